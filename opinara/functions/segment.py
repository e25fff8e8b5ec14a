"""Dictionary tokenizer and HTML entities.

A lexicon entry is ``(word, tag)``. A run of ASCII letters and digits is one
token; elsewhere the longest lexicon word that starts at a position is taken,
or else the single character. A lexicon too long for a regular expression runs as a
trie over Arrow batches; all else stays in the JVM.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator, Mapping
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V
from . import patterns as P
from .arrays import few_at_a_time, place_in
from .text import english_tokens, keep_tagged

REGEX_WORD_LIMIT = 500
#: Marks the end of a word in a trie; no character is longer than one.
END = "end"
PAIRS = "array<struct<word:string,tag:string>>"
PIECES = pa.list_(pa.struct([("word", pa.string()), ("tag", pa.string())]))


def custom_lexicon(words: Iterable[str] = V.CUSTOM_WORDS, tag: str = V.CUSTOM_WORD_TAG) -> dict[str, str]:
    return {w: tag for w in words}


def _tag_of(word: Column, lexicon: Mapping[str, str]) -> Column:
    by_tag: dict[str, list[str]] = {}
    for entry, tag in lexicon.items():
        by_tag.setdefault(tag, []).append(entry)
    chosen = F.when(F.lit(False), "")
    for tag, entries in by_tag.items():
        chosen = chosen.when(word.isin(entries), tag)
    return (
        chosen.when(word.rlike("^[0-9]+$"), "m")
        .when(word.rlike("^[A-Za-z0-9]+$"), "eng")
        .otherwise("x")
    )


def _spoken(lexicon: Mapping[str, str]) -> list[str]:
    """Lexicon words that are not plain ASCII runs, longest first."""
    words = (w for w in lexicon if not re.fullmatch(r"[A-Za-z0-9]+", w))
    return sorted(words, key=lambda w: (-len(w), w))


def _segment_by_regex(text: Column, lexicon: Mapping[str, str], listed_only: bool) -> Column:
    pieces = [P.any_of(_spoken(lexicon)), "[A-Za-z0-9]+"]
    if not listed_only:
        pieces.append("(?s:.)")
    found = F.regexp_extract_all(text, F.lit("|".join(x for x in pieces if x)), F.lit(0))
    if listed_only:
        found = F.filter(found, lambda w: w.isin(sorted(lexicon)))
    return F.transform(
        found, lambda w: F.struct(w.alias("word"), _tag_of(w, lexicon).alias("tag"))
    )


def _segment_by_batch(text: Column, lexicon: Mapping[str, str], listed_only: bool) -> Column:
    tags, spoken = dict(lexicon), _spoken(lexicon)

    @F.arrow_udf(PAIRS)
    def segment_batch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        trie: dict = {}
        for word in spoken:
            node = trie
            for ch in word:
                node = node.setdefault(ch, {})
            node[END] = word
        first = "".join(re.escape(ch) for ch in trie)
        place = re.compile("[A-Za-z0-9]+" + (f"|[{first}]" if first else ""))
        if not listed_only:
            place = re.compile("[A-Za-z0-9]+|.", re.DOTALL)

        def tag(word: str) -> str:
            if word in tags:
                return tags[word]
            if re.fullmatch("[0-9]+", word):
                return "m"
            return "eng" if re.fullmatch("[A-Za-z0-9]+", word) else "x"

        def longest(line: str, at: int) -> str | None:
            """The longest lexicon word that starts here: one step per character of it."""
            node, found = trie.get(line[at]), None
            while node is not None:
                found = node.get(END, found)
                at += 1
                node = node.get(line[at]) if at < len(line) else None
            return found

        def cut(line: str) -> list[dict[str, str]]:
            out, hit = [], place.search(line)
            while hit:
                word = longest(line, hit.start()) or hit.group(0)
                if not listed_only or word in tags:
                    out.append({"word": word, "tag": tag(word)})
                hit = place.search(line, hit.start() + len(word))
            return out

        for lines in batches:
            # A few texts at a time are Python values; the batch itself stays in Arrow.
            parts = [pa.array([None if s is None else cut(s) for s in part.to_pylist()], PIECES) for part in few_at_a_time(lines)]
            yield pa.concat_arrays(parts)

    return segment_batch(text)


def segment(
    text: Column,
    lexicon: Mapping[str, str],
    in_jvm: bool | None = None,
    listed_only: bool = False,
) -> Column:
    """``array<struct<word,tag>>`` by longest match, optionally only lexicon words.

    Up to ``REGEX_WORD_LIMIT`` words run as one ordered alternation in the JVM;
    a larger lexicon runs in Arrow batches with the same rule.
    """
    if in_jvm is None:
        in_jvm = len(lexicon) <= REGEX_WORD_LIMIT
    build = _segment_by_regex if in_jvm else _segment_by_batch
    return build(text, lexicon, listed_only)


def dictionary_tokens(
    text: Column,
    lexicon: Mapping[str, str],
    stopwords: Iterable[str],
    tags: Iterable[str] = V.KEPT_TAGS,
    in_jvm: bool | None = None,
) -> Column:
    """Lexicon words of at least two characters with a kept tag that are not stop words.

    Unlisted runs and characters carry tags that are never kept, so they are not
    built at all unless the caller keeps such a tag.
    """
    tags, stop = tuple(tags), sorted(set(stopwords))
    listed_only = not any(t in ("x", "m", "e", "en", "eng") for t in tags)
    kept = keep_tagged(segment(text, lexicon, in_jvm, listed_only), tags)
    words = F.transform(kept, lambda p: F.trim(p["word"]))
    return F.filter(
        words, lambda w: (F.length(w) > 1) & (~w.isin(stop) if stop else F.lit(True))
    )


def tokens(
    text: Column, language: Column, lexicon: Mapping[str, str], stopwords: Iterable[str]
) -> Column:
    """English texts by pattern, all others by dictionary."""
    stop = sorted(set(stopwords))
    return F.when(language == "en", english_tokens(text, stop)).otherwise(
        dictionary_tokens(text, lexicon, stop)
    )


#: A reference as browsers read it: a number in two forms, or a name.
REFERENCE = "&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\\t\\n\\f <&#;]{1,32};?)"
#: Digits beyond which a number is past the last code point.
MOST_DIGITS = 9


def _code_point(number: Column) -> Column:
    """The character of a code point."""
    return F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")


def _numeric(reference: Column) -> Column:
    """The text of ``&#...``; numbers that are no character follow the fixed rules of HTML."""
    digits = F.ltrim(F.regexp_extract(reference, "^&#[xX]?([0-9a-fA-F]+)", 1), F.lit("0"))
    base = F.when(reference.rlike("^&#[xX]"), 16).otherwise(10)
    number = F.when(F.length(digits) > MOST_DIGITS, F.lit(1 << 40)).when(digits == "", F.lit(0)).otherwise(
        F.when(base == 16, F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10)).cast("long")
    )
    table = html._invalid_charrefs  # the fixed list of the HTML standard
    known = F.create_map(*[F.lit(x) for code, shown in sorted(table.items()) for x in (code, shown)])
    absent = (number.between(0xD800, 0xDFFF)) | (number > 0x10FFFF)
    control = number.between(1, 8) | (number == 11) | number.between(14, 31) | number.between(127, 159)
    control = control | number.between(0xFDD0, 0xFDEF) | (number.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    return (
        F.when(number.isin(sorted(table)), F.try_element_at(known, number.cast("int")))
        .when(absent, F.lit("\ufffd"))
        .when(control, F.lit(""))
        .otherwise(_code_point(number))
    )


def _named(reference: Column) -> Column:
    """The text of ``&name``: the whole name, else its longest known beginning, else as it stands."""
    names = sorted(html5)
    listed, shown = F.array(*map(F.lit, names)), F.array(*[F.lit(html5[n]) for n in names])
    name = F.substring(reference, F.lit(2), F.length(reference))

    def entry(part: Column) -> Column:
        at = place_in(listed, part, len(names))
        return F.when(F.get(listed, at) == part, F.concat(F.get(shown, at), F.substring(name, F.length(part) + 1, F.length(name))))

    lengths = F.sequence(F.length(name), F.least(F.lit(2), F.length(name)), F.lit(-1))
    found = F.get(F.filter(F.transform(lengths, lambda n: entry(F.substring(name, F.lit(1), n))), lambda x: x.isNotNull()), F.lit(0))
    return F.coalesce(found, reference)


def html_unescape(text: Column | str) -> Column:
    """HTML references decoded (``&amp;`` becomes ``&``), by array functions over the text between them."""
    body = F.col(text) if isinstance(text, str) else text

    def joined(found: Column) -> Column:
        decoded = F.transform(found, lambda r: F.when(r.startswith("&#"), _numeric(r)).otherwise(_named(r)))
        between = F.split(body, REFERENCE, -1)
        return F.array_join(F.flatten(F.zip_with(between, decoded, lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")

    found = F.get(F.transform(F.array(F.regexp_extract_all(body, F.lit(REFERENCE), F.lit(0))), joined), F.lit(0))
    return F.when(F.contains(body, F.lit("&")), found).otherwise(body)
