"""Word tables of any length looked up inside texts: containment and segmentation.

A list that is measured to be short is searched for in the row, by a trie over Arrow batches: no text moves. In a
longer one a word is found by one of its grams, pieces of up to ``GRAM`` characters. Each word is
anchored at that of its grams which is rarest in a look at some texts; the texts give
each of their grams once, and only words whose anchor occurs are searched for, in the row of their text. The
anchors change what a search costs, never what it finds.

Segmentation by a few words is the ordered alternation of ``functions.segment``. By more words it finds all of them at
all positions, keeps the longest of each, and follows
the path from the first position by doubling: the places reached after 1, 2, 4, ... tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import trie as X
from ..functions.segment import REGEX_WORD_LIMIT, segment
from ..functions.text import keep_tagged
from .columns import computed_once, exploded
from .membership import hinted, listed_rows, without_listed_tokens

#: Longest gram that anchors a word.
GRAM = 4
#: Texts looked at to tell which grams are rare.
LOOKED_AT = 10_000


def characters(text: Column) -> Column:
    """The characters of a text, in one pass; a null text has none."""
    return F.when(text != "", F.split(text, "")).otherwise(F.array().cast("array<string>"))


def pieces(letters: Column, lengths: Iterable[int]) -> Column:
    """All pieces of the given lengths, as an array for each length; the n-th starts at the n-th letter."""
    wanted = sorted(set(lengths))

    def longer(shorter: Column, length: int) -> Column:
        """Each piece one letter longer, those at the end left out."""
        count = F.greatest(F.size(letters) - (length - 1), F.lit(0))
        return F.zip_with(F.slice(shorter, F.lit(1), count), F.slice(letters, F.lit(length), count), lambda a, b: F.concat(a, b))

    arrays, grown = [], letters
    for length in range(1, max(wanted, default=0) + 1):
        grown = letters if length == 1 else longer(grown, length)
        if length in wanted:
            arrays.append(grown)
    return F.array(*arrays).cast("array<array<string>>")


def _gram_length(word: Column) -> Column:
    return F.least(F.length(word), F.lit(GRAM))


def _text_grams(texts: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, gram)``: each gram of a text once, at most ``GRAM`` times as many as it has characters."""
    lists = pieces(characters(F.col(text)), range(1, GRAM + 1))
    return exploded(texts.where(F.col(text) != ""), [key], F.array_distinct(F.flatten(lists)), "_gram")


def anchored(words: DataFrame, texts: DataFrame, key: str, text: str) -> DataFrame:
    """The words with ``_gram``, their rarest gram in some of the texts; ties go to the first gram by code point."""
    at = F.sequence(F.lit(1), F.length("word") - _gram_length(F.col("word")) + 1)
    grams = exploded(words.select("word").distinct(), ["word"], F.transform(at, lambda i: F.substring(F.col("word"), i, _gram_length(F.col("word")))), "_gram")
    some = _text_grams(texts.select(key, text).limit(LOOKED_AT), key, text)
    known = some.join(grams.select("_gram").distinct(), "_gram").groupBy("_gram").agg(F.count(F.lit(1)).alias("_texts"))
    counted = grams.join(known, "_gram", "left").withColumn("_texts", F.coalesce("_texts", F.lit(0)))
    least = counted.groupBy("word").agg(F.min(F.struct("_texts", "_gram")).alias("_least"))
    return words.join(least.select("word", F.col("_least._gram").alias("_gram")), "word")


def _distinct_labels(listed: DataFrame) -> DataFrame:
    return listed.select("word", "label").where("word <> '' and label is not null").distinct()


def _labels_column(text: Column, listed: Sequence[Row]) -> Column:
    """The sorted labels of the listed words in a text, an empty array without any."""
    by_word: dict[str, list[str]] = {}
    for row in listed:
        by_word.setdefault(row["word"], []).append(row["label"])
    names = sorted({row["label"] for row in listed})
    number = {name: i for i, name in enumerate(names)}
    built, labels = X.build(list(by_word)), pa.array(names, pa.string())
    starts = np.cumsum([0, *map(len, by_word.values())])
    ids = np.array([number[name] for own in by_word.values() for name in own], np.int64)

    @F.arrow_udf("array<string>")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        finder = X.Finder(built)
        for texts in batches:
            yield X.labels_of(texts, finder, starts, ids, labels)

    return find(text)


def labels_in(texts: DataFrame, key: str, text: str, listed: DataFrame) -> DataFrame:
    """``(key, labels)``: the labels of the listed ``(word, label)`` rows whose word a text contains, distinct and sorted.

    Texts without any are absent; ``key`` must be unique. Empty and null words never match. A list that is measured
    to be short is searched for in the row of the text; a longer one is joined by gram.
    """
    words, few = listed_rows(_distinct_labels(listed))
    if few is not None:
        rows = texts.where(F.col(key).isNotNull() & (F.col(text) != "")).select(key, text)
        return computed_once(rows, "labels", _labels_column(F.col(text), few)).select(key, "labels").where(F.size("labels") > 0)
    return _labels_by_gram(texts, key, text, words)


def _labels_by_gram(texts: DataFrame, key: str, text: str, words: DataFrame) -> DataFrame:
    """``labels_in`` for lists of any length, by a join."""
    index = hinted(anchored(words, texts, key, text)).withColumn("_sure", F.col("_gram") == F.col("word"))
    found = _text_grams(texts, key, text).join(index, "_gram")
    # A word that is its own gram is in the text; of the others the text decides, once for all of them.
    hits = found.groupBy(key).agg(
        F.collect_set(F.when(F.col("_sure"), F.col("label"))).alias("_labels"),
        F.collect_set(F.when(~F.col("_sure"), F.struct("word", "label"))).alias("_maybe"),
    )
    joined = hits.join(texts.select(key, text), key)
    open_words = F.filter("_maybe", lambda m: ~F.array_contains("_labels", m["label"]) & F.contains(F.col(text), m["word"]))
    labels = F.array_sort(F.array_union("_labels", F.transform(open_words, lambda m: m["label"])))
    return joined.select(key, labels.alias("labels")).where(F.size("labels") > 0)


def texts_with_any(texts: DataFrame, key: str, text: str, listed: DataFrame) -> DataFrame:
    """Keys of texts that contain a listed word anywhere, for lists of any length; ``key`` must be unique."""
    return labels_in(texts, key, text, listed.select("word", F.lit("").alias("label"))).select(key)


def with_labels(rows: DataFrame, key: str, text: str, listed: DataFrame, out: str) -> DataFrame:
    """Adds the labels of the listed words that a text contains, an empty array where there are none."""
    words, few = listed_rows(_distinct_labels(listed))
    if few is not None:
        return computed_once(rows, out, F.when(F.col(key).isNotNull(), _labels_column(F.col(text), few)).otherwise(F.array().cast("array<string>")))
    found = _labels_by_gram(rows, key, text, words).select(key, F.col("labels").alias(out))
    return rows.join(found, key, "left").withColumn(out, F.coalesce(out, F.array().cast("array<string>")))


# --- segmentation ------------------------------------------------------------------

HIT = "struct<size:int,tag:string>"


def word_hits(texts: DataFrame, key: str, text: str, lexicon: DataFrame, lengths: Iterable[int]) -> DataFrame:
    """``(key, hits)``: for each position at which a word starts the longest one, in order."""
    listed = hinted(lexicon.select(F.col("word").alias("_piece"), "tag"))
    lists = pieces(characters(F.col(text)), lengths)
    spots = F.flatten(F.transform(lists, lambda same: F.transform(same, lambda piece, i: F.struct(i.alias("at"), piece.alias("piece")))))
    rows = exploded(texts.where(F.col(text) != ""), [key], spots, "_s").select(key, F.col("_s.at").alias("_at"), F.col("_s.piece").alias("_piece"))
    hits = rows.join(listed, "_piece").select(key, "_at", F.struct(F.length("_piece").alias("size"), "tag").alias("_hit"))
    longest = hits.groupBy(key, "_at").agg(F.max("_hit").alias("_hit"))
    return longest.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_at", "_hit"))).alias("hits"))


def _by_position(hits: Column, count: Column) -> Column:
    """An entry for every position from the sorted hits, null where no word starts."""
    nothing = F.lit(None).cast(HIT)
    before = lambda i: F.coalesce(F.get(hits, i - 1)["_at"], F.lit(-1))
    filled = F.transform(hits, lambda h, i: F.concat(F.array_repeat(nothing, h["_at"] - before(i) - 1), F.array(h["_hit"])))
    tail = F.array_repeat(nothing, count - 1 - F.coalesce(F.try_element_at(hits, F.lit(-1))["_at"], F.lit(-1)))
    return F.concat(F.flatten(filled), tail)


def _path(steps: Column, count: Column) -> Column:
    """The positions from 0 on at which a token starts, each ``steps`` after the last."""

    def doubled(state: Column, _: Column) -> Column:
        jump, path = state["jump"], state["path"]
        twice = F.transform(jump, lambda to: F.get(jump, to))
        return F.struct(twice.alias("jump"), F.concat(path, F.transform(path, lambda p: F.get(jump, p))).alias("path"))

    jump = F.concat(F.transform(steps, lambda size, i: F.least(i + size, count)), F.array(count))
    rounds = F.sequence(F.lit(1), F.greatest(F.ceil(F.log2(count + 1)).cast("int"), F.lit(1)))
    start = F.struct(jump.alias("jump"), F.array(F.lit(0)).alias("path"))
    return F.filter(F.aggregate(rounds, start, doubled, lambda s: s["path"]), lambda p: p < count)


def _tokens(text: Column, hits: Column) -> Column:
    """Word and tag of every token on the path: a listed word, a run of ASCII letters and digits, or one character."""
    runs = F.regexp_extract_all(text, F.lit("[A-Za-z0-9]+|(?s:.)"), F.lit(0))
    left = F.flatten(F.transform(runs, lambda run: F.sequence(F.length(run), F.lit(1), F.lit(-1))))
    bind = lambda value, use: F.get(F.transform(F.array(value), use), F.lit(0))

    def cut(letters: Column, rest: Column, listed: Column) -> Column:
        plain = lambda i: F.get(letters, i).rlike("[A-Za-z0-9]")
        # Words of ASCII letters and digits match whole runs only.
        whole = lambda hit, i: ~F.forall(F.slice(letters, i + 1, hit["size"]), lambda c: c.rlike("[A-Za-z0-9]")) | (hit["size"] == F.get(rest, i))
        known = F.transform(listed, lambda hit, i: F.when(hit.isNotNull() & whole(hit, i), hit))

        def tokens(words: Column) -> Column:
            steps = F.zip_with(words, rest, lambda hit, run: F.coalesce(hit["size"], run))

            def token(p: Column, sizes: Column) -> Column:
                word = F.array_join(F.slice(letters, p + 1, F.get(sizes, p)), "")
                kind = F.when(word.rlike("^[0-9]+$"), "m").when(plain(p), "eng").otherwise("x")
                return F.struct(word.alias("word"), F.coalesce(F.get(words, p)["tag"], kind).alias("tag"))

            return bind(steps, lambda sizes: F.transform(_path(sizes, F.size(letters)), lambda p: token(p, sizes)))

        return bind(known, tokens)

    found = F.coalesce(hits, F.array().cast(f"array<struct<_at:int,_hit:{HIT}>>"))
    return bind(characters(text), lambda letters: bind(left, lambda rest: bind(_by_position(found, F.size(letters)), lambda listed: cut(letters, rest, listed))))


def _hits_column(text: Column, listed: Sequence[Row]) -> Column:
    """The longest listed word at each position of a text, as ``word_hits`` has them."""
    built = X.build([row["word"] for row in listed])
    sizes, tags = np.array([len(row["word"]) for row in listed], np.int64), pa.array([row["tag"] for row in listed], pa.string())

    @F.arrow_udf(f"array<struct<_at:int,_hit:{HIT}>>")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        finder = X.Finder(built)
        for texts in batches:
            yield X.longest_of(texts, finder, sizes, tags)

    return find(text)


def _untagged(word: str) -> str:
    return "m" if re.fullmatch("[0-9]+", word) else "eng" if re.fullmatch("[A-Za-z0-9]+", word) else "x"


def segmented(rows: DataFrame, key: str, text: str, lexicon: DataFrame, out: str = "pairs", listed_only: bool = False) -> DataFrame:
    """Adds ``array<struct<word,tag>>`` by longest match with a ``(word, tag)`` table of any length; ``key`` must be unique.

    The tokens are those of ``functions.segment.segment``. Of several tags of a word the last by code point
    counts. Null texts have null, empty ones no tokens. Up to ``REGEX_WORD_LIMIT`` words, measured, run as that function in
    the row. Of more words, the hits are found in the row too if the list is short enough to be passed along; else a text gives
    one row for each position and each distinct length of the table's words, and only those that are words move on.
    ``listed_only`` allows, but does not promise, that other tokens are left out.
    """
    words, few = listed_rows(lexicon.where("word <> ''").groupBy("word").agg(F.max("tag").alias("tag")))
    body = F.col(text)
    if few is not None and len(few) <= REGEX_WORD_LIMIT:
        tags = {row["word"]: _untagged(row["word"]) if row["tag"] is None else row["tag"] for row in few}
        return rows.withColumn(out, segment(body, tags, True, listed_only))
    if few is not None:
        joined = computed_once(rows, "hits", _hits_column(body, few))
    else:
        lengths = [r["n"] for r in words.select(F.length("word").alias("n")).distinct().collect()]
        joined = rows.join(word_hits(rows, key, text, words, lengths), key, "left")
    pairs = F.when(body == "", F.array().cast("array<struct<word:string,tag:string>>")).otherwise(_tokens(body, F.col("hits")))
    return joined.withColumn(out, F.when(body.isNotNull(), pairs)).drop("hits")


def dictionary_tokens(
    rows: DataFrame, key: str, text: str, lexicon: DataFrame, stopwords: DataFrame | Iterable[str] = (),
    tags: Iterable[str] = V.KEPT_TAGS, out: str = "tokens",
) -> DataFrame:
    """Adds the listed words of two characters or more with a kept tag that are not stop words, in order."""
    listed_only = not any(t in ("x", "m", "e", "en", "eng") for t in tags)
    pairs = segmented(rows, key, text, lexicon, "_pairs", listed_only)
    kept = F.filter(F.transform(keep_tagged(F.col("_pairs"), tuple(tags)), lambda p: F.trim(p["word"])), lambda w: F.length(w) > 1)
    stop = sorted(set(stopwords)) if not isinstance(stopwords, DataFrame) else []
    if stop:
        kept = F.filter(kept, lambda w: ~w.isin(stop))
    found = pairs.withColumn(out, F.coalesce(kept, F.array().cast("array<string>"))).drop("_pairs")
    if isinstance(stopwords, DataFrame):
        return without_listed_tokens(found, key, stopwords, out)
    return found
