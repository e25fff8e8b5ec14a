"""License scan: ordered signature rules behind a keyword prefilter.

A rule is a pattern with a label, a priority and keywords; it is tried only in texts that have all
its keywords among their words, which one intersection with the keywords of all rules tells.
Such a text becomes its lower-case words, each between two blanks of its own, so that a pattern of
whole words needs no look-around and neighbouring matches share no character.
A detection that lies inside one of at least its priority goes (of equal intervals the
earlier rule stays), and so does one that overlaps a detection of higher priority.

Phrases are searched beside the rules, and all their places count whatever the rules find.

Column expressions only; every row is worked on where it lies.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import maxima_before, once, sums_before

#: What lies between words, before A-Z become lower case.
BETWEEN = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Phrases whose places are counted, with their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Priorities of the forms in which a license is named, and the score that each gives a text.
IDENTIFIER, GRANT, NAME = 3, 2, 1
SCORES = {IDENTIFIER: 1.0, GRANT: 0.9, NAME: 0.7}

#: Label, keywords and name. A pattern is written in words between single blanks; an optional word
#: brings its blank along. ``{v}`` stands for the word version, ``{l}`` for license.
LICENSES = (
    ("apache-1.0", "apache", "apache (software )?{l} {v}1 0"),
    ("apache-1.1", "apache", "apache (software )?{l} {v}1 1"),
    ("apache-2.0", "apache", "apache (software )?({l} )?{v}2 0|apache (software )?{l} {v}2"),
    ("apache-2.0", "apache2", "apache2 {l}"),
    ("apache", "apache", "apache (software )?{l}"),
    ("mit-0", "mit", "mit 0( {l})?|mit no attribution( {l})?"),
    ("mit", "mit", "mit {l}|mit x11( {l})?|mit style {l}"),
    ("mit", "expat", "expat {l}"),
    ("x11", "x11", "x11 {l}"),
    ("isc", "isc", "isc {l}|isc style {l}"),
    ("0bsd", "0bsd", "0bsd"),
    ("0bsd", "bsd zero clause", "bsd zero clause( {l})?|zero clause bsd( {l})?"),
    ("bsd-1-clause", "bsd", "bsd 1 clause( {l})?|1 clause bsd( {l})?"),
    ("bsd-2-clause", "bsd", "bsd (2|two) clause( {l})?|(2|two) clause bsd( {l})?|simplified bsd {l}"),
    ("bsd-2-clause", "freebsd", "freebsd {l}"),
    ("bsd-3-clause", "bsd", "bsd (3|three) clause( {l})?|(3|three) clause bsd( {l})?|(new|modified|revised) bsd {l}"),
    ("bsd-4-clause", "bsd", "bsd (4|four) clause( {l})?|(4|four) clause bsd( {l})?|original bsd {l}"),
    ("bsd", "bsd", "bsd( style)? {l}"),
    ("gpl-1.0", "general public", "(gnu )?general public {l} {v}1( 0)?"),
    ("gpl-2.0", "general public", "(gnu )?general public {l} {v}2( 0)?"),
    ("gpl-3.0", "general public", "(gnu )?general public {l} {v}3( 0)?"),
    ("gpl", "general public", "(gnu )?general public {l}"),
    ("gpl-2.0", "gpl", "(gnu )?gpl {v}2( 0)?"),
    ("gpl-2.0", "gplv2", "gplv2( 0)?"),
    ("gpl-3.0", "gpl", "(gnu )?gpl {v}3( 0)?"),
    ("gpl-3.0", "gplv3", "gplv3( 0)?"),
    ("gpl", "gpl", "gnu gpl|gpl {l}"),
    ("lgpl-2.0", "general public", "(gnu )?library general public {l}( {v}2( 0)?)?"),
    ("lgpl-2.1", "general public", "(gnu )?lesser general public {l} {v}2 1"),
    ("lgpl-3.0", "general public", "(gnu )?lesser general public {l} {v}3( 0)?"),
    ("lgpl", "general public", "(gnu )?lesser general public {l}"),
    ("lgpl-2.1", "lgpl", "(gnu )?lgpl {v}2 1"),
    ("lgpl-2.1", "lgplv2", "lgplv2 1"),
    ("lgpl-3.0", "lgpl", "(gnu )?lgpl {v}3( 0)?"),
    ("lgpl-3.0", "lgplv3", "lgplv3( 0)?"),
    ("lgpl", "lgpl", "gnu lgpl|lgpl {l}"),
    ("agpl-3.0", "affero", "(gnu )?affero general public {l} {v}3( 0)?"),
    ("agpl", "affero", "(gnu )?affero general public {l}"),
    ("agpl-3.0", "agpl", "(gnu )?agpl {v}3( 0)?"),
    ("agpl-3.0", "agplv3", "agplv3"),
    ("agpl", "agpl", "gnu agpl|agpl {l}"),
    ("gfdl-1.1", "free documentation", "(gnu )?free documentation {l} {v}1 1"),
    ("gfdl-1.2", "free documentation", "(gnu )?free documentation {l} {v}1 2"),
    ("gfdl-1.3", "free documentation", "(gnu )?free documentation {l} {v}1 3"),
    ("gfdl", "free documentation", "(gnu )?free documentation {l}"),
    ("mpl-1.0", "mozilla public", "mozilla public {l} {v}1 0"),
    ("mpl-1.1", "mozilla public", "mozilla public {l} {v}1 1"),
    ("mpl-2.0", "mozilla public", "mozilla public {l} {v}2( 0)?"),
    ("mpl", "mozilla public", "mozilla public {l}"),
    ("mpl-2.0", "mpl", "mpl {v}2( 0)?"),
    ("epl-1.0", "eclipse public", "eclipse public {l} {v}1( 0)?"),
    ("epl-2.0", "eclipse public", "eclipse public {l} {v}2( 0)?"),
    ("epl", "eclipse public", "eclipse public {l}"),
    ("cddl-1.0", "common development", "common development and distribution {l} {v}1 0"),
    ("cddl-1.1", "common development", "common development and distribution {l} {v}1 1"),
    ("cddl", "common development", "common development and distribution {l}"),
    ("cpl-1.0", "common public", "common public {l}( {v}1( 0)?)?"),
    ("eupl-1.1", "european union public", "european union public {l} {v}1 1"),
    ("eupl-1.2", "european union public", "european union public {l} {v}1 2"),
    ("eupl", "european union public", "european union public {l}"),
    ("artistic-1.0", "artistic", "artistic {l} {v}1( 0)?"),
    ("artistic-2.0", "artistic", "artistic {l} {v}2( 0)?"),
    ("artistic", "artistic", "artistic {l}"),
    ("bsl-1.0", "boost software", "boost software {l}( {v}1( 0)?)?"),
    ("busl-1.1", "business source", "business source {l}( {v}1 1)?"),
    ("zlib", "zlib", "zlib( libpng)? {l}"),
    ("unlicense", "unlicense", "the unlicense|unlicense {l}"),
    ("wtfpl", "wtfpl", "wtfpl( {v}2)?"),
    ("cc0-1.0", "cc0", "cc0( {v}1( 0)?)?( universal)?"),
    ("cc-by-1.0", "cc by", "cc by 1 0"),
    ("cc-by-2.0", "cc by", "cc by 2 0"),
    ("cc-by-2.5", "cc by", "cc by 2 5"),
    ("cc-by-3.0", "cc by", "cc by 3 0"),
    ("cc-by-4.0", "cc by", "cc by 4 0"),
    ("cc-by-sa-2.0", "cc by sa", "cc by sa 2 0"),
    ("cc-by-sa-3.0", "cc by sa", "cc by sa 3 0"),
    ("cc-by-sa-4.0", "cc by sa", "cc by sa 4 0"),
    ("cc-by-sa", "cc by sa", "cc by sa"),
    ("cc-by-nd-3.0", "cc by nd", "cc by nd 3 0"),
    ("cc-by-nd-4.0", "cc by nd", "cc by nd 4 0"),
    ("cc-by-nd", "cc by nd", "cc by nd"),
    ("cc-by-nc-3.0", "cc by nc", "cc by nc 3 0"),
    ("cc-by-nc-4.0", "cc by nc", "cc by nc 4 0"),
    ("cc-by-nc", "cc by nc", "cc by nc"),
    ("cc-by-nc-sa-3.0", "cc by nc sa", "cc by nc sa 3 0"),
    ("cc-by-nc-sa-4.0", "cc by nc sa", "cc by nc sa 4 0"),
    ("cc-by-nc-sa", "cc by nc sa", "cc by nc sa"),
    ("cc-by-nc-nd-3.0", "cc by nc nd", "cc by nc nd 3 0"),
    ("cc-by-nc-nd-4.0", "cc by nc nd", "cc by nc nd 4 0"),
    ("cc-by-nc-nd", "cc by nc nd", "cc by nc nd"),
    ("cc-by-4.0", "creative commons", "creative commons attribution 4 0( international)?( {l})?"),
    ("cc-by-3.0", "creative commons", "creative commons attribution 3 0( unported)?( {l})?"),
    ("cc-by-sa-4.0", "creative commons", "creative commons attribution share ?alike 4 0( international)?( {l})?"),
    ("cc-by-sa-3.0", "creative commons", "creative commons attribution share ?alike 3 0( unported)?( {l})?"),
    ("cc-by-sa", "creative commons", "creative commons attribution share ?alike( {l})?"),
    ("cc-by-nc-4.0", "creative commons", "creative commons attribution non ?commercial 4 0( international)?( {l})?"),
    ("cc-by-nc", "creative commons", "creative commons attribution non ?commercial( {l})?"),
    ("cc-by-nd", "creative commons", "creative commons attribution no ?deriv(ative)?s( {l})?"),
    ("cc-by-nc-sa", "creative commons", "creative commons attribution non ?commercial share ?alike( 4 0| 3 0)?( {l})?"),
    ("cc-by-nc-nd", "creative commons", "creative commons attribution non ?commercial no ?deriv(ative)?s( 4 0| 3 0)?( {l})?"),
    ("cc-by", "creative commons", "creative commons attribution( {l})?"),
    ("cc0-1.0", "creative commons", "creative commons (zero|cc0)( 1 0)?( universal)?"),
    ("cc", "creative commons", "creative commons( {l})?"),
    ("odbl-1.0", "open database", "open database {l}( {v}1( 0)?)?"),
    ("odc-by-1.0", "open data commons", "open data commons attribution {l}( {v}1( 0)?)?"),
    ("pddl-1.0", "public domain dedication", "public domain dedication and {l}"),
    ("ofl-1.1", "open font", "(sil )?open font {l}( {v}1 1)?"),
    ("ofl-1.1", "sil", "sil ofl( {v}1 1)?"),
    ("psf-2.0", "python software foundation", "python software foundation {l}( {v}2)?"),
    ("php-3.01", "php", "php {l}( {v}3 01)?"),
    ("ruby", "ruby", "ruby {l}|ruby s {l}"),
    ("openssl", "openssl", "openssl {l}"),
    ("vim", "vim", "vim {l}"),
    ("postgresql", "postgresql", "postgresql {l}"),
    ("ncsa", "illinois", "university of illinois (ncsa )?open source {l}"),
    ("ms-pl", "microsoft public", "microsoft public {l}"),
    ("ms-rl", "microsoft reciprocal", "microsoft reciprocal {l}"),
    ("osl-3.0", "open software", "open software {l}( {v}3( 0)?)?"),
    ("afl-3.0", "academic free", "academic free {l}( {v}3( 0)?)?"),
    ("elastic-2.0", "elastic", "elastic {l}( {v}2( 0)?)?"),
    ("sspl-1.0", "server side public", "server side public {l}( {v}1)?"),
    ("upl-1.0", "universal permissive", "universal permissive {l}( {v}1( 0)?)?"),
    ("blueoak-1.0.0", "blue oak", "blue oak model {l}( {v}1 0 0)?"),
    ("mulan-psl-2.0", "mulan", "mulan permissive software {l}( {v}2)?"),
    ("openrail", "openrail", "openrail( m)?( {l})?"),
    ("llama", "llama", "llama (2 |3 |3 1 )?community {l}"),
    ("public-domain", "public domain", "(in|into) the public domain|dedicated to the public domain"),
)

#: Sentences of license texts and notices, with priority.
TEXTS = (
    ("mit", "permission is hereby granted", GRANT, "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "without restriction", GRANT, "deal in the software without restriction including without limitation the rights to use"),
    ("isc", "permission to use", GRANT, "permission to use copy modify and( or)? distribute this software for any purpose"),
    ("bsd", "redistribution and use", GRANT, "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "endorse or promote", GRANT, "may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising materials", GRANT, "all advertising materials mentioning features or use of this software"),
    ("apache-2.0", "apache org", GRANT, "(https? )?www apache org licenses {l} 2 0"),
    ("gpl", "free software", GRANT, "you can redistribute it and or modify it under the terms of the gnu general public {l}"),
    ("lgpl", "free software", GRANT, "you can redistribute it and or modify it under the terms of the gnu lesser general public {l}"),
    ("agpl", "free software", GRANT, "you can redistribute it and or modify it under the terms of the gnu affero general public {l}"),
    ("gpl-2.0-or-later", "later version", GRANT, "general public {l} {v}2( 0)? or (at your option )?any later version"),
    ("gpl-3.0-or-later", "later version", GRANT, "general public {l} {v}3( 0)? or (at your option )?any later version"),
    ("mpl-2.0", "mozilla org", GRANT, "(https? )?(www )?mozilla org mpl 2 0"),
    ("mpl-2.0", "source code form", GRANT, "this source code form is subject to the terms of the mozilla public {l} v 2 0"),
    ("zlib", "as is without any express implied warranty", GRANT, "provided as is without any express or implied warranty"),
    ("unlicense", "unencumbered", GRANT, "free and unencumbered software released into the public domain"),
    ("wtfpl", "what you want", GRANT, "do what the f[a-z]+ you want to public {l}"),
    ("cc", "creativecommons", GRANT, "(https? )?(www )?creativecommons org licenses"),
    ("cc0-1.0", "creativecommons", GRANT, "(https? )?(www )?creativecommons org publicdomain zero( 1 0)?"),
    ("cc-by-4.0", "creativecommons", GRANT, "(https? )?(www )?creativecommons org licenses by 4 0"),
    ("cc-by-sa-4.0", "creativecommons", GRANT, "(https? )?(www )?creativecommons org licenses by sa 4 0"),
    ("cc-by-nc-4.0", "creativecommons", GRANT, "(https? )?(www )?creativecommons org licenses by nc 4 0"),
    ("bsl-1.0", "boost org", GRANT, "(https? )?www boost org {l} 1 0 txt"),
    ("proprietary", "proprietary", NAME, "proprietary and confidential|proprietary {l}"),
    ("proprietary", "confidential", NAME, "confidential and proprietary"),
    ("proprietary", "unauthorized prohibited", NAME, "unauthorized (copying|reproduction|distribution) (of this file )?is (strictly )?prohibited"),
    ("no-license", "no part of this", NAME, "no part of this (book|publication|work|document) may be reproduced"),
    ("copyright", "copyright", NAME, "copyright (c )?(19|20)[0-9]{2}( (19|20)[0-9]{2})?"),
    ("terms-of-use", "terms", NAME, "terms of (use|service)"),
    ("permission-needed", "permission", NAME, "(used|reprinted|reproduced) (with|by) (kind )?permission"),
)


@dataclass(frozen=True)
class Rule:
    """``keywords`` are words that every match has."""

    label: str
    keywords: tuple[str, ...]
    priority: int
    pattern: str


def spelled(pattern: str) -> str:
    """A pattern of words for text whose words each stand between two blanks of their own."""
    plain = pattern.replace(" ?", "( )?").replace("{v}", "(version |v )?v?").replace("{l}", "licen[cs]e")
    return f" (?:{plain})".replace(" ", "  ")[1:] + " "


def rules() -> list[Rule]:
    """All rules in order: identifiers, grants and names of each license, then sentences."""
    grant = "(licen[cs]ed|released|distributed|available|published|provided|covered|used) under (the )?(terms of (the )?)?"
    made = []
    for label in dict.fromkeys(label for label, _, _ in LICENSES):
        words = label.replace("-", " ").replace(".", " ")
        made.append(Rule(label, ("spdx", "identifier"), IDENTIFIER, spelled(f"spdx {{l}} identifier {words}( only| or later)?")))
    for label, keywords, name in LICENSES:
        made.append(Rule(label, ("under", *keywords.split(" ")), GRANT, spelled(f"{grant}({name})")))
        made.append(Rule(label, tuple(keywords.split(" ")), NAME, spelled(name)))
    return made + [Rule(label, tuple(keywords.split(" ")), priority, spelled(text)) for label, keywords, priority, text in TEXTS]


RULES = rules()


def plain_words(text: Column) -> Column:
    """The words, with a blank between them, in the case of the text."""
    return F.trim(F.regexp_replace(text, BETWEEN, " "))


def padded(plain: Column) -> Column:
    """The lower-case words, each between two blanks of its own. Only A-Z change."""
    return F.concat(F.lit(" "), F.replace(F.translate(plain, UPPER, LOWER), F.lit(" "), F.lit("  ")), F.lit(" "))


def known_words(plain: Column, wanted: Sequence[Rule], phrases: Sequence[tuple[str, str]]) -> Column:
    """The keywords that are among the words. ``lower`` changes more than A-Z and so finds all of them, if not only them."""
    keywords = {word for rule in wanted for word in rule.keywords} | {phrase.split(" ")[0] for phrase, _ in phrases}
    return F.array_intersect(F.split(F.lower(plain), " ", -1), F.from_json(F.lit(json.dumps(sorted(keywords))), "array<string>"))


def n_words(padded: Column) -> Column:
    """Number of words of a padded text, or of a piece of one that ends between words."""
    return F.floor((F.length(padded) - F.length(F.replace(padded, F.lit(" "), F.lit("")))) / 2).cast("int")


def phrase_places(padded: Column, phrase: str, label: str) -> Column:
    """Number, first and last start of the places of a phrase; null if there are none.

    Only the first word is taken off, so places that overlap all count.
    """
    first, *rest = phrase.split(" ")
    after = "".join(f" {word} " for word in rest)

    def counted(parts: Column) -> Column:
        last = n_words(padded) - n_words(F.element_at(parts, -1)) - 1
        return F.struct(
            F.lit(label).alias("label"), (F.size(parts) - 1).alias("n"), n_words(F.get(parts, F.lit(0))).alias("first"), last.alias("last")
        )

    return F.when(F.contains(padded, F.lit(f" {first} {after}")), once(F.split(padded, f" {first} (?={after})", -1), counted))


PLACE = "array<struct<label: string, n: int, first: int, last: int>>"
DETECTION = "array<struct<start: int, back: int, low: int, rank: int, label: string>>"
GROUPS = "array<struct<keywords: array<string>, rules: array<struct<rank: int, label: string, low: int, pattern: string>>>>"


def rule_table(wanted: Sequence[Rule]) -> Column:
    """The rules by keywords, in order of first use, as one constant."""
    groups: dict[tuple[str, ...], list[dict]] = {}
    for rank, rule in enumerate(wanted):
        groups.setdefault(rule.keywords, []).append({"rank": rank, "label": rule.label, "low": -rule.priority, "pattern": rule.pattern})
    return F.from_json(F.lit(json.dumps([{"keywords": keywords, "rules": rows} for keywords, rows in groups.items()])), GROUPS)


def detections(padded: Column, known: Column, wanted: Sequence[Rule]) -> Column:
    """All matches of the rules whose keywords are known; ``back`` is the end and ``low`` the priority, negative."""

    def of_rule(rule: Column) -> Column:
        def placed(found: Column) -> Column:
            gaps = F.transform(F.slice(F.split(padded, rule["pattern"], -1), F.lit(1), F.size(found)), n_words)
            sizes = F.transform(found, n_words)
            started = lambda g, s: F.zip_with(sums_before(F.zip_with(g, s, lambda a, b: a + b)), g, lambda before, gap: before + gap)
            built = lambda start, size: F.struct(
                start.alias("start"), (-(start + size)).alias("back"), rule["low"].alias("low"), rule["rank"].alias("rank"), rule["label"].alias("label")
            )
            return once(gaps, lambda g: once(sizes, lambda s: F.zip_with(started(g, s), s, built)))

        found = F.regexp_extract_all(padded, rule["pattern"], F.lit(0))
        return once(found, lambda f: F.when(F.size(f) > 0, placed(f)).otherwise(F.array().cast(DETECTION)))

    held = F.filter(rule_table(wanted), lambda group: F.forall(group["keywords"], lambda word: F.array_contains(known, word)))
    return F.flatten(F.transform(held, lambda group: F.flatten(F.transform(group["rules"], of_rule))))


def resolved(found: Column) -> Column:
    """The detections that no other suppresses, by start, then longest, then priority, then rule."""
    levels = sorted(SCORES)

    def of_sorted(rows: Column) -> Column:
        at_least = lambda level: F.transform(rows, lambda x: F.when(x["low"] <= -level, -x["back"]).otherwise(F.lit(0)))
        ahead = lambda level: F.reverse(F.transform(rows, lambda x: F.when(x["low"] <= -level, -x["start"]).otherwise(F.lit(-(1 << 30)))))
        ends = F.array(*[maxima_before(at_least(level), 0) for level in levels])
        nexts = F.array(*[F.reverse(maxima_before(ahead(level), -(1 << 30))) for level in levels[1:]])

        def kept(e: Column, n: Column) -> Column:
            def stays(x: Column, i: Column) -> Column:
                place = F.array_position(F.array(*map(F.lit, levels)), -x["low"]).cast("int")
                inside = F.get(F.get(e, place - 1), i) >= -x["back"]
                crossed = (F.get(F.get(e, place), i) > x["start"]) | (-F.get(F.get(n, place - 1), i) < -x["back"])
                return ~inside & ~F.coalesce(crossed, F.lit(False))

            return F.filter(rows, stays)

        return once(ends, lambda e: once(nexts, lambda n: kept(e, n)))

    return F.when(F.size(found) > 1, once(F.array_sort(found), of_sorted)).otherwise(found)


def licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    phrases: Sequence[tuple[str, str]] = PHRASES, wanted: Sequence[Rule] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``places`` and ``found``.

    ``places`` has for each phrase that occurs its label, the number of its places and the
    first and last word that starts one. ``found`` has the detections that stay: ``start`` and
    ``stop`` (words, end exclusive), ``label`` and ``priority``. Words are runs of 0-9, a-z and
    everything beyond ASCII, A-Z lower-cased. Null and empty texts, and texts without words, have 0 words
    and nothing found. Rows that repeat are scanned each. Other columns are left out. An
    empty table gives none.
    """
    wanted = RULES if wanted is None else wanted

    def places(spread: Column) -> Column:
        return F.array_compact(F.array(*[phrase_places(spread, phrase, label) for phrase, label in phrases])).cast(PLACE)

    def found(spread: Column, known: Column) -> Column:
        return F.transform(once(detections(spread, known, wanted), resolved), lambda x: F.struct(
            x["start"].alias("start"), (-x["back"]).alias("stop"), x["label"].alias("label"), (-x["low"]).alias("priority")
        ))

    def answer(plain: Column, known: Column) -> Column:
        hits = F.when(F.size(known) > 0, once(padded(plain), lambda spread: F.struct(places(spread).alias("places"), found(spread, known).alias("found"))))
        number = F.when(plain == "", 0).otherwise(F.size(F.split(plain, " ", -1))).cast("long")
        return F.struct(number.alias("n_words"), hits.alias("hits"))

    plain = plain_words(F.coalesce(F.col(text_col), F.lit("")))
    result = once(plain, lambda p: once(known_words(p, wanted, phrases), lambda known: answer(p, known)))
    rows = docs.select(F.col(id_col).alias(id_col), F.explode(F.array(result)).alias("_answer"))
    nothing = lambda kind: F.array().cast(kind)
    return rows.select(
        id_col, "_answer.n_words", F.coalesce("_answer.hits.places", nothing(PLACE)).alias("places"),
        F.coalesce("_answer.hits.found", nothing("array<struct<start: int, stop: int, label: string, priority: int>>")).alias("found"),
    )
