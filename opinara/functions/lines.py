"""Predicates and parts of visible page lines.

``LineRules`` holds every list and pattern, so that pages in other languages
use the same functions with their own rules.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V
from . import patterns as P
from .ids import like_count


@dataclass(frozen=True)
class LineRules:
    ui_lines: tuple[str, ...] = V.UI_LINES
    ui_phrases: tuple[str, ...] = V.UI_PHRASES
    time_patterns: tuple[str, ...] = V.TIME_PATTERNS
    from_word: str = V.FROM_WORD
    name_prefixes: tuple[str, ...] = V.NOT_NAME_PREFIXES
    name_marks: tuple[str, ...] = V.NOT_NAME_MARKS
    like_buttons: tuple[str, ...] = V.LIKE_BUTTON_LINES
    count_pattern: str = r"^(?:\p{Nd}+|\p{Nd}+(?:\.\p{Nd}+)?万)$"
    script: str = f"[{P.CJK}]"
    name_length: int = 30
    content_length: tuple[int, int] = (3, 220)
    colons: tuple[str, str] = ("：", ":")


DEFAULT = LineRules()


def is_time_line(line: Column, rules: LineRules = DEFAULT) -> Column:
    return line.rlike("|".join(rules.time_patterns))


def names_time(line: Column, rules: LineRules = DEFAULT) -> Column:
    """A time line, or a source line that shows a clock."""
    return is_time_line(line, rules) | (line.contains(rules.from_word) & line.rlike(P.CLOCK))


def is_noise_line(line: Column, rules: LineRules = DEFAULT) -> Column:
    """Blank, a button, a page phrase, a time, a source line or bare digits."""
    return (
        (line == "")
        | line.isin(list(rules.ui_lines))
        | line.rlike(P.any_of(rules.ui_phrases))
        | names_time(line, rules)
        | line.rlike(rf"^{P.quote(rules.from_word)}[{P.CJK}]{{2,8}}$")
        | line.rlike(r"^\p{Nd}+$")
    )


def looks_like_name(line: Column, rules: LineRules = DEFAULT) -> Column:
    barred = [
        r"\p{Nd}{1,2}[-/]\p{Nd}{1,2}",
        P.CLOCK,
        "^(?:" + P.any_of(rules.name_prefixes) + ")",
        "[" + "".join(P.quote(m) for m in rules.name_marks) + "]",
    ]
    return (
        F.length(line).between(1, rules.name_length)
        & ~is_noise_line(line, rules)
        & ~line.rlike("|".join(barred))
    )


def is_comment_text(line: Column, rules: LineRules = DEFAULT) -> Column:
    """Right length, in the expected script, no noise, three useful characters."""
    low, high = rules.content_length
    useful = F.length(F.regexp_replace(line, r"[^\p{L}\p{N}]+", ""))
    return (
        F.length(line).between(low, high)
        & line.rlike(rules.script)
        & ~is_noise_line(line, rules)
        & (useful >= 3)
    )


def split_at_colon(line: Column, rules: LineRules = DEFAULT) -> Column:
    """``struct<user,content>`` of a ``name: text`` line, null if either part fails."""
    wide, plain = rules.colons
    mark = F.when(line.contains(wide), wide).when(line.contains(plain), plain)
    at = F.instr(line, wide)
    at = F.when(at > 0, at).otherwise(F.instr(line, plain))
    user = F.trim(F.substring(line, F.lit(1), at - 1))
    content = F.trim(F.substring(line, at + 1, F.length(line)))
    fits = mark.isNotNull() & looks_like_name(user, rules) & is_comment_text(content, rules)
    return F.when(fits, F.struct(user.alias("user"), content.alias("content")))


def repeats_post(content: Column, post: Column) -> Column:
    """The comment repeats the post: either contains the other or its first 20 characters."""
    whole = post.contains(content) | content.contains(post)
    head = (F.length(content) >= 20) & post.contains(F.substring(content, 1, 20))
    post_head = (F.length(post) >= 20) & content.contains(F.substring(post, 1, 20))
    both = (F.coalesce(content, F.lit("")) != "") & (F.coalesce(post, F.lit("")) != "")
    return F.coalesce(both & (whole | head | post_head), F.lit(False))


def shown_count(line: Column, rules: LineRules = DEFAULT) -> Column:
    """Like count on a line of its own, null where the line shows none."""
    counts = (
        line.rlike(rules.count_pattern)
        & ~line.isin(list(rules.like_buttons))
        & ~is_time_line(line, rules)
    )
    return F.when(counts, like_count(line))


def term_count(text: Column, terms) -> Column:
    """How many of the listed terms a text contains; a repeated term counts again."""
    total = F.lit(0)
    for term in terms:
        total = total + text.contains(term).cast("int")
    return total


def relevance(
    shown: Column, countries=V.COUNTRY_TERMS, conflicts=V.CONFLICT_TERMS
) -> Column:
    """Weighted count of the listed terms in a text with normalized blanks."""
    return term_count(shown, countries) * V.COUNTRY_TERM_WEIGHT + term_count(
        shown, conflicts
    ) * F.lit(V.CONFLICT_TERM_WEIGHT)


def is_relevant(
    shown: Column,
    countries=V.COUNTRY_TERMS,
    conflicts=V.CONFLICT_TERMS,
    pairs=V.RELEVANT_PAIRS,
    least: int = V.RELEVANT_SCORE,
) -> Column:
    """Score high enough, or both words of a listed pair; blank texts never are."""
    fits = relevance(shown, countries, conflicts) >= least
    for one, two in pairs:
        fits = fits | (shown.contains(one) & shown.contains(two))
    return (shown != "") & fits


def is_widget_comment(text: Column, phrases=V.UI_WIDGET_PHRASES) -> Column:
    """Page text kept as a comment: 8 to 2000 characters shown, no page phrase."""
    return F.length(text).between(8, 2000) & ~text.rlike(P.any_of(phrases))
