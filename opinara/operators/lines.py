"""Comments from visible page lines.

Two forms hold a comment: ``name: text`` on one line, or a name line followed
by a text line. Time and like count stand on one of the next lines.

A page that arrives as one body is read inside its row, without any shuffle.
Line tables use windows that look ahead a bounded number of lines; these are cut
into chunks of consecutive lines plus a margin, so a page that holds a third
of all lines is still spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import lines as L
from ..functions import patterns as P
from ..functions.text import normalize_space
from .columns import exploded
from .rows import cap_per_group, cap_total, first_rows

TIME_REACH = 5
COUNT_REACH = 9
CHUNK_LINES = 4096
NUMBER_CHUNK = 1 << 20


def body_lines(body: Column) -> Column:
    """Cleaned non-empty lines of a page body, in order."""
    parts = F.split(F.coalesce(body, F.lit("")), P.LINE_BREAK)
    return F.filter(F.transform(parts, normalize_space), lambda x: x != "")


def page_lines(pages: DataFrame, page: str, body: str) -> DataFrame:
    """``(page, line_no, line)`` with kept lines numbered from 0."""
    return exploded(pages, [page], body_lines(F.col(body)), "line_no", "line")


def renumber_lines(lines: DataFrame, page: str, line_no: str, line: str) -> DataFrame:
    """Cleaned non-empty lines of a line table with gap-free numbers per page.

    Lines are ranked inside chunks of the old numbers and shifted by the count
    of all earlier chunks, so no task has to rank a whole page.
    """
    kept = lines.select(
        page,
        F.floor(F.col(line_no) / NUMBER_CHUNK).alias("_chunk"),
        F.col(line_no).alias("_old"),
        normalize_space(F.col(line)).alias("line"),
    ).where(F.col("line") != "")
    before = Window.partitionBy(page).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        kept.groupBy(page, "_chunk")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    rank = F.row_number().over(Window.partitionBy(page, "_chunk").orderBy("_old"))
    return (
        kept.withColumn("_rank", rank)
        .join(offsets, [page, "_chunk"])
        .select(page, (F.col("_offset") + F.col("_rank") - 1).alias("line_no"), "line")
    )


def with_lookahead(
    lines: DataFrame,
    page: str,
    line_no: str,
    found: Mapping[str, tuple[Column, int, int]],
    chunk: int = CHUNK_LINES,
) -> DataFrame:
    """For each entry ``name: (value, first, last)`` the first non-null value
    among the lines ``first`` to ``last`` after the current one.

    Line numbers must be gap-free per page. The first lines of every chunk are
    copied to the chunk before it as a margin and dropped after the windows.
    """
    reach = max(last for _, _, last in found.values())
    own = F.floor(F.col(line_no) / chunk)
    shared = (F.pmod(F.col(line_no), F.lit(chunk)) < reach) & (own > 0)
    values = {f"_v_{name}": value for name, (value, _, _) in found.items()}
    copies = (
        lines.withColumns(values)
        .withColumn("_own", own)
        .withColumn("_chunk", F.explode(F.when(shared, F.array(own, own - 1)).otherwise(F.array(own))))
    )
    order = Window.partitionBy(page, "_chunk").orderBy(line_no)
    picked = {
        name: F.first(f"_v_{name}", ignorenulls=True).over(order.rowsBetween(first, last))
        for name, (_, first, last) in found.items()
    }
    return (
        copies.withColumns(picked)
        .where(F.col("_chunk") == F.col("_own"))
        .drop("_own", "_chunk", *values)
    )


def next_match(
    lines: DataFrame, page: str, line_no: str, line: str, match: Column, reach: int = TIME_REACH
) -> DataFrame:
    """Adds ``next_match``: the next line within ``reach`` that fulfils ``match``."""
    value = F.when(match, F.col(line))
    return with_lookahead(lines, page, line_no, {"next_match": (value, 1, reach)})


def next_value(
    lines: DataFrame, page: str, line_no: str, value: Column, reach: int = COUNT_REACH
) -> DataFrame:
    """Adds ``next_value``: the next non-null value within ``reach`` lines, else 0."""
    out = with_lookahead(lines, page, line_no, {"next_value": (value, 1, reach)})
    return out.withColumn("next_value", F.coalesce("next_value", F.lit(0)))


def _candidate(form: int, user: Column, content: Column, time: Column, count: Column) -> Column:
    return F.struct(
        F.lit(form).alias("form"),
        user.alias("user_name"),
        content.alias("content"),
        F.coalesce(time, F.lit("")).alias("publish_time"),
        F.coalesce(count, F.lit(0).cast("long")).alias("like_count"),
    )


#: Parts into which the candidates of a page are dealt for the join with its post.
PAGE_SALTS = 16
CANDIDATE_FIELDS = ("form", "user_name", "content", "publish_time", "like_count")


def candidates_from_lines(
    lines: DataFrame, page: str, rules: L.LineRules = L.DEFAULT
) -> DataFrame:
    """Comment candidates of a gap-free line table ``(page, line_no, line)``."""
    line = F.col("line")
    time = F.when(L.names_time(line, rules), line)
    count = L.shown_count(line, rules)
    ahead = with_lookahead(
        lines,
        page,
        "line_no",
        {
            "_next": (line, 1, 1),
            "_time_1": (time, 1, TIME_REACH),
            "_time_2": (time, 2, TIME_REACH + 1),
            "_count_1": (count, 1, COUNT_REACH),
            "_count_2": (count, 2, COUNT_REACH + 1),
        },
    )
    pair = L.split_at_colon(line, rules)
    one = F.when(
        pair.isNotNull(),
        _candidate(1, pair["user"], pair["content"], F.col("_time_1"), F.col("_count_1")),
    )
    two = F.when(
        L.looks_like_name(line, rules) & L.is_comment_text(F.col("_next"), rules),
        _candidate(2, line, F.col("_next"), F.col("_time_2"), F.col("_count_2")),
    )
    found = exploded(ahead, [page, "line_no"], F.array_compact(F.array(one, two)), "_c")
    return found.select(page, "line_no", *[F.col("_c")[f].alias(f) for f in CANDIDATE_FIELDS])


def _in_row_candidates(lines: Column, rules: L.LineRules) -> Column:
    """The same candidates from the line array of one page body."""

    def facts(line: Column) -> Column:
        return F.struct(
            line.alias("line"),
            F.when(L.names_time(line, rules), line).alias("time"),
            L.shown_count(line, rules).alias("count"),
            L.looks_like_name(line, rules).alias("name"),
            L.is_comment_text(line, rules).alias("text"),
            L.split_at_colon(line, rules).alias("pair"),
        )

    def first_of(known: Column, start: Column, length: int, field: str) -> Column:
        near = F.transform(F.slice(known, start, F.lit(length)), lambda k: k[field])
        return F.get(F.array_compact(near), F.lit(0))

    def at_line(known: Column) -> Callable[[Column, Column], Column]:
        def build(fact: Column, i: Column) -> Column:
            after = F.get(known, i + 1)
            one = F.when(
                fact["pair"].isNotNull(),
                _candidate(
                    1,
                    fact["pair"]["user"],
                    fact["pair"]["content"],
                    first_of(known, i + 2, TIME_REACH, "time"),
                    first_of(known, i + 2, COUNT_REACH, "count"),
                ),
            )
            two = F.when(
                fact["name"] & F.coalesce(after["text"], F.lit(False)),
                _candidate(
                    2,
                    fact["line"],
                    after["line"],
                    first_of(known, i + 3, TIME_REACH, "time"),
                    first_of(known, i + 3, COUNT_REACH, "count"),
                ),
            )
            both = F.array_compact(F.array(one, two))
            return F.transform(both, lambda c: F.struct(i.cast("long").alias("line_no"), c.alias("c")))

        return build

    # The outer one-element transform binds the facts once per page.
    per_page = F.transform(
        F.array(F.transform(lines, facts)), lambda known: F.flatten(F.transform(known, at_line(known)))
    )
    return F.flatten(per_page)


def candidates_from_bodies(
    pages: DataFrame, page: str, body: str, rules: L.LineRules = L.DEFAULT, visit: str | None = None
) -> DataFrame:
    """Comment candidates of whole page bodies, read row by row without a shuffle.

    A page may have several bodies, one for each time that it was read; ``visit`` orders them. Its lines are
    then the runs of lines of its bodies one after the other, and ``line_no`` is the pair of the visit and the
    line of that body: pairs sort as the numbers of one long page would, without counting the lines
    of other rows. No comment spans two bodies.
    """
    own = [page] if visit is None else [page, visit]
    found = exploded(pages, own, _in_row_candidates(body_lines(F.col(body)), rules), "_f")
    line = F.col("_f.line_no")
    place = line if visit is None else F.struct(F.col(visit).alias("visit"), line.alias("line"))
    return found.select(page, place.alias("line_no"), *[F.col("_f.c")[f].alias(f) for f in CANDIDATE_FIELDS])


def first_texts(candidates: DataFrame, page: str) -> DataFrame:
    """First appearance of each text on a page; repeats are cut before the shuffle."""
    return first_rows(candidates, [page, "content"], ["line_no", "form"])


def not_from_post(candidates: DataFrame, posts: DataFrame, page: str, post_content: str) -> DataFrame:
    """Candidates with the other columns of their post, without repeats of its text.

    Posts have one row per address; candidates of a page without a post go. A page's
    candidates are dealt over ``PAGE_SALTS`` parts by their text and its post is copied to each part,
    so a page that holds a third of all candidates is not one task.
    """
    part = F.pmod(F.xxhash64("content"), F.lit(PAGE_SALTS)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(PAGE_SALTS - 1))).alias("_part")
    texts = posts.withColumn("_post", normalize_space(F.col(post_content))).drop(post_content).select("*", copies)
    joined = candidates.withColumn("_part", part).join(texts, [page, "_part"])
    return joined.where(~L.repeats_post(F.col("content"), F.col("_post"))).drop("_post", "_part")


def first_of_page(candidates: DataFrame, page: str, limit: int = V.MAX_COMMENTS_PER_ITEM) -> DataFrame:
    """The first ``limit`` rows of each page."""
    return cap_per_group(candidates, [page], ["line_no", "form"], limit)


def page_comments(
    candidates: DataFrame, posts: DataFrame, page: str, post_content: str, limit: int = V.MAX_COMMENTS_PER_ITEM
) -> DataFrame:
    """The first ``limit`` texts of a page, each once, that don't repeat its post.

    Whether a text repeats the post depends on the text alone, so repeats go first.
    """
    return first_of_page(not_from_post(first_texts(candidates, page), posts, page, post_content), page, limit)


def run_comments(
    comments: DataFrame, post_order: str, total: int = V.MAX_COMMENTS_PER_RUN
) -> DataFrame:
    """First appearance of each text over all posts, then the first ``total`` of the run."""
    order = [post_order, "line_no", "form"]
    return cap_total(first_rows(comments, ["content"], order), order, total)
