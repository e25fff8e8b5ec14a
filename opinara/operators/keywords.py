"""Token statistics.

Words are counted first, with map-side combine, and filtered afterwards: the
filters depend on the word alone, so they run once per distinct word instead of
once per token, and a very frequent word costs one partial count per task.
``computed_once`` keeps the optimizer from moving them below the counts again.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import pairs as B
from ..functions import patterns as P
from ..session import clear_path, work_path
from .columns import computed_once, exploded
from .membership import BROADCAST_ROWS, fits_broadcast, with_weight, without_words


def token_counts(df: DataFrame, tokens: str = "tokens", by: Iterable[str] = ()) -> DataFrame:
    """``(by, word, n)``: trimmed lower-case tokens of two characters or more.

    ``tokens`` should be a stored column or one made by ``computed_once``.
    """
    by = list(by)
    rows = df.select(*by, F.explode(tokens).alias("_token"))
    words = rows.select(*by, F.lower(F.trim("_token")).alias("_word"))
    counts = words.groupBy(*by, "_word").agg(F.count(F.lit(1)).alias("n"))
    named = computed_once(counts, "word", F.col("_word")).drop("_word")
    return named.where(F.length("word") > 1).select(*by, "word", "n")


def is_keyword_shape(word: Column) -> Column:
    """No numbers, no model codes, no one- or two-letter Latin words."""
    return ~word.rlike("^[0-9]+[a-z0-9]*$") & ~word.rlike("^[a-z]{1,2}$")


def keyword_weights(
    df: DataFrame,
    entity: Iterable[str] = V.ENTITY_WORDS,
    vague: Iterable[str] = V.VAGUE_WORDS,
    boost: Iterable[str] = V.BOOST_WORDS,
    boost_weight: float = V.BOOST_WEIGHT,
    tokens: str = "tokens",
) -> DataFrame:
    """``(keyword, weight)``: token count times the weight of the word."""
    counts = token_counts(df, tokens).where(is_keyword_shape(F.col("word")))
    kept = without_words(without_words(counts, "word", entity), "word", vague)
    weighted = with_weight(kept, "word", {w: boost_weight for w in boost}, V.PLAIN_WEIGHT)
    return weighted.select(
        F.col("word").alias("keyword"), (F.col("n") * F.col("weight")).alias("weight")
    )


def top_keywords(weights: DataFrame, n: int = 30) -> DataFrame:
    """Heaviest keywords, ties by the word."""
    return weights.orderBy(F.desc("weight"), "keyword").limit(n)


@lru_cache(maxsize=1)
def _other_digits() -> str:
    """Digit characters outside the decimal class (superscripts, circled digits)."""
    chars = (chr(c) for c in range(0x110000))
    return "".join(ch for ch in chars if ch.isdigit() and not ch.isdecimal())


def is_number_word(word: Column) -> Column:
    return word.rlike(rf"^[\p{{Nd}}{_other_digits()}]+$")


def word_frequencies(
    df: DataFrame,
    stopwords: Iterable[str] | DataFrame,
    least: int = 3,
    tokens: str = "tokens",
) -> DataFrame:
    """``(word, freq)`` of words seen at least ``least`` times, without listed words."""
    counts = token_counts(df, tokens).where((F.col("n") >= least) & ~is_number_word(F.col("word")))
    return without_words(counts, "word", stopwords).select("word", F.col("n").alias("freq"))


def top_words(frequencies: DataFrame, n: int = 120) -> DataFrame:
    return frequencies.orderBy(F.desc("freq"), "word").limit(n)


def phrase_match(text: Column, phrases: Iterable[str] = V.STANCE_PHRASES) -> Column:
    """The text contains one of the phrases, upper and lower case alike; null is no match."""
    return F.coalesce(text.rlike("(?iu)" + P.any_of(phrases)), F.lit(False))


def match_share(df: DataFrame, match: Column) -> DataFrame:
    """One row: matching rows, all rows and the share."""
    hit = F.coalesce(match, F.lit(False)).cast("int")
    return df.agg(
        F.coalesce(F.sum(hit), F.lit(0)).alias("matches"),
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.avg(hit), F.lit(0.0)).alias("share"),
    )


def word_frequency_by(df: DataFrame, by: Iterable[str], tokens: str = "tokens") -> DataFrame:
    """Word counts per platform, day or any other columns."""
    return token_counts(df, tokens, by).withColumnRenamed("n", "freq")


#: Words up to which each task gets all of them, or a number for each; their bytes, and pairs that a task adds up or lays out.
PASSED_WORDS = 1 << 23
PASSED_BYTES = 1 << 28
PART_PAIRS = 1 << 22
PARTS = 1 << 15


def neighbour_pairs(df: DataFrame, window: int = 5, tokens: str = "tokens") -> DataFrame:
    """``(one, two, weight)``: how often two different words stand less than ``window`` apart.

    A text of ``n`` tokens gives at most ``n * (window - 1)`` pairs. The tokens are written once and their words counted; up to
    ``PASSED_WORDS`` of them get numbers, and each task sorts and counts its pairs as numbers. Tasks send their counts as bytes,
    dealt by a digest of the pair. More words are counted as text, with map-side combine.
    """
    spark, path, listed = df.sparkSession, work_path(df.sparkSession, "tokens"), work_path(df.sparkSession, "words")
    step, size = B.ROW_TOKENS, F.greatest(F.size(tokens), F.lit(1))
    parts = F.transform(F.sequence(F.lit(1), size, F.lit(step)), lambda first: F.slice(tokens, first, F.lit(step + window - 1)))
    exploded(df, [], parts, "tokens").write.parquet(path)
    rows = spark.read.parquet(path)
    words = rows.select(F.explode("tokens").alias("name")).where("name IS NOT NULL").groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    words.write.parquet(listed)
    words = spark.read.parquet(listed)
    if not fits_broadcast(words, PASSED_WORDS, PASSED_BYTES):
        return _pairs_as_text(df, window, tokens)
    count = _parts((words.agg(F.sum("n")).first()[0] or 0) * (window - 1))
    names = spark.sparkContext.broadcast(B.joined(words.select("name").orderBy("name").toArrow()["name"]))
    counted = rows.mapInArrow(lambda batches: B.counted(batches, names.value, window, count), "part int, packed binary")
    return counted.repartitionById(count, "part").mapInArrow(lambda batches: B.added(batches, names.value), "one string, two string, weight long")


def _parts(pairs: int) -> int:
    return min(max(1, -(-pairs // PART_PAIRS)), PARTS)


def _pairs_as_text(df: DataFrame, window: int, tokens: str) -> DataFrame:
    words, size = F.col(tokens), F.size(tokens)

    def shifted(o: Column) -> Column:
        length = F.greatest(size - o, F.lit(0))
        return F.zip_with(
            F.slice(words, F.lit(1), length),
            F.slice(words, o + 1, length),
            lambda a, b: F.struct(F.least(a, b).alias("one"), F.greatest(a, b).alias("two")),
        )

    pairs = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(window - 1)), shifted))
    rows = exploded(df, [], pairs, "_p").select("_p.one", "_p.two").where("one <> two")
    return rows.groupBy("one", "two").agg(F.count(F.lit(1)).alias("weight"))


#: Rounds between two tables of ranks, and the largest relative change at which the ranks count as settled.
ROUNDS_A_TABLE = 6
TOLERANCE = 1e-9


class PackedPairs(NamedTuple):
    """Numbered words, ``(name, word)``, how many there are, and the pairs as blocks of numbers; no blocks for no words or too many."""

    words: DataFrame
    count: int
    edges: DataFrame | None


def packed_pairs(pairs: DataFrame) -> PackedPairs:
    """What ``text_rank`` and ``neighbour_shares`` make of stored pairs first; given to both, it is made once."""
    path = work_path(pairs.sparkSession, "split")
    rows = _split_pairs(pairs, path)
    words, count = _numbered(rows)
    fits = count > 0 and fits_broadcast(words, PASSED_WORDS, PASSED_BYTES)
    packed = PackedPairs(words, count, _edges(rows, words) if fits else None)
    clear_path(pairs.sparkSession, path)  # the words and blocks are stored
    return packed


def neighbour_shares(pairs: DataFrame, packed: PackedPairs | None = None) -> DataFrame:
    """``(src, word, share)``: the part of its rank that each word passes to each neighbour, written once.

    Up to ``PASSED_WORDS`` words, all that is shuffled are packed pairs, and the rows of a target word mostly stand together.
    """
    spark, path = pairs.sparkSession, work_path(pairs.sparkSession, "shares")
    words, count, edges = packed or packed_pairs(pairs)
    if edges is not None:
        passed = spark.sparkContext.broadcast((_names(words), _given(edges, np.ones(count))))
        shares = edges.mapInArrow(lambda batches: B.named_shares(batches, *passed.value), "src string, word string, share double")
    else:
        forth = pairs.select(F.col("one").alias("src"), F.col("two").alias("word"), "weight")
        back = pairs.select(F.col("two").alias("src"), F.col("one").alias("word"), "weight")
        rows = forth.union(back)
        sums = rows.groupBy("src").agg(F.sum("weight").alias("_sum"))
        shares = rows.join(sums, "src").select("src", "word", (F.col("weight") / F.col("_sum")).alias("share"))
    shares.write.parquet(path)
    return spark.read.parquet(path)


def given_ranks(shares: DataFrame, ranks: DataFrame) -> DataFrame:
    """``(word, neighbours, given)``: for each word its rows of shares and the sum of share times the rank of the source.

    ``ranks`` has each word once. It is written and measured; up to ``PASSED_WORDS`` words, each task gets them, and sums of a
    few million rows are all that is shuffled.
    """
    spark, path = shares.sparkSession, work_path(shares.sparkSession, "ranks")
    ranks.select("word", "rank").write.parquet(path)
    kept = spark.read.schema("word string, rank double").parquet(path)
    if not fits_broadcast(kept, PASSED_WORDS, PASSED_BYTES):
        joined = shares.join(kept.withColumnRenamed("word", "src"), "src").groupBy("word")
        return joined.agg(F.count(F.lit(1)).alias("neighbours"), F.sum(F.col("share") * F.col("rank")).alias("given"))
    table = kept.toArrow()
    passed = spark.sparkContext.broadcast((B.joined(table["word"]), table["rank"].to_numpy()))
    rows = shares.select("src", "word", "share").mapInArrow(lambda batches: B.passed(batches, *passed.value), "word string, n long, given double")
    return rows.groupBy("word").agg(F.sum("n").alias("neighbours"), F.sum("given").alias("given"))


def largest_residual(shares: DataFrame, ranks: DataFrame, damping: float = 0.85) -> float:
    """How far any rank is from the one that its neighbours give it, relative to it; 0 for no words."""
    again = given_ranks(shares, ranks).select("word", (F.lit(1 - damping) + F.lit(damping) * F.col("given")).alias("_again"))
    far = F.max(F.abs(F.col("_again") - F.col("rank")) / F.col("rank"))
    return again.join(ranks, "word").agg(far.alias("far")).first()["far"] or 0.0


def text_rank(
    pairs: DataFrame, damping: float = 0.85, tolerance: float = TOLERANCE, packed: PackedPairs | None = None
) -> DataFrame:
    """``(word, rank)`` by weighted ranks over neighbouring words, run until they settle.

    Weights are the same in both directions, so the ranks solve a symmetric system, and each round is a step of conjugate
    gradients, which for any graph take no more rounds than plain ones and on texts far fewer. The largest distance from what the
    neighbours give, relative to the rank, tells when they rest; it is computed anew at the end. Words are counted: up to
    ``PASSED_WORDS`` of them, ranks are arrays of one number a word that the tasks get whole, while the pairs stay in
    packed rows of the shared folder and nothing is shuffled in a round; more words have their ranks in tables. No pairs give no ranks.
    """
    if not 0 <= damping < 1 or tolerance <= 0:
        raise ValueError("ranks settle with a damping below 1 and a tolerance above 0")
    packed = packed or packed_pairs(pairs)
    words, count, edges = packed
    if not count:
        return words.select(F.col("name").alias("word"), F.lit(1.0).alias("rank"))
    if edges is None:
        return _ranks_in_tables(pairs, packed, damping, tolerance)
    settled = pairs.sparkSession.sparkContext.broadcast(_settled(edges, count, damping, tolerance))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = settled.value[batch["word"].to_numpy()]
            yield pa.RecordBatch.from_arrays([batch["name"], pa.array(own)], ["word", "rank"])

    return words.mapInArrow(named, "word string, rank double")


def _settled(edges: DataFrame, count: int, damping: float, tolerance: float) -> np.ndarray:
    """The ranks by conjugate gradients; distances are weighed by the sums of the words, in which the system is symmetric."""
    sums = _given(edges, np.ones(count))
    sums[sums == 0] = 1
    ranks = np.ones(count)
    far = lambda left: np.max(np.abs(left) / np.maximum(ranks, 1 - damping))
    while True:
        left = 1 - damping + damping * _given(edges, ranks / sums) - ranks
        if far(left) <= tolerance:
            return ranks
        way, size = left.copy(), np.dot(left, left / sums)
        while far(left) > tolerance / 2:
            bent = way - damping * _given(edges, way / sums)
            step = size / np.dot(way, bent / sums)
            ranks += step * way
            left -= step * bent
            before, size = size, np.dot(left, left / sums)
            way = left + size / before * way


#: Row groups of stored blocks, whose rows are large.
BLOCK_FILES = {"parquet.block.size": str(1 << 24), "parquet.page.size.row.check.min": "1"}


def _split_pairs(pairs: DataFrame, path: str) -> DataFrame:
    """The pairs, read once, as rows of about two million with a word list each, stored at ``path``."""
    weighed = pairs.select("one", "two", F.col("weight").cast("double").alias("weight"))
    weighed.mapInArrow(B.split, B.SPLIT).write.options(**BLOCK_FILES).parquet(path)
    return pairs.sparkSession.read.schema(B.SPLIT).parquet(path)


def numbered_words(pairs: DataFrame) -> tuple[DataFrame, int]:
    """``(name, word)``: the words of the pairs numbered from 0 without gaps, frequent ones first, and how many there are."""
    return _numbered(_split_pairs(pairs, work_path(pairs.sparkSession, "split")))


def _numbered(rows: DataFrame) -> tuple[DataFrame, int]:
    spark, path = rows.sparkSession, work_path(rows.sparkSession, "words")
    seen = rows.select(F.explode(F.arrays_zip("names", "counts")).alias("_w")).groupBy(F.col("_w.names").alias("name"))
    names = seen.agg(F.sum("_w.counts").alias("_n")).orderBy(F.desc("_n"), "name")
    names.select("name", F.monotonically_increasing_id().alias("_id")).write.parquet(path)
    kept = spark.read.schema("name string, _id long").parquet(path).withColumn("_part", F.shiftright("_id", 33))
    sizes = kept.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()  # a row per task
    starts, count = [], 0
    for row in sizes:
        starts.append((row["_part"], count))
        count += row["n"]
    joined = kept.join(F.broadcast(spark.createDataFrame(starts, "_part long, _start long")), "_part")
    return joined.select("name", (F.col("_start") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).alias("word")), count


def _names(words: DataFrame) -> pa.Array:
    """The names of numbered words in the order of their numbers."""
    return B.joined(words.toArrow().sort_by("word")["name"])


def packed_edges(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Both directions of many pairs in a row, as bytes of numbers; those to one word in order and together in one task."""
    return _edges(_split_pairs(pairs, work_path(pairs.sparkSession, "split")), words)


def _edges(rows: DataFrame, words: DataFrame) -> DataFrame:
    spark, path = rows.sparkSession, work_path(rows.sparkSession, "edges")
    ends = rows.agg(F.sum(F.octet_length("one"))).first()[0] or 0  # four bytes for each pair
    names, count = spark.sparkContext.broadcast(_names(words)), _parts(ends // 2)
    dealt = rows.drop("counts").mapInArrow(
        lambda batches: B.directed(batches, names.value, count), "part int, words binary, sources binary, weights binary, kind string"
    )
    dealt.repartitionById(count, "part").mapInArrow(B.laid_out, B.EDGES).write.options(compression="none", **BLOCK_FILES).parquet(path)
    return spark.read.schema(B.EDGES).parquet(path)


def _given(edges: DataFrame, ranks: np.ndarray) -> np.ndarray:
    """For each word the sum over its edges of weight times the number of the source; a number per word and block comes back."""
    passed, out = edges.sparkSession.sparkContext.broadcast(ranks), np.zeros(len(ranks))
    table = edges.mapInArrow(lambda batches: B.summed(batches, passed.value), "words binary, sums binary").toArrow()
    for batch in table.to_batches():
        for words, sums in zip(batch["words"], batch["sums"], strict=True):
            out[B.values_of(words, "i4")] += B.values_of(sums, "f8")  # each word once
    passed.destroy()
    return out


def _ranks_in_tables(pairs: DataFrame, packed: PackedPairs, damping: float, tolerance: float) -> DataFrame:
    """``text_rank`` for any number of words, each round by a join.

    After every few rounds the ranks are written to the shared folder and the largest distance is measured there; a lost
    executor costs those rounds at most, and no plan grows.
    """
    shares = neighbour_shares(pairs, packed)
    spark = shares.sparkSession
    # The rounds join and group by numbers; the words come back at the end.
    names, path = work_path(spark, "words"), work_path(spark, "steps")
    shares.select(F.col("src").alias("name")).distinct().withColumn("word", F.monotonically_increasing_id()).write.parquet(names)
    words = spark.read.parquet(names)
    numbers = lambda side: words.select(F.col("name").alias(side), F.col("word").alias(f"_{side}"))
    numbered = shares.join(numbers("src"), "src").join(numbers("word"), "word")
    # A word's own row, without a share, brings its last ranks along.
    own = words.select(F.col("word").alias("src"), "word", F.lit(None).cast("double").alias("share"))
    numbered.select(F.col("_src").alias("src"), F.col("_word").alias("word"), "share").unionByName(own).write.parquet(path)
    steps = spark.read.parquet(path)
    # The weight of the round is a column, so that all rounds are the same code, which is compiled once.
    ranks = words.select("word", F.lit(1.0).alias("rank"), F.lit(1.0).alias("before"), F.lit(1.0).alias("weight"))
    small = words.count() <= BROADCAST_ROWS
    mine = lambda name: F.max(F.when(F.col("share").isNull(), F.col(name)))
    while True:
        for _ in range(ROUNDS_A_TABLE):
            given = F.lit(1 - damping) + F.lit(damping) * F.sum(F.col("share") * F.col("rank"))
            last = ranks.withColumnRenamed("word", "src")
            rows = steps.join(F.broadcast(last) if small else last, "src").groupBy("word")
            rows = rows.agg(given.alias("_given"), mine("rank").alias("_rank"), mine("before").alias("_before"), mine("weight").alias("_weight"))
            new = F.col("_weight") * (F.col("_given") - F.col("_before")) + F.col("_before")
            far = F.abs(F.col("_given") - F.col("_rank")) / F.col("_rank")
            weight = 1 / (1 - damping**2 * F.col("_weight") / F.when(F.col("_weight") == 1, 2).otherwise(4))
            ranks = rows.select("word", new.alias("rank"), F.col("_rank").alias("before"), weight.alias("weight"), far.alias("far"))
        path = work_path(spark, "ranks")
        ranks.write.parquet(path)
        found = spark.read.parquet(path)
        far = found.agg(F.max("far").alias("far")).first()["far"]
        ranks = found.drop("far")
        if far is None or far <= tolerance:
            return ranks.join(words, "word").select(F.col("name").alias("word"), "rank")
