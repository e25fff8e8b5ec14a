"""Mixing sources to target weights by a curriculum that varies over training time.

Training time runs from 0 to 1. A source's schedule states its weight at some
times, linear in between; its integral is the source's weight in the mix. The
words that a source gives to the mix are asked for at the rate of the schedule,
so the integral up to a time is the demand up to then, and the inverse at a share
of the demand is the time at which that share is used: the training position
of the document whose words make up that share. The mix is the documents, repeated
where their source is taken more than once, sorted by range of position.

Column expressions, windows and joins only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, running_totals, stored

#: Weights of the sources in code point order, repeated.
WEIGHTS = (5.0, 2.0, 1.0)
#: How the weight of a source moves over training time, as (time, factor) with integral 1;
#: in code point order, repeated: steady, rising, falling.
SHAPES = (((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)), ((0.0, 1.5), (1.0, 0.5)))
#: Words that the mix takes, as a share of the words of all documents.
SHARE = 1.5
#: How often the words of a source may be taken.
PASSES = 2
KNOTS = "array<struct<t: double, w: double>>"


def words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def source_key(source: str) -> Column:
    """Never null; an absent source comes after every other in code point order."""
    name = F.col(source).cast("string")
    return F.when(name.isNull(), "1").otherwise(F.concat(F.lit("0"), name))


def measured(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``_id``, ``_source``, ``_size`` and ``_order``, a shuffle that every run repeats."""
    shuffle = F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), 1, 16)
    return docs.select(
        F.col(id_col).alias("_id"), source_key(source_col).alias("_source"), words(F.col(text_col)).alias("_size"), shuffle.alias("_order")
    )


def default_schedules(
    sources: DataFrame, weights: Sequence[float] = WEIGHTS, shapes: Sequence[Sequence[tuple[float, float]]] = SHAPES
) -> DataFrame:
    """Adds ``knots``: weight times shape, both dealt out in code point order of the sources.

    ``sources`` has one row per source of the mix, the size of a configuration.
    """
    place = F.row_number().over(Window.orderBy("_source")) - 1
    shape = F.array(*[F.array(*[F.struct(F.lit(t).alias("t"), F.lit(f).alias("f")) for t, f in s]) for s in shapes])
    weight = F.array(*map(F.lit, weights))
    ranked = sources.withColumn("_place", place)
    ranked = ranked.withColumn("_weight", weight[F.col("_place") % len(weights)])
    knots = F.transform(shape[F.col("_place") % len(shapes)], lambda k: F.struct(k["t"].alias("t"), (k["f"] * F.col("_weight")).alias("w")))
    return ranked.withColumn("knots", knots).drop("_place", "_weight")


def stated_schedules(sources: DataFrame, schedules: Mapping[str | None, Sequence[tuple[float, float]]]) -> DataFrame:
    """Adds ``knots`` from a mapping of source to (time, weight) pairs; an unnamed source weighs nothing."""
    keys = {"1" if name is None else f"0{name}": pairs for name, pairs in schedules.items()}
    rows = [(key, [(float(t), float(w)) for t, w in sorted(pairs)]) for key, pairs in keys.items()]
    table = sources.sparkSession.createDataFrame(rows, f"_source string, knots {KNOTS}")
    nothing = F.array(F.struct(F.lit(0.0).alias("t"), F.lit(0.0).alias("w")), F.struct(F.lit(1.0).alias("t"), F.lit(0.0).alias("w")))
    return sources.join(table, "_source", "left").withColumn("knots", F.coalesce("knots", nothing))


def segments(knots: Column) -> Column:
    """The pieces of a schedule with their area, and the area before each."""
    pairs = F.zip_with(
        F.slice(knots, F.lit(1), F.size(knots) - 1),
        F.slice(knots, F.lit(2), F.size(knots) - 1),
        lambda a, b: F.struct(
            a["t"].alias("t"), (b["t"] - a["t"]).alias("dt"), a["w"].alias("w"), (b["w"] - a["w"]).alias("dw"),
            ((a["w"] + b["w"]) / 2 * (b["t"] - a["t"])).alias("area"),
        ),
    )
    zero = F.lit(0.0)
    before = lambda s, i: F.aggregate(F.slice(s, F.lit(1), i), zero, lambda total, x: total + x["area"])
    return F.transform(
        pairs,
        lambda x, i: F.struct(x["t"].alias("t"), x["dt"].alias("dt"), x["w"].alias("w"), x["dw"].alias("dw"), x["area"].alias("area"), before(pairs, i).alias("before")),
    )


def with_targets(sources: DataFrame, share: float = SHARE, passes: int = PASSES, least: float = 0.0) -> DataFrame:
    """Adds ``weight`` (the integral), ``pieces`` and ``target`` to sources with ``size`` and ``knots``.

    Targets are in proportion to the weights, within ``least`` and ``passes`` times the
    source's size, and sum to ``share`` of all sizes: what a bound takes off one
    source goes to the others by weight until none is outside. That is the level L
    with sum(clamp(L * weight)) = total. The sum is linear between the levels at
    which some source reaches a bound, so one sorted pass over these finds L.
    """
    pieces = sources.withColumn("pieces", segments(F.col("knots"))).drop("knots")
    rows = pieces.withColumn("weight", F.aggregate("pieces", F.lit(0.0), lambda total, x: total + x["area"]))
    rows = rows.withColumn("_low", F.col("size") * F.lit(float(least))).withColumn("_high", F.col("size") * F.lit(float(passes)))
    turn = lambda at, slope, base: F.struct((F.col(at) / F.col("weight")).alias("at"), slope.alias("slope"), base.alias("base"))
    turns = rows.filter("weight > 0").select(
        F.inline(F.array(turn("_low", F.col("weight"), -F.col("_low")), turn("_high", -F.col("weight"), F.col("_high"))))
    )
    turns = turns.groupBy("at").agg(F.sum("slope").alias("slope"), F.sum("base").alias("base"))
    upto = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.agg(F.sum("_low").alias("lows"), (F.sum("size") * F.lit(float(share))).alias("total"))
    lines = turns.select("at", F.sum("slope").over(upto).alias("slope"), F.sum("base").over(upto).alias("base")).crossJoin(F.broadcast(sums))
    lines = lines.withColumn("base", F.col("base") + F.col("lows")).filter(F.col("base") + F.col("slope") * F.col("at") <= F.col("total"))
    top = F.max_by(F.struct("at", "slope", "base", "total"), "at")
    level = lines.agg(top.alias("x")).select(
        F.coalesce(F.when(F.col("x.slope") > 0, (F.col("x.total") - F.col("x.base")) / F.col("x.slope")).otherwise(F.col("x.at")), F.lit(0.0)).alias("_level")
    )
    target = F.least(F.greatest(F.col("_level") * F.col("weight"), F.col("_low")), F.col("_high"))
    return rows.crossJoin(F.broadcast(level)).withColumn("target", target).drop("_level", "_low", "_high")


def time_of(share: Column, pieces: Column, weight: Column) -> Column:
    """The time by which a share of the schedule's area is used up."""
    area = share * weight
    piece = F.element_at(F.filter(pieces, lambda x: (x["before"] <= area) & (x["area"] > 0)), -1)
    rest = area - piece["before"]
    step = 2 * rest / (piece["w"] + F.sqrt(F.greatest(piece["w"] * piece["w"] + 2 * rest * piece["dw"] / piece["dt"], F.lit(0.0))))
    return piece["t"] + F.coalesce(F.when(rest > 0, F.least(step, piece["dt"])), F.lit(0.0))


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    schedules: Mapping[str | None, Sequence[tuple[float, float]]] | None = None,
    share: float = SHARE, passes: int = PASSES, least: float = 0.0,
) -> DataFrame:
    """One row per row of ``docs``: id, ``size``, ``source_size``, ``target``, ``taken``, ``positions``.

    A source is passed over in the same shuffled order until its target is met; a
    document is taken in a pass if its middle is before the target, so the words
    taken differ from the target by half a document at most. ``positions`` are the training
    times (0 to 1) of its copies, empty if it is not taken. Without ``schedules`` the
    defaults apply. Null text has size 0, null sources are a source of their own,
    a null id is shuffled as ''. Rows that repeat are taken one by one. A source
    without words has target 0; with ``least`` of 1 or more its rows have the position 0.0 once.
    Other columns are left out. An empty table gives none.
    """
    sizes = stored(measured(docs, id_col, text_col, source_col), "sizes")
    sources = sizes.groupBy("_source").agg(F.sum("_size").alias("size"))
    planned = default_schedules(sources) if schedules is None else stated_schedules(sources, schedules)
    planned = with_targets(planned, share, passes, least).withColumnRenamed("size", "source_size")
    placed = running_totals(sizes, ["_source"], ["_order", "_id", "_size"], "_size", "_before")
    rows = placed.join(planned, "_source")
    middle = lambda turn: turn * F.col("source_size") + F.col("_before") + F.col("_size") / 2
    turns = F.filter(F.sequence(F.lit(0), F.lit(passes - 1)), lambda turn: (middle(turn) <= F.col("target")) & (F.col("target") > 0))
    rows = rows.withColumn("_turns", turns)
    times = F.transform("_turns", lambda turn: time_of(middle(turn) / F.col("target"), F.col("pieces"), F.col("weight")))
    if least >= 1:
        times = F.when(F.col("source_size") == 0, F.array(F.lit(0.0))).otherwise(times)
    return rows.select(
        F.col("_id").alias(id_col), F.col("_size").alias("size"), "source_size", "target",
        (F.size("_turns") * F.col("_size")).cast("long").alias("taken"), times.alias("positions"),
    )


def training_order(docs: DataFrame, plan: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` in training order, as often as ``plan`` takes them, with their own columns.

    Rows that share an id (null is one) can't be told apart in the plan: each of them appears as
    often as the one of them that is taken most.
    """
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("\x00"))
    most = F.max_by("positions", F.struct(F.size("positions"), "positions"))
    wanted = plan.select(key.alias("_key"), "positions").groupBy("_key").agg(most.alias("_positions"))
    wanted = wanted.select("_key", F.explode("_positions").alias("_position"))
    rows = docs.select(F.struct("*").alias("_doc"), key.alias("_key")).join(wanted, "_key")
    return rows.orderBy("_position", "_key").select("_doc.*")
