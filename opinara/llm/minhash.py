"""Near duplicates by b-bit MinHash.

A document is the set of its distinct shingles. Each of ``HASHES`` permutations
gives the minimum over the set. Bands of full minima find candidates; of each
minimum only the low ``BITS`` bits are kept, packed into longs, and the number of
unequal groups of bits gives the similarity estimate, corrected for groups that
agree by chance. Candidates whose estimate is within reach of the threshold are
confirmed on the full sets.

Documents with equal sets are one class from the start. Within a bucket the classes
are compared with one pivot, not with each other; only classes that are not in the
pivot's component afterwards are compared with the rest of the bucket, in pairs of blocks:
first by their bits, and those that meet a similar one there by their full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, id_or_last, id_or_null, salted_lookup, stored
from .components import components
from .text_hashes import BLOCK_BYTES, FACTORS, LOWER, block_word_hashes, mixed, word_hashes

#: Words of a shingle and the least similarity of a link, in percent.
SHINGLE = 5
PERCENT = 80
#: Bands of rows; a link of similarity 0.8 is missed by all bands with probability 7e-5, one of 0.85 with 8e-7.
BANDS = 24
ROWS = 5
HASHES = BANDS * ROWS
#: Low bits that are kept of a minimum, and minima packed into one long.
BITS = 4
PER_LONG = 15
LONGS = HASHES // PER_LONG
#: Estimates this far below the threshold are still confirmed: about five standard errors.
SLACK = 0.19
#: Shingles hashed at once.
BLOCK_SHINGLES = 1 << 16
#: Parts into which the rows of one class or component are dealt.
SALTS = 64
#: Members of a bucket that are compared in one go.
BLOCK = 512

_RNG = np.random.default_rng(21)
TIMES = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
PLUS = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32)
BAND_FACTORS = _RNG.integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
BAND_SEEDS = _RNG.integers(1, 1 << 63, BANDS, dtype=np.uint64)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles; a shorter text is one shingle."""
    if not len(words):
        return words
    width = min(width, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        total = total + words[k : len(words) - width + 1 + k] * FACTORS[1 + k % 7] * np.uint64(2 * (k // 7) + 1)
    return np.unique(mixed(total))


def text_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The shingle set of each text; many short texts are hashed in one block."""
    start = 0
    while start < len(texts):
        raw: list[bytes] = []
        held = 0
        while start + len(raw) < len(texts) and (not raw or held < BLOCK_BYTES):
            raw.append((texts[start + len(raw)].as_py() or "").encode())
            held += len(raw[-1]) + 1
        start += len(raw)
        if len(raw) == 1:
            yield shingles(word_hashes(np.frombuffer(raw[0], np.uint8), LOWER), width)
            continue
        at, words = block_word_hashes(np.frombuffer(b"\n".join(raw), np.uint8), LOWER)
        ends = np.searchsorted(at, np.cumsum([len(x) + 1 for x in raw]))
        for a, b in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True):
            yield shingles(words[a:b], width)


def set_key(items: np.ndarray) -> bytes:
    """128 bits for equality of sets."""
    return hashlib.blake2b(items.tobytes(), digest_size=16).digest()


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """Minimum of each set under each permutation; sets must not be empty."""
    out = np.empty((len(sets), HASHES), np.uint32)
    for row, items in enumerate(sets):
        if len(items) > BLOCK_SHINGLES:
            parts = [items[i : i + BLOCK_SHINGLES] for i in range(0, len(items), BLOCK_SHINGLES)]
            out[row] = minima(parts).min(axis=0)
    at = 0
    small = [i for i, items in enumerate(sets) if len(items) <= BLOCK_SHINGLES]
    while at < len(small):
        end, held = at, 0
        while end < len(small) and (end == at or held + len(sets[small[end]]) <= BLOCK_SHINGLES):
            held += len(sets[small[end]])
            end += 1
        block = small[at:end]
        joined = (np.concatenate([sets[i] for i in block]) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum([0, *(len(sets[i]) for i in block[:-1])])
        for k in range(HASHES):
            out[block, k] = np.minimum.reduceat(joined * TIMES[k] + PLUS[k], starts)
        at = end
    return out


def band_keys(low: np.ndarray) -> np.ndarray:
    """A 64-bit key per document and band."""
    rows = low.reshape(len(low), BANDS, ROWS).astype(np.uint64)
    return mixed((mixed(rows + np.uint64(1)) * BAND_FACTORS).sum(axis=2, dtype=np.uint64) + BAND_SEEDS).view(np.int64)


def packed_bits(low: np.ndarray) -> np.ndarray:
    """The low bits of the minima, ``PER_LONG`` of them in each of ``LONGS`` numbers."""
    bits = (low & np.uint32((1 << BITS) - 1)).astype(np.int64).reshape(len(low), LONGS, PER_LONG)
    return (bits << (BITS * np.arange(PER_LONG, dtype=np.int64))).sum(axis=2)


SIGNED = "_id long, _text1 long, _text2 long, n_shingles long, set_key binary, bits array<long>, bands array<long>"


def text_marks(text: Column) -> list[Column]:
    """128 bits that tell the text of a row."""
    return [F.xxhash64(text).alias("_text1"), F.xxhash64(F.lit(1), text).alias("_text2")]


def signatures(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """The set size, set key, packed bits and band keys of every row; null ones for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.select(["_id", "_text1", "_text2"])
            held: list[np.ndarray] = []
            size = start = 0
            for items in text_sets(batch["_text"], width):
                held.append(items)
                size += len(items)
                if size >= 8 * BLOCK_SHINGLES:
                    yield signed(rows.slice(start, len(held)), held)
                    start, held, size = start + len(held), [], 0
            if held:
                yield signed(rows.slice(start, len(held)), held)

    chosen = docs.select(id_or_last(id_col).alias("_id"), *text_marks(F.col(text_col)), F.col(text_col).alias("_text"))
    return chosen.mapInArrow(run, SIGNED)


def signed(rows: pa.RecordBatch, sets: list[np.ndarray]) -> pa.RecordBatch:
    full = [i for i, items in enumerate(sets) if len(items)]
    bits: list[list[int] | None] = [None] * len(sets)
    bands: list[list[int] | None] = [None] * len(sets)
    keys: list[bytes | None] = [None] * len(sets)
    if full:
        low = minima([sets[i] for i in full])
        for i, b, k in zip(full, packed_bits(low).tolist(), band_keys(low).tolist(), strict=True):
            bits[i], bands[i], keys[i] = b, k, set_key(sets[i])
    longs = pa.list_(pa.int64())
    added = {
        "n_shingles": pa.array([len(items) for items in sets], pa.int64()), "set_key": pa.array(keys, pa.binary()),
        "bits": pa.array(bits, longs), "bands": pa.array(bands, longs),
    }
    return pa.RecordBatch.from_arrays([*rows.columns, *added.values()], [*rows.schema.names, *added])


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """``set_key`` and ``items`` of every row of (``_id``, ``_text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for items in text_sets(batch.column(1), width):
                lists = pa.ListArray.from_arrays(pa.array([0, len(items)], pa.int32()), pa.array(items.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array([set_key(items)], pa.binary()), lists], ["set_key", "items"])

    return docs.mapInArrow(run, "set_key binary, items array<long>")


def estimate(a: str, b: str) -> Column:
    """Similarity from the bits that agree, corrected for those that agree by chance."""
    ones = F.lit(0)
    for k in range(LONGS):
        unequal = F.col(f"{a}bits")[k].bitwiseXOR(F.col(f"{b}bits")[k])
        each = unequal
        for shift in range(1, BITS):
            each = each.bitwiseOR(F.shiftright(unequal, shift))
        once = sum(1 << (BITS * i) for i in range(PER_LONG))
        ones = ones + F.bit_count(each.bitwiseAND(F.lit(once).cast("long")))
    chance = 1 / (1 << BITS)
    return (1 - ones / HASHES - chance) / (1 - chance)


def near(a: str, b: str, percent: float) -> Column:
    """Whether two classes can be linked, by their set sizes and the estimate."""
    small, large = F.least(f"{a}n", f"{b}n"), F.greatest(f"{a}n", f"{b}n")
    return (100 * small >= percent * large) & (estimate(a, b) >= percent / 100 - SLACK)


def prefixed(classes: DataFrame, side: str) -> DataFrame:
    return classes.select(F.col("node").alias(side), F.col("n").alias(f"{side}n"), F.col("bits").alias(f"{side}bits"))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: float) -> DataFrame:
    """The pairs (``u``, ``v``) whose full sets are similar enough."""
    rows = pairs.join(sets.select(F.col("node").alias("u"), F.col("items").alias("_u")), "u")
    rows = rows.join(sets.select(F.col("node").alias("v"), F.col("items").alias("_v")), "v")
    common = F.size(F.array_intersect("_u", "_v"))
    rows = rows.select("u", "v", common.alias("c"), (F.size("_u") + F.size("_v")).alias("s"))
    return rows.filter(100 * F.col("c") >= percent * (F.col("s") - F.col("c"))).select("u", "v")


def open_members(stars: DataFrame, roots: DataFrame, classes: DataFrame) -> DataFrame:
    """The members of the buckets in which some are not in the pivot's component, dealt as pairs of blocks.

    Two members of different components are compared where they share their first bucket; at
    least one of them is ``outside`` the component of the pivot there.
    """
    labels = roots.select("node", "root")
    members = stars.filter("node <> pivot").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mains = labels.select(F.col("node").alias("pivot"), F.col("root").alias("main"))
    members = members.join(mains, "pivot", "left")
    members = members.select("key", "node", "root", (F.col("root") != F.coalesce("main", "pivot")).alias("outside"))
    # The pivot itself has been compared with all; two others are needed, one of them outside.
    open_keys = members.groupBy("key").agg(F.count("*").alias("_n"), F.max(F.col("outside").cast("int")).alias("_out"))
    open_keys = open_keys.filter("_n > 1 AND _out = 1").select("key", F.ceil(F.col("_n") / BLOCK).cast("int").alias("blocks"))
    members = members.join(open_keys, "key").join(classes.select("node", "n", "bits", "bands"), "node")
    members = members.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    members = members.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    part = F.least("block", "_other").cast("long") * F.col("blocks") + F.greatest("block", "_other")
    return members.withColumn("part", part).select(*(field.split(" ")[0] for field in MEMBER.split(", ")))


#: A member of a part.
MEMBER = "key long, part long, blocks int, block int, node long, root long, outside boolean, n long, bits array<long>, bands array<long>"


class Part:
    """The members of one pair of blocks of a bucket."""

    def __init__(self, key: tuple, group: pa.Table, percent: float) -> None:
        self.key, self.part, self.blocks = (k.as_py() for k in key)
        self.percent = percent
        self.nodes, self.outside, self.block, self.sizes = (group[c].to_numpy() for c in ("node", "outside", "block", "n"))
        self.roots = group["root"].to_numpy().copy()
        self.bits, self.bands = (group[c].combine_chunks().flatten().to_numpy().reshape(len(group), -1) for c in ("bits", "bands"))

    def similar(self, x: int) -> np.ndarray:
        """The members of other components that may be linked with the outside member ``x`` and that meet it here."""
        small, large = np.minimum(self.sizes, self.sizes[x]), np.maximum(self.sizes, self.sizes[x])
        fit = (self.roots != self.roots[x]) & (100 * small >= self.percent * large)
        fit &= ~self.outside | (np.arange(len(self.nodes)) > x)
        if self.part // self.blocks != self.part % self.blocks:
            fit &= self.block != self.block[x]
        at = np.flatnonzero(fit)
        at = at[estimates(self.bits[at], self.bits[x]) >= self.percent / 100 - SLACK]
        same = self.bands[at] == self.bands[x]
        return at[self.bands[x][same.argmax(axis=1)] == self.key]


def suspected(percent: float):
    """The members of a part that may be linked with another of it."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        part = Part(key, group.sort_by("node"), percent)
        hit = np.zeros(len(part.nodes), bool)
        for x in np.flatnonzero(part.outside):
            at = part.similar(x)
            hit[at] = True
            hit[x] |= len(at) > 0
        return group.sort_by("node").filter(pa.array(hit))

    return run


def compared(percent: float):
    """Links between the members of a part that join components."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by("node")
        part = Part(key, group, percent)
        items = [x.values.to_numpy() for x in group["items"]]
        u, v = [], []
        for x in np.flatnonzero(part.outside):
            at = part.similar(x)
            if not len(at):
                continue
            shared = np.isin(np.concatenate([items[y] for y in at]), items[x])
            common = np.add.reduceat(shared.astype(np.int64), np.cumsum([0, *part.sizes[at[:-1]]]))
            for y in at[100 * common >= percent * (part.sizes[at] + part.sizes[x] - common)]:
                if part.roots[y] != part.roots[x]:
                    u.append(part.roots[x])
                    v.append(part.roots[y])
                    part.roots[part.roots == part.roots[y]] = part.roots[x]
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return run


def estimates(bits: np.ndarray, own: np.ndarray) -> np.ndarray:
    """``estimate`` for packed bits in arrays."""
    unequal = bits ^ own
    each = unequal.copy()
    for shift in range(1, BITS):
        each |= unequal >> shift
    ones = np.bitwise_count(each & np.int64(sum(1 << (BITS * i) for i in range(PER_LONG)))).sum(axis=1, dtype=np.int64)
    chance = 1 / (1 << BITS)
    return (1 - ones / HASHES - chance) / (1 - chance)


def shared_buckets(classes: DataFrame) -> DataFrame:
    """``key``, ``node`` and ``pivot`` of the buckets that hold two classes or more.

    The pivot is the member that meets most others over all its buckets: the middle of a group, if any.
    """
    keyed = classes.select("node", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    shared = stored(keyed.join(shared, "key"), "shared")
    met = shared.groupBy("node").agg(F.sum("members").alias("met"))
    pivots = shared.join(met, "node").groupBy("key").agg(F.max(F.struct("met", "node")).alias("most"))
    return stored(shared.join(pivots, "key").select("key", "node", F.col("most.node").alias("pivot")), "buckets")


def class_roots(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, width: int, percent: float) -> DataFrame:
    """``node`` and ``root`` of every class that is linked with another."""
    stars = shared_buckets(classes)
    close = stars.filter("node <> pivot").select(F.col("node").alias("u"), F.col("pivot").alias("v")).distinct()
    close = close.join(prefixed(classes, "u"), "u").join(prefixed(classes, "v"), "v").filter(near("u", "v", percent)).select("u", "v")

    named = classes.select("node", "set_key", "least_id").join(stars.select("node").distinct(), "node", "left_semi")
    texts = docs.select(id_or_last(id_col).alias("_id"), F.col(text_col).alias("_text"))
    texts = texts.join(named.select(F.col("least_id").alias("_id")).distinct(), "_id", "left_semi")
    sets = shingle_sets(texts, width).join(named.select("node", "set_key"), "set_key")
    sets = stored(sets.select("node", "items").dropDuplicates(["node"]), "sets")

    roots = stored(components(confirmed(close, sets, percent)), "roots")
    members = open_members(stars, roots, classes)
    suspects = stored(members.groupBy("key", "part", "blocks").applyInArrow(suspected(percent), MEMBER), "suspects")
    if suspects.isEmpty():
        return roots
    late = suspects.join(sets, "node").groupBy("key", "part", "blocks").applyInArrow(compared(percent), "u long, v long")
    tops = stored(components(late).select(F.col("node").alias("root"), F.col("root").alias("top")), "tops")
    alone = tops.join(roots, "root", "left_anti").select(F.col("root").alias("node"), "top")
    joined = roots.join(tops, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return joined.unionByName(alone.withColumnRenamed("top", "root"))


def labelled_rows(docs: DataFrame, id_col: str, text_col: str, width: int, percent: float) -> DataFrame:
    """``_id``, ``n_shingles``, the marks of the text, ``root`` and ``component`` of every row; without words no root."""
    marks = signatures(docs, id_col, text_col, width).withColumn("_row", F.monotonically_increasing_id())
    marks = stored(marks, "signatures")
    full = marks.filter("n_shingles > 0")
    classes = full.groupBy("set_key").agg(
        F.min("_row").alias("node"), F.min("_id").alias("least_id"), F.min("n_shingles").alias("n"),
        F.any_value("bits").alias("bits"), F.any_value("bands").alias("bands"),
    )
    classes = stored(classes, "classes")
    roots = class_roots(docs, classes, id_col, text_col, width, percent)
    labelled = classes.select("node", "set_key", "least_id").join(roots, "node", "left")
    labelled = labelled.withColumn("root", F.coalesce("root", "node")).withColumn("_salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)))
    smallest = labelled.groupBy("root").agg(F.min("least_id").alias("component"))
    labelled = salted_lookup(labelled, smallest, "root", "_salt").select("set_key", "root", "component")
    own = ["_id", "n_shingles", "_text1", "_text2"]
    rows = full.select(*own, "set_key", F.pmod(F.xxhash64("_row"), F.lit(SALTS)).alias("_salt"))
    rows = salted_lookup(rows, labelled, "set_key", "_salt").select(*own, "root", "component")
    empty = marks.filter("n_shingles = 0").select(*own, F.lit(None).cast("long").alias("root"), F.col("_id").alias("component"))
    return rows.unionByName(empty)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, percent: float = PERCENT
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id``, ``kept``.

    Words are runs without ASCII white space, A-Z lower-cased. A text of fewer than
    ``width`` words is one shingle; one without words, or null, has the empty set and is
    linked with nothing. Links join documents of at least ``percent`` similarity,
    confirmed on full sets of 64-bit shingle hashes. Equal sets are linked. The
    component is named by its smallest id; a null id comes last, and stands for itself
    where all are null. Rows that share an id are separate documents of one name.
    Other columns are left out. An empty table gives an empty result.
    """
    return labelled_rows(docs, id_col, text_col, width, percent).select(
        id_or_null(F.col("_id")).alias(id_col),
        "n_shingles",
        id_or_null(F.col("component")).alias("component_id"),
        (F.col("_id") == F.col("component")).alias("kept"),
    )


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, percent: float = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one row of each component.

    It is the one of smallest id, a null id last; of several rows of that id one, whichever has the least
    hash of its text. Rows without words are linked with nothing and all stay.
    """
    keys = ["_id", "_text1", "_text2"]
    found = labelled_rows(docs, id_col, text_col, width, percent).filter("n_shingles > 0")
    kept = found.groupBy("root").agg(F.min(F.struct(*keys)).alias("_least")).select("_least.*")
    rows = docs.select(F.struct("*").alias("_doc"), id_or_last(id_col).alias("_id"), *text_marks(F.col(text_col)))
    worded = F.coalesce(F.col(text_col).rlike(f"[^{SPACE}]"), F.lit(False))
    stay = rows.join(kept, keys, "left_semi").dropDuplicates(keys).select("_doc.*")
    return stay.unionByName(docs.filter(~worded))
