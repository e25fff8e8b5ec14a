"""Quality classifier: supervised subword embeddings.

A document's features are its words, pairs of neighbouring words and the character
n-grams of its bytes, hashed into ``BUCKETS`` rows of a matrix. Their vectors are
averaged, a linear layer and a softmax give the two classes, and numpy stochastic
gradient descent trains both on labelled documents. A word that repeats its
predecessor is one feature whatever the word, so runs of a word generalise.

The mean and the linear layer commute: for scoring, each row is reduced to one
number, its vector times the difference of the two class weights.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text_hashes import AS_IS, FACTORS, SPACES, block_word_hashes, blocks, mixed

BITS = 16
BUCKETS = 1 << BITS
DIM = 16
#: Lengths of the character n-grams, in bytes.
GRAMS = (3, 4)
#: Labelled documents that a model is trained on at most, those first in a fixed shuffle.
SAMPLE = 4000
EPOCHS = 5
RATE = 2.0
SEED = 3
#: A document is predicted good from this score on.
THRESHOLD = 0.7


def bucket(hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes) >> np.uint64(64 - BITS)).astype(np.int64)


def features(data: np.ndarray) -> Iterator[np.ndarray]:
    """Buckets of all features of a text, block by block; blocks end at white space.

    Words and pairs of words go on across the border of two blocks; the few character n-grams that span one, in
    texts over 1 MiB, are no features.
    """
    last = np.empty(0, np.uint64)
    for block in blocks(data):
        words = np.concatenate([last, block_word_hashes(block, AS_IS)[1]])
        if len(words) > len(last):
            pairs = words[:-1] * FACTORS[1] + words[1:] * FACTORS[2]
            pairs[words[:-1] == words[1:]] = FACTORS[3]
            yield bucket(words[len(last) :])
            yield bucket(pairs)
            last = words[-1:]
        plain = np.where(SPACES[block], np.uint8(0x20), block)
        for n in GRAMS:
            if len(plain) >= n:
                code = np.full(len(plain) - n + 1, n, np.uint64)
                for k in range(n):
                    code = (code << np.uint64(8)) | plain[k : len(plain) - n + 1 + k]
                yield (code * FACTORS[4] >> np.uint64(64 - BITS)).astype(np.int64)


def text_bytes(text: pa.Scalar) -> np.ndarray:
    return np.frombuffer((text.as_py() or "").encode(), np.uint8)


@dataclass(frozen=True)
class Model:
    """Per bucket the change of the log odds of a document that has this feature alone, and the odds of none."""

    weights: np.ndarray
    bias: float

    def score(self, data: np.ndarray) -> float:
        total, count = 0.0, 0
        for found in features(data):
            total += float(self.weights[found].sum())
            count += len(found)
        return float(1 / (1 + np.exp(-(total / max(count, 1) + self.bias))))


def packed(found: np.ndarray) -> bytes:
    """The distinct buckets of a document and how often it has each, compressed: 6 bytes a bucket at most, about 2 as a rule."""
    buckets, counts = np.unique(found, return_counts=True)
    return zlib.compress(np.diff(buckets, prepend=0).astype(np.uint16).tobytes() + counts.astype(np.uint32).tobytes(), 1)


def unpacked(row: bytes | pa.Buffer) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(row)
    number = len(raw) // 6
    return np.cumsum(np.frombuffer(raw, np.uint16, number), dtype=np.int64), np.frombuffer(raw, np.uint32, number, 2 * number).astype(np.float32)


def trained(rows: list[tuple[bytes | pa.Buffer, int]], epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> Model:
    """Model from (packed features, label) of each document; the rate falls to 0 in a line."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    weights, bias = np.zeros((DIM, 2)), np.zeros(2)
    steps, step = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            found, counts = unpacked(rows[i][0])
            label = rows[i][1]
            now = rate * (1 - step / steps)
            step += 1
            share = counts / max(counts.sum(), 1)
            mean = share @ vectors[found]
            logits = mean @ weights + bias
            chance = np.exp(logits - logits.max())
            chance /= chance.sum()
            chance[label] -= 1  # gradient of the loss by the logits
            vectors[found] -= now * share[:, None] * (weights @ chance)
            weights -= now * np.outer(mean, chance)
            bias -= 0.1 * now * chance
    return Model(vectors @ (weights[:, 1] - weights[:, 0]), float(bias[1] - bias[0]))


def held_out(id_col: str) -> Column:
    """Rows that no model may learn from; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def training_rows(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> list[tuple[bytes | pa.Buffer, int]]:
    """Packed features and label of the sample, one row for each of at most ``sample`` ids.

    A row takes 6 bytes for each of its buckets at most, 400 kB for a text that has them all. Of several
    texts of one id the one whose packed features come first counts.
    """
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("_label"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [packed(np.concatenate([np.empty(0, np.int64), *features(text_bytes(text))])) for text in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["id"], batch["label"], pa.array(rows, pa.binary())], ["id", "label", "row"])

    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "_id")
    texts = texts.select(F.col("_id").cast("long").alias("id"), F.col("_label").cast("int").alias("label"), "text")
    rows = texts.mapInArrow(counted, "id long, label int, row binary").groupBy("id", "label").agg(F.min("row").alias("row"))
    # Arrow keeps the rows out of the interpreter's own memory, which it would not give back.
    table = rows.orderBy("id").toArrow()
    return list(zip((x.as_buffer() for x in table["row"]), table["label"].to_pylist(), strict=True))


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``score`` (0 to 1) and ``predicted``.

    The whole text is read, in blocks. A null or empty text has the score of the bias
    alone. Other columns are left out and never seen by the model.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array([model.score(text_bytes(text)) for text in batch.column(1)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], ["id", "score"])

    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = chosen.schema["id"].dataType.simpleString()
    rows = chosen.mapInArrow(run, f"id {kind}, score double")
    return rows.select(F.col("id").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def quality(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
) -> DataFrame:
    """Trains on the labelled rows that aren't held out and scores every row.

    Returns id, ``held_out``, ``score``, ``predicted``. Labels other than 0 and 1, and of
    null ids, aren't learned from; of several labels of one id the highest counts. Without
    any label every score is 0.5.
    """
    model = trained(training_rows(docs, labels, sample, id_col, text_col, label_col))
    rows = scored(docs, model, threshold, id_col, text_col)
    return rows.select(id_col, held_out(id_col).alias("held_out"), "score", "predicted")


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns."""
    model = trained(training_rows(docs, labels, id_col=id_col, text_col=text_col))
    weights, bias = model.weights, model.bias

    def accepted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Model(weights, bias)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            yield batch.filter(pa.array([judge.score(text_bytes(text)) >= THRESHOLD for text in texts], pa.bool_()))

    return docs.mapInArrow(accepted, docs.schema)
