"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last have
the columns of ``documents``. ``run`` writes each table to the shared folder and reads it again as the
input of the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm import bpe, exact_dedup, minhash, mixing, quality
from opinara.llm.common import stored, with_place
from opinara.llm.queries import TOKENIZER


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; it learns from ``labels`` and the documents at hand."""
    return quality.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.without_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates (five words, 0.8) stays."""
    return minhash.without_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in training order, those of heavier sources up to twice.

    The mix takes 1.5 times the words at hand. Every document is in it at least once, so
    the weights decide what repeats, and nothing clean is lost.
    """
    return mixing.training_order(docs, mixing.mixed(docs, least=1.0))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, and a digest of the text that they decode to.

    ``position`` is the row's place in training order, from 0: rows of a stored table come back in
    any order, so it is taken from the files that the mix was written to.
    """
    placed = with_place(docs, "position").select(F.struct("doc_id", "position").alias("row"), "text")
    rows = bpe.encode(placed, TOKENIZER, "row", decoded=True)
    return rows.select(
        "row.doc_id", "row.position", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("quality classifier", accept_quality),
    ("exact dedup", drop_exact_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("BPE encoding", tokenize),
]
#: A trained classifier, MinHash candidates and byte-pair merges can't be stated in SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
