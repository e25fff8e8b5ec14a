"""Queries without SQL against the libraries, and the pipeline against a brute-force version."""

import base64
import hashlib
import os
from collections import Counter

import duckdb
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from opinara.llm import quality, queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def digest(ids):
    return hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall())


def test_bpe_as_the_library(spark, texts):
    library = Tokenizer.from_file(queries.TOKENIZER)
    found = queries.QUERIES["op7_bpe"](spark, FOLDER).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), digest(ids))
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_packing_keeps_every_token(spark, texts):
    with open(queries.RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = {r["doc_id"]: r for r in queries.QUERIES["op9_packing"](spark, FOLDER).collect()}
    assert found.keys() == texts.keys()
    for i, text in texts.items():
        ids = coder.encode_ordinary(text or "")
        assert (found[i]["n_tokens"], found[i]["ids_sha256"]) == (len(ids), digest(ids))


def test_quality_on_rows_it_never_saw(spark):
    larger = "/root/testdata/sf0.01"
    truth = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{larger}/labels.parquet'").fetchall())
    found = queries.QUERIES["op3_quality"](spark, larger).collect()
    held = [r for r in found if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 50
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_pipeline_against_brute_force(spark, texts):
    from tests_llm_brute import exact_groups, near_components, planned_copies

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    kept = {r["doc_id"]: texts[r["doc_id"]] for r in quality.quality(docs, labels).collect() if r["predicted"]}
    kept = {i: kept[i] for i in exact_groups(kept)}
    kept = {i: kept[i] for i in near_components(kept, 5, 80)}
    source = dict(duckdb.sql(f"SELECT doc_id, source FROM '{FOLDER}/documents.parquet'").fetchall())
    copies = planned_copies(kept, source)
    library = Tokenizer.from_file(queries.TOKENIZER)
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert Counter(r["doc_id"] for r in rows) == copies
    for r in rows:
        assert r["ids"] == library.encode(kept[r["doc_id"]] or "", add_special_tokens=False).ids


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, FOLDER).count() == 0


def test_tokens_carry_the_training_order(spark):
    from pyspark.sql import functions as F

    from opinara.llm import mixing
    from opinara.llm.common import stored

    text = F.concat(F.lit("w"), F.repeat(F.lit(" w"), F.pmod(F.xxhash64("id"), F.lit(400)).cast("int")))
    docs = spark.range(600).select(F.col("id").alias("doc_id"), text.alias("text"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"))
    docs = stored(docs, "some-docs")
    plan = {r["doc_id"]: r["positions"] for r in mixing.mixed(docs, least=1.0).collect()}
    spread = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in spread.items():
        spark.conf.set(name, value)
    try:
        mix = stored(corpus_pipeline.mix_sources(spark, docs, FOLDER), "some-mix")
    finally:
        for name in spread:
            spark.conf.unset(name)
    assert len(mix.inputFiles()) > 1
    rows = sorted(corpus_pipeline.tokenize(spark, mix, FOLDER).collect(), key=lambda r: r["position"])
    assert [r["position"] for r in rows] == list(range(sum(map(len, plan.values()))))
    places = [plan[r["doc_id"]].pop(0) for r in rows]
    assert places == sorted(places) and not any(plan.values())
