"""Term vectors, clusters and trained classifiers.

Of the corpus only the vocabulary of the term vectors comes to the driver, and its
size is a parameter; the words of naive Bayes stay in a table.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LinearSVC, OneVsRest
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from ..functions.text import lexicon_words, vector_terms
from ..session import work_path
from .columns import computed_once
from .membership import fits_broadcast, hinted

MAX_TERMS = 5000
CLUSTERS = 6
STARTS = 10
SEED = 42
HASHED_WORDS = 1 << 16
#: Words of a naive Bayes model that are broadcast when it has too many for that.
FREQUENT_WORDS = 100_000


#: Column of the distinct terms of a row with their counts.
COUNTS = "_counts"


@F.arrow_udf(ArrayType(StructType().add("term", "string").add("tf", "long")))
def count_terms(lists: pa.Array) -> pa.Array:
    """Lists of terms as lists of distinct terms with counts; a null list is empty."""
    row, coded = pc.list_parent_indices(lists).to_numpy(), lists.flatten().dictionary_encode()
    wide = max(len(coded.dictionary), 1)
    pairs, counts = np.unique(row * wide + coded.indices.to_numpy(), return_counts=True)
    return as_lists(len(lists), pairs // wide, term=coded.dictionary.take(pa.array(pairs % wide)), tf=pa.array(counts, pa.int64()))


def as_lists(rows: int, row: np.ndarray, **fields: pa.Array) -> pa.Array:
    """One list of structs for each of ``rows``, from entries in order of their ``row``."""
    starts = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(starts), pa.StructArray.from_arrays(list(fields.values()), list(fields)))


def counted_terms(docs: DataFrame, tokens: str = "tokens", keep: Sequence[str] | None = None) -> DataFrame:
    """The columns ``keep``, by default all, and ``COUNTS``, written once: texts are made and split only here.

    A row has all its terms, so they are counted where it stands and nothing moves.
    A table that has the counts already comes back as it is.
    """
    if COUNTS in docs.columns:
        return docs
    keep = list(docs.columns if keep is None else keep)
    prepared = computed_once(docs, "_said", vector_terms(F.col(tokens)))
    path = work_path(docs.sparkSession, "term-counts")
    prepared.select(*keep, count_terms("_said").alias(COUNTS)).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def vocabulary(counted: DataFrame, n: int, size: int = MAX_TERMS) -> tuple[list[str], list[float]]:
    """The ``size`` most frequent terms, ties by term, and their smoothed idf plus one among ``n`` rows."""
    each = counted.select(F.inline(COUNTS)).groupBy("term").agg(F.sum("tf").alias("_total"), F.count(F.lit(1)).alias("_df"))
    top = each.orderBy(F.desc("_total"), "term").limit(size).select("term", (F.log((n + 1) / (F.col("_df") + 1)) + 1).alias("_idf")).collect()
    return [r["term"] for r in top], [r["_idf"] for r in top]


def weights_of(names: Sequence[str], idf: Sequence[float]) -> Callable[[pa.Array], tuple[np.ndarray, ...]]:
    """A function from lists of counted terms to the kept entries by row and place in ``names``: row, place, tf, unit-length weight."""

    def weigh(lists: pa.Array) -> tuple[np.ndarray, ...]:
        term, tf = lists.flatten().flatten()
        place = pc.index_in(term, value_set=pa.array(names, pa.string()))
        known = place.is_valid().to_numpy(zero_copy_only=False)
        row, place, tf = pc.list_parent_indices(lists).to_numpy()[known], place.drop_null().to_numpy(), tf.to_numpy()[known]
        order = np.argsort(row * max(len(names), 1) + place)
        row, place, tf = row[order], place[order], tf[order]
        weight = tf * np.array(idf, float)[place]
        return row, place, tf, weight / np.sqrt(np.bincount(row, weight * weight, len(lists)))[row]

    return weigh


def weighted_terms(
    docs: DataFrame, key: str, tokens: str = "tokens", size: int = MAX_TERMS, keep: Sequence[str] = ()
) -> DataFrame:
    """``(key, weights)``: for each row its kept terms as ``(term, tf, tfidf)``, with smoothed idf plus one and unit row length.

    Columns ``keep`` stay beside them if no key repeats. Rows of a repeated key count as one; only then do terms move.
    """
    counted = counted_terms(docs, tokens, [key, *keep])
    n = counted.count()
    rows = counted.select(key, *keep, COUNTS)
    if not rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").isEmpty():
        added = rows.select(key, F.inline(COUNTS)).groupBy(key, "term").agg(F.sum("tf").alias("tf"))
        path = work_path(docs.sparkSession, "key-counts")
        added.groupBy(key).agg(F.collect_list(F.struct("term", "tf")).alias(COUNTS)).write.parquet(path)
        rows, keep = docs.sparkSession.read.parquet(path), ()
    names, idf = vocabulary(rows, n, size)
    weigh = weights_of(names, idf)

    @F.arrow_udf("array<struct<term:string,tf:bigint,tfidf:double>>")
    def weights(lists: pa.Array) -> pa.Array:
        row, place, tf, weight = weigh(lists)
        return as_lists(len(lists), row, term=pa.array(names, pa.string()).take(pa.array(place)), tf=pa.array(tf), tfidf=pa.array(weight))

    return rows.select(key, *keep, weights(COUNTS).alias("weights"))


def tfidf_rows(docs: DataFrame, key: str, tokens: str = "tokens", size: int = MAX_TERMS, keep: Sequence[str] = ()) -> DataFrame:
    """``(key, term, tf, tfidf)``: the weighted terms, a row for each."""
    weighted = weighted_terms(docs, key, tokens, size, keep)
    return weighted.select(*[c for c in weighted.columns if c != "weights"], F.inline("weights"))


def top_terms_per_row(weighted: DataFrame, key: str, n: int, digits: int = 9) -> DataFrame:
    """``(key, rank, term)``: the ``n`` strongest of the weighted terms of each row, weights equal to so many digits by term."""
    # Only the strong ones are rounded and sorted: those not clearly below the n-th.
    least = F.coalesce(F.get(F.sort_array(F.col("weights")["tfidf"], asc=False), n - 1), F.lit(0.0)) - F.lit(2 * 10.0**-digits)
    strong = computed_once(weighted.select(key, "weights"), "_least", least).select(key, F.filter("weights", lambda x: x["tfidf"] >= F.col("_least")).alias("_strong"))
    ordered = F.sort_array(F.transform("_strong", lambda x: F.struct((-F.round(x["tfidf"], digits)).alias("_last"), x["term"].alias("term"))))
    ranked = strong.select(key, F.posexplode(F.slice(ordered, 1, n)).alias("_at", "_x"))
    return ranked.select(key, (F.col("_at") + 1).alias("rank"), "_x.term")


def tfidf_vectors(
    docs: DataFrame, tokens: str = "tokens", size: int = MAX_TERMS
) -> tuple[DataFrame, list[str]]:
    """Adds unit-length ``features``; the second result names the dimensions.

    The vectors are written to the shared folder in the columns in which Spark keeps vectors, and read as such.
    """
    counted = counted_terms(docs, tokens)
    names, idf = vocabulary(counted, counted.count(), size)
    weigh = weights_of(names, idf)

    @F.arrow_udf("struct<type:tinyint,size:int,indices:array<int>,values:array<double>>")
    def sparse(lists: pa.Array) -> pa.Array:
        row, place, _, weight = weigh(lists)
        starts = pa.array(np.searchsorted(row, np.arange(len(lists) + 1)).astype(np.int32))
        places = pa.ListArray.from_arrays(starts, pa.array(place, pa.int32()))
        values = pa.ListArray.from_arrays(starts, pa.array(weight))
        kind, wide = np.zeros(len(lists), np.int8), np.full(len(lists), len(names), np.int32)
        return pa.StructArray.from_arrays([pa.array(kind), pa.array(wide), places, values], ["type", "size", "indices", "values"])

    path = work_path(docs.sparkSession, "vectors")
    counted.select(*docs.columns, sparse(COUNTS).alias("features")).write.parquet(path)
    schema = StructType([*counted.select(*docs.columns).schema.fields, StructField("features", VectorUDT())])
    return docs.sparkSession.read.schema(schema).parquet(path), names


def cluster(
    docs: DataFrame,
    k: int = CLUSTERS,
    tokens: str = "tokens",
    size: int = MAX_TERMS,
    starts: int = STARTS,
    seed: int = SEED,
    iterations: int = 300,
) -> tuple[DataFrame, KMeansModel, list[str]]:
    """K-means on the term vectors, the cheapest of several seeded starts.

    Each start runs until its centroids rest or ``iterations`` are done. The vectors are in the shared folder: the starts do not clean
    and tokenize the texts again, and a lost executor costs no recomputation.
    """
    vectors, names = tfidf_vectors(docs, tokens, size)
    models = started(vectors, k, starts, seed, iterations)
    best = min(models, key=lambda model: model.summary.trainingCost)
    return best.transform(vectors), best, names


def started(vectors: DataFrame, k: int, starts: int, seed: int, iterations: int) -> list[KMeansModel]:
    """The model of each start, in order.

    Only the vectors are kept between the starts. The algorithm keeps its own copy, ready for arithmetic, of a
    table that is not itself persisted, and goes over that in each round.
    """
    kept = vectors.select("features", F.lit(True).alias("_kept")).persist()
    means = KMeans(k=k, maxIter=iterations, predictionCol="cluster")
    models = [means.copy({means.seed: seed + start}).fit(kept.select("features")) for start in range(starts)]
    kept.unpersist()
    return models


#: How far a centroid may be from the mean of its rows: it moved less than 1e-4 in the last round, after which a few rows change sides.
REST = 1e-2


def cluster_certificate(weights: DataFrame, placed: DataFrame, centers: DataFrame, named: DataFrame, key: str) -> DataFrame:
    """One row per cluster that tells whether the clustering is a fixed point, whatever made it.

    ``weights`` has ``(key, term, tfidf)`` and, if at hand, the ``cluster`` of the row, ``placed`` ``(key, cluster)`` for every row, ``centers`` ``(cluster, term,
    weight)`` with a row for every term of every cluster, and ``named`` ``(cluster, rank, term)`` the reported terms.
    ``nearest``: no row of the cluster is nearer to another centroid. ``rests``: the centroid is the mean
    of its rows. ``cost``: their squared distances from it. ``strongest``: the mean of no unreported term is above that of a reported one.
    Distances come from products of the row's terms with the centroids, so a row meets only its own terms.
    """
    by_term = centers.groupBy("term").agg(F.map_from_entries(F.collect_list(F.struct("cluster", "weight"))).alias("_at"))
    clusters = [r["cluster"] for r in centers.select("cluster").distinct().orderBy("cluster").collect()]  # a few
    lengths = centers.groupBy("cluster").agg(F.sum(F.col("weight") * F.col("weight")).alias("_length"))
    products = [F.sum(F.col("tfidf") * F.col("_at")[c]).alias(f"_p{c}") for c in clusters]
    own = weights.join(hinted(by_term), "term").groupBy(key).agg(F.sum(F.col("tfidf") * F.col("tfidf")).alias("_own"), *products)
    norms = lengths.agg(F.map_from_entries(F.collect_list(F.struct("cluster", "_length"))).alias("_norms"))
    rows = placed.join(own, key, "left").crossJoin(F.broadcast(norms))
    zero = lambda name: F.coalesce(F.col(name), F.lit(0.0))
    far = F.array(*[F.struct((zero("_own") - 2 * zero(f"_p{c}") + F.col("_norms")[c]).alias("far"), F.lit(c).alias("cluster")) for c in clusters])
    rows = rows.withColumn("_far", far)
    mine = F.filter("_far", lambda x: x["cluster"] == F.col("cluster"))[0]["far"]
    rows = rows.select("cluster", mine.alias("_mine"), F.array_min(F.transform("_far", lambda x: x["far"])).alias("_least"))
    sides = rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.sum("_mine").alias("cost"), F.min(F.col("_mine") <= F.col("_least") + 1e-9).alias("nearest"))
    told = weights if "cluster" in weights.columns else weights.join(placed, key)
    sums = told.groupBy("cluster", "term").agg(F.sum("tfidf").alias("_sum"))
    means = centers.join(sums, ["cluster", "term"], "left").join(sides.select("cluster", "size"), "cluster")
    means = means.withColumn("_mean", F.coalesce(F.col("_sum") / F.col("size"), F.lit(0.0)))
    gaps = means.join(named.select("cluster", "term", F.lit(True).alias("_named")), ["cluster", "term"], "left")
    shown = F.col("_named").isNotNull()
    gaps = gaps.groupBy("cluster").agg(
        F.sqrt(F.sum((F.col("_mean") - F.col("weight")) * (F.col("_mean") - F.col("weight")))).alias("_gap"),
        F.min(F.when(shown, F.col("_mean"))).alias("_last"), F.max(F.when(~shown, F.col("_mean"))).alias("_next"),
    )
    out = sides.join(gaps, "cluster")
    strongest = F.coalesce(F.col("_last") + REST >= F.col("_next"), F.lit(True))
    return out.select("cluster", "size", "nearest", (F.col("_gap") <= REST).alias("rests"), strongest.alias("strongest"), "cost")


def center_rows(spark: SparkSession, model: KMeansModel, names: Sequence[str]) -> DataFrame:
    """``(cluster, term, weight)``: all values of the centroids, ``k`` times the vocabulary size."""
    rows = [(c, names[i], float(x)) for c, center in enumerate(model.clusterCenters()) for i, x in enumerate(center)]
    return spark.createDataFrame(rows, "cluster int, term string, weight double")


def cluster_sizes(clustered: DataFrame, k: int = CLUSTERS) -> DataFrame:
    """``(cluster, size)`` for every cluster, 0 for an empty one."""
    sizes = clustered.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    every = clustered.sparkSession.range(k).select(F.col("id").cast("int").alias("cluster"))
    joined = every.join(F.broadcast(sizes), "cluster", "left")
    return joined.select("cluster", F.coalesce("size", F.lit(0)).cast("long").alias("size"))


def cluster_terms(docs: DataFrame, model: KMeansModel, names: Sequence[str], n: int = 10) -> DataFrame:
    """``(cluster, rank, term, weight)``: strongest terms of each centroid.

    The centroids have ``k`` times the vocabulary size values in all.
    """
    spark = docs.sparkSession
    rows = [
        (c, names[i], float(center[i]))
        for c, center in enumerate(model.clusterCenters())
        for i in (-center).argsort(kind="stable")[: max(n, 1)]
    ]
    table = spark.createDataFrame(rows, "cluster int, term string, weight double")
    order = Window.partitionBy("cluster").orderBy(F.desc("weight"), "term")
    return table.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def with_words(rows: DataFrame, text: str = "text") -> DataFrame:
    return computed_once(rows, "words", lexicon_words(F.col(text)))


@dataclass(frozen=True)
class WordBayes:
    """Multinomial naive Bayes with add-one smoothing over all words of the labelled rows.

    ``weights`` holds a row per word with its log probability per class and its count ``_n``, in a table
    of the shared folder: the vocabulary may be of any size. The classes are few and on the driver.
    """

    classes: list[int]
    priors: list[float]
    weights: DataFrame

    def log_scores(self, rows: DataFrame, key: str, text: str) -> DataFrame:
        """``(key, _scores)``: unnormalized log probability per class, for the rows that hold a known word.

        Small weights are broadcast: then only one row of sums per text and task moves. Of more words than that the
        most frequent are broadcast; of the others, which are rare, each text's counts move to the weights.
        """
        spoken = with_words(rows.select(key, text), text).select(key, F.explode("words").alias("word"))
        places = range(len(self.classes))
        thetas = [F.col("_theta")[i].alias(f"_t{i}") for i in places]
        if fits_broadcast(self.weights):
            parts = spoken.join(F.broadcast(self.weights), "word").select(key, *thetas)
        else:
            frequent = hinted(self.weights.orderBy(F.desc("_n"), "word").limit(FREQUENT_WORDS).select("word", "_theta"))
            met = spoken.join(frequent, "word", "left")
            rare = F.when(F.col("_theta").isNull(), F.col("word")).alias("_rare")
            sums = met.select(key, rare, *thetas).groupBy(key, "_rare").agg(F.count(F.lit(1)).alias("_times"), *[F.sum(f"_t{i}").alias(f"_t{i}") for i in places])
            path = work_path(rows.sparkSession, "text-words")
            sums.write.parquet(path)
            kept = rows.sparkSession.read.parquet(path)
            others = kept.where(F.col("_rare").isNotNull()).select(key, F.col("_rare").alias("word"), "_times")
            theirs = others.join(self.weights, "word").select(key, *[(F.col("_times") * F.col("_theta")[i]).alias(f"_t{i}") for i in places])
            parts = kept.where(F.col("_rare").isNull()).select(key, *[f"_t{i}" for i in places]).union(theirs)
        return parts.groupBy(key).agg(F.array(*[F.sum(f"_t{i}") for i in places]).alias("_scores"))

    def probabilities(self, rows: DataFrame, key: str, text: str) -> DataFrame:
        """Adds ``_probability``, an array in the order of the classes; ``key`` must be unique."""
        scores = rows.join(self.log_scores(rows, key, text), key, "left")
        priors = F.array(*map(F.lit, self.priors))
        totals = F.coalesce(F.zip_with("_scores", priors, lambda s, p: s + p), priors)
        odds = lambda x: F.transform(x, lambda s: F.exp(s - F.array_max(x)))
        shares = F.transform(odds(totals), lambda o: o / F.aggregate(odds(totals), F.lit(0.0), lambda a, b: a + b))
        return scores.withColumn("_probability", shares).drop("_scores")


def train_bayes(labelled: DataFrame, text: str = "text", label: str = "label") -> WordBayes:
    """Word counts per class in one aggregation; no word is left out."""
    spark = labelled.sparkSession
    rows = with_words(labelled.select(F.col(label).cast("int").alias("_class"), text), text)
    sizes = rows.groupBy("_class").agg(F.count(F.lit(1)).alias("n")).orderBy("_class").collect()  # a row per class
    classes = [r["_class"] for r in sizes]
    every = sum(r["n"] for r in sizes)
    priors = [math.log((r["n"] + 1) / (every + len(sizes))) for r in sizes]
    spoken = rows.select("_class", F.explode("words").alias("word"))
    counts = spoken.groupBy("word").agg(*[F.count_if(F.col("_class") == c).alias(f"_{i}") for i, c in enumerate(classes)])
    path = work_path(spark, "word-counts")
    counts.write.parquet(path)
    counts = spark.read.parquet(path)
    totals = counts.agg(F.count(F.lit(1)).alias("words"), *[F.sum(f"_{i}").alias(f"_{i}") for i in range(len(classes))]).first()
    theta = F.array(*[F.log((F.col(f"_{i}") + 1) / F.lit(float((totals[f"_{i}"] or 0) + totals["words"]))) for i in range(len(classes))])
    every_class = sum((F.col(f"_{i}") for i in range(len(classes))), F.lit(0))
    return WordBayes(classes, priors, counts.select("word", theta.alias("_theta"), every_class.alias("_n")))


def train_sentiment(labelled: DataFrame, text: str = "text", label: str = "label") -> WordBayes:
    """Naive Bayes on the words of a labelled table; the larger label is the positive one."""
    return train_bayes(labelled, text, label)


def positive_probability(model: WordBayes, rows: DataFrame, text: str = "text", key: str = "row_id") -> DataFrame:
    """Adds ``base_score``, the probability of the positive class; ``key`` must be unique."""
    out = model.probabilities(rows, key, text)
    return out.withColumn("base_score", F.element_at("_probability", -1)).drop("_probability")


def train_topics(labelled: DataFrame, text: str, label: str, kind: str = "nb") -> WordBayes | PipelineModel:
    """Supervised topics: naive Bayes or one-vs-rest linear SVM.

    The SVM's words are hashed into ``HASHED_WORDS`` dimensions, so all words count and
    the coefficients have a fixed size. The hashed texts are kept while labels are counted and learned from them, two at a time.
    """
    if kind == "nb":
        return train_bayes(labelled, text, label)
    rows = with_words(labelled, text).withColumn("label", F.col(label).cast("double"))
    hashed = HashingTF(numFeatures=HASHED_WORDS, inputCol="words", outputCol="features")
    kept = hashed.transform(rows).select("label", "features").persist()
    model = OneVsRest(classifier=LinearSVC(), parallelism=2).fit(kept)
    kept.unpersist()
    return PipelineModel(stages=[hashed, model])


def predicted_topics(model: WordBayes | PipelineModel, rows: DataFrame, text: str, key: str = "row_id") -> DataFrame:
    """Adds ``topic_label`` and, for models with probabilities, ``topic_confidence``; ``key`` must be unique."""
    if isinstance(model, WordBayes):
        out = model.probabilities(rows, key, text).withColumn("topic_confidence", F.array_max("_probability"))
        best = F.array_position(F.col("_probability"), F.col("topic_confidence")).cast("int")
        chosen = F.get(F.array(*map(F.lit, model.classes)), best - 1)
    else:
        out = model.transform(with_words(rows, text)).withColumn("topic_confidence", F.lit(None).cast("double"))
        chosen = F.col("prediction").cast("int")
    return out.withColumn("topic_label", chosen).select(*rows.columns, "topic_label", "topic_confidence")
