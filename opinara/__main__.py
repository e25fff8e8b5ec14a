"""``python -m opinara STEP --raw FOLDER --tables FOLDER`` runs one step or all of them."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans import steps
from .session import clear_work


def main() -> None:
    parser = argparse.ArgumentParser(prog="opinara")
    parser.add_argument("step", choices=["clean", "score", "keywords", "topics", "report", "all"])
    parser.add_argument("--raw", help="folder of landed CSV files")
    parser.add_argument("--tables", required=True, help="folder of the tables the steps share")
    parser.add_argument("--words", nargs="*", help="stop word files")
    parser.add_argument("--polarity", help="CSV of word and polarity, for the base score of English texts")
    parser.add_argument("--labelled", help="Parquet table of text and label (0 or 1) that trains the base score of other texts")
    options = parser.parse_args()
    spark = SparkSession.builder.appName("opinara").getOrCreate()
    if options.step in ("clean", "all") and not options.raw:
        parser.error("--raw is needed")
    polarity, labelled = None, None
    if options.polarity:
        listed = spark.read.csv(options.polarity, schema="word string, polarity double").dropna()
        polarity = {r["word"].strip().lower(): r["polarity"] for r in listed.collect()}  # a lexicon, as in code
    if options.labelled:
        labelled = spark.read.parquet(options.labelled).select("text", "label")
    if options.step in ("score", "all") and not (polarity or options.labelled):
        parser.error("--polarity or --labelled is needed")
    done = {
        "clean": lambda: steps.clean(spark, options.raw, options.tables, options.words),
        "score": lambda: steps.score(spark, options.tables, polarity, labelled),
        "keywords": lambda: steps.keywords(spark, options.tables),
        "topics": lambda: steps.topics(spark, options.tables),
        "report": lambda: steps.report(spark, options.tables, options.words),
        "all": lambda: steps.run(spark, options.raw, options.tables, polarity, labelled, options.words),
    }[options.step]()
    clear_work(spark)
    print("no input" if done is None else "done")


if __name__ == "__main__":
    main()
