"""Command line: ``spark-submit run_study.py`` or ``python -m linetone.cli``."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence

from pyspark.sql import SparkSession

from linetone.plans.study import SentimentStudy
from linetone.session import discard_run

log = logging.getLogger("linetone")

SAMPLE_ROWS = 5


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(
        prog="linetone", description="Score the texts of titles by sentiment."
    )
    parser.add_argument("--csv_dir", required=True, help="folder that holds movies.csv")
    parser.add_argument("--srt_dir", required=True, help="folder of the text files")
    parser.add_argument("--tsv_dir", required=True, help="folder that holds train.tsv")
    parser.add_argument("--out_dir", required=True, help="folder for results and model")
    parser.add_argument("--limit_movies", type=int, help="use the titles with the lowest ids")
    parser.add_argument("--limit_training_set", type=int, help="use the phrases with the lowest ids")
    parser.add_argument("--log", dest="logfile", help="log file (default: standard error)")
    parser.add_argument(
        "-v", "--verbose", type=int, choices=(0, 1, 2), default=0, help="0 errors, 1 info, 2 debug"
    )
    return parser


def run(spark: SparkSession, args: argparse.Namespace) -> SentimentStudy:
    """The study from end to end, with samples on standard output."""
    study = SentimentStudy(
        spark,
        csv_path=f"{args.csv_dir.rstrip('/')}/movies.csv",
        srt_dir=args.srt_dir,
        tsv_path=f"{args.tsv_dir.rstrip('/')}/train.tsv",
        limit_movies=args.limit_movies,
        limit_training_set=args.limit_training_set,
    )
    if study.n_movies_without_subs:
        print(f"titles without a text file, left out: {study.n_movies_without_subs}")
    print(f"titles in the study: {study.n_movies}")

    log.info("fitting the vocabulary")
    study.perform_count_vec()
    log.debug(
        "%d terms, %d left out", len(study.vectoriser.vocabulary), study.terms_left_out
    )
    print("Training set:")
    study.df_train.show(SAMPLE_ROWS)
    print("Testing set:")
    study.df_test.show(SAMPLE_ROWS)

    log.info("fitting the classifier")
    study.classification()
    results = f"{args.out_dir.rstrip('/')}/results"
    study.df_results.write.mode("overwrite").parquet(results)
    spark.read.parquet(results).orderBy("movieId").show(truncate=False)
    log.info("model saved to %s", study.save_model(args.out_dir))
    return study


def main(argv: Sequence[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    level = (logging.ERROR, logging.INFO, logging.DEBUG)[args.verbose]
    log.setLevel(level)
    handler = logging.FileHandler(args.logfile) if args.logfile else logging.StreamHandler()
    log.addHandler(handler)
    spark = SparkSession.builder.appName("linetone").getOrCreate()
    try:
        run(spark, args)
    finally:
        try:
            discard_run(spark)
        finally:
            log.removeHandler(handler)
            handler.close()
            spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
