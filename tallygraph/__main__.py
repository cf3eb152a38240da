"""Batch jobs: ``python -m tallygraph JOB ...``, or this file under ``spark-submit``.

    wordcount INPUT OUTPUT          word, document, count
    tf        INPUT OUTPUT          word, document, log term frequency
    tfidf     INPUT TF_OUT OUTPUT   the above and word, document, TF-IDF
    search    SCORES OUTPUT TERM..  document, score
    pagerank  INPUT OUTPUT          page, rank, highest first
    linreg    INPUT OUTPUT          term, coefficient

Inputs are text files, tables between jobs are Parquet, final lists are
tab-separated text.
"""

import argparse

from pyspark.sql import SparkSession

from tallygraph.functions import log_term_frequency
from tallygraph.operators import fit_ols, search, term_frequency, tfidf, tokenize, word_count
from tallygraph.plans import rank_lines
from tallygraph.sources import (
    count_files,
    read_documents,
    read_lines,
    read_numeric_csv,
    read_scores,
    write_betas,
    write_ranked,
    write_scores,
    write_tsv,
)


def run_wordcount(spark: SparkSession, args: argparse.Namespace) -> None:
    write_tsv(word_count(tokenize(read_documents(spark, args.input))), args.output)


def run_tf(spark: SparkSession, args: argparse.Namespace) -> None:
    term_frequency(word_count(tokenize(read_documents(spark, args.input)))).write.parquet(args.output)


def run_tfidf(spark: SparkSession, args: argparse.Namespace) -> None:
    """Counts and frequencies are stored together, so the text is read once."""
    n_docs = count_files(spark, args.input)
    counts = word_count(tokenize(read_documents(spark, args.input)))
    frequency = log_term_frequency(counts["n"]).alias("tf")
    counts.select("word", "doc_id", "n", frequency).write.parquet(args.tf_output)
    stored = spark.read.parquet(args.tf_output).select("word", "doc_id", "n")
    write_scores(tfidf(stored, n_docs), args.output)


def run_search(spark: SparkSession, args: argparse.Namespace) -> None:
    hits = search(read_scores(spark, args.scores), args.terms)
    write_tsv(hits.orderBy("doc_id"), args.output)


def run_pagerank(spark: SparkSession, args: argparse.Namespace) -> None:
    write_ranked(rank_lines(read_lines(spark, args.input)), args.output)


def run_linreg(spark: SparkSession, args: argparse.Namespace) -> None:
    table = read_numeric_csv(spark, args.input)
    print(f"Columns: {len(table.columns)}")
    y, *xs = table.columns
    betas = fit_ols(table, y, xs)
    betas.show(len(table.columns), truncate=False)
    write_betas(betas, args.output)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tallygraph", description="Batch analytics jobs on Spark.")
    jobs = top.add_subparsers(required=True, metavar="JOB")

    def job(name, run, *arguments):
        sub = jobs.add_parser(name, help=" ".join(arguments))
        for argument in arguments:
            sub.add_argument(argument)
        sub.set_defaults(run=run)
        return sub

    job("wordcount", run_wordcount, "input", "output")
    job("tf", run_tf, "input", "output")
    job("tfidf", run_tfidf, "input", "tf_output", "output")
    job("search", run_search, "scores", "output").add_argument("terms", nargs="+")
    job("pagerank", run_pagerank, "input", "output")
    job("linreg", run_linreg, "input", "output")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("tallygraph").getOrCreate()
    args.run(spark, args)


if __name__ == "__main__":
    main()
