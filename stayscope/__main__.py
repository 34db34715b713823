"""Jobs from the command line: `spark-submit --py-files ... -m`, or `python -m stayscope <job> ...`."""

from __future__ import annotations

import argparse
import json

from stayscope.operators.language import LanguageModel, fit_language_model
from stayscope.plans.board import board
from stayscope.plans.etl import run_etl
from stayscope.plans.materialise import materialise
from stayscope.plans.search import index_documents, search_documents
from stayscope.plans.training import train
from stayscope.operators.embedding import generate_vectors
from stayscope.session import build_session
from stayscope.sources.files import write_report, write_table


def etl(spark, args):
    model = LanguageModel.load(spark, args.language_model) if args.language_model else None
    print(json.dumps(run_etl(spark, args.reviews, args.states, args.clean, args.vectors, model)))


def language(spark, args):
    refuse = float(args.refuse) if args.refuse else None
    fit_language_model(spark.read.parquet(args.texts), args.text_col, args.lang_col, refuse=refuse).save(args.model)


def vectors(spark, args):
    print(generate_vectors(spark, args.clean, args.vectors))


def documents(spark, args):
    options = json.loads(open(args.jdbc_options).read()) if args.jdbc_options else None
    print(json.dumps(materialise(spark, args.vectors, args.documents, options, args.reviews, args.states)))


def models(spark, args):
    train(spark, args.vectors, args.results).show(truncate=False)


def index(spark, args):
    index_documents(spark, args.documents, args.index)


def search(spark, args):
    questions = spark.read.schema("query_id bigint, text string").json(args.questions)
    names = ("keyword_hits", "vector_hits", "compared")
    for name, hits in zip(names, search_documents(spark, args.documents, args.index, questions, args.k)):
        print(name, write_table(hits, f"{args.hits}/{name}"))


def charts(spark, args):
    for name, chart in board(spark.read.parquet(args.clean), args.low, args.high).items():
        print(name, write_report(chart, f"{args.charts}/{name}.csv"))


# Job, its required and its optional arguments.
JOBS = {
    "etl": (etl, ["reviews", "states", "clean"], ["vectors", "language-model"]),
    "language": (language, ["texts", "text-col", "lang-col", "model"], ["refuse"]),
    "vectors": (vectors, ["clean", "vectors"], []),
    "documents": (documents, ["vectors", "documents"], ["jdbc-options", "reviews", "states"]),
    "models": (models, ["vectors", "results"], []),
    "index": (index, ["documents", "index"], []),
    "search": (search, ["documents", "index", "questions", "hits"], []),
    "charts": (charts, ["clean", "charts", "low", "high"], []),
}


def main() -> None:
    parser = argparse.ArgumentParser(prog="stayscope")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name, (_, required, optional) in JOBS.items():
        job = jobs.add_parser(name)
        for argument in required:
            job.add_argument(f"--{argument}", required=True)
        for argument in optional:
            job.add_argument(f"--{argument}")
        if name == "search":
            job.add_argument("--k", type=int, default=5)
    args = parser.parse_args()
    spark = build_session(f"stayscope {args.job}")
    try:
        JOBS[args.job][0](spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
