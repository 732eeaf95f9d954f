"""Command line: python -m revlens <job> [--option value ...]."""

from __future__ import annotations

import argparse
import importlib
import json

from revlens.operators.models import model_of_file
from revlens.plans import jobs
from revlens.session import build_session


def main(argv=None):
    ap = argparse.ArgumentParser(prog="revlens")
    sub = ap.add_subparsers(dest="job", required=True)
    p = sub.add_parser("preprocess")
    p.add_argument("--reviews", required=True)
    p.add_argument("--meta", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--exclude-category", default="Books")
    p.add_argument("--emoji", help="CSV of (ch, name)")
    p = sub.add_parser("aspects")
    p.add_argument("--tokens", required=True)
    p.add_argument("--lexicon", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--negations", help="text file of the scorer's negation words, one per line")
    p.add_argument("--boosters", help="CSV of (word, scalar)")
    p.add_argument("--scorer", choices=["core", "full"], default="core", help="full: idioms, contrast and emphasis too")
    p.add_argument("--top-k", type=int, default=5)
    p = sub.add_parser("aspect-input")
    p.add_argument("--clean", required=True)
    p.add_argument("--contractions", required=True, help="CSV of (short, long)")
    p.add_argument("--out", required=True)
    p.add_argument("--min-votes", type=int, default=5)
    p = sub.add_parser("split")
    p.add_argument("--clean", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--per-label", type=int, default=20_000)
    p = sub.add_parser("score")
    p.add_argument("--clean", required=True)
    p.add_argument("--model", required=True, help="module:function that returns a predict function")
    p.add_argument("--model-file", help="saved model; --model then names a function (local path) -> predict function")
    p.add_argument("--predictions", required=True)
    p = sub.add_parser("classify")
    p.add_argument("--clean", required=True)
    p.add_argument("--model", required=True)
    p.add_argument("--predictions", required=True)
    p.add_argument("--kind", choices=["naive_bayes", "logistic"], default="naive_bayes")
    p = sub.add_parser("evaluate")
    p.add_argument("--predictions", required=True)
    p = sub.add_parser("enrich")
    p.add_argument("--products", required=True)
    p.add_argument("--similar", required=True)
    p.add_argument("--out", required=True)
    p = sub.add_parser("filter-meta")
    p.add_argument("--lines", required=True)
    p.add_argument("--keywords", required=True, help="comma separated")
    p.add_argument("--out", required=True)
    p.add_argument("--rejects")
    a = ap.parse_args(argv)
    spark = build_session()
    if a.job == "preprocess":
        jobs.preprocess(spark, a.reviews, a.meta, a.out, a.exclude_category, a.emoji)
    elif a.job == "aspects":
        jobs.extract_aspects(spark, a.tokens, a.lexicon, a.out, negations_path=a.negations, boosters_path=a.boosters,
                             top_k=a.top_k, scorer=a.scorer)
    elif a.job == "aspect-input":
        jobs.aspect_input(spark, a.clean, a.contractions, a.out, a.min_votes)
    elif a.job == "split":
        jobs.split_sets(spark, a.clean, a.out, a.per_label)
    elif a.job == "score":
        module, _, name = a.model.partition(":")
        make = getattr(importlib.import_module(module), name)
        jobs.score(spark, a.clean, model_of_file(spark, a.model_file, make) if a.model_file else make, a.predictions)
    elif a.job == "classify":
        m = jobs.train_classifier(spark, a.clean, a.model, a.predictions, a.kind)
        print(json.dumps(m.first().asDict()))
    elif a.job == "evaluate":
        for name, df in jobs.evaluate(spark, a.predictions).items():
            print(name)
            df.show(truncate=False)
    elif a.job == "enrich":
        jobs.enrich_products(spark, a.products, a.similar, a.out)
    elif a.job == "filter-meta":
        jobs.filter_metadata(spark, a.lines, a.keywords.split(","), a.out, a.rejects)
    spark.stop()


if __name__ == "__main__":
    main()
