"""Commands: clean, sample, prepare, train, predict, evaluate, submit, baseline."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from kinmatch.operators import evaluation, modeling
from kinmatch.plans import pipeline
from kinmatch.plans.config import Preparation
from kinmatch.sources import readers


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="kinmatch")
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, *flags: str, **more) -> argparse.ArgumentParser:
        p = sub.add_parser(name)
        for f in flags:
            p.add_argument(f"--{f}", required=True)
        for f, kind in more.items():
            p.add_argument(f"--{f.replace('_', '-')}", type=kind)
        return p

    command("clean", "input", "output").add_argument("--tsv", action="store_true")
    command("sample", "input", "output", per_country=int, distractors=int, seed=int)
    command("prepare", "cleaned", "work", split=str, config=str, truth=str, train_work=str, max_queries=int, stage=str)
    command("train", "work", "model", config=str)
    command("predict", "work", "model")
    p = command("evaluate", "work", "probabilities")
    p.add_argument("--thresholds", type=float, nargs="*", default=list(evaluation.DEFAULT_THRESHOLDS))
    command("submit", "work", "probabilities", "output", threshold=float, model=str)
    command("baseline", "input", "output", config=str, training_config=str)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("kinmatch").getOrCreate()
    if args.command == "clean":
        return pipeline.clean(spark, readers.Inputs(args.input, f"{args.output}/staging"), args.output, tsv=args.tsv)
    if args.command == "sample":
        given = {k: v for k, v in (("per_country", args.per_country), ("distractors", args.distractors), ("seed", args.seed)) if v is not None}
        return pipeline.sample(spark, readers.Inputs(args.input, f"{args.output}.staging"), args.output, **given)
    if args.command == "prepare":
        split = args.split or "train"
        tables = {n: spark.read.parquet(f"{args.cleaned}/{split}_source{n}.parquet") for n in (1, 2, 3)}
        truth = readers.truth(spark, args.truth) if args.truth else None
        stages = pipeline.STAGES if args.stage in (None, "all") else (args.stage,)
        return pipeline.prepare(spark, tables, args.work, Preparation.load(args.config), split=split, truth=truth, train_work=args.train_work, max_queries=args.max_queries, stages=stages)
    if args.command == "baseline":
        return pipeline.baseline(spark, args.input, args.output, Preparation.load(args.config), modeling.Training.load(args.training_config))
    work = pipeline.Work(spark, args.work)
    if args.command == "train":
        return pipeline.train(work, args.model, modeling.Training.load(args.config))
    if args.command == "predict":
        return pipeline.predict(work, args.model)
    scores = readers.probabilities(spark, args.probabilities)
    if args.command == "evaluate":
        pairs = work.table("pair_features").filter("dataset_split = 'validation'")
        found = evaluation.evaluate(work.table("query_labels"), pairs, scores, args.thresholds)
        work.say("validation_f05", found)
        print(json.dumps(found["best"]))
        return found
    if args.threshold is None and args.model is None:
        raise SystemExit("submit needs --threshold, or --model for the one that was chosen")
    threshold = pipeline.load_model(spark, work, args.model)[1]["decision_threshold"] if args.threshold is None else args.threshold
    return pipeline.submit(work, scores, threshold, args.output)
