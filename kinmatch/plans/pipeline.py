"""Runs: clean, prepare, train, predict, evaluate, submit. Each stage writes Parquet and a line in a manifest;
a stage that is done is skipped, a run with other settings, inputs or code is refused. A model knows what it was
fitted on, and scores nothing else."""

from __future__ import annotations

import json
import shutil
import time
from dataclasses import asdict
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmatch.functions.constants import INDEX_COLUMNS, MODEL_COLUMNS, RAW_COLUMNS
from kinmatch.functions.hashing import file_identity
from kinmatch.operators import blocking, cleaning, evaluation, features, guards, labeling, modeling, sampling, tfidf
from kinmatch.plans.config import Preparation
from kinmatch.sources import files, readers, sinks
from kinmatch.sources.identity import code_sha256, content_identity, table_identity

STAGES = ("index", "block", "label", "features", "export")


class Work:
    """A folder of one run, in any file system: tables by name, and the manifest."""

    def __init__(self, spark: SparkSession, root: str, signature: dict | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        files.make_folder(spark, self.root)
        at = f"{self.root}/manifest.json"
        signature = json.loads(json.dumps(signature))
        self.manifest = files.read_json(spark, at) if files.exists(spark, at) else {"signature": signature, "stages": {}}
        if signature is not None and self.manifest["signature"] != signature:
            raise ValueError("this folder holds a run with other settings, inputs or code")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def say(self, name: str, value) -> None:
        files.write_json(self.spark, value, f"{self.root}/{name}.json")

    def said(self, name: str):
        return files.read_json(self.spark, f"{self.root}/{name}.json")

    def export(self, name: str, df: DataFrame, order: list[str]) -> None:
        """A table as TSV: one file in a local folder, part files elsewhere."""
        if "://" in self.root:
            sinks.write_tsv_folder(df.orderBy(*order), f"{self.root}/{name}", "gzip" if name.endswith(".gz") else None)
        else:
            sinks.write_tsv(df, f"{self.root}/{name}", order)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def put(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        sinks.write_parquet(df, self.path(name), partition_by)
        return self.table(name)

    def run(self, stage: str, needs: tuple[str, ...], outputs: tuple[str, ...], action) -> None:
        done = self.manifest["stages"]
        if any(n not in done for n in needs):
            raise ValueError(f"stage {stage} needs {needs} first")
        if stage in done:
            if absent := [o for o in outputs if not files.exists(self.spark, self.path(o))]:
                raise ValueError(f"stage {stage} is done, but {absent} are gone; take a new folder")
            return
        began = time.time()
        action()
        done[stage] = {"seconds": round(time.time() - began, 3)}
        self.say("manifest", self.manifest)


def clean(spark: SparkSession, inputs: readers.Inputs, out: str, splits=("train", "test"), tsv: bool = False) -> dict:
    """Raw files to cleaned Parquet by split and source, as gzip TSV too if asked; the ground truth byte by
    byte; and a report."""
    report = {}
    Path(out).mkdir(parents=True, exist_ok=True)
    if readers.TRUTH_FILE in inputs.files:
        shutil.copyfile(inputs.truth(), f"{out}/{readers.TRUTH_FILE}")
    for split in splits:
        for number in (1, 2, 3):
            raw = readers.raw_records(spark, inputs, split, number)
            cleaned = cleaning.check_ids(cleaning.clean_records(raw))
            sinks.write_parquet(cleaned, f"{out}/{split}_source{number}.parquet")
            if tsv:
                sinks.write_cleaned(spark.read.parquet(f"{out}/{split}_source{number}.parquet"), raw.columns, f"{out}/{split}_source{number}.tsv")
            found = cleaning.cleaning_report(spark.read.parquet(f"{out}/{split}_source{number}.parquet")).collect()
            report[f"{split}_source{number}"] = {r["country_key"]: {k: r[k] for k in ("rows", "name_missing", "address_missing", "address_component_missing")} for r in found}
    sinks.write_json(report, f"{out}/cleaning_report.json")
    return report


def records_of(tables: dict[int, DataFrame]) -> DataFrame:
    """Cleaned tables of sources 1 to 3 as one, projected to what the index needs."""
    parts = [guards.require_columns(t, INDEX_COLUMNS, f"source {n}").select(F.lit(n).alias("source"), *INDEX_COLUMNS) for n, t in sorted(tables.items())]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole


def prepare(spark: SparkSession, tables: dict[int, DataFrame], work_dir: str, config: Preparation, *, split: str = "train", truth: DataFrame | None = None, train_work: str | None = None, max_queries: int | None = None, stages=STAGES) -> Work:
    """Index, block, label (training), features, export. Test runs use the training run's weights."""
    inputs = {f"source{n}": table_identity(t) for n, t in sorted(tables.items())}
    if truth is not None:
        inputs["truth"] = table_identity(truth)
    if train_work is not None:
        inputs["tfidf"] = weights_identity(Work(spark, train_work))
    work = Work(spark, work_dir, {"config": config.as_dict(), "split": split, "max_queries": max_queries, "inputs": inputs, "code_sha256": code_sha256()})

    def index() -> None:
        for n, t in tables.items():
            cleaning.check_ids(t, n)
        records = records_of(tables)
        guards.require_unique(records, ["entity_id"], "the records")
        guards.require_rows(records.filter("source = 1"), "source 1")
        guards.require_rows(records.filter("source > 1"), "sources 2 and 3")
        stored = work.put("records", blocking.numbered(records))
        if split == "train":
            model = tfidf.fit(stored.filter("source > 1"), bits=config.hash_bits, hash_fn=config.hash_fn)
            work.put("idf", model.idf)
            work.say("tfidf", {"n": model.n, "rows": model.rows, "bits": model.bits, "hash_fn": model.hash_fn})

    def weights() -> tfidf.Tfidf:
        fitted = Work(spark, train_work) if train_work else work
        said = fitted.said("tfidf")
        return tfidf.Tfidf(fitted.table("idf"), said["n"], said["bits"], said["hash_fn"], said["rows"])

    def queries() -> DataFrame:
        found = work.table("records").filter("source = 1")
        return found.orderBy("rid").limit(max_queries) if max_queries else found

    def block() -> None:
        asked = queries()
        any_class = not asked.filter("country_key = ''").isEmpty()
        blocker = blocking.Blocker(work.table("records").filter("source > 1"), weights(), config.limits(), any_class)
        pairs, manifest = blocker.candidates(asked)
        pairs = work.put("candidate_pairs", pairs)
        manifest = work.put("queries", manifest)
        blocker.forget(everything=True)
        work.say("blocking_report", blocking.blocking_report(pairs, manifest))

    def label() -> None:
        known = labeling.parse_truth(truth)
        labeling.audit(known, work.table("queries"), work.table("records").filter("source > 1"))
        asked = labeling.assign_splits(work.table("queries"), known, seed=config.seed, fraction=config.validation_fraction, hash_fn="md5" if config.hash_fn == "md5" else "blake2b")
        labeled = work.put("labeled_pairs", labeling.label_pairs(work.table("candidate_pairs"), known, asked))
        labels = work.put("query_labels", labeling.query_labels(asked, labeled))
        rows = [r.asDict() for r in labeling.recall_report(labels).collect()]
        work.say("candidate_recall", sorted(rows, key=lambda r: (-r["grouping"], str(r["dataset_split"]), str(r["country"]))))

    def make_features() -> None:
        records = work.table("records")
        pairs = work.table("labeled_pairs" if split == "train" else "candidate_pairs")
        work.put("pair_features", features.extract(pairs, records.filter("source = 1"), records.filter("source > 1"), nan=True))

    def export() -> None:
        found, groups = work.table("pair_features"), ("train", "validation") if split == "train" else ("test",)
        report = {"queries": work.table("queries").count()}
        for group in groups:
            own = found.filter(F.col("dataset_split") == group) if split == "train" else found
            own = work.put(f"{group}_features", own)
            labeled = F.sum(F.col("label").cast("long")) if split == "train" else F.lit(None).cast("long")
            n, positive = own.agg(F.count(F.lit(1)), labeled).first()
            report[f"{group}_pairs"] = n
            if split == "train":
                report |= {f"{group}_positive_pairs": positive or 0, f"{group}_negative_pairs": n - (positive or 0)}
        if split == "train":
            labels = work.table("query_labels")
            report |= {f"{r['dataset_split']}_queries": r["count"] for r in labels.groupBy("dataset_split").count().collect()}
            work.export("query_labels.tsv.gz", labels.select("source1_entity_id", "country", "dataset_split", "matched_entity_ids"), ["source1_entity_id"])
        lists = labeling.candidate_lists(work.table("queries"), work.table("candidate_pairs"))
        work.export("candidate_pairs.tsv", work.put("candidate_lists", lists), ["source1_entity_id"])
        work.say("tables_report", report)

    steps = {"index": (index, (), ("records",)), "block": (block, ("index",), ("candidate_pairs", "queries")), "label": (label, ("block",), ("labeled_pairs", "query_labels")), "features": (make_features, ("label",) if split == "train" else ("block",), ("pair_features",)), "export": (export, ("features",), ("candidate_lists", *(("train_features", "validation_features") if split == "train" else ("test_features",))))}
    for stage in stages:
        if stage == "label" and split != "train":
            continue
        action, needs, outputs = steps[stage]
        work.run(stage, needs, outputs, action)
    return work


# ---------------------------------------------------------------- models


def weights_identity(work: Work) -> dict:
    """The TF-IDF weights of a training run, by content."""
    return content_identity(work.table("idf").select("field", "bucket", "df")) | work.said("tfidf")


MODEL_FILES = ("validation_f05.json", "feature_importance.tsv", "learning_curve.json")


def train(work: Work, model_dir: str, config: modeling.Training, names: list[str] | None = None) -> dict:
    """Fit, save, read back, score all validation pairs, choose the threshold; returns the model's metadata.

    A folder with a model of the same settings, inputs and code is complete, and read; one of others is refused.
    """
    names, spark = list(names or MODEL_COLUMNS), work.spark
    inputs = {t: table_identity(work.table(t)) for t in ("pair_features", "query_labels")}
    signature = json.loads(json.dumps({"config": asdict(config), "features": names, "inputs": inputs, "tfidf": weights_identity(work), "code_sha256": code_sha256()}))
    at = f"{model_dir}/model_metadata.json"
    if files.exists(spark, at):
        known = files.read_json(spark, at)
        if known["signature"] != signature:
            raise ValueError("training settings, inputs or code changed; take a new model folder")
        if known["status"] == "complete":
            load_model(spark, work, model_dir)
            if absent := [f for f in MODEL_FILES if not files.exists(spark, f"{model_dir}/{f}")]:
                raise ValueError(f"the model is complete, but {absent} are gone; take a new model folder")
            return known
    files.write_json(spark, {"status": "running", "signature": signature}, at)
    table = work.table("pair_features")
    rows, watched = table.filter("dataset_split = 'train'"), table.filter("dataset_split = 'validation'")
    fitted = modeling.train(rows, watched, names, config)
    modeling.save(fitted, f"{model_dir}/trees")
    model = modeling.load(spark, f"{model_dir}/trees")
    watch = modeling.training_rows(watched, names, config.max_early_stopping_pairs, config.seed + 1, "validation")
    files.write_json(spark, {"validation_log_loss": modeling.learning_curve(model, watch)}, f"{model_dir}/learning_curve.json")
    lines = ["feature\tgain\tsplits", *(f"{name}\t{gain!r}\t{splits}" for name, gain, splits in modeling.importance(model))]
    files.write_text(spark, "\n".join(lines) + "\n", f"{model_dir}/feature_importance.tsv")
    scores = work.put("validation_probabilities", modeling.predict(model, watched, names))
    found = evaluation.evaluate(work.table("query_labels"), watched, scores, config.thresholds)
    files.write_json(spark, found, f"{model_dir}/validation_f05.json")
    metadata = {
        "status": "complete", "signature": signature, "features": names, "model_sha256": modeling.model_identity(model, config), "trees": model.stages[1].getNumTrees, "decision_threshold": found["best"]["threshold"], "validation_macro_f05": found["best"]["macro_f05"],
        "train_rows": modeling.summary(rows, config.max_train_pairs), "early_stopping_rows": modeling.summary(watched, config.max_early_stopping_pairs), "final_validation_pairs": scores.count(), "validation_queries": found["queries"], "best": found["best"],
    }
    files.write_json(spark, metadata, at)
    return metadata


def load_model(spark: SparkSession, work: Work, model_dir: str):
    """A complete model and its metadata: its trees, its features and the weights of its training run
    must be those that it was evaluated with."""
    at = f"{model_dir}/model_metadata.json"
    known = files.read_json(spark, at) if files.exists(spark, at) else {}
    if known.get("status") != "complete":
        raise ValueError("training isn't complete")
    model = modeling.load(spark, f"{model_dir}/trees")
    config = modeling.Training(**known["signature"]["config"] | {"thresholds": tuple(known["signature"]["config"]["thresholds"])})
    if modeling.model_identity(model, config) != known["model_sha256"]:
        raise ValueError("the trees aren't those of the model's metadata")
    if list(modeling.feature_names(model)) != known["features"]:
        raise ValueError("the model's features aren't those of its metadata, in that order")
    fitted = work.manifest["signature"]["inputs"].get("tfidf") if work.manifest["signature"]["split"] != "train" else weights_identity(work)
    if json.loads(json.dumps(fitted)) != known["signature"]["tfidf"]:
        raise ValueError("these pairs were made with other TF-IDF weights than the model's")
    return model, known


def predict(work: Work, model_dir: str, names: list[str] | None = None) -> DataFrame:
    """Scores of all pairs of a run, and beside them what they come from."""
    model, known = load_model(work.spark, work, model_dir)
    table = work.table("pair_features")
    scores = work.put("probabilities", modeling.predict(model, table, list(names or known["features"])))
    n = scores.count()
    if n != table.count():
        raise ValueError("not every pair has a score")
    work.say("probabilities.metadata", {"model_sha256": known["model_sha256"], "source": table_identity(table), "rows": n, "threshold": known["decision_threshold"]})
    return scores


def submit(work: Work, scores: DataFrame, threshold: float, path: str) -> int:
    """Every query of source 1, one line each."""
    check_complete(work)
    scored = evaluation.covered(work.table("candidate_pairs"), scores)
    return sinks.write_tsv(evaluation.submission(work.table("queries"), scored, threshold), path, ["source1_entity_id"])


def check_complete(work: Work) -> None:
    """A submission needs every query of source 1."""
    if work.table("queries").count() != work.table("records").filter("source = 1").count():
        raise ValueError("the run doesn't hold every query")


SAMPLE_NOTE = """A sample for development.

Training queries are drawn at random within each country; all their known matches are kept, and other records drawn
at random beside them. So country shares aren't those of the full data, and validation on a sample is optimistic.
Test records are drawn within each country and source; their true matches needn't be among them.
sample_summary.json describes the full files and the sample.
"""


def sample(spark: SparkSession, inputs: readers.Inputs, out: str, *, per_country: int = 5000, distractors: int = 5000, seed: int = 42) -> dict:
    """A sample that keeps all true matches of its queries, as TSV files and one new ZIP file."""
    inputs.require()
    staged, summary, made = Path(out).with_suffix(".files"), {}, {}
    staged.mkdir(parents=True, exist_ok=False)

    def put(name: str, df: DataFrame, order: list[str]) -> None:
        made[name] = str(staged / name)
        summary[name] = sinks.write_tsv(df, made[name], order)

    sizes, full = inputs.sizes(), {}

    def describe(name: str, df: DataFrame) -> None:
        found = sampling.profile(df, list(RAW_COLUMNS)).first().asDict()
        countries = {r["country"]: r["rows"] for r in sampling.country_counts(df).collect()}
        size = next((v for k, v in sizes.items() if k in (name, f"{name}.gz")), None)
        full[name] = {"rows": found["rows"], "bytes": size, "country_counts": countries, "blank_field_counts": {c: found[f"blank_{c}"] for c in RAW_COLUMNS}}

    describe("train_source1.tsv", readers.raw_records(spark, inputs, "train", 1))
    queries = sampling.sample_per_group(cleaning.check_ids(readers.raw_records(spark, inputs, "train", 1), 1), "country", "entity_id", per_country, seed=seed).persist()
    put("train_source1.tsv", queries.select(*RAW_COLUMNS), ["entity_id"])
    truth = labeling.parse_truth(readers.truth(spark, inputs.truth())).persist()
    matches = {r["matches"]: r["queries"] for r in sampling.match_histogram(truth).collect()}
    total = sum(matches.values())
    full["train_ground_truth.tsv"] = {"rows": total, "singleton_rows": matches.get(0, 0), "singleton_fraction": matches.get(0, 0) / total if total else None, "matches_per_entity_histogram": {str(k): v for k, v in sorted(matches.items())}}
    for n in (2, 3):
        references = cleaning.check_ids(readers.raw_records(spark, inputs, "train", n), n)
        describe(f"train_source{n}.tsv", references)
        prefix = f"S{n}-"
        own = truth.withColumn("ids", F.filter("ids", lambda x: x.startswith(prefix)))  # noqa: B023
        _, kept = sampling.sample_links(queries, own, references, distractors, seed=seed + n)
        put(f"train_source{n}.tsv", kept.select(*RAW_COLUMNS), ["entity_id"])
    kept_truth = truth.join(queries.select(F.col("entity_id").alias("sid")), "sid", "left_semi")
    put("train_ground_truth.tsv", kept_truth.select(F.col("sid").alias("source1_entity_id"), F.array_join("ids", ",").alias("matched_entity_ids")), ["source1_entity_id"])
    for n in (1, 2, 3):
        rows = readers.raw_records(spark, inputs, "test", n)
        describe(f"test_source{n}.tsv", rows)
        put(f"test_source{n}.tsv", sampling.sample_per_group(rows, "country", "entity_id", per_country, seed=seed + 10 + n).select(*RAW_COLUMNS), ["entity_id"])
    settings = {"seed": seed, "per_country": per_country, "distractors": distractors}
    sinks.write_json({"settings": settings, "full_dataset": full, "sample": summary}, str(staged / "sample_summary.json"))
    (staged / "SAMPLE_README.txt").write_text(SAMPLE_NOTE, encoding="utf-8")
    named = {f"dataset/{n.partition('_')[0]}/{n}": p for n, p in made.items()} | {f: str(staged / f) for f in ("sample_summary.json", "SAMPLE_README.txt")}
    named |= {f"utils/{n}" if n.endswith(".py") else n: p for n, p in inputs.extras().items()}
    sinks.zip_files(named, out)
    queries.unpersist()
    truth.unpersist()
    return summary


def baseline(spark: SparkSession, location: str, out: str, config: Preparation = Preparation(), training: modeling.Training = modeling.Training()) -> dict:
    """Raw input to submission."""
    inputs = readers.Inputs(location, f"{out}/staging").require()
    Path(out).mkdir(parents=True, exist_ok=True)
    sinks.write_json({n: file_identity(p) for n, p in inputs.files.items()}, f"{out}/inputs.json")
    clean(spark, inputs, f"{out}/cleaned")
    tables = {s: {n: spark.read.parquet(f"{out}/cleaned/{s}_source{n}.parquet") for n in (1, 2, 3)} for s in ("train", "test")}
    first = prepare(spark, tables["train"], f"{out}/train", config, truth=readers.truth(spark, inputs.truth()))
    found = train(first, f"{out}/model", training)
    second = prepare(spark, tables["test"], f"{out}/test", config, split="test", train_work=f"{out}/train")
    scores = predict(second, f"{out}/model")
    rows = submit(second, scores, found["decision_threshold"], f"{out}/matching_results.tsv")
    return {"best": found["best"], "queries": rows}
