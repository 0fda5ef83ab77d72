"""Truth, splits and what retrieval kept of it. Every report starts from the queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmatch.functions.hashing import in_validation
from kinmatch.operators.guards import forbid, require_keys


def truth_ids(raw: Column | str) -> Column:
    """A comma-joined list as an array, trimmed, without blanks."""
    return F.filter(F.transform(F.split(raw, ","), lambda x: F.trim(x)), lambda x: x != "")


def parse_truth(truth: DataFrame) -> DataFrame:
    """``sid, ids``; ids that repeat or aren't of a reference source are errors."""
    parsed = truth.select(F.col("source1_entity_id").alias("sid"), truth_ids(F.coalesce("matched_entity_ids", F.lit(""))).alias("ids"))
    foreign = F.exists("ids", lambda x: ~(x.startswith("S2-") | x.startswith("S3-")))
    once = parsed.groupBy("sid").agg(F.count(F.lit(1)).alias("rows"), F.bool_or(F.size("ids") != F.size(F.array_distinct("ids"))).alias("twice"), F.bool_or(foreign).alias("foreign"))
    forbid(once, (F.col("twice"), "the truth lists an id twice"), (F.col("foreign"), "the truth lists an id that isn't of source 2 or 3"), (F.col("rows") > 1, "the truth repeats"))
    return parsed


def edges(truth: DataFrame) -> DataFrame:
    return truth.select("sid", F.explode("ids").alias("eid"))


def audit(truth: DataFrame, queries: DataFrame, references: DataFrame) -> None:
    """Each query has truth, and each of its true references exists."""
    require_keys(queries, truth.select(F.col("sid").alias("source1_entity_id")), ["source1_entity_id"], "a query without truth")
    asked = edges(truth.join(queries.select(F.col("source1_entity_id").alias("sid")), "sid", "left_semi"))
    require_keys(asked, references.select(F.col("entity_id").alias("eid")), ["eid"], "a true reference that isn't in sources 2 and 3")


def assign_splits(manifest: DataFrame, truth: DataFrame, *, seed: int = 42, fraction: float = 0.2, hash_fn: str = "blake2b") -> DataFrame:
    """The manifest with ``ids`` and ``dataset_split``, a property of the query alone."""
    known = truth.withColumnRenamed("sid", "source1_entity_id")
    drawn = in_validation(F.col("source1_entity_id"), F.col("country"), F.size("ids") > 0, seed, fraction, hash_fn)
    return manifest.join(known.hint("merge"), "source1_entity_id").withColumn("dataset_split", F.when(drawn, "validation").otherwise("train"))


def label_pairs(pairs: DataFrame, truth: DataFrame, queries: DataFrame) -> DataFrame:
    """Pairs with ``label`` and ``dataset_split``. Nothing that grows is sent to the driver for the joins."""
    true = edges(truth).select(F.col("sid").alias("source1_entity_id"), F.col("eid").alias("candidate_entity_id"), F.lit(1).alias("hit"))
    splits = queries.select("source1_entity_id", "dataset_split")
    labeled = pairs.join(true.hint("merge"), ["source1_entity_id", "candidate_entity_id"], "left").join(splits.hint("merge"), "source1_entity_id")
    return labeled.select(*pairs.columns, F.coalesce("hit", F.lit(0)).cast("byte").alias("label"), "dataset_split")


def query_labels(queries: DataFrame, labeled: DataFrame) -> DataFrame:
    """Every query with its numbers of candidates, true links and retrieved true links."""
    hits = labeled.groupBy("source1_entity_id").agg(F.sum(F.col("label").cast("long")).alias("retrieved_true_links"))
    return queries.join(hits.hint("merge"), "source1_entity_id", "left").select(
        "source1_entity_id", "country", "dataset_split", F.array_join("ids", ",").alias("matched_entity_ids"), F.col("n_candidates").cast("long").alias("n_candidates"), F.size("ids").cast("long").alias("true_links"),
        F.coalesce("retrieved_true_links", F.lit(0)).cast("long").alias("retrieved_true_links"),
    )


def oracle_f05(true_links: Column, retrieved: Column) -> Column:
    """The best F0.5 that a perfect choice among the candidates can have."""
    return F.when(true_links == 0, 1.0).otherwise(5 * retrieved / (4 * retrieved + true_links))


def recall_report(labels: DataFrame) -> DataFrame:
    """Over all queries, by split, by country, and by both, in one cube. ``grouping`` tells the four
    apart: a country may itself be empty."""
    n, h = F.col("true_links"), F.col("retrieved_true_links")
    found = labels.cube("dataset_split", "country").agg(
        F.grouping_id().cast("int").alias("grouping"), F.count(F.lit(1)).alias("queries"), F.sum(n).alias("true_links"), F.sum(h).alias("retrieved_true_links"), F.count_if(n > 0).alias("queries_with_matches"),
        F.count_if((n > 0) & (n == h)).alias("queries_all_matches_retrieved"), F.count_if(n == 0).alias("singleton_queries"), F.sum("n_candidates").alias("candidate_pairs"),
        F.avg(oracle_f05(n, h)).alias("oracle_macro_f05_ceiling"),
    )
    return found.withColumns(
        {
            "candidate_recall": F.try_divide(F.col("retrieved_true_links"), F.col("true_links")),
            "all_matches_retrieved_rate": F.try_divide(F.col("queries_all_matches_retrieved"), F.col("queries_with_matches")),
            "positive_pairs": F.col("retrieved_true_links"),
            "negative_pairs": F.col("candidate_pairs") - F.col("retrieved_true_links"),
        }
    )


def lost_links(truth: DataFrame, pairs: DataFrame) -> DataFrame:
    """``sid, eid``: true links that retrieval didn't find."""
    found = pairs.select(F.col("source1_entity_id").alias("sid"), F.col("candidate_entity_id").alias("eid"))
    return edges(truth).join(found.hint("merge"), ["sid", "eid"], "left_anti")


def split_report(labeled: DataFrame) -> DataFrame:
    """Pairs, queries and positives of each split."""
    return labeled.groupBy("dataset_split").agg(F.count(F.lit(1)).alias("pairs"), F.countDistinct("source1_entity_id").alias("queries"), F.sum(F.col("label").cast("long")).alias("positives"))


def candidate_lists(manifest: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row a query, its candidates in rank order, empty where it has none; counts must agree."""
    lists = pairs.groupBy("source1_entity_id").agg(F.array_sort(F.collect_list(F.struct("candidate_rank", "candidate_entity_id"))).alias("c"))
    joined = manifest.withColumn("asked", F.lit(True)).join(lists, "source1_entity_id", "full_outer").withColumn("c", F.coalesce("c", F.expr("array()")))
    forbid(
        joined,
        (F.col("asked").isNull(), "pairs of a query that isn't in the manifest"),
        (F.size("c") != F.col("n_candidates"), "a query whose candidates aren't as many as its manifest says"),
        (F.size(F.array_distinct(F.transform("c", lambda x: x["candidate_entity_id"]))) != F.size("c"), "a query that has a candidate twice"),
    )
    return joined.select("source1_entity_id", F.array_join(F.transform("c", lambda x: x["candidate_entity_id"]), ",").alias("candidate_entity_ids"))
