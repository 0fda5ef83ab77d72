"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read back as the next
one's ``docs``. All but the last return the columns that they were given, whatever others there are
beside ``doc_id`` and ``text``; ``n_chars`` follows the text where it changes. An empty table gives an
empty one. What each does with nulls, ties and repeated rows is said with it. Ids are whole numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmatch.llm.chain import cut_passages
from kinmatch.llm.common import fresh_name, write_table
from kinmatch.llm.decontaminate import drop_contaminated
from kinmatch.llm.langid import UNKNOWN, held_out, identify, train
from kinmatch.llm.packing import pack
from kinmatch.llm.simhash import drop_near_duplicates

#: Below this share the best language isn't believed.
MIN_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without letters (null and empty texts too), or in none
    of the languages, go. Repeated rows all stay or all go; of equally likely languages the first by name
    counts. If nothing is labelled there is no language to tell, and all go."""
    model = train(docs.filter(~held_out()))
    pred, score = fresh_name(docs, "lang"), fresh_name(docs, "score")
    told = identify(docs, model, pred_col=pred, score_col=score)
    return told.filter((F.col(pred) != UNKNOWN) & (F.col(score) >= MIN_SCORE)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id, a null id being the largest.
    Of repeated rows (equal in id and text) one stays. Texts that are null or have no words are copies of
    each other."""
    return drop_near_duplicates(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that a document with a smaller id has; those left empty by that go. Null
    and empty texts, documents with a null id, and repeats between rows of one id stay as they are."""
    cut = cut_passages(docs)
    if "n_chars" in cut.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return cut.select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark. Null and empty texts hold none; repeated rows all
    stay or all go; an empty benchmark lets all stay."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens. A null or empty text is its end token;
    repeated rows are packed each."""
    return pack(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("decontamination", decontamination), ("packing", packing)]

#: Language scores, fingerprints and tokens can't be had in SQL; tests hold each stage to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
