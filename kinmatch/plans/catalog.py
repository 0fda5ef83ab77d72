"""The engine's operators as queries over the driver's tables, with SQL that checks them.

``documents`` stands in for business records: source, name, address and country follow from a
document's id, words, length and language, so that copies and near copies of documents are records
that match. Half of the names begin alike, so that blocks overflow; some records have no country. Two records are a true match if their documents are equally
long, which copies are, and some that retrieval can't find. All limits are those of production.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmatch.functions import similarity as S
from kinmatch.functions import text as T
from kinmatch.functions.constants import CHANNELS, FEATURES, MODEL_COLUMNS
from kinmatch.operators import cleaning, evaluation, features, labeling, modeling, sampling, tfidf
from kinmatch.operators.blocking import Blocker, Limits, of_portion, portions
from kinmatch.sources import files
from kinmatch.sources.staging import staged, staged_parts

THRESHOLDS = (0.2, 0.5, 0.8, 1.0)


# ---------------------------------------------------------------- records


def raw_records(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang")
    w = F.split(F.trim(F.regexp_replace("text", "[^A-Za-z]+", " ")), " ")
    word = lambda i: F.coalesce(F.get(F.col("w"), i), F.lit(""))
    n = F.col("n")
    suffix = F.element_at(F.array(*[F.lit(s) for s in ("", " Ltd", " Pvt. Ltd.", " Inc", " Co")]), (F.col("doc_id") % 5 + 1).cast("int"))
    number = n.cast("string")
    address = (
        F.when(F.col("lang") == "en", F.concat(F.lpad(number, 4, "0"), F.lit(" "), word(3), F.lit(" St, "), word(4), F.lit(" city, TX "), (78700 + n).cast("string")))
        .when(F.col("lang") == "de", F.concat(F.lit("Plot "), number, F.lit(" Nr "), word(3), F.lit(", "), word(4), F.lit(" nagar, Maharashtra, "), (400000 + n).cast("string")))
        .when(F.col("lang") == "fr", F.concat(number, F.lit(" av "), word(3), F.lit(", "), (75000 + n).cast("string"), F.lit(" Paris")))
        .otherwise(F.concat(number, F.lit(" "), word(3), F.lit(" rd")))
    )
    country = F.when(F.col("doc_id") % 29 == 3, "").when(F.col("lang") == "en", "United States").when(F.col("lang") == "de", "India").when(F.col("lang") == "fr", "France").otherwise("Peru")
    base = docs.withColumns({"w": w, "n": F.length("text") % 97 + 1, "source": (F.col("doc_id") % 3 + 1).cast("int")})
    return base.select(
        F.concat(F.lit("S"), F.col("source").cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"), "source", (F.col("source").cast("long") * 10**12 + F.col("doc_id")).alias("rid"),
        F.concat(F.when(F.col("doc_id") % 2 == 0, "The ").otherwise(""), F.array_join(F.slice("w", 1, 3), " "), suffix).alias("business_name"), address.alias("business_address"), country.alias("country"), "text",
    )


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_records(raw_records(spark, sf))


_made: dict[tuple[str, str, str], tuple[object, Callable[[], list[DataFrame]]]] = {}


def _once(name: str, spark: SparkSession, sf: str, make: Callable[[], object], tables: Callable[[object], list[DataFrame]]):
    """What a session has prepared is made once for all its queries, and again if its tables are gone."""
    key = (name, spark.sparkContext.applicationId, sf)
    if key in _made and all(files.exists(spark, f) for t in _made[key][1]() for f in t.inputFiles()[:1]):
        return _made[key][0]
    found = make()
    _made[key] = found, lambda: tables(found)
    return found


def records(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned records."""
    return _once("records", spark, sf, lambda: staged(cleaned(spark, sf).drop("text"), "records"), lambda t: [t])


def queries_of(r: DataFrame) -> DataFrame:
    return r.filter("source = 1")


def references_of(r: DataFrame) -> DataFrame:
    return r.filter("source > 1")


def truth_of(spark: SparkSession, sf: str) -> DataFrame:
    """Ground truth as a file has it: every query, the ids of its matches joined by commas."""
    raw = raw_records(spark, sf).select("entity_id", "source", F.length("text").alias("t"))
    ids = references_of(raw).groupBy("t").agg(F.array_join(F.array_sort(F.collect_list("entity_id")), ",").alias("matched_entity_ids"))
    return queries_of(raw).join(ids.hint("merge"), "t", "left").select(F.col("entity_id").alias("source1_entity_id"), F.coalesce("matched_entity_ids", F.lit("")).alias("matched_entity_ids"))


def blocker_of(spark: SparkSession, sf: str, retrieval: str = "rowid") -> Blocker:
    """The references, indexed."""

    def make() -> Blocker:
        refs = references_of(records(spark, sf))
        return Blocker(refs, tfidf.fit(refs, hash_fn="md5"), Limits(retrieval=retrieval))

    return _once(f"blocker {retrieval}", spark, sf, make, lambda b: [records(spark, sf), *b._tables])


def read_of(spark: SparkSession, sf: str) -> DataFrame:
    """The queries, as retrieval reads them."""
    blocker = blocker_of(spark, sf)
    return _once("read", spark, sf, lambda: blocker.read(queries_of(records(spark, sf))), lambda t: [t, *blocker._tables])


def hits_of(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Hits of channels A to D, those that overflow by their fallback, and what overflowed."""
    blocker, read = blocker_of(spark, sf), read_of(spark, sf)
    return _once("hits", spark, sf, lambda: blocker.kept_hits(read), lambda t: [*t, read])


def pool_of(spark: SparkSession, sf: str) -> DataFrame:
    blocker, read = blocker_of(spark, sf), read_of(spark, sf)
    return _once("pool", spark, sf, lambda: blocker.lexical_pool(read), lambda t: [t, read])


def cosines_of(spark: SparkSession, sf: str) -> DataFrame:
    """Both cosines of all pairs of any channel."""
    blocker, read, (keyed, _), pool = blocker_of(spark, sf), read_of(spark, sf), hits_of(spark, sf), pool_of(spark, sf)
    return _once("cosines", spark, sf, lambda: blocker.cosines(keyed, pool, read), lambda t: [t, keyed, pool])


def run_of(spark: SparkSession, sf: str) -> Run:
    return _once("run", spark, sf, lambda: Run(spark, sf), lambda r: [r.records, *r.blocker._tables])


class Run:
    """Records, candidates with a probability, and the manifest, which many queries start from."""

    def __init__(self, spark: SparkSession, sf: str):
        self.records, self.blocker = records(spark, sf), blocker_of(spark, sf)
        self.chosen, self.manifest = self.blocker.ranked(queries_of(self.records), *hits_of(spark, sf), pool_of(spark, sf), read_of(spark, sf))
        # what retrieval gives stands in for a model's probability
        self.pairs = self.chosen.withColumn("match_probability", F.round(F.least(F.lit(1.0), F.col("retrieval_score").cast("double")), 6))

    def truth(self, spark: SparkSession, sf: str) -> DataFrame:
        return labeling.parse_truth(truth_of(spark, sf))

    def labels(self, spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
        truth = self.truth(spark, sf)
        asked = labeling.assign_splits(self.manifest, truth, hash_fn="md5")
        labeled = labeling.label_pairs(self.pairs, truth, asked)
        return labeled, labeling.query_labels(asked, labeled)

    def sides(self, pairs: DataFrame) -> DataFrame:
        """Pairs with both records, as ``a`` and ``b``."""
        side = lambda x, name, alias: x.select(F.col("entity_id").alias(name), F.struct(*x.columns).alias(alias)).hint("merge")
        return pairs.join(side(queries_of(self.records), "source1_entity_id", "a"), "source1_entity_id").join(side(references_of(self.records), "candidate_entity_id", "b"), "candidate_entity_id")


def _in_portions(run: Run, pairs: DataFrame, make: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """What is made of pairs and both of their records, which the joins copy to each pair: in portions of queries, so that
    the copies of no more than one are on disk."""
    n = portions(queries_of(run.records))
    return staged_parts([make(pairs.filter(of_portion("source1_entity_id", i, n))) for i in range(n)], name)


# ---------------------------------------------------------------- queries


def er_profile(spark, sf):
    found = sampling.profile(raw_records(spark, sf), ["business_name", "business_address", "country"], "source")
    return found.select(F.col("source").cast("long").alias("source"), "rows", "countries", "blank_business_name", "blank_business_address", "blank_country")


def er_country_counts(spark, sf):
    return sampling.country_counts(raw_records(spark, sf), "source").select(F.col("source").cast("long").alias("source"), "country", "rows")


def er_country_hist(spark, sf):
    return cleaning.cleaning_report(cleaned(spark, sf))


def er_clean_name(spark, sf):
    return cleaned(spark, sf).select("entity_id", "name_basic", "name_expanded", "name_without_suffix", "name_token_key", "name_compact", F.col("name_missing").cast("long").alias("name_missing"))


def er_clean_address(spark, sf):
    kept = cleaned(spark, sf).select(
        "entity_id", "country_key", "address_basic", "address_normalized", "address_latin_folded", "address_tokens", "address_numbers", "address_numbers_zero_normalized", F.col("house_number_candidate").alias("house"), F.col("house_number_zero_normalized").alias("house_zero"),
        F.col("postal_code_candidate").alias("postal"), F.col("state_candidate").alias("state"), F.col("city_candidate").alias("city"), F.col("street_candidate").alias("street"), F.col("locality_candidate").alias("locality"), F.col("address_missing").cast("long").alias("missing"), F.col("address_component_missing").cast("long").alias("component_missing"),
    )
    return kept


def er_zero_norm(spark, sf):
    return raw_records(spark, sf).select("entity_id", T.zero_normalize("business_address").alias("address"))


def er_part_name_tokens(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet")
    return part.select("p_partkey", T.sorted_words(F.lower("p_name")).alias("token_key"), F.size(T.grams(F.lower("p_name"))).cast("long").alias("grams"))


def er_tokens(spark, sf):
    return cleaned(spark, sf).select(F.explode(T.words("name_basic")).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def er_grams3(spark, sf):
    return cleaned(spark, sf).select(F.explode(T.grams("name_without_suffix")).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))


def _channel(channel):
    def run(spark, sf):
        """Hits of a channel, those that overflow by their fallback."""
        hits, _ = hits_of(spark, sf)
        return hits.filter(F.col("channel") == channel).select("sid", "rid")

    return run


def er_block_overflow(spark, sf):
    r = records(spark, sf)
    blocker = Blocker(references_of(r), None, Limits())
    return blocker.key_matches(blocker.read(queries_of(r))).filter(F.col("n") > blocker.limits.block_limit).select("sid", "channel").distinct()


def er_token_pool(spark, sf):
    return pool_of(spark, sf)


def er_query_tokens(spark, sf):
    r = records(spark, sf)
    found = tfidf.indexed(queries_of(r), tfidf.fit(references_of(r), hash_fn="md5"), Limits().query_terms)
    return found.select("entity_id", F.explode("asked").alias("t")).select("entity_id", "t.*")


def er_df_idf(spark, sf):
    return tfidf.fit(references_of(records(spark, sf)), hash_fn="md5").idf.select("field", "bucket", "df", F.round("idf", 5).alias("idf"))


def er_tfidf_vectors(spark, sf):
    r = records(spark, sf)
    found = tfidf.entries(tfidf.vectors(r, tfidf.fit(references_of(r), hash_fn="md5")))
    return found.select("entity_id", "field", "bucket", F.round("value", 5).alias("value"))


def er_cosine(spark, sf):
    """Both cosines of all pairs of any channel."""
    return cosines_of(spark, sf).select("sid", "eid", F.round("nc", 5).alias("name_cosine"), F.round("ac", 5).alias("address_cosine"))


def er_channel_union(spark, sf):
    """All six channels of the chosen pairs."""
    pairs = run_of(spark, sf).pairs
    return pairs.select("source1_entity_id", "candidate_entity_id", *[F.col(f"block_{c}").cast("long").alias(f"block_{c}") for c in CHANNELS])


def er_candidates(spark, sf, retrieval="rowid"):
    """All six channels, ranked and capped."""
    if retrieval == "bm25":
        return blocker_of(spark, sf, retrieval).candidates(queries_of(records(spark, sf)))[0]
    pairs = run_of(spark, sf).chosen
    rounded = {c: F.round(F.col(c).cast("double"), 4) for c in ("retrieval_score", "name_retrieval_cosine", "address_retrieval_cosine")}
    return pairs.withColumns(rounded | {c: F.col(c).cast("long") for c in ("candidate_source", "candidate_rank", *(f"block_{c}" for c in CHANNELS))})


def er_manifest(spark, sf):
    run = run_of(spark, sf)
    return run.manifest.select("source1_entity_id", "country", *[F.col(c).cast("long").alias(c) for c in ("n_candidates", "union_candidates")], "overflow_blocks")


def er_rank_cap(spark, sf):
    return run_of(spark, sf).pairs.select("source1_entity_id", "candidate_entity_id", F.col("candidate_rank").cast("long").alias("candidate_rank"))


def er_similarities(spark, sf):
    run = run_of(spark, sf)
    a, b = F.col("a.name_basic"), F.col("b.name_basic")
    r6 = lambda c: F.round(c, 6)
    made = lambda pairs: run.sides(pairs).select(
        "source1_entity_id", "candidate_entity_id", r6(S.levenshtein_ratio(a, b)).alias("levenshtein"), S.edit_distance(F.col("a.address_normalized"), F.col("b.address_normalized")).cast("long").alias("edits"), r6(S.word_jaccard(a, b)).alias("jaccard"),
        r6(S.gram_jaccard(a, b)).alias("gram_jaccard"), S.exact(a, b).alias("same"), r6(S.length_ratio(a, b)).alias("length_ratio"), r6(S.jaro_winkler(a, b)).alias("jaro_winkler"),
    )
    return _in_portions(run, run.pairs, made, "similarities")


def er_features(spark, sf):
    """All features of all candidates."""
    run = run_of(spark, sf)
    shown = ["source1_entity_id", "candidate_entity_id", *[F.round(F.col(c).cast("double"), 4).alias(c) for c in FEATURES]]
    return _in_portions(run, run.pairs, lambda pairs: features.extract(pairs, queries_of(run.records), references_of(run.records)).select(*shown), "features")


def er_truth(spark, sf):
    return labeling.edges(labeling.parse_truth(truth_of(spark, sf)))


def er_label(spark, sf):
    labeled, _ = run_of(spark, sf).labels(spark, sf)
    return labeled.select("source1_entity_id", "candidate_entity_id", F.col("label").cast("long").alias("label"), "dataset_split")


def er_label_audit(spark, sf):
    run = run_of(spark, sf)
    return labeling.lost_links(run.truth(spark, sf), run.pairs)


def er_split(spark, sf):
    return run_of(spark, sf).labels(spark, sf)[1].select("source1_entity_id", "country", "dataset_split", "n_candidates", "true_links", "retrieved_true_links")


def er_recall_report(spark, sf):
    r = labeling.recall_report(run_of(spark, sf).labels(spark, sf)[1])
    return r.select(F.col("grouping").cast("long").alias("grouping"), "dataset_split", "country", "queries", "true_links", "retrieved_true_links", "queries_with_matches", "queries_all_matches_retrieved", "singleton_queries", "candidate_pairs", F.round("candidate_recall", 6).alias("candidate_recall"), F.round("oracle_macro_f05_ceiling", 6).alias("ceiling"))


def er_oracle_ceiling(spark, sf):
    return run_of(spark, sf).labels(spark, sf)[1].agg(F.round(F.avg(labeling.oracle_f05(F.col("true_links"), F.col("retrieved_true_links"))), 6).alias("ceiling"))


def _swept(spark, sf):
    run = run_of(spark, sf)
    _, labels = run.labels(spark, sf)
    return evaluation.sweep(labels, evaluation.covered(run.pairs, run.pairs.select(*evaluation.PAIR, "match_probability")), THRESHOLDS)


def er_threshold_sweep(spark, sf):
    return _swept(spark, sf).select("threshold", "country", "queries", F.round("macro_f05", 6).alias("macro_f05"))


def er_best_threshold(spark, sf):
    return evaluation.best_threshold(_swept(spark, sf)).select("threshold", F.round("macro_f05", 6).alias("macro_f05"))


def er_candidate_list(spark, sf):
    run = run_of(spark, sf)
    return labeling.candidate_lists(run.manifest, run.pairs)


def er_submission(spark, sf):
    run = run_of(spark, sf)
    return evaluation.submission(run.manifest, run.pairs, 0.5)


def er_sample_stratified(spark, sf):
    return sampling.sample_per_group(queries_of(raw_records(spark, sf)), "country", "entity_id", 20, hash_fn="md5").select("entity_id", "country")


def er_retain_matches(spark, sf):
    raw = staged(raw_records(spark, sf).drop("text"), "raw")
    chosen = sampling.sample_per_group(queries_of(raw), "country", "entity_id", 20, hash_fn="md5")
    _, kept = sampling.sample_links(chosen, labeling.parse_truth(truth_of(spark, sf)), references_of(raw), 10, hash_fn="md5")
    return kept.select("entity_id", "country")


def er_match_histogram(spark, sf):
    return sampling.match_histogram(labeling.parse_truth(truth_of(spark, sf))).select("matches", "queries", F.round("share", 6).alias("share"))


def er_clean_unicode(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs.select("doc_id", T.unicode_normalize("text").alias("normalized"), T.basic("text").alias("basic"))


def er_latin_fold(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", T.latin_fold(T.unicode_normalize("text")).alias("folded"))


def er_sequence_ratio(spark, sf):
    run = run_of(spark, sf)
    return _in_portions(run, run.pairs.select("source1_entity_id", "candidate_entity_id"), lambda pairs: features.prototype_features(run.sides(pairs)).drop("a", "b"), "ratios")


def er_train_predict(spark, sf):
    """A model of all columns, fitted with production settings, and its scores of all pairs."""
    run = run_of(spark, sf)
    labeled, _ = run.labels(spark, sf)
    table = staged(features.extract(labeled.drop("match_probability"), queries_of(run.records), references_of(run.records), nan=True), "features")
    names = list(MODEL_COLUMNS)
    model = modeling.train(table.filter("dataset_split = 'train'"), table.filter("dataset_split = 'validation'"), names, modeling.Training())
    return modeling.predict(model, table, names)


# ---------------------------------------------------------------- SQL

_LEGAL = "CASE x WHEN 'pvt' THEN 'private' WHEN 'ltd' THEN 'limited' WHEN 'corp' THEN 'corporation' WHEN 'co' THEN 'company' WHEN 'inc' THEN 'incorporated' ELSE x END"
_REC = f"""
base AS (
  SELECT doc_id, lang, coalesce(text, '') AS text, 1 + doc_id % 3 AS source, length(coalesce(text, '')) % 97 + 1 AS n,
    string_split(trim(regexp_replace(coalesce(text, ''), '[^A-Za-z]+', ' ', 'g')), ' ') AS w FROM documents),
raw AS (
  SELECT 'S' || source || '-' || doc_id AS entity_id, source, source * 1000000000000 + doc_id AS rid, text, n,
    CASE WHEN doc_id % 2 = 0 THEN 'The ' ELSE '' END || array_to_string(w[1:3], ' ') || (['', ' Ltd', ' Pvt. Ltd.', ' Inc', ' Co'])[doc_id % 5 + 1] AS business_name,
    CASE WHEN doc_id % 29 = 3 THEN '' WHEN lang = 'en' THEN 'United States' WHEN lang = 'de' THEN 'India' WHEN lang = 'fr' THEN 'France' ELSE 'Peru' END AS country,
    CASE WHEN doc_id % 29 = 3 THEN '' WHEN lang = 'en' THEN 'US' WHEN lang = 'de' THEN 'IN' WHEN lang = 'fr' THEN 'FR' ELSE 'PERU' END AS country_key, lang,
    coalesce(w[4], '') AS w3, coalesce(w[5], '') AS w4,
    CASE lang WHEN 'en' THEN lpad(CAST(n AS VARCHAR), 4, '0') || ' ' || coalesce(w[4], '') || ' St, ' || coalesce(w[5], '') || ' city, TX ' || (78700 + n)
      WHEN 'de' THEN 'Plot ' || n || ' Nr ' || coalesce(w[4], '') || ', ' || coalesce(w[5], '') || ' nagar, Maharashtra, ' || (400000 + n)
      WHEN 'fr' THEN n || ' av ' || coalesce(w[4], '') || ', ' || (75000 + n) || ' Paris'
      ELSE n || ' ' || coalesce(w[4], '') || ' rd' END AS business_address
  FROM base),
name1 AS (
  SELECT *, lower(trim(business_name)) IN ('', 'null', 'none', 'na', 'nan') AS miss, trim(regexp_replace(lower(business_name), '[^a-z]+', ' ', 'g')) AS b FROM raw),
name2 AS (
  SELECT *, CASE WHEN miss THEN '' ELSE b END AS name_basic,
    CASE WHEN miss THEN '' ELSE array_to_string(list_transform(string_split(b, ' '), lambda x: {_LEGAL}), ' ') END AS name_expanded FROM name1),
name3 AS (
  SELECT *, trim(regexp_replace(' ' || name_expanded, '( (private|limited|corporation|company|incorporated|llp|llc|plc|sarl|sas|sasu|eurl))+$', '')) AS core,
    lower(w3) AS a3, lower(w4) AS a4 FROM name2),
plain AS (
  SELECT *, trim(regexp_replace(lower(replace(business_address, ',', ' ')), ' +', ' ', 'g')) AS address_basic FROM name3),
rec AS (
  SELECT *, CASE WHEN core <> '' THEN core ELSE name_basic END AS nt,
    CASE WHEN country_key = 'US' AND a3 <> '' THEN regexp_replace(address_basic, '^([0-9]+ [a-z]+) st ', '\\1 street ')
      WHEN country_key = 'IN' THEN regexp_replace(address_basic, ' nr ', ' near ')
      WHEN country_key = 'FR' THEN regexp_replace(address_basic, ' av ', ' avenue ') ELSE address_basic END AS address,
    CASE lang WHEN 'en' THEN lpad(CAST(n AS VARCHAR), 4, '0') ELSE CAST(n AS VARCHAR) END AS house_raw, CAST(n AS VARCHAR) AS house,
    CASE country_key WHEN 'US' THEN CAST(78700 + n AS VARCHAR) WHEN 'IN' THEN CAST(400000 + n AS VARCHAR) WHEN 'FR' THEN CAST(75000 + n AS VARCHAR) ELSE '' END AS postal,
    CASE country_key WHEN 'US' THEN 'TX' WHEN 'IN' THEN 'maharashtra' ELSE '' END AS state,
    CASE country_key WHEN 'US' THEN trim(a4 || ' city') WHEN 'IN' THEN trim(a4 || ' nagar') ELSE '' END AS city FROM plain)
"""


def _sql(body: str, *more: str) -> str:
    return f"WITH {','.join((_REC, *more))}\n{body}"


_SAME_CLASS = "(s.country_key = e.country_key OR s.country_key = '' OR e.country_key = '')"
_TRUTH = """
truth AS (SELECT s.entity_id AS sid, e.entity_id AS eid FROM raw s JOIN raw e ON length(s.text) = length(e.text) WHERE s.source = 1 AND e.source > 1)"""
_LABELS = """
hits AS (SELECT ranked.sid, count(*) AS n_candidates, count(truth.eid) AS hit FROM ranked LEFT JOIN truth ON truth.sid = ranked.sid AND truth.eid = ranked.eid GROUP BY ranked.sid),
links AS (SELECT sid, count(*) AS t FROM truth GROUP BY sid),
labels AS (
  SELECT entity_id AS sid, country_key AS country, coalesce(n_candidates, 0) AS n_candidates, coalesce(t, 0) AS t, coalesce(hit, 0) AS hit,
    CASE WHEN CAST('0x' || substr(md5('42|' || country_key || '|' || CASE WHEN coalesce(t, 0) > 0 THEN '1' ELSE '0' END || '|' || entity_id), 1, 13) AS BIGINT) / 4503599627370496.0 < 0.2
      THEN 'validation' ELSE 'train' END AS dataset_split
  FROM rec LEFT JOIN hits ON hits.sid = entity_id LEFT JOIN links ON links.sid = entity_id WHERE source = 1)"""
_F05 = """
steps AS (SELECT unnest([0.2, 0.5, 0.8, 1.0]) :: DOUBLE AS threshold),
passed AS (
  SELECT labels.sid, country, threshold, t, count(ranked.eid) AS predicted, count(truth.eid) AS tp
  FROM labels CROSS JOIN steps LEFT JOIN ranked ON ranked.sid = labels.sid AND ranked.p >= threshold
    LEFT JOIN truth ON truth.sid = ranked.sid AND truth.eid = ranked.eid GROUP BY ALL),
graded AS (SELECT *, CASE WHEN predicted = 0 AND t = 0 THEN 1.0 ELSE 5.0 * tp / (5 * tp + 4 * (predicted - tp) + (t - tp)) END AS v FROM passed)"""
_KEYS = """
keys AS (
  SELECT entity_id, source, rid, country_key, 'A' AS channel, unnest([CASE WHEN name_basic <> '' THEN 'basic|' || name_basic END, CASE WHEN nt <> '' THEN 'core|' || nt END,
    CASE WHEN nt <> '' THEN 'sorted|' || array_to_string(list_sort(string_split(nt, ' ')), ' ') END]) AS key FROM rec
  UNION SELECT entity_id, source, rid, country_key, 'B', left(replace(nt, ' ', ''), 3) FROM rec WHERE length(replace(nt, ' ', '')) >= 3
  UNION SELECT entity_id, source, rid, country_key, 'C', 'postal|' || state || '|' || postal FROM rec WHERE state <> '' AND postal <> ''
  UNION SELECT entity_id, source, rid, country_key, 'C', 'name|' || city || '|' || array_to_string(string_split(nt, ' ')[1:3], ' ') FROM rec WHERE city <> '' AND nt <> ''
  UNION SELECT entity_id, source, rid, country_key, 'C', 'token|' || city || '|' || x FROM (SELECT *, unnest(string_split(address, ' ')) AS x FROM rec WHERE city <> '')
    WHERE length(x) >= 3 AND NOT regexp_full_match(x, '[0-9]+') AND x NOT IN ('road', 'street', 'avenue', 'lane', 'block', 'near', 'and', 'the') AND NOT list_contains(string_split(city, ' '), x)
  UNION SELECT entity_id, source, rid, country_key, 'D', house || '|' || left(replace(nt, ' ', ''), 3) FROM rec WHERE length(replace(nt, ' ', '')) >= 3),
matched AS (
  SELECT DISTINCT s.entity_id AS sid, e.entity_id AS eid, e.rid, s.channel FROM keys s JOIN keys e ON s.channel = e.channel AND s.key = e.key AND """ + _SAME_CLASS + """
  WHERE s.source = 1 AND e.source > 1 AND s.key IS NOT NULL),
counted AS (SELECT sid, channel, count(*) AS n FROM matched GROUP BY ALL)"""
_TERMS = """
fields AS (SELECT entity_id, rid, source, country_key, 'name' AS field, nt AS body FROM rec UNION ALL SELECT entity_id, rid, source, country_key, 'address', address FROM rec),
tokens AS (SELECT * EXCLUDE body, ' ' || unnest(string_split(body, ' ')) || ' ' AS w FROM fields WHERE body <> ''),
named AS (
  SELECT * EXCLUDE w, 'w:' || trim(w) AS term FROM tokens
  UNION ALL SELECT * EXCLUDE (w, k, i), k || ':' || substr(w, i, k) FROM (SELECT *, unnest(range(1, length(w) - k + 2)) AS i FROM tokens, (SELECT unnest([3, 4, 5]) AS k))),
terms AS (SELECT *, CAST('0x' || substr(md5(term), 1, 15) AS BIGINT) & 262143 AS bucket FROM named),
idf AS (
  SELECT field, bucket, count(DISTINCT entity_id) AS df, CAST(CAST(ln(((SELECT count(*) FROM rec WHERE source > 1) + 1.0) / (count(DISTINCT entity_id) + 1)) + 1 AS FLOAT) AS DOUBLE) AS idf
  FROM terms WHERE source > 1 GROUP BY field, bucket),
unseen AS (SELECT CAST(CAST(ln(count(*) + 1.0) + 1 AS FLOAT) AS DOUBLE) AS idf FROM rec WHERE source > 1),
weights AS (
  SELECT entity_id, field, bucket, (1 + ln(tf)) * coalesce(idf, (SELECT idf FROM unseen)) AS v
  FROM (SELECT entity_id, field, bucket, count(*) AS tf FROM terms GROUP BY ALL) LEFT JOIN idf USING (field, bucket)),
unit AS (SELECT entity_id, field, bucket, v / sqrt(sum(v * v) OVER (PARTITION BY entity_id, field)) AS v FROM weights),
lex AS (SELECT DISTINCT entity_id, rid, source, country_key, field, term AS token, bucket FROM terms WHERE left(term, 2) IN ('w:', '3:')),
asked AS (
  SELECT * FROM (SELECT lex.*, row_number() OVER (PARTITION BY entity_id, field ORDER BY coalesce(idf, (SELECT idf FROM unseen)) DESC, token) AS rn FROM lex LEFT JOIN idf USING (field, bucket) WHERE source = 1)
  WHERE rn <= 16),
shares AS (SELECT DISTINCT s.entity_id AS sid, e.entity_id AS eid, e.rid, s.field FROM asked s JOIN lex e ON e.source > 1 AND s.field = e.field AND s.token = e.token AND """ + _SAME_CLASS + """),
pool AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sid, field ORDER BY rid) AS rn FROM shares) WHERE rn <= 120)"""
_KEYED = """
keyed AS (
  SELECT sid, channel, eid, rid FROM matched JOIN counted USING (sid, channel) WHERE n <= 100
  UNION ALL SELECT sid, channel, eid, rid FROM (
    SELECT *, row_number() OVER (PARTITION BY sid, channel ORDER BY rid) AS rn FROM (
      SELECT DISTINCT m.sid, m.channel, m.eid, m.rid FROM matched m JOIN counted c ON c.sid = m.sid AND c.channel = m.channel AND n > 100 JOIN shares ON shares.sid = m.sid AND shares.eid = m.eid))
  WHERE rn <= 100),
asked_pairs AS (SELECT sid, eid FROM keyed UNION SELECT sid, eid FROM pool),
dots AS (
  SELECT sid, eid, x.field, sum(x.v * y.v) AS dot FROM asked_pairs JOIN unit x ON x.entity_id = sid JOIN unit y ON y.entity_id = eid AND y.field = x.field AND y.bucket = x.bucket GROUP BY ALL),
cosines AS (
  SELECT p.sid, p.eid, s.name_basic AS sn, e.name_basic AS en, CASE WHEN s.nt <> '' AND e.nt <> '' THEN least(1.0, coalesce(n.dot, 0)) END AS nc, CASE WHEN s.address <> '' AND e.address <> '' THEN least(1.0, coalesce(a.dot, 0)) END AS ac
  FROM asked_pairs p JOIN rec s ON s.entity_id = p.sid JOIN rec e ON e.entity_id = p.eid LEFT JOIN dots n ON n.sid = p.sid AND n.eid = p.eid AND n.field = 'name' LEFT JOIN dots a ON a.sid = p.sid AND a.eid = p.eid AND a.field = 'address')"""
_RANKED = """
near AS (
  SELECT sid, eid, CASE field WHEN 'name' THEN 'E' ELSE 'F' END AS channel FROM (
    SELECT sid, eid, field, row_number() OVER (PARTITION BY sid, field ORDER BY round(coalesce(CASE field WHEN 'name' THEN nc ELSE ac END, 0), 9) DESC, eid) AS rn FROM pool JOIN cosines USING (sid, eid))
  WHERE rn <= 25),
united AS (
  SELECT sid, eid, """ + ", ".join(f"max(CAST(channel = '{c}' AS INT)) AS block_{c.lower()}" for c in CHANNELS) + """, count(DISTINCT channel) AS channels
  FROM (SELECT sid, eid, channel FROM keyed UNION ALL SELECT sid, eid, channel FROM near) GROUP BY ALL),
valued AS (
  SELECT *, round(0.55 * coalesce(nc, 0) + 0.30 * coalesce(ac, 0) + 0.10 * CAST(sn <> '' AND sn = en AS INT) + 0.01 * channels, 9) AS score FROM united JOIN cosines USING (sid, eid)),
placed AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY score DESC, eid) AS rk, count(*) OVER (PARTITION BY sid) AS found FROM valued),
ranked AS (SELECT *, round(least(1.0, CAST(CAST(score AS FLOAT) AS DOUBLE)), 6) AS p FROM placed WHERE rk <= 80)"""
_ALL = (_KEYS, _TERMS, _KEYED, _RANKED)
_EVAL = (*_ALL, _TRUTH, _LABELS)
_GRAM_SET = "list_distinct(flatten(list_transform(string_split({0}, ' '), lambda t: list_transform(range(1, length(t) + 1), lambda i: substr(' ' || t || ' ', i, 3)))))"
_LEV = "CASE WHEN {0} <> '' AND {1} <> '' THEN 1 - levenshtein({0}, {1}) / greatest(length({0}), length({1})) END"
_HASHED = "row_number() OVER (PARTITION BY country ORDER BY md5('42|' || entity_id), entity_id)"


def _both(a: str, b: str, value: str) -> str:
    return f"CASE WHEN {a} <> '' AND {b} <> '' THEN {value} END"


def _shared(a: str, b: str, parts: str) -> str:
    one, two = parts.format(a), parts.format(b)
    return _both(a, b, f"len(list_intersect({one}, {two})) / len(list_distinct(list_concat({one}, {two})))")


def _feature_sql() -> str:
    words = "string_split({0}, ' ')"
    on = lambda make, column: make(f"s.{column}", f"e.{column}")
    same, lev = (lambda a, b: _both(a, b, f"CAST({a} = {b} AS DOUBLE)")), (lambda a, b: _LEV.format(a, b))
    ratio = lambda a, b: _both(a, b, f"least(length({a}), length({b})) / greatest(length({a}), length({b}))")
    made = {
        "name_levenshtein_ratio": on(lev, "name_basic"), "name_jaro_winkler": on(lambda a, b: _both(a, b, f"jaro_winkler_similarity({a}, {b})"), "name_basic"), "name_token_jaccard": on(lambda a, b: _shared(a, b, words), "name_basic"), "name_tfidf_cosine": "nc",
        "name_char_ngram_similarity": on(lambda a, b: _shared(a, b, _GRAM_SET), "name_basic"), "name_exact": on(same, "name_basic"), "name_without_suffix_similarity": on(lev, "core"), "name_expanded_similarity": on(lev, "name_expanded"),
        "address_levenshtein": on(lev, "address"), "address_edit_distance": on(lambda a, b: _both(a, b, f"levenshtein({a}, {b})"), "address"), "address_token_jaccard": on(lambda a, b: _shared(a, b, words), "address"), "address_tfidf_cosine": "ac",
        "address_char_similarity": on(lambda a, b: _shared(a, b, _GRAM_SET), "address"), "country_exact": on(same, "country_key"), "address_exact": on(same, "address"), "name_address_similarity_product": f"({on(lev, 'name_basic')}) * ({on(lev, 'address')})",
        "name_length_ratio": on(ratio, "name_basic"), "address_length_ratio": on(ratio, "address"),
        "name_missing": "s.miss OR e.miss", "name_missing_left": "s.miss", "name_missing_right": "e.miss", "name_missing_both": "s.miss AND e.miss",
        **{f"address_missing{x}": f"{a}.address = '' {op} {b}.address = ''" for x, a, op, b in (("", "s", "OR", "e"), ("_left", "s", "OR", "s"), ("_right", "e", "OR", "e"), ("_both", "s", "AND", "e"))},
    }
    for stem, column in (("postal", "postal"), ("city", "city"), ("state", "state"), ("house_number", "house")):
        made["postal_code_exact" if stem == "postal" else f"{stem}_exact"] = on(same, column)
        made[f"{stem}_missing"] = on(lambda a, b: f"{a} = '' OR {b} = ''", column)
    return ", ".join(f"round(CAST(CAST({made[f]} AS FLOAT) AS DOUBLE), 4) AS {f}" for f in FEATURES)


_BLANK = "count(*) FILTER (trim({0}) = '') AS blank_{0}"
_NUMBERS = "list_filter(string_split(address_basic, ' '), lambda x: regexp_matches(x, '[0-9]'))"
_PIPED = "array_to_string(list_sort(list_distinct({0})), '|')"

SQL = {
    "er_profile": _sql(f"SELECT CAST(source AS BIGINT) AS source, count(*) AS rows, count(DISTINCT nullif(country, '')) AS countries, {', '.join(_BLANK.format(c) for c in ('business_name', 'business_address', 'country'))} FROM raw GROUP BY 1"),
    "er_country_counts": _sql("SELECT CAST(source AS BIGINT) AS source, CASE country WHEN '' THEN '<missing>' ELSE country END AS country, count(*) AS rows FROM raw GROUP BY ALL"),
    "er_country_hist": _sql("SELECT country_key, count(*) AS rows, CAST(sum(miss :: INT) AS BIGINT) AS name_missing, CAST(0 AS BIGINT) AS address_missing, CAST(0 AS BIGINT) AS address_component_missing FROM rec GROUP BY 1"),
    "er_clean_name": _sql("SELECT entity_id, name_basic, name_expanded, core AS name_without_suffix, array_to_string(list_sort(list_distinct(string_split(core, ' '))), ' ') AS name_token_key, replace(core, ' ', '') AS name_compact, CAST(miss AS BIGINT) AS name_missing FROM rec"),
    "er_clean_address": _sql(
        f"""SELECT entity_id, country_key, address_basic, address AS address_normalized, address AS address_latin_folded, {_PIPED.format("string_split(address, ' ')")} AS address_tokens, {_PIPED.format(_NUMBERS)} AS address_numbers,
        {_PIPED.format(f"list_transform({_NUMBERS}, lambda x: ltrim(x, '0'))")} AS address_numbers_zero_normalized, house_raw AS house, house AS house_zero, postal, state, city,
        trim(regexp_replace(CASE lang WHEN 'en' THEN house_raw || ' ' || a3 || CASE WHEN country_key = 'US' AND a3 <> '' THEN ' street' ELSE ' st' END WHEN 'de' THEN 'plot ' || n || CASE country_key WHEN 'IN' THEN ' near ' ELSE ' nr ' END || a3
          WHEN 'fr' THEN n || CASE country_key WHEN 'FR' THEN ' avenue ' ELSE ' av ' END || a3 ELSE n || ' ' || a3 || ' rd' END, ' +', ' ', 'g')) AS street,
        CASE lang WHEN 'de' THEN trim(a4 || ' nagar') ELSE '' END AS locality, CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS component_missing FROM rec"""
    ),
    "er_zero_norm": _sql("SELECT entity_id, regexp_replace(business_address, '^0+', '') AS address FROM raw"),
    "er_part_name_tokens": f"SELECT p_partkey, array_to_string(list_sort(list_distinct(string_split(lower(p_name), ' '))), ' ') AS token_key, CAST(len({_GRAM_SET.format('lower(p_name)')}) AS BIGINT) AS grams FROM part",
    "er_tokens": _sql("SELECT token, count(*) AS n FROM (SELECT unnest(string_split(name_basic, ' ')) AS token FROM rec WHERE name_basic <> '') GROUP BY 1"),
    "er_grams3": _sql(f"SELECT gram, count(*) AS n FROM (SELECT unnest({_GRAM_SET.format('core')}) AS gram FROM rec WHERE core <> '') GROUP BY 1"),
    **{f"er_block_{c.lower()}": _sql(f"SELECT sid, rid FROM keyed WHERE channel = '{c}'", _KEYS, _TERMS, _KEYED) for c in "ABCD"},
    "er_block_overflow": _sql("SELECT sid, channel FROM counted WHERE n > 100", _KEYS),
    "er_token_pool": _sql("SELECT sid, field, rid FROM pool", _TERMS),
    "er_query_tokens": _sql("SELECT entity_id, field, token FROM asked", _TERMS),
    "er_df_idf": _sql("SELECT field, bucket, df, round(idf, 5) AS idf FROM idf", _TERMS),
    "er_tfidf_vectors": _sql("SELECT entity_id, field, bucket, round(v, 5) AS value FROM unit", _TERMS),
    "er_cosine": _sql("SELECT sid, eid, round(nc, 5) AS name_cosine, round(ac, 5) AS address_cosine FROM cosines", _KEYS, _TERMS, _KEYED),
    "er_channel_union": _sql(f"SELECT sid AS source1_entity_id, eid AS candidate_entity_id, {', '.join(f'CAST(block_{c.lower()} AS BIGINT) AS block_{c}' for c in CHANNELS)} FROM ranked", *_ALL),
    "er_candidates": _sql(
        f"""SELECT sid AS source1_entity_id, eid AS candidate_entity_id, CAST(substr(eid, 2, 1) AS BIGINT) AS candidate_source, rk AS candidate_rank, round(CAST(CAST(score AS FLOAT) AS DOUBLE), 4) AS retrieval_score,
        round(CAST(CAST(nc AS FLOAT) AS DOUBLE), 4) AS name_retrieval_cosine, round(CAST(CAST(ac AS FLOAT) AS DOUBLE), 4) AS address_retrieval_cosine, {", ".join(f"CAST(block_{c.lower()} AS BIGINT) AS block_{c}" for c in CHANNELS)} FROM ranked""",
        *_ALL,
    ),
    "er_manifest": _sql(
        """SELECT entity_id AS source1_entity_id, country_key AS country, least(80, coalesce(found, 0)) AS n_candidates, coalesce(found, 0) AS union_candidates, coalesce(blocks, '') AS overflow_blocks
        FROM rec LEFT JOIN (SELECT DISTINCT sid, found FROM placed) f ON f.sid = entity_id LEFT JOIN (SELECT sid, string_agg(channel, ',' ORDER BY channel) AS blocks FROM counted WHERE n > 100 GROUP BY sid) b ON b.sid = entity_id WHERE source = 1""",
        *_ALL,
    ),
    "er_rank_cap": _sql("SELECT sid AS source1_entity_id, eid AS candidate_entity_id, rk AS candidate_rank FROM ranked", *_ALL),
    "er_similarities": _sql(
        f"""SELECT sid AS source1_entity_id, eid AS candidate_entity_id, round({_LEV.format('s.name_basic', 'e.name_basic')}, 6) AS levenshtein, {_both('s.address', 'e.address', 'levenshtein(s.address, e.address)')} AS edits,
        round({_shared('s.name_basic', 'e.name_basic', "string_split({0}, ' ')")}, 6) AS jaccard, round({_shared('s.name_basic', 'e.name_basic', _GRAM_SET)}, 6) AS gram_jaccard, {_both('s.name_basic', 'e.name_basic', 'CAST(s.name_basic = e.name_basic AS DOUBLE)')} AS same,
        round({_both('s.name_basic', 'e.name_basic', 'least(length(s.name_basic), length(e.name_basic)) / greatest(length(s.name_basic), length(e.name_basic))')}, 6) AS length_ratio,
        round({_both('s.name_basic', 'e.name_basic', 'jaro_winkler_similarity(s.name_basic, e.name_basic)')}, 6) AS jaro_winkler FROM ranked JOIN rec s ON s.entity_id = sid JOIN rec e ON e.entity_id = eid""",
        *_ALL,
    ),
    "er_features": _sql(f"SELECT sid AS source1_entity_id, eid AS candidate_entity_id, {_feature_sql()} FROM ranked JOIN rec s ON s.entity_id = sid JOIN rec e ON e.entity_id = eid", *_ALL),
    "er_truth": _sql("SELECT sid, eid FROM truth", _TRUTH),
    "er_label": _sql("SELECT ranked.sid AS source1_entity_id, ranked.eid AS candidate_entity_id, CAST(truth.eid IS NOT NULL AS BIGINT) AS label, dataset_split FROM ranked JOIN labels USING (sid) LEFT JOIN truth ON truth.sid = ranked.sid AND truth.eid = ranked.eid", *_EVAL),
    "er_label_audit": _sql("SELECT sid, eid FROM truth WHERE NOT EXISTS (SELECT 1 FROM ranked WHERE ranked.sid = truth.sid AND ranked.eid = truth.eid)", *_ALL, _TRUTH),
    "er_split": _sql("SELECT sid AS source1_entity_id, country, dataset_split, n_candidates, t AS true_links, hit AS retrieved_true_links FROM labels", *_EVAL),
    "er_recall_report": _sql(
        """SELECT CAST(grouping(dataset_split, country) AS BIGINT) AS grouping, dataset_split, country, count(*) AS queries, CAST(sum(t) AS BIGINT) AS true_links, CAST(sum(hit) AS BIGINT) AS retrieved_true_links,
        count(*) FILTER (t > 0) AS queries_with_matches, count(*) FILTER (t > 0 AND t = hit) AS queries_all_matches_retrieved, count(*) FILTER (t = 0) AS singleton_queries, CAST(sum(n_candidates) AS BIGINT) AS candidate_pairs,
        round(sum(hit) / nullif(sum(t), 0), 6) AS candidate_recall, round(avg(CASE WHEN t = 0 THEN 1.0 ELSE 5.0 * hit / (4 * hit + t) END), 6) AS ceiling
        FROM labels GROUP BY GROUPING SETS ((), (dataset_split), (country), (dataset_split, country))""",
        *_EVAL,
    ),
    "er_oracle_ceiling": _sql("SELECT round(avg(CASE WHEN t = 0 THEN 1.0 ELSE 5.0 * hit / (4 * hit + t) END), 6) AS ceiling FROM labels", *_EVAL),
    "er_threshold_sweep": _sql("SELECT threshold, country, count(*) AS queries, round(avg(v), 6) AS macro_f05 FROM graded GROUP BY GROUPING SETS ((threshold), (threshold, country))", *_EVAL, _F05),
    "er_best_threshold": _sql("SELECT threshold, round(m, 6) AS macro_f05 FROM (SELECT threshold, avg(round(v, 12)) AS m FROM graded GROUP BY 1) ORDER BY m DESC, threshold DESC LIMIT 1", *_EVAL, _F05),
    "er_candidate_list": _sql("SELECT entity_id AS source1_entity_id, coalesce(ids, '') AS candidate_entity_ids FROM rec LEFT JOIN (SELECT sid, string_agg(eid, ',' ORDER BY rk) AS ids FROM ranked GROUP BY sid) ON sid = entity_id WHERE source = 1", *_ALL),
    "er_submission": _sql("SELECT entity_id AS source1_entity_id, coalesce(ids, '') AS matched_entity_ids FROM rec LEFT JOIN (SELECT sid, string_agg(eid, ',' ORDER BY eid) AS ids FROM ranked WHERE p >= 0.5 GROUP BY sid) ON sid = entity_id WHERE source = 1", *_ALL),
    "er_sample_stratified": _sql(f"SELECT entity_id, country FROM (SELECT *, {_HASHED} AS rn FROM raw WHERE source = 1) WHERE rn <= 20"),
    "er_retain_matches": _sql(
        f"""SELECT entity_id, country FROM raw WHERE entity_id IN (SELECT eid FROM needed)
        UNION ALL SELECT entity_id, country FROM (SELECT *, {_HASHED} AS rn FROM raw WHERE source > 1 AND entity_id NOT IN (SELECT eid FROM needed)) WHERE rn <= 10""",
        _TRUTH, f"chosen AS (SELECT entity_id FROM (SELECT *, {_HASHED} AS rn FROM raw WHERE source = 1) WHERE rn <= 20), needed AS (SELECT DISTINCT eid FROM truth JOIN chosen ON sid = entity_id)",
    ),
    "er_match_histogram": _sql("SELECT matches, count(*) AS queries, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM (SELECT entity_id, count(eid) AS matches FROM raw LEFT JOIN truth ON sid = entity_id WHERE source = 1 GROUP BY 1) GROUP BY 1", _TRUTH),
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **{f"er_block_{c.lower()}": _channel(c) for c in "ABCD"},
    **{name: f for name, f in list(globals().items()) if name.startswith("er_")},
    "er_candidates_bm25": lambda spark, sf: er_candidates(spark, sf, "bm25"),
}
