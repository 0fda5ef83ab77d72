"""Candidate retrieval: six channels of keyed joins, ranked and capped for each query.

Posting lists are cut before they are joined wherever that can't change the result. In ``rowid``
mode the first N of a union of lists lie in the lists' own first N, so no list is longer than what
a query may take from it; a hot key costs a bounded join. ``bm25`` mode scores full lists, as arrays.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinmatch.functions import text as T
from kinmatch.functions.constants import CHANNELS, CITY_STOP_WORDS, SCORE_WEIGHTS
from kinmatch.operators import bm25, cosine
from kinmatch.operators.tfidf import Tfidf, indexed
from kinmatch.sources.staging import discard, staged, staged_parts

ANY, UNKNOWN = "*", "UNKNOWN"
_SEP = "\x1f"
#: What takes far more disk in shuffles than its result is made in portions: of about so many records, and so many at
#: most, so that the work of a portion that is the same for all of them stays in proportion to the input.
PORTION_ROWS, MOST_PORTIONS = 1 << 13, 24
#: Bits of a pair: the channels that have it by a key, and the pools that it is in.
_MARKS = {c: 1 << i for i, c in enumerate((*"ABCD", "name", "address"))}


@dataclass(frozen=True)
class Limits:
    block_limit: int = 100
    lexical_pool: int = 120
    lexical_top_k: int = 25
    max_candidates: int = 80
    query_terms: int = 16
    retrieval: str = "rowid"


# ---------------------------------------------------------------- keys


def block_keys() -> Column:
    """``array<struct<channel, key>>`` of a record; a key needs all of its parts."""
    name, city = T.name_text(), F.col("city_candidate")
    prefix = F.substring(F.array_join(T.words(name), ""), 1, 3)
    name_words = T.words(name)

    def key(channel: str, *parts: Column) -> Column:
        filled = parts[0] != ""
        for p in parts[1:]:
            filled = filled & (p != "")
        return F.when(filled, F.array(F.struct(F.lit(channel).alias("channel"), F.concat_ws(_SEP, *parts).alias("key"))))

    whole_prefix = F.when(F.length(prefix) == 3, prefix).otherwise(F.lit(""))
    usual = F.array_union(F.array(*[F.lit(w) for w in CITY_STOP_WORDS]), T.words(city))
    streets = F.filter(F.array_distinct(F.array_except(T.words(T.address_text()), usual)), lambda t: (F.length(t) >= 3) & ~F.rlike(t, F.lit(r"^\p{Nd}+$")))
    in_city = F.when(city != "", F.transform(streets, lambda t: F.struct(F.lit("C").alias("channel"), F.concat_ws(_SEP, F.lit("city_token"), city, t).alias("key"))))
    lists = [
        key("A", F.lit("basic"), F.col("name_basic")),
        key("A", F.lit("core"), name),
        key("A", F.lit("sorted"), F.array_join(F.array_sort(name_words), " ")),
        key("B", whole_prefix),
        key("C", F.lit("postal"), F.col("state_candidate"), F.col("postal_code_candidate")),
        in_city,
        key("C", F.lit("city_name"), city, F.array_join(F.slice(name_words, 1, 3), " ")),
        key("D", F.col("house_number_zero_normalized"), whole_prefix),
    ]
    kind = "array<struct<channel:string,key:string>>"
    return F.array_distinct(F.concat(*[F.coalesce(x.cast(kind), F.array().cast(kind)) for x in lists]))


def _classes_of_query() -> Column:
    country = F.col("country_key")
    return F.when(country == "", F.array(F.lit(ANY))).otherwise(F.array_distinct(F.array(country, F.lit(UNKNOWN))))


def _classes_of_reference(any_class: bool) -> Column:
    own = F.when(F.col("country_key") == "", F.lit(UNKNOWN)).otherwise(F.col("country_key"))
    return F.array(own, F.lit(ANY)) if any_class else F.array(own)


def _first(df: DataFrame, by: list[str], n: int) -> DataFrame:
    """The lowest ``rid`` of each group; planned as a limit before and after the shuffle."""
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(*by).orderBy("rid"))).filter(F.col("rn") <= n).drop("rn")


def _lists(df: DataFrame, by: list[str], n: int) -> DataFrame:
    """Of each group the ``n`` lowest ``rid``, as one array."""
    return _first(df, by, n).groupBy(*by).agg(F.collect_list("rid").alias("rids"))


def _united(hits: DataFrame, by: list[str]) -> DataFrame:
    """The union of each group's lists, ascending. Lists are short and a query has few, so arrays of some
    thousand numbers take the place of as many rows."""
    return hits.groupBy(*by).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("rids")))).alias("rids"))


def _grown(df: DataFrame) -> DataFrame:
    """Never sent to the driver for a join. Spark takes a table's size from its compressed file and before its
    arrays are exploded, so what has hundreds of MB of rows may pass for a few."""
    return df.hint("merge")


def portions(table: DataFrame) -> int:
    """How many portions a table is taken in."""
    return max(1, min(MOST_PORTIONS, -(-table.count() // PORTION_ROWS)))


def of_portion(column: str, i: int, n: int) -> Column:
    """Whether a row belongs to a portion; by another hash than those that deal rows to tasks."""
    return F.pmod(F.xxhash64(F.lit("portion"), F.col(column)), F.lit(n)) == i if n > 1 else F.lit(True)


# ---------------------------------------------------------------- channels


class Blocker:
    """References indexed for queries. ``references`` are records with ``rid`` (the order of ingest).

    What several branches of a plan read (keys, tokens, hits, cosines) is written once; :meth:`forget`
    removes those tables when the results are no longer read.
    """

    def __init__(self, references: DataFrame, model: Tfidf | None, limits: Limits = Limits(), any_class: bool = True):
        if limits.retrieval not in ("rowid", "bm25"):
            raise ValueError("retrieval must be rowid or bm25")
        self.references, self.model, self.limits, self.any_class = references, model, limits, any_class
        self._tables: list[DataFrame] = []

    def _keep(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        self._tables.append(staged(df, name, by))
        return self._tables[-1]

    def _keep_parts(self, parts: list[DataFrame], name: str) -> DataFrame:
        """One table of parts that are made one after the other."""
        if len(parts) == 1:
            return self._keep(parts[0], name)
        self._tables.append(staged_parts(parts, name))
        return self._tables[-1]

    def _drop(self, table: DataFrame) -> None:
        discard(table)
        self._tables = [t for t in self._tables if t is not table]

    def forget(self, everything: bool = False) -> None:
        """Remove the tables that queries have left; those of the references stay if more queries come."""
        kept = [] if everything else [self.__dict__.get(x) for x in ("keys", "index")]
        for table in self._tables:
            if not any(table is x for x in kept):
                discard(table)
        self._tables = [t for t in self._tables if any(t is x for x in kept)]

    @cached_property
    def keys(self) -> DataFrame:
        """``class, rid, channel, key``."""
        found = self.references.select("rid", _classes_of_reference(self.any_class).alias("classes"), F.explode(block_keys()).alias("k"))
        return self._keep(found.select(F.explode("classes").alias("class"), "rid", "k.*"), "keys")

    @cached_property
    def _parts(self) -> int:
        return cosine.parts_of(self.references.count())

    @cached_property
    def index(self) -> DataFrame:
        """``rid, classes, eid, name_basic, candidate_source``, vectors and tokens, written by ``part``; for ``bm25``
        also keys. Records are dealt before they have vectors, which are far larger."""
        named = (_classes_of_reference(self.any_class).alias("classes"), F.col("entity_id").alias("eid"), F.col("source").alias("candidate_source"), F.col("name_basic").alias("rname"))
        if self.limits.retrieval == "bm25":
            named = (*named, block_keys().alias("keys"))
        own = cosine.part_of(self._parts)
        # so many files a part that the cores are busy while vectors are made
        files = max(1, -(-2 * self.references.sparkSession.sparkContext.defaultParallelism // self._parts))
        dealt = self.references.repartition(self._parts * files, own * files + F.pmod(F.xxhash64(F.lit("file"), "rid"), F.lit(files)))
        return self._keep(indexed(dealt, self.model, 0, "rid", (*named, own.alias("part"))).drop("asked"), "index", "part")

    def _tokens(self, asked: DataFrame, wanted: Column) -> DataFrame:
        """``class, rid, field, token``, of tokens that some query asks for and that are wanted."""
        every = self.index.select("rid", F.explode("classes").alias("class"), "tokens").select("rid", "class", F.explode("tokens").alias("t")).select("class", "rid", "t.*").filter(wanted)
        return every.join(_grown(asked.filter(wanted).select("class", "field", "token").distinct()), ["class", "field", "token"], "left_semi")

    def read(self, queries: DataFrame) -> DataFrame:
        """Queries with their classes, keys, vectors and the tokens that they ask for."""
        own = (F.col("name_basic").alias("qname"), _classes_of_query().alias("classes"), block_keys().alias("keys"))
        if self.model is None:
            return self._keep(queries.select(F.col("entity_id").alias("sid"), *own), "queries")
        made = indexed(queries, self.model, self.limits.query_terms, more=own)
        return self._keep(made.select(F.col("entity_id").alias("sid"), "qname", "classes", "keys", F.col("name_vector").alias("qn"), F.col("address_vector").alias("qa"), "asked"), "queries")

    @staticmethod
    def _asked_keys(read: DataFrame) -> DataFrame:
        return read.select("sid", F.explode("classes").alias("class"), "keys").select("sid", "class", F.explode("keys").alias("k")).select("sid", "class", "k.*")

    @staticmethod
    def _asked_tokens(read: DataFrame) -> DataFrame:
        return read.select("sid", F.explode("classes").alias("class"), "asked").select("sid", "class", F.explode("asked").alias("t")).select("sid", "class", "t.*")

    def postings(self) -> DataFrame:
        """Key postings, each list cut to one more than a channel may use."""
        return _lists(self.keys, ["class", "channel", "key"], self.limits.block_limit + 1)

    def key_matches(self, read: DataFrame) -> DataFrame:
        """``sid, channel, rid, n``: what shares a key, and how many do; beyond the limit, not all are listed."""
        found = _united(self._asked_keys(read).join(_grown(self.postings()), ["class", "channel", "key"]), ["sid", "channel"]).withColumn("n", F.size("rids"))
        return self._keep(found.select("sid", "channel", F.explode(F.slice("rids", 1, self.limits.block_limit + 1)).alias("rid"), "n"), "key-matches")

    def keyed_hits(self, read: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Hits of channels A to D, and the (query, channel) that overflowed."""
        counted = self.key_matches(read)
        over = counted.filter(F.col("n") > self.limits.block_limit).select("sid", "channel").distinct()
        fits = counted.filter(F.col("n") <= self.limits.block_limit).select("sid", "channel", "rid")
        return fits.union(self._fallback(read, over)), over

    def _fallback(self, read: DataFrame, over: DataFrame) -> DataFrame:
        """Channels that overflow keep references that also share a query token, the first ``block_limit``.

        Lists of (key, token) exist for overflowing keys alone and are cut like the others.
        """
        limit, at = self.limits.block_limit, ["class", "channel", "key", "field", "token"]
        if self.limits.retrieval == "bm25":
            full = over.groupBy("sid").agg(F.collect_set("channel").alias("over"))
            asked = read.join(_grown(full), "sid").withColumn("keys", F.filter("keys", lambda k: F.array_contains("over", k["channel"])))
            return bm25.best(self.index, asked, limit, True).select("sid", F.col("g").alias("channel"), "rid")
        keys = self._asked_keys(read).join(_grown(over), ["sid", "channel"])
        wanted = keys.join(_grown(self._asked_tokens(read)), ["sid", "class"])
        hot = self.keys.join(_grown(keys.select("class", "channel", "key").distinct()), ["class", "channel", "key"], "left_semi")

        def lists(own: Column) -> DataFrame:
            both = hot.join(_grown(self._tokens(wanted, own)), ["class", "rid"]).join(_grown(wanted.filter(own).select(*at).distinct()), at, "left_semi")
            return _lists(both, at, limit)

        found = lambda own, lists: _united(own.join(_grown(lists), at), ["sid", "channel"]).select("sid", "channel", F.explode(F.slice("rids", 1, limit)).alias("rid"))
        return self._by_lists(read, wanted, lists, found, "fallback")

    def _by_lists(self, read: DataFrame, wanted: DataFrame, lists: Callable[[Column], DataFrame], found: Callable[[DataFrame, DataFrame], DataFrame], name: str) -> DataFrame:
        """What the wanted rows find in lists of tokens: lists in portions of tokens, then what is found in portions of
        queries. A list is whole in its portion, and so is what a query finds."""
        n = portions(self.index)
        made = self._keep_parts([lists(of_portion("token", i, n)) for i in range(n)], f"{name}-lists")
        n = portions(read)
        out = self._keep_parts([found(wanted.filter(of_portion("sid", i, n)), made) for i in range(n)], name)
        self._drop(made)
        return out

    def lexical_pool(self, read: DataFrame) -> DataFrame:
        """``sid, field, rid``: references that share a query token, the first ``lexical_pool``."""
        pool, at = self.limits.lexical_pool, ["class", "field", "token"]
        if self.limits.retrieval == "bm25":
            return self._keep(bm25.best(self.index, read, pool, False).select("sid", F.col("g").alias("field"), "rid"), "pool")
        asked = self._asked_tokens(read)
        found = lambda own, lists: _united(own.join(_grown(lists), at), ["sid", "field"]).select("sid", "field", F.explode(F.slice("rids", 1, pool)).alias("rid"))
        return self._by_lists(read, asked, lambda own: _lists(self._tokens(asked, own), at, pool), found, "pool")

    # ------------------------------------------------------------ all together

    def with_cosines(self, pairs: DataFrame, read: DataFrame) -> DataFrame:
        """Pairs (``sid, rid``), each once, with both cosines, and what ranking needs of both records."""
        return self._scored(pairs.withColumn("marks", F.lit(0)), read).drop("marks")

    def _scored(self, marked: DataFrame, read: DataFrame) -> DataFrame:
        return cosine.of_pairs(self.index, self._parts, read, marked, self.model.bits)

    def near(self, scored: DataFrame) -> dict[str, Column]:
        """Channels E and F: whether a pair is, of the pool of a field, among the nearest by that field's cosine (to nine
        digits, so that the order doesn't hang on the order of a sum), ties by id."""
        found = {}
        for channel, field, of in (("E", "name", "nc"), ("F", "address", "ac")):
            inside = F.col("marks").bitwiseAND(_MARKS[field]) != 0
            rank = F.row_number().over(Window.partitionBy("sid").orderBy(inside.desc(), F.round(F.coalesce(of, F.lit(0.0)), 9).desc(), "eid"))
            found[channel] = inside & (rank <= self.limits.lexical_top_k)
        return found

    def candidates(self, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Ranked and capped pairs (the pair schema), and a manifest with every query."""
        read = self.read(queries)
        keyed, over = self.kept_hits(read)
        pool = self.lexical_pool(read)
        return self.ranked(queries, keyed, over, pool, read)

    def kept_hits(self, read: DataFrame) -> tuple[DataFrame, DataFrame]:
        """:meth:`keyed_hits`, written."""
        keyed, over = self.keyed_hits(read)
        return self._keep(keyed, "keyed-hits"), over

    def cosines(self, keyed: DataFrame, pool: DataFrame, read: DataFrame) -> DataFrame:
        """Cosines once, for every pair of any channel."""
        return self._keep(self.with_cosines(keyed.select("sid", "rid").union(pool.select("sid", "rid")), read), "cosines")

    def _ranked(self, keyed: DataFrame, pool: DataFrame, read: DataFrame) -> DataFrame:
        """Pairs of these queries, ranked and capped. Hits go along with the pairs through the cosines as marks, so that
        pairs aren't joined again: what is shuffled after the cosines is one row a pair, by query."""
        bit = lambda c: F.create_map(*[F.lit(x) for kind in _MARKS.items() for x in kind])[F.col(c)]
        marked = keyed.select("sid", "rid", bit("channel").alias("marks")).union(pool.select("sid", "rid", bit("field").alias("marks")))
        same = ((F.col("qname") != "") & (F.col("qname") == F.col("rname"))).cast("double")
        scored = self._scored(marked, read).select("sid", "eid", "candidate_source", "nc", "ac", "marks", same.alias("same")).repartition("sid")
        had = {c: F.col("marks").bitwiseAND(_MARKS[c]) != 0 for c in "ABCD"}
        flagged = scored.withColumns({f"block_{c}": x.cast("int") for c, x in (had | self.near(scored)).items()})
        flagged = flagged.withColumn("channels", sum((F.col(f"block_{c}") for c in CHANNELS[1:]), F.col(f"block_{CHANNELS[0]}"))).filter("channels > 0")
        wn, wa, we, wc = SCORE_WEIGHTS
        score = F.round(wn * F.coalesce("nc", F.lit(0.0)) + wa * F.coalesce("ac", F.lit(0.0)) + we * F.col("same") + wc * F.col("channels"), 9)
        by_score, whole = Window.partitionBy("sid").orderBy(F.col("score").desc(), "eid"), Window.partitionBy("sid")
        full = flagged.withColumn("score", score)
        return full.withColumns({"candidate_rank": F.row_number().over(by_score), "union_candidates": F.count(F.lit(1)).over(whole)}).filter(F.col("candidate_rank") <= self.limits.max_candidates).drop("marks", "same", "channels")

    def ranked(self, queries: DataFrame, keyed: DataFrame, over: DataFrame, pool: DataFrame, read: DataFrame) -> tuple[DataFrame, DataFrame]:
        """As :meth:`candidates`, of what the channels found."""
        n = portions(read)
        own = lambda df, i: df.filter(of_portion("sid", i, n))
        ranked = self._keep_parts([self._ranked(own(keyed, i), own(pool, i), own(read, i)) for i in range(n)], "ranked")
        chosen = ranked.select(
            F.col("sid").alias("source1_entity_id"), F.col("eid").alias("candidate_entity_id"), F.col("candidate_source").cast("int"), F.col("candidate_rank").cast("int"), F.col("score").cast("float").alias("retrieval_score"),
            F.col("nc").cast("float").alias("name_retrieval_cosine"), F.col("ac").cast("float").alias("address_retrieval_cosine"), *[F.col(f"block_{c}") for c in CHANNELS],
        )
        counts = ranked.filter("candidate_rank = 1").select("sid", "union_candidates")
        overs = over.groupBy("sid").agg(F.array_join(F.array_sort(F.collect_set("channel")), ",").alias("overflow_blocks"))
        manifest = queries.select(F.col("entity_id").alias("sid"), F.col("country_key").alias("country")).join(_grown(counts), "sid", "left").join(_grown(overs), "sid", "left")
        manifest = manifest.select(F.col("sid").alias("source1_entity_id"), "country", F.least(F.coalesce("union_candidates", F.lit(0)), F.lit(self.limits.max_candidates)).alias("n_candidates"), F.coalesce("union_candidates", F.lit(0)).alias("union_candidates"), F.coalesce("overflow_blocks", F.lit("")).alias("overflow_blocks"))
        return chosen, manifest


def blocking_report(pairs: DataFrame, manifest: DataFrame) -> dict:
    """Totals of a run, by one aggregate over each table."""
    found = pairs.agg(F.count(F.lit(1)).alias("pairs"), *[F.coalesce(F.sum(f"block_{c}"), F.lit(0)).alias(f"block_{c}_final_pairs") for c in CHANNELS]).first().asDict()
    asked = manifest.agg(
        F.count(F.lit(1)).alias("queries"), F.count_if(F.col("n_candidates") == 0).alias("queries_without_candidates"), F.count_if(F.col("union_candidates") > F.col("n_candidates")).alias("queries_capped"),
        F.count_if(F.col("overflow_blocks") != "").alias("queries_with_overflow_blocks"),
    ).first().asDict()
    return found | asked | {"average_candidates": found["pairs"] / max(1, asked["queries"])}


def numbered(records: DataFrame) -> DataFrame:
    """Records with ``rid`` in the order (source, entity_id): the order of ingest, made explicit.

    Numbers are a partition's number in the high bits over a range-partitioned sort: ascending, not
    dense, and no task sees more than its range.
    """
    return records.repartitionByRange("source", "entity_id").sortWithinPartitions("source", "entity_id").withColumn("rid", F.monotonically_increasing_id())
