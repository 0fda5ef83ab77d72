import numpy as np
from pyspark.sql import functions as F

from kinmatch.llm.common import drop_table, runs, sliding_min, spread_join, whole_runs, write_table
from kinmatch.llm.components import components, forest


def test_spread_join_is_a_join(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 1000 == 1, None).otherwise(F.col("id").cast("string")).alias("k"), "id")
    facts = rows.select("k").distinct().filter("k <> '5'").withColumn("v", F.length("k"))
    key = lambda r: str(tuple(r))
    for how in ("left", "inner"):
        got = spread_join(rows, facts, "k", how).select("k", "id", "v").collect()
        assert sorted(got, key=key) == sorted(rows.join(facts, "k", how).select("k", "id", "v").collect(), key=key)


def test_components_against_union_find(spark):
    rng = np.random.default_rng(4)
    for n, m in ((200, 150), (60, 300), (400, 390)):
        a, b = rng.integers(0, n, m), rng.integers(0, n, m)
        if n == 400:
            a, b = np.arange(m), np.arange(m) + 1  # one long path
        links = spark.createDataFrame(list(zip(a.tolist(), b.tolist())), "a long, b long")
        root = list(range(n + 1))

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for x, y in zip(a.tolist(), b.tolist()):
            root[find(x)] = find(y)
        got = {r["node"]: r["root"] for r in components(links).collect()}
        linked = {x for x, y in zip(a.tolist(), b.tolist()) if x != y} | {y for x, y in zip(a.tolist(), b.tolist()) if x != y}
        assert set(got) == linked
        assert all((got[x] == got[y]) == (find(x) == find(y)) for x in linked for y in linked)
        fa, fb = forest(a, b)
        assert len(fa) == len(set(np.concatenate([a, b]).tolist())) - len({find(x) for x in np.concatenate([a, b]).tolist()}) and (fb < fa).all()


def test_written_tables(spark):
    table = write_table(spark.range(10), "t")
    path = table.inputFiles()[0]
    assert table.count() == 10
    drop_table(table)
    import os

    assert not os.path.exists(path.removeprefix("file://"))


def test_runs_and_windows(spark):
    x = np.array([5, 1, 4, 4, 9, 2, 7])
    for w in (1, 2, 3, 5, 7):
        assert sliding_min(x, w).tolist() == [min(x[i : i + w]) for i in range(len(x) - w + 1)]
    assert runs(np.array([1, 1, 2])).tolist() == [0, 2, 3]
    import pyarrow as pa

    keys = [1, 1, 2, 3, 3, 3, 3, 4]
    batches = [pa.RecordBatch.from_pydict({"k": keys[i : i + 2]}) for i in range(0, 8, 2)]
    tables = [t.column(0).to_pylist() for t in whole_runs(iter(batches))]
    assert sum(tables, []) == keys and all(set(p).isdisjoint(q) for p, q in zip(tables, tables[1:]))
