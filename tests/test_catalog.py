"""The catalogue's queries against DuckDB on the small tables, and the entry module without its guests."""

import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from kinmatch.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = catalog.QUERIES[name](spark, SF)
    found = con.execute(catalog.SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(got.columns)
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=key) == sorted(found.fetchall(), key=key)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_rows(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_prepared_tables_are_made_again_if_they_are_gone(spark):
    first = catalog.records(spark, SF)
    assert catalog.records(spark, SF) is first
    shutil.rmtree(Path(first.inputFiles()[0].removeprefix("file:").replace("//", "/")).parent)
    assert catalog.records(spark, SF).count() == 200
    assert catalog.QUERIES["er_rank_cap"](spark, SF).count() > 0


@pytest.mark.parametrize("name", ["er_label", "er_manifest", "er_split", "er_submission", "er_threshold_sweep", "er_best_threshold", "er_recall_report", "er_label_audit", "er_features", "er_similarities"])
def test_what_grows_is_never_sent_to_the_driver(spark, name):
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_queries_share_what_retrieval_has_found(spark):
    assert catalog.run_of(spark, SF).blocker is catalog.blocker_of(spark, SF)
    assert catalog.hits_of(spark, SF)[0] is catalog.hits_of(spark, SF)[0]
    assert catalog.cosines_of(spark, SF) is catalog.cosines_of(spark, SF)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry_without_the_training_data_operators(tmp_path):
    root = Path(__file__).parents[1]
    shutil.copytree(root / "kinmatch", tmp_path / "kinmatch", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.catalog.QUERIES))"], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert said.stdout.strip() == "True"
