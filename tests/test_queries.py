"""Every registered query against its SQL, and the plans it may not have."""

import datetime as dt
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry_points
from floortally.bindings.oracle_sql import ORACLES
from floortally.bindings.registry import QUERIES

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def canonical(rows, order):
    def value(x):
        return round(x, 9) + 0.0 if isinstance(x, float) else x

    return sorted((tuple(value(row[i]) for i in order) for row in rows), key=lambda r: [(x is None, str(x)) for x in r])


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= entry_points.queries().items() and ORACLES.items() <= entry_points.oracle_sql().items()


@pytest.mark.parametrize("missing", ["tokenizers", "floortally.llm", "corpus_pipeline", None])
def test_entry_points_work_without_the_training_data_operators(missing):
    block = f"sys.modules[{missing!r}] = None; " if missing else ""
    found = subprocess.run(
        [sys.executable, "-c", f"import sys; {block}import __spark_entry__ as e; print(len(e.queries()))"],
        cwd=os.path.dirname(entry_points.__file__), capture_output=True, text=True, check=True,
    )
    n = int(found.stdout.split()[-1])
    assert n == len(QUERIES) if missing else n >= len(QUERIES)


@pytest.fixture(scope="module", autouse=True)
def shuffled_joins(spark):
    """Joins as on data too large to broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, old)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query_matches_sql(spark, duck, sf_dir, key):
    df = QUERIES[key](spark, sf_dir)
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "Scan ExistingRDD"):
        assert forbidden not in plan
    if key != "same_day_summary":  # its one grand total groups a handful of manager rows
        assert "SinglePartition" not in plan
    found = duck.execute(ORACLES[key])
    names = [column[0] for column in found.description]
    expected = found.fetchall()
    assert sorted(df.columns) == sorted(names)
    columns = sorted(names)
    got = canonical(rows, [df.columns.index(x) for x in columns])
    assert got == canonical(expected, [names.index(x) for x in columns])
    assert got


def test_entry_gives_three_reasons_at_most_per_day(spark):
    rows = entry_points.entry(spark).collect()
    assert rows and max(r["rank"] for r in rows) == 3
    assert all(isinstance(r.as_of, dt.date) for r in rows)


# Facts and JSON columns each report needs; every one is scanned or parsed once.
PARSES = {
    "lost_sale_followups": 2,
    "phone_follow_ups": 2,
    "reason_summary": 2,
    "reason_summary_codes": 2,
    "category_issue_crosstab": 3,
    "category_issue_codes": 3,
    "reason_domain_day": 1,
    "reason_domain_codes": 1,
    "objection_handling_matrix": 1,
    "objection_handling_codes": 1,
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", list(PARSES))
def test_facts_are_scanned_and_json_parsed_once(spark, sf_dir, key):
    plan = plan_of(QUERIES[key](spark, sf_dir))
    assert plan.count("from_json(") == PARSES[key]
    for fact in ("orders", "lineitem"):
        assert plan.count(f"/{fact}.parquet") <= 1


def test_a_report_of_one_day_reads_its_week_and_month_only(spark, sf_dir):
    plan = plan_of(QUERIES["category_wtd_mtd_one_day"](spark, sf_dir))
    (scan,) = [line for line in plan.split("\n") if "FileScan" in line and "/orders.parquet" in line]
    assert "GreaterThanOrEqual(o_orderdate,1998-08-01T00:00), LessThan(o_orderdate,1" in scan


def test_flags_are_built_from_one_detail(spark, sf_dir):
    detail = plan_of(QUERIES["adherence_detail"](spark, sf_dir))
    for key in ("store_flags", "flagged_managers_total"):
        plan = plan_of(QUERIES[key](spark, sf_dir))
        for table in ("events", "customer", "supplier"):
            assert plan.count(f"/{table}.parquet") <= detail.count(f"/{table}.parquet")
        assert plan.count("Exchange") <= detail.count("Exchange") + 4
