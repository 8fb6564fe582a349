import dataclasses
import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from floortally import jobs
from floortally.bindings import driver as D
from floortally.sources import daily_store
from floortally.sources.tables import Tables

DAY = dt.date(1998, 8, 15)


def test_every_report_writes_its_tables(spark, sf_dir, tmp_path):
    sales, audio = D.sales_floor(spark, sf_dir), D.audio_floor(spark, sf_dir)
    both = audio.bind(interactions=sales.interactions)
    plan = {
        "lost_sales": (sales, DAY, D.ORDER_TENANTS),
        "tenant_reasons": (sales, DAY, D.ORDER_TENANTS),
        "funnel": (audio, D.AS_OF, ()),
        "device_adherence": (audio, D.AS_OF, ()),
        "daily_adherence": (audio, D.AS_OF, ()),
        "tenant_matrix": (both, D.AS_OF, D.BRAND_TENANTS),
    }
    assert plan.keys() == jobs.REPORTS.keys() == jobs.RUN_LAG.keys()
    for report, (tables, as_of, tenants) in plan.items():
        parameters = jobs.Parameters(as_of, tenants, device_pattern=D.DEVICE_PATTERN)
        jobs.run(report, tables, parameters, str(tmp_path))
        for folder in (tmp_path / report).iterdir():
            if folder.name == "daily":
                continue
            assert list((folder / f"as_of={as_of}").glob("part-*")), folder
    written = spark.read.parquet(str(tmp_path / "device_adherence" / "flagged_managers"))
    assert written.where("is_total").count() >= 1 and "as_of" in written.columns


def test_data_day_of_a_run():
    assert jobs.as_of_for("lost_sales", dt.date(2024, 3, 1)) == dt.date(2024, 2, 28)
    assert jobs.as_of_for("tenant_matrix", dt.date(2024, 3, 1)) == dt.date(2024, 2, 29)


class Counted(Tables):
    """Tables that count how often each role is read."""

    def __init__(self, tables):
        self.reads = Counter()

        def read(role):
            self.reads[role] += 1
            return getattr(tables, role)

        super().__init__({role: (lambda role=role: read(role)) for role in tables._loaders})


REPORTS = {
    "lost_sales": (DAY, ["interactions", "interaction_flags"]),
    "tenant_reasons": (DAY, ["interactions"]),
    "funnel": (D.AS_OF, ["interactions", "scheme_flags"]),
}


def direct(report, t, p):
    """The tables of a report straight from the facts."""
    written = {}

    class Memory(jobs.Writer):
        def table(self, name, df):
            written[name] = df
            return df

        export = table

        def daily(self, spark):
            class Nothing:
                def bring(self, *_):
                    return None

                days_of = bring

            return Nothing()

    class Bare(Tables):
        def bind(self, **frames):
            return self

    jobs.REPORTS[report](Bare(t._loaders), p, Memory("", report, p.as_of))
    return written


@pytest.mark.parametrize("report", list(REPORTS))
def test_periods_come_from_stored_days(spark, sf_dir, tmp_path, report):
    as_of, facts = REPORTS[report]
    floor = D.audio_floor(spark, sf_dir) if report == "funnel" else D.sales_floor(spark, sf_dir)
    p = jobs.Parameters(as_of, D.ORDER_TENANTS)
    before = dataclasses.replace(p, as_of=as_of - dt.timedelta(3))
    t = Counted(floor)
    jobs.run(report, t, before, str(tmp_path))
    # One read to build the days, one to learn the session.
    assert {role: t.reads[role] for role in facts} == {role: 2 if role == "interactions" else 1 for role in facts}
    stamps = {f: f.stat().st_mtime_ns for f in (tmp_path / report / "daily").rglob("part-*.parquet")}
    jobs.run(report, t, p, str(tmp_path))
    kept = {f for f, stamp in stamps.items() if f.exists() and f.stat().st_mtime_ns == stamp}
    assert kept == set(stamps)  # days known before stay as they are
    jobs.run(report, t, p, str(tmp_path))
    days = {f.parent.name for f in stamps}
    assert f"date={as_of - dt.timedelta(3)}" in days and f"date={as_of}" not in days
    for name, df in direct(report, floor, p).items():
        folder = tmp_path / report / (name if (tmp_path / report / name).exists() else f"{name}_csv") / f"as_of={as_of}"
        if folder.parent.name.endswith("_csv"):
            got = spark.read.option("header", True).option("inferSchema", False).csv(str(folder)).collect()
            assert len(got) == df.count()
        else:
            got = spark.read.schema(df.schema).parquet(str(folder)).collect()
            assert sorted(map(str, got)) == sorted(map(str, df.collect())), name


def test_a_day_without_rows_counts_as_known(spark, tmp_path):
    store, days = daily_store.DailyStore(spark, str(tmp_path)), [dt.date(2024, 1, n) for n in (1, 2, 3)]
    asked = []

    def build(wanted):
        asked.append(list(wanted))
        return spark.createDataFrame([(dt.date(2024, 1, 2), "a")], "date date, x string").where(F.col("date").isin(wanted))

    for renewed in (days[2], days[2], days[1]):
        assert [(r.date, r.x) for r in store.bring("t", days[0], days[2], renewed, build).collect()] == [(days[1], "a")]
    assert asked == [days, days[2:], days[1:]]
    store.replace("t", days[1:2], store.read("t").where("false"))
    assert store.read("t").count() == 0 and store.known("t") == set(days)
