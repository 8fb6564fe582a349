"""Whole reports as jobs: read the tables, compute every table of a report, write them.

    zip -qr floortally.zip floortally
    spark-submit --py-files floortally.zip floortally/jobs.py \\
        --report daily_adherence --tables /data/in --out /data/out --as-of 2024-01-30

Result tables go to `<out>/<report>/<table>/as_of=<date>`; a rerun of a day replaces it. Reports of a period keep
the folded facts of each day under `<out>/<report>/daily`: a run reads the facts of the days it does not know and
of the last `--renew-days`, once, and everything else from there.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from floortally import constants as C, session
from floortally.operators.asof import MONTH, WEEK, as_date
from floortally.plans import calendar, daily_adherence, device_adherence, funnel, lost_sales, matrix, tenant_reasons
from floortally.sources import csv_days
from floortally.sources.daily_store import DailyStore
from floortally.sources.sinks import write_csv, write_report
from floortally.sources.tables import Tables, parquet_tables
from floortally.sources.tenants import Tenant

# Days from the data day to the day a report is run.
RUN_LAG = {
    "lost_sales": 2,
    "tenant_reasons": 2,
    "funnel": 2,
    "device_adherence": 1,
    "daily_adherence": 1,
    "tenant_matrix": 1,
}


@dataclass(frozen=True)
class Parameters:
    as_of: dt.date
    tenants: Sequence[Tenant] = field(default_factory=tuple)
    regions: Sequence[int] | None = None
    brands: Sequence[int] | None = None
    tenant_like: str | None = None
    device_pattern: str = C.DEVICE_PATTERN
    renew_days: int = 1

    @property
    def renewed(self) -> dt.date:
        return self.as_of - dt.timedelta(self.renew_days - 1)


class Writer:
    """Writes the tables of one report and day, giving back the written rows."""

    def __init__(self, root: str, report: str, as_of: dt.date):
        self.root, self.day = f"{root}/{report}", f"as_of={as_of}"

    def daily(self, spark: SparkSession) -> DailyStore:
        return DailyStore(spark, f"{self.root}/daily")

    def table(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{name}/{self.day}"
        write_report(df, path, mode="overwrite")
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def export(self, name: str, df: DataFrame) -> None:
        write_csv(df, f"{self.root}/{name}_csv/{self.day}", mode="overwrite")


def _week_or_month(as_of: dt.date) -> dt.date:
    return min(as_of - dt.timedelta(as_of.weekday()), as_of.replace(day=1))


def run_lost_sales(t: Tables, p: Parameters, out: Writer) -> None:
    store, first = out.daily(t.interactions.sparkSession), _week_or_month(p.as_of)
    calls = store.bring("lost_calls", first, p.as_of, p.renewed, lambda days: lost_sales.lost_calls(t, days))

    def labels(days: Sequence[dt.date]) -> DataFrame:
        return lost_sales.lost_labels(t.bind(lost_calls=store.days_of("lost_calls", days)))

    t = t.bind(lost_calls=calls, lost_labels=store.bring("lost_labels", first, p.as_of, p.renewed, labels))
    out.table("phone_follow_ups", lost_sales.phone_follow_ups(t, p.as_of))
    out.table("reason_codes", lost_sales.reason_codes(t, p.as_of))
    out.table("category_codes", lost_sales.category_codes(t, p.as_of))
    out.table("follow_ups", lost_sales.follow_ups(t, p.as_of))
    out.table("unsuccessful_total", lost_sales.unsuccessful_total(t, p.as_of))
    out.table("reason_summary", lost_sales.reason_summary(t, p.as_of))
    out.table("top_reasons_mtd", lost_sales.top_reasons(t, p.as_of, MONTH))
    out.table("top_reasons_wtd", lost_sales.top_reasons(t, p.as_of, WEEK))
    out.table("category_issues", lost_sales.category_issues(t, p.as_of))
    out.table("category_trend", lost_sales.category_trend(t, p.as_of))
    out.table("top_reasons_of_day", lost_sales.top_reasons_of_day(t, p.as_of))


def run_tenant_reasons(t: Tables, p: Parameters, out: Writer) -> None:
    store, first = out.daily(t.interactions.sparkSession), _week_or_month(p.as_of)
    calls = store.bring("tenant_calls", first, p.as_of, p.renewed, lambda days: tenant_reasons.tenant_calls(t, p.tenants, days))

    def reasons(days: Sequence[dt.date]) -> DataFrame:
        return tenant_reasons.daily_reasons(t.bind(tenant_calls=store.days_of("tenant_calls", days)), p.tenants)

    t = t.bind(tenant_calls=calls, tenant_reasons=store.bring("tenant_reasons", first, p.as_of, p.renewed, reasons))
    out.table("reason_codes", tenant_reasons.reason_codes(t, p.tenants, p.as_of))
    out.table("objection_codes", tenant_reasons.objection_codes(t, p.tenants, p.as_of))
    out.table("outcome_totals", tenant_reasons.outcome_totals(t, p.tenants, p.as_of))
    out.table("reasons_of_day", tenant_reasons.reasons_of_day(t, p.tenants, p.as_of))
    out.table("reason_trend", tenant_reasons.reason_trend(t, p.tenants, p.as_of))
    out.table("objection_handling", tenant_reasons.objection_handling(t, p.tenants, p.as_of))


def run_funnel(t: Tables, p: Parameters, out: Writer) -> None:
    store = out.daily(t.interactions.sparkSession)
    first = min(p.as_of - dt.timedelta(funnel.WINDOW_DAYS), p.as_of.replace(day=1))
    steps = store.bring("scheme_steps", first, p.as_of, p.renewed, lambda days: funnel.scheme_steps(t, days))

    def sellers(days: Sequence[dt.date]) -> DataFrame:
        return funnel.seller_days(t.bind(scheme_steps=store.days_of("scheme_steps", days)), days)

    t = t.bind(scheme_steps=steps, seller_days=store.bring("seller_days", first, p.as_of, p.renewed, sellers))
    out.table("window", funnel.funnel_window(t, p.as_of, p.regions))
    out.table("month", funnel.funnel_mtd(t, p.as_of, p.regions))
    out.table("combined", funnel.combined(t, p.as_of, p.regions, p.brands))
    out.table("heat", funnel.heat(t, p.as_of, p.regions, p.brands))
    out.table("effectiveness_pitched", funnel.effectiveness(t, p.as_of, False, p.regions))
    out.table("effectiveness_sold", funnel.effectiveness(t, p.as_of, True, p.regions))
    out.export("staff", funnel.staff_funnel(t, p.as_of, p.regions))
    out.export("effectiveness_flags", funnel.effectiveness_flags(t, p.as_of, p.regions))


def run_device_adherence(t: Tables, p: Parameters, out: Writer) -> None:
    """The summaries read the written detail, so the facts are scanned once."""
    detail = device_adherence.adherence_detail(t, p.as_of, p.regions, p.brands, p.tenant_like, p.device_pattern)
    detail = out.table("detail", detail)
    out.export("detail", device_adherence.sorted_detail(detail))
    if "attendance" in t:
        out.table("attendance_rejects", device_adherence.attendance_rejects(t, p.as_of))
    out.table("summary", device_adherence.adherence_summary(detail))
    out.table("stores", device_adherence.store_summary(detail))
    out.table("flagged_managers", device_adherence.flagged_managers(detail))


def run_daily_adherence(t: Tables, p: Parameters, out: Writer) -> None:
    detail = out.table("detail", daily_adherence.daily_adherence(t, p.as_of, p.brands, p.tenant_like, p.device_pattern))
    out.export("detail", device_adherence.sorted_detail(detail, ascending=False))
    out.table("summary", daily_adherence.same_day_summary(detail))


def run_tenant_matrix(t: Tables, p: Parameters, out: Writer) -> None:
    table = out.table("adherence", matrix.adherence_matrix(t, p.tenants, p.as_of))
    out.table("headline", matrix.headline_of(table, p.tenants))
    out.table("reasons", matrix.reason_matrix(t, p.tenants, p.as_of))
    out.table("objections", matrix.objection_matrix(t, p.tenants, p.as_of))
    day = table.sparkSession.range(1, numPartitions=1).select(as_date(p.as_of).alias("as_of"))
    out.table("weeks", calendar.week_calendar(day))


REPORTS: dict[str, Callable[[Tables, Parameters, Writer], None]] = {
    "lost_sales": run_lost_sales,
    "tenant_reasons": run_tenant_reasons,
    "funnel": run_funnel,
    "device_adherence": run_device_adherence,
    "daily_adherence": run_daily_adherence,
    "tenant_matrix": run_tenant_matrix,
}


def run(report: str, t: Tables, parameters: Parameters, out: str) -> None:
    REPORTS[report](t, parameters, Writer(out, report, parameters.as_of))


def as_of_for(report: str, run_day: dt.date) -> dt.date:
    """The data day a run on `run_day` reports on."""
    return run_day - dt.timedelta(RUN_LAG[report])


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Run one report and write its tables.")
    parser.add_argument("--report", choices=list(REPORTS), required=True)
    parser.add_argument("--tables", required=True, help="folder with one Parquet dataset per role")
    parser.add_argument("--out", required=True)
    day = parser.add_mutually_exclusive_group(required=True)
    day.add_argument("--as-of", type=dt.date.fromisoformat)
    day.add_argument("--run-day", type=dt.date.fromisoformat)
    parser.add_argument("--tenants", help="JSON file: {name: shift seconds}")
    parser.add_argument("--attendance", help="folder with day=YYYY-MM-DD CSV drops")
    parser.add_argument("--regions", type=int, nargs="*")
    parser.add_argument("--brands", type=int, nargs="*")
    parser.add_argument("--tenant-like", help="LIKE pattern on audio paths")
    parser.add_argument("--renew-days", type=int, default=1, help="last days whose folded facts are built anew")
    parser.add_argument("--device-pattern", default=C.DEVICE_PATTERN, help="regular expression of device codes")
    return parser.parse_args()


def main() -> None:
    args = _arguments()
    spark = session.build(f"floortally {args.report}")
    as_of = args.as_of or as_of_for(args.report, args.run_day)
    tenants: list[Tenant] = []
    if args.tenants:
        with open(args.tenants, encoding="utf-8") as file:
            tenants = [Tenant(name, seconds) for name, seconds in json.load(file).items()]
    tables = parquet_tables(spark, args.tables)
    if args.attendance:
        first, last = device_adherence.attendance_days(as_of)
        tables = tables.bind(attendance=csv_days.read_days(spark, args.attendance, first, last))
    parameters = Parameters(as_of, tenants, args.regions, args.brands, args.tenant_like, args.device_pattern, args.renew_days)
    run(args.report, tables, parameters, args.out)


if __name__ == "__main__":
    main()
