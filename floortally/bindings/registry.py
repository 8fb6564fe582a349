"""The reports registered over the driver tables, one callable per key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from floortally.bindings import driver as D
from floortally.operators.asof import DAILY, MONTH, MONTH_END, WEEK
from floortally.operators.display import as_text
from floortally.plans import calendar, daily_adherence, device_adherence, funnel, lost_sales, matrix, tenant_reasons

Query = Callable[[SparkSession, str], DataFrame]


def _sales(report: Callable, *args, **kwargs) -> Query:
    return lambda spark, sf_dir: report(D.sales_floor(spark, sf_dir), *args, **kwargs)


def _audio(report: Callable, *args, **kwargs) -> Query:
    return lambda spark, sf_dir: report(D.audio_floor(spark, sf_dir), *args, **kwargs)


def _from_detail(report: Callable) -> Query:
    return lambda spark, sf_dir: report(
        device_adherence.adherence_detail(D.audio_floor(spark, sf_dir), D.AS_OF, pattern=D.DEVICE_PATTERN)
    )


def _from_daily(report: Callable) -> Query:
    return lambda spark, sf_dir: report(
        daily_adherence.daily_adherence(D.audio_floor(spark, sf_dir), D.AS_OF, pattern=D.DEVICE_PATTERN)
    )


def week_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendars of all months with interactions, each as of its last interaction day."""
    days = D.sales_floor(spark, sf_dir).interactions.select("date")
    months = days.groupBy(F.trunc("date", "MM").alias("month")).agg(F.max("date").alias("as_of")).select("as_of")
    return calendar.week_calendar(months)


def report_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Period bounds of every day with interactions."""
    return calendar.report_periods(D.sales_floor(spark, sf_dir).interactions.select(F.col("date").alias("as_of")))


QUERIES: dict[str, Query] = {
    "topk_reason_mtd": _sales(lost_sales.top_reasons, DAILY, MONTH),
    "topk_reason_wtd": _sales(lost_sales.top_reasons, DAILY, WEEK),
    "reason_trend": _sales(lost_sales.reason_trend, DAILY),
    "top5_share": _sales(lost_sales.top_reasons_of_day, DAILY),
    "lost_sale_followups": _sales(lost_sales.follow_ups, DAILY),
    "unsuccessful_total": _sales(lost_sales.unsuccessful_total, DAILY),
    "phone_follow_ups": _sales(lost_sales.phone_follow_ups, DAILY),
    "reason_summary": _sales(lost_sales.reason_summary, DAILY),
    "reason_summary_codes": _sales(lost_sales.reason_summary, DAILY, lists=True),
    "reason_issue_codes": _sales(lost_sales.reason_codes, DAILY),
    "category_issue_crosstab": _sales(lost_sales.category_issues, DAILY, lists=True),
    "category_issue_codes": _sales(lost_sales.category_codes, DAILY),
    "category_wtd_mtd": _sales(lost_sales.category_trend, DAILY),
    "outcome_totals_by_tenant": _sales(tenant_reasons.outcome_totals, D.ORDER_TENANTS, DAILY),
    "reason_domain_day": _sales(tenant_reasons.reasons_of_day, D.ORDER_TENANTS, DAILY, lists=True),
    "reason_domain_codes": _sales(tenant_reasons.reason_codes, D.ORDER_TENANTS, DAILY),
    "reason_domain_wtd_mtd": _sales(tenant_reasons.reason_trend, D.ORDER_TENANTS, DAILY),
    "objection_handling_matrix": _sales(tenant_reasons.objection_handling, D.ORDER_TENANTS, DAILY, lists=True),
    "objection_handling_codes": _sales(tenant_reasons.objection_codes, D.ORDER_TENANTS, DAILY),
    "category_wtd_mtd_one_day": _sales(lost_sales.category_trend, D.SALES_DAY),
    "reason_domain_one_day": _sales(tenant_reasons.reasons_of_day, D.CONFIGURED_TENANTS, D.SALES_DAY),
    "reason_domain_wtd_mtd_one_day": _sales(tenant_reasons.reason_trend, D.CONFIGURED_TENANTS, D.SALES_DAY),
    "objection_handling_one_day": _sales(tenant_reasons.objection_handling, D.CONFIGURED_TENANTS, D.SALES_DAY),
    "funnel_window": _audio(funnel.funnel_window, D.AS_OF),
    "funnel_region": _audio(funnel.funnel_window, D.AS_OF, [3]),
    "funnel_combined_region_brand": _audio(funnel.combined, D.AS_OF, [26], [0, 2]),
    "funnel_mtd": _audio(funnel.funnel_mtd, D.AS_OF),
    "funnel_staff": _audio(funnel.staff_funnel, D.AS_OF),
    "funnel_combined_total": _audio(funnel.combined, D.AS_OF),
    "roster_asof": _audio(funnel.active_roster, D.AS_OF),
    "effectiveness_flags": _audio(funnel.effectiveness_flags, D.AS_OF),
    "effectiveness_pitched": _audio(funnel.effectiveness, D.AS_OF, False),
    "effectiveness_sold": _audio(funnel.effectiveness, D.AS_OF, True),
    "heat_minmax": _audio(funnel.heat, D.AS_OF),
    "device_roster": _audio(device_adherence.device_roster, D.AS_OF),
    "device_file_stats": _audio(device_adherence.device_file_stats, D.AS_OF, pattern=D.DEVICE_PATTERN),
    "attendance_rollup": _audio(device_adherence.attendance_rollup, D.AS_OF),
    "attendance_rejects": _audio(device_adherence.attendance_rejects, D.AS_OF),
    "staff_mtd": _audio(device_adherence.staff_mtd, D.AS_OF),
    "blank_rules": _audio(device_adherence.blank_rules, D.AS_OF),
    "adherence_detail": _from_detail(device_adherence.sorted_detail),
    "adherence_region_brand": _audio(device_adherence.adherence_detail, D.AS_OF, [26], [1, 3], pattern=D.DEVICE_PATTERN),
    "adherence_summary": _from_detail(device_adherence.adherence_summary),
    "store_flags": _from_detail(device_adherence.store_summary),
    "flagged_managers_total": _from_detail(device_adherence.flagged_managers),
    "staff_hours_wtd_mtd": _audio(daily_adherence.staff_hours, D.AS_OF),
    "daily_adherence": _from_daily(lambda detail: detail),
    "same_day_summary": _from_daily(daily_adherence.same_day_summary),
    "assignment_range_join": _audio(matrix.assignment_audio, D.BRAND_TENANTS, D.AS_OF),
    "blank_pct": _audio(matrix.blank_percentages, D.BRAND_TENANTS, D.AS_OF),
    "mtd_hours": _audio(matrix.month_hours, D.BRAND_TENANTS, D.AS_OF),
    "week_matrix": _audio(matrix.week_matrix, D.BRAND_TENANTS, D.AS_OF),
    "day_matrix": _audio(matrix.day_matrix, D.BRAND_TENANTS, D.AS_OF),
    "adherence_bands": _audio(matrix.adherence_matrix, D.BRAND_TENANTS, D.AS_OF),
    "reason_matrix": _sales(matrix.reason_matrix, D.ORDER_TENANTS, MONTH_END),
    "objection_matrix": _sales(matrix.objection_matrix, D.ORDER_TENANTS, MONTH_END),
    "headline": _audio(matrix.headline, D.BRAND_TENANTS, D.AS_OF),
    "week_calendar": week_calendar,
    "report_periods": report_periods,
    "category_display": _sales(lambda t: as_text(lost_sales.category_trend(t, DAILY), ["wtd", "mtd"])),
    "adherence_display": _audio(
        lambda t: as_text(
            matrix.adherence_matrix(t, D.BRAND_TENANTS, D.AS_OF).select(*matrix.STAFF_KEYS, *matrix.RATES),
            percents=matrix.RATES,
        )
    ),
}
