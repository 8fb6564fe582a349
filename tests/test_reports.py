"""Reports on hand-made rows for the semantics the driver tables cannot show."""

import datetime as dt

import pyarrow as pa
import pytest
from pyspark.sql import functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from floortally.operators.asof import DAILY, MONTH, MONTH_END, WEEK
from floortally.plans import calendar, daily_adherence, device_adherence, funnel, lost_sales, matrix, tenant_reasons
from floortally.sources.tables import SCHEMAS, Tables
from floortally.sources.tenants import Tenant

D = dt.date
DAY = D(2024, 5, 15)


def frame(spark, role, rows):
    """Rows given as dicts of the interesting columns."""
    schema = T.StructType.fromDDL(SCHEMAS[role])
    return spark.createDataFrame(pa.Table.from_pylist(rows, to_arrow_schema(schema)), schema)


def bound(spark, **roles):
    empty = {role: frame(spark, role, []) for role in SCHEMAS}
    return Tables({}).bind(**{**empty, **{role: frame(spark, role, rows) for role, rows in roles.items()}})


def call(number, day=DAY, **extra):
    base = dict(id=number, interaction_code=f"C{number}", date=day, duration="180001", sales_outcome="unsuccessful")
    return {**base, "path": "/shop one/x", "phone_number_discussion": '[{"phone_number_exchange":true}]', **extra}


def flag(number, reasons, **extra):
    base = dict(id=number * 10, interaction_id=number, sales_outcome="sale_unsuccessful", type_of_interaction="sales")
    return {**base, "reason_loss_of_sale": reasons, **extra}


GLITCH = '[{"category":"Product","sub_category":"Technical Glitch","reason":"r"},{"sub_category":"Other"}]'


@pytest.fixture
def sales(spark):
    two_phones = '[{"phone_number":"1","phone_number_exchange":true},{"phone_number":"2","phone_number_exchange":true},{"phone_number_exchange":false}]'
    return bound(
        spark,
        interactions=[
            call(1, phone_number_discussion=two_phones),
            call(2, duration="180000"),
            call(3, phone_number_discussion=None),
            call(4),
            call(5, day=D(2024, 5, 1)),
            call(6, day=D(2024, 4, 30)),
        ],
        interaction_flags=[
            flag(1, GLITCH, primary_category_new='[{"category":"Bed"},{"category":"Sofa"},{"category":" "}]'),
            flag(2, GLITCH),
            flag(3, GLITCH),
            flag(4, '[{"sub_category":"Other"}]'),
            flag(5, None),
            flag(6, "[]"),
        ],
    )


def test_follow_ups_are_the_product_of_phones_and_reasons(sales):
    rows = lost_sales.follow_ups(sales, DAY).collect()
    assert sorted((r.phone_number, r.sub_category, r.reason) for r in rows) == [
        ("1", "Other", None),
        ("1", "Technical Glitch", "r"),
        ("2", "Other", None),
        ("2", "Technical Glitch", "r"),
    ]


def test_reason_summary_counts_rows_against_lost_sales(sales):
    got = {r.sub_category: r for r in lost_sales.reason_summary(sales, DAY).collect()}
    glitch = got["Technical Glitch"]
    assert (glitch.interactions, glitch.pct) == (2, 66.7)
    assert len(got) == 3 and got["Deferred decision making"].interactions == 0
    assert [tuple(r)[1:] for r in lost_sales.reason_codes(sales, DAY).collect()] == [("Technical Glitch", "C1", 2)]
    assert [tuple(r) for r in lost_sales.phone_follow_ups(sales, DAY).collect()] == [(DAY, 3, 4)]


def test_reason_summary_lists_the_codes_behind_its_counts(sales):
    for as_of in (DAY, DAILY):
        rows = lost_sales.reason_summary(sales, as_of, lists=True).where(F.col("as_of") == F.lit(DAY)).collect()
        got = {r.sub_category: (r.part, r.interactions, r.pct, r.interaction_codes) for r in rows}
        assert got == {"Technical Glitch": (0, 2, 66.7, "C1, C1"), "Deferred decision making": (0, 0, 0.0, ""), "Uncertainty in dimension": (0, 0, 0.0, "")}


def test_category_table_counts_the_product_but_lists_codes_once(sales):
    got = {r.prod_category: r for r in lost_sales.category_issues(sales, DAY).collect()}
    assert got.keys() == {"Bed", "Sofa"}
    assert (got["Bed"].glitch_count, got["Bed"].deferred_count) == (2, 0)
    codes = {tuple(r)[1:] for r in lost_sales.category_codes(sales, DAY).collect()}
    assert codes == {("Bed", "Technical Glitch", "C1", 2), ("Sofa", "Technical Glitch", "C1", 2)}


def test_category_table_lists_the_codes_of_its_cells(sales):
    rows = lost_sales.category_issues(sales, DAILY, lists=True).where(F.col("as_of") == F.lit(DAY)).collect()
    got = {r.prod_category: (r.part, r.glitch_count, r.glitch_codes, r.deferred_codes, r.uncertainty_codes) for r in rows}
    assert got == {"Bed": (0, 2, "C1", "", ""), "Sofa": (0, 2, "C1", "", "")}


def test_month_and_week_to_date(sales):
    month = {(r.category, r.interactions) for r in lost_sales.top_reasons(sales, DAY, MONTH, 5).collect()}
    assert month == {("Other", 3), ("Technical Glitch", 2), (None, 1)}
    week = {(r.category, r.interactions) for r in lost_sales.top_reasons(sales, DAY, WEEK, 5).collect()}
    assert week == {("Other", 3), ("Technical Glitch", 2)}
    history = lost_sales.top_reasons(sales, DAILY, MONTH, 5).where(F.col("as_of") == F.lit(DAY))
    assert {(r.category, r.interactions) for r in history.collect()} == month
    end = lost_sales.reason_trend(sales, MONTH_END).where(F.col("category").isNull()).collect()
    assert {(r.as_of, r.mtd) for r in end} == {(D(2024, 5, 31), 1), (D(2024, 4, 30), 1)}


def test_recurring_codes_count_once_in_a_period(spark):
    bed = '[{"category":"Bed"}]'
    days = {1: ("A", DAY), 2: ("", DAY), 3: ("A", DAY - dt.timedelta(days=1)), 4: (None, DAY)}
    t = bound(
        spark,
        interactions=[call(n, interaction_code=code, day=day) for n, (code, day) in days.items()],
        interaction_flags=[flag(n, "[]", primary_category_new=bed) for n in days],
    )
    assert [(r.prod_category, r.mtd) for r in lost_sales.category_trend(t, DAY).collect()] == [("Bed", 2)]


def test_loss_categories_of_the_day_list_their_codes(spark):
    reasons = '[{"category":"Price"},{"category":"Price"},{"category":"Elsewhere"}]'
    codes = {1: " B ", 2: "A", 3: None, 4: " "}
    t = bound(spark, interactions=[call(n, path="/a/shop_one/1", interaction_code=code, reason_loss_of_sale=reasons) for n, code in codes.items()])
    named = [Tenant("Shop One"), Tenant("Nobody Called")]
    for as_of in (DAY, DAILY):
        found = tenant_reasons.reasons_of_day(t, named, as_of, lists=True).collect()
        assert len(found) == (10 if as_of == DAY else 5) and {r.part for r in found} == {0}
        cells = {(r.tenant, r.category): (r.interactions, r.pct, r.interaction_codes) for r in found}
        assert cells.pop(("Shop One", "Price")) == (8, 266.7, "A, A, B, B")
        assert set(cells.values()) == {(0, 0.0, "")}


def test_objection_table_lists_the_codes_of_its_cells(spark):
    objections = '[{"category":"price_issue","handling":"Solution"},{"category":"price_issue","handling":"Solution"},{"category":"not_applicable"}]'
    codes = {1: "B", 2: "A", 3: None, 4: " "}
    t = bound(spark, interactions=[call(n, path="/a/shop_one/1", interaction_code=code, customer_objection_handling=objections) for n, code in codes.items()])
    named = [Tenant("Shop One"), Tenant("Nobody Called")]
    for as_of in (DAY, DAILY):
        found = tenant_reasons.objection_handling(t, named, as_of, lists=True).collect()
        assert len(found) == (16 if as_of == DAY else 8) and {r.part for r in found} == {0}
        cells = {(r.tenant, r.objection): (r.solution_count, r.solution_codes, r.generic_count, r.generic_codes, r.explanation_codes) for r in found}
        assert cells.pop(("Shop One", "Price Issue")) == (8, "A, A, B, B", 0, "", "")
        assert set(cells.values()) == {(0, "", 0, "", "")}
        assert {(r.tenant, r.total_objections) for r in found} <= {("Shop One", 8), ("Nobody Called", 0)}


def test_tenant_tables_keep_idle_categories(spark):
    reasons = '[{"category":"Price"},{"category":"Price"},{"category":"Elsewhere"}]'
    objections = '[{"category":"price_issue","handling":"Solution"},{"category":"not_applicable"},{"category":"new_kind","handling":"Generic"}]'
    t = bound(
        spark,
        interactions=[
            call(1, path="/a/shop_one/1", reason_loss_of_sale=reasons, customer_objection_handling=objections),
            call(2, path="/a/shopxone/2", sales_outcome="successful"),
        ],
    )
    named = [Tenant("Shop One")]
    day = {r.category: r for r in tenant_reasons.reasons_of_day(t, named, DAY).collect()}
    assert len(day) == 5 and (day["Price"].interactions, day["Price"].pct) == (2, 200.0)
    assert day["Product"].interactions == 0
    assert [tuple(r) for r in tenant_reasons.reason_codes(t, named, DAY).collect()] == [("Shop One", DAY, "Price", "C1", 2)]
    table = {r.objection: r for r in tenant_reasons.objection_handling(t, named, DAY).collect()}
    assert len(table) == 8 and table["Price Issue"].solution_count == 1
    codes = tenant_reasons.objection_codes(t, named, DAY).collect()
    assert [tuple(r)[2:] for r in codes] == [("Price Issue", "Solution", "C1", 1)]
    assert {r.total_objections for r in table.values()} == {2}
    both = [*named, Tenant("Nobody Called")]
    for report, n in ((tenant_reasons.reasons_of_day, 5), (tenant_reasons.reason_trend, 5), (tenant_reasons.objection_handling, 8)):
        found = report(t, both, DAY).collect()
        idle = [r.asDict() for r in found if r.tenant == "Nobody Called"]
        assert len(idle) == n and len(found) == 2 * n
        assert all(v == 0 for r in idle for v in r.values() if isinstance(v, (int, float)))
    totals = tenant_reasons.outcome_totals(t, named, DAY).collect()
    assert {(r.sales_outcome, r.total_interactions, r.total_unsuccessful) for r in totals} == {
        ("unsuccessful", 2, 1),
        ("successful", 2, 1),
    }


@pytest.fixture
def floor(spark):
    people = [dict(id=n, name=f"P{n}", employee_id=f"e{n}", store_id=1) for n in (1, 2)]
    people.append(dict(id=3, name="P3", employee_id=None, store_id=2))
    devices = [
        dict(name="t0001", store_id=1, sales_person_id=1, assigned_on=DAY, unassigned_on=DAY),
        dict(name="t0002", store_id=1, sales_person_id=2, assigned_on=D(2024, 1, 1), comments="To be Delete Row"),
        dict(name="t0003", store_id=2, sales_person_id=3, assigned_on=D(2024, 1, 1), comments="fine"),
        dict(name="t0009", store_id=2, sales_person_id=3, assigned_on=D(2024, 1, 1), unassigned_on=D(2024, 5, 14)),
    ]

    def audio(number, device, staff, clock="120000", duration="00:10:00", speech="300", day=DAY, created=None):
        return dict(
            id=number, path=f"/audio/shop_one/T{device:04d}/{number}", filename=f"20240515_{clock}.wav", date=day,
            createddate=created or day, duration=duration, speech_duration=speech, sales_person_id=staff,
        )

    files = [
        audio(1, 1, 1),
        audio(2, 1, 1, clock="092959"),
        audio(3, 1, 1, created=DAY + dt.timedelta(1)),
        audio(4, 1, 1, duration=None),
        audio(5, 3, 3, speech="59"),
        audio(6, 3, 3, day=D(2024, 5, 1), duration="30:00:00", speech="50000"),
        audio(7, 7, None, day=D(2024, 5, 2)),
    ]
    return bound(
        spark,
        sales_persons=people,
        devices=devices,
        device_registrations=[dict(name="t0001", store_id=1, brand_id=5), dict(name="t0008", store_id=1, brand_id=6)],
        stores=[
            dict(id=1, name="S1", brand_id=5, abm_id=1, regional_manager_id=3),
            dict(id=2, name="S2", brand_id=5, abm_id=None, regional_manager_id=3),
        ],
        managers=[dict(id=1, user_id=9)],
        users=[dict(id=9, name="M")],
        brands=[dict(id=5, name="Shop One")],
        salesperson_stores=[
            dict(sp_id=1, store_id=1, start_date=D(2024, 5, 10)),
            dict(sp_id=3, store_id=2, start_date=D(2024, 1, 1), end_date=D(2024, 5, 14)),
        ],
        audio_files=files,
    )


def test_device_roster(floor):
    got = {(r.device, r.staff_name, r.employee_id, r.manager) for r in device_adherence.device_roster(floor, DAY).collect()}
    assert got == {("t0001", "P1", "E1", "M"), ("t0002", None, None, "M"), ("t0003", "P3", None, None), ("t0008", None, None, "M")}
    brand = device_adherence.device_roster(floor, DAY, brands=[5], regions=[3]).collect()
    assert {r.device for r in brand} == {"t0001", "t0002", "t0003"}
    assert device_adherence.device_roster(floor, DAY, regions=[26]).collect() == []


def test_file_statistics_cover_same_day_working_hours(floor):
    got = {r.device: r for r in device_adherence.device_file_stats(floor, DAY, 6).collect()}
    assert got.keys() == {"t0001", "t0003"}
    one = got["t0001"]
    assert (one.total_files, one.valid_files, one.blank_files, one.recorded_seconds, one.active_days) == (2, 1, 1, 600.0, 1)
    assert (got["t0003"].valid_files, got["t0003"].blank_files) == (0, 1)


def test_staff_month_covers_every_upload_and_keeps_the_null_group(floor):
    got = {r.employee_id: r for r in device_adherence.staff_mtd(floor, DAY).collect()}
    assert (got["E1"].mtd_recorded_seconds, got["E1"].mtd_days_received, got["E1"].mtd_blank_pct) == (1800.0, 1, 25.0)
    assert (got[None].mtd_recorded_seconds, got[None].mtd_days_received) == (109200.0, 3)


def test_detail_falls_back_to_default_shift_and_null_employees_meet(floor):
    got = {r.device: r for r in device_adherence.adherence_detail(floor, DAY).collect()}
    one = got["t0001"]
    assert (one.wtd_shift_seconds, one.adherence_pct, one.blank_pct) == (34200.0, 1.8, 50.0)
    assert one.comments == "High Blank Files, Low Device Adherence"
    assert got["t0002"].mtd_recorded_seconds == 109200.0 and got["t0002"].wtd_shift_seconds is None
    plain = device_adherence.adherence_detail(floor, DAY, null_safe=False).where("device = 't0002'").first()
    assert plain.mtd_recorded_seconds is None
    wrapped = device_adherence.adherence_detail(floor, DAY, wrap_24h=True).where("device = 't0002'").first()
    assert (got["t0002"].mtd_shift_seconds, wrapped.mtd_shift_seconds) == (102600.0, 16200.0)


def test_summaries_drop_null_managers(floor):
    detail = device_adherence.adherence_detail(floor, DAY)
    rows = device_adherence.adherence_summary(detail).collect()
    assert [(r.manager, r.total_devices, r.inactive_devices, r.active_devices, r.total_files) for r in rows] == [("M", 3, 2, 1, 2)]
    flagged = device_adherence.flagged_managers(detail).collect()
    assert {(r.manager, r.is_total, r.time_log_pct, r.blank_pct) for r in flagged} == {("M", False, 2, 50), ("Grand Total", True, 2, 50)}


def test_daily_adherence(floor):
    got = {r.device: r for r in daily_adherence.daily_adherence(floor, DAY).collect()}
    one = got["t0001"]
    assert (one.device_active, one.adherence_pct, one.blank_pct) == ("Yes", 2.1, 50.0)
    assert got["t0002"].device_active == "No" and got["t0002"].mtd_seconds == 600.0
    total = daily_adherence.same_day_summary(daily_adherence.daily_adherence(floor, DAY)).where("is_total").first()
    assert (total.total_devices, total.same_day_received, total.same_day_not_received, total.active_pct) == (3, 1, 2, 33)


def test_assignments_bound_the_audio(floor):
    named = [Tenant("Shop One", 36000), Tenant("Idle")]
    rows = matrix.assignment_audio(floor, named, DAY).collect()
    assert {(r.name, r.id, r.week, r.day_label) for r in rows} == {
        ("P1", 1, "Week 3", "D-1"),
        ("P1", 4, "Week 3", "D-1"),
        ("P3", 6, "Week 1", "D-X"),
    }
    got = matrix.adherence_matrix(floor, named, DAY).where("name = 'P1'").first()
    assert (got.mtd_hours, got.total_files, got.d_1, got.d_1_band, got.week_6) == ("0:10:00", 2, 1.7, "critical", 0.0)
    long = matrix.month_hours(floor, named, DAY).where("name = 'P3'").first()
    assert long.mtd_hours == "30:00:00"
    head = {r.tenant: (r.avg_adherence, r.active_staff, r.total_staff) for r in matrix.headline(floor, named, DAY).collect()}
    assert head == {"Shop One": (1, 1, 2), "Idle": (0, 0, 0)}


def test_idle_staff_count_no_files(floor):
    quiet = floor.bind(audio_files=floor.audio_files.limit(0))
    got = matrix.blank_percentages(quiet, [Tenant("Shop One")], DAY).collect()
    assert {(r.name, r.total_files, r.blank_pct) for r in got} == {("P1", 0, 0.0), ("P3", 0, 0.0)}


def test_active_roster_at_a_day(floor):
    rows = funnel.active_roster(floor, DAY, regions=[3], brands=[5]).collect()
    assert [(r.manager, r.total_store_count, r.total_executive_count) for r in rows] == [("M", 1, 1)]
    earlier = funnel.active_roster(floor, D(2024, 5, 14)).collect()
    assert {(r.manager, r.total_executive_count) for r in earlier} == {("M", 1), (None, 1)}


def test_six_week_calendar(spark):
    days = spark.createDataFrame([(D(2024, 6, 15),)], "as_of date")
    got = [(r.week, r.start_date.day, r.end_date.day, r.working_days) for r in calendar.week_calendar(days).collect()]
    assert sorted(got) == [
        ("Week 1", 1, 1, 1),
        ("Week 2", 2, 8, 7),
        ("Week 3", 9, 15, 7),
        ("Week 4", 16, 22, 0),
        ("Week 5", 23, 29, 0),
        ("Week 6", 30, 30, 0),
    ]
