"""Roles derived from the TPC-H-like tables and `events`, row by row, with no sampling.

sales floor (orders, lineitem): `interactions` = orders, `interaction_flags` = lineitem.
audio floor (events): `interactions`, `scheme_flags`, `audio_files`, `attendance`.
organisation: brand = region, area manager = nation, store = supplier, staff = customer.
Nested columns are JSON text built from the row's own values, so a hot order key never
gathers its lines in one task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from floortally import constants as C
from floortally.sources.tables import Tables
from floortally.sources.tenants import Tenant

AS_OF = dt.date(2024, 1, 30)
SALES_DAY = dt.date(1998, 8, 15)
STAFF_PER_STORE = 15
STAFF_STEP = 10
DEVICE_PATTERN = "T[0-9]{4,}"
ORDER_TENANTS = [Tenant("Urgent"), Tenant("High"), Tenant("Medium"), Tenant("Not Specified"), Tenant("Low")]
#: With a tenant that never called.
CONFIGURED_TENANTS = [*ORDER_TENANTS, Tenant("Dormant")]
BRAND_TENANTS = [
    Tenant("AFRICA", 28_800),
    Tenant("AMERICA", 25_200),
    Tenant("ASIA", 30_600),
    Tenant("EUROPE", 30_600),
    Tenant("MIDDLE EAST", 36_000),
]


def _array(*values: str | None) -> str:
    return "array(" + ", ".join("null" if v is None else f"'{v}'" for v in values) + ")"


#: The reports' own labels and others beside them.
LABELS = {
    "loss": _array(*C.LOSS_CATEGORIES, "Store", None),
    "issue": _array(*C.FOLLOW_UP_ISSUES, "Price concern", "Delivery time", None),
    "product": _array("Mattress", "Sofa", "Bed", "", None),
    "objection": _array(*C.OBJECTION_CATEGORIES, *C.NO_OBJECTION, None),
    "handling": _array(*C.HANDLINGS, "Deferred"),
    "brand": _array("africa", "america", "asia", "europe", "middle_east"),
}


def _pick(labels: str, index: str) -> str:
    return f"element_at({LABELS[labels]}, cast(pmod({index}, size({LABELS[labels]})) as int) + 1)"


def _json_rows(count: str, at_most: int, texts: dict[str, str], raw: dict[str, str] | None = None) -> str:
    """JSON array of `count` (<= at_most) objects built from the row; in the fields `{i}` runs
    from 0. A NULL field is left out of its object; a zero count gives NULL."""

    def thing(i: int) -> str:
        fields = [f"concat('\"{name}\":\"', {value.format(i=i)}, '\"')" for name, value in texts.items()]
        fields += [f"concat('\"{name}\":', {value.format(i=i)})" for name, value in (raw or {}).items()]
        return f"if({count} > {i}, concat('{{', concat_ws(',', {', '.join(fields)}), '}}'), null)"

    rows = ", ".join(thing(i) for i in range(at_most))
    return f"if({count} > 0, concat('[', concat_ws(',', {rows}), ']'), null)"


def _device(number: str) -> str:
    return f"lpad(cast({number} as string), greatest(4, length(cast({number} as string))), '0')"


def _loader(spark: SparkSession, sf_dir: str):
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_calls(orders: DataFrame) -> DataFrame:
    reasons = _json_rows("o_orderkey % 4", 3, {"category": _pick("loss", "o_custkey + {i}")})
    objections = _json_rows(
        "o_custkey % 3",
        2,
        {"category": _pick("objection", "o_orderkey + {i}"), "handling": _pick("handling", "o_custkey + {i}")},
    )
    phones = _json_rows(
        "o_orderkey % 3",
        2,
        {"exchange_context": "if((o_custkey + {i}) % 2 = 0, 'follow-up', 'catalogue')"},
        {
            "phone_number": "9000000000 + o_orderkey * 2 + {i}",
            "phone_number_exchange": "(o_orderkey + {i}) % 4 <> 0",
        },
    )
    return orders.selectExpr(
        "o_orderkey as id",
        "concat('audio/', o_orderkey, '.wav') as audio_url",
        "case when o_orderkey % 31 = 7 then null when o_orderkey % 37 = 9 then ' ' else concat('IC-', o_orderkey) end "
        "as interaction_code",
        "o_orderdate + make_dt_interval(0, 0, 0, o_orderkey % 43200) as start_time",
        "o_orderdate + make_dt_interval(0, 0, 0, o_orderkey % 43200 + 600) as end_time",
        "cast(o_orderdate as date) as date",
        "if(o_orderkey % 97 = 0, 'n/a', cast(cast(floor(o_totalprice) as bigint) as string)) as duration",
        "o_custkey as sales_person_id",
        f"o_custkey div {STAFF_PER_STORE} as store_id",
        "concat('/audio/', lower(replace(substring(o_orderpriority, 3), ' ', '_')), '/', o_orderkey, '.wav') as path",
        "case o_orderstatus when 'F' then 'unsuccessful' when 'O' then 'successful' else 'follow_up' end "
        "as sales_outcome",
        f"{phones} as phone_number_discussion",
        f"if(o_orderkey % 8 = 4, '[]', {reasons}) as reason_loss_of_sale",
        f"{objections} as customer_objection_handling",
    )


def line_flags(lineitem: DataFrame) -> DataFrame:
    quantity = "cast(l_quantity as bigint)"
    return lineitem.selectExpr(
        "l_orderkey * 8 + l_linenumber as id",
        "l_orderkey as interaction_id",
        "if(l_returnflag = 'A', 'sale_successful', 'sale_unsuccessful') as sales_outcome",
        "if(l_linestatus = 'O', 'sales', 'service') as type_of_interaction",
        _json_rows("l_linenumber % 3", 2, {"category": _pick("product", "l_partkey + {i}")}) + " as primary_category_new",
        _json_rows(
            f"{quantity} % 4",
            3,
            {
                "category": _pick("loss", "l_suppkey + {i}"),
                "sub_category": _pick("issue", "l_partkey + l_suppkey + {i}"),
                "reason": "concat('reason ', l_partkey % 10)",
            },
        )
        + " as reason_loss_of_sale",
        "if(l_linenumber % 2 = 0, '[{\"category\":\"price_issue\"}]', null) as customer_objection_handling",
    )


def _numbered_events(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id",
        "ts",
        "cast(ts as date) as day",
        "event_type",
        f"user_id * {STAFF_STEP} as staff",
        "value",
        "cast(get_json_object(props, '$.k') as bigint) as k",
    )


def event_calls(events: DataFrame) -> DataFrame:
    return _numbered_events(events).selectExpr(
        "event_id as id",
        "concat('EV-', event_id) as interaction_code",
        "day as date",
        "cast(cast(floor(value * 10000) as bigint) as string) as duration",
        "if(k % 10 = 9, null, staff) as sales_person_id",
        f"staff div {STAFF_PER_STORE} as store_id",
    )


def event_schemes(events: DataFrame) -> DataFrame:
    pitched = "(k + {i}) % 2"
    sop = _json_rows(
        "(k + 2) % 3",
        2,
        {"gms_redemption_flexibility": "if(k % 11 = 0, 'na', cast((k div 4 + {i}) % 2 as string))"},
        {
            "gms_pitched": pitched,
            "gms_sold": pitched + " * if((k + {i}) % 5 in (1, 3), 1, 0)",
            "gms_monthly_payment": "(k div 2 + {i}) % 2",
            "gms_redemption_exclusion": "(k div 3 + {i}) % 2",
            "gms_rules_penalties": "(k div 5 + {i}) % 2",
            "gms_benefit_stacking": "(k div 7 + {i}) % 2",
        },
    )
    return _numbered_events(events).selectExpr("event_id as id", "event_id as interaction_id", f"{sop} as sop_new")


def _interval_forms(seconds: str, clock: str) -> str:
    """The same duration in other forms of interval text, for some rows each."""
    forms = [
        f"concat({seconds}, ' seconds')",
        f"concat({seconds} div 60, ' mins ', {seconds} % 60, '.0 secs')",
        f"concat('0 days ', {clock})",
        f"cast({seconds} as string)",
        f"concat('+', {clock})",
        f"concat({seconds} div 3600, 'h', {seconds} % 3600 div 60, 'm', {seconds} % 60, 's')",
        f"if({seconds} % 60 = 0, substring({clock}, 1, length({clock}) - 3), {clock})",
        f"concat('@ -', {seconds}, ' sec ago')",
    ]
    return " ".join(f"when k % 20 = {11 + i} then {form}" for i, form in enumerate(forms))


def event_audio(events: DataFrame) -> DataFrame:
    seconds = "(cast(floor(value / 5) as bigint) * 100)"
    clock = (
        f"concat(lpad(cast({seconds} div 3600 as string), 2, '0'), ':', "
        f"lpad(cast({seconds} div 60 % 60 as string), 2, '0'), ':', lpad(cast({seconds} % 60 as string), 2, '0'))"
    )
    brand = _pick("brand", f"staff div {STAFF_PER_STORE}")
    return _numbered_events(events).selectExpr(
        "event_id as id",
        f"concat('/audio/', if(event_type = 'error', 'misc', {brand}), '/T', {_device('staff')}, '/', event_id) as path",
        "concat(date_format(ts, 'yyyyMMdd_HHmmss'), '.wav') as filename",
        "day as date",
        "if(k % 10 = 0 and k <> 10, date_add(day, 1), day) as createddate",
        f"case when k = 7 then null when k = 8 then '00:00:00' {_interval_forms(seconds, clock)} else {clock} end as duration",
        f"case when k = 50 then null when k >= 98 then cast({seconds} + 1 as string) "
        f"else cast({seconds} * k div 100 as string) end as speech_duration",
        "if(event_type = 'error', null, staff) as sales_person_id",
    )


def event_attendance(events: DataFrame) -> DataFrame:
    """First and last event of a user's day as clock times, in several forms; every tenth day is unreadable."""
    days = _numbered_events(events).groupBy("staff", "day").agg(F.min("ts").alias("first"), F.max("ts").alias("last"))

    def written(time: str) -> str:
        forms = {0: "M/d/yyyy H:mm:ss", 1: "d-MMM-yyyy HH:mm:ss", 2: "d MMM yyyy H:mm:ss"}
        cases = " ".join(f"when {i} then date_format({time}, '{form}')" for i, form in forms.items())
        return f"case dayofmonth(day) % 6 {cases} else date_format({time}, 'yyyy-MM-dd HH:mm:ss') end"

    return days.selectExpr(
        "concat('E', staff) as UserID",
        f"if(dayofmonth(day) % 10 = 3, 'n/a', {written('first')}) as InDateTime",
        f"{written('last')} as OutDateTime",
        "if(dayofmonth(day) % 5 = 4, date_format(day, 'MMM d, yyyy'), cast(day as string)) as Date",
        "date_add(day, 1) as day",
    )


def organisation(spark: SparkSession, sf_dir: str) -> dict:
    read = _loader(spark, sf_dir)
    store = f"c_custkey div {STAFF_PER_STORE}"
    device = f"concat('t', {_device('c_custkey')})"

    def spans(names: str, *periods: list[str]) -> DataFrame:
        """One validity row per customer and period."""
        rows = [
            "named_struct(" + ", ".join(f"'{n}', {value}" for n, value in zip(names.split(), values)) + ")"
            for values in periods
        ]
        return read("customer").selectExpr(f"inline(array({', '.join(rows)}))")

    handover = "date_add(date'2024-01-05', cast(c_custkey % 30 as int))"
    returned = "date_add(date'2024-01-20', cast(c_custkey % 15 as int))"
    return {
        "sales_persons": lambda: read("customer").selectExpr(
            "c_custkey as id",
            "c_name as name",
            "concat('staff', c_custkey, '@example.com') as email",
            "if(c_custkey % 13 = 5, null, concat('e', c_custkey)) as employee_id",
            f"{store} as store_id",
        ),
        "stores": lambda: read("supplier").selectExpr(
            "s_suppkey as id",
            "s_name as name",
            "cast(s_suppkey % 5 as int) as brand_id",
            "if(s_suppkey % 17 = 16, null, cast(s_nationkey as bigint)) as abm_id",
            "if(s_suppkey % 2 = 0, 3, 26) as regional_manager_id",
        ),
        "managers": lambda: read("nation").selectExpr(
            "cast(n_nationkey as bigint) as id", "1000L + n_nationkey as user_id"
        ),
        "users": lambda: read("nation").selectExpr("1000L + n_nationkey as id", "n_name as name"),
        "brands": lambda: read("region").selectExpr("r_regionkey as id", "r_name as name"),
        "salesperson_stores": lambda: spans(
            "sp_id store_id start_date end_date",
            ["c_custkey", store, "date_add(date'2023-11-01', cast(c_custkey % 20 as int))", handover],
            [
                "c_custkey",
                f"{store} + 5",
                f"date_add({handover}, 1)",
                "if(c_custkey % 4 = 3, date'2024-01-29', cast(null as date))",
            ],
        ),
        "devices": lambda: spans(
            "name store_id sales_person_id assigned_on unassigned_on comments",
            [
                device,
                store,
                "c_custkey",
                "date_add(date'2023-10-15', cast(c_custkey % 10 as int))",
                returned,
                f"case c_custkey % 9 when 4 then '{C.DELETED_DEVICE_COMMENT}' when 2 then 'ok' end",
            ],
            [
                device,
                f"{store} + if(c_custkey % 8 = 1, 5, 0)",
                "if(c_custkey % 6 = 0, null, c_custkey)",
                f"date_add({returned}, 1)",
                "cast(null as date)",
                "cast(null as string)",
            ],
        ),
        "device_registrations": lambda: read("customer").selectExpr(
            f"{device} as name", f"{store} as store_id", f"cast({store} % 5 as int) as brand_id"
        ),
    }


def sales_floor(spark: SparkSession, sf_dir: str) -> Tables:
    """Lost-sale roles over orders and lineitem."""
    read = _loader(spark, sf_dir)
    return Tables(
        {
            **organisation(spark, sf_dir),
            "interactions": lambda: order_calls(read("orders")),
            "interaction_flags": lambda: line_flags(read("lineitem")),
        }
    )


def audio_floor(spark: SparkSession, sf_dir: str) -> Tables:
    """Scheme funnel and adherence roles over events."""
    read = _loader(spark, sf_dir)
    return Tables(
        {
            **organisation(spark, sf_dir),
            "interactions": lambda: event_calls(read("events")),
            "scheme_flags": lambda: event_schemes(read("events")),
            "audio_files": lambda: event_audio(read("events")),
            "attendance": lambda: event_attendance(read("events")),
        }
    )
