"""DuckDB SQL giving the expected result of every registered query on the driver tables."""

from __future__ import annotations

from floortally import constants as C

AS_OF = "DATE '2024-01-30'"
WEEK_FROM = f"({AS_OF} - 6)"
MONTH_FROM = "DATE '2024-01-01'"


def _quoted(values: list[str]) -> str:
    return ", ".join(f"'{value}'" for value in values)


ISSUES, LOSSES = f"({_quoted(C.FOLLOW_UP_ISSUES)})", f"({_quoted(C.LOSS_CATEGORIES)})"
WORK_HOURS = "strftime(ts, '%H%M%S') BETWEEN '093000' AND '223000'"
BRANDS = "['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST']"


def pct0(n: str, d: str) -> str:
    return f"(CASE WHEN {d} > 0 THEN round_even({n}::DOUBLE / {d} * 100, 0)::BIGINT ELSE 0 END)"


def pct1(n: str, d: str) -> str:
    return f"(CASE WHEN {d} > 0 THEN round_even({n}::DOUBLE / ({d})::DOUBLE * 100 * 10, 0) / 10 END)"


def mean_tenths(x: str) -> str:
    return f"round_even(sum(round_even({x} * 10, 0)::BIGINT) / (count({x}) * 10.0::DOUBLE), 0)"


CTES = {
    # --- orders and lineitem as calls and flags ---------------------------------------
    "calls": """SELECT o_orderkey AS id,
        CASE WHEN o_orderkey % 31 = 7 THEN NULL WHEN o_orderkey % 37 = 9 THEN ' ' ELSE 'IC-' || o_orderkey END AS code, o_orderdate::DATE AS d, o_orderdate, o_custkey,
        CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE floor(o_totalprice)::BIGINT END AS ms,
        '/audio/' || lower(replace(substr(o_orderpriority, 3), ' ', '_')) || '/' || o_orderkey || '.wav' AS path,
        CASE o_orderstatus WHEN 'F' THEN 'unsuccessful' WHEN 'O' THEN 'successful' ELSE 'follow_up' END AS outcome
        FROM orders""",
    "long_calls": "SELECT * FROM calls WHERE ms > 180000",
    "phones": """SELECT call_id, (9000000000 + call_id * 2 + i)::VARCHAR AS phone_number,
        CASE WHEN (o_custkey + i) % 2 = 0 THEN 'follow-up' ELSE 'catalogue' END AS exchange_context
        FROM (SELECT o_orderkey AS call_id, o_custkey, unnest(range(o_orderkey % 3)) AS i FROM orders)
        WHERE (call_id + i) % 4 <> 0""",
    "call_reasons": f"""SELECT call_id,
        ([{_quoted(C.LOSS_CATEGORIES)}, 'Store', NULL])[(o_custkey + i) % 7 + 1] AS category
        FROM (SELECT o_orderkey AS call_id, o_custkey, unnest(range(o_orderkey % 4)) AS i FROM orders)""",
    "call_objections": f"""SELECT call_id,
        ([{_quoted(C.OBJECTION_CATEGORIES + C.NO_OBJECTION)}, NULL])[(call_id + i) % 10 + 1] AS category,
        ([{_quoted(C.HANDLINGS)}, 'Deferred'])[(o_custkey + i) % 4 + 1] AS handling
        FROM (SELECT o_orderkey AS call_id, o_custkey, unnest(range(o_custkey % 3)) AS i FROM orders)""",
    "flags": """SELECT row_number() OVER () AS fid, l_orderkey AS call_id, l_linenumber, l_partkey, l_suppkey,
        l_quantity::BIGINT AS q FROM lineitem WHERE l_returnflag <> 'A' AND l_linestatus = 'O'""",
    "flag_reasons": f"""SELECT fid,
        ([{_quoted(C.LOSS_CATEGORIES)}, 'Store', NULL])[(l_suppkey + i) % 7 + 1] AS category,
        ([{_quoted(C.FOLLOW_UP_ISSUES)}, 'Price concern', 'Delivery time', NULL])[(l_partkey + l_suppkey + i) % 6 + 1] AS sub_category,
        'reason ' || (l_partkey % 10) AS reason
        FROM (SELECT *, unnest(range(q % 4)) AS i FROM flags)""",
    "flag_products": """SELECT fid, i, (['Mattress', 'Sofa', 'Bed', '', NULL])[(l_partkey + i) % 5 + 1] AS product
        FROM (SELECT *, unnest(range(l_linenumber % 3)) AS i FROM flags)""",
    "lost": "SELECT f.*, c.code, c.d, c.o_custkey FROM flags f JOIN long_calls c ON f.call_id = c.id",
    "issue_flags": f"SELECT DISTINCT fid FROM flag_reasons WHERE sub_category IN {ISSUES}",
    "lost_reasons": "SELECT l.d, l.code, r.sub_category AS category FROM lost l LEFT JOIN flag_reasons r USING (fid)",
    "tenants": """SELECT * FROM (VALUES ('Urgent', '%urgent%'), ('High', '%high%'), ('Medium', '%medium%'),
        ('Not Specified', '%not_specified%'), ('Low', '%low%')) AS v(tenant, pattern)""",
    "tenant_calls": "SELECT tenant, c.* FROM calls c JOIN tenants ON c.path LIKE tenants.pattern",
    "tenant_long": "SELECT * FROM tenant_calls WHERE ms > 180000",
    # --- events as calls, recordings and attendance -----------------------------------
    "ev": """SELECT event_id AS id, ts, ts::DATE AS d, event_type, user_id * 10 AS staff, value,
        json_extract_string(props, '$.k')::BIGINT AS k FROM events""",
    "chain": """SELECT s_suppkey AS store_id, s_name AS store, s_suppkey % 5 AS brand_id,
        CASE WHEN s_suppkey % 2 = 0 THEN 3 ELSE 26 END AS region, n_name AS manager
        FROM supplier LEFT JOIN nation ON n_nationkey = CASE WHEN s_suppkey % 17 = 16 THEN NULL ELSE s_nationkey END""",
    "scheme": """SELECT id, (k + i) % 2 AS pitched, ((k + i) % 2) * (CASE WHEN (k + i) % 5 IN (1, 3) THEN 1 ELSE 0 END) AS sold,
        (k // 2 + i) % 2 AS pay, (k // 3 + i) % 2 AS excl, (k // 5 + i) % 2 AS rules, (k // 7 + i) % 2 AS stack,
        CASE WHEN k % 11 = 0 THEN NULL ELSE (k // 4 + i) % 2 END AS flex, k, i
        FROM (SELECT *, unnest(range((k + 2) % 3)) AS i FROM ev)""",
    "funnel": """SELECT e.id, e.d, CASE WHEN e.k % 10 = 9 THEN NULL ELSE e.staff END AS seller, c.*,
        s.* EXCLUDE (id, k, i) FROM ev e JOIN chain c ON c.store_id = e.staff // 15 LEFT JOIN scheme s ON s.id = e.id
        WHERE floor(e.value * 10000) > 180000""",
    "managers_window": f"""SELECT region, manager, count(DISTINCT store_id) AS stores, count(DISTINCT seller) AS sellers,
        count(*) AS n, coalesce(sum(pitched), 0)::BIGINT AS pitched, coalesce(sum(sold), 0)::BIGINT AS sold
        FROM funnel WHERE d BETWEEN {WEEK_FROM} AND {AS_OF} GROUP BY ALL""",
    "managers_month": f"""SELECT region, manager, count(DISTINCT store_id) AS stores, count(DISTINCT seller) AS sellers,
        count(*) AS n, coalesce(sum(pitched), 0)::BIGINT AS pitched, coalesce(sum(sold), 0)::BIGINT AS sold
        FROM funnel WHERE d BETWEEN {MONTH_FROM} AND {AS_OF} GROUP BY ALL""",
    "duty": """SELECT c_custkey AS sp_id, c_custkey // 15 AS store_id,
        DATE '2023-11-01' + (c_custkey % 20)::INT AS start_date, DATE '2024-01-05' + (c_custkey % 30)::INT AS end_date
        FROM customer UNION ALL
        SELECT c_custkey, c_custkey // 15 + 5, DATE '2024-01-06' + (c_custkey % 30)::INT,
        CASE WHEN c_custkey % 4 = 3 THEN DATE '2024-01-29' END FROM customer""",
    "roster": f"""SELECT region, manager, count(DISTINCT store_id) AS total_stores, count(DISTINCT sp_id) AS total_staff
        FROM (SELECT ch.region, ch.manager, ch.store_id, x.sp_id FROM duty x
              JOIN chain ch ON ch.store_id = x.sp_id // 15
              WHERE x.start_date <= {AS_OF} AND coalesce(x.end_date, DATE '2099-12-31') >= {AS_OF}) GROUP BY ALL""",
    "combined": f"""SELECT m.region, m.manager, r.total_stores, r.total_staff, {pct0('m.pitched', 'm.n')} AS mtd_pitched_pct,
        {pct0('m.sold', 'm.pitched')} AS mtd_sold_pct, w.stores, w.sellers, w.n, w.pitched, w.sold,
        CASE WHEN w.n IS NOT NULL THEN {pct0('w.pitched', 'w.n')} END AS pitched_pct,
        CASE WHEN w.n IS NOT NULL THEN {pct0('w.sold', 'w.pitched')} END AS sold_pct
        FROM managers_month m
        LEFT JOIN roster r ON r.region = m.region AND r.manager IS NOT DISTINCT FROM m.manager
        LEFT JOIN managers_window w ON w.region = m.region AND w.manager IS NOT DISTINCT FROM m.manager""",
    "devices": f"""SELECT code AS name, c_custkey // 15 AS store_id, c_custkey AS sp_id,
        DATE '2023-10-15' + (c_custkey % 10)::INT AS assigned_on, DATE '2024-01-20' + (c_custkey % 15)::INT AS unassigned_on,
        CASE c_custkey % 9 WHEN 4 THEN '{C.DELETED_DEVICE_COMMENT}' WHEN 2 THEN 'ok' END AS comments
        FROM (SELECT *, 't' || lpad(c_custkey::VARCHAR, greatest(4, length(c_custkey::VARCHAR))::INT, '0') AS code FROM customer)
        UNION ALL
        SELECT code, c_custkey // 15 + CASE WHEN c_custkey % 8 = 1 THEN 5 ELSE 0 END,
        CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_custkey END, DATE '2024-01-21' + (c_custkey % 15)::INT, NULL, NULL
        FROM (SELECT *, 't' || lpad(c_custkey::VARCHAR, greatest(4, length(c_custkey::VARCHAR))::INT, '0') AS code FROM customer)""",
    "staff": """SELECT c_custkey AS id, c_name AS name, c_custkey // 15 AS store_id,
        CASE WHEN c_custkey % 13 = 5 THEN NULL ELSE 'E' || c_custkey END AS employee_id FROM customer""",
    "on_device": f"""SELECT * FROM devices WHERE assigned_on <= {AS_OF}
        AND coalesce(unassigned_on, DATE '2099-12-31') >= {AS_OF}""",
    "all_devices": f"""SELECT ch.region, ch.manager, ch.store, st.name AS staff_name, b.name AS device, st.employee_id, st.id AS sp_id
        FROM (SELECT name, c_custkey // 15 AS store_id FROM (SELECT c_custkey,
                't' || lpad(c_custkey::VARCHAR, greatest(4, length(c_custkey::VARCHAR))::INT, '0') AS name FROM customer)
              UNION SELECT name, store_id FROM on_device) b
        LEFT JOIN on_device dv ON dv.name = b.name AND (dv.comments IS NULL OR dv.comments <> '{C.DELETED_DEVICE_COMMENT}')
        LEFT JOIN staff st ON st.id = dv.sp_id
        LEFT JOIN chain ch ON ch.store_id = b.store_id""",
    "device_rows": "SELECT * FROM all_devices WHERE region IS NOT NULL",
    "audio": f"""SELECT id, d, ts, k % 10 <> 0 OR k = 10 AS same_day, {WORK_HOURS} AS in_hours,
        't' || lpad(staff::VARCHAR, greatest(4, length(staff::VARCHAR))::INT, '0') AS device,
        CASE WHEN event_type = 'error' THEN NULL ELSE staff END AS sp_id,
        CASE WHEN event_type = 'error' THEN NULL ELSE ({BRANDS})[(staff // 15) % 5 + 1] END AS tenant,
        CASE k WHEN 7 THEN NULL WHEN 8 THEN 0 ELSE base END AS secs,
        CASE WHEN k = 50 THEN NULL WHEN k >= 98 THEN base + 1 ELSE base * k // 100 END AS speech
        FROM (SELECT *, floor(value / 5)::BIGINT * 100 AS base FROM ev)""",
    "judged": """SELECT *, speech::DOUBLE / nullif(secs, 0) AS share,
        CASE WHEN secs > 0 AND speech::DOUBLE / nullif(secs, 0) BETWEEN 0.1 AND 1 THEN 0 ELSE 1 END AS blank_a,
        CASE WHEN secs IS NULL OR secs = 0 THEN 1 WHEN speech::DOUBLE / secs > 1 OR speech::DOUBLE / secs <= 0.1 THEN 1
             ELSE 0 END AS blank_b,
        CASE WHEN secs > 0 AND (speech::DOUBLE / nullif(secs, 0) < 0.1 OR speech::DOUBLE / nullif(secs, 0) > 1) THEN 1
             ELSE 0 END AS blank_c FROM audio""",
    "week_stats": f"""SELECT device, count(*) AS total_files, sum(1 - blank_a)::BIGINT AS valid_files,
        sum(secs)::DOUBLE AS recorded_seconds, count(DISTINCT d) AS active_days, sum(blank_a)::BIGINT AS blank_files
        FROM judged WHERE same_day AND in_hours AND d BETWEEN {WEEK_FROM} AND {AS_OF} GROUP BY device""",
    "shifts": f"""SELECT 'E' || staff AS user_id, d,
        CASE WHEN day(d) % 10 = 3 OR worked < 0 THEN 34200 ELSE worked END AS seconds
        FROM (SELECT staff, d, (epoch(date_trunc('second', max(ts))) - epoch(date_trunc('second', min(ts))) - 5400)::BIGINT AS worked
              FROM ev GROUP BY staff, d)""",
    "attendance": f"""SELECT user_id, count(DISTINCT d) FILTER (d >= {WEEK_FROM}) AS wtd_days,
        sum(seconds) FILTER (d >= {WEEK_FROM})::DOUBLE AS wtd_shift_seconds,
        count(DISTINCT d) AS mtd_days, sum(seconds)::DOUBLE AS mtd_shift_seconds
        FROM shifts WHERE d BETWEEN {MONTH_FROM} AND {AS_OF} GROUP BY user_id""",
    "employee_month": f"""SELECT st.employee_id, sum(secs)::DOUBLE AS mtd_recorded_seconds, count(DISTINCT d) AS mtd_days_received,
        ((2000 * sum(blank_b)::BIGINT + count(*)) // (2 * count(*)))::DOUBLE / 10 AS mtd_blank_pct
        FROM judged LEFT JOIN staff st ON st.id = judged.sp_id WHERE d BETWEEN {MONTH_FROM} AND {AS_OF} GROUP BY st.employee_id""",
    "detail": f"""SELECT *, {pct1('blank_files', 'total_files')} AS blank_pct,
        CASE WHEN recorded_seconds > 0 THEN {pct1('recorded_seconds', 'wtd_shift_seconds')} END AS adherence_pct,
        CASE WHEN mtd_recorded_seconds > 0 THEN {pct1('mtd_recorded_seconds', 'mtd_shift_seconds')} END AS mtd_adherence_pct
        FROM (SELECT r.*, w.* EXCLUDE (device), m.* EXCLUDE (employee_id),
              CASE WHEN a.wtd_shift_seconds IS NULL AND w.recorded_seconds IS NOT NULL THEN 34200.0::DOUBLE * w.active_days
                   ELSE a.wtd_shift_seconds END AS wtd_shift_seconds,
              CASE WHEN a.mtd_shift_seconds IS NULL AND m.mtd_recorded_seconds IS NOT NULL
                   THEN 34200.0::DOUBLE * m.mtd_days_received ELSE a.mtd_shift_seconds END AS mtd_shift_seconds
              FROM device_rows r LEFT JOIN week_stats w USING (device)
              LEFT JOIN attendance a ON a.user_id = r.employee_id
              LEFT JOIN employee_month m ON m.employee_id IS NOT DISTINCT FROM r.employee_id)""",
    "summary": f"""SELECT region, manager, count(DISTINCT device) AS devices, count(*) FILTER (staff_name IS NULL) AS inactive,
        coalesce(sum(total_files) FILTER (staff_name IS NOT NULL), 0)::BIGINT AS files,
        count(*) FILTER (staff_name IS NOT NULL) AS staffed,
        {mean_tenths('CASE WHEN staff_name IS NOT NULL THEN adherence_pct END')} AS log,
        {mean_tenths('CASE WHEN staff_name IS NOT NULL THEN blank_pct END')} AS blank,
        {mean_tenths('CASE WHEN staff_name IS NOT NULL THEN mtd_adherence_pct END')} AS mtd_log,
        {mean_tenths('CASE WHEN staff_name IS NOT NULL THEN mtd_blank_pct END')} AS mtd_blank
        FROM detail WHERE manager IS NOT NULL GROUP BY region, manager""",
    "stores": f"""SELECT region, store, manager, {mean_tenths('adherence_pct')} AS log, {mean_tenths('blank_pct')} AS blank
        FROM detail WHERE manager IS NOT NULL AND store IS NOT NULL AND staff_name IS NOT NULL GROUP BY ALL""",
    "flagged": "SELECT *, blank > 8 OR log < 85 AS flagged FROM stores",
    "hours": f"""SELECT sp_id, sum(secs) FILTER (d >= DATE '2024-01-24')::DOUBLE AS wtd, sum(secs)::DOUBLE AS mtd
        FROM audio WHERE same_day AND in_hours AND d BETWEEN {MONTH_FROM} AND {AS_OF} GROUP BY sp_id""",
    "day_stats": f"""SELECT device, count(*) AS total_files, sum(1 - blank_a)::BIGINT AS valid_files,
        sum(secs)::DOUBLE AS recorded_seconds, sum(blank_a)::BIGINT AS blank_files
        FROM judged WHERE same_day AND in_hours AND d = {AS_OF} GROUP BY device""",
    "daily": f"""SELECT r.manager, r.store, r.staff_name, r.employee_id, r.device,
        CASE WHEN s.recorded_seconds IS NULL THEN 'No' ELSE 'Yes' END AS device_active, s.total_files, s.valid_files,
        s.blank_files, CASE WHEN s.recorded_seconds IS NOT NULL THEN {pct1('s.blank_files', 's.total_files')} END AS blank_pct,
        s.recorded_seconds, {pct1('s.recorded_seconds', '28800')} AS adherence_pct,
        h.wtd AS wtd_seconds, {pct1('h.wtd', '28800 * 7')} AS wtd_adherence_pct,
        h.mtd AS mtd_seconds, {pct1('h.mtd', '28800 * 30')} AS mtd_adherence_pct
        FROM all_devices r LEFT JOIN day_stats s USING (device)
        LEFT JOIN hours h ON h.sp_id IS NOT DISTINCT FROM r.sp_id""",
    "day_summary": f"""SELECT manager, count(DISTINCT device) AS devices, count(*) FILTER (staff_name IS NULL) AS inactive,
        count(*) FILTER (device_active = 'No') AS not_received,
        count(*) FILTER (total_files IS NOT NULL AND device_active = 'Yes') AS received,
        coalesce(sum(total_files), 0)::BIGINT AS files, count(total_files) AS with_files,
        {mean_tenths('CASE WHEN total_files IS NOT NULL THEN adherence_pct END')} AS log,
        {mean_tenths('CASE WHEN total_files IS NOT NULL THEN blank_pct END')} AS blank,
        {mean_tenths('wtd_adherence_pct')} AS wtd, {mean_tenths('mtd_adherence_pct')} AS mtd
        FROM daily WHERE manager IS NOT NULL GROUP BY manager""",
    "day_rated": """SELECT *, CASE WHEN with_files > 0 THEN round_even(received::DOUBLE / devices * 100, 0) END AS active_pct
        FROM day_summary""",
    "shift": """SELECT * FROM (VALUES ('AFRICA', 28800), ('AMERICA', 25200), ('ASIA', 30600), ('EUROPE', 30600),
        ('MIDDLE EAST', 36000)) AS v(tenant, shift)""",
    "spans": f"""SELECT r_name AS tenant, x.sp_id, s.s_name AS store, st.name, dv.name AS device, x.start_date, x.end_date
        FROM duty x JOIN supplier s ON s.s_suppkey = x.store_id JOIN region ON r_regionkey = s.s_suppkey % 5
        LEFT JOIN staff st ON st.id = x.sp_id
        LEFT JOIN devices dv ON dv.sp_id = x.sp_id AND dv.store_id = x.store_id AND dv.assigned_on <= {AS_OF}
             AND coalesce(dv.unassigned_on, DATE '2099-12-31') >= {AS_OF}
        WHERE x.start_date <= {AS_OF} AND coalesce(x.end_date, DATE '2099-12-31') >= {MONTH_FROM}""",
    "spoken": f"""SELECT p.tenant, p.store, p.name, p.device, a.id, a.d, a.secs, a.blank_c,
        CASE WHEN a.d <= DATE '2024-01-06' THEN 1 ELSE 2 + (a.d - DATE '2024-01-07') // 7 END AS week
        FROM spans p LEFT JOIN judged a ON a.tenant = p.tenant AND a.sp_id = p.sp_id AND a.same_day AND a.in_hours
        AND a.d BETWEEN greatest(p.start_date, {MONTH_FROM})
                    AND least(coalesce(p.end_date, DATE '2099-12-31'), {AS_OF})""",
    "matrix": """SELECT tenant, store, name, device, count(id) AS files, coalesce(sum(blank_c), 0)::BIGINT AS blank,
        coalesce(sum(secs), 0)::DOUBLE AS mtd, """
    + ", ".join(f"coalesce(sum(secs) FILTER (week = {w}), 0)::DOUBLE AS w{w}" for w in range(1, 7))
    + ", "
    + ", ".join(f"coalesce(sum(secs) FILTER (d = {AS_OF} - {n - 1}), 0)::DOUBLE AS d{n}" for n in range(1, 5))
    + """ FROM spoken WHERE tenant IS NOT NULL AND store IS NOT NULL AND name IS NOT NULL AND device IS NOT NULL
        GROUP BY ALL""",
    "rated": f"""SELECT tenant, store, name, device, files, blank, mtd,
        CASE WHEN files > 0 THEN round_even(blank::DOUBLE / files * 100 * 10, 0) / 10 ELSE 0.0 END AS blank_pct,
        {pct1('mtd', '30 * shift')} AS mtd_pct, """
    + ", ".join(
        f"{pct1(f'w{w}', f'{n} * shift')} AS w{w}" if n else f"0.0::DOUBLE AS w{w}"
        for w, n in ((1, 6), (2, 7), (3, 7), (4, 7), (5, 3), (6, 0))
    )
    + ", "
    + ", ".join(f"{pct1(f'd{n}', 'shift')} AS d{n}" for n in range(1, 5))
    + " FROM matrix JOIN shift USING (tenant)",
}
USES = {
    "long_calls": ["calls"],
    "flag_reasons": ["flags"],
    "flag_products": ["flags"],
    "lost": ["flags", "long_calls"],
    "issue_flags": ["flag_reasons"],
    "lost_reasons": ["lost", "flag_reasons"],
    "tenant_calls": ["calls", "tenants"],
    "tenant_long": ["tenant_calls"],
    "scheme": ["ev"],
    "funnel": ["ev", "chain", "scheme"],
    "managers_window": ["funnel"],
    "managers_month": ["funnel"],
    "roster": ["duty", "chain"],
    "combined": ["managers_month", "managers_window", "roster"],
    "on_device": ["devices"],
    "all_devices": ["on_device", "staff", "chain"],
    "device_rows": ["all_devices"],
    "audio": ["ev"],
    "judged": ["audio"],
    "week_stats": ["judged"],
    "shifts": ["ev"],
    "attendance": ["shifts"],
    "employee_month": ["judged", "staff"],
    "detail": ["device_rows", "week_stats", "attendance", "employee_month"],
    "summary": ["detail"],
    "stores": ["detail"],
    "flagged": ["stores"],
    "hours": ["audio"],
    "day_stats": ["judged"],
    "daily": ["all_devices", "day_stats", "hours"],
    "day_summary": ["daily"],
    "day_rated": ["day_summary"],
    "spans": ["duty", "staff", "devices"],
    "spoken": ["spans", "judged"],
    "matrix": ["spoken"],
    "rated": ["matrix", "shift"],
}


def _query(uses: list[str], body: str, **local: str) -> str:
    """The body behind the CTEs it needs, each after those it builds on."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for parent in USES.get(name, []):
            need(parent)
        if name not in ordered:
            ordered.append(name)

    for name in uses:
        need(name)
    parts = [f"{name} AS {'MATERIALIZED ' if name == 'flags' else ''}({CTES[name]})" for name in ordered]
    parts += [f"{name} AS ({text})" for name, text in local.items()]
    return f"WITH {', '.join(parts)} {body}"


MONDAY = "({0} - (isodow({0}) - 1)::INT)"
MONTH_DAY = "date_trunc('month', {0})::DATE"


def _per_as_of(first: str, source: str, last: str) -> str:
    """Rows of `source` repeated for each as-of day up to `last` whose period holds them."""
    return (
        f"SELECT s.*, a AS as_of FROM (SELECT *, unnest(generate_series(d, {last}, INTERVAL 1 DAY))::DATE AS a FROM {source}) s "
        f"WHERE d >= {first}"
    )


def _top(k: int, measure: str = "count(code)") -> str:
    return f"""SELECT as_of, category, n AS interactions, rank::INTEGER AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY as_of ORDER BY n DESC, category NULLS LAST) AS rank FROM (
            SELECT as_of, category, {measure} AS n FROM seen GROUP BY as_of, category)) WHERE rank <= {k}"""


_WIDE_LAST = "greatest(" + MONDAY.format("d") + " + 6, last_day(d))"
_WIDE_FIRST = "least(" + MONDAY.format("a") + ", " + MONTH_DAY.format("a") + ")"
_IN_WEEK = "d >= " + MONDAY.format("as_of")
_IN_MONTH = "d >= " + MONTH_DAY.format("as_of")
_DAY_FLAGS = f"""SELECT l.*, p.phone_number, p.exchange_context FROM lost l JOIN issue_flags USING (fid)
    JOIN phones p ON p.call_id = l.call_id"""
_SUMMARY_COLUMNS = """region::INTEGER AS regional_manager_id, manager"""


def _title(column: str) -> str:
    words = "string_split({0}, '_')".format(column)
    return f"array_to_string([upper(w[1]) || w[2:] FOR w IN {words}], ' ')"


def _category_matrix(source: str, label: str, name: str) -> str:
    week = "1 + (day(d) - 1 + dayofweek(date_trunc('month', d)::DATE)) // 7"
    weeks = ", ".join(f"count(*) FILTER ({week} = {w}) AS week_{w}" for w in range(1, 7))
    days = ", ".join(f"count(*) FILTER (d = last_day(d) - {n - 1}) AS d_{n}" for n in range(1, 5))
    return _query(
        ["tenant_calls", "call_reasons", "call_objections"],
        f"""SELECT * EXCLUDE (category), row_number() OVER (PARTITION BY tenant, as_of ORDER BY contribution_pct DESC, category)::INTEGER AS position
            FROM (SELECT tenant, as_of, category, {label} AS {name}, mtd,
            round_even(mtd::DOUBLE / sum(mtd) OVER (PARTITION BY tenant, as_of) * 100 * 10, 0) / 10 AS contribution_pct,
            {', '.join(f'week_{w}' for w in range(1, 7))}, {', '.join(f'd_{n}' for n in range(1, 5))}
            FROM (SELECT tenant, last_day(d) AS as_of, category, count(*) AS mtd, {weeks}, {days}
                  FROM {source} WHERE category IS NOT NULL GROUP BY ALL))""",
    )


_ISSUE_LIST = _quoted(C.FOLLOW_UP_ISSUES)
_CODE = "trim(code) AS interaction_code"
_CODED = "code IS NOT NULL AND trim(code) <> ''"
_CODE_LIST = f"string_agg(trim(code), ', ' ORDER BY trim(code)) FILTER ({_CODED})"


def _issue_cell(issue: str, prefix: str) -> str:
    return (
        f"count(*) FILTER (sub_category = '{issue}') AS {prefix}_count, "
        f"coalesce(string_agg(DISTINCT trim(code), ', ' ORDER BY trim(code)) FILTER (sub_category = '{issue}' AND {_CODED}), '') AS {prefix}_codes"
    )


def _handling_cell(handling: str) -> str:
    low = handling.lower()
    return (
        f"count(*) FILTER (o.handling = '{handling}') AS {low}_count, "
        f"coalesce(string_agg(trim(o.code), ', ' ORDER BY trim(o.code)) FILTER (o.handling = '{handling}' AND {_CODED}), '') AS {low}_codes"
    )


def _funnel_report(source: str, order: str = "") -> str:
    return _query(
        [source],
        f"""SELECT *, row_number() OVER (PARTITION BY regional_manager_id ORDER BY {order} manager NULLS LAST)::INTEGER AS position FROM (
            SELECT {_SUMMARY_COLUMNS}, stores AS store_count, sellers AS executive_count, n AS interactions, pitched, sold,
            {pct0('pitched', 'n')} AS pitched_pct, {pct0('sold', 'pitched')} AS sold_pct FROM {source})""",
    )


def _effectiveness(condition: str, count: str) -> str:
    names = {
        "pay": "gms_monthly_payment",
        "excl": "gms_redemption_exclusion",
        "rules": "gms_rules_penalties",
        "flex": "gms_redemption_flexibility",
        "stack": "gms_benefit_stacking",
    }
    picked = f"{condition} AND manager IS NOT NULL"
    means = ", ".join(
        f"coalesce(round_even(avg({c}) FILTER ({picked}) * 100 * 100, 0)::BIGINT, 0) AS {n}" for c, n in names.items()
    )
    return _query(
        ["funnel"],
        f"""SELECT {_SUMMARY_COLUMNS}, {count}, {', '.join(f'{n} / 100.0::DOUBLE AS {n}' for n in names.values())}, FALSE AS is_total
            FROM t UNION ALL
            SELECT region::INTEGER, 'Grand Total', sum({count})::BIGINT,
            {', '.join(f'round_even(sum({n}) / (count(*) * 100.0::DOUBLE) * 10, 0) / 10' for n in names.values())}, TRUE
            FROM t GROUP BY region""",
        t=f"""SELECT region, manager, count(*) FILTER ({picked}) AS {count}, {means}
            FROM funnel WHERE d BETWEEN {WEEK_FROM} AND {AS_OF} GROUP BY region, manager""",
    )


def _hms(column: str) -> str:
    return (
        f"(({column})::BIGINT // 3600)::VARCHAR || ':' || lpad((({column})::BIGINT % 3600 // 60)::VARCHAR, 2, '0') || ':' || "
        f"lpad((({column})::BIGINT % 60)::VARCHAR, 2, '0')"
    )


def _band(column: str) -> str:
    return (
        f"CASE WHEN {column} >= 85 THEN 'on_track' WHEN {column} >= 75 THEN 'watch' WHEN {column} >= 60 THEN 'behind' "
        f"WHEN {column} IS NOT NULL THEN 'critical' END"
    )


_STAFF = "tenant, store, name, device"
_WEEKS = ", ".join(f"w{n} AS week_{n}" for n in range(1, 7))
_DAYS = ", ".join(f"d{n} AS d_{n}" for n in range(1, 5))
_RATED = {"mtd_adherence_pct": "mtd_pct", **{f"week_{n}": f"w{n}" for n in range(1, 7)}, **{f"d_{n}": f"d{n}" for n in range(1, 5)}}
_MANAGER_MEANS = """devices AS total_devices, inactive AS inactive_devices, devices - inactive AS active_devices, files AS total_files,
    (CASE WHEN staffed = 0 THEN coalesce(log, 0) ELSE log END)::BIGINT AS time_log_pct,
    (CASE WHEN staffed = 0 THEN coalesce(blank, 0) ELSE blank END)::BIGINT AS blank_pct,
    (CASE WHEN staffed = 0 THEN coalesce(mtd_log, 0) ELSE mtd_log END)::BIGINT AS mtd_time_log_pct,
    (CASE WHEN staffed = 0 THEN coalesce(mtd_blank, 0) ELSE mtd_blank END)::BIGINT AS mtd_blank_pct"""

ORACLES = {
    "topk_reason_mtd": _query(
        ["lost_reasons"], _top(3), seen=_per_as_of(MONTH_DAY.format("a"), "lost_reasons", "last_day(d)")
    ),
    "topk_reason_wtd": _query(
        ["lost_reasons"], _top(3), seen=_per_as_of(MONDAY.format("a"), "lost_reasons", MONDAY.format("d") + " + 6")
    ),
    "reason_trend": _query(
        ["lost_reasons"],
        f"""SELECT as_of, category, CASE WHEN count(*) FILTER ({_IN_WEEK}) > 0 THEN count(code) FILTER ({_IN_WEEK}) END AS wtd,
            CASE WHEN count(*) FILTER ({_IN_MONTH}) > 0 THEN count(code) FILTER ({_IN_MONTH}) END AS mtd FROM seen GROUP BY as_of, category""",
        seen=_per_as_of(_WIDE_FIRST, "lost_reasons", _WIDE_LAST),
    ),
    "top5_share": _query(
        ["lost_reasons"],
        f"""SELECT *, round_even(interactions::DOUBLE / nullif(sum(interactions) OVER (PARTITION BY as_of), 0) * 100, 0)::BIGINT AS share_pct
            FROM ({_top(5, 'count(DISTINCT code)')})""",
        seen="SELECT d AS as_of, code, category FROM lost_reasons",
    ),
    "lost_sale_followups": _query(
        ["lost", "phones", "issue_flags", "flag_products", "calls"],
        """SELECT f.d AS as_of, 'audio/' || f.call_id || '.wav' AS audio_url, f.code AS interaction_code,
            c.o_orderdate + to_seconds(f.call_id % 43200) AS start_time,
            c.o_orderdate + to_seconds(f.call_id % 43200 + 600) AS end_time, f.d AS date,
            c_name AS se_name, s_name AS store_name, pj.js AS primary_category_new, f.phone_number, f.exchange_context,
            r.category, r.sub_category, r.reason,
            CASE WHEN f.l_linenumber % 2 = 0 THEN '[{"category":"price_issue"}]' END AS customer_objection_handling
            FROM day_flags f JOIN calls c ON c.id = f.call_id JOIN flag_reasons r ON r.fid = f.fid
            LEFT JOIN customer ON c_custkey = f.o_custkey LEFT JOIN supplier ON s_suppkey = f.o_custkey // 15
            LEFT JOIN products pj ON pj.fid = f.fid""",
        day_flags=_DAY_FLAGS,
        products="""SELECT fid, '[' || string_agg(CASE WHEN product IS NULL THEN '{}' ELSE '{"category":"' || product || '"}' END,
            ',' ORDER BY i) || ']' AS js FROM flag_products GROUP BY fid""",
    ),
    "unsuccessful_total": _query(["lost"], "SELECT d AS as_of, count(*) AS interaction_count FROM lost GROUP BY d"),
    "phone_follow_ups": _query(
        ["lost", "phones", "issue_flags"],
        """SELECT t.as_of, total AS interaction_count, coalesce(n, 0) AS phone_rows
            FROM (SELECT d AS as_of, count(*) AS total FROM lost GROUP BY d) t
            LEFT JOIN (SELECT f.d, count(*) AS n FROM day_flags f JOIN flag_reasons r ON r.fid = f.fid GROUP BY f.d) x ON x.d = t.as_of""",
        day_flags=_DAY_FLAGS,
    ),
    "reason_summary": _query(
        ["lost", "phones", "issue_flags"],
        f"""SELECT t.as_of, i.issue AS sub_category, coalesce(n, 0) AS interactions,
            round_even(coalesce(n, 0)::DOUBLE / total * 100 * 10, 0) / 10 AS pct
            FROM (SELECT d AS as_of, count(*) AS total FROM lost GROUP BY d) t
            CROSS JOIN (SELECT unnest([{_ISSUE_LIST}]) AS issue) i
            LEFT JOIN (SELECT f.d, r.sub_category, count(*) AS n FROM day_flags f JOIN flag_reasons r ON r.fid = f.fid GROUP BY ALL) x
              ON x.d = t.as_of AND x.sub_category = i.issue""",
        day_flags=_DAY_FLAGS,
    ),
    "reason_summary_codes": _query(
        ["lost", "phones", "issue_flags"],
        f"""SELECT t.as_of, i.issue AS sub_category, 0::BIGINT AS part, coalesce(n, 0) AS interactions,
            round_even(coalesce(n, 0)::DOUBLE / total * 100 * 10, 0) / 10 AS pct, coalesce(codes, '') AS interaction_codes
            FROM (SELECT d AS as_of, count(*) AS total FROM lost GROUP BY d) t
            CROSS JOIN (SELECT unnest([{_ISSUE_LIST}]) AS issue) i
            LEFT JOIN (SELECT f.d, r.sub_category, count(*) AS n, {_CODE_LIST} AS codes
                       FROM day_flags f JOIN flag_reasons r ON r.fid = f.fid GROUP BY ALL) x
              ON x.d = t.as_of AND x.sub_category = i.issue""",
        day_flags=_DAY_FLAGS,
    ),
    "reason_issue_codes": _query(
        ["lost", "phones", "issue_flags"],
        f"""SELECT f.d AS as_of, r.sub_category, {_CODE}, count(*) AS n FROM day_flags f JOIN flag_reasons r ON r.fid = f.fid
            WHERE r.sub_category IN {ISSUES} AND {_CODED} GROUP BY f.d, r.sub_category, code""",
        day_flags=_DAY_FLAGS,
    ),
    "category_issue_crosstab": _query(
        ["lost", "phones", "issue_flags", "flag_products"],
        f"""SELECT f.d AS as_of, p.product AS prod_category, 0::BIGINT AS part,
            {', '.join(map(_issue_cell, C.FOLLOW_UP_ISSUES, ('uncertainty', 'deferred', 'glitch')))}
            FROM day_flags f JOIN flag_reasons r ON r.fid = f.fid JOIN flag_products p ON p.fid = f.fid
            WHERE p.product IS NOT NULL AND trim(p.product) <> '' GROUP BY f.d, p.product""",
        day_flags=_DAY_FLAGS,
    ),
    "category_issue_codes": _query(
        ["lost", "phones", "issue_flags", "flag_products"],
        f"""SELECT f.d AS as_of, p.product AS prod_category, r.sub_category, {_CODE}, count(*) AS n
            FROM day_flags f JOIN flag_reasons r ON r.fid = f.fid JOIN flag_products p ON p.fid = f.fid
            WHERE p.product IS NOT NULL AND trim(p.product) <> '' AND r.sub_category IN {ISSUES} AND {_CODED}
            GROUP BY f.d, p.product, r.sub_category, code""",
        day_flags=_DAY_FLAGS,
    ),
    "category_wtd_mtd": _query(
        ["lost", "flag_products"],
        f"""SELECT as_of, product AS prod_category, nullif(count(DISTINCT code) FILTER ({_IN_WEEK}), 0) AS wtd,
            count(DISTINCT code) FILTER ({_IN_MONTH}) AS mtd,
            row_number() OVER (PARTITION BY as_of ORDER BY mtd DESC, product)::INTEGER AS position
            FROM seen GROUP BY as_of, product HAVING mtd > 0""",
        labelled="""SELECT l.d, l.code, p.product FROM lost l JOIN flag_products p USING (fid)
            WHERE p.product IS NOT NULL AND trim(p.product) <> ''""",
        seen=_per_as_of(_WIDE_FIRST, "labelled", _WIDE_LAST),
    ),
    "outcome_totals_by_tenant": _query(
        ["tenant_long"],
        """SELECT tenant, d AS as_of, outcome AS sales_outcome, count(code) AS interactions,
            sum(count(code)) OVER (PARTITION BY tenant, d)::BIGINT AS total_interactions,
            coalesce(sum(CASE WHEN outcome = 'unsuccessful' THEN count(code) END) OVER (PARTITION BY tenant, d), 0)::BIGINT
                AS total_unsuccessful
            FROM tenant_long GROUP BY tenant, d, outcome""",
    ),
    "reason_domain_day": _query(
        ["tenant_long", "call_reasons"],
        f"""SELECT t.tenant, t.d AS as_of, i.category, 0::BIGINT AS part, coalesce(n, 0) AS interactions,
            CASE WHEN lost > 0 THEN round_even(coalesce(n, 0)::DOUBLE / lost * 100 * 10, 0) / 10 ELSE 0.0 END AS pct,
            coalesce(codes, '') AS interaction_codes
            FROM (SELECT tenant, d, count(code) FILTER (outcome = 'unsuccessful') AS lost FROM tenant_long GROUP BY ALL) t
            CROSS JOIN (SELECT unnest([{_quoted(C.LOSS_CATEGORIES)}]) AS category) i
            LEFT JOIN (SELECT c.tenant, c.d, r.category, count(*) AS n, {_CODE_LIST} AS codes
                       FROM tenant_long c JOIN call_reasons r ON r.call_id = c.id WHERE c.outcome = 'unsuccessful' GROUP BY ALL) x
              ON x.tenant = t.tenant AND x.d = t.d AND x.category = i.category""",
    ),
    "reason_domain_codes": _query(
        ["tenant_long", "call_reasons"],
        f"""SELECT c.tenant, c.d AS as_of, r.category, {_CODE}, count(*) AS n
            FROM tenant_long c JOIN call_reasons r ON r.call_id = c.id
            WHERE c.outcome = 'unsuccessful' AND r.category IN {LOSSES} AND {_CODED} GROUP BY ALL""",
    ),
    "reason_domain_wtd_mtd": _query(
        ["tenant_long", "call_reasons"],
        f"""SELECT k.tenant, k.as_of, i.category,
            count(s.code) FILTER (s.category = i.category AND {_IN_WEEK.replace('as_of', 'k.as_of')}) AS wtd,
            count(s.code) FILTER (s.category = i.category AND {_IN_MONTH.replace('as_of', 'k.as_of')}) AS mtd
            FROM (SELECT DISTINCT tenant, as_of FROM seen) k
            CROSS JOIN (SELECT unnest([{_quoted(C.LOSS_CATEGORIES)}]) AS category) i
            JOIN seen s ON s.tenant = k.tenant AND s.as_of = k.as_of GROUP BY ALL""",
        labelled="""SELECT c.tenant, c.d, c.code, r.category FROM tenant_long c LEFT JOIN call_reasons r ON r.call_id = c.id
            WHERE c.outcome = 'unsuccessful'""",
        seen=_per_as_of(_WIDE_FIRST, "labelled", _WIDE_LAST),
    ),
    "objection_handling_matrix": _query(
        ["tenant_long", "call_objections"],
        f"""SELECT t.tenant, t.d AS as_of, replace({_title('i.category')}, ' And ', ' and ') AS objection,
            0::BIGINT AS part, {', '.join(_handling_cell(h) for h in C.HANDLINGS)},
            coalesce(any_value(n.total), 0) AS total_objections
            FROM (SELECT DISTINCT tenant, d FROM tenant_long) t
            CROSS JOIN (SELECT unnest([{_quoted(C.OBJECTION_CATEGORIES)}]) AS category) i
            LEFT JOIN objections o ON o.tenant = t.tenant AND o.d = t.d AND o.category = i.category
            LEFT JOIN (SELECT tenant, d, count(*) AS total FROM objections GROUP BY ALL) n ON n.tenant = t.tenant AND n.d = t.d
            GROUP BY t.tenant, t.d, i.category""",
        objections="""SELECT c.tenant, c.d, c.code, o.category, o.handling FROM tenant_long c JOIN call_objections o ON o.call_id = c.id
            WHERE o.category IS NOT NULL AND o.category <> 'not_applicable'""",
    ),
    "objection_handling_codes": _query(
        ["tenant_long", "call_objections"],
        f"""SELECT c.tenant, c.d AS as_of, replace({_title('o.category')}, ' And ', ' and ') AS objection, o.handling, {_CODE}, count(*) AS n
            FROM tenant_long c JOIN call_objections o ON o.call_id = c.id
            WHERE o.category IS NOT NULL AND o.category <> 'not_applicable' AND o.handling IN ({_quoted(C.HANDLINGS)})
            AND {_CODED} GROUP BY ALL""",
    ),
    "funnel_window": _funnel_report("managers_window"),
    "funnel_mtd": _funnel_report("managers_month", "sold_pct DESC,"),
    "funnel_staff": _query(
        ["funnel"],
        f"""SELECT *, row_number() OVER (PARTITION BY regional_manager_id ORDER BY manager NULLS LAST, store NULLS LAST,
            staff_name NULLS LAST, email NULLS LAST)::INTEGER AS position FROM (
            SELECT region::INTEGER AS regional_manager_id, manager, store, c_name AS staff_name,
            CASE WHEN c_custkey IS NOT NULL THEN 'staff' || c_custkey || '@example.com' END AS email, count(*) AS interactions,
            coalesce(sum(pitched), 0)::BIGINT AS pitched, coalesce(sum(sold), 0)::BIGINT AS sold
            FROM funnel LEFT JOIN customer ON c_custkey = seller WHERE d BETWEEN {WEEK_FROM} AND {AS_OF} GROUP BY ALL)""",
    ),
    "funnel_combined_total": _query(
        ["combined"],
        f"""SELECT *, row_number() OVER (PARTITION BY regional_manager_id ORDER BY is_total, mtd_sold_pct DESC NULLS LAST,
            manager NULLS LAST)::INTEGER AS position FROM (
            SELECT {_SUMMARY_COLUMNS}, FALSE AS is_total, total_stores AS total_store_count, total_staff AS total_executive_count,
            mtd_pitched_pct, mtd_sold_pct, stores AS store_count, sellers AS executive_count, n AS interactions, pitched,
            pitched_pct, sold, sold_pct FROM combined
            UNION ALL
            SELECT g.region::INTEGER, 'Grand Total', TRUE, r.a, r.b, {pct0('m.p', 'm.n')}, {pct0('m.s', 'm.p')}, w.a, w.b, w.n, w.p,
            {pct0('w.p', 'w.n')}, w.s, {pct0('w.s', 'w.p')}
            FROM (SELECT DISTINCT region FROM managers_month) g
            LEFT JOIN (SELECT region, sum(total_stores)::BIGINT AS a, sum(total_staff)::BIGINT AS b FROM roster GROUP BY 1) r USING (region)
            LEFT JOIN (SELECT region, sum(n)::BIGINT AS n, sum(pitched)::BIGINT AS p, sum(sold)::BIGINT AS s
                       FROM managers_month GROUP BY 1) m USING (region)
            LEFT JOIN (SELECT region, sum(stores)::BIGINT AS a, sum(sellers)::BIGINT AS b, sum(n)::BIGINT AS n,
                       sum(pitched)::BIGINT AS p, sum(sold)::BIGINT AS s FROM managers_window GROUP BY 1) w USING (region))""",
    ),
    "roster_asof": _query(
        ["roster"],
        f"SELECT {_SUMMARY_COLUMNS}, total_stores AS total_store_count, total_staff AS total_executive_count FROM roster",
    ),
    "effectiveness_flags": _query(
        ["funnel", "scheme"],
        f"""SELECT f.region::INTEGER AS regional_manager_id, f.manager, f.store, c_name AS sales_person,
            'EV-' || f.id AS interaction_code, f.pitched::VARCHAR AS gms_pitched, f.sold::VARCHAR AS gms_sold,
            f.pay::VARCHAR AS gms_monthly_payment, f.excl::VARCHAR AS gms_redemption_exclusion,
            f.rules::VARCHAR AS gms_rules_penalties,
            CASE WHEN f.pitched IS NULL THEN NULL ELSE coalesce(f.flex::VARCHAR, 'na') END AS gms_redemption_flexibility,
            f.stack::VARCHAR AS gms_benefit_stacking
            FROM funnel f LEFT JOIN customer ON c_custkey = f.seller WHERE f.d BETWEEN {WEEK_FROM} AND {AS_OF}""",
    ),
    "effectiveness_pitched": _effectiveness("pitched = 1", "pitched"),
    "effectiveness_sold": _effectiveness("pitched = 1 AND sold = 1", "sold"),
    "heat_minmax": _query(
        ["combined"],
        f"""SELECT {_SUMMARY_COLUMNS}, mtd_pitched_pct, mtd_sold_pct,
            CASE WHEN min(mtd_pitched_pct) OVER w = max(mtd_pitched_pct) OVER w THEN 1.0 ELSE (mtd_pitched_pct - min(mtd_pitched_pct)
              OVER w)::DOUBLE / (max(mtd_pitched_pct) OVER w - min(mtd_pitched_pct) OVER w) END AS mtd_pitched_pct_heat,
            CASE WHEN min(mtd_sold_pct) OVER w = max(mtd_sold_pct) OVER w THEN 1.0 ELSE (mtd_sold_pct - min(mtd_sold_pct)
              OVER w)::DOUBLE / (max(mtd_sold_pct) OVER w - min(mtd_sold_pct) OVER w) END AS mtd_sold_pct_heat
            FROM combined WINDOW w AS (PARTITION BY region)""",
    ),
    "device_roster": _query(
        ["device_rows"],
        f"SELECT {_SUMMARY_COLUMNS}, store, staff_name, device, employee_id, sp_id FROM device_rows",
    ),
    "device_file_stats": _query(["week_stats"], "SELECT * FROM week_stats"),
    "attendance_rollup": _query(
        ["attendance"],
        f"SELECT *, {_hms('wtd_shift_seconds')} AS wtd_shift, {_hms('mtd_shift_seconds')} AS mtd_shift FROM attendance",
    ),
    "attendance_rejects": _query(
        ["ev"],
        f"""SELECT d + 1 AS day, 'InDateTime' AS field, count(*) AS rejected FROM (SELECT DISTINCT staff, d FROM ev)
            WHERE day(d) % 10 = 3 AND d BETWEEN {MONTH_FROM} AND {AS_OF} GROUP BY d""",
    ),
    "staff_mtd": _query(["employee_month"], "SELECT * FROM employee_month"),
    "blank_rules": _query(
        ["judged"],
        f"""SELECT sp_id AS sales_person_id, count(*) AS files, sum(blank_a)::BIGINT AS blank_a, sum(blank_b)::BIGINT AS blank_b,
            sum(blank_c)::BIGINT AS blank_c FROM judged WHERE d BETWEEN {MONTH_FROM} AND {AS_OF} GROUP BY sp_id""",
    ),
    "adherence_detail": _query(
        ["detail"],
        f"""SELECT {_SUMMARY_COLUMNS}, store, staff_name, device, employee_id, total_files, valid_files, blank_files,
            recorded_seconds, active_days, wtd_shift_seconds, blank_pct, adherence_pct, mtd_recorded_seconds,
            mtd_days_received, mtd_blank_pct, mtd_shift_seconds, mtd_adherence_pct,
            CASE WHEN blank_pct > 8 AND adherence_pct < 85 THEN 'High Blank Files, Low Device Adherence'
                 WHEN blank_pct > 8 THEN 'High Blank Files' WHEN adherence_pct < 85 THEN 'Low Device Adherence' ELSE '' END AS comments,
            row_number() OVER (PARTITION BY manager ORDER BY store NULLS LAST, staff_name NULLS LAST, device NULLS LAST)::INTEGER AS position
            FROM detail""",
    ),
    "adherence_summary": _query(["summary"], f"SELECT {_SUMMARY_COLUMNS}, {_MANAGER_MEANS} FROM summary"),
    "store_flags": _query(
        ["flagged"],
        """SELECT a.region::INTEGER AS regional_manager_id, a.store, a.manager, a.log::BIGINT AS time_log_pct,
            b.manager AS blank_manager, b.blank::BIGINT AS blank_pct,
            coalesce(b.blank > 8, FALSE) OR coalesce(a.log < 85, FALSE) AS flagged
            FROM stores a LEFT JOIN stores b ON a.region = b.region AND a.store = b.store""",
    ),
    "flagged_managers_total": _query(
        ["summary", "flagged"],
        f"""SELECT {_SUMMARY_COLUMNS}, FALSE AS is_total, {_MANAGER_MEANS} FROM chosen UNION ALL
            SELECT region::INTEGER, 'Grand Total', TRUE, sum(devices)::BIGINT, sum(inactive)::BIGINT, sum(devices - inactive)::BIGINT,
            sum(files)::BIGINT, round_even(avg(log), 0)::BIGINT, round_even(avg(blank), 0)::BIGINT,
            round_even(avg(mtd_log), 0)::BIGINT, round_even(avg(mtd_blank), 0)::BIGINT FROM chosen GROUP BY region""",
        chosen="""SELECT * FROM summary s WHERE EXISTS (SELECT 1 FROM flagged f
            WHERE f.region = s.region AND f.manager = s.manager AND f.flagged)""",
    ),
    "staff_hours_wtd_mtd": _query(["hours"], "SELECT sp_id, wtd AS wtd_seconds, mtd AS mtd_seconds FROM hours"),
    "daily_adherence": _query(["daily"], "SELECT * FROM daily"),
    "same_day_summary": _query(
        ["day_rated"],
        """SELECT manager, FALSE AS is_total, devices AS total_devices, inactive AS inactive_devices,
            devices - inactive AS active_devices, not_received AS same_day_not_received, received AS same_day_received,
            files AS total_files, (CASE WHEN with_files = 0 THEN 0 ELSE active_pct END)::BIGINT AS active_pct,
            (CASE WHEN with_files = 0 THEN 0 ELSE log END)::BIGINT AS adherence_pct,
            (CASE WHEN with_files = 0 THEN 0 ELSE blank END)::BIGINT AS blank_pct,
            wtd::BIGINT AS wtd_adherence_pct, mtd::BIGINT AS mtd_adherence_pct FROM day_rated UNION ALL
            SELECT 'Grand Total', TRUE, sum(devices)::BIGINT, sum(inactive)::BIGINT, sum(devices - inactive)::BIGINT,
            sum(not_received)::BIGINT, sum(received)::BIGINT, sum(files)::BIGINT, round_even(avg(active_pct), 0)::BIGINT,
            round_even(avg(log), 0)::BIGINT, round_even(avg(blank), 0)::BIGINT, round_even(avg(wtd), 0)::BIGINT,
            round_even(avg(mtd), 0)::BIGINT FROM day_rated""",
    ),
    "assignment_range_join": _query(
        ["spoken"],
        f"""SELECT {_STAFF}, id, d AS date, secs::DOUBLE AS recorded_seconds, coalesce(blank_c, 0)::INTEGER AS blank_file,
            CASE WHEN d IS NOT NULL THEN 'Week ' || week END AS week,
            CASE WHEN d IS NULL THEN NULL WHEN {AS_OF} - d BETWEEN 0 AND 3 THEN 'D-' || ({AS_OF} - d + 1) ELSE 'D-X' END AS day_label
            FROM spoken""",
    ),
    "blank_pct": _query(["rated"], f"SELECT {_STAFF}, blank AS blank_files, files AS total_files, blank_pct FROM rated"),
    "mtd_hours": _query(
        ["rated"],
        f"SELECT {_STAFF}, mtd AS mtd_seconds, {_hms('mtd')} AS mtd_hours, mtd_pct AS mtd_adherence_pct FROM rated",
    ),
    "week_matrix": _query(["rated"], f"SELECT {_STAFF}, {_WEEKS} FROM rated"),
    "day_matrix": _query(["rated"], f"SELECT {_STAFF}, {_DAYS} FROM rated"),
    "adherence_bands": _query(
        ["rated"],
        f"""SELECT {_STAFF}, mtd AS mtd_seconds, {_hms('mtd')} AS mtd_hours, blank AS blank_files, files AS total_files, blank_pct,
            mtd_pct AS mtd_adherence_pct, {_WEEKS}, {_DAYS}, {', '.join(f'{_band(c)} AS {n}_band' for n, c in _RATED.items())} FROM rated""",
    ),
    "reason_matrix": _category_matrix(
        "tenant_calls JOIN call_reasons ON call_reasons.call_id = tenant_calls.id AND outcome = 'unsuccessful'",
        "category",
        "reason",
    ),
    "objection_matrix": _category_matrix(
        "tenant_calls JOIN call_objections ON call_objections.call_id = tenant_calls.id", _title("category"), "objection"
    ),
    "headline": _query(
        ["rated"],
        f"""SELECT tenant, {mean_tenths('d1')}::BIGINT AS avg_adherence, count(*) FILTER (d1 > 0) AS active_staff,
            count(*) AS total_staff FROM rated GROUP BY tenant""",
    ),
    "week_calendar": """WITH months AS (SELECT max(o_orderdate)::DATE AS as_of FROM orders GROUP BY date_trunc('month', o_orderdate)),
        days AS (SELECT as_of, unnest(generate_series(date_trunc('month', as_of)::DATE, last_day(as_of), INTERVAL 1 DAY))::DATE AS d
                 FROM months),
        labelled AS (SELECT *, 1 + count(*) FILTER (dayofweek(d) = 0 AND day(d) > 1)
                       OVER (PARTITION BY as_of ORDER BY d) AS number FROM days)
        SELECT as_of, 'Week ' || number AS week, min(d) AS start_date, max(d) AS end_date, least(max(d), as_of) AS end_to_date,
        count(*) FILTER (d <= as_of)::INTEGER AS working_days, strftime(min(d), '%d-%m-%Y') AS start_text
        FROM labelled GROUP BY as_of, number""",
    "report_periods": """SELECT DISTINCT as_of, date_trunc('month', as_of)::DATE AS month_start, last_day(as_of) AS month_end,
        as_of - (isodow(as_of) - 1)::INT AS week_start, as_of - (isodow(as_of) - 7)::INT AS week_end,
        as_of - dayofweek(as_of)::INT AS sunday_week_start, as_of - dayofweek(as_of)::INT + 6 AS sunday_week_end,
        greatest(date_trunc('month', as_of)::DATE, as_of - 6) AS rolling_start,
        least(date_trunc('month', as_of)::DATE, as_of - 4) AS look_back_start, day(as_of)::INTEGER AS month_days,
        'Week ' || (1 + (SELECT count(*) FROM range(2, day(as_of) + 1) r(n)
                         WHERE dayofweek(date_trunc('month', as_of)::DATE + (n - 1)::INT) = 0)) AS week,
        day(as_of) || CASE WHEN day(as_of) IN (1, 21, 31) THEN 'st' WHEN day(as_of) IN (2, 22) THEN 'nd'
            WHEN day(as_of) IN (3, 23) THEN 'rd' ELSE 'th' END || strftime(as_of, ' %b''%y') AS title
        FROM (SELECT DISTINCT o_orderdate::DATE AS as_of FROM orders)""",
}
SALES_DAY = "DATE '1998-08-15'"


_NAMED = {
    "reason_domain_day": ["category", "interactions", "pct"],
    "reason_domain_wtd_mtd": ["category", "wtd", "mtd"],
    "objection_handling_matrix": ["objection", "explanation_count", "solution_count", "generic_count", "total_objections"],
}


def _one_day(key: str) -> str:
    """A report of the whole history cut to one day, with zero rows of the configured tenants that had no call that day."""
    label, *figures = _NAMED[key]
    return f"""WITH everything AS ({ORACLES[key]}),
        configured AS (SELECT unnest(['Urgent', 'High', 'Medium', 'Not Specified', 'Low', 'Dormant']) AS tenant),
        kinds AS (SELECT {label}, {', '.join(f'0 * min({x}) AS {x}' for x in figures)} FROM everything GROUP BY {label})
        SELECT tenant, as_of, {label}, {', '.join(figures)} FROM everything WHERE as_of = {SALES_DAY} UNION ALL
        SELECT tenant, {SALES_DAY}, {label}, {', '.join(figures)} FROM configured CROSS JOIN kinds
        WHERE tenant NOT IN (SELECT tenant FROM everything WHERE as_of = {SALES_DAY})"""


ORACLES["category_wtd_mtd_one_day"] = f"SELECT * FROM ({ORACLES['category_wtd_mtd']}) WHERE as_of = {SALES_DAY}"
ORACLES["reason_domain_one_day"] = _one_day("reason_domain_day")
ORACLES["reason_domain_wtd_mtd_one_day"] = _one_day("reason_domain_wtd_mtd")
ORACLES["objection_handling_one_day"] = _one_day("objection_handling_matrix")
ORACLES["funnel_region"] = f"SELECT * FROM ({ORACLES['funnel_window']}) WHERE regional_manager_id = 3"
ORACLES["funnel_combined_region_brand"] = "SELECT * FROM ({0}) WHERE regional_manager_id = 26".format(
    ORACLES["funnel_combined_total"].replace("WHERE x.start_date <=", "WHERE ch.brand_id IN (0, 2) AND x.start_date <=")
)
_BRAND_DEVICES = CTES["all_devices"].replace(
    "FROM customer)\n              UNION SELECT name, store_id FROM on_device)",
    "FROM customer) WHERE c_custkey // 15 % 5 IN (1, 3)\n"
    "              UNION SELECT name, store_id FROM on_device WHERE store_id IN (SELECT store_id FROM chain WHERE brand_id IN (1, 3)))",
)
ORACLES["adherence_region_brand"] = "SELECT * EXCLUDE (position) FROM ({0}) WHERE regional_manager_id = 26".format(
    ORACLES["adherence_detail"].replace(CTES["all_devices"], _BRAND_DEVICES)
)
ORACLES["category_display"] = (
    f"SELECT as_of, prod_category, coalesce(wtd::VARCHAR, '-') AS wtd, coalesce(mtd::VARCHAR, '-') AS mtd, position "
    f"FROM ({ORACLES['category_wtd_mtd']})"
)
ORACLES["adherence_display"] = _query(
    ["rated"],
    f"SELECT {_STAFF}, printf('%.1f%%', blank_pct) AS blank_pct, "
    + ", ".join(f"printf('%.1f%%', {c}) AS {n}" for n, c in _RATED.items())
    + " FROM rated",
)
