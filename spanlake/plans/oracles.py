"""The registered queries once more, as SQL over the same tables."""

from __future__ import annotations

# Month text in SQL, and the same roles that plans.mapping gives to orders and line items.
ROLES = r"""
snapshots AS (
  SELECT o_orderkey AS id, o_custkey AS person, o_orderdate AS created,
         strftime(o_orderdate, '%Y%m') AS from_month
  FROM orders),
latest AS (
  SELECT id, person, created, from_month FROM (
    SELECT *, row_number() OVER (PARTITION BY person ORDER BY created DESC, id DESC) AS rn
    FROM snapshots) ranked
  WHERE rn = 1),
periods AS (
  SELECT l_orderkey AS master_id, l_linenumber AS line, l_suppkey AS employer,
         CASE WHEN l_discount = 0 THEN 0.0::DOUBLE ELSE l_extendedprice END AS salary,
         strftime(l_shipdate, '%Y%m') AS to_month
  FROM lineitem),
scoped AS (
  SELECT master_id, line, employer, salary, to_month, person, from_month
  FROM periods JOIN latest ON master_id = id),
valid AS (SELECT * FROM scoped WHERE from_month <= to_month)
"""

MESSY = r"""
texts AS (
  SELECT *, strftime(l_shipdate + to_months((6 - 3 * l_linenumber)::INTEGER), '%Y%m') AS s,
         strftime(l_shipdate, '%Y%m') AS e
  FROM lineitem),
messy AS (
  SELECT l_orderkey AS master_id, l_linenumber AS line,
         CASE WHEN l_quantity = 1 THEN NULL
              WHEN l_quantity = 2 THEN '  ' || s || ' '
              WHEN l_quantity = 3 THEN chr(9) || s
              WHEN l_quantity = 4 THEN s || chr(10)
              WHEN l_quantity = 5 THEN substr(s, 1, 4) || '13'
              WHEN l_quantity = 6 THEN '   '
              ELSE s END AS from_month,
         CASE WHEN l_quantity IN (1, 7) THEN NULL
              WHEN l_quantity = 8 THEN 'x' || e
              WHEN l_quantity = 9 THEN '0000' || substr(e, 5, 2)
              ELSE e END AS to_month,
         l_discount, l_extendedprice
  FROM texts),
clean AS (
  SELECT master_id, line, trim(from_month, ' ') AS from_month, trim(to_month, ' ') AS to_month,
         CASE WHEN l_discount = 0.01 THEN NULL ELSE l_extendedprice END AS salary
  FROM messy),
checked AS (
  SELECT *, regexp_matches(from_month, '^[0-9]{4}(0[1-9]|1[0-2])\z') AS from_ok,
         regexp_matches(to_month, '^[0-9]{4}(0[1-9]|1[0-2])\z') AS to_ok
  FROM clean),
judged AS (
  SELECT *, coalesce(from_ok AND to_ok AND from_month <= to_month, FALSE) AS good
  FROM checked)
"""

REASON = """
  CASE WHEN from_month IS NULL THEN 'from_month NULL'
       WHEN NOT from_ok THEN 'from_month sai format YYYYMM'
       WHEN to_month IS NULL THEN 'to_month NULL'
       WHEN NOT to_ok THEN 'to_month sai format YYYYMM'
       ELSE 'from_month > to_month' END AS "REJECT_REASON"
"""

TIES = """
ties AS (
  SELECT o_orderkey AS id, nullif(o_custkey % 1000, 0) AS person,
         CASE WHEN o_orderkey % 11 <> 0
              THEN date_trunc('year', o_orderdate)::TIMESTAMP END AS created
  FROM orders),
kept AS (
  SELECT id, person, created FROM (
    SELECT *, row_number() OVER (
      PARTITION BY person ORDER BY created DESC NULLS LAST, id DESC NULLS LAST) AS rn
    FROM ties) ranked
  WHERE rn = 1)
"""

# The winners after each of three loads.
LOADS = """
winners AS (
  SELECT * FROM (SELECT unnest([0, 1, 2]) AS load) n JOIN ties ON id % 3 <= load
  QUALIFY row_number() OVER (
    PARTITION BY load, person ORDER BY created DESC NULLS LAST, id DESC NULLS LAST) = 1)
"""

WORKERS = """
detail AS (
  SELECT periods.*, s_nationkey AS worker FROM periods JOIN supplier ON employer = s_suppkey),
known AS (
  SELECT latest.*, c_nationkey AS worker FROM latest JOIN customer ON person = c_custkey)
"""

HOT = """
hot AS (
  SELECT CASE WHEN line <= 3 THEN (SELECT min(id) FROM latest) ELSE master_id END AS master_id,
         line, employer, salary, to_month
  FROM periods)
"""

EVERY = """
every_period AS (
  SELECT l_orderkey AS master_id, l_linenumber AS line, l_suppkey AS employer,
         CASE WHEN l_discount = 0 THEN 0.0::DOUBLE ELSE l_extendedprice END AS salary,
         strftime(l_shipdate - to_months((3 * l_linenumber)::INTEGER), '%Y%m') AS from_month,
         strftime(l_shipdate, '%Y%m') AS to_month, o_custkey AS person
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""


def _axis(source: str) -> str:
    return f"""
axis AS (
  SELECT strftime(m, '%Y%m') AS month FROM (
    SELECT unnest(generate_series(
             strptime(min(from_month) || '01', '%Y%m%d'),
             strptime(max(to_month) || '01', '%Y%m%d'), INTERVAL 1 MONTH)) AS m
    FROM {source}) months)
"""


def _report(source: str, amount: str = "salary::DECIMAL(18, 2)", scale: str = "1") -> str:
    digits = "2" if "DECIMAL" in amount else "4"
    return f"""
by_month AS (
  SELECT month, count(DISTINCT person) AS people, count(DISTINCT employer) AS employers,
         sum({amount}) AS total,
         sum(CASE WHEN salary > 0 THEN {amount} END) AS positive,
         count(CASE WHEN salary > 0 THEN 1 END) AS positive_rows,
         count(DISTINCT CASE WHEN salary = 0 THEN person END) AS zero_pay_people
  FROM axis JOIN {source} ON month BETWEEN from_month AND to_month
  GROUP BY month),
report AS (
  SELECT month AS "THANG_ID", coalesce(people, 0) AS "SO_NGUOI_THAM_GIA",
         coalesce(employers, 0) AS "SO_DON_VI",
         coalesce(round(total::DOUBLE / {scale}, {digits}), 0.0) AS "TONG_QUY_LUONG",
         coalesce(round(positive::DOUBLE / nullif(positive_rows, 0) / {scale}, 4), 0.0)
           AS "LUONG_BINH_QUAN",
         coalesce(zero_pay_people, 0) AS "SO_NGUOI_LUONG_0"
  FROM axis LEFT JOIN by_month USING (month))
"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts) + "\n" + select


_SCOPED_REPORT = (ROLES, _axis("valid"), _report("valid"))

_RULES = """
rules AS (
  SELECT 'orphan periods' AS rule, count(*) AS violations
  FROM periods WHERE NOT EXISTS (SELECT 1 FROM latest WHERE id = master_id)
  UNION ALL
  SELECT 'persons with several snapshots', count(*)
  FROM (SELECT person FROM latest GROUP BY person HAVING count(*) > 1) d
  UNION ALL
  SELECT 'reversed periods', count(*) FROM scoped WHERE from_month > to_month
  UNION ALL
  SELECT 'duplicate months', count(*)
  FROM (SELECT "THANG_ID" FROM report GROUP BY "THANG_ID" HAVING count(*) > 1) d)
"""

ORACLES: dict[str, str] = {
    # Scans and sinks
    "scan_parquet": "SELECT * FROM orders",
    "csv_ingest": """
        SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props
        FROM events""",
    "csv_ingest_multi_line": "SELECT * FROM documents",
    "csv_records": r"""
        SELECT * REPLACE (regexp_replace(text, '([.,]) ', '\1' || chr(10) || '"', 'g')
                          || '"' || chr(10) || chr(10) AS text)
        FROM documents""",
    "bronze_metadata": """
        SELECT *, 'orders.csv' AS source_file, TRUE AS load_time, 'BRONZE' AS layer FROM orders""",
    "write_recount": "SELECT count(*) AS sent, count(*) AS written FROM lineitem",
    "reject_sink": _with(
        MESSY,
        select=f"SELECT master_id, line, from_month, to_month, salary, {REASON}"
        " FROM judged WHERE NOT good",
    ),
    # Projections and snapshots
    "slim_project": "SELECT o_orderkey AS id, o_custkey AS person FROM orders",
    "soft_delete_columns": _with(
        ROLES,
        select='SELECT *, 0 AS "IS_DELETED", NULL::TIMESTAMP AS "DELETED_AT" FROM latest',
    ),
    "clean_months": _with(MESSY, select="SELECT * FROM clean"),
    "distinct_persons": 'SELECT count(*) AS "rows" FROM ('
    "SELECT DISTINCT nullif(o_custkey % 1000, 0) FROM orders) d",
    "latest_per_key": _with(ROLES, select="SELECT * FROM latest"),
    "latest_per_key_with_ties": _with(TIES, select="SELECT * FROM kept"),
    "latest_per_key_max": _with(TIES, select="SELECT * FROM kept"),
    "csv_quarantine": """
        SELECT l_orderkey, l_linenumber,
               concat_ws(';', CASE WHEN l_linenumber % 3 = 0 THEN 'l_quantity=n/a' END,
                         CASE WHEN l_linenumber >= 6 THEN 'l_shipdate=a "day", or so' END) AS bad_cells,
               CASE WHEN l_linenumber % 3 = 0 THEN -1 ELSE l_quantity END::DOUBLE AS quantity,
               l_linenumber >= 6 AS no_date
        FROM lineitem WHERE l_linenumber % 3 = 0 OR l_linenumber >= 6""",
    "latest_merge": _with(
        TIES,
        LOADS,
        select="""
        SELECT id, person, created,
               (id NOT IN (SELECT id FROM winners WHERE load = 2))::INTEGER AS "IS_DELETED",
               CASE WHEN id NOT IN (SELECT id FROM winners WHERE load = 2)
                    THEN make_date(2020, 1, max(load)::INTEGER + 2)::TIMESTAMP END AS "DELETED_AT"
        FROM winners GROUP BY id, person, created""",
    ),
    "latest_changes": _with(
        TIES,
        LOADS,
        select="""
        SELECT CASE WHEN l.id IS NULL THEN 'untouched' WHEN o.id IS NULL THEN 'new'
                    WHEN (coalesce(l.created, TIMESTAMP '0001-01-01'), l.id)
                       > (coalesce(o.created, TIMESTAMP '0001-01-01'), o.id) THEN 'replaced'
                    ELSE 'late' END AS change, count(*) AS rows
        FROM (SELECT * FROM winners WHERE load = 1) o
        FULL JOIN (
          SELECT * FROM ties WHERE id % 3 = 2 QUALIFY row_number() OVER (
            PARTITION BY person ORDER BY created DESC NULLS LAST, id DESC) = 1) l
        ON o.person IS NOT DISTINCT FROM l.person
        GROUP BY 1""",
    ),
    # Linking
    "scope_to_latest": _with(
        ROLES, select="SELECT * FROM periods WHERE master_id IN (SELECT id FROM latest)"
    ),
    "scope_to_latest_worker": _with(
        ROLES,
        WORKERS,
        select="""
        SELECT * FROM detail WHERE EXISTS (
          SELECT 1 FROM known WHERE id = master_id AND known.worker = detail.worker)""",
    ),
    "scope_to_latest_salted": _with(
        ROLES, HOT, select="SELECT * FROM hot WHERE master_id IN (SELECT id FROM latest)"
    ),
    "scope_conservation": _with(
        ROLES,
        WORKERS,
        select="""
        SELECT count(*) AS scoped,
               count(*) FILTER (WHERE same AND to_month <= '199506') AS valid,
               count(*) FILTER (WHERE same AND to_month > '199506') AS rejected,
               count(*) FILTER (WHERE NOT same) AS mismatched
        FROM (SELECT detail.to_month, detail.worker = known.worker AS same
              FROM detail JOIN known ON id = master_id) linked""",
    ),
    "detail_with_person": _with(ROLES, select="SELECT * FROM scoped"),
    "detail_with_person_salted": _with(
        ROLES,
        HOT,
        select="SELECT hot.*, person, from_month FROM hot JOIN latest ON master_id = id",
    ),
    "orphan_periods": _with(
        ROLES, select="SELECT * FROM periods WHERE master_id NOT IN (SELECT id FROM latest)"
    ),
    "orphan_periods_salted": _with(
        ROLES,
        select="""
        SELECT CASE WHEN line > 3 THEN master_id END AS master_id, line, employer, salary, to_month
        FROM periods WHERE line <= 3 OR master_id NOT IN (SELECT id FROM latest)""",
    ),
    # Split
    "month_format_filter": _with(
        MESSY,
        select=r"""
        SELECT master_id, line, from_month, to_month,
               CASE WHEN l_discount = 0.01 THEN 'n/a' ELSE l_extendedprice::VARCHAR END AS salary
        FROM messy WHERE regexp_matches(from_month, '^[0-9]{4}(0[1-9]|1[0-2])\z')
          AND regexp_matches(to_month, '^[0-9]{4}(0[1-9]|1[0-2])\z')""",
    ),
    "valid_intervals": _with(
        MESSY, select="SELECT master_id, line, from_month, to_month, salary FROM judged WHERE good"
    ),
    "reject_reasons": _with(
        MESSY,
        select=f"SELECT master_id, line, from_month, to_month, salary, {REASON}"
        " FROM judged WHERE NOT good",
    ),
    "reject_reasons_known": _with(
        MESSY,
        select="""
        SELECT master_id, line, from_month, to_month, salary,
               CASE WHEN NOT from_ok THEN 'from_month sai format YYYYMM'
                    WHEN NOT to_ok THEN 'to_month sai format YYYYMM'
                    ELSE 'from_month > to_month' END AS "REJECT_REASON"
        FROM judged WHERE NOT (from_ok AND to_ok AND from_month <= to_month)""",
    ),
    "reject_reason_counts": _with(
        MESSY,
        select=f"""
        SELECT "REJECT_REASON", count(*) AS "rows"
        FROM (SELECT {REASON} FROM judged WHERE NOT good) r GROUP BY "REJECT_REASON" """,
    ),
    "split_conservation": _with(
        MESSY,
        select="""
        SELECT count(*) AS "rows", count(*) FILTER (WHERE good) AS valid,
               count(*) FILTER (WHERE NOT good) AS rejected
        FROM judged""",
    ),
    # Months
    "month_bounds": _with(
        ROLES,
        select="SELECT min(from_month) AS first_month, max(to_month) AS last_month FROM valid",
    ),
    "month_dim": _with(ROLES, _axis("valid"), select='SELECT month AS "THANG_ID" FROM axis'),
    "month_dim_empty": """
        SELECT count(*) AS "rows" FROM lineitem
        WHERE regexp_matches('x' || strftime(l_shipdate, '%Y%m'), '^[0-9]{6}$')""",
    "interval_month_join": _with(
        ROLES,
        _axis("valid"),
        select="""
        SELECT master_id, line, from_month, to_month, month AS "THANG_ID"
        FROM scoped JOIN axis ON month BETWEEN from_month AND to_month""",
    ),
    "interval_month_explode": _with(
        ROLES,
        _axis("valid"),
        select="""
        SELECT master_id, line, from_month, to_month, month AS "THANG_ID"
        FROM scoped JOIN axis ON month BETWEEN from_month AND to_month""",
    ),
    # Report
    "monthly_report": _with(*_SCOPED_REPORT, select="SELECT * FROM report"),
    "monthly_report_given_axis": _with(
        ROLES,
        EVERY,
        _axis("every_period"),
        _report("valid"),
        select="SELECT * FROM report",
    ),
    "monthly_report_explode": _with(*_SCOPED_REPORT, select="SELECT * FROM report"),
    "monthly_report_range_join": _with(*_SCOPED_REPORT, select="SELECT * FROM report"),
    "monthly_report_every_period": _with(
        EVERY, _axis("every_period"), _report("every_period"), select="SELECT * FROM report"
    ),
    "monthly_report_range": _with(
        EVERY,
        _axis("every_period"),
        _report("every_period"),
        select="""SELECT * FROM report WHERE "THANG_ID" BETWEEN '199511' AND '199810'""",
    ),
    "monthly_report_incremental": _with(
        EVERY,
        "left_over AS (SELECT * FROM every_period WHERE line BETWEEN 2 AND 6)",
        _axis("left_over"),
        _report("left_over"),
        select="SELECT * FROM report",
    ),
    "gap_fill_left_join": _with(
        ROLES,
        EVERY,
        _axis("every_period"),
        _report("valid"),
        select="SELECT * FROM report",
    ),
    "monthly_report_fine_amounts": _with(
        ROLES,
        "paid AS (SELECT * REPLACE (salary / 7.3::DOUBLE AS salary) FROM valid)",
        _axis("paid"),
        _report("paid", "salary"),
        select="SELECT * FROM report",
    ),
    "monthly_report_large_amounts": _with(
        ROLES,
        "paid AS (SELECT * REPLACE (salary * 1e20 / 7.3::DOUBLE AS salary) FROM valid)",
        _axis("paid"),
        _report("paid", "salary", "1e20"),
        select="SELECT * FROM report",
    ),
    **{
        name: _with(*_SCOPED_REPORT, select=f'SELECT "THANG_ID", "{metric}" FROM report')
        for name, metric in {
            "monthly_participants": "SO_NGUOI_THAM_GIA",
            "monthly_employers": "SO_DON_VI",
            "monthly_payroll": "TONG_QUY_LUONG",
            "monthly_avg_positive": "LUONG_BINH_QUAN",
            "monthly_zero_pay_people": "SO_NGUOI_LUONG_0",
        }.items()
    },
    "report_summary": _with(
        *_SCOPED_REPORT,
        select="""
        SELECT max("SO_NGUOI_THAM_GIA") AS "MAX_NGUOI_THAM_GIA",
               round(sum("TONG_QUY_LUONG"), 2) AS "SUM_QUY_LUONG_TAT_CA_THANG",
               sum("SO_NGUOI_LUONG_0")::BIGINT AS "SUM_NGUOI_LUONG_0"
        FROM report""",
    ),
    "report_presentation": _with(
        *_SCOPED_REPORT,
        select="""
        SELECT substr("THANG_ID", 1, 4) || '-' || substr("THANG_ID", 5, 2) AS "Tháng",
               format('{:,}', "SO_NGUOI_THAM_GIA") AS "Số người tham gia",
               format('{:,}', "SO_DON_VI") AS "Số đơn vị",
               format('{:,.0f}', "TONG_QUY_LUONG") AS "Tổng quỹ lương (đ)",
               format('{:,.0f}', "LUONG_BINH_QUAN") AS "Lương bình quân (đ)",
               format('{:,}', "SO_NGUOI_LUONG_0") AS "Số người lương 0"
        FROM report""",
    ),
    # Rules
    "layer_counts": """
        SELECT 'orders' AS "table", count(*) AS "rows" FROM orders
        UNION ALL SELECT 'lineitem', count(*) FROM lineitem""",
    "dq_duplicate_keys": """
        SELECT 'duplicate lines' AS rule, count(*) AS violations FROM (
          SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) d""",
    "dq_latest_parity": _with(
        TIES,
        select="""
        SELECT 'latest rows differ from distinct keys' AS rule,
               abs((SELECT count(*) FROM kept)
                   - (SELECT count(*) FROM (SELECT DISTINCT person FROM ties) d)) AS violations""",
    ),
    "dq_latest_parity_broken": _with(
        TIES,
        select="""
        SELECT 'latest rows differ from distinct keys' AS rule,
               abs((SELECT count(*) FROM kept WHERE id % 5 <> 0)
                   - (SELECT count(*) FROM (SELECT DISTINCT person FROM ties) d)) AS violations""",
    ),
    "dq_written_rows": "SELECT 'periods: written rows' AS rule, 0::BIGINT AS violations",
    "dq_written_rows_lost": """
        SELECT 'periods: written rows' AS rule, count(*) AS violations FROM lineitem WHERE l_linenumber >= 7""",
    "dq_expected_rows": """
        SELECT 'periods: expected rows' AS rule,
               abs((SELECT count(*) FROM lineitem) - 7 * (SELECT count(*) FROM orders))
                 AS violations""",
    "dq_empty_axis": _with(
        ROLES,
        _axis("valid"),
        select="""
        SELECT 'empty month axis' AS rule, (count(*) = 0)::BIGINT AS violations FROM axis""",
    ),
    "dq_empty_axis_broken": _with(
        ROLES,
        select="""
        SELECT 'empty month axis' AS rule, (count(*) = 0)::BIGINT AS violations
        FROM valid WHERE regexp_matches('x' || to_month, '^[0-9]{6}$')""",
    ),
    "dq_report_incomplete": _with(
        *_SCOPED_REPORT,
        select="""
        SELECT 'report months differ from axis' AS rule,
               abs((SELECT count(*) FROM report WHERE NOT ends_with("THANG_ID", '06'))
                   - (SELECT count(*) FROM axis)) AS violations""",
    ),
    "dq_orphans": _with(
        ROLES,
        select="""
        SELECT 'orphan periods' AS rule, count(*) AS violations
        FROM periods WHERE master_id NOT IN (SELECT id FROM latest)""",
    ),
    "dq_link_mismatch": _with(
        ROLES,
        WORKERS,
        select="""
        SELECT 'worker id mismatches' AS rule, count(*) AS violations
        FROM detail WHERE master_id IN (SELECT id FROM known) AND NOT EXISTS (
          SELECT 1 FROM known WHERE id = master_id AND known.worker = detail.worker)""",
    ),
    "dq_interval_order": _with(
        ROLES,
        select="""
        SELECT 'reversed periods' AS rule, count(*) AS violations
        FROM scoped WHERE from_month > to_month""",
    ),
    "dq_malformed_months": _with(
        MESSY,
        select="""
        SELECT 'malformed periods' AS rule, count(*) AS violations
        FROM checked WHERE NOT coalesce(from_ok AND to_ok, FALSE)""",
    ),
    "dq_null_keys": """
        SELECT 'NULL person' AS rule, count(*) AS violations
        FROM orders WHERE o_custkey % 1000 = 0""",
    "dq_nan_amounts": """
        SELECT 'NaN amounts' AS rule, count(*) AS violations
        FROM lineitem WHERE l_linenumber = 7""",
    "dq_report_complete": _with(
        *_SCOPED_REPORT,
        select="""
        SELECT 'report months differ from axis' AS rule,
               abs((SELECT count(*) FROM report) - (SELECT count(*) FROM axis)) AS violations""",
    ),
    "dq_duplicate_months": """
        SELECT 'duplicate months' AS rule, count(*) AS violations FROM (
          SELECT 1 FROM lineitem GROUP BY strftime(l_shipdate, '%Y%m') HAVING count(*) > 1) d""",
    "dq_negative_total": """
        SELECT 'negative payrolls' AS rule, count(*) AS violations FROM (
          SELECT sum(CASE WHEN l_linenumber % 2 = 0 THEN l_extendedprice::DECIMAL(18, 2)
                          ELSE -l_extendedprice::DECIMAL(18, 2) END) AS total
          FROM lineitem GROUP BY l_shipdate::DATE) t
        WHERE total < 0""",
    "validate_rules": _with(*_SCOPED_REPORT, _RULES, select="SELECT * FROM rules"),
    "validate_summary": _with(
        *_SCOPED_REPORT,
        _RULES,
        select='SELECT sum(violations)::BIGINT AS "ERROR_ROWS" FROM rules',
    ),
    "layer_status": _with(
        ROLES,
        select="""
        SELECT 'SILVER' AS layer,
               CASE WHEN (SELECT count(*) FROM (
                            SELECT 1 FROM latest GROUP BY person HAVING count(*) > 1) d)
                       + (SELECT count(*) FROM scoped
                          WHERE master_id NOT IN (SELECT id FROM latest)) > 0
                    THEN 'FAILED' ELSE 'SUCCESS' END AS status,
               metric, value
        FROM (SELECT 'MASTER_ROWS' AS metric, (SELECT count(*) FROM latest) AS value
              UNION ALL SELECT 'DETAIL_ROWS', (SELECT count(*) FROM scoped)) m""",
    ),
    "layer_status_failed": _with(
        ROLES,
        select="""
        SELECT 'SILVER' AS layer,
               CASE WHEN (SELECT count(*) FROM periods
                          WHERE master_id NOT IN (SELECT id FROM latest)) > 0
                    THEN 'FAILED' ELSE 'SUCCESS' END AS status,
               'DETAIL_ROWS' AS metric, (SELECT count(*) FROM periods) AS value""",
    ),
}
