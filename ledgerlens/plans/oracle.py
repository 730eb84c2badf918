"""DuckDB SQL oracle: one independent SQL text per catalog query.

GROUP BYs), not from the Spark plans. The test tables are pre-registered
views; stand-in tables are rebuilt here as CTEs. Dates are published as ISO
text. Money sums use exact integer millionths, as the library does.
"""

from __future__ import annotations

import math


def MS(x: str) -> str:
    """Exact money sum: integer millionths, summed, back to double."""
    return f"(CAST(sum(CAST(round_even({x} * 1000000.0, 0) AS HUGEINT)) AS DOUBLE) / 1000000.0)"


def MU(x: str) -> str:
    """A money value as integer millionths."""
    return f"CAST(round_even({x} * 1000000.0, 0) AS HUGEINT)"


def D(c: str, alias: str | None = None) -> str:
    return f"strftime({c}, '%Y-%m-%d') AS {alias or c}"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes)


def _tenant(multi: bool) -> str:
    return "c_mktsegment" if multi else "'t0'"


HEADERS = ("orders LEFT JOIN customer ON o_custkey = c_custkey "
           "LEFT JOIN nation ON c_nationkey = n_nationkey")
ORDER_COLS = ["order_no", "date_created", "customer_id", "ship2_name", "ship2_email_address",
              "ship2_add1", "ship2_add2", "ship2_add3", "ship2_city", "ship2_country",
              "unit_price", "unit_quantity", "unit_of_measure", "payment_method", "supplier_id",
              "sales_tax", "sales_cost", "item_desc", "class_id1", "class_id2", "class_id3",
              "class_id4", "class_id5", *[f"price{i}" for i in range(1, 11)]]
PO_COLS = ["po_no", "qty_ordered", "qty_received", "unit_price", "date_created",
           "date_last_modified", "item_description", "unit_of_measure", "contract_number",
           "vendor_id", "ship2_name", "ship2_add1", "ship2_add2", "ship2_city", "ship2_state",
           "ship2_country", "ship2_zip", "location_id", "vendor_name"]


def order_tables(multi: bool = False) -> str:
    nulls = ", ".join(f"CAST(NULL AS DOUBLE) AS price{i}" for i in range(2, 11))
    return f"""
oe_line AS (
  SELECT l_orderkey AS order_no, l_partkey AS inv_mast_uid, l_suppkey AS supplier_id,
         l_extendedprice / l_quantity AS unit_price, l_quantity AS unit_quantity,
         l_linestatus AS unit_of_measure, l_tax AS sales_tax,
         l_extendedprice * (1 - l_discount) AS sales_cost
  FROM lineitem),
oe_hdr AS (
  SELECT {_tenant(multi)} AS company_id, o_orderkey AS order_no, o_orderdate AS date_created,
         o_custkey AS customer_id, c_name AS ship2_name,
         CASE WHEN o_custkey % 97 = 0 THEN NULL
              ELSE 'c' || CAST(o_custkey AS VARCHAR) || '@example.com' END AS ship2_email_address,
         CAST(NULL AS VARCHAR) AS ship2_add1, CAST(NULL AS VARCHAR) AS ship2_add2,
         CAST(NULL AS VARCHAR) AS ship2_add3, n_name AS ship2_city, n_name AS ship2_country,
         o_orderpriority AS payment_method
  FROM {HEADERS}),
inv_mast AS (
  SELECT p_partkey AS inv_mast_uid, concat_ws(' ', p_name, p_brand) AS item_desc,
         p_brand AS class_id1, p_type AS class_id2, CAST(p_size AS VARCHAR) AS class_id3,
         CAST(NULL AS VARCHAR) AS class_id4, CAST(NULL AS VARCHAR) AS class_id5,
         p_retailprice AS price1, {nulls}
  FROM part),
order_extract AS (
  SELECT h.company_id, l.order_no, h.date_created, h.customer_id, h.ship2_name,
         h.ship2_email_address, h.ship2_add1, h.ship2_add2, h.ship2_add3, h.ship2_city,
         h.ship2_country, l.unit_price, l.unit_quantity, l.unit_of_measure, h.payment_method,
         l.supplier_id, l.sales_tax, l.sales_cost, i.item_desc, i.class_id1, i.class_id2,
         i.class_id3, i.class_id4, i.class_id5, {", ".join(f"i.price{i}" for i in range(1, 11))}
  FROM oe_line l JOIN oe_hdr h ON l.order_no = h.order_no
       LEFT JOIN inv_mast i ON l.inv_mast_uid = i.inv_mast_uid),
raw_orders AS (SELECT *, unit_price * unit_quantity AS price FROM order_extract)"""


def purchase_tables(multi: bool = False) -> str:
    return f"""
po_line AS (
  SELECT l_orderkey AS po_no, l_quantity AS qty_ordered, l_quantity AS qty_received,
         l_extendedprice / l_quantity AS unit_price, l_shipdate AS date_created,
         l_shipdate AS date_last_modified, concat_ws(' ', p_name, p_brand) AS item_description,
         l_linestatus AS unit_of_measure,
         CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_linenumber = 7 THEN ''
              ELSE 'C-' || CAST(l_suppkey AS VARCHAR) END AS contract_number,
         l_suppkey AS vendor_id
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey),
po_hdr AS (
  SELECT {_tenant(multi)} AS company_id, o_orderkey AS po_no, c_name AS ship2_name,
         CAST(NULL AS VARCHAR) AS ship2_add1, CAST(NULL AS VARCHAR) AS ship2_add2,
         n_name AS ship2_city, CAST(NULL AS VARCHAR) AS ship2_state, n_name AS ship2_country,
         CAST(NULL AS VARCHAR) AS ship2_zip, CAST(c_nationkey AS BIGINT) AS location_id
  FROM {HEADERS}),
vendor AS (SELECT s_suppkey AS vendor_id, s_name AS vendor_name FROM supplier),
purchase_extract AS (
  SELECT h.company_id, l.po_no, l.qty_ordered, l.qty_received, l.unit_price, l.date_created,
         l.date_last_modified, l.item_description, l.unit_of_measure, l.contract_number,
         l.vendor_id, h.ship2_name, h.ship2_add1, h.ship2_add2, h.ship2_city, h.ship2_state,
         h.ship2_country, h.ship2_zip, h.location_id, v.vendor_name
  FROM po_line l JOIN po_hdr h ON l.po_no = h.po_no
       LEFT JOIN vendor v ON l.vendor_id = v.vendor_id),
po_prepared AS (
  SELECT * REPLACE (CASE WHEN po_no % 50 = 0 THEN NULL ELSE po_no END AS po_no),
         unit_price * qty_ordered AS price, CAST(year(date_created) AS INTEGER) AS year
  FROM purchase_extract),
purchase_order AS (
  SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY {order_by(PO_COLS + ['price', 'year'])}) - 1 AS "index"
  FROM po_prepared)"""


def order_by(cols: list[str]) -> str:
    return ", ".join(f'"{c}" ASC NULLS FIRST' for c in cols)


def calendar_sql(t: str) -> str:
    return f"""CAST(year({t}) AS INTEGER) AS year, CAST(month({t}) AS INTEGER) AS month,
         CAST(week({t}) AS INTEGER) AS week, CAST(day({t}) AS INTEGER) AS day,
         CAST(isodow({t}) - 1 AS INTEGER) AS dayofweek,
         CAST(dayofyear({t}) AS INTEGER) AS dayofyear, CAST({t} AS DATE) AS just_date,
         strftime({t}, '%Y-%m') AS year_month, strftime({t}, '%b') AS month_abbr,
         strftime({t}, '%a') AS day_abbr, CAST(hour({t}) AS INTEGER) AS hour,
         CAST(quarter({t}) AS INTEGER) AS quater,
         CASE WHEN hour({t}) <= 4 THEN 'Late Night' WHEN hour({t}) <= 8 THEN 'Early Morning'
              WHEN hour({t}) <= 12 THEN 'Morning' WHEN hour({t}) <= 16 THEN 'Noon'
              WHEN hour({t}) <= 20 THEN 'Evening' WHEN hour({t}) <= 24 THEN 'Night' END AS session"""


def sales_from(src: str = "raw_orders") -> str:
    return f"""
sales_dedup AS (
  SELECT DISTINCT company_id, ship2_city AS city, ship2_country AS country_iso2,
         date_created AS created_at, ship2_email_address AS email, item_desc AS name,
         unit_quantity AS qty_ordered, order_no AS order_id, customer_id, price AS total,
         supplier_id, unit_price, unit_of_measure, payment_method AS method
  FROM {src}),
sales_shifted AS (
  SELECT * REPLACE (CAST(created_at AS TIMESTAMP) - INTERVAL 8 HOUR AS created_at)
  FROM sales_dedup),
sales AS (
  SELECT company_id, city, country_iso2, created_at AS date_created, email, name, qty_ordered,
         order_id, customer_id, total, supplier_id, unit_price, unit_of_measure, method,
         {calendar_sql('created_at')}
  FROM sales_shifted WHERE created_at IS NOT NULL AND email IS NOT NULL)"""


SALES_COLS = ["company_id", "city", "country_iso2", "date_created", "email", "name",
              "qty_ordered", "order_id", "customer_id", "total", "supplier_id", "unit_price",
              "unit_of_measure", "method", "year", "month", "week", "day", "dayofweek",
              "dayofyear", "just_date", "year_month", "month_abbr", "day_abbr", "hour", "quater",
              "session"]


def publish_cols(cols: list[str], dates: set[str]) -> str:
    return ", ".join(D(f'"{c}"', f'"{c}"') if c in dates else f'"{c}"' for c in cols)


SALES_OUT = publish_cols(SALES_COLS, {"just_date"})

# -- customer summary -------------------------------------------------------------
TIE = ["date_created", "order_id", "name", "qty_ordered", "unit_price", "total", "customer_id",
       "supplier_id", "unit_of_measure", "method", "city", "country_iso2"]
SUMMARY = f"""
ss_src AS (SELECT *, CAST(date_created AS DATE) AS created_at FROM sales
           WHERE date_created IS NOT NULL AND email IS NOT NULL),
ss_int AS (
  SELECT *, CAST(COALESCE(date_diff('day', lag(created_at) OVER (
              PARTITION BY company_id, email ORDER BY created_at, {order_by(TIE)}), created_at), 0)
         AS BIGINT) AS "interval"
  FROM ss_src),
ss_cust AS (
  SELECT company_id, email, min(created_at) AS mn, max(created_at) AS mx, count(*) AS n,
         sum("interval") AS s, sum("interval" * "interval") AS q
  FROM ss_int GROUP BY company_id, email),
ss_last AS (SELECT company_id, max(just_date) AS last_day FROM ss_src GROUP BY company_id),
ss_a AS (
  SELECT i.*, c.mn AS "min", c.mx AS "max", c.n AS len, CAST(c.s AS DOUBLE) / c.n AS mean,
         COALESCE(1.4 * CASE WHEN c.n > 1 THEN sqrt(
             CAST(CAST(c.n AS HUGEINT) * c.q - CAST(c.s AS HUGEINT) * c.s AS DOUBLE)
             / CAST(CAST(c.n AS HUGEINT) * (c.n - 1) AS DOUBLE)) END, 0.0) AS std_,
         CAST(date_diff('day', c.mn, c.mx) AS DOUBLE) AS diff,
         CAST(date_diff('day', c.mx, l.last_day) AS BIGINT) AS recent_order
  FROM ss_int i JOIN ss_cust c ON i.company_id = c.company_id AND i.email = c.email
       JOIN ss_last l ON i.company_id = l.company_id),
sales_summary AS (
  SELECT * EXCLUDE (avg_day0),
         CASE WHEN recent_order > avg_metric THEN 'churn' ELSE 'active' END AS churn_label
  FROM (
    SELECT *, abs("interval" - mean) AS avg_diff,
           CASE WHEN (len > 2 AND abs("interval" - mean) > std_) OR (len = 2 AND "interval" > 0)
                THEN 'returned' ELSE 'not_returned' END AS win_back,
           CAST(created_at = "min" AS INTEGER) AS new_customer, "min" AS min_c, "max" AS max_c,
           diff / len AS avg_day, diff / len AS avg_day0, (diff / len) * 2 AS avg_metric,
           CASE len WHEN 1 THEN '1 Order' WHEN 2 THEN '2 Orders' WHEN 3 THEN '3 Orders'
                ELSE '4+ Orders' END AS freq_pur,
           CAST(len > 3 AS INTEGER) AS repeat_customer
    FROM ss_a))"""
SUMMARY_EXTRA = ["created_at", "interval", "min", "max", "len", "mean", "std_", "avg_diff",
                 "win_back", "new_customer", "min_c", "max_c", "diff", "avg_day", "avg_metric",
                 "recent_order", "churn_label", "freq_pur", "repeat_customer"]
SUMMARY_DATES = {"just_date", "created_at", "min", "max", "min_c", "max_c"}

GAP_CHURN = """
g_src AS (SELECT company_id, email, CAST(date_created AS DATE) AS just_date FROM sales
          WHERE email IS NOT NULL AND date_created IS NOT NULL),
g_days AS (SELECT company_id, just_date, email, count(*) AS "count" FROM g_src
           GROUP BY company_id, just_date, email),
g_last AS (SELECT company_id, max(just_date) AS last_day FROM g_src GROUP BY company_id),
g1 AS (
  SELECT d.*, CAST(date_diff('day', d.just_date, l.last_day) AS BIGINT) AS recent_order,
         COALESCE(date_diff('day', lag(d.just_date) OVER (PARTITION BY d.company_id, d.email
                  ORDER BY d.just_date), d.just_date), 0) AS gap
  FROM g_days d JOIN g_last l ON d.company_id = l.company_id),
g2 AS (SELECT *, round_even(avg(gap) OVER (PARTITION BY company_id, email), 0) AS avg_days_order
       FROM g1),
g3 AS (SELECT *, avg_days_order * 2 AS avg_rate,
              CASE WHEN recent_order > avg_days_order * 2 THEN 'churn' ELSE 'active' END AS churn_label
       FROM g2)"""

# -- RFM --------------------------------------------------------------------------
def rfm_base_sql(trailing: int | None = None) -> str:
    trail, src = "", "sales"
    if trailing is not None:
        trail = f"""
rb_trail AS (
  SELECT s.* FROM sales s JOIN (SELECT company_id, max(just_date) AS mx FROM sales
                                GROUP BY company_id) m ON s.company_id = m.company_id
  WHERE s.just_date >= CAST(m.mx - INTERVAL {trailing} DAY AS DATE)),"""
        src = "rb_trail"
    return trail + f"""
rb_src AS (
  SELECT company_id, customer_id, email, just_date, order_id, total FROM {src}
  WHERE customer_id IS NOT NULL AND order_id IS NOT NULL AND email IS NOT NULL),
rb_ref AS (SELECT company_id, max(just_date) + 1 AS ref FROM rb_src GROUP BY company_id),
rb_agg AS (
  SELECT company_id, email, max(just_date) AS last_day, count(order_id) AS frequency,
         {MS('total')} AS monetary
  FROM rb_src GROUP BY company_id, email),
rfm_base AS (
  SELECT a.company_id, a.email, CAST(date_diff('day', a.last_day, r.ref) AS BIGINT) AS recency,
         a.frequency, a.monetary, round_even(ln(a.frequency), 10) AS frequency_log,
         round_even(ln(a.monetary), 10) AS monetary_log,
         round_even(ln(date_diff('day', a.last_day, r.ref)), 10) AS recency_log
  FROM rb_agg a JOIN rb_ref r ON a.company_id = r.company_id
  WHERE a.monetary <> 0 AND a.monetary > 0)"""


RFM_SCALED = """
rz_stats AS (
  SELECT company_id, avg(recency_log) AS mr, avg(frequency_log) AS mf, avg(monetary_log) AS mm,
         stddev_pop(recency_log) AS sr, stddev_pop(frequency_log) AS sf,
         stddev_pop(monetary_log) AS sm
  FROM rfm_base GROUP BY company_id),
rfm_scaled AS (
  SELECT b.*, (recency_log - mr) / CASE WHEN sr = 0 THEN 1.0 ELSE sr END AS recency_z,
         (frequency_log - mf) / CASE WHEN sf = 0 THEN 1.0 ELSE sf END AS frequency_z,
         (monetary_log - mm) / CASE WHEN sm = 0 THEN 1.0 ELSE sm END AS monetary_z
  FROM rfm_base b JOIN rz_stats s ON b.company_id = s.company_id)"""


def clusters_sql() -> str:
    """Lloyd's algorithm per tenant until no centre moves, 300 rounds at most."""
    start = [(-1.2, 1.2, 1.2), (-0.4, 0.4, 0.4), (0.4, -0.4, -0.4), (1.2, -1.2, -1.2)]

    def dist(j):
        return " + ".join(f"(q{f} - c{j}{f}) * (q{f} - c{j}{f})" for f in range(3))

    near = ", ".join(f"{dist(j)} AS d{j}" for j in range(4))
    pick = ("CASE WHEN d0 <= d1 AND d0 <= d2 AND d0 <= d3 THEN 0 WHEN d1 <= d2 AND d1 <= d3 THEN 1 "
            "WHEN d2 <= d3 THEN 2 ELSE 3 END")
    names = [(j, f) for j in range(4) for f in range(3)]
    first = ", ".join(f"CAST({start[j][f]!r} AS DOUBLE) * 1e8 AS c{j}{f}" for j, f in names)
    moved = ", ".join(f"CASE WHEN count(*) FILTER (k = {j}) > 0 THEN CAST(sum(CAST(q{f} AS BIGINT)) FILTER (k = {j}) AS DOUBLE)"
                      f" / count(*) FILTER (k = {j}) ELSE max(c{j}{f}) END AS n{j}{f}" for j, f in names)
    q = ", ".join(f"CAST(floor({z} * 1e8 + 0.5) AS DOUBLE) AS q{f}"
                  for f, z in enumerate(("recency_z", "frequency_z", "monetary_z")))
    old = ", ".join(f"max(c{j}{f}) AS c{j}{f}" for j, f in names)
    same = " AND ".join(f"n{j}{f} = c{j}{f}" for j, f in names)
    return f"""
km_p AS MATERIALIZED (SELECT company_id, email, {q} FROM rfm_scaled),
km_c AS (
  SELECT DISTINCT company_id, 0 AS round, false AS done, {first} FROM km_p
  UNION ALL
  SELECT company_id, round + 1, {same}, {", ".join(f"n{j}{f}" for j, f in names)} FROM (
    SELECT company_id, max(round) AS round, {old}, {moved} FROM (
      SELECT *, {pick} AS k FROM (SELECT p.*, c.* EXCLUDE (company_id), {near} FROM km_p p JOIN km_c c USING (company_id)
                                  WHERE NOT c.done AND c.round < 300))
    GROUP BY company_id)),
km_last AS (SELECT * FROM km_c QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY round DESC) = 1),
km AS (SELECT company_id, email, CAST({pick} AS INTEGER) AS cluster, done AS converged FROM (
  SELECT p.*, c.* EXCLUDE (company_id), {near} FROM km_p p JOIN km_last c USING (company_id)))"""


def _bin(rank: str) -> str:
    return (f"(1 + CAST(4*({rank}-1) > (n-1) AS INTEGER) + CAST(4*({rank}-1) > 2*(n-1) AS INTEGER)"
            f" + CAST(4*({rank}-1) > 3*(n-1) AS INTEGER))")


RFM_SCORES = f"""
rs_q AS (
  SELECT company_id, quantile_cont(recency, 0.25) AS q1, quantile_cont(recency, 0.5) AS q2,
         quantile_cont(recency, 0.75) AS q3, count(*) AS n
  FROM rfm_base GROUP BY company_id),
rs_rank AS (
  SELECT b.*, q.q1, q.q2, q.q3, q.n,
         row_number() OVER (PARTITION BY b.company_id ORDER BY b.frequency, b.email) AS rf,
         row_number() OVER (PARTITION BY b.company_id ORDER BY b.monetary, b.email) AS rm
  FROM rfm_base b JOIN rs_q q ON b.company_id = q.company_id),
rs_bins AS (
  SELECT *,
    CAST(CASE WHEN recency <= q1 THEN 1 WHEN recency <= q2 THEN 2 WHEN recency <= q3 THEN 3
              ELSE 4 END AS INTEGER) AS r,
    CAST(5 - {_bin('rf')} AS INTEGER) AS f,
    CAST(5 - {_bin('rm')} AS INTEGER) AS m
  FROM rs_rank),
rfm_scores AS (
  SELECT company_id, email, recency, frequency, monetary, frequency_log, monetary_log,
         recency_log, r, f, m,
         CAST(r AS VARCHAR) || CAST(f AS VARCHAR) || CAST(m AS VARCHAR) AS rfm,
         r + f + m AS s_rfm, CAST(r * 100 + f * 10 + m AS INTEGER) AS rfm_int
  FROM rs_bins)"""


def segment_case() -> str:
    # restates the fixed lookup table of ledgerlens.functions.labels as SQL
    from ..functions.labels import QUADRANT_SEGMENTS, SEGMENT_CODES
    seg = " ".join(f"WHEN rfm_int IN ({', '.join(map(str, codes))}) THEN '{name}'"
                   for name, codes in SEGMENT_CODES.items())
    quad = " ".join(f"WHEN cust_segment IN ({', '.join(repr(s) for s in segs)}) THEN '{q}'"
                    for q, segs in QUADRANT_SEGMENTS.items())
    return f"""
rseg AS (SELECT *, CASE {seg} END AS cust_segment FROM rfm_scores),
rfm_labeled AS (
  SELECT *, CASE {quad} END AS quad_segment,
         CASE frequency WHEN 1 THEN '1 Order' WHEN 2 THEN '2 Orders' WHEN 3 THEN '3 Orders'
              ELSE '4+ Orders' END AS f_label,
         monetary / frequency AS avg_order_value
  FROM rseg)"""


RFM_SCORE_COLS = ["company_id", "email", "recency", "frequency", "monetary", "frequency_log",
                  "monetary_log", "recency_log", "r", "f", "m", "rfm", "s_rfm", "rfm_int"]
RFM_TABLE = """
rfm_span AS (SELECT company_id, email, min(min_c) AS min_c, max(max_c) AS max_c
             FROM sales_summary GROUP BY company_id, email),
rfm AS (
  SELECT l.*, s.min_c, s.max_c FROM rfm_labeled l
  JOIN rfm_span s ON l.company_id = s.company_id AND l.email = s.email)"""
RFM_COLS = RFM_SCORE_COLS + ["cust_segment", "quad_segment", "f_label", "avg_order_value",
                             "min_c", "max_c"]

# -- cohorts ----------------------------------------------------------------------------
def cohort_sql(months: int, start: str | None = None, end: str | None = None) -> str:
    where = []
    if start:
        where.append(f"date_created >= TIMESTAMP '{start}'")
    if end:
        where.append(f"date_created <= TIMESTAMP '{end}'")
    cond = ("WHERE " + " AND ".join(where)) if where else ""
    return f"""
c_src AS (SELECT company_id, order_id, date_created, email, total,
                 CAST(date_created AS DATE) AS just_date FROM sales {cond}),
c_cut AS (SELECT company_id, max(just_date) - CAST(day(max(just_date)) AS INTEGER) AS cut
          FROM c_src GROUP BY company_id),
c_rows AS (
  SELECT s.* FROM c_src s JOIN c_cut c ON s.company_id = c.company_id
  WHERE s.just_date <= c.cut AND s.order_id IS NOT NULL AND s.just_date IS NOT NULL
    AND s.email IS NOT NULL AND s.total IS NOT NULL AND s.total > 0),
c_start AS (SELECT company_id,
                   CAST(date_trunc('month', max(just_date)) - INTERVAL {months} MONTH AS DATE) AS st
            FROM c_rows GROUP BY company_id),
c_win AS (SELECT r.*, CAST(date_trunc('month', r.just_date) AS DATE) AS order_month
          FROM c_rows r JOIN c_start s ON r.company_id = s.company_id WHERE r.just_date >= s.st),
c_first AS (SELECT company_id, email, min(order_month) AS cm FROM c_win GROUP BY company_id, email),
c_idx AS (
  SELECT w.*, c.cm,
         CAST((year(w.order_month) - year(c.cm)) * 360
              + (month(w.order_month) - month(c.cm)) * 30 AS INTEGER) AS cohort_index
  FROM c_win w JOIN c_first c ON w.company_id = c.company_id AND w.email = c.email),
cohort_data AS (
  SELECT company_id, strftime(cm, '%Y-%m') AS cohortmonth, cohort_index,
         count(DISTINCT email) AS customer_count, {MS('total')} / count(*) AS average_sales
  FROM c_idx GROUP BY company_id, strftime(cm, '%Y-%m'), cohort_index)"""


def cohort_names(months: int) -> list[tuple[int, str]]:
    return [(0, "new_customer")] + [(30 * i, f"days_{30 * i}") for i in range(1, months + 1)]


def cohort_counts_sql(months: int) -> str:
    cols = ", ".join(f"CAST(max(CASE WHEN cohort_index = {v} THEN customer_count END) AS DOUBLE) AS {n}"
                     for v, n in cohort_names(months))
    return f"""
cohort_counts AS (SELECT company_id, cohortmonth, {cols} FROM cohort_data
                  GROUP BY company_id, cohortmonth)"""


def retention_select(months: int) -> str:
    cols = ", ".join(f"round_even({n} / new_customer, 3) * 100 AS {n}"
                     for _, n in cohort_names(months))
    return f"SELECT company_id, cohortmonth, {cols} FROM cohort_counts"


# -- series ---------------------------------------------------------------------------
def full_month_series(src: str, value: str, name: str, where: str = "") -> str:
    return f"""
{name}_src AS (SELECT company_id, CAST(date_created AS DATE) AS ds, * EXCLUDE (company_id)
               FROM {src} WHERE date_created IS NOT NULL {where}),
{name}_cut AS (SELECT company_id, max(ds) - CAST(day(max(ds)) AS INTEGER) AS cut
               FROM {name}_src GROUP BY company_id),
{name} AS (
  SELECT s.company_id, s.ds, {value} AS y
  FROM {name}_src s JOIN {name}_cut c ON s.company_id = c.company_id
  WHERE s.ds <= c.cut GROUP BY s.company_id, s.ds)"""


DAILY_CHURN = """
daily_churn AS (
  SELECT company_id, CAST(date_created AS DATE) AS ds, CAST(count(*) AS DOUBLE) AS y
  FROM sales_summary WHERE churn_label = 'churn' AND date_created IS NOT NULL
  GROUP BY company_id, CAST(date_created AS DATE))"""


def densify_sql(series: str, name: str) -> str:
    return f"""
{name}_span AS (SELECT company_id, min(ds) AS lo, max(ds) AS hi, avg(y) AS mean
                FROM {series} GROUP BY company_id),
{name}_cal AS (SELECT company_id, mean,
                      CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS ds
               FROM {name}_span),
{name} AS (SELECT c.company_id, c.ds, COALESCE(s.y, c.mean) AS y
           FROM {name}_cal c LEFT JOIN {series} s ON c.company_id = s.company_id AND c.ds = s.ds)"""


def future_sql(series: str, name: str, horizon: int = 90) -> str:
    return f"""
{name}_last AS (SELECT company_id, max(ds) AS hi FROM {series} GROUP BY company_id),
{name} AS (
  SELECT company_id, ds, y FROM {series}
  UNION ALL
  SELECT company_id, CAST(unnest(generate_series(hi + 1, hi + {horizon}, INTERVAL 1 DAY)) AS DATE),
         CAST(NULL AS DOUBLE)
  FROM {name}_last)"""


def features_sql(frame: str) -> str:
    from ..operators import forecast as FC
    hinges = ", ".join(
        f"greatest(t - {FC.CHANGEPOINT_RANGE * j / FC.N_CHANGEPOINTS!r}, 0.0) AS cp_{j}"
        for j in range(1, FC.N_CHANGEPOINTS + 1))
    trig = []
    for k in range(1, FC.WEEKLY_ORDER + 1):
        c = 2 * math.pi * k / 7.0
        for fn in ("sin", "cos"):
            trig.append(f"round_even({fn}(ed * {c!r}), 10) * won AS w_{fn}{k}")
    for k in range(1, FC.YEARLY_ORDER + 1):
        c = 2 * math.pi * k / 365.25
        for fn in ("sin", "cos"):
            trig.append(f"round_even({fn}(ed * {c!r}), 10) * yon AS y_{fn}{k}")
    return f"""
ff_span AS (SELECT company_id, min(ds) AS t0, max(ds) AS t1 FROM {frame}
            WHERE y IS NOT NULL GROUP BY company_id),
ff_t AS (
  SELECT f.company_id, f.ds, f.y,
         CASE WHEN date_diff('day', s.t0, s.t1) > 0
              THEN date_diff('day', s.t0, f.ds) / date_diff('day', s.t0, s.t1) ELSE 0.0 END AS t,
         CAST(date_diff('day', DATE '1970-01-01', f.ds) AS DOUBLE) AS ed,
         CAST(date_diff('day', s.t0, s.t1) + 1 >= {FC.WEEKLY_MIN_DAYS} AS DOUBLE) AS won,
         CAST(date_diff('day', s.t0, s.t1) + 1 >= {FC.YEARLY_MIN_DAYS} AS DOUBLE) AS yon
  FROM {frame} f JOIN ff_span s ON f.company_id = s.company_id),
features AS (SELECT company_id, ds, y, t, {hinges}, {", ".join(trig)} FROM ff_t)"""


def forecast_sql() -> str:
    """Ridge fit of ``features``: exact sums, elimination step by step, residual deviation."""
    from ..operators import forecast as FC
    n, unit = len(FC.PENALTY), float(FC.UNIT)
    xs = ", ".join(["CAST(1000000 AS BIGINT)", *(f"CAST(round_even({f} * {unit!r}, 0) AS BIGINT)" for f in FC.FEATURES)])
    sums = ", ".join(f"sum(x[i] * x[{j + 1}])" for j in range(n)) + ", sum(x[i] * z)"
    pen = "[" + ", ".join(repr(float(p)) for p in FC.PENALTY) + "]"

    def part(a, b):
        fold = f"list_reduce(list_prepend(0.0::DOUBLE, list_transform(range({a + 1}, {b + 1}), lambda k: coef[k] * x[k])), lambda p, q: p + q)"
        return f"{fold} / {unit!r} * scale"

    t, w = 2 + len(FC.HINGES), 2 + len(FC.HINGES) + len(FC.WEEKLY)
    return f"""
fc_s AS (SELECT company_id, CASE WHEN max(abs(y)) > 0 THEN max(abs(y)) ELSE 1.0 END AS scale
         FROM features WHERE y IS NOT NULL GROUP BY company_id),
fc_x AS MATERIALIZED (SELECT company_id, ds, y, scale, [{xs}] AS x, CAST(round_even(y / scale * {unit!r}, 0) AS BIGINT) AS z
         FROM features JOIN fc_s USING (company_id)),
fc_g AS MATERIALIZED (
  SELECT company_id, list(r ORDER BY i) AS m FROM (
    SELECT company_id, i, [{sums}] AS r FROM fc_x, range(1, {n + 1}) AS i(i) WHERE y IS NOT NULL GROUP BY company_id, i)
  GROUP BY company_id),
fc_e(company_id, k, m) AS (
  SELECT company_id, 1, list_transform(m, lambda r, i: list_transform(r, lambda v, j:
    CAST(v AS DOUBLE) + CASE WHEN i = j THEN ({pen})[i] * {unit * unit!r} ELSE 0.0 END)) FROM fc_g
  UNION ALL
  SELECT company_id, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN
      list_transform(r, lambda v, j: CASE WHEN m[k][k] > 0 THEN v / m[k][k] ELSE 0.0 END)
    ELSE list_transform(r, lambda v, j: v - r[k] * CASE WHEN m[k][k] > 0 THEN m[k][j] / m[k][k] ELSE 0.0 END) END)
  FROM fc_e WHERE k <= {n}),
fc_c AS MATERIALIZED (SELECT company_id, list_transform(m, lambda r: r[{n + 1}]) AS coef FROM fc_e WHERE k = {n + 1}),
fc_p AS MATERIALIZED (SELECT company_id, ds, y, scale, {part(0, t)} AS trend, {part(t, w)} AS weekly, {part(w, n)} AS yearly
         FROM fc_x JOIN fc_c USING (company_id)),
fc_h AS MATERIALIZED (SELECT *, weekly + yearly AS additive_terms, trend + (weekly + yearly) AS yhat FROM fc_p),
fc_r AS (SELECT company_id, count(*)::HUGEINT AS n, sum(e) AS s, sum(e * e) AS q FROM (
           SELECT company_id, CAST(round_even((y - yhat) / scale * {unit!r}, 0) AS HUGEINT) AS e FROM fc_h WHERE y IS NOT NULL)
         GROUP BY company_id),
fc_d AS (SELECT company_id, CASE WHEN n > 1 THEN sqrt(CAST(n * q - s * s AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE)) / {unit!r}
                            ELSE 0.0 END AS sd FROM fc_r),
forecast AS (SELECT company_id, ds, y, trend, weekly, yearly, additive_terms, yhat,
                    yhat - {FC.Z80!r} * sd * scale AS yhat_lower, yhat + {FC.Z80!r} * sd * scale AS yhat_upper
             FROM fc_h JOIN fc_d USING (company_id))"""


# -- vendors ------------------------------------------------------------------------------
VENDOR = f"""
v_items AS (
  SELECT company_id, item_description, COALESCE(sum({MU('price')}), 0) AS spend_u,
         count(vendor_name) AS no_of_vendors, count(po_no) AS no_of_pos
  FROM purchase_order WHERE item_description IS NOT NULL
  GROUP BY company_id, item_description),
v_share AS (
  SELECT *, CASE WHEN sum(spend_u) OVER (PARTITION BY company_id) <> 0 THEN round_even(100.0 * (
           (CAST(sum(spend_u) OVER (PARTITION BY company_id ORDER BY spend_u, item_description
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / 1000000.0)
           / (CAST(sum(spend_u) OVER (PARTITION BY company_id) AS DOUBLE) / 1000000.0)), 2) END
         AS cum_share
  FROM v_items),
v_class AS (
  SELECT *, CASE WHEN cum_share > 20 THEN 'Major Spend' ELSE 'Tail Spend' END AS spend_class
  FROM v_share),
vendor_spend_analysis AS (
  SELECT p.*,
         CASE WHEN p.contract_number IS NULL OR trim(p.contract_number) = ''
                   OR trim(p.contract_number) = '0'
              THEN 'Contract Not Available' ELSE 'Contract Available' END AS contract,
         CASE WHEN p.po_no IS NULL THEN 'PO Not Available' ELSE 'PO Available' END AS po,
         c.spend_class, c.no_of_vendors,
         CASE WHEN c.no_of_vendors = 1 THEN 'Single Vendor'
              WHEN c.no_of_vendors > 1 AND c.no_of_vendors <= 5 THEN 'Between 1 and 5'
              WHEN c.no_of_vendors > 5 THEN 'More than 5' END AS vendor_class,
         c.no_of_pos,
         CASE WHEN c.no_of_pos = 1 THEN 'Single PO'
              WHEN c.no_of_pos > 1 AND c.no_of_pos <= 12 THEN 'Between 1 and 12'
              WHEN c.no_of_pos > 12 THEN 'More than 12' END AS po_class
  FROM purchase_order p JOIN v_class c
    ON p.company_id = c.company_id AND p.item_description = c.item_description
  WHERE c.no_of_pos > 0),
vb AS (
  SELECT company_id, item_description, vendor_name, year,
         round_even({MS('unit_price')} / count(unit_price), 1) AS unit_price,
         round_even({MS('price')}, 1) AS price
  FROM vendor_spend_analysis
  WHERE contract = 'Contract Not Available' AND item_description IS NOT NULL
    AND vendor_name IS NOT NULL AND year IS NOT NULL
  GROUP BY company_id, item_description, vendor_name, year),
vband AS (
  SELECT company_id, item_description, min(unit_price) AS min_price, max(unit_price) AS max_price,
         count(unit_price) AS item_count, min(year) AS min_year
  FROM vb GROUP BY company_id, item_description),
price_book AS (
  SELECT b.*, CAST(1 AS BIGINT) AS disc_factor, b.unit_price * 1 AS adjusted_price,
         d.min_price, d.max_price, d.item_count, d.min_year
  FROM vb b JOIN vband d ON b.company_id = d.company_id AND b.item_description = d.item_description),
vr1 AS (
  SELECT *,
    CAST(CASE WHEN min_price > 0 THEN round_even(max_price / min_price * 100, 0) ELSE 0 END AS BIGINT) AS ppv,
    CAST(CASE WHEN min_price > 0 THEN round_even(adjusted_price / min_price * 100, 0) ELSE 0 END AS BIGINT)
      AS vendor_price_index
  FROM price_book),
deal_rows AS (
  SELECT * EXCLUDE (item_count),
    CASE WHEN year = min_year THEN '1st Year of Purchase for the item'
         ELSE CAST(year AS VARCHAR) END AS purchase_period,
    CAST(vendor_price_index = 100 AS BIGINT) AS best_quote_score,
    CASE WHEN vendor_price_index > 5000 THEN '> 50 times - Exclude' ELSE 'Include' END AS range_selection,
    CASE WHEN min_price > 0
         THEN round_even(price / unit_price * (adjusted_price - min_price), 1) ELSE 0.0 END AS extra_cost,
    row_number() OVER (PARTITION BY company_id ORDER BY item_count DESC, vendor_name DESC,
                       year DESC, item_description ASC) - 1 AS s_no
  FROM vr1),
item_rollup AS (
  SELECT company_id, item_description,
         {MS('min_price')} / count(min_price) AS avg_min_price_itm,
         {MS('unit_price')} / count(unit_price) AS avg_unit_price_itm,
         avg(vendor_price_index) AS avg_vendor_price_index_itm, avg(ppv) AS avg_ppv_itm,
         count(range_selection) AS cnt_range_itm, {MS('extra_cost')} AS tot_extra_cost_itm,
         {MS('price')} AS tot_price_itm
  FROM deal_rows WHERE range_selection = 'Include' GROUP BY company_id, item_description),
vendor_rollup AS (
  SELECT *, CAST(round_even(sum_score / cnt_range_vnd * 100, 0) AS BIGINT) AS good_score FROM (
    SELECT company_id, vendor_name,
           round_even({MS('min_price')} / count(min_price), 1) AS avg_min_price_vnd,
           round_even({MS('unit_price')} / count(unit_price), 1) AS avg_unit_price_vnd,
           round_even(avg(vendor_price_index), 0) AS avg_vendor_price_index_vnd,
           round_even(avg(ppv), 0) AS avg_ppv_vnd,
           CAST(sum(best_quote_score) AS DOUBLE) AS sum_score,
           count(range_selection) AS cnt_range_vnd,
           round_even({MS('extra_cost')}, 1) AS tot_extra_cost_vnd,
           round_even({MS('price')}, 1) AS tot_price_vnd
    FROM deal_rows WHERE range_selection = 'Include' GROUP BY company_id, vendor_name)),
vendor_deals AS (
  SELECT d.*, i.* EXCLUDE (company_id, item_description), v.* EXCLUDE (company_id, vendor_name)
  FROM deal_rows d
  JOIN item_rollup i ON d.company_id = i.company_id AND d.item_description = i.item_description
  JOIN vendor_rollup v ON d.company_id = v.company_id AND d.vendor_name = v.vendor_name)"""


def snapshot_sql(kind: str) -> str:
    """Target table loaded up to a share of each tenant's keys, and the delta above its watermark."""
    if kind == "order":
        src, key, cols = "raw_orders", "order_no", ORDER_COLS + ["price"]
    else:
        src, key, cols = "po_prepared", "po_no", PO_COLS + ["price", "year"]
    return f"""
{kind}_cut AS (
  SELECT company_id, CAST(floor(max({key}) * CASE company_id WHEN 'AUTOMOBILE' THEN 0.25::DOUBLE WHEN 'BUILDING' THEN 0.5
           WHEN 'FURNITURE' THEN 0.75 WHEN 'MACHINERY' THEN 1.0 END) AS BIGINT) AS cut
  FROM {src} GROUP BY company_id),
{kind}_target AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.company_id ORDER BY {order_by(['s.' + c for c in cols]).replace('"s.', 's."')}) - 1 AS "index"
  FROM {src} s JOIN {kind}_cut c ON s.company_id = c.company_id
  WHERE c.cut IS NOT NULL AND (s.{key} IS NULL OR s.{key} <= c.cut)),
{kind}_wm AS (SELECT company_id, max({key}) AS wm, max("index") + 1 AS next_index
              FROM {kind}_target GROUP BY company_id),
{kind}_delta AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.company_id ORDER BY {order_by(['s.' + c for c in cols]).replace('"s.', 's."')})
              - 1 + COALESCE(w.next_index, 0) AS "index"
  FROM {src} s LEFT JOIN {kind}_wm w ON s.company_id = w.company_id
  WHERE w.wm IS NULL OR s.{key} > w.wm),
{kind}_status AS (
  SELECT COALESCE(a.company_id, b.company_id) AS company_id,
         '{'recent_order' if kind == 'order' else 'recent_vendor'}' AS step,
         a.source_max, b.wm AS target_max, COALESCE(n.n_new, 0) AS n_new,
         CASE WHEN COALESCE(n.n_new, 0) > 0 THEN 'completed' ELSE 'no recent data' END AS status
  FROM (SELECT company_id, max({key}) AS source_max FROM {src} GROUP BY company_id) a
  FULL OUTER JOIN {kind}_wm b ON a.company_id = b.company_id
  LEFT JOIN (SELECT company_id, count(*) AS n_new FROM {kind}_delta GROUP BY company_id) n
    ON COALESCE(a.company_id, b.company_id) = n.company_id)"""


def day_sql(src: str, key: str, step: str) -> str:
    """Status rows of the second day's pull."""
    return f"""
{step}_cut AS (
  SELECT company_id, max({key}) AS source_max, CAST(floor(max({key}) * CASE company_id WHEN 'AUTOMOBILE' THEN 0.25::DOUBLE
           WHEN 'BUILDING' THEN 0.5 WHEN 'FURNITURE' THEN 0.75 WHEN 'MACHINERY' THEN 1.0 END) AS BIGINT) AS cut
  FROM {src} GROUP BY company_id),
{step} AS (
  SELECT company_id, '{step}' AS step, max(source_max) AS source_max, max({key}) FILTER ({key} <= cut) AS target_max,
         count(*) FILTER (cut IS NULL OR {key} > cut) AS n_new,
         CASE WHEN count(*) FILTER (cut IS NULL OR {key} > cut) > 0 THEN 'completed' ELSE 'no recent data' END AS status,
         count(*) FILTER (cut IS NULL OR {key} > cut) > 0 AS refreshed
  FROM {src} JOIN {step}_cut USING (company_id) GROUP BY company_id)"""


def build() -> dict[str, str]:
    from ..operators.forecast import PENALTY
    from .catalog import COHORT_RUN_DAY, COHORT_SCAN_DAYS, FORECAST_DIGITS, HISTORY_CUTOFF, TRAILING_DAYS, Z_DIGITS
    import datetime as dt

    O, P, SL = order_tables(), purchase_tables(), sales_from()
    SS = [O, SL, SUMMARY]
    q: dict[str, str] = {}
    # sources and loading
    q["schema_conform"] = with_(O) + f""" SELECT *, row_number() OVER (PARTITION BY company_id
        ORDER BY {order_by(ORDER_COLS + ['price'])}) - 1 AS "index" FROM raw_orders"""
    # every job for all tenants at once
    OM, PM = order_tables(True), purchase_tables(True)
    q["tenant_sales_summary"] = (with_(OM, SL, SUMMARY) +
                                 f" SELECT {publish_cols(SALES_COLS + SUMMARY_EXTRA, SUMMARY_DATES)} FROM sales_summary")
    q["tenant_rfm_segments"] = (with_(OM, SL, SUMMARY, rfm_base_sql(), RFM_SCORES, segment_case(), RFM_TABLE)
                                + f" SELECT {publish_cols(RFM_COLS, {'min_c', 'max_c'})} FROM rfm")
    q["tenant_cohort_year"] = with_(OM, SL, cohort_sql(12), cohort_counts_sql(12)) + " SELECT * FROM cohort_counts"
    q["tenant_vendor_deals"] = with_(PM, VENDOR) + " SELECT * FROM vendor_deals"
    q["order_extract"] = with_(O) + " SELECT * FROM order_extract"
    q["purchase_extract"] = with_(P) + """ SELECT *, unit_price * qty_ordered AS price,
        CAST(year(date_created) AS INTEGER) AS year FROM purchase_extract"""
    q["history_cutoff"] = with_(O) + f" SELECT * FROM raw_orders WHERE date_created >= TIMESTAMP '{HISTORY_CUTOFF}'"
    q["surrogate_index"] = with_(O) + f""" SELECT *, row_number() OVER (PARTITION BY company_id
        ORDER BY {order_by(ORDER_COLS + ['price'])}) - 1 AS "index"
        FROM raw_orders WHERE date_created >= TIMESTAMP '{HISTORY_CUTOFF}'"""
    q["incremental_orders"] = with_(OM, snapshot_sql("order")) + " SELECT * FROM order_delta"
    q["incremental_pos"] = with_(PM, snapshot_sql("po")) + (
        " SELECT * REPLACE (CAST(po_no AS DOUBLE) AS po_no) FROM po_delta")
    q["ingest_status"] = (with_(OM, PM, snapshot_sql("order"), snapshot_sql("po"))
                          + " SELECT * REPLACE (CAST(target_max AS DOUBLE) AS target_max)"
                            " FROM (SELECT * FROM order_status UNION ALL SELECT * FROM po_status)")
    q["incremental_completeness"] = (with_(OM, PM, snapshot_sql("order"), snapshot_sql("po")) + " " + " UNION ALL ".join(
        f"SELECT company_id, '{step}' AS step, '{part}' AS part, count(*) AS lines FROM {src} GROUP BY company_id"
        for step, kind, full in (("recent_order", "order", "raw_orders"), ("recent_vendor", "po", "po_prepared"))
        for part, src in (("source", full), ("target", f"{kind}_target"), ("delta", f"{kind}_delta"))))
    # the daily run: after two days the warehouse is that of a full build
    q["daily_run_summary"] = q["tenant_sales_summary"]
    two = [OM, PM, day_sql("raw_orders", "order_no", "recent_order"), day_sql("po_plain", "po_no", "recent_vendor")]
    two[1] += ", po_plain AS (SELECT *, unit_price * qty_ordered AS price, CAST(year(date_created) AS INTEGER) AS year FROM purchase_extract)"
    q["daily_run_status"] = with_(*two) + " SELECT * REPLACE (CAST(target_max AS DOUBLE) AS target_max) FROM (SELECT * FROM recent_order UNION ALL SELECT * FROM recent_vendor)"
    q["daily_run_files"] = with_(*two) + f""" SELECT t."table", s.company_id,
        CASE WHEN s.target_max IS NULL THEN 'new' WHEN s.n_new > 0 THEN 'rebuilt' ELSE 'kept' END AS files
        FROM (SELECT * FROM recent_order UNION ALL SELECT * FROM recent_vendor) s
        JOIN (VALUES ('recent_order', 'sales'), ('recent_order', 'sales_summary'), ('recent_order', 'gap_churn'),
                     ('recent_vendor', 'vendor_spend_analysis'), ('recent_vendor', 'vendor_deals')) t(step, "table") USING (step)"""
    plain = PM.replace("CASE WHEN po_no % 50 = 0 THEN NULL ELSE po_no END AS po_no", "po_no AS po_no")
    # keys are appended in their order, so line numbers are those of one load
    q["daily_run_items"] = with_(plain, VENDOR) + f""" SELECT company_id, item_description, count("index") AS lines,
        max("index") AS last_index, {MS('price')} AS spend, max(spend_class) AS spend_class, max(no_of_pos) AS no_of_pos
        FROM vendor_spend_analysis GROUP BY company_id, item_description"""
    q["append_with_key"] = with_(OM, snapshot_sql("order")) + """ SELECT * FROM order_delta d
        WHERE d."index" IS NOT NULL AND NOT EXISTS (
          SELECT 1 FROM order_target t WHERE t.company_id = d.company_id AND t."index" = d."index")"""
    q["append_null_keys"] = with_(P) + f""" SELECT * REPLACE (CAST(po_no AS DOUBLE) AS po_no) FROM po_prepared WHERE po_no IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY company_id, po_no ORDER BY {order_by(PO_COLS + ['price', 'year'])}) = 1"""
    q["blank_columns"] = with_(O) + " SELECT company_id, order_no, ship2_name AS nocolname FROM oe_hdr"
    q["text_dates"] = with_(O) + """, d AS (SELECT company_id, order_no, CASE WHEN order_no % 7 = 0 THEN 'None'
        WHEN order_no % 11 = 0 THEN strftime(date_created, '%Y-%m-%d')[:6] WHEN order_no % 13 <> 0 THEN strftime(date_created, '%Y-%m-%d')
        END AS date_created FROM oe_hdr)
        SELECT *, 'sentinel' AS step FROM d WHERE date_created IS DISTINCT FROM 'None'
        UNION ALL SELECT *, 'valid' FROM d WHERE date_created <> 'None' AND length(date_created) >= 7"""
    q["dedupe_columns"] = with_(O) + " SELECT l.*, h.* EXCLUDE (order_no) FROM oe_line l JOIN oe_hdr h ON l.order_no = h.order_no"
    # sales
    q["sales_clean"] = with_(O, SL) + f" SELECT {SALES_OUT} FROM sales"
    q["sales_replay_dedupe"] = (with_(O, "raw_twice AS (SELECT * FROM raw_orders UNION ALL SELECT * FROM raw_orders)",
                                      sales_from("raw_twice")) + f" SELECT {SALES_OUT} FROM sales")
    q["tenant_sales"] = with_(order_tables(True), SL) + f" SELECT {SALES_OUT} FROM sales"
    cal = f"SELECT event_id, ts, {calendar_sql('ts')} FROM events"
    q["sales_dateparts"] = f"""SELECT event_id, ts, year, month, week, day, dayofweek, dayofyear,
        {D('just_date')}, year_month, month_abbr, day_abbr, hour, quater FROM ({cal})"""
    q["sales_session"] = f"SELECT event_id, ts, hour, session FROM ({cal})"
    # summary and churn
    summary_cols = SALES_COLS + SUMMARY_EXTRA
    q["sales_summary"] = with_(*SS) + f" SELECT {publish_cols(summary_cols, SUMMARY_DATES)} FROM sales_summary"
    q["winback"] = with_(*SS) + """ SELECT company_id, win_back, freq_pur, count(*) AS "rows",
        count(DISTINCT email) AS customers FROM sales_summary GROUP BY company_id, win_back, freq_pur"""
    sparse = """raw_sparse AS (SELECT * REPLACE (ship2_email_address || '#' || CAST(order_no % 29 AS VARCHAR) AS ship2_email_address)
        FROM raw_orders)"""
    q["sparse_labels"] = with_(O, sparse, sales_from("raw_sparse"), SUMMARY) + """ SELECT company_id, freq_pur, repeat_customer,
        win_back, churn_label, count(*) AS "rows", count(DISTINCT email) AS customers FROM sales_summary GROUP BY ALL"""
    q["churn_labels"] = with_(*SS) + f""" SELECT DISTINCT company_id, email,
        {publish_cols(['min_c', 'max_c', 'len', 'diff', 'avg_day', 'avg_metric', 'recent_order', 'churn_label'], {'min_c', 'max_c'})}
        FROM sales_summary"""
    q["repeat_customers"] = with_(*SS) + """ SELECT company_id, freq_pur, repeat_customer,
        count(*) AS customers FROM (SELECT DISTINCT company_id, email, freq_pur, repeat_customer
        FROM sales_summary) GROUP BY company_id, freq_pur, repeat_customer"""
    q["gap_churn"] = with_(O, SL, GAP_CHURN) + f""" SELECT company_id, {D('just_date')}, email,
        "count", recent_order, avg_days_order, avg_rate, churn_label,
        arg_max(churn_label, just_date) OVER (PARTITION BY company_id, email) AS churn_label_latest
        FROM g3"""
    # RFM
    RB = [O, SL, rfm_base_sql()]
    q["rfm_base"] = with_(*RB) + " SELECT * FROM rfm_base"
    q["rfm_scaled"] = with_(*RB, RFM_SCALED) + f""" SELECT company_id, email,
        round_even(recency_z, {Z_DIGITS}) AS recency_z, round_even(frequency_z, {Z_DIGITS}) AS frequency_z,
        round_even(monetary_z, {Z_DIGITS}) AS monetary_z FROM rfm_scaled"""
    for name, tables in (("rfm_clusters", O), ("tenant_rfm_clusters", OM)):
        q[name] = (with_(tables, SL, rfm_base_sql(), RFM_SCALED, clusters_sql()).replace("WITH ", "WITH RECURSIVE ", 1)
                   + " SELECT company_id, email, cluster, converged AS cluster_converged FROM km")
    q["rfm_scores"] = with_(*RB, RFM_SCORES) + f" SELECT {', '.join(RFM_SCORE_COLS)} FROM rfm_scores"
    rfm_full = [O, SL, SUMMARY, rfm_base_sql(), RFM_SCORES, segment_case(), RFM_TABLE]
    q["rfm_segments"] = with_(*rfm_full) + f" SELECT {publish_cols(RFM_COLS, {'min_c', 'max_c'})} FROM rfm"
    rfm_one = [O, SL, SUMMARY, rfm_base_sql(TRAILING_DAYS), RFM_SCORES, segment_case(), RFM_TABLE]
    q["rfm_one"] = with_(*rfm_one) + f" SELECT {publish_cols(RFM_COLS, {'min_c', 'max_c'})} FROM rfm"
    q["rfm_quadrants"] = (with_(*RB, RFM_SCORES, segment_case())
                          + f""" SELECT company_id, quad_segment, count(*) AS customers,
        {MS('monetary')} AS monetary FROM rfm_labeled GROUP BY company_id, quad_segment""")
    q["cardinality_check"] = with_(*rfm_full) + """ SELECT company_id, email, count(*) AS n_rows
        FROM rfm GROUP BY company_id, email HAVING count(*) > 1"""
    q["cardinality_broken"] = with_(*rfm_full) + """ SELECT company_id, email,
        CASE WHEN regexp_matches(email, '^c[0-9]*33@') THEN 3 ELSE 2 END::BIGINT AS n_rows
        FROM rfm WHERE regexp_matches(email, '^c[0-9]*3@')"""
    summ_cols = ["company_id", "email", "cust_segment", "quad_segment"] + [
        c for c in summary_cols if c not in ("company_id", "email")]
    q["summ_rfm"] = with_(*rfm_full) + f""" SELECT {publish_cols(summ_cols, SUMMARY_DATES)}
        FROM (SELECT COALESCE(s.company_id, r.company_id) AS company_id,
                     COALESCE(s.email, r.email) AS email, r.cust_segment, r.quad_segment,
                     s.* EXCLUDE (company_id, email)
              FROM (SELECT company_id, email, cust_segment, quad_segment FROM rfm) r
              FULL OUTER JOIN sales_summary s ON r.company_id = s.company_id AND r.email = s.email)"""
    # cohorts
    q["cohort_half_data"] = with_(O, SL, cohort_sql(6)) + " SELECT * FROM cohort_data"
    q["cohort_half"] = with_(O, SL, cohort_sql(6), cohort_counts_sql(6)) + " SELECT * FROM cohort_counts"
    q["cohort_year"] = with_(O, SL, cohort_sql(12), cohort_counts_sql(12)) + " SELECT * FROM cohort_counts"
    q["retention_half"] = with_(O, SL, cohort_sql(6), cohort_counts_sql(6)) + " " + retention_select(6)
    q["retention_year"] = with_(O, SL, cohort_sql(12), cohort_counts_sql(12)) + " " + retention_select(12)
    q["cohort_avg_sales"] = with_(O, SL, cohort_sql(6)) + f""" SELECT company_id, cohortmonth,
        round_even({MS('average_sales')}, 2) AS average_sales FROM cohort_data
        GROUP BY company_id, cohortmonth"""
    end = dt.date.fromisoformat(COHORT_RUN_DAY)
    start = (end - dt.timedelta(days=COHORT_SCAN_DAYS)).isoformat()
    q["cohort_year_scan"] = (with_(O, SL, cohort_sql(12, start, COHORT_RUN_DAY), cohort_counts_sql(12))
                             + " SELECT * FROM cohort_counts")
    # series
    DS = full_month_series("sales", f"COALESCE({MS('s.total')}, 0.0)", "daily_sales")
    DO = full_month_series("sales_summary", "CAST(count(s.order_id) AS DOUBLE)", "daily_orders")
    q["daily_sales"] = with_(O, SL, DS) + f" SELECT company_id, {D('ds')}, y FROM daily_sales"
    q["warehouse_roundtrip"] = with_(OM, SL, DS) + f""" SELECT lpad(CAST(ascii(company_id) AS VARCHAR), 4, '0') AS company_id,
        {D('ds')}, {MS('y')} AS y FROM daily_sales WHERE ascii(company_id) <> 77 GROUP BY ALL"""
    q["daily_orders"] = with_(*SS, DO) + f" SELECT company_id, {D('ds')}, y FROM daily_orders"
    q["daily_churn"] = with_(*SS, DAILY_CHURN) + f" SELECT company_id, {D('ds')}, y FROM daily_churn"
    q["densify_orders"] = (with_(*SS, DO, densify_sql("daily_orders", "dense"))
                           + f" SELECT company_id, {D('ds')}, y FROM dense")
    q["densify_churn"] = (with_(*SS, DAILY_CHURN, densify_sql("daily_churn", "dense"))
                          + f" SELECT company_id, {D('ds')}, y FROM dense")
    q["future_frame"] = (with_(*SS, DO, densify_sql("daily_orders", "dense"), future_sql("dense", "fut"))
                         + f" SELECT company_id, {D('ds')}, y FROM fut")
    q["forecast_features"] = (with_(*SS, DO, densify_sql("daily_orders", "dense"),
                                    future_sql("dense", "fut"), features_sql("fut"))
                              + f" SELECT * REPLACE ({D('ds')}) FROM features")
    digits = ", ".join(f"round_even({c}, {FORECAST_DIGITS}) AS {c}" for c in (
        "y", "trend", "weekly", "yearly", "additive_terms", "yhat", "yhat_lower", "yhat_upper"))
    churn = [*SS, DAILY_CHURN, densify_sql("daily_churn", "dense"), future_sql("dense", "fut")]
    orders = [DO, densify_sql("daily_orders", "dense"), future_sql("dense", "fut")]
    for name, ctes in (("sales_forecast", [O, SL, DS, future_sql("daily_sales", "fut")]), ("churn_forecast", churn),
                       ("order_forecast", [*SS, *orders]), ("tenant_order_forecast", [OM, SL, SUMMARY, *orders])):
        body = with_(*ctes, features_sql("fut"), forecast_sql()).replace("WITH ", "WITH RECURSIVE ", 1)
        q[name] = body + f" SELECT company_id, {D('ds')}, {digits} FROM forecast"
    gram = forecast_sql().split(",\nfc_e(")[0]
    q["forecast_gram"] = (with_(*SS, *orders, features_sql("fut"), gram)
                          + " SELECT company_id, i - 1 AS i, j - 1 AS j, CAST(m[i][j] AS BIGINT) AS total"
                            f" FROM fc_g, range(1, {len(PENALTY) + 1}) AS a(i), range(1, {len(PENALTY) + 2}) AS b(j)")
    # vendors
    VV = [P, VENDOR]
    q["vendor_item_spend"] = with_(*VV) + """ SELECT company_id, item_description,
        CAST(spend_u AS DOUBLE) / 1000000.0 AS spend, cum_share, spend_class FROM v_class"""
    q["vendor_flags"] = with_(*VV) + """ SELECT company_id, "index", contract_number,
        CAST(po_no AS DOUBLE) AS po_no,
        CASE WHEN contract_number IS NULL OR trim(contract_number) = '' OR trim(contract_number) = '0'
             THEN 'Contract Not Available' ELSE 'Contract Available' END AS contract,
        CASE WHEN po_no IS NULL THEN 'PO Not Available' ELSE 'PO Available' END AS po
        FROM purchase_order"""
    q["vendor_classes"] = with_(*VV) + """ SELECT DISTINCT company_id, item_description,
        no_of_vendors, vendor_class, no_of_pos, po_class FROM vendor_spend_analysis"""
    q["vendor_spend_analysis"] = (with_(*VV) + " SELECT * REPLACE (CAST(po_no AS DOUBLE) AS po_no)"
                                  " FROM vendor_spend_analysis")
    po_sparse = """po_sparse AS (SELECT * REPLACE (
        item_description || ' #' || CAST(CASE WHEN dayofyear(date_created) % 3 = 0 THEN dayofyear(date_created) ELSE 0 END AS VARCHAR) AS item_description,
        CASE WHEN dayofyear(date_created) % 5 = 0 THEN ' 0 ' ELSE contract_number END AS contract_number) FROM purchase_order)"""
    q["sparse_vendor_classes"] = with_(P, po_sparse, VENDOR.replace("purchase_order", "po_sparse")) + """ SELECT company_id, vendor_class,
        po_class, contract, po, spend_class, count(*) AS lines, count(DISTINCT item_description) AS items
        FROM vendor_spend_analysis GROUP BY ALL"""
    q["vendor_price_book"] = with_(*VV) + " SELECT * FROM price_book"
    q["vendor_deal_rows"] = with_(*VV) + " SELECT * FROM deal_rows"
    q["vendor_item_rollup"] = with_(*VV) + " SELECT * FROM item_rollup"
    q["vendor_vendor_rollup"] = with_(*VV) + " SELECT * FROM vendor_rollup"
    q["vendor_deals"] = with_(*VV) + " SELECT * FROM vendor_deals"
    return q
