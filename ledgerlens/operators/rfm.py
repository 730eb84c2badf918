"""RFM segmentation (R1-R17) and the summary x segment join.

Grain: one row per (company_id, email). Quartile scores follow pandas
``qcut``: recency on interpolated quartiles, frequency and monetary on
first-seen ranks (ties broken by email ascending).
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import order_count_label, quadrant_of, reverse_score, segment_of
from ..functions.rounding import half_even, money_sum
from ..session import TENANT, materialize, per_tenant, settings
from .selection import rows_at_ranks

LOGS = ["recency_log", "frequency_log", "monetary_log"]
SCALED = ["recency_z", "frequency_z", "monetary_z"]
LOG_DIGITS = 10


def rfm_base(sales: DataFrame, trailing_days: int | None = None, last_day: DataFrame | None = None) -> DataFrame:
    """R1-R6 (+ R2 with ``trailing_days``): recency, frequency, monetary, logs.

    ``last_day`` (company_id, last_day) where it is known already.
    """
    df = sales.select(TENANT, "customer_id", "email", "just_date", "order_id", "total")
    if trailing_days is not None:                                     # R2
        if last_day is None:
            last_day = df.groupBy(TENANT).agg(F.max("just_date").alias("last_day"))
        last = last_day.select(TENANT, F.col("last_day").alias("_ll_max"))
        df = (df.join(per_tenant(last), TENANT)
              .filter(F.col("just_date") >= F.date_sub("_ll_max", trailing_days))
              .drop("_ll_max"))
    df = df.filter(F.col("customer_id").isNotNull() & F.col("order_id").isNotNull()
                   & F.col("email").isNotNull())                      # R1
    # one row per customer, written once: the reference date and every later
    # step (scaling, quartiles, ranks, k-means) read it instead of the lines
    per = materialize(df.groupBy(TENANT, "email").agg(                # R4
        F.max("just_date").alias("_ll_last"),
        F.count("order_id").alias("frequency"),
        money_sum("total").alias("monetary")))
    ref = per.groupBy(TENANT).agg(F.date_add(F.max("_ll_last"), 1).alias("_ll_ref"))  # R3
    per = (per.join(per_tenant(ref), TENANT)
           .withColumn("recency", F.datediff("_ll_ref", "_ll_last").cast("bigint"))
           .drop("_ll_ref", "_ll_last"))
    per = per.filter(F.col("monetary") != 0)                          # R5
    per = per.filter(F.col("monetary") > 0)                           # R6: log undefined below 0
    # logs are rounded to 10 places: engines differ in the last bit of ln()
    return per.select(
        TENANT, "email", "recency", "frequency", "monetary",
        half_even(F.ln("frequency"), LOG_DIGITS).alias("frequency_log"),
        half_even(F.ln("monetary"), LOG_DIGITS).alias("monetary_log"),
        half_even(F.ln("recency"), LOG_DIGITS).alias("recency_log"))


def rfm_scaled(base: DataFrame) -> DataFrame:
    """Z-scores of the three logs with the population std (zero std -> 1)."""
    stats = base.groupBy(TENANT).agg(
        *[F.avg(c).alias(f"_ll_mu_{c}") for c in LOGS],
        *[F.stddev_pop(c).alias(f"_ll_sd_{c}") for c in LOGS])
    out = base.join(per_tenant(stats), TENANT)
    for c, z in zip(LOGS, SCALED):
        sd = F.col(f"_ll_sd_{c}")
        out = out.withColumn(z, (F.col(c) - F.col(f"_ll_mu_{c}"))
                             / F.when(sd == 0, F.lit(1.0)).otherwise(sd))
    return out.drop(*[f"_ll_mu_{c}" for c in LOGS], *[f"_ll_sd_{c}" for c in LOGS])


def _edges(base: DataFrame, sizes: DataFrame, value: str) -> DataFrame:
    """``(company_id, edges)``: the last (value, email) of the first three rank quarters.

    pandas ``qcut`` on ranks 1..n has its edges at ``1 + k(n-1)/4``; the last rank not
    above edge k is ``1 + floor(k(n-1)/4)``. (``ntile(4)`` is a different rule.)
    """
    wanted = sizes.select(TENANT, "_ll_n", F.explode(F.lit([1, 2, 3])).alias("_ll_k")).select(
        TENANT, "_ll_n", "_ll_k", F.expr("1 + _ll_k * (_ll_n - 1) div 4").alias("_ll_rank"))
    found = rows_at_ranks(base, value, "email", wanted)
    return found.groupBy(TENANT).agg(F.array_sort(F.collect_list(F.struct("_ll_k", value, "email"))).alias("edges"))


def _rank_bin(value: str, edges: str) -> F.Column:
    """Quarter 1-4 of a row's rank by (value, email): edges it lies behind, plus one."""
    own = F.struct(value, "email")
    return reduce(lambda n, k: n + (own > F.struct(F.col(edges)[k][value], F.col(edges)[k]["email"])).cast("int"),
                  range(3), F.lit(1))


def rfm_scores(base: DataFrame) -> DataFrame:
    """R, F, M quartile scores (1 = best) and the RFM code."""
    # exact percentile keeps a count per distinct value and merges partial
    # maps: recency is a whole number of days, so a tenant's state is bounded
    # by the length of its history, not by its number of customers
    q = base.groupBy(TENANT).agg(
        F.percentile("recency", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("_ll_q"),
        F.count(F.lit(1)).alias("_ll_n"))
    sizes = materialize(q)
    for value in ("frequency", "monetary"):  # the edges are three rows a tenant
        sizes = sizes.join(_edges(base, sizes.select(TENANT, "_ll_n"), value).withColumnRenamed("edges", f"_ll_{value}"), TENANT)
    df = base.join(per_tenant(materialize(sizes)), TENANT)
    rec = F.col("recency")
    r_bin = (F.when(rec <= F.col("_ll_q")[0], 1).when(rec <= F.col("_ll_q")[1], 2)
             .when(rec <= F.col("_ll_q")[2], 3).otherwise(4))
    df = df.withColumns({
        "r": r_bin.cast("int"),                           # labels [4,3,2,1] then reversed
        "f": reverse_score(_rank_bin("frequency", "_ll_frequency")),
        "m": reverse_score(_rank_bin("monetary", "_ll_monetary")),
    })
    df = df.withColumns({
        "rfm": F.concat(F.col("r").cast("string"), F.col("f").cast("string"),
                        F.col("m").cast("string")),
        "s_rfm": F.col("r") + F.col("f") + F.col("m"),
    }).withColumn("rfm_int", F.col("rfm").cast("int"))
    return df.drop("_ll_q", "_ll_n", "_ll_frequency", "_ll_monetary")


def customer_span(summary: DataFrame) -> DataFrame:
    """First/last purchase day per email from ``sales_summary`` (deduplicated)."""
    return summary.groupBy(TENANT, "email").agg(
        F.min("min_c").alias("min_c"), F.max("max_c").alias("max_c"))


def rfm_segments(scores: DataFrame, summary: DataFrame) -> DataFrame:
    """Segment, quadrant, order label, average order value, span."""
    df = scores.withColumns({
        "cust_segment": segment_of("rfm_int"),
        "quad_segment": quadrant_of(segment_of("rfm_int")),
        "f_label": order_count_label("frequency"),
        "avg_order_value": F.col("monetary") / F.col("frequency"),
    })
    # The reference merges, then keeps one row per email; deduplicating
    # the right side first gives the same rows without the fan-out.
    return df.join(customer_span(summary), [TENANT, "email"], "inner")


RFM_COLUMNS = [TENANT, "email", "recency", "frequency", "monetary", "frequency_log",
               "monetary_log", "recency_log", "r", "f", "m", "rfm", "s_rfm", "rfm_int",
               "cust_segment", "quad_segment", "f_label", "avg_order_value", "min_c", "max_c"]


KMEANS_ROUNDS = 300       # the one limit on k-means rounds, at every tenant size
# a round shuffles four rows per task and tenant: nothing to re-plan
ROUND_SETTINGS = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "4"}
KMEANS_UNIT = 1e8         # z-scores enter k-means as whole hundred-millionths
# start centres (recency, frequency, monetary) in z units, from the most to
# the least active customers
KMEANS_START = [(-1.2, 1.2, 1.2), (-0.4, 0.4, 0.4), (0.4, -0.4, -0.4), (1.2, -1.2, -1.2)]

_Q = ["_ll_q0", "_ll_q1", "_ll_q2"]
_K = len(KMEANS_START)


def _centres(centres: dict[int, list[float]]) -> str:
    """The centres of all tenants as one literal array: rounds differ in a constant
    only, not in plan or generated code."""
    flat = [0.0] * (3 * _K * (max(centres, default=0) + 1))
    for t, c in centres.items():
        flat[3 * _K * t:3 * _K * (t + 1)] = c
    return "array(" + ", ".join(f"{x!r}D" for x in flat) + ")"


def _nearest(held: str) -> str:
    """Number of the nearest of the tenant's centres in ``held`` (the lowest of
    equally near ones)."""
    def dist(j: int) -> str:
        gaps = (f"({q} - get({held}, _ll_t * {3 * _K} + {3 * j + f}))" for f, q in enumerate(_Q))
        return " + ".join(f"{g} * {g}" for g in gaps)

    # the smallest (distance, number) pair
    return "least(" + ", ".join(f"struct({dist(j)} AS d, {j} AS k)" for j in range(_K)) + ").k"


def rfm_clusters(scaled: DataFrame, rounds: int = KMEANS_ROUNDS) -> DataFrame:
    """K-means (k=4) on the standardised logs, for all tenants at once.

    Lloyd's algorithm from fixed start centres, until no centre of the tenant moves
    or for ``rounds``; ``cluster_converged`` says which. A round is one aggregation:
    every customer is assigned by an expression against its tenant's four centres, and
    the sums (exact, over whole numbers) and counts are combined map-side into one row
    per tenant and cluster. Those rows are all the driver sees. Points are written by
    tenant, so a tenant that is finished is not read any more. An empty cluster keeps
    its centre.
    """
    spark = scaled.sparkSession
    tenants = sorted((r[0] for r in scaled.select(TENANT).distinct().collect()), key=lambda t: (t is not None, t))
    if not tenants:
        return scaled.withColumns({"cluster": F.lit(None).cast("int"), "cluster_converged": F.lit(True)})
    number = {t: k for k, t in enumerate(tenants)}
    kind = dict(scaled.dtypes)[TENANT]
    numbers = spark.createDataFrame(list(number.items()), f"_ll_own {kind}, _ll_t int")
    named = scaled.join(per_tenant(numbers), F.col(TENANT).eqNullSafe(F.col("_ll_own"))).drop("_ll_own")
    points = materialize(named.withColumns({
        q: F.floor(F.col(z) * KMEANS_UNIT + 0.5).cast("double") for q, z in zip(_Q, SCALED)}), by="_ll_t")
    start = [x * KMEANS_UNIT for c in KMEANS_START for x in c]
    centres = {t: list(start) for t in number.values()}
    active = set(centres)
    view = f"_ll_points_{uuid.uuid4().hex}"
    points.createTempView(view)
    sums = ", ".join(f"sum(CAST({q} AS bigint)) AS {q}" for q in _Q)
    for _ in range(rounds):
        if not active:
            break
        new = {t: list(centres[t]) for t in active}
        with settings(spark, ROUND_SETTINGS):
            found = spark.sql(
                f"SELECT _ll_t, {_nearest('_ll_c')} AS k, count(*) AS n, {sums} FROM (SELECT *, {_centres(centres)} AS _ll_c FROM {view}"
                f" WHERE _ll_t IN ({', '.join(map(str, sorted(active)))})) GROUP BY 1, 2").collect()
        for r in found:
            new[r["_ll_t"]][3 * r["k"]:3 * r["k"] + 3] = [float(r[q]) / r["n"] for q in _Q]
        active = {t for t in active if new[t] != centres[t]}
        centres |= new
    spark.catalog.dropTempView(view)
    return (points.withColumn("cluster", F.expr(_nearest(_centres(centres))).cast("int"))
            .withColumn("cluster_converged", ~F.col("_ll_t").isin(sorted(active)) if active else F.lit(True))
            .drop(*_Q, "_ll_t"))


def rfm_table(sales: DataFrame, summary: DataFrame, trailing_days: int | None = None,
              clusters: bool = True, last_day: DataFrame | None = None) -> DataFrame:
    """The published ``rfm`` (or ``rfm_one`` with ``trailing_days=365``) table."""
    base = rfm_base(sales, trailing_days, last_day)
    cols = list(RFM_COLUMNS)
    if clusters:
        base = rfm_clusters(rfm_scaled(base)).drop(*SCALED)
        cols[8:8] = ["cluster", "cluster_converged"]
    return rfm_segments(rfm_scores(base), summary).select(*cols)


def cardinality_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once (empty when ``one_to_many`` holds)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def one_row_each(df: DataFrame, keys: list[str]) -> DataFrame:
    """R17 inside the plan: ``df``, or an error when a key occurs more than once.

    The count is part of one aggregation on the keys, which a join on them can reuse.
    """
    rest = [c for c in df.columns if c not in keys]
    one = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_ll_n"), *(F.any_value(c).alias(c) for c in rest))
    name = F.concat_ws(", ", *(F.col(k).cast("string") for k in keys))
    message = F.concat(F.lit("merge keys are not unique: "), name)
    # the check stands in a column that is kept, so no pruning removes it
    first = F.when(F.col("_ll_n") > 1, F.raise_error(message).cast(df.schema[keys[-1]].dataType)).otherwise(F.col(keys[-1]))
    return one.withColumn(keys[-1], first).select(*df.columns)


def summary_with_segments(rfm: DataFrame, summary: DataFrame) -> DataFrame:
    """``rfm(email, segments)`` full outer join ``sales_summary`` on email.

    Every rfm email comes from the summary, so the full outer join is a left
    join from the (large, possibly skewed) summary plus the rfm rows without
    a summary row. A left join lets AQE split hot emails, which a full outer
    join cannot. The segments of a partition (a row a customer) are hashed, so
    the summary's wide rows need no sort.
    """
    seg = one_row_each(rfm.select(TENANT, "email", "cust_segment", "quad_segment"), [TENANT, "email"])
    left = summary.join(seg.hint("shuffle_hash"), [TENANT, "email"], "left")
    emails = summary.select(TENANT, "email").distinct()
    orphans = seg.join(emails, [TENANT, "email"], "left_anti")
    return left.unionByName(orphans, allowMissingColumns=True).select(
        TENANT, "email", "cust_segment", "quad_segment",
        *[c for c in summary.columns if c not in (TENANT, "email")])
