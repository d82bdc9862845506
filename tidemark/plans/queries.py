"""The library's operators bound to the driver's star tables, each with the same query in SQL.

Roles: events are payments or alerts (user = account, event type = kind or
outcome), orders are cases (status F closed, O open, P pending), line items
are tasks and supplier-to-part edges, nations are tenants, documents are
evidence. Dates and timestamps are returned as text and doubles rounded, so
that engines can be compared by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import nested, times
from tidemark.operators import aggregates, columns, joins, quality, windows
from tidemark.plans import calibration, documents, evidence, metrics, views
from tidemark.plans.service import QueryService
from tidemark.sources import readers
from tidemark.sources.tables import SnapshotTable, TableSpec
from tidemark.sources.written import new_folder
from tidemark.streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return readers.parquet(spark, f"{sf_dir}/{name}.parquet")


def text(c: str | Column) -> Column:
    """A timestamp as ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, removed when the driver's JVM ends."""
    return new_folder(spark, name)


def r4(c: str | Column) -> Column:
    return F.round(c, 4)


def r8(c: str | Column) -> Column:
    """For means of amounts: at four places they could be ties, which engines round either way."""
    return F.round(c, 8)


# ------------------------------------------------------------------ scans, projections, filters


@query("SELECT o_orderkey, o_custkey, n_name AS tenant_id, o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_name = (SELECT max(n_name) FROM nation)")
def src_03_tenant_scan(spark, d):
    nation = table(spark, d, "nation")
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey")).withColumnRenamed("n_name", "tenant_id")
    tenant = nation.agg(F.max("n_name")).first()[0]
    return columns.for_tenant(rows, tenant).select("o_orderkey", "o_custkey", "tenant_id", "o_orderstatus")


@query("SELECT o_orderkey AS case_id, o_orderstatus AS status, CAST(o_totalprice AS DOUBLE) AS value_at_risk, strftime(o_orderdate, '%Y-%m-%d') AS created_date, CAST(NULL AS VARCHAR) AS sla_due_at FROM orders")
def prj_02_typed_gold(spark, d):
    rows = columns.ensure_columns(table(spark, d, "orders"), {"sla_due_at": "string"})
    out = columns.typed(rows, {"case_id": ("o_orderkey", "long"), "status": ("o_orderstatus", "string"), "value_at_risk": ("o_totalprice", "double"), "created_date": ("o_orderdate", "date"), "sla_due_at": ("sla_due_at", "string")})
    return out.withColumn("created_date", F.date_format("created_date", "yyyy-MM-dd"))


@query("SELECT n_nationkey, n_name, coalesce(CAST(n_regionkey AS VARCHAR), '') AS first_key FROM nation")
def prj_04_first_available(spark, d):
    rows = table(spark, d, "nation")
    return rows.select("n_nationkey", "n_name", F.coalesce(columns.first_available(rows, "missing_key", "N_REGIONKEY", kind="string"), F.lit("")).alias("first_key"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS props_k, event_type FROM events")
def prj_06_flatten(spark, d):
    rows = table(spark, d, "events").select("event_id", F.from_json("props", "k long").alias("props"), "event_type")
    return columns.flatten(rows)


@query("SELECT n_nationkey, sha256(concat_ws('||', coalesce(CAST(n_nationkey AS VARCHAR), ''), coalesce(n_name, ''), coalesce(CAST(n_regionkey AS VARCHAR), ''))) AS record_hash FROM nation")
def hash_01_record_hash(spark, d):
    return table(spark, d, "nation").select("n_nationkey", columns.record_hash(["n_nationkey", "n_name", "n_regionkey"]).alias("record_hash"))


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_orderpriority = '1-URGENT'")
def fil_01_request_filters(spark, d):
    return table(spark, d, "orders").where(F.col("o_orderstatus").isin("F", "P") & (F.col("o_orderpriority") == "1-URGENT")).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= DATE '1996-03-01' AND o_orderdate < DATE '1996-06-01'")
def fil_02_date_range(spark, d):
    return times.in_date_range(table(spark, d, "orders"), "o_orderdate", "1996-03-01", "1996-05-31").select("o_orderkey", "o_totalprice")


@query("SELECT p_type, count(*) AS n FROM part WHERE p_type LIKE '%O%' AND NOT contains(p_name, 'red') GROUP BY p_type")
def fil_04_like(spark, d):
    return table(spark, d, "part").where(F.col("p_type").like("%O%") & ~F.col("p_name").contains("red")).groupBy("p_type").agg(F.count("*").alias("n"))


@query("SELECT o_orderpriority, count(*) AS cases, count(*) FILTER (o_orderstatus NOT IN ('F')) AS open_cases FROM orders GROUP BY o_orderpriority")
def fil_06_isin(spark, d):
    return table(spark, d, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("cases"), aggregates.count_where(~F.col("o_orderstatus").isin("F")).alias("open_cases"))


_AGE = "date_diff('day', o_orderdate, TIMESTAMP '2001-08-02')"


@query(f"SELECT CASE WHEN {_AGE} <= 7 THEN '0-7' WHEN {_AGE} <= 14 THEN '8-14' WHEN {_AGE} <= 30 THEN '15-30' WHEN {_AGE} <= 60 THEN '31-60' ELSE '60+' END AS age_bucket, count(*) AS cases FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1")
def fil_08_case(spark, d):
    return metrics.case_ages(table(spark, d, "orders"), F.lit("2001-08-02").cast("timestamp"), "o_orderdate", F.col("o_orderstatus") != "F")


@query("SELECT event_id, event_type FROM events WHERE regexp_matches(event_type, '^(click|view)$')")
def fil_09_regex(spark, d):
    return table(spark, d, "events").where(F.col("event_type").rlike("^(click|view)$")).select("event_id", "event_type")


# ------------------------------------------------------------------ joins


@query("SELECT o_orderkey, o_orderstatus, coalesce(f, 0) AS has_return FROM orders LEFT JOIN (SELECT l_orderkey, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS f FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey")
def join_01_flags(spark, d):
    lines = table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return joins.flag_by_key(table(spark, d, "orders"), lines, ["o_orderkey"], F.col("l_returnflag") == "R", "has_return").select("o_orderkey", "o_orderstatus", "has_return")


@query("SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")
def join_02_prefixed(spark, d):
    region = table(spark, d, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return joins.enrich(table(spark, d, "nation"), region, ["n_regionkey"], ["r_name"], [F.asc("r_name")]).select("n_nationkey", "n_name", "r_name")


_LATEST = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey, l_suppkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_extendedprice DESC, l_quantity DESC, l_tax DESC, l_discount DESC) AS rn FROM lineitem) WHERE rn = 1)"


def latest_order() -> list[Column]:
    return [F.desc(c) for c in ("l_shipdate", "l_linenumber", "l_extendedprice", "l_quantity", "l_tax", "l_discount")]


@query(f"SELECT a.l_orderkey, a.l_partkey, a.l_suppkey, a.l_linenumber, b.l_extendedprice AS latest_price FROM lineitem a LEFT JOIN {_LATEST} b USING (l_orderkey, l_partkey, l_suppkey) WHERE a.l_returnflag = 'R'")
def join_05_composite(spark, d):
    lines = table(spark, d, "lineitem")
    keys = ["l_orderkey", "l_partkey", "l_suppkey"]
    latest = windows.latest_per_key(lines, keys, latest_order()).select(*keys, F.col("l_extendedprice").alias("latest_price"))
    return lines.where("l_returnflag = 'R'").join(latest, keys, "left").select(*keys, "l_linenumber", "latest_price")


_TIERS = "(VALUES ('AFRICA', 'HOUSEHOLD', 10), ('DEFAULT', 'HOUSEHOLD', 20), ('DEFAULT', 'MACHINERY', 30), ('ASIA', 'MACHINERY', 40)) c(tenant_id, segment, tier)"


@query(
    f"""WITH base AS (SELECT c_custkey, r_name AS tenant_id, c_mktsegment AS segment FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
    m AS (SELECT b.*, c.tier, CASE WHEN c.tenant_id = b.tenant_id THEN 0 WHEN c.tenant_id = 'DEFAULT' THEN 1 ELSE 2 END AS match_rank FROM base b LEFT JOIN {_TIERS} ON b.segment = c.segment AND (c.tenant_id = b.tenant_id OR c.tenant_id = 'DEFAULT'))
    SELECT c_custkey, tenant_id, segment, match_rank, tier FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY match_rank, tier) AS rn FROM m) WHERE rn = 1"""
)
def join_06_best_match(spark, d):
    base = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    base = base.select("c_custkey", F.col("r_name").alias("tenant_id"), F.col("c_mktsegment").alias("segment"))
    config = spark.createDataFrame([("AFRICA", "HOUSEHOLD", 10), ("DEFAULT", "HOUSEHOLD", 20), ("DEFAULT", "MACHINERY", 30), ("ASIA", "MACHINERY", 40)], "tenant_id string, segment string, tier int")
    return joins.best_match(base, config, ["segment"], "tenant_id", ["c_custkey"], [F.col("_c_tier")]).select("c_custkey", "tenant_id", "segment", "match_rank", "tier")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice, o_custkey, coalesce(c_mktsegment, o_orderpriority) AS label FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey WHERE l_linestatus = 'F'")
def join_07_bridge(spark, d):
    lines = table(spark, d, "lineitem").where("l_linestatus = 'F'")
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority")
    people = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return joins.bridge(lines, orders, people, "l_orderkey", "o_custkey").select("l_orderkey", "l_linenumber", "l_extendedprice", "o_custkey", F.coalesce("c_mktsegment", "o_orderpriority").alias("label"))


@query("SELECT event_id, coalesce(a.s_name, b.s_name) AS s_name FROM events LEFT JOIN supplier a ON user_id = a.s_suppkey LEFT JOIN supplier b ON CAST(json_extract_string(props, '$.k') AS BIGINT) = b.s_suppkey")
def join_08_or_rewritten(spark, d):
    rows = table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").try_cast("long"))
    return joins.either_key(rows, table(spark, d, "supplier"), ("user_id", "s_suppkey"), ("k", "s_suppkey"), ["s_name"]).select("event_id", "s_name")


#: The granularities of the views of conditions and alerts.
_ALL_GRAINS = ("day", "week", "month", "year", "all")

_SPANS = "SELECT event_id AS cond_id, user_id, ts AS starts, CASE WHEN event_id % 20 = 0 THEN NULL ELSE ts + INTERVAL 6 HOUR END AS ends FROM events WHERE event_type = 'signup'"
_START = "CASE g WHEN 'all' THEN TIMESTAMP '1970-01-01 00:00:00' ELSE date_trunc(CASE g WHEN 'all' THEN 'day' ELSE g END, {0}) END"
_GRAIN_LIST = "(SELECT unnest(['day', 'week', 'month', 'year', 'all']) AS g)"


@query(
    f"""WITH c AS (SELECT *, {_START.format("starts")} AS b FROM ({_SPANS}), {_GRAIN_LIST}), e AS (SELECT event_id, user_id, ts, g, {_START.format("ts")} AS b FROM events, {_GRAIN_LIST} WHERE event_type = 'purchase')
    SELECT cond_id, c.g AS bucket_granularity, strftime(c.b, '%Y-%m-%d %H:%M:%S') AS bucket_start, event_id FROM c LEFT JOIN e ON c.user_id = e.user_id AND c.g = e.g AND c.b = e.b AND ts >= starts AND (ends IS NULL OR ts <= ends)"""
)
def join_09_bucket_interval(spark, d):
    """All conditions at all granularities."""
    events = table(spark, d, "events")
    conds = events.where("event_type = 'signup'").select(F.col("event_id").alias("cond_id"), "user_id", F.col("ts").alias("starts"), F.when(F.col("event_id") % 20 != 0, F.col("ts") + F.expr("INTERVAL 6 HOUR")).alias("ends"))
    points = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    c, p = times.explode_grains(conds, "starts", _ALL_GRAINS), times.explode_grains(points, "ts", _ALL_GRAINS)
    return joins.bucket_interval(c, p, ["user_id", "bucket_granularity", "bucket_start"], "starts", "ends", "ts").select("cond_id", "bucket_granularity", text("bucket_start").alias("bucket_start"), "event_id")


@query("SELECT count(*) AS orders_of_active FROM orders WHERE o_custkey IN (SELECT user_id FROM events WHERE event_type = 'error')")
def join_11_semi(spark, d):
    users = table(spark, d, "events").where("event_type = 'error'").select(F.col("user_id").alias("o_custkey"))
    return table(spark, d, "orders").join(users, "o_custkey", "left_semi").agg(F.count("*").alias("orders_of_active"))


@query(
    """SELECT strftime(period, '%Y-%m-%d %H:%M:%S') AS period, coalesce(opened, 0) AS opened, coalesce(closed, 0) AS closed, coalesce(opened, 0) - coalesce(closed, 0) AS net
    FROM (SELECT date_trunc('month', o_orderdate) AS period, count(*) AS opened FROM orders GROUP BY 1) FULL JOIN (SELECT date_trunc('month', l_shipdate) AS period, count(*) AS closed FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1) USING (period)"""
)
def join_12_full(spark, d):
    out = metrics.inflow_outflow(table(spark, d, "orders"), "o_orderdate", table(spark, d, "lineitem").where("l_linestatus = 'F'"), "l_shipdate", "month")
    return out.withColumn("period", text("period"))


@query("SELECT n_name, o_orderkey, c_name, r_name FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def join_17_sql(spark, d):
    session = spark.newSession()
    for t in ("orders", "customer", "nation", "region"):
        table(session, d, t).createOrReplaceTempView(t)
    return session.sql(SQL["join_17_sql"])


@query(
    """SELECT o_orderkey, c_name, best AS latest_line FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN
    (SELECT l_orderkey, l_linenumber AS best FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC) rn FROM lineitem) WHERE rn = 1) ON o_orderkey = l_orderkey"""
)
def join_19_latest_lookup(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("latest_line"), "l_shipdate")
    people = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    out = joins.enrich(table(spark, d, "orders"), lines, ["o_orderkey"], ["latest_line", "l_shipdate"], [F.desc("l_shipdate"), F.desc("latest_line")])
    return joins.enrich(out, people, ["o_custkey"], ["c_name"], [F.asc("c_name")]).select("o_orderkey", "c_name", "latest_line")


@query("SELECT event_id, round(value - avg(value) OVER (PARTITION BY event_type), 8) AS above_mean, count(*) OVER (PARTITION BY event_type) AS peers FROM events")
def join_20_group_stats(spark, d):
    events = table(spark, d, "events").select("event_id", "event_type", "value")
    stats = events.groupBy("event_type").agg(F.avg("value").alias("mean"), F.count("*").alias("peers"))
    return events.join(stats, "event_type").select("event_id", r8(F.col("value") - F.col("mean")).alias("above_mean"), "peers")


# ------------------------------------------------------------------ aggregations

_EDGE = "SELECT '{g}' AS bucket_granularity, date_trunc('{g}', l_shipdate) AS b, l_suppkey, l_partkey, l_extendedprice, l_shipdate, l_returnflag FROM lineitem"


@query(
    "SELECT bucket_granularity, strftime(b, '%Y-%m-%d %H:%M:%S') AS bucket_start, l_suppkey AS from_l_suppkey, l_partkey AS to_l_partkey, count(*) AS tx_count, round(sum(l_extendedprice), 4) AS total_amount, max(l_returnflag) AS currency_hint, date_diff('second', min(l_shipdate), max(l_shipdate)) AS active_window_sec, "
    "round(CASE WHEN max(l_shipdate) > min(l_shipdate) THEN count(*) / (date_diff('second', min(l_shipdate), max(l_shipdate)) / 86400.0) ELSE count(*) END, 4) AS tx_per_day FROM ("
    + " UNION ALL ".join(_EDGE.format(g=g) for g in ("day", "week", "month", "year"))
    + ") GROUP BY ALL"
)
def agg_01_edges(spark, d):
    out = aggregates.edges(table(spark, d, "lineitem"), "l_suppkey", "l_partkey", "l_shipdate", "l_extendedprice", currency="l_returnflag")
    return out.select("bucket_granularity", text("bucket_start").alias("bucket_start"), "from_l_suppkey", "to_l_partkey", "tx_count", r4("total_amount").alias("total_amount"), "currency_hint", "active_window_sec", r4("tx_per_day").alias("tx_per_day"))


@query("SELECT user_id, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS bucket_start, count(*) AS bucket_tx_count, round(sum(value), 4) AS bucket_tx_amount FROM events WHERE event_type IN ('purchase', 'view') GROUP BY 1, 2")
def agg_02_entity_rollup(spark, d):
    rows = times.explode_grains(table(spark, d, "events").where(F.col("event_type").isin("purchase", "view")), "ts", ("day",))
    return rows.groupBy("user_id", text("bucket_start").alias("bucket_start")).agg(F.count("*").alias("bucket_tx_count"), r4(F.sum("value")).alias("bucket_tx_amount"))


@query("SELECT strftime(date_trunc('week', ts), '%Y-%m-%d %H:%M:%S') AS period, count(*) AS total, count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (event_type = 'purchase') AS purchases, round(count(*) FILTER (event_type = 'error') / count(*), 4) AS error_rate FROM events GROUP BY 1")
def agg_06_conditional(spark, d):
    e = F.col("event_type")
    out = metrics.period_rates(table(spark, d, "events"), "ts", "week", {"errors": e == "error", "purchases": e == "purchase"}, {"error_rate": ("errors", "total")})
    return out.select(text("period").alias("period"), "total", "errors", "purchases", r4("error_rate").alias("error_rate"))


@query("SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT CASE WHEN value > 100 THEN user_id END) AS big_users FROM events GROUP BY 1")
def agg_07_cond_distinct(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count_distinct("user_id").alias("users"), aggregates.distinct_where(F.col("value") > 100, "user_id").alias("big_users"))


@query("SELECT event_type, count(value) AS n, round(avg(value), 8) AS mean, round(stddev_samp(value), 8) AS stddev, round(sum(value), 2) AS total FROM events GROUP BY 1")
def agg_10_stats(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count("value").alias("n"), r8(F.avg("value")).alias("mean"), r8(F.stddev("value")).alias("stddev"), F.round(F.sum("value"), 2).alias("total"))


@query()
def agg_11_approx(spark, d):
    p = F.percentile_approx("value", [0.25, 0.5, 0.75, 0.9], 10_000)
    return table(spark, d, "events").groupBy("event_type").agg(p.alias("p")).select("event_type", *[F.col("p")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75", "p90"))])


@query("SELECT event_type, round(quantile_cont(value, 0.5), 8) AS p50, round(quantile_cont(value, 0.95), 8) AS p95, round(quantile_cont(value, 0.99), 8) AS p99 FROM events GROUP BY 1")
def agg_13_percentile(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(*[r8(F.percentile("value", p)).alias(n) for p, n in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99"))])


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, " + ", ".join(f"count(*) FILTER (event_type = '{e}') AS \"{e}\"" for e in ("click", "error", "view")) + " FROM events GROUP BY 1")
def agg_15_pivot(spark, d):
    rows = table(spark, d, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return aggregates.pivot(rows, ["day"], "event_type", ["click", "error", "view"], F.count("event_id")).fillna(0)


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS n, round(avg({c}), 8) AS mean, round(stddev_samp({c}), 8) AS stddev, round(min({c}), 8) AS least, round(max({c}), 8) AS most FROM lineitem" for c in ("l_quantity", "l_discount", "l_tax")))
def agg_16_describe(spark, d):
    out = aggregates.describe(table(spark, d, "lineitem"), ["l_quantity", "l_discount", "l_tax"])
    return out.select("column", "n", *[r8(c).alias(c) for c in ("mean", "stddev", "least", "most")])


@query("SELECT strftime(o_orderdate, '%Y-%m') AS bucket, count(*) AS n FROM orders GROUP BY 1")
def agg_18_histogram(spark, d):
    return aggregates.histogram(table(spark, d, "orders"), F.date_format("o_orderdate", "yyyy-MM"))


@query("SELECT CASE WHEN o_totalprice >= 300000 THEN 'HIGH' WHEN o_totalprice >= 100000 THEN 'MEDIUM' ELSE 'LOW' END AS tier, count(*) AS cases, count(DISTINCT o_custkey) AS owners FROM orders GROUP BY 1")
def agg_20_tiers(spark, d):
    v = F.col("o_totalprice")
    return table(spark, d, "orders").groupBy(F.when(v >= 300000, "HIGH").when(v >= 100000, "MEDIUM").otherwise("LOW").alias("tier")).agg(F.count("*").alias("cases"), F.count_distinct("o_custkey").alias("owners"))


# ------------------------------------------------------------------ windows, order, sets


@query(f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, strftime(l_shipdate, '%Y-%m-%d') AS ship_date FROM {_LATEST}")
def win_01_latest(spark, d):
    out = windows.latest_per_key(table(spark, d, "lineitem"), ["l_orderkey", "l_partkey", "l_suppkey"], latest_order())
    return out.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_date"))


@query("SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS recent_rank_desc FROM events")
def win_02_recent_rank(spark, d):
    return windows.recency(table(spark, d, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("event_id", "user_id", "recent_rank_desc")


_RUN = "OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@query(f"SELECT event_id, CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) {_RUN} AS BIGINT) AS cum_tx_count, round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END) {_RUN}, 2) AS cum_tx_amount FROM events")
def win_03_running(spark, d):
    out = windows.running(table(spark, d, "events"), ["user_id"], [F.asc("ts"), F.asc("event_id")], "value", F.col("event_type") == "purchase")
    return out.select("event_id", "cum_tx_count", F.round("cum_tx_amount", 2).alias("cum_tx_amount"))


@query("SELECT o_orderpriority, count(*) AS cases, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM orders GROUP BY 1")
def win_05_share(spark, d):
    out = windows.share_of_total(table(spark, d, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("cases")), "cases")
    return out.select("o_orderpriority", "cases", F.round("share", 6).alias("share"))


@query(
    """WITH t AS (SELECT date_trunc('month', o_orderdate) AS p, count(*) AS cases FROM orders GROUP BY 1), l AS (SELECT p, cases, lag(cases) OVER (ORDER BY p) AS prev_cases FROM t)
    SELECT strftime(p, '%Y-%m-%d') AS period, cases, prev_cases, round(CASE WHEN coalesce(prev_cases, 0) = 0 THEN 0.0 ELSE (cases - prev_cases) / prev_cases * 100 END, 4) AS cases_change_pct FROM l"""
)
def win_06_lag(spark, d):
    t = table(spark, d, "orders").groupBy(times.bucket(F.col("o_orderdate"), "month").alias("period")).agg(F.count("*").alias("cases"))
    return windows.period_change(t, "period", ["cases"]).select(F.date_format("period", "yyyy-MM-dd").alias("period"), "cases", "prev_cases", r4("cases_change_pct").alias("cases_change_pct"))


@query("SELECT event_id, count(*) OVER (PARTITION BY user_id) AS user_events FROM events")
def win_07_part_count(spark, d):
    return table(spark, d, "events").select("event_id", F.count("*").over(Window.partitionBy("user_id")).alias("user_events"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def srt_02_topk(spark, d):
    return metrics.high_value(table(spark, d, "orders"), "o_totalprice", 0.0, [F.asc("o_orderkey")], 10).select("o_orderkey", "o_totalprice")


@query(" UNION ALL ".join(f"SELECT '{g}' AS bucket_granularity, strftime(date_trunc('{g}', ts), '%Y-%m-%d %H:%M:%S') AS bucket_start, event_type, count(*) AS n, round(sum(value), 2) AS amount FROM events GROUP BY 1, 2, 3" for g in ("day", "week", "month", "year")))
def set_01_union_grains(spark, d):
    rows = times.explode_grains(table(spark, d, "events"), "ts")
    return rows.groupBy("bucket_granularity", text("bucket_start").alias("bucket_start"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("amount"))


@query("SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def set_04_distinct(spark, d):
    return table(spark, d, "lineitem").select("l_suppkey", "l_returnflag").distinct()


# ------------------------------------------------------------------ arrays and JSON


def _lines(spark, d) -> DataFrame:
    item = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("items"))


_ORDERED = "ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag"


@query(f"SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ',' {_ORDERED}) AS parts, count(*) AS items FROM lineitem GROUP BY 1")
def arr_01_project(spark, d):
    return _lines(spark, d).select("l_orderkey", F.array_join(F.transform(nested.project(F.col("items"), "l_partkey"), lambda x: x.cast("string")), ",").alias("parts"), nested.length_or_0(F.col("items")).cast("long").alias("items"))


@query(
    f"""SELECT l_orderkey, string_agg(l_returnflag || ':' || l_linenumber, ',' ORDER BY k) AS firsts FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag {_ORDERED}) AS rn, row_number() OVER (PARTITION BY l_orderkey {_ORDERED}) AS k FROM lineitem) WHERE rn = 1 GROUP BY 1"""
)
def arr_03_dedup(spark, d):
    rows = _lines(spark, d)
    kept = nested.first_per_key(F.col("items"), "l_returnflag", rows.schema["items"].dataType.simpleString())
    return rows.select("l_orderkey", F.array_join(F.transform(kept, lambda x: F.concat(x["l_returnflag"], F.lit(":"), x["l_linenumber"].cast("string"))), ",").alias("firsts"))


@query(
    """WITH a AS (SELECT l_orderkey, list_sort(list(l_quantity)) AS q FROM lineitem GROUP BY 1), b AS (SELECT l_orderkey, arg_max(l_partkey, {'q': l_quantity, 'p': -l_partkey}) AS top_part FROM lineitem GROUP BY 1)
    SELECT l_orderkey, len(list_distinct(q)) AS kinds, list_sum(q) AS total, list_max(q) AS most, list_min(q) AS least, q[CAST(ceil(len(q) * 0.95) AS BIGINT)] AS p95, top_part FROM a JOIN b USING (l_orderkey)"""
)
def arr_04_stats(spark, d):
    items = F.col("items")
    q = nested.project(items, "l_quantity")
    return _lines(spark, d).select(
        "l_orderkey", F.size(F.array_distinct(q)).cast("long").alias("kinds"), nested.total(q).alias("total"), F.array_max(q).alias("most"), F.array_min(q).alias("least"), nested.nearest_rank(q, 0.95).alias("p95"), nested.arg_max(items, "l_quantity", "l_partkey").alias("top_part")
    )


@query(f"SELECT l_orderkey, first(l_partkey {_ORDERED}) FILTER (l_quantity > 25) AS first_big FROM lineitem GROUP BY 1")
def arr_06_first(spark, d):
    return _lines(spark, d).select("l_orderkey", nested.first_where(F.col("items"), lambda x: x["l_quantity"] > 25, lambda x: x["l_partkey"]).alias("first_big"))


@query("SELECT l_orderkey, l_linenumber, 'SUPPLIER' AS entity_type, l_suppkey AS entity_id FROM lineitem WHERE l_suppkey % 3 <> 0 UNION ALL SELECT l_orderkey, l_linenumber, 'PART', l_partkey FROM lineitem")
def arr_07_fanout(spark, d):
    kind = lambda name, c: F.struct(F.lit(name).alias("entity_type"), F.col(c).alias("entity_id"))
    rows = nested.fan_out(table(spark, d, "lineitem"), [F.when(F.col("l_suppkey") % 3 != 0, kind("SUPPLIER", "l_suppkey")), kind("PART", "l_partkey")])
    return rows.select("l_orderkey", "l_linenumber", "entity_type", "entity_id")


@query("SELECT r_name, n_name, s_name FROM region LEFT JOIN nation ON r_regionkey = n_regionkey LEFT JOIN supplier ON n_nationkey = s_nationkey")
def arr_08_explode3(spark, d):
    s = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.collect_list("s_name").alias("suppliers"))
    n = table(spark, d, "nation").join(s, "n_nationkey", "left").groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(F.collect_list(F.struct("n_name", "suppliers")).alias("nations"))
    tree = table(spark, d, "region").join(n, "r_regionkey", "left")
    return tree.select("r_name", F.explode_outer("nations").alias("n")).select("r_name", "n.n_name", F.explode_outer("n.suppliers").alias("s_name"))


@query(f"SELECT l_orderkey, max(CASE WHEN k = 1 THEN l_partkey END) AS item_001_l_partkey, max(CASE WHEN k = 2 THEN l_partkey END) AS item_002_l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey {_ORDERED}) AS k FROM lineitem) GROUP BY 1")
def arr_10_wide(spark, d):
    return _lines(spark, d).select("l_orderkey", *nested.wide(F.col("items"), ["l_partkey"], "item", 2))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def jsn_01_parse(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("SELECT event_id, coalesce(json_extract_string(props, '$.missing'), json_extract_string(props, '$.k')) AS v FROM events")
def jsn_02_fallback(spark, d):
    return table(spark, d, "events").select("event_id", nested.json_first("props", "$.missing", "$.k").alias("v"))


@query("SELECT n_nationkey, '{\"n_nationkey\":' || n_nationkey || ',\"n_name\":\"' || n_name || '\",\"n_regionkey\":' || n_regionkey || '}' AS payload FROM nation")
def jsn_03_payload(spark, d):
    rows = table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return rows.select("n_nationkey", nested.payload(rows).alias("payload"))


# ------------------------------------------------------------------ quality, tables, streams, documents, service

_REASONS = "concat_ws(',', CASE WHEN quality IS NULL THEN 'NO_LABEL' END, CASE WHEN quality = 0 THEN 'LOW_QUALITY' END, CASE WHEN length(text) < 200 THEN 'SHORT' END)"


@query(f"SELECT d.doc_id, {_REASONS} AS reasons, {_REASONS} = '' AS passed FROM documents d LEFT JOIN labels l USING (doc_id)")
def etl_23_dq_split(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    rules = {"NO_LABEL": F.col("quality").isNull(), "LOW_QUALITY": F.col("quality") == 0, "SHORT": F.length("text") < 200}
    good, bad = quality.split(rows, rules)
    return good.select("doc_id", F.lit("").alias("reasons"), F.lit(True).alias("passed")).unionByName(bad.select("doc_id", F.array_join("dq_reasons", ",").alias("reasons"), F.lit(False).alias("passed")))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'F' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders")
def snk_01_upsert(spark, d):
    """All orders upserted into a keyed table, then an update that closes every third."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    merged = SnapshotTable(spark, scratch(spark, "snk_01"), TableSpec("orders", ("o_orderkey",), "batch"))
    merged.upsert(orders.withColumn("batch", F.lit(1)), "1")
    merged.upsert(orders.where("o_orderkey % 3 = 0").withColumns({"o_orderstatus": F.lit("F"), "batch": F.lit(2)}), "2")
    return merged.read().select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n, round(sum(value), 2) AS amount FROM events GROUP BY 1, 2")
def str_04_tumbling(spark, d):
    out = ingest.tumbling(table(spark, d, "events"), "ts", "1 hour", ["event_type"], [F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("amount")])
    return out.select(text("window_start").alias("window_start"), "event_type", "n", "amount")


@query("SELECT doc_id, CAST(coalesce(octet_length(encode(text)), 0) AS BIGINT) AS size_bytes, CAST(coalesce(length(text), 0) AS BIGINT) AS text_length, md5(CASE WHEN length(trim(text)) > 0 AND octet_length(encode(text)) <= 52428800 THEN substr(text, 1, 30000) END) AS index_md5, md5(CASE WHEN length(trim(text)) > 0 AND octet_length(encode(text)) <= 52428800 THEN text END) AS forward_md5, CASE WHEN text IS NULL OR octet_length(encode(text)) > 52428800 OR length(trim(text)) = 0 THEN 'ERROR' ELSE 'COMPLETED' END AS processing_status FROM documents")
def doc_01_pipeline(spark, d):
    """With the limits that production uses, and the text that is forwarded."""
    out = documents.process(table(spark, d, "documents"))
    return out.select("doc_id", "size_bytes", "text_length", F.md5(F.col("index_text").cast("binary")).alias("index_md5"), F.md5(F.col("forward_text").cast("binary")).alias("forward_md5"), "processing_status")


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey = 7 AND s_suppkey IN (0, 1, 2, 3, 4, 5, 6, 7, 8, 9)")
def api_01_query(spark, d):
    service = QueryService(spark, {"supplier": f"{d}/supplier.parquet"}, "7", ("s_nationkey",))
    return service.query("supplier", {"s_suppkey": list(range(10))}, ["s_suppkey", "s_name"], 1000)


# ------------------------------------------------------------------ metrics


@query(
    """WITH t AS (SELECT date_trunc('week', ts) AS p, count(*) AS alerts, count(*) FILTER (event_type = 'purchase') AS tp, count(*) FILTER (event_type = 'error') AS fp, count(*) FILTER (event_type = 'view') AS tn, count(*) FILTER (event_type = 'click') AS fn,
    sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END) AS v FROM events GROUP BY 1)
    SELECT strftime(p, '%Y-%m-%d') AS period, alerts, tp, fp, tn, fn, round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 4) AS precision, round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 4) AS recall,
    round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 4) AS f1, round(CASE WHEN fp + tn = 0 THEN 0 ELSE fp / (fp + tn) END, 4) AS fpr, round(v, 2) AS confirmed_value,
    round(CASE WHEN coalesce(lag(alerts) OVER (ORDER BY p), 0) = 0 THEN 0.0 ELSE (alerts - lag(alerts) OVER (ORDER BY p)) / lag(alerts) OVER (ORDER BY p) * 100 END, 4) AS alerts_change_pct FROM t"""
)
def met_04_trend(spark, d):
    e = F.col("event_type")
    outcome = F.when(e == "purchase", "TRUE_POSITIVE").when(e == "error", "FALSE_POSITIVE").when(e == "view", "TRUE_NEGATIVE").when(e == "click", "FALSE_NEGATIVE")
    alerts = table(spark, d, "events").select(F.col("ts").alias("event_ts"), outcome.alias("prediction_outcome_norm"), F.lit("FRAUD").alias("alert_type_norm"), F.col("value").alias("tx_amount"))
    out = metrics.fraud_trend(alerts, "week")
    return out.select(F.date_format("period", "yyyy-MM-dd").alias("period"), "alerts", "tp", "fp", "tn", "fn", *[r4(c).alias(c) for c in ("precision", "recall", "f1", "fpr")], F.round("confirmed_value", 2).alias("confirmed_value"), r4("alerts_change_pct").alias("alerts_change_pct"))


@query("SELECT o_orderpriority, count(*) AS cases, count(*) FILTER (o_orderstatus <> 'F') AS open_cases, count(*) FILTER (o_orderstatus = 'F') AS closed_cases, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM orders GROUP BY 1")
def met_06_inventory(spark, d):
    cases = table(spark, d, "orders").withColumn("status", F.when(F.col("o_orderstatus") == "F", "STATUS_81_CLOSED_REFUTED").otherwise("STATUS_10_OPEN"))
    return metrics.case_inventory(cases, "o_orderpriority").withColumn("share", F.round("share", 6))


@query("SELECT l_suppkey, count(*) AS tasks, count(*) FILTER (l_linestatus = 'F') AS completed, count(*) FILTER (l_returnflag = 'R') AS breached, round(avg(l_quantity), 8) AS avg_hours FROM lineitem GROUP BY 1")
def met_07_workload(spark, d):
    tasks = table(spark, d, "lineitem").select("l_suppkey", (F.col("l_linestatus") == "F").cast("int").alias("is_completed"), (F.col("l_returnflag") == "R").cast("int").alias("sla_breached"), (F.col("l_quantity") * 3_600_000).alias("task_duration_ms"))
    return metrics.task_workload(tasks, "l_suppkey").withColumn("avg_hours", r8("avg_hours"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F' AND o_totalprice >= 250000 ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def met_10_high_value(spark, d):
    return metrics.high_value(table(spark, d, "orders").where("o_orderstatus <> 'F'"), "o_totalprice", 250000.0, [F.asc("o_orderkey")]).select("o_orderkey", "o_totalprice")


@query(
    """WITH a AS (SELECT date_trunc('hour', ts) AS b, count(*) AS received FROM events GROUP BY 1), e AS (SELECT date_trunc('hour', ts) AS b, count(*) AS evaluated, avg(CASE WHEN value >= 0 THEN value END) AS m, quantile_cont(CASE WHEN value >= 0 THEN value END, 0.95) AS p FROM events WHERE event_type <> 'error' GROUP BY 1)
    SELECT strftime(b, '%Y-%m-%d %H:%M:%S') AS time_bucket, received, coalesce(evaluated, 0) AS evaluated, round(received / evaluated * 100, 8) AS rate_pct, round(m, 8) AS avg_latency, round(p, 8) AS p95_latency FROM a LEFT JOIN e USING (b)"""
)
def met_24_tms(spark, d):
    events = table(spark, d, "events")
    out = metrics.throughput(events, "ts", events.where("event_type <> 'error'"), "ts", "hour", "value")
    return out.select(text("time_bucket").alias("time_bucket"), "received", "evaluated", *[r8(c).alias(c) for c in ("rate_pct", "avg_latency", "p95_latency")])


@query("SELECT strftime(o_orderdate, '%Y-%m-%d') AS metric_date, count(*) AS new_cases, count(*) FILTER (o_orderstatus = 'F') AS closed_cases, count(*) FILTER (o_orderstatus <> 'F') AS open_cases, count(DISTINCT CASE WHEN o_orderstatus <> 'F' THEN o_custkey END) AS active_owners, round(sum(CASE WHEN o_orderstatus <> 'F' THEN o_totalprice ELSE 0 END), 2) AS value_at_risk, round(count(*) FILTER (o_orderstatus = 'F') / count(*), 4) AS closure_rate FROM orders GROUP BY 1")
def met_26_daily(spark, d):
    cases = table(spark, d, "orders").withColumn("status", F.when(F.col("o_orderstatus") == "F", "STATUS_82_CLOSED_CONFIRMED").otherwise("OPEN"))
    out = metrics.daily_cases(cases, "o_orderdate", "o_custkey", "o_totalprice")
    return out.withColumns({"metric_date": F.date_format("metric_date", "yyyy-MM-dd"), "value_at_risk": F.round("value_at_risk", 2), "closure_rate": r4("closure_rate")})


@query(
    """WITH t AS (SELECT o_custkey, count(*) AS cases, count(*) FILTER (o_orderstatus = 'F') AS closed_cases FROM orders GROUP BY 1) SELECT o_custkey, cases, closed_cases, round(closed_cases / cases * 100, 4) AS closure_rate, CASE WHEN closed_cases / cases * 100 >= 80 THEN 'HIGH' WHEN closed_cases / cases * 100 >= 50 THEN 'MEDIUM' ELSE 'LOW' END AS tier FROM t"""
)
def met_20_productivity(spark, d):
    cases = table(spark, d, "orders").withColumn("status", F.when(F.col("o_orderstatus") == "F", "STATUS_81_CLOSED_REFUTED").otherwise("OPEN"))
    return metrics.productivity(cases, "o_custkey").select("o_custkey", "cases", "closed_cases", r4("closure_rate").alias("closure_rate"), "tier")


@query("SELECT event_type, total, row_number() OVER (ORDER BY total DESC, event_type) AS rank FROM (SELECT event_type, round(sum(value), 2) AS total FROM events GROUP BY 1)")
def met_23_rank(spark, d):
    return metrics.rank_by(table(spark, d, "events").groupBy("event_type").agg(F.round(F.sum("value"), 2).alias("total")), "total", False, "event_type").withColumn("rank", F.col("rank").cast("long"))


@query("SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS period, count(*) AS n, round(avg(value), 8) AS mean FROM events GROUP BY 1")
def met_28_rollup(spark, d):
    hourly = table(spark, d, "events").groupBy(times.bucket(F.col("ts"), "hour").alias("h")).agg(F.count("*").alias("n"), F.avg("value").alias("mean"))
    out = metrics.roll_up(hourly, "h", "day", ["n"], {"mean": "n"})
    return out.select(F.date_format("period", "yyyy-MM-dd").alias("period"), "n", r8("mean").alias("mean"))


@query("SELECT event_type, CASE WHEN avg(value) >= 51 THEN 'good' WHEN avg(value) >= 50 THEN 'fair' ELSE 'poor' END AS status FROM events GROUP BY 1")
def met_30_status(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(metrics.kpi_status(F.avg("value"), 51, 50).alias("status"))


# ------------------------------------------------------------------ evidence and calibration

_MS = "(epoch_us(ts) // 1000)"


@query(f"SELECT event_id, count(*) OVER (PARTITION BY user_id, event_type ORDER BY {_MS} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lifetime_count FROM events")
def rule_030_pair_history(spark, d):
    rows = table(spark, d, "events").withColumn("ms", F.unix_millis("ts"))
    return evidence.lifetime_count(rows, ["user_id", "event_type"], "ms").select("event_id", "lifetime_count")


@query(f"SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY {_MS} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lifetime_count FROM events")
def rule_044_lifetime(spark, d):
    rows = table(spark, d, "events").withColumn("ms", F.unix_millis("ts"))
    return evidence.lifetime_count(rows, ["user_id"], "ms").select("event_id", "lifetime_count")


@query(f"SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY {_MS} RANGE BETWEEN 86400000 PRECEDING AND CURRENT ROW) AS recent_count FROM events")
def rule_002_window(spark, d):
    return evidence.recent_count(table(spark, d, "events"), ["user_id"], "ts", 86_400_000).select("event_id", "recent_count")


@query(f"SELECT event_id, coalesce({_MS} - max({_MS}) OVER (PARTITION BY user_id ORDER BY {_MS} RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gap_ms FROM events")
def rule_003_gap(spark, d):
    return evidence.gap_before(table(spark, d, "events"), ["user_id"], "ts").select("event_id", "gap_ms")


@query(f"SELECT event_id, {_MS} - lag({_MS}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_gap_ms FROM events")
def rule_076_previous_gap(spark, d):
    return evidence.gap_to_previous(table(spark, d, "events"), ["user_id"], "ts", "event_id").select("event_id", "previous_gap_ms")


@query(f"SELECT event_id, {_MS} - min({_MS}) OVER (PARTITION BY user_id) AS age_ms FROM events")
def rule_001_age(spark, d):
    return evidence.account_age(table(spark, d, "events"), ["user_id"], "ts").select("event_id", "age_ms")


@query("SELECT o_orderkey, coalesce(o_totalprice, 0) >= 10000 AS over FROM orders")
def rule_091_amount(spark, d):
    return table(spark, d, "orders").select("o_orderkey", evidence.over_threshold(F.col("o_totalprice"), F.lit(None).cast("double")).alias("over"))


@query("SELECT c_nationkey, count(DISTINCT c_mktsegment) AS accounts FROM customer GROUP BY 1")
def rule_083_accounts(spark, d):
    return evidence.accounts_per_party(table(spark, d, "customer"), "c_nationkey", "c_mktsegment")


@query("SELECT event_id, value AS x_amount, CAST(hour(ts) AS INTEGER) AS x_hour, CAST(dayofweek(ts) + 1 AS INTEGER) AS x_weekday, CASE WHEN value = floor(value) THEN 1 ELSE 0 END AS x_whole, count(*) OVER (PARTITION BY event_type) AS x_bank_count FROM events")
def ml_02_features(spark, d):
    return calibration.payment_features(table(spark, d, "events"), "value", "ts", "event_type", "event_type").select("event_id", "x_amount", "x_hour", "x_weekday", "x_whole", "x_bank_count")


@query(" UNION ALL ".join(f"SELECT '{c}' AS feature, round(corr({c}, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END), 6) AS corr FROM lineitem" for c in ("l_quantity", "l_discount", "l_tax")))
def ml_03_corr(spark, d):
    rows = table(spark, d, "lineitem").withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
    return calibration.correlations(rows, ["l_quantity", "l_discount", "l_tax"], "y").withColumn("corr", F.round("corr", 6))


@query(
    """WITH q AS (SELECT unnest(quantile_cont(value, [0.5, 0.75, 0.9, 0.95])) AS t FROM events), g AS (SELECT t, count(*) FILTER (value > t) AS fired, count(*) FILTER (value > t AND event_type = 'error') AS hits, count(*) FILTER (event_type = 'error') AS positives FROM q, events GROUP BY t)
    SELECT round(t, 8) AS threshold, fired, hits, positives, round(hits / fired, 6) AS precision, round(hits / positives, 6) AS recall FROM g"""
)
def ml_05_threshold(spark, d):
    out = calibration.threshold_grid(table(spark, d, "events"), "value", F.col("event_type") == "error", [0.5, 0.75, 0.9, 0.95])
    return out.select(r8("threshold").alias("threshold"), "fired", "hits", "positives", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


@query("SELECT event_type, CAST(trunc(quantile_cont(value, 0.5) * 0.7) AS INTEGER) AS alert_threshold, CAST(trunc(quantile_cont(value, 0.75)) AS INTEGER) AS interdiction_threshold FROM events WHERE value > 10 GROUP BY 1")
def ml_10_thresholds(spark, d):
    return calibration.threshold_advice(table(spark, d, "events"), ["event_type"], "value", F.col("value") > 10)


# ------------------------------------------------------------------ views over events: user pays the account named in props


def _detail(spark, d) -> DataFrame:
    e = table(spark, d, "events")
    none = F.lit(None).cast("string")
    return e.select(
        F.col("event_id").cast("string").alias("transaction_id"), F.lit("T1").alias("tenant_id"), F.col("event_type").alias("tx_type"), none.alias("end_to_end_id"), none.alias("tx_msg_id"), F.col("ts").alias("tx_event_ts"), F.col("value").alias("instructed_amount"),
        F.lit("EUR").alias("instructed_currency"), F.col("user_id").cast("string").alias("debtor_account_id"), F.get_json_object("props", "$.k").alias("creditor_account_id"), F.when(F.col("user_id") % 2 == 0, F.concat(F.lit("c"), F.col("user_id").cast("string"))).alias("debtor_id"),
        none.alias("creditor_id"), none.alias("debtor_name"), none.alias("creditor_name"), (F.col("event_type") == "error").cast("int").alias("is_alerted"), (F.col("value") > 200).cast("int").alias("is_investigated"),
    )


_PAYS = ("purchase", "view")
_PARTY = (
    "SELECT event_id, event_type, ts, value, 'ACCOUNT' AS entity_type, 'DEBTOR' AS entity_role, CAST(user_id AS VARCHAR) AS entity_id FROM events UNION ALL SELECT event_id, event_type, ts, value, 'ACCOUNT', 'CREDITOR', json_extract_string(props, '$.k') FROM events "
    "UNION ALL SELECT event_id, event_type, ts, value, 'COUNTERPARTY', 'DEBTOR', 'c' || user_id FROM events WHERE user_id % 2 = 0"
)
_PW = "PARTITION BY entity_type, entity_role, entity_id ORDER BY ts{0}, CAST(event_id AS VARCHAR){0}"


@query(
    f"""WITH p AS ({_PARTY}), ev AS (SELECT 'EVENT' AS row_type, CAST(event_id AS VARCHAR) AS transaction_id, entity_type, entity_role, entity_id, CAST(NULL AS VARCHAR) AS bucket_granularity, CAST(NULL AS VARCHAR) AS bucket_start, CAST(row_number() OVER ({_PW.format(" DESC")}) AS BIGINT) AS recent_rank_desc,
    CAST(sum(CASE WHEN event_type IN ('purchase', 'view') THEN 1 ELSE 0 END) OVER ({_PW.format("")} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum_tx_count, round(sum(CASE WHEN event_type IN ('purchase', 'view') THEN value ELSE 0 END) OVER ({_PW.format("")} ROWS UNBOUNDED PRECEDING), 2) AS cum_tx_amount, CAST(NULL AS BIGINT) AS bucket_tx_count, CAST(NULL AS DOUBLE) AS bucket_tx_amount FROM p),
    g AS (SELECT unnest(['day', 'week', 'month', 'year']) AS g), ag AS (SELECT 'AGG' AS row_type, 'AGG||' || entity_type || '||' || entity_role || '||' || entity_id || '||' || g || '||' || strftime(date_trunc(g, ts), '%Y-%m-%d %H:%M:%S') AS transaction_id, entity_type, entity_role, entity_id, g AS bucket_granularity, strftime(date_trunc(g, ts), '%Y-%m-%d %H:%M:%S') AS bucket_start,
    CAST(NULL AS BIGINT) AS recent_rank_desc, CAST(NULL AS BIGINT) AS cum_tx_count, CAST(NULL AS DOUBLE) AS cum_tx_amount, count(*) AS bucket_tx_count, round(sum(value), 2) AS bucket_tx_amount FROM p, g WHERE event_type IN ('purchase', 'view') GROUP BY ALL)
    SELECT * FROM ev UNION ALL SELECT * FROM ag"""
)
def view_06_history(spark, d):
    out = views.transaction_history(_detail(spark, d), payment_types=_PAYS)
    return out.select(
        "row_type", "transaction_id", "entity_type", "entity_role", "entity_id", "bucket_granularity", text("bucket_start").alias("bucket_start"), F.col("recent_rank_desc").cast("long").alias("recent_rank_desc"), "cum_tx_count", F.round("cum_tx_amount", 2).alias("cum_tx_amount"), "bucket_tx_count", F.round("bucket_tx_amount", 2).alias("bucket_tx_amount")
    )


@query(
    "SELECT g AS bucket_granularity, strftime(date_trunc(g, ts), '%Y-%m-%d %H:%M:%S') AS bucket_start, CAST(user_id AS VARCHAR) AS from_id, json_extract_string(props, '$.k') AS to_id, count(*) AS tx_count, round(sum(value), 2) AS total_amount, max(CASE WHEN value > 200 THEN 1 ELSE 0 END) AS investigated FROM events, (SELECT unnest(['day', 'week', 'month', 'year']) AS g) WHERE event_type IN ('purchase', 'view') GROUP BY ALL"
)
def view_07_account_edges(spark, d):
    out = views.network_edges(_detail(spark, d), "debtor_account_id", "creditor_account_id", payment_types=_PAYS)
    return out.select("bucket_granularity", text("bucket_start").alias("bucket_start"), F.col("from_debtor_account_id").alias("from_id"), F.col("to_creditor_account_id").alias("to_id"), "tx_count", F.round("total_amount", 2).alias("total_amount"), F.col("is_investigated_edge").alias("investigated"))


@query("SELECT g AS bucket_granularity, 'c' || user_id AS from_id, CAST(user_id AS VARCHAR) AS to_id, strftime(date_trunc(g, ts), '%Y-%m-%d') AS bucket_start, count(*) AS tx_count FROM events, (SELECT unnest(['day', 'week', 'month', 'year']) AS g) WHERE user_id % 2 = 0 AND event_type IN ('purchase', 'view') GROUP BY ALL")
def view_09_holder_links(spark, d):
    out = views.holder_links(_detail(spark, d), payment_types=_PAYS)
    return out.select("bucket_granularity", F.col("from_counterparty_id").alias("from_id"), F.col("to_account_id").alias("to_id"), F.date_format("bucket_start", "yyyy-MM-dd").alias("bucket_start"), "tx_count")


@query(
    f"""WITH p AS (SELECT DISTINCT event_id, ts, value, entity_type, entity_id FROM ({_PARTY}) WHERE event_type = 'error'), q AS (SELECT *, {_START.format("ts")} AS b FROM p, {_GRAIN_LIST})
    SELECT entity_type, entity_id, g AS bucket_granularity, strftime(b, '%Y-%m-%d %H:%M:%S') AS bucket_start,
    strftime(CASE g WHEN 'all' THEN TIMESTAMP '2999-12-31 00:00:00' WHEN 'day' THEN b + INTERVAL 1 DAY WHEN 'week' THEN b + INTERVAL 7 DAY WHEN 'month' THEN b + INTERVAL 1 MONTH ELSE b + INTERVAL 1 YEAR END, '%Y-%m-%d %H:%M:%S') AS bucket_end,
    count(DISTINCT event_id) AS alerts_count, round(sum(value), 2) AS alerts_value_sum, count(DISTINCT CASE WHEN value > 200 THEN event_id END) AS investigations_count FROM q GROUP BY ALL"""
)
def view_10_alert_history(spark, d):
    alerts = _detail(spark, d).where("tx_type = 'error'").withColumns({"alert_id": F.col("transaction_id"), "event_ts": F.col("tx_event_ts"), "tx_amount": F.col("instructed_amount")})
    out = views.alert_history(alerts)
    return out.select("entity_type", "entity_id", "bucket_granularity", text("bucket_start").alias("bucket_start"), text("bucket_end").alias("bucket_end"), "alerts_count", F.round("alerts_value_sum", 2).alias("alerts_value_sum"), "investigations_count")


@query(
    f"""WITH c AS (SELECT event_id AS cond, ts AS starts, CASE WHEN event_id % 20 = 0 THEN NULL ELSE ts + INTERVAL 3 HOUR END AS ends, g, {_START.format("ts")} AS b FROM events, {_GRAIN_LIST} WHERE event_type = 'signup'),
    t AS (SELECT event_id, ts, g, {_START.format("ts")} AS b FROM events, {_GRAIN_LIST} WHERE event_type = 'purchase')
    SELECT cond, c.g AS bucket_granularity, strftime(c.b, '%Y-%m-%d %H:%M:%S') AS bucket_start, t.event_id, sha256(cond || '||' || c.g || '||' || strftime(c.b, '%Y-%m-%d %H:%M:%S') || '||' || coalesce(CAST(t.event_id AS VARCHAR), 'NO_TX')) AS pk
    FROM c LEFT JOIN t ON c.g = t.g AND c.b = t.b AND t.ts >= starts AND (ends IS NULL OR t.ts <= ends)"""
)
def view_11_conditions_timeline(spark, d):
    """All conditions at all granularities."""
    conds = table(spark, d, "events").where("event_type = 'signup'").select(
        F.col("event_id").alias("cond"), F.col("event_id").cast("string").alias("pk"), F.lit("T1").alias("tenant_id"), F.col("ts").alias("condition_inception_ts"), F.when(F.col("event_id") % 20 != 0, F.col("ts") + F.expr("INTERVAL 3 HOUR")).alias("condition_expiry_ts"), F.lit("purchase,none").alias("event_types_csv")
    )
    tx = _detail(spark, d).where("tx_type in ('purchase', 'click')")
    return views.conditions_timeline(conds, tx).select("cond", "bucket_granularity", F.col("bucket_text").alias("bucket_start"), F.col("transaction_id").cast("long").alias("event_id"), "pk")


@query(
    """WITH s AS (SELECT date_trunc('hour', ts) AS b, count(*) AS r, count(*) FILTER (event_type <> 'error') AS e, avg(value) FILTER (event_type <> 'error' AND value >= 0) AS l FROM events GROUP BY 1), m AS (SELECT avg(r) AS mean, stddev_samp(r) AS dev FROM s),
    c AS (SELECT b, concat_ws(',', CASE WHEN r / nullif(e, 0) * 100 NOT BETWEEN 80 AND 130 THEN 'RATE' END, CASE WHEN l > 60 THEN 'LATENCY' END, CASE WHEN r < mean - dev THEN 'THROUGHPUT' END) AS reasons FROM s, m)
    SELECT strftime(b, '%Y-%m-%d %H:%M:%S') AS time_bucket, reasons FROM c WHERE reasons <> ''"""
)
def met_14_anomalies(spark, d):
    events = table(spark, d, "events")
    series = metrics.throughput(events, "ts", events.where("event_type <> 'error'"), "ts", "hour", "value")
    return metrics.anomalies(series, metrics.Limits((80.0, 130.0), 60.0, 1.0)).select(text("time_bucket").alias("time_bucket"), F.array_join("reasons", ",").alias("reasons"))


@query("WITH h AS (SELECT date_trunc('hour', ts) AS b, count(*) AS r, count(*) FILTER (event_type <> 'error') AS e FROM events GROUP BY 1) SELECT max(r) AS peak, CAST(sum(r) AS BIGINT) AS received, CAST(sum(e) AS BIGINT) AS evaluated, round(max(r) / 0.6, 6) AS capacity, 75.0 - CASE WHEN sum(r) / sum(e) * 100 BETWEEN 95 AND 105 THEN 0 ELSE 25 END AS health_pct FROM h")
def met_15_health(spark, d):
    events = table(spark, d, "events")
    series = metrics.throughput(events, "ts", events.where("event_type <> 'error'"), "ts", "hour", "value")
    return metrics.health(series).select("peak", "received", "evaluated", F.round("capacity", 6).alias("capacity"), "health_pct")


@query(
    """WITH x AS (SELECT o_orderdate - to_hours(CAST(l_partkey % 100 AS BIGINT) - 20) AS alerted, o_orderdate AS made, l_shipdate AS done FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT round(avg(CASE WHEN made >= alerted THEN date_diff('hour', alerted, made) END), 6) AS detection_hours, round(avg(CASE WHEN done >= made THEN date_diff('hour', made, done) END), 6) AS resolution_hours FROM x"""
)
def met_18_resolution(spark, d):
    """Alerts lie up to 79 hours before their case, or up to 20 behind it, which do not count."""
    rows = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.withColumn("alerted", F.timestamp_millis(F.unix_millis("o_orderdate") - (F.col("l_partkey") % 100 - 20) * 3_600_000))
    return metrics.resolution(rows, "alerted", "o_orderdate", "l_shipdate").select(F.round("detection_hours", 6).alias("detection_hours"), F.round("resolution_hours", 6).alias("resolution_hours"))


@query("WITH c AS (SELECT o_custkey AS case_id, max(CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 2 ELSE 1 END) AS r FROM orders GROUP BY 1) SELECT case_id, CASE r WHEN 3 THEN 'FRAUD_AND_AML' WHEN 2 THEN 'FRAUD' ELSE 'AML' END AS category FROM c")
def met_17_categories(spark, d):
    s = F.col("o_orderstatus")
    alerts = table(spark, d, "orders").select(F.col("o_custkey").alias("case_id"), F.when(s == "F", "FRAUD_AND_AML").when(s == "O", "FRAUD").otherwise("AML").alias("alert_type_norm"))
    return metrics.case_categories(alerts)


@query("WITH t AS (SELECT event_type, count(*) FILTER (value > 100) AS fired FROM events GROUP BY 1) SELECT event_type, fired, CASE WHEN fired - 100 >= 10 THEN 'INCREASE' WHEN fired - 100 > -10 THEN 'RETAIN' ELSE 'DECREASE' END AS advice, CASE WHEN abs(fired - 100) < 10 THEN 50 ELSE greatest(0, 50 + fired - 100) END AS new_weight FROM t")
def ml_09_weights(spark, d):
    rows = table(spark, d, "events").groupBy("event_type").agg(F.count_if(F.col("value") > 100).alias("fired")).withColumns({"weight": F.lit(50).cast("long"), "coef": (F.col("fired") - 100) / 100.0 + F.signum(F.col("fired") - 100) * 1e-9})
    return calibration.weight_advice(rows, "weight", "coef").select("event_type", "fired", "advice", "new_weight")


@query("SELECT s_nationkey, count(*) AS n FROM supplier WHERE s_nationkey = 7 GROUP BY 1")
def api_02_sql(spark, d):
    service = QueryService(spark, {"supplier": f"{d}/supplier.parquet"}, "7", ("s_nationkey",))
    return service.sql("SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1")


@query(f"SELECT event_id, count(*) OVER (PARTITION BY json_extract_string(props, '$.k') ORDER BY {_MS} RANGE BETWEEN 28800000 PRECEDING AND CURRENT ROW) AS recent_count FROM events")
def rule_016_creditor_window(spark, d):
    rows = table(spark, d, "events").withColumn("account", F.get_json_object("props", "$.k"))
    return evidence.recent_count(rows, ["account"], "ts", 28_800_000).select("event_id", "recent_count")


@query(
    """SELECT event_id, CAST(year(ts) - year(born) - CASE WHEN month(ts) < month(born) OR (month(ts) = month(born) AND day(ts) < day(born)) THEN 1 ELSE 0 END AS INTEGER) AS years
    FROM (SELECT event_id, ts, DATE '1960-01-01' + CAST(event_id * 37 % 18000 AS INTEGER) AS born FROM events)"""
)
def rule_028_age(spark, d):
    """All events, each with a birth date of its own."""
    born = F.date_add(F.lit("1960-01-01").cast("date"), (F.col("event_id") * 37 % 18000).cast("int"))
    rows = table(spark, d, "events").withColumn("doc", F.to_json(F.struct(F.struct(born.cast("string").alias("BirthDt")).alias("a"))))
    return rows.select("event_id", evidence.age_in_years("doc", "$.a.BirthDt", F.to_date("ts")).alias("years"))


@query("SELECT event_type, count(*) AS n, count(*) FILTER (json_extract_string(props, '$.k') IS NOT NULL) AS with_k FROM events GROUP BY 1")
def agg_17_coverage(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count(F.get_json_object("props", "$.k")).alias("with_k"))


# ------------------------------------------------------------------ names of the former round for what does the whole job now; second names, not further queries

for _name, _now in (
    ("join_09_whole", "join_09_bucket_interval"),
    ("agg_01_whole", "agg_01_edges"),
    ("snk_01_whole", "snk_01_upsert"),
    ("doc_01_whole", "doc_01_pipeline"),
    ("view_06_whole", "view_06_history"),
    ("view_07_whole", "view_07_account_edges"),
    ("view_09_whole", "view_09_holder_links"),
    ("view_11_whole", "view_11_conditions_timeline"),
    ("rule_028_whole", "rule_028_age"),
):
    QUERIES[_name] = QUERIES[_now]
    if _now in SQL:
        SQL[_name] = SQL[_now]
