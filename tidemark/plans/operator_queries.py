"""Operators that no other query reaches, each with its SQL: landed JSON, versions, rule configuration, merged rules, fraud series, approximate quantiles."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import times
from tidemark.operators import columns
from tidemark.plans import evidence, fraud_series
from tidemark.plans.executive_queries import STAR, cases
from tidemark.plans.queries import _MS, query, r8, scratch, table, text
from tidemark.sources import readers
from tidemark.sources.sinks import append_json


@query("SELECT event_type, count(*) AS n, round(sum(value), 2) AS amount, count(DISTINCT user_id) AS users, true AS has_lineage FROM events GROUP BY 1")
def src_01_json_lines(spark, d):
    """All events as landed JSON lines, read back with a declared schema, load time and file."""
    folder = scratch(spark, "src_01") + "/events"
    append_json(table(spark, d, "events").withColumn("ts", text("ts")), folder)
    rows = readers.json_objects(spark, folder, "event_id long, ts timestamp, user_id long, event_type string, value double, props string, absent string")
    lineage = F.bool_and(F.col("source_file_path").isNotNull() & F.col("ingested_at_ts").isNotNull() & F.col("absent").isNull())
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("amount"), F.count_distinct("user_id").alias("users"), lineage.alias("has_lineage"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'closed' WHEN o_orderkey % 3 = 1 THEN 'second' ELSE 'first' END AS state FROM orders")
def src_05_latest_version(spark, d):
    """Rows of several commits, of which the last of a key counts; within a commit the last in sequence. Meta columns go."""
    orders = table(spark, d, "orders").select("o_orderkey")
    version = lambda rows, state, time, number: rows.select("o_orderkey", F.lit(state).alias("state"), F.lit(time).alias("_commit_time"), F.format_string("%s_%02d", F.lit(time), F.lit(number)).alias("_commit_seqno"))
    kept, absent = version(orders, "first", "1", 1), readers.if_present(spark, f"{d}/no_such_table.parquet")
    assert absent is None
    rows = kept.unionByName(version(orders.where("o_orderkey % 3 = 1"), "second", "1", 2)).unionByName(version(orders.where("o_orderkey % 3 = 0"), "closed", "2", 1))
    return columns.drop_meta(readers.latest_version(rows, "o_orderkey"))


@query(
    """SELECT p_partkey, kind, CASE WHEN kind = 'EXIT' THEN '.x' WHEN i = 0 THEN '.01' ELSE '.02' END AS sub_rule_ref, CASE kind WHEN 'EXIT' THEN 'no history' ELSE p_brand END AS reason,
    CASE WHEN kind = 'BAND' AND i = 1 THEN CAST(p_size AS DOUBLE) END AS lower_limit, CASE WHEN kind = 'BAND' AND i = 0 THEN CAST(p_size AS DOUBLE) END AS upper_limit
    FROM part, (VALUES ('BAND', 0), ('BAND', 1), ('EXIT', 0)) AS b(kind, i) WHERE p_size % 4 <> 0
    UNION ALL SELECT p_partkey, NULL, NULL, NULL, NULL, NULL FROM part WHERE p_size % 4 = 0"""
)
def rule_cfg_bands(spark, d):
    """Bands and exit conditions of each rule's newest configuration; an older one loses, rules without any keep a row."""
    size, band = F.col("p_size").cast("double"), lambda ref, low, high: F.struct(F.lit(ref).alias("subRuleRef"), F.col("p_brand").alias("reason"), low.alias("lowerLimit"), high.alias("upperLimit"))
    none, parts = F.lit(None).cast("double"), table(spark, d, "part")
    some = F.col("p_size") % 4 != 0
    rules = parts.select(
        F.lit("T1").alias("tenant_id"), F.col("p_partkey").alias("rule_id"), F.lit("1").alias("rule_cfg"), F.lit(1000).alias("max_query_range_ms"), F.lit("2024-01-02").cast("timestamp").alias("rule_updated_ts"), F.lit("h").alias("record_hash"),
        F.when(some, F.to_json(F.array(band(".01", none, size), band(".02", size, none)))).alias("bands_json"), F.when(some, F.to_json(F.array(F.struct(F.lit(".x").alias("subRuleRef"), F.lit("no history").alias("reason"))))).alias("exit_conditions_json"),
    )
    older = rules.withColumns({"rule_updated_ts": F.lit("2023-01-01").cast("timestamp"), "bands_json": F.lit('[{"subRuleRef": "old"}]')})
    return evidence.bands(rules.unionByName(older)).select(F.col("rule_id").alias("p_partkey"), "kind", "sub_rule_ref", "reason", "lower_limit", "upper_limit")


@query(
    """WITH r AS (SELECT l_orderkey, 'r' || l_suppkey % 5 AS id, CAST(l_quantity AS BIGINT) AS w, '.0' || l_linenumber % 2 AS ref FROM lineitem),
    b AS (SELECT l_orderkey, id, max(w) AS w, arg_min(ref, (-w, ref)) AS ref FROM r GROUP BY ALL)
    SELECT l_orderkey, string_agg(id || '=' || w || ref, ',' ORDER BY w DESC, id, ref) AS merged, CASE WHEN l_orderkey % 2 = 0 THEN '.over' END AS override FROM b GROUP BY l_orderkey"""
)
def rule_merge(spark, d):
    """Rules of all typologies of an alert with the largest weight of each; the override rule stands apart."""
    rule = F.struct(F.concat(F.lit("r"), F.col("l_suppkey") % 5).alias("id"), F.col("l_quantity").cast("bigint").alias("wght"), F.concat(F.lit(".0"), F.col("l_linenumber") % 2).alias("subRuleRef"))
    lists = table(spark, d, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.collect_list(rule).alias("ruleResults"))
    override = F.when(F.col("l_orderkey") % 2 == 0, F.array(F.struct(F.lit("EFRuP@1.0.0").alias("id"), F.lit(0).cast("bigint").alias("wght"), F.lit(".over").alias("subRuleRef"))))
    lists = lists.withColumn("ruleResults", F.concat("ruleResults", F.coalesce(override, F.array().cast("array<struct<id:string,wght:bigint,subRuleRef:string>>"))))
    results = lists.groupBy("l_orderkey").agg(F.collect_list(F.struct("ruleResults")).alias("results"))
    out = results.select("l_orderkey", *[c.alias(n) for n, c in evidence.merge_rules(F.col("results")).items()])
    merged = F.array_join(F.transform("merged_rules", lambda r: F.concat(r["id"], F.lit("="), -r["w"], r["ref"])), ",")
    return out.select("l_orderkey", merged.alias("merged"), F.col("override_rule").alias("override"))


@query("SELECT o_orderkey, coalesce(o_totalprice, 0) >= coalesce(CASE WHEN o_custkey % 3 <> 0 THEN o_custkey * 1000.0 END, 10000) AS over FROM orders")
def rule_091_configured(spark, d):
    """Amounts against a threshold of each customer's own, or the fallback."""
    return table(spark, d, "orders").select("o_orderkey", evidence.over_threshold(F.col("o_totalprice"), F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey") * 1000.0)).alias("over"))


@query(
    f"""SELECT event_id, coalesce({_MS} - max({_MS}) OVER (PARTITION BY json_extract_string(props, '$.k') ORDER BY {_MS} RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gap_ms,
    count(*) OVER (PARTITION BY json_extract_string(props, '$.k') ORDER BY {_MS} RANGE UNBOUNDED PRECEDING) AS lifetime_count FROM events"""
)
def rule_004_045_creditor(spark, d):
    """Gap and history of the receiving account."""
    rows = table(spark, d, "events").withColumns({"account": F.get_json_object("props", "$.k"), "ms": F.unix_millis("ts")})
    return evidence.lifetime_count(evidence.gap_before(rows, ["account"], "ts"), ["account"], "ms").select("event_id", "gap_ms", "lifetime_count")


@query("SELECT json_extract_string(props, '$.k') AS party, count(DISTINCT user_id) AS accounts FROM events GROUP BY 1")
def rule_084_creditor_accounts(spark, d):
    return evidence.accounts_per_party(table(spark, d, "events").withColumn("party", F.get_json_object("props", "$.k")), "party", "user_id")


@query("SELECT event_type, count(*) AS n, quantile_disc(value, 0.05) AS p05, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95 FROM events GROUP BY 1")
def agg_12_quantiles(spark, d):
    """Approximate quantiles with an accuracy of ten thousand: exact on groups of up to some thousands of rows."""
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), *[F.percentile_approx("value", p, 10_000).alias(n) for n, p in (("p05", 0.05), ("p50", 0.5), ("p95", 0.95))])


@query(
    """WITH m AS (SELECT date_trunc('month', ts) AS p, event_type, count(*) AS n FROM events GROUP BY ALL), b AS (SELECT *, lag(n) OVER (PARTITION BY event_type ORDER BY p) AS before FROM m)
    SELECT event_type, strftime(p, '%Y-%m') AS period, n, round(CASE WHEN coalesce(before, 0) = 0 THEN 0.0 ELSE (n - before) / before * 100 END, 6) AS change_pct, CASE WHEN coalesce(before, 0) = 0 THEN 'flat' WHEN (n - before) / before * 100 > 5 THEN 'up' WHEN (n - before) / before * 100 < -5 THEN 'down' ELSE 'flat' END AS trend FROM b"""
)
def met_29_changes(spark, d):
    """Change and trend of monthly counts."""
    monthly = table(spark, d, "events").groupBy("event_type", times.bucket(F.col("ts"), "month").alias("p")).agg(F.count("*").alias("n"))
    before = F.lag("n").over(Window.partitionBy("event_type").orderBy("p"))  # a row per month
    out = monthly.withColumn("before", before)
    return out.select("event_type", F.date_format("p", "yyyy-MM").alias("period"), "n", F.round(times.pct_change(F.col("n"), F.col("before")), 6).alias("change_pct"), times.trend(F.col("n"), F.col("before"), 5.0).alias("trend"))


@query(
    f"""{STAR}, raw AS (SELECT l_tax, l_discount, l_quantity, l_returnflag, l_extendedprice, l_shipdate FROM lineitem),
    a AS (SELECT date_trunc('month', l_shipdate) AS p, CASE WHEN l_tax > 0.02 THEN 'ALRT' ELSE 'NALT' END AS s, l_tax > 0.02 AND l_discount > 0.05 AS i, l_quantity > 40 AS b, CASE l_returnflag WHEN 'A' THEN 'AML' WHEN 'N' THEN 'FRAUD' ELSE 'FRAUD_AND_AML' END AS k,
      CASE WHEN l_tax > 0.055 THEN 'TP' WHEN l_tax > 0.035 THEN 'FP' WHEN l_tax > 0.015 THEN 'FN' ELSE 'TN' END AS o, CASE WHEN l_quantity > 25 THEN l_extendedprice END AS v, l_quantity AS q FROM raw WHERE year(l_shipdate) = 1997),
    e AS (SELECT p, count(*) AS tx_evaluated, count(*) FILTER (s = 'ALRT') AS tx_alerted, count(*) FILTER (s = 'ALRT' AND k = 'AML') AS aml_alerts, count(*) FILTER (s = 'ALRT' AND k = 'FRAUD') AS fraud_alerts, count(*) FILTER (i) AS interdiction_alerts, count(*) FILTER (b) AS blocking_alerts,
      count(*) FILTER (o = 'TP') AS tp, count(*) FILTER (o = 'FP') AS fp, count(*) FILTER (o = 'TN') AS tn, count(*) FILTER (o = 'FN') AS fn, round(avg(q), 8) AS avg_total_processing_ms, coalesce(sum(v) FILTER (o IN ('TP', 'FN')), 0) AS fv, coalesce(sum(v) FILTER (o = 'TP' AND i), 0) AS pv FROM a GROUP BY 1),
    c AS (SELECT date_trunc('month', case_updated_ts) AS p, avg(created_to_updated_ms) / 86400000 AS d FROM cases WHERE year(case_updated_ts) = 1997 AND status IN ('STATUS_81_CLOSED_REFUTED', 'STATUS_82_CLOSED_CONFIRMED', 'STATUS_83_CLOSED_INCONCLUSIVE', 'STATUS_71_AUTOCLOSED_CONFIRMED', 'STATUS_72_AUTOCLOSED_REFUTED') GROUP BY 1)
    SELECT strftime(e.p, '%Y-%m') AS period, e.* EXCLUDE (p, fv, pv), round(fv, 2) AS total_fraud_value, round(pv, 2) AS prevented_fraud_value, round(tx_alerted / tx_evaluated, 8) AS evaluated_alert_rate, round(interdiction_alerts / tx_evaluated, 8) AS interdiction_rate, round(CASE WHEN tx_alerted = 0 THEN 0 ELSE blocking_alerts / tx_alerted END, 8) AS block_rate,
      round((tp + fn) / tx_evaluated, 8) AS fraud_rate, round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 8) AS precision, round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 8) AS recall, round(CASE WHEN fp + tn = 0 THEN 0 ELSE fp / (fp + tn) END, 8) AS fpr, round(CASE WHEN tp + fn = 0 THEN 0 ELSE fn / (tp + fn) END, 8) AS manual_detection_rate,
      round(coalesce(c.d, 0), 8) AS mttd_days, round((aml_alerts / tx_evaluated - lag(aml_alerts / tx_evaluated) OVER w) / nullif(lag(aml_alerts / tx_evaluated) OVER w, 0) * 100, 6) AS aml_alert_velocity_pct, round((fraud_alerts / tx_evaluated - lag(fraud_alerts / tx_evaluated) OVER w) / nullif(lag(fraud_alerts / tx_evaluated) OVER w, 0) * 100, 6) AS fraud_alert_velocity_pct
    FROM e LEFT JOIN c ON e.p = c.p WINDOW w AS (ORDER BY e.p)"""
)
def met_05_series(spark, d):
    """The whole fraud trend of a year by month, blocking told by a condition of the caller's, interdiction by the default one."""
    items = table(spark, d, "lineitem").selectExpr("concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS item", "l_tax", "l_discount", "l_quantity", "l_returnflag", "l_extendedprice", "l_shipdate")
    kind = F.when(F.col("l_returnflag") == "A", "AML").when(F.col("l_returnflag") == "N", "fraud").otherwise("FRAUD_AND_AML")
    outcome = F.when(F.col("l_tax") > 0.055, "TRUE_POSITIVE").when(F.col("l_tax") > 0.035, "FALSE_POSITIVE").when(F.col("l_tax") > 0.015, "FALSE_NEGATIVE").otherwise("TRUE_NEGATIVE")
    rows = items.select(
        F.col("l_shipdate").alias("created_at_ts"), F.col("l_shipdate").alias("event_ts"), kind.alias("alert_type_norm"), outcome.alias("prediction_outcome_norm"), F.when(F.col("l_tax") > 0.02, "ALRT").otherwise("NALT").alias("alert_status"),
        F.when(F.col("l_discount") > 0.05, "BREACH").alias("priority_norm"), F.when(F.col("l_quantity") > 25, F.col("l_extendedprice")).alias("tx_amount"), F.lit(None).cast("long").alias("event_to_ingest_ms"), F.col("l_quantity").alias("total_processing_time_ms"), "l_quantity",
    )
    out = fraud_series.fraud_series(rows, cases(spark, d), "month", date(1997, 1, 1), date(1997, 12, 31), blocked=F.col("l_quantity") > 40)
    rates = ["avg_total_processing_ms", "evaluated_alert_rate", "interdiction_rate", "block_rate", "fraud_rate", "precision", "recall", "fpr", "manual_detection_rate", "mttd_days"]
    counts = ["tx_evaluated", "tx_alerted", "aml_alerts", "fraud_alerts", "interdiction_alerts", "blocking_alerts", "tp", "fp", "tn", "fn"]
    return out.select(F.date_format("period", "yyyy-MM").alias("period"), *counts, *[r8(c).alias(c) for c in rates], *[F.round(c, 2).alias(c) for c in ("total_fraud_value", "prevented_fraud_value")], *[F.round(c, 6).alias(c) for c in ("aml_alert_velocity_pct", "fraud_alert_velocity_pct")])
