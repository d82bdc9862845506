"""Metric families. Each is one pass of conditional aggregates over a table, not a query per number."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import bucket, millis_between
from tidemark.operators.aggregates import confusion, share
from tidemark.operators.windows import period_change, share_of_total

#: Presets of what counts as a closed case.
CLOSED_SET = ("STATUS_71_AUTOCLOSED_CONFIRMED", "STATUS_72_AUTOCLOSED_REFUTED", "STATUS_81_CLOSED_REFUTED", "STATUS_82_CLOSED_CONFIRMED", "STATUS_83_CLOSED_INCONCLUSIVE", "STATUS_99_ABANDONED")
AGE_BUCKETS = ((7, "0-7"), (14, "8-14"), (30, "15-30"), (60, "31-60"))


def closed(status: Column, preset: str = "set") -> Column:
    """``set``: one of the final statuses; ``like``: CLOSED, COMPLETE or DISPOSED in the name; ``contains``: CLOSED in the name."""
    s = F.upper(status)
    return {"set": s.isin(*CLOSED_SET), "like": s.like("%CLOSED%") | s.like("%COMPLETE%") | s.like("%DISPOSED%"), "contains": s.contains("CLOSED")}[preset]


def age_bucket(days: Column) -> Column:
    out = F.lit("60+")
    for most, name in reversed(AGE_BUCKETS):
        out = F.when(days <= most, name).otherwise(out)
    return out


def period_rates(df: DataFrame, ts: str, grain: str, counts: dict[str, Column], rates: dict[str, tuple[str, str]] | None = None, change: list[str] | None = None) -> DataFrame:
    """A row per period with conditional counts, rates of two counts and change against the period before."""
    out = df.groupBy(bucket(F.col(ts), grain).alias("period")).agg(F.count("*").alias("total"), *[F.count_if(t).alias(n) for n, t in counts.items()])
    out = out.withColumns({n: share(F.col(a), F.col(b)) for n, (a, b) in (rates or {}).items()}) if rates else out
    return period_change(out, "period", change) if change else out


def fraud_trend(alerts: DataFrame, grain: str = "week", interdicted: Column | None = None, blocked: Column | None = None) -> DataFrame:
    """Alerts by type and outcome with precision, recall, F1 and false-positive rate per period, with change."""
    rows = alerts.withColumn("period", bucket(F.col("event_ts"), grain))
    kind = F.col("alert_type_norm")
    out = rows.groupBy("period").agg(
        F.count("*").alias("alerts"), F.count_if(kind.isin("FRAUD", "FRAUD_AND_AML")).alias("fraud_alerts"), F.count_if(kind.isin("AML", "FRAUD_AND_AML")).alias("aml_alerts"), *confusion(F.col("prediction_outcome_norm")),
        F.count_if(F.coalesce(interdicted, F.lit(False)) if interdicted is not None else F.lit(False)).alias("interdicted"), F.count_if(F.coalesce(blocked, F.lit(False)) if blocked is not None else F.lit(False)).alias("blocked"),
        F.sum(F.when(F.col("prediction_outcome_norm") == "TRUE_POSITIVE", F.coalesce("tx_amount", F.lit(0.0))).otherwise(0.0)).alias("confirmed_value"),
    )
    out = out.withColumns({"interdiction_rate": share(F.col("interdicted"), F.col("alerts")), "block_rate": share(F.col("blocked"), F.col("alerts"))})
    return period_change(out, "period", ["alerts", "tp", "fp"])


def case_inventory(cases: DataFrame, by: str, preset: str = "set") -> DataFrame:
    """Open, closed and all cases by a column, with the share of all."""
    done = F.coalesce(closed(F.col("status"), preset), F.lit(False))
    out = cases.groupBy(by).agg(F.count("*").alias("cases"), F.count_if(~done).alias("open_cases"), F.count_if(done).alias("closed_cases"))
    return share_of_total(out, "cases")


def case_categories(alerts: DataFrame) -> DataFrame:
    """Category per case: the highest of its alerts' types, FRAUD_AND_AML over FRAUD over AML."""
    rank = F.when(F.col("alert_type_norm") == "FRAUD_AND_AML", 3).when(F.col("alert_type_norm") == "FRAUD", 2).when(F.col("alert_type_norm") == "AML", 1).otherwise(0)
    top = alerts.where("case_id is not null").groupBy("case_id").agg(F.max(rank).alias("r"))
    return top.select("case_id", F.when(F.col("r") == 3, "FRAUD_AND_AML").when(F.col("r") == 2, "FRAUD").when(F.col("r") == 1, "AML").otherwise("UNKNOWN").alias("category"))


def task_workload(tasks: DataFrame, by: str) -> DataFrame:
    return tasks.groupBy(by).agg(F.count("*").alias("tasks"), F.count_if(F.col("is_completed") == 1).alias("completed"), F.count_if(F.col("sla_breached") == 1).alias("breached"), (F.avg("task_duration_ms") / 3_600_000).alias("avg_hours"))


def case_ages(cases: DataFrame, now: Column, created: str, is_open: Column) -> DataFrame:
    """Open cases by age bucket."""
    days = F.floor((F.unix_timestamp(now) - F.unix_timestamp(created)) / 86400)
    return cases.where(is_open).groupBy(age_bucket(days).alias("age_bucket")).agg(F.count("*").alias("cases"))


def high_value(df: DataFrame, value: str, threshold: float, order: list[Column], k: int = 10) -> DataFrame:
    return df.where(F.col(value) >= threshold).orderBy(F.desc(value), *order).limit(k)


def inflow_outflow(opened: DataFrame, opened_ts: str, closed_df: DataFrame, closed_ts: str, grain: str) -> DataFrame:
    """Opened and closed per period, 0 where a period has only the other."""
    a = opened.groupBy(bucket(F.col(opened_ts), grain).alias("period")).agg(F.count("*").alias("opened"))
    b = closed_df.groupBy(bucket(F.col(closed_ts), grain).alias("period")).agg(F.count("*").alias("closed"))
    return a.join(b, "period", "full").fillna(0, ["opened", "closed"]).withColumn("net", F.col("opened") - F.col("closed"))


def throughput(received: DataFrame, received_ts: str, evaluated: DataFrame, evaluated_ts: str, grain: str = "hour", latency: str | None = None) -> DataFrame:
    """Received and evaluated per bucket, their rate in per cent (null if none was evaluated), latency of non-negative rows.

    Both percentiles are exact, the 95th between values and the 99th one of them; Spark keeps a count for each different value of a bucket.
    """
    a = received.groupBy(bucket(F.col(received_ts), grain).alias("time_bucket")).agg(F.count("*").alias("received"))
    known = f"CASE WHEN `{latency}` >= 0 THEN `{latency}` END"
    extra = [F.expr(f"avg({known})").alias("avg_latency"), F.expr(f"percentile({known}, 0.95)").alias("p95_latency"), F.expr(f"percentile_disc(0.99) WITHIN GROUP (ORDER BY {known})").alias("p99_latency"), F.count_if(F.col(latency) < 0).alias("negative")] if latency else []
    b = evaluated.groupBy(bucket(F.col(evaluated_ts), grain).alias("time_bucket")).agg(F.count("*").alias("evaluated"), *extra)
    out = a.join(b, "time_bucket", "left").withColumn("evaluated", F.coalesce("evaluated", F.lit(0)))
    return out.withColumn("rate_pct", F.when(F.col("evaluated") == 0, F.lit(None)).otherwise(F.col("received") / F.col("evaluated") * 100))


@dataclass(frozen=True)
class Limits:
    rate: tuple[float, float] = (95.0, 105.0)
    latency: float = 5.0
    sigmas: float = 2.0


def anomalies(series: DataFrame, limits: Limits = Limits()) -> DataFrame:  # noqa: B008
    """Buckets whose rate, latency or throughput is out of bounds, with reason codes; the bounds of throughput are the series' own mean and deviation."""
    stats = series.agg(F.avg("received").alias("m"), F.coalesce(F.stddev("received"), F.lit(0.0)).alias("s"))
    m, s = stats.first() or (0.0, 0.0)  # one row
    codes = {"RATE": ~F.col("rate_pct").between(*limits.rate), "LATENCY": F.col("avg_latency") > limits.latency, "THROUGHPUT": F.col("received") < (m or 0.0) - limits.sigmas * (s or 0.0)}
    reasons = F.filter(F.array(*[F.when(t, F.lit(c)) for c, t in codes.items()]), lambda x: x.isNotNull())
    return series.withColumn("reasons", reasons).where(F.size("reasons") > 0)


def health(series: DataFrame, headroom: float = 0.4, limits: Limits = Limits()) -> DataFrame:  # noqa: B008
    """Peak and capacity, and the share of four conditions that hold, as one row."""
    one = series.agg(F.max("received").alias("peak"), F.sum("received").alias("received"), F.sum("evaluated").alias("evaluated"), F.avg("avg_latency").alias("latency"), F.sum("negative").alias("negative"))
    rate = share(F.col("received"), F.col("evaluated")) * 100
    good = [rate.between(*limits.rate), F.coalesce("latency", F.lit(0.0)) <= limits.latency, F.coalesce("negative", F.lit(0)) == 0, F.col("evaluated") > 0]
    return one.withColumns({"capacity": F.col("peak") / (1 - headroom), "health_pct": sum([g.cast("int") for g in good[1:]], good[0].cast("int")) / len(good) * 100})


def productivity(cases: DataFrame, owner: str, preset: str = "set") -> DataFrame:
    """Workload, closure and confirmation rates and a tier per owner."""
    done = F.coalesce(closed(F.col("status"), preset), F.lit(False))
    out = cases.where(F.col(owner).isNotNull()).groupBy(owner).agg(F.count("*").alias("cases"), F.count_if(done).alias("closed_cases"), F.count_if(F.upper("status").contains("CONFIRMED")).alias("confirmed_cases"))
    out = out.withColumns({"closure_rate": share(F.col("closed_cases"), F.col("cases")) * 100, "confirmation_rate": share(F.col("confirmed_cases"), F.col("closed_cases")) * 100})
    return out.withColumn("tier", F.when(F.col("closure_rate") >= 80, "HIGH").when(F.col("closure_rate") >= 50, "MEDIUM").otherwise("LOW"))


def daily_cases(cases: DataFrame, created: str, owner: str, value: str, preset: str = "set") -> DataFrame:
    """Case metrics per day in one pass."""
    done = F.coalesce(closed(F.col("status"), preset), F.lit(False))
    return cases.groupBy(F.to_date(created).alias("metric_date")).agg(
        F.count("*").alias("new_cases"), F.count_if(done).alias("closed_cases"), F.count_if(~done).alias("open_cases"), F.count_distinct(F.when(~done, F.col(owner))).alias("active_owners"),
        F.sum(F.when(~done, F.coalesce(value, F.lit(0.0))).otherwise(0.0)).alias("value_at_risk"), share(F.count_if(done), F.count("*")).alias("closure_rate"),
    )


def roll_up(hourly: DataFrame, ts: str, grain: str, sums: list[str], weighted: dict[str, str] | None = None) -> DataFrame:
    """Coarser buckets: sums of counts, averages weighted by a count."""
    return hourly.groupBy(bucket(F.col(ts), grain).alias("period")).agg(*[F.sum(c).alias(c) for c in sums], *[share(F.sum(F.col(a) * F.col(w)), F.sum(w)).alias(a) for a, w in (weighted or {}).items()])


def resolution(cases: DataFrame, alert_ts: str, created: str, closed_at: str) -> DataFrame:
    """Mean hours from alert to case and from case to end, over rows where both ends are known and in order."""
    lag, work = millis_between(F.col(alert_ts), F.col(created)) / 3_600_000, millis_between(F.col(created), F.col(closed_at)) / 3_600_000
    return cases.agg(F.avg(F.when(lag >= 0, lag)).alias("detection_hours"), F.avg(F.when(work >= 0, work)).alias("resolution_hours"))


def rank_by(df: DataFrame, metric: str, ascending: bool, tie: str) -> DataFrame:
    from pyspark.sql import Window

    order = [F.asc(metric) if ascending else F.desc(metric), F.asc(tie)]
    return df.withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # aggregated rows


def kpi_status(value: Column, good: float, fair: float, higher_is_better: bool = True) -> Column:
    if higher_is_better:
        return F.when(value >= good, "good").when(value >= fair, "fair").otherwise("poor")
    return F.when(value <= good, "good").when(value <= fair, "fair").otherwise("poor")
