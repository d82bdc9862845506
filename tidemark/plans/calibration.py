"""Calibration of thresholds and weights."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.aggregates import share
from tidemark.operators.joins import either_key
from tidemark.operators.quantiles import bounds, discrete_quantiles
from tidemark.operators.windows import running_in_slices
from tidemark.sources.written import Written


def payment_features(df: DataFrame, amount: str, ts: str, sender: str, receiver: str, priority: Column | None = None, rule: dict[str, Column] | None = None, typology: dict[str, Column] | None = None) -> DataFrame:
    """Fourteen features of payments: amount, time and bank; the alert's priority; configuration of its rule and typology (missing: 0).

    ``rule`` gives ``band_count`` and ``bands_json``, ``typology`` gives
    ``alert_threshold``, ``rule_count`` and ``first_weight``. Payments per
    sender are counted before the shuffle and joined back, so a sender with much
    of the table is no task's alone.
    """
    zero = lambda c: F.coalesce(F.lit(0.0) if c is None else c.cast("double"), F.lit(0.0))
    a, rule, typology = F.coalesce(amount, F.lit(0.0)), rule or {}, typology or {}
    limit = lambda k: None if rule.get("bands_json") is None else F.get_json_object(rule["bands_json"], f"$[{k}].upperLimit").try_cast("double")
    df = df.withColumns(
        {
            "x_amount": a, "x_hour": F.hour(ts), "x_weekday": F.dayofweek(ts), "x_cross_bank": (F.coalesce(sender, F.lit("")) != F.coalesce(receiver, F.lit(""))).cast("int"), "x_round_100": (F.pmod(a, F.lit(100.0)) == 0).cast("int"),
            "x_whole": (a == F.floor(a)).cast("int"), "x_priority": zero(priority), "x_band_count": zero(rule.get("band_count")), "x_band_1_limit": zero(limit(0)), "x_band_2_limit": zero(limit(1)),
            "x_alert_threshold": zero(typology.get("alert_threshold")), "x_rule_count": zero(typology.get("rule_count")), "x_first_weight": zero(typology.get("first_weight")),
        }
    )
    counts = df.groupBy(F.col(sender).alias("_sender")).agg(F.count("*").alias("x_bank_count"))
    return df.join(counts.hint("merge"), F.col(sender).eqNullSafe(F.col("_sender"))).drop("_sender")


def outcome(alerted: Column, fraud: Column) -> Column:
    return F.when(alerted & fraud, "TRUE_POSITIVE").when(alerted, "FALSE_POSITIVE").when(fraud, "FALSE_NEGATIVE").otherwise("TRUE_NEGATIVE")


def correlations(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """Pearson correlation of each column with the target, one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.corr(c, target).alias("corr")) for c in columns])
    return df.agg(pairs.alias("p")).select(F.inline("p"))


def threshold_grid(df: DataFrame, score: str, positive: Column, quantiles: list[float]) -> DataFrame:
    """For thresholds at exact quantiles of a score: how many rows fire (strictly above), and precision, recall and F1.

    The thresholds are a handful of numbers; they are joined as literals, and
    one pass counts for all of them.
    """
    cuts = df.agg(F.percentile(score, F.lit(quantiles)).alias("q")).first()["q"] or []
    cuts = sorted(set(cuts))
    if not cuts:
        return df.sparkSession.createDataFrame([], "threshold double, fired long, hits long, positives long, precision double, recall double, f1 double")
    counts = F.array(*[F.struct(F.lit(float(c)).alias("threshold"), F.count_if(F.col(score) > c).alias("fired"), F.count_if((F.col(score) > c) & positive).alias("hits"), F.count_if(positive).alias("positives")) for c in cuts])
    out = df.agg(counts.alias("g")).select(F.inline("g"))
    return out.withColumns({"precision": share(F.col("hits"), F.col("fired")), "recall": share(F.col("hits"), F.col("positives"))}).withColumn("f1", share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def best_threshold(grid: DataFrame, rows: int, max_fire_rate: float = 0.2) -> DataFrame:
    """The best threshold by recall, then precision, then F1, among those that fire rarely enough."""
    return grid.where(F.col("fired") <= max_fire_rate * rows).orderBy(F.desc("recall"), F.desc("precision"), F.desc("f1"), "threshold").limit(1)


def rule_weights(long: DataFrame, keys: list[str], rule: str, weight: str, rules: list[str]) -> DataFrame:
    """Rule results as one row per key with a column per rule (missing: 0)."""
    return long.groupBy(*keys).pivot(rule, rules).agg(F.max(weight)).fillna(0)


def fit_typology(df: DataFrame, features: list[str], label: str, seed: int = 42, least: int = 10) -> tuple[PipelineModel, dict[str, float]] | None:
    """Standardised logistic regression with elastic net on a typology's rows; None with too few rows or one class only."""
    facts = df.agg(F.count("*").alias("n"), F.count_distinct(label).alias("k")).first()
    if facts["n"] < least or facts["k"] < 2:
        return None
    train, test = df.randomSplit([0.8, 0.2], seed)
    stages = [VectorAssembler(inputCols=features, outputCol="raw", handleInvalid="skip"), StandardScaler(inputCol="raw", outputCol="scaled", withMean=True), LogisticRegression(featuresCol="scaled", labelCol=label, maxIter=100, regParam=0.01, elasticNetParam=0.5)]
    model = Pipeline(stages=stages).fit(train)
    scored = model.transform(test)
    p, y = F.col("prediction") == 1, F.col(label) == 1
    c = scored.agg(F.count_if(p & y).alias("tp"), F.count_if(p & ~y).alias("fp"), F.count_if(~p & ~y).alias("tn"), F.count_if(~p & y).alias("fn"), F.count_distinct(label).alias("k")).first()
    auc = BinaryClassificationEvaluator(labelCol=label).evaluate(scored) if c["k"] == 2 else float("nan")
    return model, {"auc": auc, "tp": c["tp"], "fp": c["fp"], "tn": c["tn"], "fn": c["fn"]}


def weight_advice(df: DataFrame, weight: str, coefficient: str) -> DataFrame:
    """Adjustment of a rule's weight by its coefficient; small ones are left alone, weights never go below 0."""
    change = F.floor(F.abs(F.col(coefficient) * 100)).cast("int") * F.signum(coefficient).cast("int")
    return df.withColumn("adjustment", change).withColumns({"advice": F.when(F.abs("adjustment") < 10, "RETAIN").when(F.col("adjustment") > 0, "INCREASE").otherwise("DECREASE"), "new_weight": F.when(F.abs("adjustment") < 10, F.col(weight)).otherwise(F.greatest(F.lit(0), F.col(weight) + F.col("adjustment")))})


def threshold_advice(df: DataFrame, keys: list[str], score: str, positive: Column) -> DataFrame:
    """Alert threshold at 0.7 of the median score of true positives, interdiction threshold at their upper quartile."""
    return df.where(positive).groupBy(*keys).agg((F.percentile(score, 0.5) * 0.7).cast("int").alias("alert_threshold"), F.percentile(score, 0.75).cast("int").alias("interdiction_threshold"))


# ------------------------------------------------------------------ calibration set


def _unique(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One row per key, the least one, so that a join can't multiply rows."""
    return df.groupBy(*keys).agg(F.min(F.struct(*columns)).alias("_u")).select(*keys, *[F.col(f"_u.{c}").alias(c) for c in columns])


def calibration_set(results: DataFrame, transactions: DataFrame, typologies: DataFrame, rules: DataFrame, high_value: float = 1000.0, accuracy: int = 10_000) -> DataFrame:
    """A row per alert, typology and rule with its transaction, configuration, derived features and statistics of its rule and typology.

    ``results`` has ``alert_id, tenant_id, typology_id, typology_cfg, typology_score, rule_id, rule_cfg, current_rule_weight,
    prediction_outcome, created_at_ts, alert_tx_msg_id, tx_original_end_to_end_id, tx_instg_agent, tx_instd_agent``. A transaction is found by message
    or else by end-to-end id, two equi-joins. Statistics are aggregated before the
    shuffle - counts, moments, quantile summaries of bounded size for amounts - and
    joined back by merge, so a typology with much of the table is split among tasks.
    Quantiles of scores are exact: scores are counted by value. Those of amounts have ranks off by up to ``1 / accuracy``.
    """
    written = Written(results.sparkSession, "calibration")
    columns = ["tx_type", "tx_amount", "instg_mmb_id", "instd_mmb_id", "charge_count", "event_ts"]
    rows = either_key(results, transactions, ("alert_tx_msg_id", "tx_msg_id"), ("tx_original_end_to_end_id", "end_to_end_id"), columns)
    rows = rows.join(_unique(typologies, ["typology_id", "typology_cfg"], ["config_alert_threshold", "config_interdiction_threshold", "rule_count"]), ["typology_id", "typology_cfg"], "left")
    rows = rows.join(_unique(rules, ["rule_id", "rule_cfg"], ["band_count", "exit_condition_count"]), ["rule_id", "rule_cfg"], "left")
    is_ = lambda test: F.coalesce(test, F.lit(False)).cast("int")
    outcome_, score, weight = F.col("prediction_outcome"), F.col("typology_score"), F.col("current_rule_weight")
    seconds = F.unix_timestamp("created_at_ts") - F.unix_timestamp("event_ts")
    ratio = lambda a, b: F.try_divide(a, b)  # noqa: E731  null beside a threshold of 0
    rows = rows.withColumns({f"is_{o.lower()}": is_(outcome_ == o) for o in ("TRUE_POSITIVE", "FALSE_POSITIVE", "TRUE_NEGATIVE", "FALSE_NEGATIVE")})
    rows = rows.withColumns(
        {
            "requires_investigation": is_(outcome_.isin("TRUE_POSITIVE", "FALSE_POSITIVE")),
            "alert_date": F.to_date("created_at_ts"), "alert_hour": F.hour("created_at_ts"), "alert_day_of_week": F.dayofweek("created_at_ts"), "transaction_hour": F.hour("event_ts"), "transaction_day_of_week": F.dayofweek("event_ts"),
            "tx_to_alert_seconds": seconds, "tx_to_alert_minutes": seconds / 60, "tx_to_alert_hours": seconds / 3600,
            "exceeded_alert_threshold": is_(score >= F.col("config_alert_threshold")), "exceeded_interdiction_threshold": is_(score >= F.col("config_interdiction_threshold")),
            "score_to_alert_ratio": ratio(score, F.col("config_alert_threshold")), "score_to_interdiction_ratio": ratio(score, F.col("config_interdiction_threshold")),
            "rule_fired": is_(weight > 0), "rule_contribution_pct": F.when(score > 0, weight / score * 100).otherwise(0.0),
            "is_high_value_tx": is_(F.col("tx_amount") > high_value), "is_cross_border": is_(F.col("instg_mmb_id") != F.col("instd_mmb_id")), "has_charges": is_(F.col("charge_count") > 0),
            "tx_type_category": F.when(F.contains("tx_type", F.lit("pacs.008")), "payment_instruction").when(F.contains("tx_type", F.lit("pacs.002")), "payment_status").otherwise("other"),
            "agents_match": is_((F.col("tx_instg_agent") == F.col("instg_mmb_id")) & (F.col("tx_instd_agent") == F.col("instd_mmb_id"))),
        }
    )
    rows = written.cut(rows)
    total = lambda c, name: F.sum(c).alias(name)
    per_rule = rows.groupBy("rule_id", "typology_id").agg(
        F.count("*").alias("rule_total_alerts"), total("is_true_positive", "rule_true_positives"), total("is_false_positive", "rule_false_positives"), F.avg("current_rule_weight").alias("rule_avg_weight"), F.stddev("current_rule_weight").alias("rule_stddev_weight"),
        F.avg("tx_amount").alias("rule_avg_tx_amount"), total("is_high_value_tx", "rule_high_value_tx_count"),
    )
    per_rule = per_rule.withColumn("rule_precision", share(F.col("rule_true_positives"), F.col("rule_true_positives") + F.col("rule_false_positives")))
    quantile = lambda c, p, name: F.percentile_approx(c, p, accuracy).alias(f"typology_{name}")
    per_typology = rows.groupBy("typology_id", "tenant_id").agg(
        F.count("*").alias("typology_total_alerts"), total("is_true_positive", "tp"), total("is_false_positive", "fp"), total("is_true_negative", "tn"), total("is_false_negative", "fn"),
        F.avg("typology_score").alias("typology_avg_score"), F.stddev("typology_score").alias("typology_stddev_score"), F.avg("tx_amount").alias("typology_avg_tx_amount"), total("is_high_value_tx", "typology_high_value_count"), total("is_cross_border", "typology_cross_border_count"),
        quantile("tx_amount", 0.5, "median_tx_amount"), quantile("tx_amount", 0.9, "p90_tx_amount"),
    )
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    per_typology = per_typology.withColumns({"typology_precision": share(tp, tp + fp), "typology_recall": share(tp, tp + fn), "typology_accuracy": share(tp + tn, F.col("typology_total_alerts")), "typology_fpr": share(fp, fp + tn)})
    per_typology = per_typology.withColumn("typology_f1_score", share(2 * F.col("typology_precision") * F.col("typology_recall"), F.col("typology_precision") + F.col("typology_recall")))
    per_typology = per_typology.withColumnsRenamed({"tp": "typology_true_positives", "fp": "typology_false_positives", "tn": "typology_true_negatives", "fn": "typology_false_negatives"})
    scores = discrete_quantiles(rows, ["typology_id", "tenant_id"], "typology_score", {"typology_median_score": 0.5, "typology_p25_score": 0.25, "typology_p75_score": 0.75, "typology_p90_score": 0.9})
    for stats, keys in ((per_rule, ["rule_id", "typology_id"]), (per_typology, ["typology_id", "tenant_id"]), (scores, ["typology_id", "tenant_id"])):
        right = stats.withColumnsRenamed({k: f"_s_{k}" for k in keys}).hint("merge")
        on = [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys]
        rows = rows.join(right, on, "left").drop(*[f"_s_{k}" for k in keys])
    return rows


# ------------------------------------------------------------------ threshold rules

QUANTILES = (0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.98, 0.99)


def _with_metrics(counts: DataFrame, totals: dict[str, int]) -> DataFrame:
    """Metrics of old alerts and a rule together, from how often the rule fires on rows of each kind."""
    tp = F.lit(totals["tp"]) + F.col("new_tp")
    fp = F.lit(totals["fp"]) + F.col("new_fp")
    n, positives = F.lit(totals["n"]), F.lit(totals["tp"] + totals["fn"])
    out = counts.withColumns({"precision": share(tp, tp + fp), "recall": share(tp, positives), "alert_rate": share(tp + fp, n), "fire_rate": share(F.col("fired"), n)})
    out = out.withColumn("f1", share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    return out.withColumn("extra_alert_rate", share(F.col("new_tp") + F.col("new_fp"), n))


#: Slices of a feature whose exact quantiles are sought.
SLICES = 32


def _cuts(df: DataFrame, features: list[str], quantiles) -> dict[str, list[float]]:
    """Distinct thresholds of each feature, exact discrete quantiles; none for a constant or empty one. Features x quantiles numbers reach the driver."""
    if not features:
        return {}
    between, feature = bounds(df, features, SLICES), F.col("feature")
    ends = df.agg(*[f(F.col(c)).alias(f"{n}_{c}") for c in features for n, f in (("low", F.min), ("high", F.max))]).first()
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in features])))
    slice_ = lambda v: F.coalesce(*[F.when(feature == c, sum(((v > b).cast("int") for b in between[c]), F.lit(0))) for c in features])
    found = discrete_quantiles(long, ["feature"], "v", {f"q{i}": p for i, p in enumerate(quantiles)}, slice_).collect()
    found = {r["feature"]: sorted(set(r[1:])) for r in found}
    return {c: found.get(c, []) if ends[f"low_{c}"] != ends[f"high_{c}"] else [] for c in features}


def _place(feature: str, cuts: list[float]) -> Column:
    """How many thresholds lie below a value plus how many are not above it: odd on a threshold; null stays null."""
    x = F.col(feature).cast("double")
    return sum(((x > c).cast("int") + (x >= c).cast("int") for c in cuts), F.lit(0))


def _totals(df: DataFrame, positive: Column, alerted: Column) -> dict[str, int]:
    r = df.agg(F.count("*").alias("n"), F.count_if(positive & alerted).alias("tp"), F.count_if(~positive & alerted).alias("fp"), F.count_if(positive & ~alerted).alias("fn")).first()
    return r.asDict()


def threshold_rules(df: DataFrame, features: list[str], positive: Column, alerted: Column, quantiles=QUANTILES) -> DataFrame:
    """All rules ``feature > t`` and ``feature < t`` at the quantiles, with the metrics of alerting on them besides what is alerted already.

    One pass counts a histogram between the thresholds of every feature; what a
    rule fires on is a running sum over a few cells. Comparisons are strict; null never fires.
    """
    positive, alerted = (F.coalesce(c, F.lit(False)) for c in (positive, alerted))
    cuts, totals = _cuts(df, features, quantiles), _totals(df, positive, alerted)
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), _place(c, cuts[c]).alias("place")) for c in features if cuts[c]] or [F.struct(F.lit("").alias("feature"), F.lit(None).cast("int").alias("place"))])
    cells = df.select(positive.alias("y"), alerted.alias("a"), F.inline(cells)).where("place is not null").groupBy("feature", "place").agg(F.count("*").alias("fired"), F.count_if(F.col("y") & ~F.col("a")).alias("new_tp"), F.count_if(~F.col("y") & ~F.col("a")).alias("new_fp"))
    grid = [(c, d, k, float(t)) for c in features for k, t in enumerate(cuts[c]) for d in ("gt", "lt")]
    grid = df.sparkSession.createDataFrame(grid, "feature string, direction string, k int, threshold double")  # features x quantiles x 2 rows
    fires = F.when(F.col("direction") == "gt", F.col("place") >= 2 * F.col("k") + 2).otherwise(F.col("place") <= 2 * F.col("k"))
    counts = grid.join(cells, "feature").where(fires).groupBy("feature", "direction", "threshold").agg(*[F.sum(c).alias(c) for c in ("fired", "new_tp", "new_fp")])
    counts = grid.select("feature", "direction", "threshold").join(counts, ["feature", "direction", "threshold"], "left").fillna(0, ["fired", "new_tp", "new_fp"])
    return _with_metrics(counts, totals)


def paired_rules(df: DataFrame, pairs: list[tuple[str, str]], positive: Column, alerted: Column, quantiles=QUANTILES) -> DataFrame:
    """All rules of two conditions on a pair of features, from one two-dimensional histogram a pair."""
    positive, alerted = (F.coalesce(c, F.lit(False)) for c in (positive, alerted))
    features = list(dict.fromkeys(c for p in pairs for c in p))
    cuts, totals = _cuts(df, features, quantiles), _totals(df, positive, alerted)
    pairs = [(a, b) for a, b in pairs if cuts[a] and cuts[b]]
    grid = [(k, a, d, i, float(t), b, e, j, float(u)) for k, (a, b) in enumerate(pairs) for i, t in enumerate(cuts[a]) for d in ("gt", "lt") for j, u in enumerate(cuts[b]) for e in ("gt", "lt")]
    schema = "pair int, feature string, direction string, i int, threshold double, feature_2 string, direction_2 string, j int, threshold_2 double"
    grid = df.sparkSession.createDataFrame(grid, schema)
    cells = F.array(*[F.struct(F.lit(k).alias("pair"), _place(a, cuts[a]).alias("p"), _place(b, cuts[b]).alias("q")) for k, (a, b) in enumerate(pairs)] or [F.struct(F.lit(-1).alias("pair"), F.lit(None).cast("int").alias("p"), F.lit(None).cast("int").alias("q"))])
    cells = df.select(positive.alias("y"), alerted.alias("a"), F.inline(cells)).where("p is not null and q is not null")
    cells = cells.groupBy("pair", "p", "q").agg(F.count("*").alias("fired"), F.count_if(F.col("y") & ~F.col("a")).alias("new_tp"), F.count_if(~F.col("y") & ~F.col("a")).alias("new_fp"))
    fires = lambda direction, place, k: F.when(F.col(direction) == "gt", F.col(place) >= 2 * F.col(k) + 2).otherwise(F.col(place) <= 2 * F.col(k))
    keys = ["feature", "direction", "threshold", "feature_2", "direction_2", "threshold_2"]
    counts = grid.join(cells, "pair").where(fires("direction", "p", "i") & fires("direction_2", "q", "j")).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("fired", "new_tp", "new_fp")])
    return _with_metrics(counts, totals)


def best_rules(rules: DataFrame, k: int = 1, max_extra_alert_rate: float = 0.02, max_fire_rate: float = 0.2, min_fire_rate: float = 0.0005) -> DataFrame:
    """The ``k`` best rules by recall, then precision, then F1, that fire neither too often nor hardly ever and add few alerts."""
    allowed = rules.where((F.col("fire_rate") <= max_fire_rate) & (F.col("fire_rate") >= min_fire_rate) & (F.col("extra_alert_rate") <= max_extra_alert_rate))
    names = [c for c in ("feature", "direction", "threshold", "feature_2", "direction_2", "threshold_2") if c in rules.columns]
    return allowed.orderBy(F.desc("recall"), F.desc("precision"), F.desc("f1"), *names).limit(k)


# ------------------------------------------------------------------ all typologies at once


def _solve(size: int, reg: float, elastic: float, tolerance: float):
    """A step of proximal Newton for each group, from its loss, gradient and Gram sums at the trial coefficients."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        d = size + 1
        upper = np.triu_indices(d)
        penalised = np.array([0.0] + [1.0] * size)
        penalty = lambda b: reg * (elastic * np.abs(b * penalised).sum() + (1 - elastic) / 2 * ((b * penalised) ** 2).sum())
        for batch in batches:
            rows, out = batch.to_pylist(), []
            for r in rows:
                trial, kept = np.array(r["trial"]), np.array(r["kept"])
                value = r["loss"] + penalty(trial)
                if value > r["value"] + 1e-12:  # a step too far: half of it
                    out.append((kept.tolist(), ((kept + trial) / 2).tolist(), r["value"], bool(np.abs(trial - kept).max() < tolerance)))
                    continue
                gram = np.zeros((d, d))
                gram[upper] = r["gram"]
                gram = gram + np.triu(gram, 1).T + 1e-12 * np.eye(d)
                gradient, new = np.array(r["gradient"]), trial.copy()
                for _ in range(1000):  # coordinate descent on the quadratic model, with soft thresholds
                    before = new.copy()
                    for j in range(d):
                        slope = gradient[j] - gram[j] @ (new - trial) + gram[j, j] * new[j]
                        cut = reg * elastic * penalised[j]
                        new[j] = np.sign(slope) * max(abs(slope) - cut, 0.0) / (gram[j, j] + reg * (1 - elastic) * penalised[j])
                    if np.abs(new - before).max() < tolerance / 10:
                        break
                out.append((trial.tolist(), new.tolist(), value, bool(np.abs(new - trial).max() < tolerance)))
            kept_names = [n for n in batch.schema.names if n.startswith("_k")]
            columns = [batch.column(n) for n in kept_names] + [batch.column("n")]
            arrays = [pa.array([o[0] for o in out], pa.list_(pa.float64())), pa.array([o[1] for o in out], pa.list_(pa.float64())), pa.array([o[2] for o in out], pa.float64()), pa.array([o[3] for o in out], pa.bool_())]
            yield pa.record_batch([*columns, *arrays], names=[*kept_names, "n", "kept", "trial", "value", "done"])

    return run


def grouped_logistic(df: DataFrame, keys: list[str], features: list[str], label: str, reg: float = 0.01, elastic: float = 0.5, rounds: int = 50, tolerance: float = 1e-7, least: int = 10) -> DataFrame:
    """Standardised logistic regression with elastic net for every group at once: keys, ``n, intercept, coefficients``, ``means`` and ``deviations``.

    A round is one aggregate for all groups: the loss, gradient and weighted
    Gram sums at each group's trial coefficients, summed before the shuffle, so a
    group's rows never meet. Each group then takes a proximal Newton step, or half of the
    last one if the loss went up; groups that stand still are done. Groups with fewer than ``least`` rows or
    one label are left out; rows with a null feature or label are, too.
    """
    spark, written = df.sparkSession, Written(df.sparkSession, "logistic")
    size, names = len(features), [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(label).cast("double").alias("y"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)]).dropna(subset=["y", *[f"x{i}" for i in range(size)]])
    stats = rows.groupBy(*names).agg(F.count("*").alias("n"), F.avg("y").alias("_share"), F.array(*[F.avg(f"x{i}") for i in range(size)]).alias("means"), F.array(*[F.coalesce(F.stddev(f"x{i}"), F.lit(0.0)) for i in range(size)]).alias("deviations"))
    stats = written.cut(stats.where((F.col("n") >= least) & (F.col("_share") > 0) & (F.col("_share") < 1)))
    match = lambda right: [F.col(n).eqNullSafe(F.col(f"r{n}")) for n in names]
    other = lambda right: right.withColumnsRenamed({n: f"r{n}" for n in names})
    # groups are joined by merge, whose large partitions adaptive execution splits
    scaled = rows.join(other(stats).hint("merge"), match(stats)).select(*names, "y", *[F.when(F.col("deviations")[i] > 0, (F.col(f"x{i}") - F.col("means")[i]) / F.col("deviations")[i]).otherwise(0.0).alias(f"x{i}") for i in range(size)])
    scaled = written.cut(scaled)
    start = F.array(F.ln(F.col("_share") / (1 - F.col("_share"))), *[F.lit(0.0)] * size)
    state = written.cut(stats.select(*names, "n", start.alias("kept"), start.alias("trial"), F.lit(float("inf")).alias("value"), F.lit(False).alias("done")))
    x = [F.lit(1.0), *[F.col(f"x{i}") for i in range(size)]]
    margin = sum((F.col("trial")[i] * x[i] for i in range(1, size + 1)), F.col("trial")[0])
    kinds = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)
    for _ in range(rounds):
        active = state.where("not done")
        if not active.limit(1).count():
            break
        at = scaled.join(other(active).hint("merge"), match(active)).withColumn("m", margin).withColumn("p", 1 / (1 + F.exp(-F.col("m"))))
        loss = F.greatest(F.col("m"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("m"))) - F.col("y") * F.col("m")
        w, rest = F.col("p") * (1 - F.col("p")), F.col("y") - F.col("p")
        sums = at.groupBy(*names).agg(
            F.avg(loss).alias("loss"), F.array(*[F.avg(rest * c) for c in x]).alias("gradient"), F.array(*[F.avg(w * x[i] * x[j]) for i in range(size + 1) for j in range(i, size + 1)]).alias("gram")
        )
        step = active.join(other(sums), match(sums)).drop(*[f"r{n}" for n in names])
        moved = step.mapInArrow(_solve(size, reg, elastic, tolerance), f"{kinds}, n long, kept array<double>, trial array<double>, value double, done boolean")
        after = written.cut(state.where("done").unionByName(moved.select(*state.columns)))
        written.drop(state)
        state = after
    out = state.join(other(stats).drop("n", "_share"), match(stats))
    return out.select(*[F.col(n).alias(k) for n, k in zip(names, keys, strict=True)], "n", F.col("trial")[0].alias("intercept"), F.slice("trial", 2, size).alias("coefficients"), "means", "deviations", F.col("done").alias("converged"))


def grouped_scores(df: DataFrame, models: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """``df`` with the ``probability`` that its group's model gives; rows of groups without a model are left out."""
    names = [f"_r{i}" for i in range(len(keys))]
    right = models.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], "intercept", "coefficients", "means", "deviations").hint("merge")
    terms = [F.when(F.col("deviations")[i] > 0, F.col("coefficients")[i] * (F.col(c).cast("double") - F.col("means")[i]) / F.col("deviations")[i]).otherwise(0.0) for i, c in enumerate(features)]
    out = df.join(right, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)])
    return out.withColumn("probability", 1 / (1 + F.exp(-sum(terms, F.col("intercept"))))).select(*df.columns, "probability")


def grouped_evaluation(scored: DataFrame, keys: list[str], label: str, probability: str = "probability", grain: int = 1000) -> DataFrame:
    """Confusion counts at 0.5 and the area under the curve for every group.

    Rows are counted by score first. Scores lie in ``grain`` slices, whose sums
    tell how many negatives lie in the slices below, so no task holds a whole
    group's scores. A group with one label has no area.
    """
    p, y = F.col(probability) >= 0.5, F.col(label) == 1
    by_score = scored.groupBy(*keys, probability).agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg")).withColumn("slice", F.floor(F.col(probability) * grain).cast("int"))
    ranked = running_in_slices(by_score, keys, "slice", [F.asc(probability)], {"below": F.col("neg")})
    area = ranked.groupBy(*keys).agg((F.sum(F.col("pos") * (F.col("below") - F.col("neg") / 2)) / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0))).alias("auc"))
    counts = scored.groupBy(*keys).agg(F.count_if(p & y).alias("tp"), F.count_if(p & ~y).alias("fp"), F.count_if(~p & ~y).alias("tn"), F.count_if(~p & y).alias("fn"))
    right = area.withColumnsRenamed({k: f"_a_{k}" for k in keys})
    return counts.join(right, [F.col(k).eqNullSafe(F.col(f"_a_{k}")) for k in keys]).drop(*[f"_a_{k}" for k in keys])


def pearson(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Correlations of all pairs of columns for every group, one pass: keys, ``a, b, corr``."""
    pairs = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.corr(a, b).alias("corr")) for i, a in enumerate(columns) for b in columns[i + 1 :]])
    return df.groupBy(*keys).agg(pairs.alias("p")).select(*keys, F.inline("p"))
