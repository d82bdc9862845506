"""Boosted trees and their attributions, forests and clusters, grouped regressions, threshold rules, sketches, hot keys and JSON in strings, against brute force."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import graphs, json_strings, sketches, windows
from tidemark.plans import calibration, evidence, missed
from tidemark.sources.written import Written

# ------------------------------------------------------------------ missed fraud


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 3))
    y = ((x[:, 0] > 0.3) & (x[:, 1] < 0.5) | (rng.random(600) < 0.05)).astype(int)
    rows = [(i, *map(float, v), int(k)) for i, (v, k) in enumerate(zip(x, y, strict=True))]
    rows[5] = (5, None, 1.0, float(x[5, 2]), 1)
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y int")


def test_attributions_sum_to_the_margin(spark, labelled):
    features = ["a", "b", "c"]
    model = missed.fit_boosted(labelled, features, "y", trees=5, depth=3)
    trees = missed.structure(model)
    assert len(trees) == 5 and all(len(t.value) > 1 for t in trees)
    out = missed.attribute(labelled.withColumn("margin", F.lit("clash")), trees, features).collect()
    from pyspark.ml.feature import VectorAssembler

    filled = VectorAssembler(inputCols=features, outputCol="_x").transform(labelled.fillna(0.0))
    raw = {r["id"]: r["rawPrediction"][1] for r in model.transform(filled).collect()}
    assert len(out) == 600
    for r in out:
        assert r["margin"] == pytest.approx(raw[r["id"]], abs=1e-9)
        assert r["base"] + sum(r["attribution"]) == pytest.approx(r["margin"], abs=1e-9)
    # by definition: what a feature's splits change on the way down
    t, r = trees[0], out[0]
    v, at, parts = [r[c] or 0.0 for c in features], 0, [0.0] * 3
    while t.left[at] >= 0:
        to = t.left[at] if v[t.feature[at]] <= t.threshold[at] else t.right[at]
        parts[t.feature[at]] += t.value[to] - t.value[at]
        at = to
    assert missed.path_attributions(np.array([v]), [t])[1][0] == pytest.approx(parts)
    strongest = missed.drivers(missed.attribute(labelled, trees, features), features).orderBy(F.desc("mean_abs")).first()
    assert strongest["feature"] in ("a", "b")
    assert missed.fit_boosted(labelled.where("y = 1"), features, "y") is None


def test_hidden_typologies(spark, labelled):
    found = missed.hidden_typologies(labelled, "id", ["a", "b", "c"], "y", F.col("y") == 1, reach=0.8, trees=5, depth=3).collect()
    assert len(found) == labelled.where("y = 1").count()
    assert {r["typology"] == "noise" for r in found} <= {True, False} and any(r["cluster"] >= 0 for r in found)
    assert all(r["cluster"] >= 0 or r["confidence"] == 0 for r in found)


def brute_clusters(points, reach, min_samples, min_size):
    ids = sorted(points)
    d = {a: {b: float(np.sqrt(((np.array(points[a]) - np.array(points[b])) ** 2).sum())) for b in ids} for a in ids}
    core = {a: sorted(d[a][b] for b in ids if b != a)[min_samples - 1] if len(ids) > min_samples else np.inf for a in ids}
    dense = [a for a in ids if core[a] <= reach]
    parent = {a: a for a in dense}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    own = {a: core[a] for a in dense}
    edges = sorted((max(d[a][b], core[a], core[b]), a, b) for i, a in enumerate(dense) for b in dense[i + 1 :] if d[a][b] <= reach and max(d[a][b], core[a], core[b]) <= reach)
    near, weight = {}, 0.0
    for w, a, b in edges:
        near[a], near[b] = min(near.get(a, w), w), min(near.get(b, w), w)
        p, q = sorted((root(a), root(b)))
        if p != q:
            parent[q] = p
            weight += w
    own = {a: near.get(a, core[a]) for a in dense}
    groups = {}
    for a in dense:
        groups.setdefault(root(a), []).append(a)
    out = dict.fromkeys(ids, (-1, 0.0))
    for g, members in groups.items():
        if len(members) >= min_size:
            closest = min(own[a] for a in members)
            out |= {a: (min(members), 1.0 if own[a] == 0 else closest / own[a]) for a in members}
    return out, weight


@pytest.mark.parametrize(("reach", "min_samples", "over"), [(0.35, 2, (0, 1)), (0.6, 1, (0,)), (0.5, 4, (0, 1, 2))])
def test_density_clusters_equal_brute_force(spark, reach, min_samples, over):
    rng = np.random.default_rng(2)
    centres = rng.normal(scale=2, size=(6, 3))
    points = {i: tuple(np.round(centres[i % 6] + rng.normal(scale=0.25 * (1 + i % 3), size=3), 3).tolist()) for i in range(150)}
    points |= {200 + i: points[i] for i in range(12)} | {300: points[0], 301: points[0], 400: (50.0, 50.0, 50.0)}
    df = spark.createDataFrame([(i, list(v)) for i, v in points.items()] + [(900, None), (None, [0.0, 0.0, 0.0])], "id long, v array<double>")
    got = {r["id"]: (r["cluster"], r["confidence"]) for r in graphs.density_clusters(df, "id", "v", reach, min_samples, 3, over).collect()}
    want, _ = brute_clusters(points, reach, min_samples, 3)
    assert {i: c for i, (c, _) in got.items()} == {i: c for i, (c, _) in want.items()}
    assert all(got[i][1] == pytest.approx(want[i][1]) for i in want)
    assert len({c for c, _ in want.values()}) > 2


def test_no_density_in_nothing(spark):
    assert graphs.density_clusters(spark.createDataFrame([], "id long, v array<double>"), "id", "v", 1.0).count() == 0


def test_spanning_forest_is_the_least(spark):
    random.seed(3)
    edges = [(a, b, float(random.randint(1, 12))) for a in range(40) for b in range(a + 1, 40) if random.random() < 0.12 and (a < 30) == (b < 30)]
    parent = list(range(40))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    total = count = 0
    for a, b, w in sorted(edges, key=lambda e: (e[2], e[0], e[1])):
        p, q = sorted((root(a), root(b)))
        if p != q:
            parent[q], total, count = p, total + w, count + 1
    df = spark.createDataFrame(edges + [(e[1], e[0], e[2] + 1) for e in edges[:9]] + [(7, 7, 0.0)], "a long, b long, w double")
    forest, labels = graphs.spanning_forest(df, Written(spark, "test"))
    rows = forest.collect()
    assert (len(rows), sum(r["w"] for r in rows)) == (count, total)
    ends = {x for a, b, _ in edges for x in (a, b)}
    assert {r["id"]: r["label"] for r in labels.collect()} == {a: root(a) for a in ends}


# ------------------------------------------------------------------ grouped regressions


def test_grouped_logistic_equals_one_model_a_group(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    rng = np.random.default_rng(4)
    rows = []
    for g, slope in (("p", 2.0), ("q", -1.0), (None, 0.0)):
        x = rng.normal(size=(300, 3)) * [1, 10, 0.1] + [0, 5, 0]
        p = 1 / (1 + np.exp(-(slope * x[:, 0] + 0.1 * x[:, 1] - 0.5)))
        rows += [(g, *map(float, v), 7.0, int(rng.random() < q)) for v, q in zip(x, p, strict=True)]
    rows += [("few", 1.0, 1.0, 1.0, 7.0, 1)] * 5 + [("one", 1.0, float(i), 1.0, 7.0, 1) for i in range(30)] + [("p", None, 1.0, 1.0, 7.0, 0)]
    df = spark.createDataFrame(rows, "g string, a double, b double, c double, d double, y int")
    features = ["a", "b", "c", "d"]
    got = {r["g"]: r for r in calibration.grouped_logistic(df, ["g"], features, "y").collect()}
    assert set(got) == {"p", "q", None} and all(r["converged"] for r in got.values())
    for g in got:
        mine = df.where(F.col("g").eqNullSafe(F.lit(g))).dropna(subset=features)
        stages = [VectorAssembler(inputCols=features, outputCol="raw"), StandardScaler(inputCol="raw", outputCol="x", withMean=True), LogisticRegression(featuresCol="x", labelCol="y", maxIter=500, regParam=0.01, elasticNetParam=0.5, tol=1e-10)]
        one = Pipeline(stages=stages).fit(mine).stages[-1]
        assert got[g]["coefficients"] == pytest.approx(one.coefficients.toArray().tolist(), abs=2e-4)
        assert got[g]["intercept"] == pytest.approx(one.intercept, abs=2e-4)
    models = calibration.grouped_logistic(df, ["g"], features, "y")
    scored = calibration.grouped_scores(df.dropna(subset=features), models, ["g"], features)
    result = {r["g"]: r for r in calibration.grouped_evaluation(scored, ["g"], "y", grain=7).collect()}
    for g in got:
        own = [(r["probability"], r["y"]) for r in scored.where(F.col("g").eqNullSafe(F.lit(g))).collect()]
        pos, neg = [p for p, y in own if y], [p for p, y in own if not y]
        auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
        assert result[g]["auc"] == pytest.approx(auc) and result[g]["tp"] == sum(p >= 0.5 for p in pos)


# ------------------------------------------------------------------ threshold rules


def test_best_rules_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, *range(20)]), rng.random(), 3.0, rng.random() < 0.3, rng.random() < 0.1) for _ in range(400)]
    df = spark.createDataFrame([(None if a is None else float(a), b, c, y, f) for a, b, c, y, f in rows], "a double, b double, c double, y boolean, f boolean")
    rules = calibration.threshold_rules(df, ["a", "b", "c"], F.col("y"), F.col("f"))
    got = {(r["feature"], r["direction"], r["threshold"]): r for r in rules.collect()}
    assert all(k[0] != "c" for k in got)  # constant
    place = {"a": 0, "b": 1}
    best = None
    for (feature, direction, t), r in got.items():
        fires = [v[place[feature]] is not None and (v[place[feature]] > t if direction == "gt" else v[place[feature]] < t) for v in rows]
        alerts = [a or v[4] for a, v in zip(fires, rows, strict=True)]
        tp, fp, fn = (sum(x) for x in ([a and v[3] for a, v in zip(alerts, rows, strict=True)], [a and not v[3] for a, v in zip(alerts, rows, strict=True)], [not a and v[3] for a, v in zip(alerts, rows, strict=True)]))
        assert r["fired"] == sum(fires) and r["precision"] == pytest.approx(tp / (tp + fp)) and r["recall"] == pytest.approx(tp / (tp + fn))
        extra, rate = (tp + fp - sum(v[4] for v in rows)) / 400, sum(fires) / 400
        assert r["extra_alert_rate"] == pytest.approx(extra)
        if 0.0005 <= rate <= 0.2 and extra <= 0.05:
            best = max(best or (0, 0), (tp / (tp + fn), tp / (tp + fp)))
    top = calibration.best_rules(rules, max_extra_alert_rate=0.05).first()
    assert (top["recall"], top["precision"]) == pytest.approx(best)
    pairs = calibration.paired_rules(df, [("a", "b"), ("a", "c")], F.col("y"), F.col("f")).collect()
    for r in rng.sample(pairs, 60):
        test = lambda v, d, t: v is not None and (v > t if d == "gt" else v < t)
        assert r["fired"] == sum(test(v[0], r["direction"], r["threshold"]) and test(v[1], r["direction_2"], r["threshold_2"]) for v in rows)
    assert calibration.best_rules(calibration.threshold_rules(df.limit(0), ["a", "b"], F.col("y"), F.col("f"))).count() == 0


# ------------------------------------------------------------------ sketches


def test_sketches_roll_up_within_their_bounds(spark):
    df = spark.range(60_000).select(F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 30).alias("ts"), F.pmod(F.xxhash64("id"), F.lit(1_000_000)).cast("double").alias("v"), (F.col("id") % 9000).alias("who"), F.lit("x").alias("k"))
    hourly = Written(spark, "test").cut(sketches.states(df, ["k"], "ts", "hour", "v", "who", k=256, lg=12))  # states survive a table
    for grain in ("day", "month", None):
        merged = sketches.merge(sketches.merge(hourly, ["k"], "day"), ["k"], grain)
        got = sketches.read(merged, {"p50": 0.5, "p99": 0.99}).collect()
        assert sum(r["n"] for r in got) == 60_000
        if grain:
            for p in (0.5, 0.99):
                assert all(r["gap"] <= sketches.rank_error(256) for r in sketches.rank_gap(df, merged, ["k"], "ts", grain, "v", "gap", p).collect())
    assert abs(got[0]["distinct"] - 9000) < 4 * 1.04 / 64 * 9000
    empty = sketches.read(sketches.states(df.limit(3).withColumn("v", F.lit(None).cast("double")), ["k"], "ts", "day", "v", "who"), {"p": 0.5}).first()
    assert empty["n"] == 0 and empty["p"] is None


# ------------------------------------------------------------------ hot keys


def test_hot_keys_give_what_plain_windows_give(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(i, "hot" if rng.random() < 0.4 else rng.choice(["a", "b", None]), 1_700_000_000_000 + rng.randint(0, 5 * 86_400_000) // 60_000 * 60_000, rng.choice([None, 1.0, 2.5])) for i in range(1500)]
    df = spark.createDataFrame(rows, "id long, k string, ms long, v double").withColumn("ts", F.timestamp_millis("ms"))
    order = [F.asc("ts"), F.asc("id")]
    jobs = {
        "running": lambda: windows.running(df, ["k"], order, "v", F.col("v") > 1, slice_=F.to_date("ts")),
        "lifetime": lambda: evidence.lifetime_count(df, ["k"], "ms"),
        "recent": lambda: evidence.recent_count(df, ["k"], "ts", 28_800_000),
        "gap": lambda: evidence.gap_before(df, ["k"], "ts"),
        "previous": lambda: evidence.gap_to_previous(df, ["k"], "ts", "id"),
    }
    plain = {n: sorted(map(tuple, f().select(*sorted(f().columns)).collect()), key=repr) for n, f in jobs.items()}
    monkeypatch.setattr(windows, "HOT_ROWS", 300)
    for n, f in jobs.items():
        assert sorted(map(tuple, f().select(*sorted(f().columns)).collect()), key=repr) == plain[n], n
    # no task of the sliced path holds more than a day of the hot key
    sliced = windows.running_in_slices(df.withColumn("day", F.to_date("ts")), ["k"], "day", order, {"n": F.lit(1)})
    largest = sliced.groupBy("k", "day").count().agg(F.max("count")).first()[0]
    assert largest < 0.4 * sum(r[1] == "hot" for r in rows)
    first = {}
    for _, k, ms, _ in rows:
        first[k] = min(first.get(k, ms), ms)
    assert all(r["age_ms"] == r["ms"] - first[r["k"]] for r in evidence.account_age(df, ["k"], "ts").collect())


# ------------------------------------------------------------------ JSON in strings


def test_json_strings_open_level_by_level(spark):
    inner = lambda i: json.dumps({"deep": json.dumps({"n": i, "flag": True})})
    rows = [(1, json.dumps({"a": 1, "s": inner(1), "list": [{"x": 1}]}), "{not json", "7", None), (2, json.dumps({"a": 2.5, "s": inner(2), "more": {"b-c": "t"}}), "{}", "8", None), (3, None, "x", None, None)]
    df = spark.createDataFrame(rows, "id long, doc string, odd string, num string, nothing string")
    out = json_strings.open_json_strings(df)
    assert set(out.columns) == {"id", "doc_a", "doc_s_deep_flag", "doc_s_deep_n", "doc_list", "doc_more_b_c", "odd", "num", "nothing"}
    got = {r["id"]: r for r in out.collect()}
    assert (float(got[1]["doc_a"]), got[1]["doc_s_deep_n"], got[1]["doc_s_deep_flag"], json.loads(got[1]["doc_list"])) == (1.0, 1, True, [{"x": 1}])
    assert (float(got[2]["doc_a"]), got[2]["doc_more_b_c"], got[2]["odd"], got[3]["doc_a"], got[1]["num"]) == (2.5, "t", "{}", None, "7")
    kept = json_strings.open_json_strings(df, keep_text=True)
    assert json.loads(kept.where("id = 1").first()["doc_json"])["a"] == 1
    assert json_strings.open_json_strings(df.limit(0)).columns == df.columns
