"""Pipelines and views on hand-written payloads."""

import hashlib
import json
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.plans import documents, evidence, views
from tidemark.plans.etl import PIPELINES, dynamic, pipeline_for, typology_rules
from tidemark.plans.queries import QUERIES
from tidemark.sources.tables import SnapshotTable, TableSpec

STATUS = {
    "TxTp": "pacs.002.001.12", "TenantId": "T1",
    "FIToFIPmtSts": {"GrpHdr": {"MsgId": "m1", "CreDtTm": "2024-01-02T03:04:05.000Z"}, "TxInfAndSts": {"TxSts": "ACCC", "OrgnlEndToEndId": "e1", "ChrgsInf": [{"Amt": {"Amt": 1.5, "Ccy": "EUR"}}, None, {"Amt": {"Amt": 2.0, "Ccy": "USD"}}], "InstgAgt": {"FinInstnId": {"ClrSysMmbId": {"MmbId": "bank1"}}}}},
    "DataCache": {"cdtrId": "c1", "dbtrId": "d1", "instdAmt": {"amt": 100.0, "ccy": "EUR"}, "cdtrAcctId": "ca", "dbtrAcctId": "da"},
}
RULES_A = [{"id": "r1", "cfg": "1", "wght": 100, "subRuleRef": ".01"}, {"id": "r2", "cfg": "1", "wght": 50, "subRuleRef": ".x01"}, None]
RULES_B = [{"id": "r1", "cfg": "1", "wght": 300, "subRuleRef": ".01"}, {"id": "EFRuP@1.0.0", "cfg": "n", "wght": 0, "subRuleRef": "none"}]
ALERT = {"status": "ALRT", "timestamp": "2024-01-02T03:04:06Z", "evaluationID": "ev1", "metaData": {"prcgTmDP": 1_000_000, "prcgTmED": 2_000_000}, "tadpResult": {"id": "tadp", "typologyResult": [{"id": "t1", "cfg": "1", "result": 400, "ruleResults": RULES_A}, None, {"id": "t2", "cfg": "1", "result": 90, "ruleResults": RULES_B}]}}
NETWORK = {"cfg": "1", "active": True, "tenantId": "T1", "messages": [{"id": "n1", "cfg": "1", "txTp": "pacs.002.001.12", "typologies": [{"id": "t1", "cfg": "1", "rules": [{"id": "r1", "cfg": "1"}, {"id": "r2", "cfg": "1"}]}]}]}
PAYMENT = {
    "TxTp": "pacs.008.001.10", "TenantId": "T1",
    "FIToFICstmrCdtTrf": {"GrpHdr": {"MsgId": "p1", "CreDtTm": "2024-01-02T03:00:00Z", "NbOfTxs": 1}, "CdtTrfTxInf": {"PmtId": {"EndToEndId": "e1"}, "InstdAmt": {"Amt": {"Amt": 100.0, "Ccy": "EUR"}}, "Cdtr": {"Nm": "Cred", "Id": {"PrvtId": {"Othr": [{"Id": "c1"}]}}}, "Dbtr": {"Nm": "Deb", "Id": {"PrvtId": {"DtAndPlcOfBirth": {"BirthDt": "1990-05-01"}, "Othr": [{"Id": "d1"}]}}}, "CdtrAcct": {"Id": {"Othr": [{"Id": "ca"}]}}, "DbtrAcct": {"Id": {"Othr": [{"Id": "da"}]}}, "Purp": {"Cd": "MP2P"}}},
}


@pytest.fixture(scope="module")
def gold(spark):
    def run(name, rows):
        return PIPELINES[name].stages(spark.read.json(spark.sparkContext.parallelize([json.dumps(r) for r in rows])))

    alert = {"alert_id": 1, "tenant_id": "T1", "priority": " high ", "alert_type": "fraud", "prediction_outcome": "TRUE_POSITIVE", "created_at": "1704164647000", "case_id": 7, "alert_data": json.dumps(ALERT), "transaction": json.dumps(STATUS), "network_map": json.dumps(NETWORK)}
    broken = {"alert_id": 2, "tenant_id": "T1", "alert_data": "{", "created_at": "x", "case_id": None}
    return {
        "alerts": run("alerts", [alert, alert, broken]),
        "pacs002": run("pacs002", [{"document": STATUS}]),
        "pacs008": run("pacs008", [{"tenantid": "T1", "messageid": "p1", "endtoendid": "e1", "credttm": "2024-01-02T03:00:00Z", "document": json.dumps(PAYMENT)}]),
        "transactions": run("transactions", [{"amt": 100.0, "ccy": "EUR", "credttm": "2024-01-02T03:00:00Z", "endtoendid": "e1", "msgid": "m1", "tenantid": "T1", "txtp": "pacs.008.001.10"}]),
        "cases": run("cases", [{"case_id": 7, "tenant_id": "T1", "status": "STATUS_20", "created_at": "1704164647000", "updated_at": "1704168247000"}, {"case_id": 7, "tenant_id": "T1", "status": "OLD", "created_at": "1600000000000"}]),
        "tasks": run("tasks", [{"task_id": 1, "case_id": 7, "tenant_id": "T1", "created_at": "1704164647000", "completed_at": "1704168247000", "sla_deadline": "1704164648000", "status": "done"}]),
        "condition": run("condition", [{"condition": json.dumps({"condId": "k1", "tenantId": "T1", "ntty": {"id": "d1"}, "incptnDtTm": "2024-01-01T00:00:00Z", "evtTp": ["pacs.008.001.10"]})}]),
        "rule": run("rule", [{"ruleid": "r1", "rulecfg": "1", "tenantid": t, "configuration": json.dumps({"id": "r1", "desc": t, "config": {"bands": [{"subRuleRef": ".01", "reason": f"{t} band", "lowerLimit": 5}], "parameters": {"maxQueryRange": 1000}}})} for t in ("DEFAULT", "T1")]),
        "typologies": run("typologies", [{"typologyid": "t1", "typologycfg": "1", "tenantid": "T1", "configuration": json.dumps({"id": "t1", "typology_name": "first", "workflow": {"alertThreshold": 200}, "rules": [{"id": "r1", "cfg": "1", "wghts": [{"ref": ".01", "wght": 100}]}], "expression": ["Add", "v1"]})}]),
        "network_map": run("network_map", [{"tenantid": "T1", "configuration": json.dumps(NETWORK), "credttm": "2024-01-01T00:00:00Z"}]),
        "evaluation": run("evaluation", [{"messageid": "m1", "tenantid": "T1", "evaluation": json.dumps({"report": {"status": "alrt", "timestamp": "2024-01-02T03:04:06Z", "evaluationID": "ev1", "metaData": {"prcgTmDP": 5}}, "dataCache": STATUS["DataCache"], "transaction": STATUS})}]),
    }


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_alerts(gold):
    r = one(gold["alerts"]["gold"])
    assert (r["rule_count_total"], r["rule_id_count_distinct"], r["rule_weight_sum"], r["rule_weight_max"], r["top_rule_id"]) == (4, 3, 450, 300, "r1")
    assert (r["typology_count"], r["typology_id"], r["charge_count"], r["charge_total_amount"], r["has_multi_currency_charges"]) == (2, "t1,t2", 2, 3.5, 1)
    assert (r["priority_norm"], r["efrup_subruleref"], r["tx_amount"], r["rule_weight_p95"]) == ("HIGH", "none", 100.0, 300.0)
    dlq = one(gold["alerts"]["dlq"])
    assert set(dlq["dq_reasons"]) >= {"CREATED_AT_TS_NULL", "EVENT_TS_NULL", "ALERT_DATA_MISSING_CORE", "TX_MISSING_CORE", "NET_MISSING_CORE"}


def test_cases_tasks_and_messages(gold):
    c = one(gold["cases"]["gold"])
    assert (c["status"], c["created_to_updated_ms"], c["has_owner"]) == ("STATUS_20", 3_600_000, 0)
    t = one(gold["tasks"]["gold"])
    assert (t["sla_breached"], t["is_completed"], t["task_duration_ms"]) == (1, 1, 3_600_000)
    s = one(gold["pacs002"]["gold"])
    assert (s["end_to_end_id"], s["tx_status"], s["charge_currency_count"], s["instg_mmb_id"], s["dc_debtor_account_id"]) == ("e1", "ACCC", 2, "bank1", "da")
    p = one(gold["pacs008"]["gold"])
    assert (p["creditor_id"], p["debtor_account_id"], p["purpose_code"], str(p["event_date"])) == ("c1", "da", "MP2P", "2024-01-02")
    e = one(gold["evaluation"]["gold"])
    assert (e["is_alert"], e["report_status"], e["total_prcg_tm_ns"], e["tx_msg_id"]) == (1, "ALRT", 5, "m1")


def test_configuration(gold):
    k = one(gold["condition"]["gold"])
    assert (k["target_type"], k["event_types_csv"], k["is_active"], k["is_expired"]) == ("ENTITY", "pacs.008.001.10", 1, 0)
    assert {r["rule_type"] for r in gold["rule"]["gold"].collect()} == {"BAND"}
    t = one(gold["typologies"]["gold"])
    assert (t["rule_001_id"], t["rule_001_w01_wght"], t["expr_002_token"], t["rule_002_id"]) == ("r1", 100.0, "v1", None)
    assert typology_rules(gold["typologies"]["silver"]).count() == 1
    n = one(gold["network_map"]["gold"])
    assert (n["rule_count"], n["message_count"], n["network_active"]) == (2, 1, True)
    assert {(r["kind"], r["reason"]) for r in evidence.bands(gold["rule"]["gold"]).collect()} == {("BAND", "DEFAULT band"), ("BAND", "T1 band")}


def test_views(gold):
    g = {k: v["gold"] for k, v in gold.items()}
    detail = views.transaction_detail(g["transactions"], g["pacs008"], g["pacs002"])
    d = one(detail)
    assert (d["debtor_id"], d["creditor_account_id"], d["instructed_amount"], d["charge_count"], d["instg_mmb_id"]) == ("d1", "ca", 100.0, 2, "bank1")
    flagged = views.investigation_flags(detail, g["alerts"], g["cases"], g["tasks"])
    assert (one(flagged)["is_alerted"], one(flagged)["is_investigated"]) == (1, 1)
    history = views.transaction_history(flagged)
    assert {r["row_type"]: r["count"] for r in history.groupBy("row_type").count().collect()} == {"EVENT": 4, "AGG": 16}
    edge = views.network_edges(flagged, "debtor_account_id", "creditor_account_id")
    assert edge.count() == 4 and edge.select("pk").distinct().count() == 4
    assert views.holder_links(flagged).count() == 8
    timeline = views.conditions_timeline(g["condition"].withColumnRenamed("tenant_id", "tenant_id"), detail)
    assert {(r["bucket_granularity"], r["transaction_id"] is not None) for r in timeline.collect()} == {("day", False), ("week", True), ("month", True), ("year", True), ("all", True)}
    header = views.alert_header(g["alerts"], g["pacs002"], g["pacs008"])
    assert (one(header)["block_or_override_status"], one(header)["debtor_account_id"]) == ("NOT_BLOCKED", "da")
    payloads = gold["alerts"]["bronze"].where("alert_id = 1").dropDuplicates(["alert_id"])
    typ = {r["typology_id"]: r["typology_name"] for r in views.typologies_triggered(payloads, g["typologies"]).collect() if r["typology_id"]}
    assert typ == {"t1": "first", "t2": None}
    rules = {(r["typology_id"], r["rule_id"]): (r["match_rank"], r["matched_band_reason"]) for r in views.rules_triggered(payloads, g["rule"]).collect()}
    assert rules[("t1", "r1")] == (0, "T1 band") and rules[("t1", "r2")][0] == 2
    maps = gold["network_map"]["bronze"]
    assert {r["rule_id"] for r in views.network_evaluated(header, maps).collect()} == {"r1", "r2"}
    merged = payloads.select(F.from_json("alert_data", "tadpResult struct<typologyResult:array<struct<ruleResults:array<struct<id:string,wght:bigint,subRuleRef:string>>>>>").alias("a"))
    got = one(merged.select(*[c.alias(n) for n, c in evidence.merge_rules(F.col("a.tadpResult.typologyResult")).items()]))
    assert {r["id"]: -r["w"] for r in got["merged_rules"]} == {"r1": 300, "r2": 50} and got["override_rule"] == "none"
    built, skipped = views.build_all({"a": header, "b": None}, {"x": (("a",), lambda a: a), "y": (("b",), lambda b: b), "z": (("x",), lambda x: x)})
    assert sorted(built) == ["x", "z"] and skipped == ["y"]


def test_refresh_is_idempotent(spark, tmp_path):
    raw = spark.createDataFrame([(1, "T1", "low", 60, 1000, 2000), (1, "T1", "high", 30, 1000, 3000)], "id long, tenant_id string, priority string, target_seconds long, created_at long, updated_at long")
    p = pipeline_for("db", "sla_policies")
    for _ in range(2):
        table = p.refresh(spark, str(tmp_path), raw)
        assert [(r["priority"], r["target_seconds"]) for r in table.read().collect()] == [("HIGH", 30)]


@pytest.mark.parametrize("name", ["alerts", "network_map"])
def test_refresh_equals_stages(spark, tmp_path, name):
    """What is refreshed from written layers is what the stages make of the batch."""
    rows = {
        "alerts": [{"alert_id": 1, "tenant_id": "T1", "created_at": "1704164647000", "alert_data": json.dumps(ALERT), "transaction": json.dumps(STATUS), "network_map": json.dumps(NETWORK)}, {"alert_id": 2, "tenant_id": "T1", "alert_data": "{", "created_at": "x"}],
        "network_map": [{"tenantid": "T1", "configuration": json.dumps(NETWORK), "credttm": "2024-01-01T00:00:00Z"}],
    }[name]
    raw = spark.read.json(spark.sparkContext.parallelize([json.dumps(r) for r in rows]))
    stages = PIPELINES[name].stages(raw)
    got = PIPELINES[name].refresh(spark, str(tmp_path), raw).read()
    timed = ("ingested_at_ts", "event_to_ingest_ms")
    plain = lambda df: sorted(str(r.asDict()) for r in df.select(*[c for c in sorted(stages["gold"].columns) if c not in timed]).collect())
    assert plain(got) == plain(stages["gold"]) and got.count() == 1
    if name == "alerts":
        assert [r["alert_id"] for r in SnapshotTable(spark, f"{tmp_path}/silver", TableSpec("alerts_dlq", ("dlq_id",), "ingested_at_ts")).read().collect()] == [2]


def test_dynamic(spark):
    raw = spark.createDataFrame([("m1", "2024-01-01T00:00:00Z", (1, [2, 3])), ("m1", "2024-01-02T00:00:00Z", (5, None))], "messageid string, credttm string, body struct<x:int,ys:array<int>>")
    g = one(dynamic("raw_history", "odd").stages(raw)["gold"])
    assert (g["body_x"], g["body_ys"], str(g["event_date"])) == (5, None, "2024-01-02")


def test_documents_are_processed_whole(spark, tmp_path):
    texts = ["é" * 40_000, "short", " ", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in QUERIES["doc_01_whole"](spark, str(tmp_path)).collect()}
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    assert [got[i]["processing_status"] for i in range(4)] == ["COMPLETED", "COMPLETED", "ERROR", "ERROR"]
    assert [(got[i]["index_md5"], got[i]["forward_md5"]) for i in range(4)] == [(md5(texts[0][:30_000]), md5(texts[0])), (md5("short"), md5("short")), (None, None), (None, None)]
    gated = {r["doc_id"]: r["processing_error"] for r in documents.process(df, most_bytes=100).collect()}
    assert gated == {0: "TOO_LARGE", 1: None, 2: "EMPTY", 3: "NO_TEXT"}


def _start(ts, grain):
    day = ts.replace(hour=0, minute=0, second=0, microsecond=0)
    return {"day": day, "week": day - timedelta(days=day.weekday()), "month": day.replace(day=1), "year": day.replace(month=1, day=1), "all": datetime(1970, 1, 1)}[grain]


@pytest.mark.parametrize(("name", "hours", "same_user"), [("join_09_whole", 6, True), ("view_11_whole", 3, False)])
def test_all_conditions_at_all_granularities(spark, sf, name, hours, same_user):
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts")).collect()
    events = [(r["event_id"], r["user_id"], r["event_type"], datetime.fromisoformat(r["ts"])) for r in events]
    want = Counter()
    for cond, user, kind, start in events:
        if kind != "signup":
            continue
        end = datetime.max if cond % 20 == 0 else start + timedelta(hours=hours)
        inside = [(i, ts) for i, u, k, ts in events if k == "purchase" and (u == user or not same_user) and start <= ts <= end]
        for grain in ("day", "week", "month", "year", "all"):
            found = [i for i, ts in inside if _start(ts, grain) == _start(start, grain)]
            want.update((cond, grain, str(_start(start, grain)), i) for i in found or [None])
    key = "cond_id" if same_user else "cond"
    got = Counter(tuple(r) for r in QUERIES[name](spark, sf).select(key, "bucket_granularity", "bucket_start", "event_id").collect())
    assert got == want
    assert len({k[0] for k in got}) == sum(e[2] == "signup" for e in events)


@pytest.mark.parametrize("name", ["agg_01_whole", "view_06_whole", "view_07_whole", "view_09_whole"])
def test_all_default_granularities(spark, sf, name):
    assert {r[0] for r in QUERIES[name](spark, sf).select("bucket_granularity").distinct().collect()} - {None} == {"day", "week", "month", "year"}


def test_age_changes_on_the_birthday(spark):
    rows = [("1990-05-15", "2020-05-14", 29), ("1990-05-15", "2020-05-15", 30), ("1990-05-15", "2020-05-01", 29), ("2000-02-29", "2023-02-28", 22), ("2000-02-29", "2023-03-01", 23), ("2000-02-29", "2024-02-29", 24), ("1990-12-31", "1990-12-01", -1), ("x", "2020-01-01", None)]
    df = spark.createDataFrame([(json.dumps({"BirthDt": b}), at, y) for b, at, y in rows], "doc string, at string, years int")
    got = df.select("years", evidence.age_in_years("doc", "$.BirthDt", F.col("at").cast("date")).alias("age")).collect()
    assert [r["age"] for r in got] == [y for _, _, y in rows]


def test_all_orders_go_through_upsert(spark, sf, monkeypatch):
    calls = []
    upsert = SnapshotTable.upsert
    monkeypatch.setattr(SnapshotTable, "upsert", lambda self, rows, instant=None: calls.append(rows.count()) or upsert(self, rows, instant))
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    got = QUERIES["snk_01_whole"](spark, sf)
    assert calls == [orders.count(), orders.where("o_orderkey % 3 = 0").count()]
    assert got.count() == orders.count() and got.where("o_orderkey % 3 = 0 and o_orderstatus <> 'F'").count() == 0
