"""Landed files through their pipelines into the views that depend on them, and aggregates kept up to date by touched keys."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators.aggregates import edges
from tidemark.plans import orchestrate
from tidemark.plans.orchestrate import Orchestrator, View, in_order, refresh_aggregate


def land(folder, table, rows):
    path = folder / "db" / table / "2024"
    path.mkdir(parents=True, exist_ok=True)
    (path / f"{len(list(path.iterdir()))}.json").write_text("\n".join(json.dumps(r) for r in rows))
    return str(path)


def payment(k, amount, at="2024-01-05T10:00:00.000Z"):
    return {"TxTp": "pacs.008.001.10", "TenantId": "T1", "FIToFICstmrCdtTrf": {"GrpHdr": {"MsgId": f"p{k}", "CreDtTm": at}, "CdtTrfTxInf": {"PmtId": {"EndToEndId": f"e{k}"}, "InstdAmt": {"Amt": {"Amt": amount, "Ccy": "EUR"}},
        "Dbtr": {"Nm": "d", "Id": {"PrvtId": {"Othr": [{"Id": f"db{k % 2}"}]}}}, "Cdtr": {"Nm": "c", "Id": {"PrvtId": {"Othr": [{"Id": "cr"}]}}}, "DbtrAcct": {"Id": {"Othr": [{"Id": f"da{k}"}]}}, "CdtrAcct": {"Id": {"Othr": [{"Id": "ca"}]}}}}}


def transaction(k, amount, at="2024-01-05T10:00:00.000Z"):
    return {"amt": amount, "ccy": "EUR", "credttm": at, "endtoendid": f"e{k}", "msgid": f"s{k}", "tenantid": "T1", "txtp": "pacs.008.001.10"}


def message(k, amount):
    return {"tenantid": "T1", "messageid": f"p{k}", "endtoendid": f"e{k}", "credttm": "2024-01-05T10:00:00.000Z", "document": json.dumps(payment(k, amount))}


def status(k):
    return {"document": json.dumps({"TxTp": "pacs.002.001.12", "TenantId": "T1", "FIToFIPmtSts": {"GrpHdr": {"MsgId": f"s{k}", "CreDtTm": "2024-01-05T10:00:01.000Z"}, "TxInfAndSts": {"TxSts": "ACCC", "OrgnlEndToEndId": f"e{k}", "ChrgsInf": [{"Amt": {"Amt": 1.5, "Ccy": "EUR"}}]}}})}


def test_files_become_views(spark, tmp_path):
    o = Orchestrator(spark, str(tmp_path / "wh"))
    assert o.build_views()["skipped"] == [v.name for v in o.views]
    landed = {"transaction": [transaction(k, 10.0 * k) for k in range(4)], "pacs008": [message(k, 10.0 * k) for k in range(4)], "pacs002": [status(k) for k in range(3)]}
    for table, rows in landed.items():
        done = o.run(land(tmp_path, table, rows), with_views=table == "pacs002")
    assert done["table"] == "pacs002" and done["views"]["built"] == ["transaction_detail"]
    detail = {r["end_to_end_id"]: r for r in o.view("transaction_detail").collect()}
    assert len(detail) == 4 and detail["e1"]["charge_total_amount"] == 1.5 and detail["e3"]["charge_count"] == 0
    assert o.build_views()["current"] == ["transaction_detail"]  # nothing has changed
    # cases, tasks and alerts complete the inputs of the flagged detail and what stands on it
    for table, rows in {"alerts": [alert(1)], "cases": [{"case_id": 5, "tenant_id": "T1", "status": "STATUS_82_CONFIRMED", "created_at": "1704448800000"}], "tasks": [{"task_id": 1, "case_id": 5, "tenant_id": "T1", "created_at": "1704448800000", "completed_at": "1704449800000"}]}.items():
        o.run(land(tmp_path, table, rows))
    done = o.build_views()
    assert {"alert_header", "flagged_detail", "transaction_history", "account_edges", "counterparty_edges", "holder_links", "alert_history"} <= set(done["built"]) and done["current"] == ["transaction_detail"]
    flags = {r["end_to_end_id"]: (r["is_alerted"], r["is_investigated"]) for r in o.view("flagged_detail").collect()}
    assert flags == {"e0": (0, 0), "e1": (1, 1), "e2": (0, 0), "e3": (0, 0)}
    day = o.view("counterparty_edges").where("bucket_granularity = 'day'")
    assert {(r["from_debtor_id"], r["tx_count"], r["total_amount"]) for r in day.collect()} == {("db0", 2, 20.0), ("db1", 2, 40.0)}
    # a new version of one transaction: what depends on it is built again, the rest is not
    o.run(land(tmp_path, "transactions", [transaction(1, 99.0, "2024-01-06T10:00:00.000Z")]))
    done = o.build_views()
    assert "alert_header" in done["current"] and "transaction_detail" in done["built"] and "account_edges" in done["built"]


def alert(k):
    data = {"status": "ALRT", "timestamp": "2024-01-05T10:00:02.000Z", "evaluationID": "v", "metaData": {"prcgTmDP": 1, "prcgTmED": 1}, "tadpResult": {"id": "t", "typologyResult": [{"id": "ty", "cfg": "1", "result": 10, "workflow": {"alertThreshold": 5}, "ruleResults": [{"id": "r", "cfg": "1", "wght": 3, "subRuleRef": ".01"}]}]}}
    tx = json.loads(status(k)["document"])
    return {"alert_id": 7, "case_id": 5, "tenant_id": "T1", "created_at": "1704448803000", "alert_data": json.dumps(data), "transaction": json.dumps(tx), "network_map": json.dumps({"active": True, "messages": [{"id": "m", "txTp": "pacs.002.001.12", "typologies": []}]})}


def test_routes(spark, tmp_path):
    o = Orchestrator(spark, str(tmp_path))
    assert o.route("s3a://b/db/sla-policies/2024/x.json").name == "sla_policies"
    assert o.route("s3a://b/x.json", "Alert").name == "alerts"
    assert o.route("s3a://b/enrichment/odd/x.json").name == "enrichment_odd"


def test_order_of_views():
    made = lambda n, *needs: View(n, needs, lambda: None)
    assert [v.name for v in in_order((made("c", "b", "gold/x"), made("a", "gold/x"), made("b", "a")))] == ["a", "b", "c"]
    with pytest.raises(ValueError, match="each other"):
        in_order((made("a", "b"), made("b", "a")))
    names = [v.name for v in in_order(orchestrate.VIEWS)]
    assert len(names) == 12 and names.index("flagged_detail") > names.index("transaction_detail")


def test_touched_keys_give_what_a_full_build_gives(spark):
    schema = "id int, a string, b string, ts timestamp, amount double"
    first = spark.sql("select cast(id as int) id, concat('a', id % 5) a, concat('b', id % 3) b, timestamp_seconds(1700000000 + id * 7000) ts, cast(id % 11 as double) amount from range(300)").to(spark.createDataFrame([], schema).schema)
    build = lambda df: edges(df, "a", "b", "ts", "amount")
    old = build(first).cache()
    # amounts change, a row moves to another edge and day, rows come and one goes
    gone = first.where("id in (7, 8, 50, 299)")
    new = spark.createDataFrame([(7, "a2", "b1", None, 1000.0), (8, "a9", "b9", None, 5.0), (50, "a0", "b2", None, 2.0), (400, "a1", "b0", None, 3.0)], "id int, a string, b string, t int, amount double")
    new = new.select("id", "a", "b", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 9000).alias("ts"), "amount")
    now = first.join(gone.select("id"), "id", "left_anti").select("id", "a", "b", "ts", "amount").unionByName(new)
    keys = ["bucket_granularity", "bucket_start", "from_a", "to_b"]
    got = refresh_aggregate(old, keys, build, now, gone.unionByName(new), {"a": "from_a", "b": "to_b"})
    want = build(now)
    assert sorted(map(str, got.select(*sorted(want.columns)).collect())) == sorted(map(str, want.select(*sorted(want.columns)).collect()))
    assert old.count() != want.count()
