"""views make of gold what they read, write none of it, and parse each payload once."""

import pytest

import tidemark.plans.table_queries  # noqa: F401  registers its queries
from tidemark.plans.queries import QUERIES
from tidemark.sources import written


@pytest.mark.parametrize(("name", "payloads"), [("view_01_alert_header", 4), ("view_05_transaction_detail", 2), ("view_05_payment_charges", 2), ("view_08_counterparty_edges", 2)])
def test_payloads_are_parsed_once(spark, sf, monkeypatch, name, payloads):
    # the network map of view_01 is a constant
    cuts = []
    cut = written.Written.cut
    monkeypatch.setattr(written.Written, "cut", lambda self, df: cuts.append(df) or cut(self, df))
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == payloads and not cuts
