"""From a landed file to the views that depend on it.

An object's path names its table; its pipeline merges it into bronze, silver and
gold; views whose inputs have changed since they were last built are built
again, in order of their dependencies. Aggregate views are kept up to date by
their touched keys: only what the changed rows belong to, before or after the
change, is aggregated again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.columns import drop_meta
from tidemark.plans import views
from tidemark.plans.etl import ALIASES, PIPELINES, Pipeline, pipeline_for
from tidemark.sources import readers
from tidemark.sources.sinks import append_json
from tidemark.sources.tables import SnapshotTable, TableSpec
from tidemark.sources.written import Written


@dataclass(frozen=True)
class View:
    """``needs`` names tables (``layer/name``) and earlier views; ``build`` takes them in that order."""

    name: str
    needs: tuple[str, ...]
    build: Callable[..., DataFrame]


def _flagged(detail: DataFrame, alerts: DataFrame, cases: DataFrame, tasks: DataFrame) -> DataFrame:
    return views.investigation_flags(detail, alerts, cases.withColumn("status", F.when(F.col("status_norm").startswith("STATUS_8"), F.col("status_norm"))), tasks)


def _payloads(alerts: DataFrame) -> DataFrame:
    return alerts.where("alert_data is not null").select("alert_id", "tenant_id", "alert_data")


def _alert_history(detail: DataFrame, alerts: DataFrame) -> DataFrame:
    rows = alerts.select("alert_id", "tenant_id", "tx_msg_id", F.col("event_ts").alias("alert_ts"))
    joined = detail.drop("event_ts").join(rows, ["tenant_id", "tx_msg_id"]).withColumns({"event_ts": F.col("alert_ts"), "tx_amount": F.col("instructed_amount")})
    return views.alert_history(joined)


def _conditions(conditions: DataFrame, detail: DataFrame) -> DataFrame:
    return views.conditions_timeline(conditions, detail)


#: The eleven views, in an order in which each has what it needs, and the flagged detail that six of them share.
VIEWS: tuple[View, ...] = (
    View("alert_header", ("gold/alerts", "gold/pacs002", "gold/pacs008"), views.alert_header),
    View("typologies_triggered", ("bronze/alerts", "gold/typologies"), lambda a, t: views.typologies_triggered(_payloads(a), t)),
    View("rules_triggered", ("bronze/alerts", "gold/rule"), lambda a, r: views.rules_triggered(_payloads(a), r)),
    View("network_evaluated", ("alert_header", "bronze/network_map"), views.network_evaluated),
    View("transaction_detail", ("gold/transactions", "gold/pacs008", "gold/pacs002"), views.transaction_detail),
    View("flagged_detail", ("transaction_detail", "gold/alerts", "gold/cases", "gold/tasks"), _flagged),
    View("transaction_history", ("flagged_detail",), views.transaction_history),
    View("account_edges", ("flagged_detail",), lambda d: views.network_edges(d, "debtor_account_id", "creditor_account_id")),
    View("counterparty_edges", ("flagged_detail",), lambda d: views.network_edges(d, "debtor_id", "creditor_id")),
    View("holder_links", ("flagged_detail",), views.holder_links),
    View("alert_history", ("flagged_detail", "gold/alerts"), _alert_history),
    View("conditions_timeline", ("gold/condition", "transaction_detail"), _conditions),
)


def in_order(found: tuple[View, ...]) -> list[View]:
    """Views so that each comes behind those it needs; a cycle is an error."""
    names, out = {v.name for v in found}, []
    left = list(found)
    while left:
        ready = [v for v in left if all(n not in names or n in {o.name for o in out} for n in v.needs)]
        if not ready:
            raise ValueError(f"views need each other: {', '.join(v.name for v in left)}")
        out += ready
        left = [v for v in left if v not in ready]
    return out


def refresh_aggregate(old: DataFrame, keys: list[str], build: Callable[[DataFrame], DataFrame], now: DataFrame, changed: DataFrame, owners: dict[str, str]) -> DataFrame:
    """``build(now)``, made from ``old`` and the rows that changed.

    ``changed`` holds changed rows as they were and as they are. ``build`` of
    these tells which keys they touch. ``owners`` maps columns of ``now`` to those of the keys that have
    their values, such as the ends of an edge: rows of touched owners alone are
    aggregated again, and of the result the touched keys are taken.
    """
    same = lambda right: [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in right]
    touched = Written(old.sparkSession, "touched").cut(build(changed).select(*keys, *[c for c in owners.values() if c not in keys]).distinct())
    of = touched.select(*[F.col(c).alias(f"_r_{k}") for k, c in owners.items()]).distinct()
    again = build(now.join(of, same(owners), "left_semi"))
    right = touched.select(*[F.col(k).alias(f"_r_{k}") for k in keys])
    kept = old.join(right, same(keys), "left_anti")
    return kept.unionByName(again.join(right, same(keys), "left_semi"), allowMissingColumns=True)


class Orchestrator:
    """Refreshes tables and views below a warehouse folder."""

    def __init__(self, spark: SparkSession, warehouse: str, found: tuple[View, ...] = VIEWS):
        self.spark, self.warehouse, self.views = spark, warehouse.rstrip("/"), in_order(found)

    # -- tables

    def route(self, path: str, table: str | None = None, db: str | None = None) -> Pipeline:
        """The pipeline of an object: by an explicit name, else by its path from the end; a generic one if there is none."""
        name = readers.resolve_table(ALIASES, table, path)
        if name:
            return PIPELINES[name]
        parts = [p for p in path.split("://")[-1].strip("/").split("/") if p]
        return pipeline_for(db or (parts[-3] if len(parts) > 2 else "raw_history"), readers.normalize_table_name(table or (parts[-2] if len(parts) > 1 else parts[-1])))

    def run(self, path: str, table: str | None = None, db: str | None = None, with_views: bool = False) -> dict[str, object]:
        """Merges the JSON objects at a path into their table and, if asked for, builds what depends on it."""
        pipeline = self.route(path, table, db)
        pipeline.refresh(self.spark, self.warehouse, readers.json_objects(self.spark, path))
        return {"table": pipeline.name, "path": path, "views": self.build_views() if with_views else None}

    def _table(self, need: str) -> SnapshotTable:
        layer, name = need.split("/")
        return SnapshotTable(self.spark, f"{self.warehouse}/{layer}", TableSpec(name, (), "ingested_at_ts"))

    # -- views

    def built(self) -> dict[str, tuple[str, str]]:
        """For each view, what it was last built from and the folder it was written to; one row a build is kept."""
        path = f"{self.warehouse}/views/_built"
        if not readers.exists(self.spark, path):
            return {}
        rows = self.spark.read.schema("view string, inputs string, path string, at timestamp").json(path)
        newest = rows.groupBy("view").agg(F.max_by(F.struct("inputs", "path"), "at").alias("last"))
        return {r["view"]: (r["last"]["inputs"], r["last"]["path"]) for r in newest.collect()}  # a row per view

    def view(self, name: str) -> DataFrame:
        """A view as it was last built."""
        return self.spark.read.parquet(self.built()[name][1])

    def build_views(self, only: set[str] | None = None) -> dict[str, list[str]]:
        """Builds views with changed inputs; returns those ``built``, those ``current`` and those ``skipped`` for want of an input.

        A view is written beside its former version, and stands when its row in the list of builds does.
        """
        have, out = self.built(), {"built": [], "current": [], "skipped": []}
        for view in self.views:
            if only is not None and view.name not in only:
                continue
            tables = {n: self._table(n) for n in view.needs if "/" in n}
            if not all(t.ready() for t in tables.values()) or not all(n in have for n in view.needs if n not in tables):
                out["skipped"].append(view.name)
                continue
            inputs = ";".join(f"{n}={tables[n].commits()[-1] if n in tables else have[n][1]}" for n in view.needs)
            if view.name in have and have[view.name][0] == inputs:
                out["current"].append(view.name)
                continue
            rows = [drop_meta(tables[n].read()) if n in tables else self.spark.read.parquet(have[n][1]) for n in view.needs]
            path = f"{self.warehouse}/views/{view.name}/{uuid.uuid4().hex}"
            view.build(*rows).write.parquet(path)
            build = self.spark.createDataFrame([(view.name, inputs, path)], "view string, inputs string, path string").withColumn("at", F.current_timestamp())
            append_json(build, f"{self.warehouse}/views/_built")
            have[view.name] = (inputs, path)
            out["built"].append(view.name)
        return out
