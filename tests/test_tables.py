"""Keyed tables, streams, the service and quality."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import columns, joins, quality, windows
from tidemark.plans.service import Forbidden, QueryService
from tidemark.sources import readers
from tidemark.sources.tables import SnapshotTable, TableSpec, catalog, commit_histogram
from tidemark.streaming import ingest


def frame(spark, rows, schema="id long, v string, at long"):
    return spark.createDataFrame(rows, schema)


def test_upsert_is_keyed_idempotent_and_versioned(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "gold"), TableSpec("t", ("id",), "at"))
    assert not table.ready()
    with pytest.raises(LookupError):
        table.read()
    first = table.upsert(frame(spark, [(1, "a", 1), (1, "b", 2), (2, "c", 1)]), "20240101000000000")
    table.upsert(frame(spark, [(2, "d", 5), (3, "e", 1)]), "20240102000000000")
    state = lambda t, **k: {r["id"]: r["v"] for r in t.read(**k).collect()}
    assert state(table) == {1: "b", 2: "d", 3: "e"}
    assert state(table, as_of=first) == {1: "b", 2: "c"} == state(table, as_of="20240101")
    table.upsert(frame(spark, [(2, "d", 5), (3, "e", 1)]), "20240103000000000")
    assert state(table) == {1: "b", 2: "d", 3: "e"}
    table.upsert(spark.createDataFrame([(4, 9)], "id long, extra long").withColumn("at", F.lit(1)), "20240104000000000")
    assert {r["id"]: r["extra"] for r in table.read().collect()} == {1: None, 2: None, 3: None, 4: 9}
    assert [r["rows"] for r in table.history().orderBy("instant").collect()] == [2, 3, 3, 4]
    assert catalog(spark, str(tmp_path)).collect()[0]["commits"] == 4
    keyed = SnapshotTable(spark, str(tmp_path / "keys"), TableSpec("k", ("a", "b"), "at"))
    odd = [("a||b", "c", 1), ("a", "b||c", 1), (None, "", 1), ("", None, 1), ("", "", 1)]
    keyed.upsert(spark.createDataFrame(odd, "a string, b string, at long"), "1")
    before = {p.name for p in (tmp_path / "keys/k/v=1").iterdir() if p.name.startswith("_bucket")}
    keyed.upsert(spark.createDataFrame([("a", "b||c", 2)], "a string, b string, at long"), "2")
    assert sorted((r["a"] or "-", r["b"] or "-", r["at"]) for r in keyed.read().collect()) == sorted((a or "-", b or "-", 2 if a == "a" else n) for a, b, n in odd)
    assert len(before) > 1 and len([p for p in (tmp_path / "keys/k/v=2").iterdir() if p.name.startswith("_bucket")]) == 1  # only the bucket of the batch
    with pytest.raises(ValueError, match="after"):
        keyed.upsert(spark.createDataFrame(odd, "a string, b string, at long"), "2")
    keyed.upsert(spark.createDataFrame([("new", "x", 2.5)], "a string, b string, at double"), "3")  # a type changed: all is written anew
    assert keyed.read().count() == 6 and keyed.vacuum() == ["1", "2"] and keyed.read().count() == 6
    assert sum(r["n"] for r in commit_histogram(table.read()).collect()) == 4
    assert columns.drop_meta(table.read()).columns[0] in ("id", "v", "at", "extra")
    assert readers.latest_version(table.read(), "id").count() == 4


def test_stream_ingest_merges_once(spark, tmp_path):
    landed = tmp_path / "in"
    landed.mkdir()
    table = SnapshotTable(spark, str(tmp_path / "gold"), TableSpec("s", ("id",), "at"))
    rebuilt = []

    def deliver(name, rows):
        (landed / name).write_text("\n".join(json.dumps(r) for r in rows))
        stream = ingest.json_stream(spark, str(landed), "id long, v string, at long")
        ingest.ingest(stream, table, str(tmp_path / "ckpt"), after=lambda: rebuilt.append(1)).awaitTermination(60)

    deliver("a.json", [{"id": 1, "v": "a", "at": 1}])
    deliver("b.json", [{"id": 1, "v": "b", "at": 2}, {"id": 2, "v": "x", "at": 1}])
    assert {r["id"]: r["v"] for r in table.read().collect()} == {1: "b", 2: "x"}
    assert len(rebuilt) == 2


def test_service_scopes_and_refuses(spark, tmp_path):
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "tenant_id string, x int").write.parquet(str(tmp_path / "t"))
    spark.createDataFrame([(1,)], "x int").write.parquet(str(tmp_path / "open"))
    service = QueryService(spark, {"t": str(tmp_path / "t"), "open": str(tmp_path / "open")}, "a")
    assert service.query("t").count() == 2
    assert service.query("t", {"x": [1, 3]}, ["x"]).collect()[0]["x"] == 1
    assert service.sql("select sum(x) as s from t;").collect()[0]["s"] == 3
    assert service.rows(service.query("t", columns=["x"], limit=1)) in ([{"x": 1}], [{"x": 2}])
    for bad in ({"limit": 0}, {"limit": 10_001}, {"columns": ["nope"]}):
        with pytest.raises(ValueError):
            service.query("t", **bad)
    with pytest.raises(ValueError, match="tenant"):
        service.query("open")
    with pytest.raises(LookupError):
        service.query("missing")
    for text in ("drop table t", "with x as (select 1) insert into t select 1, 2", "select 1; select 2"):
        with pytest.raises(ValueError):
            service.sql(text)
    with pytest.raises(Forbidden):
        service.sql("select 1 as a union all select 2; delete from t")
    with pytest.raises(Exception):  # noqa: B017  a path is no table
        service.sql(f"select * from parquet.`{tmp_path}/t`").collect()
    assert service.sql("select 'drop it' as words").count() == 1
    # another tenant's saved tables and views, other databases and Java code are out of reach
    spark.createDataFrame([("b", 9)], "tenant_id string, x int").createOrReplaceGlobalTempView("g")
    spark.sql("drop table if exists other_secret")
    spark.createDataFrame([("b", 9)], "tenant_id string, x int").write.mode("overwrite").saveAsTable("other_secret")
    outside = ["other_secret", "global_temp.g", "default.other_secret", "spark_catalog.default.other_secret", "(select * from other_secret)", "t where x in (select x from other_secret)", "t join other_secret using (x)", "table(other_secret)"]
    for text in [*(f"select * from {o}" for o in outside), "with t2 as (select * from other_secret) select * from t2", "select (select max(x) from global_temp.g) as x from t", "select java_method('java.lang.System', 'getProperty', 'user.home') as h", "select reflect('java.lang.System', 'currentTimeMillis') as h", "select `reflect`('java.lang.System', 'currentTimeMillis') as h"]:
        with pytest.raises(Exception):  # noqa: B017
            service.sql(text).collect()
    detours = [
        "with other_secret as (select * from other_secret) select * from other_secret", "select * from (with other_secret as (select * from other_secret) select * from other_secret)", "select * from identifier('other_secret')", "select * from identifier('other' || '_secret')",
        "select x from t where exists (select * from identifier('other_secret'))", "select current_user() as u", "select current_user as u", "select current_catalog() as c", "select input_file_name() as f from t", "explain select * from t", "cache table t", "set spark.sql.runSQLOnFiles=true",
        "describe t", "show tables", "select * from t lateral view explode(array((select max(x) from other_secret))) as e", "select transform(array(1), v -> (select max(x) from other_secret)) as a", "select x from t group by x having x > (select max(x) from default.other_secret)", "select * from t order by (select max(x) from other_secret)",
    ]
    for text in detours:
        with pytest.raises(Exception):  # noqa: B017
            service.sql(text).collect()
    with pytest.raises(Forbidden):
        service.sql("with other_secret as (select * from other_secret) select * from other_secret")
    with pytest.raises(Forbidden):
        service.sql("select * from spark_catalog.default.other_secret")
    spark.sql("drop table other_secret")
    assert service.sql("with t as (select x + 1 as x from t) select max(x) as m from t").collect()[0]["m"] == 3
    assert service.sql("select tenant_id, rank() over (order by x) as r, sum(x) over (partition by tenant_id) as n from t where x between 1 and 2 and tenant_id like 'a%' and not x is null").count() == 2
    assert service.sql("select a.x, case when a.x in (1, 3) then 'one' else cast(a.x as string) end as s from t a left join (values (1, 'p')) as v(x, p) on a.x = v.x where exists (select 1 from t b where b.x >= a.x)").count() == 2
    assert service.sql("with y as (select x as `set`, x + 1 as load from t) select max(`set`) as m, max(load) as n from y").collect()[0] == (2, 3)
    assert service.sql("select count(*) as n from t a join t b on a.x = b.x where a.x in (select x from t)").collect()[0]["n"] == 2
    assert service.sql("select id from range(3)").count() == 3


def test_split_keeps_every_row(spark):
    df = frame(spark, [(1, "a", 1), (None, "b", 2), (3, None, None)])
    good, bad = quality.split(df, {"NO_ID": F.col("id").isNull(), "NO_V": F.col("v").isNull(), "NO_AT": F.col("at").isNull()})
    assert good.count() == 1
    assert sorted(map(tuple, (r["dq_reasons"] for r in bad.collect()))) == [("NO_ID",), ("NO_V", "NO_AT")]
    assert quality.dead_letters(bad, ["id"]).select("dlq_id").distinct().count() == 2


def test_columns(spark):
    df = spark.createDataFrame([(1, (2, {"k": [1]}), "x")], "a int, b struct<c:int,d:map<string,array<int>>>, `e-f` string")
    flat = columns.flatten(df)
    assert flat.columns == ["a", "b_c", "b_d", "e_f"]
    assert columns.require_scalar(flat) is flat
    with pytest.raises(ValueError, match="b"):
        columns.require_scalar(df)
    cast = columns.ensure_columns(df, {"z": "date", "e-f": "int"}, cast=False)
    assert dict(cast.dtypes)["z"] == "date"
    with pytest.raises(ValueError):
        columns.tenant_column(df)


def test_joins_do_not_multiply(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    right = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    out = joins.enrich(left, right, ["k"], ["v"], [F.desc("v")])
    assert sorted((r["id"], r["v"]) for r in out.collect() if r["v"]) == [(1, 2), (2, 1)]
    assert out.count() == 3
    latest = windows.latest_per_key(right, ["k"], [F.desc("v")])
    assert {r["k"]: r["v"] for r in latest.collect()} == {"a": 2, "b": 1}


def test_paths():
    registry = {"alerts": "alerts", "alert": "alerts", "sla_policies": "sla_policies"}
    assert readers.resolve_table(registry, None, "s3a://b/db/sla-policies/2024/x.json") == "sla_policies"
    assert readers.resolve_table(registry, "Alert", "s3a://b/db/other/x.json") == "alerts"
    assert readers.resolve_table(registry, None, "s3a://b/raw/unknown/x.json") is None


def test_upsert_evaluates_a_batch_once_and_rewrites_what_it_touches(spark, tmp_path):
    for n in (300, 3000):
        table = SnapshotTable(spark, str(tmp_path / str(n)), TableSpec("t", ("id",), "at", buckets=4, bucket_rows=50))
        table.upsert(spark.range(n).select("id", F.lit(1).alias("at"), F.lit("old").alias("v")))
        evaluated = spark.sparkContext.accumulator(0)

        def count(frames, evaluated=evaluated):
            for f in frames:
                evaluated.add(len(f))
                yield f

        batch = spark.createDataFrame([(5, 2, "new"), (n - 1, 2, "new"), (5, 1, "older")], "id long, at int, v string").mapInPandas(count, "id long, at int, v string")
        instant = table.upsert(batch)
        note = table._note(instant)
        assert evaluated.value == 3
        assert len([b for b, v in note["where"].items() if v == instant]) <= 2
        assert note["buckets"] >= n / 50 > note["buckets"] / 4  # as many as the table's size asks for
        assert table.read().where("v = 'new'").count() == 2 and table.read().count() == n
    # a table that grows past its buckets is dealt anew, once
    grown = table.upsert(spark.range(3000, 8000).select("id", F.lit(3).alias("at"), F.lit("more").alias("v")))
    assert table._note(grown)["buckets"] > note["buckets"] and table.read().count() == 8000 and table.read().where("v = 'new'").count() == 2
