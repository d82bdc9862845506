"""Real streams over landed files, and batches from a database behind a stored high-water mark."""

import json
import uuid

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark.sources import readers
from tidemark.sources.tables import SnapshotTable, TableSpec
from tidemark.streaming import ingest

SCHEMA = "id long, k string, at timestamp, v double"


class Landing:
    def __init__(self, folder):
        self.folder, self.n = folder, 0
        folder.mkdir()

    def put(self, *rows):
        self.n += 1
        (self.folder / f"{self.n}.json").write_text("\n".join(json.dumps({"id": i, "k": k, "at": f"2024-01-01 {at}", "v": v}) for i, k, at, v in rows))


def run(query):
    query.processAllAvailable()
    query.stop()
    return query


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    landing, out = Landing(tmp_path / "in"), tmp_path / "out"
    stream = ingest.json_stream(spark, str(landing.folder), SCHEMA, files_per_batch=1)
    counts = ingest.tumbling(stream, "at", "10 minutes", ["k"], [F.count("*").alias("n"), F.sum("v").alias("total")], late="20 minutes")
    query = counts.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(tmp_path / "state")).outputMode("append").start()
    try:
        for rows in ([(1, "a", "10:01:00", 1.0), (2, "a", "10:05:00", 2.0)], [(3, "a", "10:25:00", 1.0), (4, "a", "10:08:00", 4.0)], [(5, "a", "11:00:00", 1.0)], [(6, "a", "10:02:00", 100.0), (7, "b", "11:01:00", 1.0)], [(8, "a", "12:00:00", 1.0)]):
            landing.put(*rows)
            query.processAllAvailable()  # a batch each, so that the watermark moves between them
        late = ingest.dropped_late(query)
    finally:
        query.stop()
    got = {(str(r["window_start"]), r["k"]): (r["n"], r["total"]) for r in spark.read.parquet(str(out)).collect()}
    assert got[("2024-01-01 10:00:00", "a")] == (3, 7.0)  # row 4 was out of order but in time, row 6 was late
    assert got[("2024-01-01 10:20:00", "a")] == (1, 1.0) and ("2024-01-01 12:00:00", "a") not in got
    assert late == 1


def test_repeats_within_the_watermark_are_dropped(spark, tmp_path):
    landing, name = Landing(tmp_path / "in"), f"once_{uuid.uuid4().hex[:8]}"
    stream = ingest.json_stream(spark, str(landing.folder), SCHEMA, files_per_batch=1)
    query = ingest.once(stream, ["id"], "at", "10 minutes").writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / "state")).outputMode("append").start()
    try:
        for rows in ([(1, "a", "10:00:00", 1.0), (1, "a", "10:01:00", 2.0), (2, "a", "10:02:00", 3.0)], [(1, "a", "10:03:00", 4.0)], [(9, "a", "13:00:00", 5.0)], [(9, "a", "13:00:01", 6.0), (3, "a", "13:01:00", 7.0)]):
            landing.put(*rows)
            query.processAllAvailable()
    finally:
        query.stop()
    rows = spark.table(name).collect()
    assert sorted(r["id"] for r in rows) == [1, 2, 3, 9]


def test_a_failed_batch_is_replayed_without_loss_or_repeat(spark, tmp_path):
    landing = Landing(tmp_path / "in")
    table = SnapshotTable(spark, str(tmp_path / "wh"), TableSpec("t", ("id",), "at"))
    calls = []

    def shape(df):
        calls.append(df.count())
        if len(calls) == 2:
            raise RuntimeError("lost")
        return df

    def go(after=None):
        return ingest.ingest(ingest.json_stream(spark, str(landing.folder), SCHEMA), table, str(tmp_path / "state"), shape, after)

    landing.put((1, "a", "10:00:00", 1.0))
    go().awaitTermination()
    landing.put((1, "b", "11:00:00", 2.0), (2, "a", "10:00:00", 1.0))
    with pytest.raises(StreamingQueryException):
        go().awaitTermination()
    assert table.read().count() == 1
    go().awaitTermination()
    assert {r["id"]: r["k"] for r in table.read().collect()} == {1: "b", 2: "a"}

    def fail_once():  # the merge is done, the batch isn't committed
        if len(calls) == 4:
            raise RuntimeError("lost behind the merge")

    landing.put((3, "c", "12:00:00", 1.0))
    with pytest.raises(StreamingQueryException):
        go(fail_once).awaitTermination()
    go(fail_once).awaitTermination()
    assert sorted((r["id"], r["k"]) for r in table.read().collect()) == [(1, "b"), (2, "a"), (3, "c")]
    assert calls == [1, 2, 2, 1, 1]


@pytest.fixture
def database(spark, tmp_path):
    """A Derby database in a folder, which Spark brings along."""
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    jvm = spark.sparkContext._jvm
    jvm.java.lang.Class.forName("org.apache.derby.jdbc.EmbeddedDriver")
    connection = jvm.java.sql.DriverManager.getConnection(url)
    statement = connection.createStatement()
    yield url, statement.execute
    connection.close()


def test_database_batches(spark, tmp_path, database):
    url, execute = database
    execute("create table pay (id bigint, at_ts timestamp, v double)")
    table = SnapshotTable(spark, str(tmp_path / "wh"), TableSpec("pay", ("id",), "at_ts"))
    log, seen, fail = str(tmp_path / "offsets"), [], []

    def merge(df):
        df = df.toDF(*[c.lower() for c in df.columns])
        seen.append((df.count(), df.rdd.getNumPartitions()))
        if fail == ["before"]:
            raise RuntimeError("lost before the merge")
        table.upsert(df)
        if fail == ["behind"]:
            raise RuntimeError("lost between merge and commit")

    step = lambda: readers.jdbc_batch(spark, url, "pay", "at_ts", log, merge, {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}, parts=3, by="id")
    assert step() is False
    for k in range(30):
        execute(f"insert into pay values ({k}, timestamp('2024-01-01 10:{k:02d}:00'), {k}.5)")
    execute("insert into pay values (99, null, 1.0)")
    assert step() is True and seen[-1] == (30, 3) and step() is False
    execute("insert into pay values (5, timestamp('2024-01-02 10:00:00'), 55.0)")
    execute("insert into pay values (40, timestamp('2024-01-02 10:00:01'), 40.0)")
    for kind in ("before", "behind"):
        fail[:] = [kind]
        with pytest.raises(RuntimeError):
            step()
    fail.clear()
    assert step() is True and seen[-1][0] == 2 and step() is False
    rows = {r["id"]: r["v"] for r in table.read().collect()}
    assert len(rows) == 31 and rows[5] == 55.0 and rows[40] == 40.0
    assert str(readers.stored_offset(spark, log, "timestamp")) == "2024-01-02 10:00:01"
