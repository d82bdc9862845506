"""Documents through their states: the cases of a run, failures of its helpers, conflicts."""

import pytest
from pyspark.sql import functions as F

from tidemark.plans import document_states as ds

META = "array<struct<fileName:string,fileSize:long,mimeType:string,encryption:string>>"
DOCS = f"_id string, _attachments map<string,binary>, metadata {META}"
KEY = "000102030405060708090a0b0c0d0e0f"


@pytest.fixture
def docs(spark):
    file = lambda size=10, encryption=None: [("f.txt", size, "text/plain", encryption)]
    secret = spark.range(1).select(F.aes_encrypt(F.lit("hidden words").cast("binary"), F.unhex(F.lit(KEY)), F.lit("GCM"))).first()[0]
    return spark.createDataFrame([
        ("plain", {"b": b"second", "a": b"first"}, file()), ("long", {"a": b"x" * 40_000}, file(40_000)), ("none", {}, file()), ("nul", None, file()), ("nometa", {"a": b"t"}, []), ("big", {"a": b"t"}, file(60 * 1024 * 1024)),
        ("secret", {"a": bytes(secret)}, file(10, "aes")), ("broken", {"a": b"not encrypted"}, file(10, "aes")), ("odd", {"a": b"\xff\xfe"}, file()),
    ], DOCS)


class Sink:
    def __init__(self, refuses=()):
        self.rows, self.refuses = {}, refuses

    def __call__(self, df):
        for r in df.collect():
            if r["doc_id"] not in self.refuses:
                self.rows[r["doc_id"]] = r
        return df.where(F.col("doc_id").isin(*self.refuses)).select("doc_id", F.lit("refused by sink").alias("error")) if self.refuses else None


def ends(df):
    return {r["doc_id"]: (r["status"], r["error"]) for r in df.collect()}


def test_a_run_and_its_errors(spark, tmp_path, docs):
    table, index, forward = ds.state_table(spark, str(tmp_path)), Sink(), Sink()
    got = ends(ds.run(docs, table, index, forward, key=KEY))
    assert got == {
        "plain": ("COMPLETED", None), "long": ("COMPLETED", None), "secret": ("COMPLETED", None), "none": ("ERROR", "No attachments found"), "nul": ("ERROR", "No attachments found"), "nometa": ("ERROR", "Document metadata missing"),
        "big": ("ERROR", "File too large: 60MB"), "broken": ("ERROR", "Decryption failed"), "odd": ("ERROR", "No text could be extracted"),
    }
    assert set(index.rows) == set(forward.rows) == {"plain", "long", "secret"}
    assert index.rows["plain"]["content"] == "first" and index.rows["secret"]["content"] == "hidden words"
    assert (len(index.rows["long"]["content"]), index.rows["long"]["text_length"], len(forward.rows["long"]["content"])) == (30_000, 40_000, 40_000)
    states = {r["doc_id"]: (r["status"], r["revision"], r["error"]) for r in ds.states_of(table).collect()}
    assert states["plain"] == ("COMPLETED", 2, None) and states["big"] == ("ERROR", 2, "File too large: 60MB")
    # a second run takes what has not been completed, and nothing else
    again = ends(ds.run(docs.where("_id in ('plain', 'broken')"), table, index, forward, key=KEY))
    assert again == {"broken": ("ERROR", "Decryption failed")}
    assert ds.run(docs.where("_id = 'plain'"), table, index, forward).count() == 0


def test_failures_of_sinks_are_errors_of_their_documents(spark, tmp_path, docs):
    table, index, forward = ds.state_table(spark, str(tmp_path)), Sink(["long"]), Sink(["plain"])
    got = ends(ds.run(docs.where("_id in ('plain', 'long', 'secret')"), table, index, forward, key=KEY))
    assert got == {"plain": ("ERROR", "refused by sink"), "long": ("ERROR", "refused by sink"), "secret": ("COMPLETED", None)}
    assert "long" not in forward.rows and "plain" in index.rows
    got = ends(ds.run(docs.where("_id in ('plain', 'long', 'secret')"), table, Sink(), Sink(), key=KEY))
    assert got == {"plain": ("COMPLETED", None), "long": ("COMPLETED", None)}
    assert ends(ds.run(docs.where("_id = 'secret'"), ds.state_table(spark, str(tmp_path / "other")), Sink(), Sink()))["secret"] == ("ERROR", "Decryption failed")  # no key


def test_conflicts_are_retried_later_each_time(spark, tmp_path):
    table, waits = ds.state_table(spark, str(tmp_path)), []
    wanted = lambda seen, status, *ids: spark.createDataFrame([(i, seen, status, None) for i in ids], "doc_id string, seen long, status string, error string")
    ds.change(table, wanted(0, "PROCESSING", "a", "b"))
    ds.change(table, wanted(0, "COMPLETED", "a"), sleep=waits.append)  # based on a revision that is gone
    assert waits == [1.0] and {r["doc_id"]: (r["status"], r["revision"]) for r in ds.states_of(table).collect()} == {"a": ("COMPLETED", 2), "b": ("PROCESSING", 1)}

    def meddle(seconds):  # somebody else is always first
        waits.append(seconds)
        ds.change(table, states_now())

    def states_now():
        return ds.states_of(table).where("doc_id = 'b'").select("doc_id", F.col("revision").alias("seen"), F.lit("PROCESSING").alias("status"), F.lit(None).cast("string").alias("error"))

    waits.clear()
    with pytest.raises(ds.Conflict):
        ds.change(table, wanted(7, "COMPLETED", "b", "c").withColumn("seen", F.when(F.col("doc_id") == "c", 0).otherwise(F.col("seen"))), sleep=meddle)
    assert waits == [1.0, 2.0] and {r["doc_id"]: r["status"] for r in ds.states_of(table).collect()} == {"a": "COMPLETED", "b": "PROCESSING", "c": "COMPLETED"}
