"""links between minor members and a block of members that they are not in."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import minhash


def block(prefix, rows):
    ids, labels, elements = zip(*rows, strict=True)
    return pa.table({f"{prefix}id": pa.array(ids, pa.int64()), f"{prefix}label": pa.array(labels, pa.int64()), f"{prefix}elements": pa.array(elements, pa.list_(pa.int64()))})


def test_elements_that_one_member_of_a_block_holds():
    minors = block("minor_", [(1, 1, [1, 2, 3, 4, 5]), (2, 2, [11, 12, 13, 14, 15])])
    members = block("", [(2, 2, [11, 12, 13, 14, 15]), (7, 7, [1, 2, 3, 4, 5, 6]), (8, 8, [21, 22]), (9, 9, [11, 12, 13, 14])])
    found = minhash._block_links(0.8)(minors, members)
    assert set(zip(found["a"].to_pylist(), found["b"].to_pylist(), strict=True)) == {(7, 1), (9, 2)}


@pytest.mark.parametrize("rows_of_a_block", [2, 5, 4096])
def test_links_of_a_bucket_in_many_blocks(spark, monkeypatch, rows_of_a_block):
    """Thirty pairs of like sets in one bucket, whose representative is like none of them."""
    monkeypatch.setattr(minhash, "BLOCK_ROWS", rows_of_a_block)
    sets = [(2 * k + e, [100 * k + x for x in range(10 - e)]) for k in range(1, 31) for e in (0, 1)] + [(1, [0])]
    rows = spark.createDataFrame([(5, i, i, 1) for i, _ in sets], "key long, id long, label long, main long")
    links = minhash.bucket_links(rows, spark.createDataFrame(sets, "id long, elements array<long>"), 0.8)
    assert {tuple(r) for r in links.select(F.col("a"), F.col("b")).collect()} == {(2 * k + 1, 2 * k) for k in range(1, 31)}
