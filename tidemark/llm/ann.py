"""Approximate nearest neighbours with a forest of random-projection trees.

The forest is fitted on a bounded sample: every inner node has a random
direction and splits at the sample's median projection. All vectors are then
sent to their leaf in every tree, and leaves are dealt into blocks of bounded
size. A query walks all trees through one shared priority queue - the branch
whose largest distance to a crossed split is smallest goes next, whatever tree
it is in - until it has the set number of leaves. Queries and vectors meet by
an equi-join on (tree, leaf, block); each block ranks its members exactly, and
the rankings of a query are merged.

The share of leaves a query visits buys recall. Vectors without neighbourhood
structure (independent directions in 64 dimensions, say) need a large share:
``PROBES`` is set for those; see the README for measured recall.

Defined results
---------------
* vectors that are null, empty, all zero, or hold null or non-finite
  components take no part, neither do those with a null id; nor do vectors of
  another dimension than most (the smaller one, if tied);
* equal vectors are searched as one; of many copies the ``k + 1`` smallest
  ids are kept, which is all a ranking with ties to smaller ids can show;
* rows that repeat both id and vector count once;
* with fewer than ``k`` candidates, all of them are returned;
* an empty table, or one without queries, gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut_lineage

TREES, DEPTH = 8, 6
#: Share of all leaves that a query visits.
PROBES = 0.17
#: Distinct vectors on which the forest is fitted, at most.
SAMPLE = 16_384
#: Sampled vectors a leaf must have on average; small tables get shallower trees.
LEAF_SAMPLE = 16
#: Vectors and queries of a leaf that meet in one task.
BLOCK_VECTORS, BLOCK_QUERIES = 4096, 4096


class Forest:
    """Directions and thresholds of all trees; node ``i`` has the children ``2 i + 1`` and ``2 i + 2``."""

    def __init__(self, sample, trees: int = TREES, depth: int = DEPTH, seed: int = 0):
        import numpy as np

        n, size = sample.shape
        self.trees, self.depth = trees, max(0, min(depth, int(math.log2(max(1, n / LEAF_SAMPLE)))))
        self.inner = 2**self.depth - 1
        rng = np.random.default_rng(seed)
        directions = rng.normal(size=(trees, self.inner, size))
        self.directions = directions / np.linalg.norm(directions, axis=2, keepdims=True)
        self.thresholds = np.zeros((trees, self.inner))
        for t in range(trees):
            members = [np.arange(n)]
            for node in range(self.inner):
                mine = members[node]
                p = sample[mine] @ self.directions[t, node]
                self.thresholds[t, node] = np.median(p) if len(p) else 0.0
                members += [mine[p <= self.thresholds[t, node]], mine[p > self.thresholds[t, node]]]

    def leaves(self, vectors):
        """``len(vectors) x trees``: the leaf of each vector in each tree."""
        import numpy as np

        out = np.zeros((len(vectors), self.trees), dtype=np.int32)
        for t in range(self.trees):
            at = np.zeros(len(vectors), dtype=np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (np.einsum("ij,ij->i", vectors, self.directions[t, at]) > self.thresholds[t, at])
            out[:, t] = at - self.inner
        return out

    def probe(self, vector, leaves: int) -> list[tuple[int, int]]:
        """The ``(tree, leaf)`` pairs that a query visits, best first."""
        import numpy as np

        margins = (np.einsum("tnd,d->tn", self.directions, vector) - self.thresholds).tolist()
        queue, found = [(0.0, t, 0) for t in range(self.trees)], []
        while queue and len(found) < leaves:
            far, t, node = heapq.heappop(queue)
            while node < self.inner:
                m = margins[t][node]
                heapq.heappush(queue, (max(far, abs(m)), t, 2 * node + (1 if m > 0 else 2)))
                node = 2 * node + (2 if m > 0 else 1)
            found.append((t, node - self.inner))
        return found


def usable(v: Column) -> Column:
    """Vectors that take part: without null or non-finite components, not all zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(column):
    import numpy as np

    return np.array(column.to_pylist(), dtype=np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _rank_block(k: int):
    """For a block: the best ``k + 1`` vectors of each query, by exact inner product in double precision."""

    def rank(queries, vectors):
        import numpy as np
        import pyarrow as pa

        q, v = _matrix(queries.column("v").combine_chunks()), _matrix(vectors.column("v").combine_chunks())
        ids = vectors.column("ids").to_pylist()
        lowest = np.array([i[0] for i in ids], dtype=np.int64)
        # a row for each query and near vector; numpy columns, no object for each
        rows, places, scores = [], [], []
        for at in range(0, len(q) if len(v) else 0, 256):
            near = q[at : at + 256] @ v.T
            edge = np.partition(near, len(v) - min(k + 1, len(v)), axis=1)[:, len(v) - min(k + 1, len(v))]
            # the product of matrices may add up in another order than the exact one
            slack = 1e-12 * np.abs(q[at : at + 256]).sum(axis=1) * np.abs(v).max()
            for i, (row, low, x) in enumerate(zip(near, edge - slack, q[at : at + 256], strict=True)):
                some = np.flatnonzero(row >= low)
                exact = (v[some] * x).sum(axis=1)
                best = np.lexsort((lowest[some], -exact))[: k + 1]
                rows.append(np.full(len(best), at + i))
                places.append(some[best])
                scores.append(exact[best])
        rows, places, scores = (np.concatenate(x) if x else np.zeros(0, dtype=kind) for x, kind in ((rows, np.int64), (places, np.int64), (scores, np.float64)))
        return pa.table({"h1": queries.column("h1").combine_chunks().take(pa.array(rows)), "h2": queries.column("h2").combine_chunks().take(pa.array(rows)), "score": pa.array(scores), "ids": vectors.column("ids").combine_chunks().take(pa.array(places))})

    return rank


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, trees: int = TREES, depth: int = DEPTH, probes: float = PROBES, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query row the ``k`` nearest other rows found, by inner product."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.where(usable(F.col("v")) & F.col("id").isNotNull())
    size = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    size = size["size"] if size else 1
    rows = rows.where(F.size("v") == size).withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(1), F.col("v"))})

    # distinct vectors, each with its k + 1 smallest ids; the rank limit applies before the shuffle too
    same = Window.partitionBy("h1", "h2").orderBy("id")
    few = rows.withColumn("rank", F.dense_rank().over(same)).where(F.col("rank") <= k + 1)
    distinct = cut_lineage(few.groupBy("h1", "h2").agg(F.array_sort(F.collect_set("id")).alias("ids"), F.any_value("v").alias("v")))
    asking = cut_lineage(rows.where("asks").select("id", "h1", "h2").distinct())
    queries = distinct.join(asking.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi")

    import numpy as np

    sample = [r["v"] for r in distinct.orderBy("h1", "h2").limit(SAMPLE).select("v").collect()]
    forest = Forest(np.array(sample, dtype=np.float64).reshape(len(sample), size), trees, depth)
    shared = vectors.sparkSession.sparkContext.broadcast(forest)  # trees x nodes x dimension numbers
    wanted = max(1, math.ceil(probes * trees * 2**forest.depth))
    kind = distinct.schema["v"].dataType.simpleString()

    def to_leaves(batches):
        import pyarrow as pa

        for part in batches:
            if part.num_rows:
                found = shared.value.leaves(_matrix(part.column("v")))
                spots = pa.array([[{"tree": t, "leaf": int(x)} for t, x in enumerate(row)] for row in found], pa.list_(pa.struct([("tree", pa.int32()), ("leaf", pa.int32())])))
                yield pa.record_batch([*part.columns, spots], names=[*part.schema.names, "spots"])

    def to_probes(batches):
        import pyarrow as pa

        for part in batches:
            if part.num_rows:
                found = [shared.value.probe(x, wanted) for x in _matrix(part.column("v"))]
                spots = pa.array([[{"tree": t, "leaf": leaf} for t, leaf in row] for row in found], pa.list_(pa.struct([("tree", pa.int32()), ("leaf", pa.int32())])))
                yield pa.record_batch([*part.columns, spots], names=[*part.schema.names, "spots"])

    spots = "spots array<struct<tree:int,leaf:int>>"
    index = distinct.mapInArrow(to_leaves, f"h1 long, h2 long, ids array<long>, v {kind}, {spots}")
    index = index.select("h1", "h2", "ids", "v", F.inline("spots"))
    probe = queries.select("h1", "h2", "v").mapInArrow(to_probes, f"h1 long, h2 long, v {kind}, {spots}").select("h1", "h2", "v", F.inline("spots"))
    index, probe = cut_lineage(index), cut_lineage(probe)

    # blocks: every vector block of a leaf meets every query block of it
    spot = ["tree", "leaf"]
    blocks = index.groupBy(*spot).agg(F.count("*").alias("n")).join(probe.groupBy(*spot).agg(F.count("*").alias("m")), spot)
    blocks = cut_lineage(blocks.select(*spot, F.ceil(F.col("n") / BLOCK_VECTORS).cast("int").alias("nb"), F.ceil(F.col("m") / BLOCK_QUERIES).cast("int").alias("nq")))
    blocks = F.broadcast(blocks)  # at most trees x leaves rows
    vb = F.pmod(F.col("h1"), F.col("nb")).cast("int")
    qb = F.pmod(F.col("h1"), F.col("nq")).cast("int")
    left = probe.join(blocks, spot).select("h1", "h2", "v", *spot, qb.alias("qb"), F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("vb"))
    right = index.join(blocks, spot).select("ids", "v", *spot, vb.alias("vb"), F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("qb"))
    key = [*spot, "vb", "qb"]
    ranked = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_rank_block(k), "h1 long, h2 long, score double, ids array<long>")

    # a vector may come from several trees: equal rows share a dense rank, so the limit holds before the shuffle as well
    best = Window.partitionBy("h1", "h2").orderBy(F.desc("score"), F.col("ids")[0])
    merged = ranked.withColumn("place", F.dense_rank().over(best)).where(F.col("place") <= k + 1).dropDuplicates(["h1", "h2", "place"])
    merged = merged.groupBy("h1", "h2").agg(F.collect_list(F.struct((-F.col("score")).alias("d"), "ids")).alias("top"))  # at most k + 1 of each
    merged = cut_lineage(merged)
    flat = F.flatten(F.transform("top", lambda t: F.transform(t["ids"], lambda i: F.struct(t["d"].alias("d"), i.alias("id")))))
    found = asking.withColumnRenamed("id", "query_id").join(merged, ["h1", "h2"])
    found = found.select("query_id", F.slice(F.filter(F.array_sort(flat), lambda x: x["id"] != F.col("query_id")), 1, k).alias("found"))
    return found.select("query_id", F.posexplode("found").alias("at", "x")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.d")).alias("score"))
