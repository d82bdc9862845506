"""Spanning forests and density clusters as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.written import Written

#: Points, and pairs of them, whose distances are held at once; neighbours in order on either side that are tried first.
ROWS_AT_ONCE, PAIRS_AT_ONCE, NEXT = 256, 1_000_000, 16


def spanning_forest(edges: DataFrame, written: Written) -> tuple[DataFrame, DataFrame]:
    """Minimum spanning forest of ``a, b, w`` by Borůvka rounds: its edges, and ``id, label`` of every end with the smallest id of its tree.

    In a round every tree takes its lightest edge to another tree (ties by the
    ids of the ends, so that no cycle can close) and trees that are joined get
    one label by pointer jumping. Edges inside a tree are left out of the next
    round; trees at least halve in number, so the rounds grow with the logarithm
    of the points. Edges are oriented and counted once; parallel ones may occur.
    """
    edges = written.cut(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "w").groupBy("a", "b").agg(F.min("w").alias("w")))
    labels = written.cut(edges.select(F.col("a").alias("id")).unionByName(edges.select(F.col("b").alias("id"))).distinct().withColumn("label", F.col("id")))
    open_edges = written.cut(edges.select("a", "b", "w", F.col("a").alias("la"), F.col("b").alias("lb")))
    forest = None
    while True:
        best = F.min(F.struct("w", "a", "b", "la", "lb")).alias("e")
        both = open_edges.select("*", F.explode(F.array("la", "lb")).alias("tree"))
        chosen = written.cut(both.groupBy("tree").agg(best).select("tree", "e.*"))
        if not chosen.limit(1).count():
            break
        taken = chosen.select("a", "b", "w").distinct()
        forest = taken if forest is None else forest.unionByName(taken)
        # each tree points at the tree behind its edge; of two that point at each other the smaller is the root
        other = F.when(F.col("tree") == F.col("la"), F.col("lb")).otherwise(F.col("la"))
        points = chosen.select("tree", other.alias("to"))
        back = points.select(F.col("tree").alias("to"), F.col("to").alias("back"))
        root = (F.col("back") == F.col("tree")) & (F.col("tree") < F.col("to"))
        up = written.cut(points.join(back, "to").select("tree", F.when(root, F.col("tree")).otherwise(F.col("to")).alias("to")))
        while up.join(up.select(F.col("tree").alias("to"), F.col("to").alias("next")).hint("merge"), "to").where("next != to").limit(1).count():
            ahead = up.select(F.col("tree").alias("to"), F.col("to").alias("next"))
            jumped = written.cut(up.join(ahead.hint("merge"), "to").select("tree", F.col("next").alias("to")))
            written.drop(up)
            up = jumped
        moved = up.select(F.col("tree").alias("label"), F.col("to").alias("new"))
        # a large tree's label is a hot key: merge joins, which adaptive execution splits
        relabelled = written.cut(labels.join(moved.hint("merge"), "label", "left").select("id", F.coalesce("new", "label").alias("label")))
        at = lambda c: up.select(F.col("tree").alias(f"l{c}"), F.col("to").alias(f"n{c}"))
        moved_edges = open_edges.join(at("a").hint("merge"), "la").join(at("b").hint("merge"), "lb")
        left = written.cut(moved_edges.where("na != nb").select("a", "b", "w", F.col("na").alias("la"), F.col("nb").alias("lb")))
        written.drop(labels, open_edges, up)
        labels, open_edges = relabelled, left
    smallest = labels.groupBy("label").agg(F.min("id").alias("least"))
    named = written.cut(labels.join(smallest.hint("merge"), "label").select("id", F.col("least").alias("label")))
    if forest is None:
        forest = edges.select("a", "b", "w").limit(0)
    return written.cut(forest), named


def _cells(v: str, over: list[int], reach: float) -> Column:
    return F.array(*[F.floor(F.col(v)[k] / reach).cast("long") for k in over])


def _neighbourhoods(points: DataFrame, over: list[int], reach: float) -> DataFrame:
    """Every point once in its own cell and in those around it, as ``cell`` and ``own``."""
    near = F.array(F.lit(0).cast("long"))
    shifts = [F.array()]
    for _ in over:
        shifts = [F.concat(s, F.array(F.lit(k).cast("long"))) for s in shifts for k in (-1, 0, 1)]
    near = F.array(*[F.zip_with("at", s, lambda x, k: x + k) for s in shifts]) if over else F.array(F.array().cast("array<long>"))
    return points.withColumn("at", _cells("v", over, reach)).withColumn("cell", F.explode(near)).withColumn("own", F.col("cell") == F.col("at")).drop("at")


def _matrix(column):
    import numpy as np
    import pyarrow as pa

    lists = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(lists.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(lists), -1)


def _distances(x, y):
    import numpy as np

    out = np.zeros((len(x), len(y)))
    for k in range(x.shape[1]):
        out += (x[:, k, None] - y[None, :, k]) ** 2
    return np.sqrt(out)


def _along(v):
    """Points in order of the component that varies most, and that component."""
    import numpy as np

    axis = int(np.ptp(v, axis=0).argmax()) if v.size else 0
    order = np.argsort(v[:, axis], kind="stable") if v.size else np.zeros(len(v), dtype=np.int64)
    return order, v[order, axis] if v.size else np.zeros(len(v))


def _span(along, rows, bound, of=None):
    """From where to where points lie that may be within ``bound`` of ``rows``."""
    import numpy as np

    of, at = along if of is None else of, along[rows]
    pad = bound * (1 + 1e-9) + 1e-9 * max(abs(along[0]), abs(along[-1]))  # for what rounding adds
    return int(np.searchsorted(of, at.min() - pad)), int(np.searchsorted(of, at.max() + pad, side="right"))


def _blocks(v, along, rows, bound):
    """``rows`` by parts, each with the points that may be within their bounds, as ``rows, from, distances``; ``v`` is in order."""
    stack = [rows[part : part + ROWS_AT_ONCE] for part in range(0, len(rows), ROWS_AT_ONCE)][::-1]
    while stack:
        part = stack.pop()
        lo, hi = _span(along, part, bound[part].max())
        if len(part) > 1 and len(part) * (hi - lo) > PAIRS_AT_ONCE:
            stack += [part[len(part) // 2 :], part[: len(part) // 2]]
        else:
            yield part, lo, _distances(v[part], v[lo:hi])


def _beside(v, rows):
    """The points next to each of ``rows`` in order, and their distances: what is near among them bounds what is nearest of all."""
    import numpy as np

    near = np.clip(rows[:, None] + np.arange(-NEXT, NEXT + 1)[None, :], 0, len(v) - 1)
    near.sort(axis=1)
    again = np.concatenate([np.zeros((len(rows), 1), dtype=bool), near[:, 1:] == near[:, :-1]], axis=1)
    d = np.sqrt(((v[rows][:, None, :] - v[near]) ** 2).sum(axis=2))
    return near, np.where(again, np.inf, d)


def _nth(d, n, others: int):
    """Distance to the ``others``-th other point in each row; points at ``n`` copies, infinite where there are not so many."""
    import numpy as np

    k = min(others + 1, d.shape[1])
    order = np.argpartition(d, k - 1, axis=1)[:, :k]
    least = np.take_along_axis(d, order, axis=1)
    first = np.argsort(least, axis=1, kind="stable")
    least, order = np.take_along_axis(least, first, axis=1), np.take_along_axis(order, first, axis=1)
    # copies of a point are others at distance 0; the point itself is not
    counted = np.cumsum(np.take_along_axis(np.broadcast_to(n, d.shape), order, axis=1), axis=1) - 1
    at = (counted >= others).argmax(axis=1)
    return np.where(counted[:, -1] >= others, least[np.arange(len(d)), at], np.inf)


def _core(min_samples: int, reach: float):
    """Distance from each point of a cell to its ``min_samples``-th other point; only those within reach count."""

    def run(table):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        if not pc.any(table.column("own")).as_py():
            return pa.table({"id": pa.array([], pa.int64()), "core": pa.array([], pa.float64())})
        v = _matrix(table.column("v"))
        order, along = _along(v)
        v, n, own, ids = v[order], table.column("n").to_numpy()[order], table.column("own").to_numpy(zero_copy_only=False)[order], table.column("id").to_numpy()[order]
        mine, core, bound = np.flatnonzero(own), np.full(len(ids), np.inf), np.full(len(ids), reach)
        for part in range(0, len(mine), ROWS_AT_ONCE):
            rows = mine[part : part + ROWS_AT_ONCE]
            near, d = _beside(v, rows)
            bound[rows] = np.minimum(reach, _nth(d, n[near], min_samples))
        for rows, lo, d in _blocks(v, along, mine, bound):
            core[rows] = _nth(d, n[lo : lo + d.shape[1]], min_samples)
        mine = mine[core[mine] <= reach]
        return pa.table({"id": pa.array(ids[mine]), "core": pa.array(core[mine])})

    return run


def _components(v, along, reach: float):
    """Numbers of the sets of points that steps of up to ``reach`` connect. A point once reached is met by no other."""
    import numpy as np

    of, left, count = np.full(len(v), -1), np.arange(len(v)), 0
    while len(left):
        edge, left = [left[:1]], left[1:]
        of[edge[0]] = count
        while edge and len(left):
            rows = edge.pop()
            lo, hi = _span(along, rows, reach, along[left])
            if lo == hi:
                continue
            size = max(1, min(ROWS_AT_ONCE, PAIRS_AT_ONCE // (hi - lo)))
            if len(rows) > size:
                edge += [rows[size:]]
                rows = rows[:size]
            ahead = left[lo:hi]
            met = (_distances(v[rows], v[ahead]) <= reach).any(axis=0)
            if met.any():
                of[ahead[met]] = count
                edge.append(ahead[met])
                left = np.concatenate([left[:lo], ahead[~met], left[hi:]])
        count += 1
    return of, count


def _local_links(reach: float):
    """Points of a cell and those around it that are connected within reach to one of the cell, with the least id of what is connected; for those of the cell, their closest link (mutual reachability)."""

    def run(table):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        if not pc.any(table.column("own")).as_py():
            return pa.table({"id": pa.array([], pa.int64()), "label": pa.array([], pa.int64()), "own": pa.array([], pa.bool_()), "w": pa.array([], pa.float64())})
        v = _matrix(table.column("v"))
        order, along = _along(v)
        v, ids, core, own = v[order], table.column("id").to_numpy()[order], table.column("core").to_numpy()[order], table.column("own").to_numpy(zero_copy_only=False)[order]
        mine, bound, closest = np.flatnonzero(own), np.full(len(ids), reach), np.full(len(ids), np.inf)

        def link(d, rows, others):
            w = np.maximum(np.maximum(d, core[others]), core[rows][:, None])
            return np.where((others == rows[:, None]) | (d > reach), np.inf, w).min(axis=1)

        for part in range(0, len(mine), ROWS_AT_ONCE):
            rows = mine[part : part + ROWS_AT_ONCE]
            near, d = _beside(v, rows)
            bound[rows] = np.minimum(reach, link(d, rows, near))
        for rows, lo, d in _blocks(v, along, mine, bound):
            closest[rows] = link(d, rows, np.arange(lo, lo + d.shape[1])[None, :])
        of, count = _components(v, along, reach)
        least = np.full(count, np.iinfo(np.int64).max)
        np.minimum.at(least, of, ids)
        here = np.zeros(count, dtype=bool)
        here[of[own]] = True
        kept = np.flatnonzero(here[of])
        known = own[kept] & np.isfinite(closest[kept])
        return pa.table({"id": pa.array(ids[kept]), "label": pa.array(least[of[kept]]), "own": pa.array(own[kept]), "w": pa.array(closest[kept], mask=~known)})

    return run


def density_clusters(points: DataFrame, id_col: str, vector: str, reach: float, min_samples: int = 2, min_size: int = 3, over: tuple[int, ...] = (0, 1), keep: tuple[str, ...] = ()) -> DataFrame:
    """``id, cluster, confidence`` and the columns ``keep``, a row for each point: clusters of dense points, ``-1`` for noise.

    The core distance of a point is that to its ``min_samples``-th other point.
    Two points are linked at the greatest of their distance and core distances;
    points connected by links within ``reach`` are a cluster, named by its
    smallest id, if there are ``min_size`` of them. Of clusters with the same
    smallest id, as repeated ids allow, the one with the least vector has it for
    a name; the others are numbered on from the greatest id. The confidence is the
    cluster's closest link as a share of the point's own closest one.

    Equal vectors are folded first and numbered; ids may be repeated. Points meet in cells of side ``reach`` over
    the components ``over``, with the points of the cells around; distance in
    some components is never more than in all, so no near pair is missed. Of a
    point's links a cell finds the closest, looking no further than what is
    next to it in order allows, and of what is connected the least number;
    these are then connected. Null vectors and ids are left out.
    """
    written = Written(points.sparkSession, "density")
    rows = written.cut(points.select(F.col(id_col).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("v"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)]).where("v is not null and key is not null"))
    folded = written.cut(rows.groupBy("v").agg(F.min("key").alias("least"), F.max("key").alias("most"), F.count("*").alias("n")).withColumn("id", F.monotonically_increasing_id()))
    over = list(over)
    core = _neighbourhoods(folded, over, reach).groupBy("cell").applyInArrow(_core(min_samples, reach), "id long, core double")
    dense = written.cut(folded.join(core, "id"))
    linked = _neighbourhoods(dense, over, reach).groupBy("cell").applyInArrow(_local_links(reach), "id long, label long, own boolean, w double")
    # a point's label in its own cell, and those that the cells around have for it: at most as many as there are cells around
    local = written.cut(linked.groupBy("id").agg(F.max(F.when(F.col("own"), F.col("label"))).alias("part"), F.max("w").alias("own"), F.collect_set("label").alias("seen")))
    edges = local.select(F.col("part").alias("a"), F.explode("seen").alias("b"), F.lit(0.0).alias("w")).where("a != b").distinct()
    _, labels = spanning_forest(edges, written)
    placed = dense.select("id", "v", "least", "n", "core").join(local.select("id", "part", "own"), "id").join(labels.select(F.col("id").alias("part"), "label").hint("merge"), "part", "left").withColumn("label", F.coalesce("label", "part"))
    placed = placed.withColumn("own", F.when(F.col("n") > 1, F.greatest(F.lit(0.0), F.least(F.col("core"), F.coalesce("own", "core")))).otherwise(F.coalesce("own", "core")))
    placed = written.cut(placed)
    sizes = placed.groupBy("label").agg(F.sum("n").alias("size"), F.min("own").alias("closest"), F.min("least").alias("cluster"), F.min("v").alias("first")).where(F.col("size") >= min_size)
    sizes = written.cut(sizes.withColumn("nth", F.row_number().over(Window.partitionBy("cluster").orderBy("first"))))
    if sizes.where("nth > 1").limit(1).count():
        named = F.lit(folded.agg(F.max("most")).first()[0]) + F.row_number().over(Window.orderBy("cluster", "first"))
        sizes = sizes.where("nth = 1").unionByName(sizes.where("nth > 1").withColumn("cluster", named))
    found = placed.join(sizes.hint("merge"), "label").select("id", "cluster", F.when(F.col("own") == 0, 1.0).otherwise(F.col("closest") / F.col("own")).alias("confidence"))
    of_vector = folded.join(found, "id", "left").select(F.col("v").alias("u"), "cluster", "confidence")
    out = rows.join(of_vector.hint("merge"), F.col("v") == F.col("u"))
    return out.select(F.col("key").alias(id_col), F.coalesce("cluster", F.lit(-1)).alias("cluster"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)])
