"""Missed fraud: a boosted-tree model, what drives each of its scores, and clusters of rows with like drivers."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.graphs import density_clusters
from tidemark.sources.written import Written


@dataclass
class Tree:
    """A regression tree as arrays by node; a leaf's ``left`` is -1. Values are weighted predictions, those of inner nodes included."""

    feature: list[int]
    threshold: list[float]
    left: list[int]
    right: list[int]
    value: list[float]


#: Bins of a feature, between which trees split.
BINS = 32


@dataclass
class Boosted:
    """A boosted-tree model over the numbers of bins, and for each feature the values at which a bin ends and another begins."""

    model: GBTClassificationModel
    cuts: list[list[float]]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` scored by the features in its vector ``_x``."""
        values = vector_to_array("_x")
        rows = _binned(df.withColumns({f"_v{i}": values[i] for i in range(len(self.cuts))}), self.cuts)
        names = [f"_{n}{i}" for i in range(len(self.cuts)) for n in "vb"]
        return self.model.transform(_assembled(rows, self.cuts)).drop("_bins", *names)


def bin_ends(counts: DataFrame, features: int) -> list[list[float]]:
    """Where the bins of each feature end, the last one left out: at all values if these are no more than ``BINS``, else at exact quantiles.

    ``counts``: ``feature, v, n, slice``, where slices do not overlap in the values of a feature. A row per slice reaches the driver.
    """
    slices, places, found = {}, [], set()
    for r in counts.groupBy("feature", "slice").agg(F.min("v").alias("least"), F.max("v").alias("most"), F.count("*").alias("values"), F.sum("n").alias("n")).collect():
        slices.setdefault(r["feature"], []).append(r)
    few = [f for f, parts in slices.items() if sum(r["values"] for r in parts) <= BINS]
    for f in slices.keys() - set(few):
        parts = sorted(slices[f], key=lambda r: r["least"])
        wanted, upto = [-(-k * sum(r["n"] for r in parts) // BINS) for k in range(1, BINS)], 0
        for r in parts:
            places += [(f, r["slice"], p - upto) for p in wanted if upto < p <= upto + r["n"]]
            upto += r["n"]
    if few:
        found |= {tuple(r) for r in counts.where(F.col("feature").isin(*few)).select("feature", "v").collect()}
    if places:
        upto = F.sum("n").over(Window.partitionBy("feature", "slice").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        wanted = F.broadcast(counts.sparkSession.createDataFrame(places, "feature int, slice int, place long"))  # at most BINS a feature
        ranked = counts.withColumn("upto", upto).join(wanted, ["feature", "slice"])
        found |= {tuple(r) for r in ranked.where("place <= upto and place > upto - n").select("feature", "v").collect()}
    return [sorted(v for g, v in found if g == f and v < max(r["most"] for r in slices[f])) for f in range(features)]


def _binned(df: DataFrame, cuts: list[list[float]]) -> DataFrame:
    """``df`` with the bins ``_b0, _b1, ...`` of its features ``_v0, _v1, ...``: how many cuts are less than each."""
    df = df.withColumns({f"_b{i}": F.lit(0.0) for i, c in enumerate(cuts) if not c})
    if not any(cuts):
        return df
    # a bin has the value it ends with, a bucket has the one it begins with
    splits = {i: [-math.inf, *[math.nextafter(v, math.inf) for v in c], math.inf] for i, c in enumerate(cuts) if c}
    out = Bucketizer(splitsArray=list(splits.values()), inputCols=[f"_v{i}" for i in splits], outputCols=[f"_b{i}" for i in splits]).transform(df)
    # buckets are named as categories, which trees would split otherwise
    return out.withColumns({f"_b{i}": F.col(f"_b{i}").alias(f"_b{i}", metadata={}) for i in splits})


def _assembled(df: DataFrame, cuts: list[list[float]]) -> DataFrame:
    return VectorAssembler(inputCols=[f"_b{i}" for i in range(len(cuts))], outputCol="_bins").transform(df)


def fit_boosted(df: DataFrame, features: list[str], label: str, trees: int = 20, depth: int = 4, seed: int = 42) -> Boosted | None:
    """Boosted trees on rows with a label of 0 or 1 (missing features count 0); None unless both labels occur.

    Two passes over the rows: one counts the values of features for the bins that
    trees split between, the other counts rows that share all bins and the label.
    The many passes of the fit are over these counts, each with its rows as weight.
    """
    known = df.where(F.col(label).isin(0, 1)).select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_v{i}") for i, c in enumerate(features)], F.col(label).cast("double").alias("_label"))
    written = Written(df.sparkSession, "boosted")
    values = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(f"_v{i}").alias("v")) for i in range(len(features))])
    counts = known.select(F.inline(values)).groupBy("feature", "v").agg(F.count("*").alias("n"))
    counts = written.cut(counts.repartitionByRange("feature", "v").withColumn("slice", F.spark_partition_id()))
    cuts = bin_ends(counts, len(features))
    cells = written.cut(_binned(known, cuts).groupBy(*[f"_b{i}" for i in range(len(features))], "_label").agg(F.count("*").cast("double").alias("_n")))
    size, labels = cells.agg(F.count("*"), F.count_distinct("_label")).first()
    if labels < 2:
        return None
    # the fit looks for splits in a sample of maxBins squared, here all cells; no feature has more bins than it has cuts for
    fit = GBTClassifier(featuresCol="_bins", labelCol="_label", weightCol="_n", maxIter=trees, maxDepth=depth, seed=seed, maxBins=max(BINS, math.isqrt(size) + 1))
    model = fit.fit(_assembled(cells, cuts))
    written.drop(counts, cells)
    return Boosted(model, cuts)


def structure(boosted: Boosted) -> list[Tree]:
    """The trees of a model, read once; a few hundred numbers each. A split after a bin is one after the value that the bin ends with."""
    out = []
    for member, weight in zip(boosted.model.trees, boosted.model.treeWeights, strict=True):
        tree, stack = Tree([], [], [], [], []), [(member._java_obj.rootNode(), None)]
        while stack:
            node, place = stack.pop()
            at = len(tree.value)
            if place is not None:
                place[0][place[1]] = at
            tree.value.append(weight * node.prediction())
            inner = node.getClass().getSimpleName() == "InternalNode"
            tree.feature.append(node.split().featureIndex() if inner else 0)
            tree.threshold.append(boosted.cuts[tree.feature[-1]][math.floor(node.split().threshold())] if inner else 0.0)
            tree.left.append(-1)
            tree.right.append(-1)
            if inner:
                stack += [(node.leftChild(), (tree.left, at)), (node.rightChild(), (tree.right, at))]
        out.append(tree)
    return out


def path_attributions(x, trees: list[Tree]):
    """``(base, attributions)`` of rows: what each split on a row's path adds to the prediction is its feature's. Base and attributions sum to the margin."""
    import numpy as np

    base, out, rows = 0.0, np.zeros(x.shape), np.arange(len(x))
    for t in trees:
        feature, threshold, left, right, value = (np.array(v) for v in (t.feature, t.threshold, t.left, t.right, t.value))
        base += value[0]
        at, moving = np.zeros(len(x), dtype=np.int64), rows
        while len(moving := moving[left[at[moving]] >= 0]):
            here = at[moving]
            f = feature[here]
            there = np.where(x[moving, f] <= threshold[here], left[here], right[here])
            out[moving, f] += value[there] - value[here]
            at[moving] = there
    return float(base), out


def attribute(df: DataFrame, trees: list[Tree], features: list[str]) -> DataFrame:
    """``df`` with ``margin`` (half the log odds), ``base`` and ``attribution``, an array in the order of ``features``; Arrow batches, no shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(trees)  # of the model's size

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[-len(features) :]], axis=1)
            base, parts = path_attributions(x, shared.value)
            offsets = pa.array(np.arange(0, parts.size + 1, len(features), dtype=np.int32))
            arrays = pa.ListArray.from_arrays(offsets, pa.array(parts.ravel()))
            kept = batch.columns[: -len(features)]
            yield pa.record_batch([*kept, pa.array(base + parts.sum(axis=1)), pa.array(np.full(len(x), base)), arrays], names=[*batch.schema.names[: len(kept)], "margin", "base", "attribution"])

    kept = [c for c in df.columns if c not in ("margin", "base", "attribution")]
    rows = df.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(kept)], *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"x{i}") for i, c in enumerate(features)])
    kinds = "".join(f"_{i} {df.schema[c].dataType.simpleString()}, " for i, c in enumerate(kept))
    return rows.mapInArrow(run, f"{kinds}margin double, base double, attribution array<double>").select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(kept)], "margin", "base", "attribution")


def drivers(attributed: DataFrame, features: list[str]) -> DataFrame:
    """Mean absolute attribution of each feature, one pass."""
    each = F.array(*[F.struct(F.lit(c).alias("feature"), F.avg(F.abs(F.col("attribution")[i])).alias("mean_abs")) for i, c in enumerate(features)])
    return attributed.agg(each.alias("d")).select(F.inline("d"))


def standardized(df: DataFrame, vector: str, size: int) -> DataFrame:
    """``df`` with a vector of mean 0 and deviation 1 in each component (constant ones: 0)."""
    stats = df.agg(*[f(F.col(vector)[i]).alias(f"{n}{i}") for i in range(size) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    scaled = [(F.col(vector)[i] - F.lit(stats[f"m{i}"])) / F.lit(stats[f"s{i}"]) if stats[f"s{i}"] else F.lit(0.0) for i in range(size)]
    return df.withColumn(vector, F.array(*scaled))


def hidden_typologies(df: DataFrame, id_col: str, features: list[str], label: str, missed: Column, reach: float = 0.5, min_samples: int = 2, min_size: int = 3, trees: int = 20, depth: int = 4) -> DataFrame | None:
    """Missed rows (``missed``) clustered by what drives their scores: ``id, margin, top_driver, cluster, confidence, typology``, a row for each, also where ids are repeated; None without both labels."""
    model = fit_boosted(df, features, label, trees, depth)
    if model is None:
        return None
    scored = attribute(df.where(missed).select(id_col, *features), structure(model), features)
    names = F.array(*[F.lit(c) for c in features])
    strongest = F.array_position(F.transform("attribution", F.abs), F.array_max(F.transform("attribution", F.abs)))
    # written, as three jobs read it: none scores the rows again
    scored = Written(df.sparkSession, "scored").cut(scored.withColumn("top_driver", F.element_at(names, strongest.cast("int"))).select(id_col, "margin", "top_driver", "attribution"))
    clusters = density_clusters(standardized(scored, "attribution", len(features)), id_col, "attribution", reach, min_samples, min_size, keep=("margin", "top_driver"))
    typology = F.when(F.col("cluster") >= 0, F.concat(F.lit("hidden_typology_"), "cluster")).otherwise("noise")
    return clusters.select(id_col, "margin", "top_driver", "cluster", "confidence").withColumn("typology", typology)
