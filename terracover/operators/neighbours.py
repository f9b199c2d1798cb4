"""Exact nearest neighbours within a class, and minority rows interpolated between them.

Rows of a class are cut into cells of bounded size: into slabs along the feature that spreads
most, slabs along the next, and these along a third, by rank, so that ties and copies fill
cells like any other rows. A row first meets its own cell. The distance to the k-th neighbour
there bounds the search: the row goes on to the cells whose box lies within it, and to no
others. The best of all meetings are the neighbours, so the search is exact.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracover.functions.hashing import digest_bucket, key_digest, unit_interval
from terracover.operators.joins import large_join, lookup_join
from terracover.operators.ranking import running_totals
from terracover.operators.splits import SEED, oversample
from terracover.sources.staging import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows of a cell; cells whose boxes go to every task, beyond which cells grow; distances at a time.
BLOCK_ROWS, MOST_CELLS, PAIRS = 256, 1 << 18, 1 << 20
AXES = 3


def _best(found: Column, k: int) -> Column:
    return F.slice(F.array_sort(found), 1, k)


def _cells(rows: DataFrame, axes, block_rows: int) -> DataFrame:
    """``rows`` (key, g, f) with the number ``cell`` of a cell of at most ``block_rows`` rows within its class."""
    sizes = stage(rows.groupBy("g").agg(F.count(F.lit(1)).alias("size")), "sizes")
    n_axes = len(axes)
    cuts = F.ceil(F.pow(F.col("size") / F.lit(float(block_rows)), F.lit(1.0 / n_axes)) - F.lit(1e-9)).cast("bigint")
    table = lookup_join(rows, sizes.withColumn("cuts", F.greatest(cuts, F.lit(1))).drop("size"), "g").withColumns({"cell": F.lit(0).cast("bigint"), "one": F.lit(1)})
    for i, axis in enumerate(axes):
        held = F.lit(block_rows) * F.pow("cuts", F.lit(n_axes - 1 - i)).cast("bigint")
        ranked = running_totals(table.withColumn("order", F.struct(F.col("f")[axis].alias("v"), "key")), ["g", "cell"], "order", ["one"])
        # As many numbers below a slab as it can have parts: the next rank of cuts, and one for its rest.
        number = F.col("cell") * (F.col("cuts") + 1) + F.floor((F.col("cum_one") - 1) / held)
        table = ranked.select("key", "g", "f", "cuts", "one", number.cast("bigint").alias("cell"))
    return table.select("key", "g", "f", "cell")


def _meet(k: int, n_features: int, schema):
    """Rows that ask (``asks``) against the rows of their cell, which come first: the k nearest within ``bound``."""
    def run(batches):
        at, x, names, places = None, None, None, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            g, cell = batch.column("g").to_pylist(), batch.column("cell").to_numpy()
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            f = batch.column("f").flatten().to_numpy(zero_copy_only=False).reshape(-1, n_features)
            keys, rows, bounds = batch.column("key"), batch.column("row").to_numpy(), batch.column("bound").to_numpy(zero_copy_only=False)
            code = np.array([0] + [int(p != q) for p, q in zip(g, g[1:])]).cumsum()
            edges = np.flatnonzero((np.diff(cell) != 0) | (np.diff(code) != 0) | (np.diff(asks.astype(int)) != 0)) + 1
            found = []  # (row, d2, key, f), a block per run
            for low, high in zip([0, *edges], [*edges, len(cell)]):
                here = g[low], int(cell[low])
                if here != at:
                    at, x, names, places = here, np.zeros((0, n_features)), [], None
                if not asks[low]:
                    x, names, places = np.concatenate([x, f[low:high]]), names + keys.slice(low, high - low).to_pylist(), None
                    continue
                if places is None:  # by key, so that a stable sort gives ties to the smaller one
                    order = sorted(range(len(names)), key=names.__getitem__)
                    x, names = x[order], [names[i] for i in order]
                    places = {}
                    for i, name in enumerate(names):
                        places.setdefault(name, []).append(i)
                step = max(1, PAIRS // max(1, len(names)))
                for first in range(low, high, step):
                    last = min(high, first + step)
                    q = f[first:last]
                    d2 = np.zeros((last - first, len(names)))
                    for i in range(n_features):
                        d = q[:, i, None] - x[None, :, i]
                        d2 += d * d
                    own = [(i, j) for i, name in enumerate(keys.slice(first, last - first).to_pylist()) for j in places.get(name, ())]
                    usable = ~(d2 > bounds[first:last, None])
                    if own:
                        usable[tuple(zip(*own))] = False
                    d2[~usable] = np.inf
                    near = np.argsort(np.where(usable, d2, np.inf), axis=1, kind="stable")[:, :k]
                    # A usable pair may be infinitely far too: those follow the finite ones, by key.
                    fine = np.take_along_axis(usable, near, 1)
                    short = fine.sum(1) < np.minimum(usable.sum(1), k)
                    for i in np.flatnonzero(short):
                        near[i] = np.lexsort((np.arange(len(names)), d2[i], ~usable[i]))[:k]
                        fine[i] = usable[i, near[i]]
                    i, j = np.nonzero(fine)
                    found.append((rows[first:last][i], d2[i, near[i, j]], [names[n] for n in near[i, j]], x[near[i, j]]))
            if found:
                row, d2, f_found = (np.concatenate([b[i] for b in found]) for i in (0, 1, 3))
                names_found = [name for b in found for name in b[2]]
                ends = pa.array(np.arange(0, (len(row) + 1) * n_features, n_features, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row), pa.array(d2), pa.array(names_found, schema), pa.ListArray.from_arrays(ends, pa.array(f_found.ravel()))], ["row", "d2", "key", "f"]
                )

    return run


def _reached(boxes):
    """Each row once per other cell of its class whose box lies within the row's bound."""
    def run(batches):
        of = boxes.value
        for batch in batches:
            if not batch.num_rows:
                continue
            g, cell = np.array(batch.column("g").to_pylist(), dtype=object), batch.column("cell").to_numpy()
            bounds = batch.column("bound").to_numpy(zero_copy_only=False)
            f = batch.column("f").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            order = np.lexsort((cell, np.unique(g.astype(str), return_inverse=True)[1]))
            edges = np.flatnonzero((np.diff(cell[order]) != 0) | (g[order][1:] != g[order][:-1])) + 1
            who, where = [], []
            for run_of in np.split(order, edges):
                numbers, low, high, axis = of[g[run_of[0]]]
                q, far = f[run_of], bounds[run_of] * (1 + 1e-9)  # rounding must not hide a row on the border
                widest = np.sqrt(far.max()) if np.isfinite(far).all() else np.inf
                near = np.flatnonzero(~((low[:, axis] > q[:, axis].max() + widest) | (high[:, axis] < q[:, axis].min() - widest)))
                gap = np.maximum(np.maximum(low[near] - q.max(0), q.min(0) - high[near]), 0)
                near = near[~((gap * gap).sum(1) > widest * widest * (1 + 1e-9))]
                near = near[numbers[near] != cell[run_of[0]]]
                if not len(near):
                    continue
                step = max(1, PAIRS // len(near))
                for first in range(0, len(run_of), step):
                    part = q[first:first + step, None, :]
                    gap = np.maximum(np.maximum(low[near][None] - part, part - high[near][None]), 0)
                    i, j = np.nonzero(~((gap * gap).sum(2) > far[first:first + step, None]))
                    who.append(run_of[first + i])
                    where.append(numbers[near[j]])
            if who:
                taken = batch.take(pa.array(np.concatenate(who)))
                target = pa.array(np.concatenate(where))
                yield taken.set_column(taken.schema.get_field_index("cell"), "cell", target)

    return run


def nearest_neighbours(df: DataFrame, key: str, group: str, features, k: int = 5, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(key, f, near): per row its k nearest rows of the same group, array<struct<d2, key, f>>.

    ``key`` is unique and not NULL; ``features`` hold no NULL or NaN. Distances are Euclidean,
    given as squares; ties go to the smaller key. Groups with fewer rows give fewer neighbours.
    """
    features = list(features)
    facts = df.agg(F.count(F.lit(1)).alias("n"), *(F.coalesce(F.var_pop(c), F.lit(0.0)).alias(f"v{i}") for i, c in enumerate(features))).first()
    axes = sorted(range(len(features)), key=lambda i: (facts[f"v{i}"], features[i]), reverse=True)[:AXES]
    # A cell without k others bounds nothing.
    size = max(block_rows, k + 1, -(-facts["n"] // MOST_CELLS))
    # A NULL group is one like any other, so groups get names that are never NULL.
    named = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-")).alias("g")
    rows = df.select(F.col(key).alias("key"), named, F.array(*(F.col(c).cast("double") for c in features)).alias("f"))
    placed = stage(_cells(rows, axes, size).withColumn("row", F.monotonically_increasing_id()), "cells")
    kind, n_features, spark = placed.schema["key"].dataType.simpleString(), len(features), df.sparkSession
    found_kind, asked_kind = f"row bigint, d2 double, key {kind}, f array<double>", f"g string, cell bigint, row bigint, key {kind}, f array<double>, bound double"
    no_bound = F.lit(float("inf")).alias("bound")

    def met(asked: DataFrame) -> DataFrame:
        columns = ["g", "cell", "row", "key", "f", "bound"]
        held = placed.withColumn("bound", no_bound).select(*columns, F.lit(False).alias("asks"))
        sent = held.unionByName(asked.select(*columns, F.lit(True).alias("asks")))
        together = sent.repartition("g", "cell").sortWithinPartitions("g", "cell", "asks")
        arrow = pa_kind(placed.select("key"))
        found = together.mapInArrow(_meet(k, n_features, arrow), found_kind)
        return found.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("d2", "key", "f"))).alias("found")).select("row", F.slice("found", 1, k).alias("found"))

    none = F.array().cast(f"array<struct<d2:double,key:{kind},f:array<double>>>")
    first = met(placed.withColumn("bound", no_bound))
    own = stage(placed.join(first.hint("merge"), "row", "left").withColumn("near", F.coalesce("found", none)).drop("found"), "near")
    edges = [a(F.col("f")[i]).alias(f"{n}{i}") for i in range(n_features) for a, n in ((F.min, "low"), (F.max, "high"))]
    boxes: dict = {}
    for g, part in placed.groupBy("g", "cell").agg(*edges).toPandas().sort_values(["g", "cell"]).groupby("g"):
        low, high = (part[[f"{n}{i}" for i in range(n_features)]].to_numpy() for n in ("low", "high"))
        boxes[g] = part["cell"].to_numpy(), low, high, axes[0]
    far = F.when(F.size("near") == k, F.element_at("near", -1)["d2"]).otherwise(F.lit(float("inf")))
    asked = own.select("g", "cell", "row", "key", "f", far.alias("bound")).mapInArrow(_reached(spark.sparkContext.broadcast(boxes)), asked_kind)
    joined = own.join(met(asked).hint("merge"), "row", "left")
    return joined.select("key", "f", _best(F.concat("near", F.coalesce("found", none)), k).alias("near"))


def pa_kind(df: DataFrame):
    """Arrow type of a one-column table."""
    return df.limit(0).toArrow().schema.field(0).type


def oversample_interpolated(
    df: DataFrame, label: str, keys, features, ratio: float = 0.5, k: int = 5, seed: int = SEED, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Small classes filled up to ``ratio`` times the largest with rows between neighbours.

    A synthetic row lies on the line from a row to one of its k nearest of its class; which
    one, and where, follows from the seed, the row's keys and the copy's number. Original rows
    have ``copy`` 1. Rows with a missing feature are kept and take no part; the only row of a
    class is repeated. ``keys`` are unique.
    """
    keys, features = list(keys), list(features)
    whole = F.lit(True)
    for c in features:
        whole = whole & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    complete = stage(df.where(whole).withColumn("_key", key_digest(seed, *keys)), "complete")
    copies = oversample(complete, label, keys, ratio, seed)
    synthetic = stage(copies.where("copy > 1"), "copies")
    needed = stage(synthetic.select(label).distinct(), "needed")
    near = nearest_neighbours(lookup_join(complete, needed, label, "left_semi", null_safe=True), "_key", label, features, k, block_rows)
    met = large_join(synthetic, near.select(F.col("key").alias("_key"), "near"), "_key")
    pick = digest_bucket(key_digest(seed + 3, *keys, "copy")) % F.greatest(F.size("near"), F.lit(1))
    chosen = met.withColumn("to", F.get("near", pick.cast("int"))["f"]).withColumn("u", unit_interval(key_digest(seed + 4, *keys, "copy")))
    between = {
        c: F.coalesce(F.col(c).cast("double") + F.col("u") * (F.col("to")[i] - F.col(c).cast("double")), F.col(c).cast("double"))
        for i, c in enumerate(features)
    }
    columns = [c for c in df.columns if c not in features]
    made = chosen.select(*columns, *(v.alias(c) for c, v in between.items()), "copy")
    given = df.select(*columns, *(F.col(c).cast("double").alias(c) for c in features), F.lit(1).alias("copy"))
    return given.unionByName(made)
