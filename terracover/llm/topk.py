"""Exact top-k search by inner product with cover trees over queries and data.

The top level of the index is a set of pivots, picked farthest-first from a bounded sample
(``SAMPLE`` rows by hash): every row goes to the cell of its nearest pivot, large cells are
cut by hash into blocks, and each block becomes a cover tree of its own. Every row is
indexed; the sample decides only how well cells fit, never the result. Queries get the same
treatment in smaller blocks.

For a node pair with centres p, q and covering radii r, s no inner product exceeds
``<p, q> + s |p| + r |q| + r s``. A pair is dropped if that is below the worst k-th score
among the queries of its query node. Blocks of queries first search the cell with the
highest bound, which gives each query a k-th score; these prune cells for the whole block,
then blocks, then node pairs inside a block, where both trees are descended together and
leaves are visited from the highest bound down.

Shape of the job: vectors move once to their block and trees are staged as one row per
block. Pairs of blocks are dropped by centres and radii alone; blocks of the pairs that are
left meet in groups of about 16 by 16, so a block moves once per group of the other side.
A task holds one pair of groups, some tens of megabytes in 64 dimensions. At most ``k`` rows
per query and meeting come back. Cells and pivots are bounded by parameters and travel with
the tasks.

Defined results: vectors that are null, or hold null or non-finite components, and rows
without an id take no part. Shorter vectors count as padded with zeros. Repeated rows count
once; rows with the same id and different vectors are separate candidates, and a query
never finds a row of its own id. Ties go to the smaller id. Scores are exact as long as
they fit 63 bits. Vectors of any length are held whole; blocks hold a fixed number of rows.
Only the two named columns and the query condition are read, clashing names have no effect.
Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terracover.sources.staging import stage

SAMPLE, CELLS = 4096, 256
DATA_BLOCK, QUERY_BLOCK, LEAF = 2048, 512, 32
GROUP = 16  # blocks of a side that meet in one task, about
NONE = np.iinfo(np.int64).min


def quantised(vector: Column, scale: float) -> Column:
    """floor(scale * x) of every component; null unless all components are finite numbers."""
    double = F.transform(vector, lambda x: x.cast("double"))
    sound = F.forall(double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(sound, F.transform(double, lambda x: F.floor(x * scale)))


def _matrix(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for row, v in zip(out, vectors):
        row[:len(v)] = v
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; in floating point where no sum can leave its integers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2.0 ** 52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def pivots(sample: np.ndarray, many: int) -> np.ndarray:
    """Farthest-first rows of the sample: the separated centres of the tree's top level."""
    points = sample.astype(np.float64)
    chosen, near = [0], np.full(len(points), np.inf)
    while len(chosen) < min(many, len(points)):
        near = np.minimum(near, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
        if near.max() == 0:
            break
        chosen.append(int(near.argmax()))
    return sample[chosen]


class CoverTree:
    """Nodes with a centre, a covering radius and a range of rows; children halve the radius.

    The children of a node are centred on a net: chosen farthest-first, they are more than
    half the radius apart and leave no row farther than that. Where rows are too scattered
    for a net of a quarter of them, the node stays a leaf.
    """

    def __init__(self, rows: np.ndarray):
        points = rows.astype(np.float64)
        self.order = np.arange(len(rows))
        self.nodes: list[list] = []  # centre row, radius, start, end, first child, last child + 1
        waiting = [self._node(points, np.arange(len(rows)), 0, 0)]
        while waiting:
            at, members, distance = waiting.pop()
            node = self.nodes[at]
            if len(members) <= LEAF or node[1] == 0:
                continue
            half, near, owner, centres = node[1] / 2, distance.copy(), np.zeros(len(members), int), [node[0]]
            while near.max() > half and len(centres) <= min(64, len(members) // 4):
                new = int(near.argmax())
                d = np.sqrt(((points[members] - points[members[new]]) ** 2).sum(axis=1))
                closer = d < near
                owner[closer], near[closer] = len(centres), d[closer]
                centres.append(members[new])
            if near.max() > half:
                continue
            start, node[4] = node[2], len(self.nodes)
            node[5] = node[4] + len(centres)
            for c, centre in enumerate(centres):
                own = members[owner == c]
                waiting.append(self._node(points, own, start, centre))
                start += len(own)

    def _node(self, points: np.ndarray, members: np.ndarray, start: int, centre: int) -> tuple:
        distance = np.sqrt(((points[members] - points[centre]) ** 2).sum(axis=1))
        self.order[start:start + len(members)] = members
        self.nodes.append([centre, float(distance.max()), start, start + len(members), 0, 0])
        return len(self.nodes) - 1, members, distance


def _bound(p: np.ndarray, r: np.ndarray, q: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Largest possible inner product of rows within r of p and s of q; a hair too large, never too small."""
    norms = np.sqrt((p * p).sum(axis=-1)), np.sqrt((q * q).sum(axis=-1))
    top = (p * q).sum(axis=-1) + s * norms[0] + r * norms[1] + r * s
    return top + 1e-9 * (norms[0] + r) * (norms[1] + s) + 1e-6


class Best:
    """The k best (score, id) of each query; among equal scores the smaller ids."""

    def __init__(self, many: int, k: int, floor: np.ndarray | None = None):
        self.k = k
        self.score = np.full((many, k), NONE, np.int64)
        self.id = np.full((many, k), np.iinfo(np.int64).max, np.int64)
        self.floor = np.full(many, NONE, np.int64) if floor is None else floor

    def worst(self) -> np.ndarray:
        return np.maximum(self.score[:, -1], self.floor)

    def add(self, rows: slice, score: np.ndarray, ids: np.ndarray) -> None:
        both = np.concatenate([self.score[rows], score], axis=1)
        names = np.concatenate([self.id[rows], np.broadcast_to(ids, score.shape)], axis=1)
        keep = np.lexsort((names, ~both), axis=1)[:, :self.k]
        self.score[rows] = np.take_along_axis(both, keep, 1)
        self.id[rows] = np.take_along_axis(names, keep, 1)


def search(queries: dict, data: dict, best: Best) -> None:
    """Dual-tree search of one block of queries in one block of data; rows are in tree order."""
    qn, dn = queries["nodes"], data["nodes"]
    qc, dc = queries["centres"], data["centres"]
    pairs, leaves = np.zeros((1, 2), np.int64), []
    while len(pairs):
        worst = _worst(best, qn)
        a, b = pairs.T
        top = _bound(dc[b], dn[b, 1], qc[a], qn[a, 1])
        pairs, top = pairs[top >= worst[a]], top[top >= worst[a]]
        a, b = pairs.T
        q_leaf, d_leaf = qn[a, 5] == 0, dn[b, 5] == 0
        done = q_leaf & d_leaf
        leaves += [(t, i, j) for t, (i, j) in zip(top[done].tolist(), pairs[done].tolist())]
        grown = []
        for i, j in pairs[~done].tolist():
            # Descend the node with the larger radius, or the only one that has children.
            if qn[i, 5] and (not dn[j, 5] or qn[i, 1] >= dn[j, 1]):
                grown += [(c, j) for c in range(int(qn[i, 4]), int(qn[i, 5]))]
            else:
                grown += [(i, c) for c in range(int(dn[j, 4]), int(dn[j, 5]))]
        pairs = np.array(grown, np.int64).reshape(-1, 2)
    by_query: dict[int, list] = {}
    for t, i, j in sorted(leaves, reverse=True):
        by_query.setdefault(i, []).append((t, j))
    for i, found in by_query.items():
        rows = slice(int(qn[i, 2]), int(qn[i, 3]))
        # From the highest bound down, some leaves at a time; the rest falls as the k-th scores rise.
        for at in range(0, len(found), 16):
            low = best.worst()[rows].min()
            some = [j for t, j in found[at:at + 16] if t >= low]
            if not some:
                break
            there = np.concatenate([np.arange(int(dn[j, 2]), int(dn[j, 3])) for j in some])
            score = products(queries["rows"][rows], data["rows"][there])
            own = queries["ids"][rows][:, None] == data["ids"][there][None, :]
            best.add(rows, np.where(own, NONE, score), data["ids"][there])


def _worst(best: Best, nodes: np.ndarray) -> np.ndarray:
    worst = best.worst()
    return np.array([worst[int(n[2]):int(n[3])].min() for n in nodes], np.float64)


def _assign(centres: np.ndarray):
    width = centres.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = centres.astype(np.float64)
        for batch in batches:
            rows = _matrix(batch.column("v").to_pylist(), width)
            x = rows.astype(np.float64)
            far = (c * c).sum(axis=1)[None, :] - 2 * x @ c.T
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(far.argmin(axis=1).astype(np.int32)), pa.array([r.tobytes() for r in rows], pa.binary())],
                names=["id", "cell", "v"],
            )

    return run


_BLOCK = "cell int, part bigint, n bigint, width int, ids binary, rows binary, nodes binary, centres binary"


def _index(width: int):
    def run(rows: pa.Table) -> pa.Table:
        held = sorted(set(zip(rows.column("id").to_pylist(), rows.column("v").to_pylist())))
        ids = np.array([i for i, _ in held], np.int64)
        matrix = np.frombuffer(b"".join(v for _, v in held), np.int64).reshape(-1, width)
        tree = CoverTree(matrix)
        nodes = np.array(tree.nodes, np.float64)
        centres = matrix[nodes[:, 0].astype(int)]
        return pa.table({
            "cell": pa.array([rows.column("cell")[0].as_py()], pa.int32()), "part": pa.array([rows.column("part")[0].as_py()], pa.int64()),
            "n": pa.array([len(ids)], pa.int64()), "width": pa.array([width], pa.int32()),
            "ids": pa.array([ids[tree.order].tobytes()], pa.binary()), "rows": pa.array([matrix[tree.order].tobytes()], pa.binary()),
            "nodes": pa.array([nodes.tobytes()], pa.binary()), "centres": pa.array([centres.tobytes()], pa.binary()),
        })

    return run


def _open(block: dict) -> dict:
    nodes = np.frombuffer(block["nodes"], np.float64).reshape(-1, 6)
    return {
        "ids": np.frombuffer(block["ids"], np.int64), "nodes": nodes,
        "rows": np.frombuffer(block["rows"], np.int64).reshape(-1, block["width"]),
        "centres": np.frombuffer(block["centres"], np.int64).reshape(-1, block["width"]).astype(np.float64),
    }


def _blocks(rows: DataFrame, most: int, width: int, name: str) -> DataFrame:
    """One row per block of at most about ``most`` rows of a cell: its cover tree."""
    parts = rows.groupBy("cell").agg(F.ceil(F.count("*") / most).alias("parts"))
    cut = rows.join(parts, "cell").select("id", "cell", "v", F.pmod(F.xxhash64("id"), F.col("parts")).alias("part"))
    return stage(cut.groupBy("cell", "part").applyInArrow(_index(width), _BLOCK), name)


def _cells(blocks: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers, centres and covering radii of the cells: at most ``CELLS`` rows reach the driver."""
    pivots_f = centres.astype(np.float64)

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x = np.frombuffer(row["rows"], np.int64).reshape(-1, row["width"]).astype(np.float64)
                far = np.sqrt(((x - pivots_f[row["cell"]]) ** 2).sum(axis=1).max())
                yield pa.RecordBatch.from_arrays([pa.array([row["cell"]], pa.int32()), pa.array([float(far)])], names=["cell", "radius"])

    found = blocks.select("cell", "width", "rows").mapInArrow(reach, "cell int, radius double")
    rows = found.groupBy("cell").agg(F.max("radius").alias("radius")).orderBy("cell").collect()
    cells = np.array([r["cell"] for r in rows], np.int64)
    return cells, pivots_f[cells], np.array([r["radius"] for r in rows])


def _targets(cells: tuple, first: bool):
    """(cell, part, target, floor) of query blocks: the cell of the highest bound, or all others that may hold a better row."""
    numbers, centres, radii = cells

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = _open(row)
                root = block["nodes"][0]
                top = _bound(centres, radii, block["centres"][0], root[1])
                # Where the block's own centre scores highest, its queries likely do.
                seed = int((centres @ block["centres"][0]).argmax())
                if first:
                    chosen, floor = [seed], None
                else:
                    floor = np.frombuffer(row["floor"], np.int64)
                    chosen = [c for c in np.flatnonzero(top >= floor.min()).tolist() if c != seed]
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["cell"]] * len(chosen), pa.int32()), pa.array([row["part"]] * len(chosen), pa.int64()),
                    pa.array(numbers[chosen].astype(np.int32)), pa.array([row.get("floor")] * len(chosen), pa.binary()),
                ], names=["cell", "part", "target", "floor"])

    return run


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Centre and covering radius of each block's root."""
    for batch in batches:
        for row in batch.to_pylist():
            block = _open(row)
            yield pa.RecordBatch.from_arrays([
                pa.array([row["cell"]], pa.int32()), pa.array([row["part"]], pa.int64()),
                pa.array([block["centres"][0].tobytes()], pa.binary()), pa.array([float(block["nodes"][0, 1])]),
            ], names=["cell", "part", "centre", "radius"])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a query block and a data block that may hold a better row; blocks themselves are not looked at."""
    names = ["cell", "part", "target", "there", "floor"]
    for batch in batches:
        vectors = [np.stack([np.frombuffer(x, np.float64) for x in batch.column(c).to_pylist()]) for c in ("q_centre", "d_centre")] if batch.num_rows else []
        if not vectors:
            continue
        top = _bound(vectors[1], batch.column("d_radius").to_numpy(), vectors[0], batch.column("q_radius").to_numpy())
        worst = np.array([NONE if f is None else np.frombuffer(f, np.int64).min() for f in batch.column("floor").to_pylist()], np.float64)
        yield batch.select(names).filter(pa.array(top >= worst))


def _meet(k: int):
    """All query blocks of a group against all data blocks of another."""
    names = ["cell", "part", "place", "query_id", "vec_id", "score"]
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(rows: pa.Table) -> pa.Table:
        held = rows.to_pylist()
        there = [_open(r) for r in held if r["side"] == 1]
        out = []
        for row in held:
            if row["side"]:
                continue
            queries = _open(row)
            best = Best(len(queries["ids"]), k, np.frombuffer(row["floor"], np.int64) if row["floor"] else None)
            # From the root with the highest bound down, so that the k-th scores rise early.
            root = queries["nodes"][0]
            top = [float(_bound(d["centres"][0], d["nodes"][0, 1], queries["centres"][0], root[1])) for d in there]
            for i in sorted(range(len(there)), key=lambda i: -top[i]):
                if top[i] >= best.worst().min():
                    search(queries, there[i], best)
            place, column = np.nonzero(best.score != NONE)
            out.append([
                np.full(len(place), row["cell"]), np.full(len(place), row["part"]), place, queries["ids"][place],
                best.id[place, column], best.score[place, column],
            ])
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 6
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    return run


def _floors(k: int):
    """Per query block the k-th score of each query so far, in the block's order."""

    def run(rows: pa.Table) -> pa.Table:
        n = rows.column("n")[0].as_py()
        floor = np.full(n, NONE, np.int64)
        for place, score in zip(rows.column("place").to_pylist(), rows.column("score").to_pylist()):
            if place is not None:
                floor[place] = score
        return pa.table({
            "cell": pa.array([rows.column("cell")[0].as_py()], pa.int32()), "part": pa.array([rows.column("part")[0].as_py()], pa.int64()),
            "floor": pa.array([floor.tobytes()], pa.binary()),
        })

    return run


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest inner products of each query row with rows of other ids."""
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), quantised(vectors[vector_col], scale).alias("v"), is_query.alias("asks"))
    rows = stage(rows.where("id IS NOT NULL AND v IS NOT NULL"), "topk-rows")
    width, total = rows.agg(F.max(F.size("v")), F.count("*")).first()
    spark = vectors.sparkSession
    result = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not width:  # no row, or none with a component
        return spark.createDataFrame([], result)
    sample = rows.select("v", F.xxhash64("id", "v").alias("h")).orderBy("h").limit(SAMPLE).collect()
    centres = pivots(_matrix([r["v"] for r in sample], width), max(1, min(CELLS, total // DATA_BLOCK)))
    kind = "id bigint, cell int, v binary"
    data = _blocks(rows.select("id", "v").mapInArrow(_assign(centres), kind), DATA_BLOCK, width, "topk-data")
    queries = _blocks(rows.where("asks").select("id", "v").mapInArrow(_assign(centres), kind), QUERY_BLOCK, width, "topk-queries")
    cells = _cells(data, centres)

    fields = [c.split()[0] for c in _BLOCK.split(", ")]
    head = "cell int, part bigint, centre binary, radius double"
    q_heads = stage(queries.mapInArrow(_heads, head), "topk-heads").withColumnsRenamed({"centre": "q_centre", "radius": "q_radius"})
    d_heads = stage(data.mapInArrow(_heads, head), "topk-heads").withColumnsRenamed(
        {"cell": "target", "part": "there", "centre": "d_centre", "radius": "d_radius"}
    )
    # Blocks meet in groups: a block is sent once per group of the other side, not once per block.
    groups = [max(1, -(-blocks.count() // GROUP)) for blocks in (queries, data)]

    def met(pairs: DataFrame, name: str) -> DataFrame:
        close = pairs.join(q_heads, ["cell", "part"]).join(d_heads, "target").mapInArrow(
            _near, "cell int, part bigint, target int, there bigint, floor binary"
        )
        close = stage(close.withColumns({
            "asking": F.pmod(F.xxhash64("cell", "part"), F.lit(groups[0])), "asked": F.pmod(F.xxhash64("target", "there"), F.lit(groups[1])),
        }), f"{name}-pairs")
        place = ["asking", "asked"]
        q_sent = close.groupBy("cell", "part", *place).agg(F.first("floor").alias("floor"))
        d_sent = close.select(F.col("target").alias("cell"), F.col("there").alias("part"), *place).distinct()
        sent = q_sent.join(queries, ["cell", "part"]).select(*place, F.lit(0).alias("side"), "floor", *fields).unionByName(
            d_sent.join(data, ["cell", "part"]).select(*place, F.lit(1).alias("side"), F.lit(None).cast("binary").alias("floor"), *fields)
        )
        found = sent.groupBy(*place).applyInArrow(_meet(k), "cell int, part bigint, place int, query_id bigint, vec_id bigint, score bigint")
        return stage(found, name)

    pair = "cell int, part bigint, target int, floor binary"
    first = met(queries.mapInArrow(_targets(cells, True), pair), "topk-first")
    order = Window.partitionBy("cell", "part", "place").orderBy(F.col("score").desc(), "vec_id")
    kth = first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k)
    known = queries.select("cell", "part", "n").join(kth.select("cell", "part", "place", "score"), ["cell", "part"], "left")
    floors = known.groupBy("cell", "part").applyInArrow(_floors(k), "cell int, part bigint, floor binary")
    wanted = queries.join(floors, ["cell", "part"]).mapInArrow(_targets(cells, False), pair)
    rest = met(wanted, "topk-rest")
    ranked = first.unionByName(rest).distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
