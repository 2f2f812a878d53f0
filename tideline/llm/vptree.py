"""Nearest neighbours by cosine with one vantage-point tree per shard.

Rows are dealt to regions, each around a pivot, and the regions to shards of
bounded size.  Each shard collapses vectors of one direction (equal but for a
power of two) and builds a vantage-point tree over unit vectors, whose
straight-line distance is a metric that falls with the cosine.

A search has two rounds.  In the first a query meets one shard of its own
region; the distance of the k-th found bounds the second, which visits the
other shards of all regions that the triangle inequality leaves, given their
radii.  Inside a shard a subtree is visited only if there can be a nearer
vector.  Every bound is relaxed by ``factor``: a region or subtree is left out
if it is farther than ``factor`` times the distance of the k-th best so far.
Factor one is exact; smaller factors prune more.  Found vectors are scored
again on the original numbers in double precision.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.session import materialize

SHARD_ROWS = 16_384
QUERY_ROWS = 1024
LEAF_ROWS = 32
#: Points of a query's own corner of a tree that give its first bound, at most.
HOME_ROWS = 256
#: Pivots, and so regions, of the vectors of one dimension, at most; every task holds them.
PIVOTS = 256
#: Scores closer than this count as ties until ids decide.
CLOSE = 1e-12


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, dim, vector) without ids or vectors that are null, hold null or non-finite numbers, or are zero."""
    v = F.col(vec_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    zero = F.forall(v, lambda x: x == 0)
    return vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & finite & ~zero).select(
        F.col(id_col).cast("long").alias("id"), F.size(v).alias("dim"), v.alias("vector")
    )


def _matrix(table: pa.Table | pa.RecordBatch, dim: int) -> np.ndarray:
    column = table.column("vector")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), dim)


def _scaled(rows: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two, which rounds nothing and keeps squares in range."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])


def _unit(rows: np.ndarray) -> np.ndarray:
    scaled = _scaled(rows)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _added(columns: np.ndarray) -> np.ndarray:
    """Row sums, added from left to right."""
    total = np.zeros(len(columns))
    for j in range(columns.shape[1]):
        total += columns[:, j]
    return total


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision, the products added in their order; equal rows give equal numbers."""
    a, b = _scaled(a), _scaled(b)
    return _added(a * b) / (np.sqrt(_added(a * a)) * np.sqrt(_added(b * b)))


def build_tree(points: np.ndarray, leaf_rows: int = LEAF_ROWS) -> dict[str, np.ndarray]:
    """Nodes as arrays: the vantage row and radius, the children, and for leaves the range in ``order``."""
    vantage, radius, inside, outside, start, end = [], [], [], [], [], []
    order: list[np.ndarray] = []
    placed = 0

    def new() -> int:
        for column, value in zip((vantage, radius, inside, outside, start, end), (-1, 0.0, -1, -1, 0, 0)):
            column.append(value)
        return len(vantage) - 1

    todo = [(new(), np.arange(len(points)))]
    while todo:
        node, rows = todo.pop()
        if len(rows) > leaf_rows:
            # The row farthest from the first one: vantage points at the rim separate best.
            first = points[rows] @ points[rows[0]]
            top = int(first.argmin())
            rest = np.delete(rows, top)
            far = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (points[rest] @ points[rows[top]])))
            middle = float(np.median(far))
            near = far <= middle
            if not near.all():
                vantage[node], radius[node] = int(rows[top]), middle
                inside[node], outside[node] = new(), new()
                todo += [(inside[node], rest[near]), (outside[node], rest[~near])]
                continue
        order.append(rows)
        start[node], end[node] = placed, placed + len(rows)
        placed += len(rows)
    for node in range(len(vantage) - 1, -1, -1):
        # The leaves of a subtree lie next to each other; children come after their parent.
        if vantage[node] >= 0:
            start[node] = min(start[inside[node]], start[outside[node]])
            end[node] = max(end[inside[node]], end[outside[node]])
    return {
        "vantage": np.array(vantage), "radius": np.array(radius), "inside": np.array(inside), "outside": np.array(outside),
        "start": np.array(start), "end": np.array(end), "order": np.concatenate(order) if order else np.zeros(0, dtype=int),
    }


def home_bound(tree: dict[str, np.ndarray], points: np.ndarray, asked: np.ndarray, keep: int) -> np.ndarray:
    """For each asked unit vector the ``keep``-th distance among the few points of its own corner of the tree."""
    at = np.zeros(len(asked), dtype=int)
    while True:
        down = (tree["vantage"][at] >= 0) & (tree["end"][at] - tree["start"][at] > HOME_ROWS)
        if not down.any():
            break
        here = at[down]
        far = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * np.einsum("ij,ij->i", asked[down], points[tree["vantage"][here]])))
        at[down] = np.where(far <= tree["radius"][here], tree["inside"][here], tree["outside"][here])
    out = np.full(len(asked), np.inf)
    for node in np.unique(at):
        mine = np.flatnonzero(at == node)
        rows = tree["order"][tree["start"][node] : tree["end"][node]]
        if len(rows) >= keep:
            far = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (asked[mine] @ points[rows].T)))
            out[mine] = np.partition(far, keep - 1, axis=1)[:, keep - 1]
    return out


def search_tree(
    tree: dict[str, np.ndarray], points: np.ndarray, asked: np.ndarray, keep: int, factor: float, bound: np.ndarray | None = None
) -> np.ndarray:
    """Row numbers of about the ``keep`` nearest points of each asked unit vector, -1 where there are fewer.

    Nothing farther than ``bound`` is needed.  All queries walk the tree
    together, so every node is met once.
    """
    found = np.full((len(asked), keep), -1)
    best = np.full((len(asked), keep), np.inf)
    limit = home_bound(tree, points, asked, keep)
    if bound is not None:
        limit = np.minimum(limit, bound)

    def offer(act: np.ndarray, rows: np.ndarray, far: np.ndarray) -> None:
        near = (far <= limit[act][:, None] + 1e-9).any(axis=1)
        act, far = act[near], far[near]
        if not len(act):
            return
        far = np.concatenate([best[act], far], axis=1)
        ids = np.concatenate([found[act], np.broadcast_to(rows, (len(act), len(rows)))], axis=1)
        top = np.argpartition(far, keep - 1, axis=1)[:, :keep]
        best[act], found[act] = np.take_along_axis(far, top, 1), np.take_along_axis(ids, top, 1)
        limit[act] = np.minimum(limit[act], best[act].max(axis=1))

    def distance(act: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (asked[act] @ points[rows].T)))

    def visit(node: int, act: np.ndarray) -> None:
        if not len(act):
            return
        if tree["vantage"][node] < 0:
            rows = tree["order"][tree["start"][node] : tree["end"][node]]
            if len(rows):
                offer(act, rows, distance(act, rows))
            return
        top = tree["vantage"][node : node + 1]
        far = distance(act, top)
        offer(act, top, far)
        room = tree["radius"][node] - far[:, 0]
        # The k-th best so far bounds what is worth a look on the other side.
        visit(tree["inside"][node], act[(room >= 0) | (-room <= factor * limit[act] + 1e-9)])
        visit(tree["outside"][node], act[(room < 0) | (room <= factor * limit[act] + 1e-9)])

    visit(0, np.arange(len(asked)))
    return found


def pivots(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> dict[int, np.ndarray]:
    """Unit vectors that the regions of each dimension lie around: one for a shard's worth of rows, ``PIVOTS`` at most."""
    sizes = vectors.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / shard_rows).alias("shards"))
    order = Window.partitionBy("dim").orderBy(F.xxhash64("vector"), "id")
    ranked = vectors.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= PIVOTS)
    chosen = ranked.join(sizes, "dim").where(F.col("__n") <= F.col("shards")).select("dim", "__n", "vector").collect()
    held: dict[int, list] = {}
    for r in sorted(chosen, key=lambda r: (r["dim"], r["__n"])):
        held.setdefault(r["dim"], []).append(r["vector"])
    return {dim: _unit(np.array(rows, dtype=np.float64)) for dim, rows in held.items()}


def _far(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Straight-line distances of unit vectors to the pivots."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (rows @ centres.T)))


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The dimension, the row numbers and the vectors of each dimension in a batch."""
    dims = np.asarray(batch.column("dim"))
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        yield int(dim), at, _matrix(batch.take(pa.array(at)), int(dim))


def regions(vectors: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """Add to (dim, id, vector) the region, that of the nearest pivot, and the distance to it."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            region, away = np.zeros(batch.num_rows, dtype=np.int32), np.zeros(batch.num_rows)
            for dim, at, rows in _by_dim(batch):
                # Queries may have a dimension that no indexed row has.
                if dim in centres:
                    far = _far(_unit(rows), centres[dim])
                    region[at], away[at] = far.argmin(axis=1), far.min(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(region), pa.array(away)], names=["dim", "id", "vector", "region", "away"])

    return vectors.select("dim", "id", "vector").mapInArrow(place, "dim int, id long, vector array<double>, region int, away double")


@dataclass
class Index:
    """The trees of all shards (dim, region, part, tree), written; the pivots; and each region's radius and number of shards."""

    trees: DataFrame
    centres: dict[int, np.ndarray]
    radius: dict[int, np.ndarray]
    parts: dict[int, np.ndarray]


def build(vectors: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> Index:
    """The index over (dim, id, vector); every row is in it.

    Of the rows of one direction a shard keeps the ``k + 1`` smallest ids, as
    no other can be among the k nearest of a row.  The driver holds the pivots
    and two numbers for each.
    """
    centres = pivots(vectors, shard_rows)
    placed = materialize(regions(vectors, centres), "regions")
    # One row per region.
    found = placed.groupBy("dim", "region").agg(F.count(F.lit(1)).alias("rows"), F.max("away").alias("radius")).collect()
    radius = {dim: np.zeros(len(c)) for dim, c in centres.items()}
    parts = {dim: np.zeros(len(c), dtype=np.int64) for dim, c in centres.items()}
    for r in found:
        radius[r["dim"]][r["region"]] = r["radius"]
        parts[r["dim"]][r["region"]] = -(-r["rows"] // shard_rows)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, region, ids = (np.asarray(batch.column(c)) for c in ("dim", "region", "id"))
            part = np.zeros(batch.num_rows, dtype=np.int64)
            for dim in np.unique(dims):
                at = dims == dim
                part[at] = _part(ids[at], parts[int(dim)][region[at]])
            yield pa.RecordBatch.from_arrays([batch.column("dim"), batch.column("region"), pa.array(part), batch.column("id"), batch.column("vector")], names=["dim", "region", "part", "id", "vector"])

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        dim, region, part = (x.as_py() for x in key)
        ids, rows = np.asarray(table.column("id")), _scaled(_matrix(table, dim))
        by_id = np.argsort(ids, kind="stable")
        ids, rows = ids[by_id], rows[by_id]
        distinct, which = np.unique(rows, axis=0, return_inverse=True)
        which = which.reshape(-1)
        by_vector = np.argsort(which, kind="stable")
        starts = np.searchsorted(which[by_vector], np.arange(len(distinct) + 1))
        place = np.arange(len(ids)) - starts[which[by_vector]]
        kept = place <= k
        out = io.BytesIO()
        np.savez(
            out, ids=ids[by_vector][kept], owner=which[by_vector][kept], rows=distinct, **build_tree(_unit(distinct))
        )
        return pa.table({"dim": [dim], "region": [region], "part": [part], "tree": [out.getvalue()]}, schema=packed)

    packed = pa.schema([("dim", pa.int32()), ("region", pa.int32()), ("part", pa.int64()), ("tree", pa.binary())])
    dealt = placed.mapInArrow(deal, "dim int, region int, part long, id long, vector array<double>")
    trees = dealt.groupBy("dim", "region", "part").applyInArrow(pack, "dim int, region int, part long, tree binary")
    return Index(materialize(trees, "vptrees"), centres, radius, parts)


def _part(ids: np.ndarray, count: np.ndarray) -> np.ndarray:
    """An even number below ``count`` from an id."""
    mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    return (mixed % np.maximum(count, 1).astype(np.uint64)).astype(np.int64)


def _nearest_in(
    tree: dict[str, np.ndarray], rows: np.ndarray, ids: np.ndarray, k: int, factor: float, bound: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, member id, score) of the k best of a shard for each row, ties to the smaller id; the own id is left out.

    Nothing farther than a row's ``bound`` is needed.  As long as the last
    vector kept ties with a query's k-th, more are kept.
    """
    units, asked = _unit(tree["rows"]), _unit(rows)
    done: list[tuple] = []
    going, keep = np.arange(len(rows)), k + 4
    while len(going):
        wide = min(keep, len(units))
        again = []
        # So many queries at once that their lists stay small.
        for part in np.array_split(going, max(1, len(going) * wide // 4_000_000)):
            found = search_tree(tree, units, asked[part], wide, factor, bound[part])
            at, slot = np.nonzero(found >= 0)
            vector = found[at, slot]
            score = cosine(rows[part[at]], tree["rows"][vector])
            # Each vector found stands for the smallest of the ids that have its direction.
            first = np.searchsorted(tree["owner"], vector)
            count = np.searchsorted(tree["owner"], vector, side="right") - first
            of = np.repeat(np.arange(len(vector)), count)
            member = tree["ids"][np.repeat(first, count) + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)]
            query, value = at[of], score[of]
            other = member != ids[part[query]]
            query, member, value = query[other], member[other], value[other]
            order = np.lexsort((member, -value, query))
            query, member, value = query[order], member[order], value[order]
            place = np.arange(len(query)) - np.searchsorted(query, query)
            worst = np.full(len(part), np.inf)
            np.minimum.at(worst, at, score)
            kth = np.full(len(part), -np.inf)
            last = place == k - 1
            kth[query[last]] = value[last]
            # A list that is not full holds all there is within the bound.
            open_ = (np.bincount(at, minlength=len(part)) == wide) & (worst >= kth - CLOSE) & (wide < len(units))
            top = (place < k) & ~open_[query]
            done.append((part[query[top]], member[top], value[top]))
            again.append(part[open_])
        going, keep = np.concatenate(again), keep * 4
    return tuple(np.concatenate(c) for c in zip(*done)) if done else (np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0))


def search(index: Index, queries: DataFrame, k: int, factor: float = 1.0, query_rows: int = QUERY_ROWS) -> DataFrame:
    """The k nearest rows of each query: query_id, rank (from 1), vec_id, score.

    Rows with the query's own id are left out; ties go to the smaller id; with
    fewer than k candidates all are returned.  Blocks of at most about
    ``query_rows`` queries meet one shard at a time.
    """
    shard = ["dim", "region", "part"]
    # Tasks get the arrays, not the table.
    all_centres, radius, shards = index.centres, index.radius, index.parts
    fields = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def look_up(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return fields.empty_table()
        ids, rows = np.asarray(left.column("id")), _matrix(left, key[0].as_py())
        tree = dict(np.load(io.BytesIO(right.column("tree")[0].as_py())))
        # The distance that goes with the k-th score so far; without one there is no bound.
        kth = np.asarray(left.column("kth").combine_chunks().cast(pa.float64()).to_numpy(zero_copy_only=False), dtype=np.float64)
        bound = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * kth)) + 1e-9
        query, member, score = _nearest_in(tree, rows, ids, k, factor, np.where(np.isnan(bound), np.inf, bound))
        return pa.table([ids[query], member, score], schema=fields)

    def meet(asked: DataFrame) -> DataFrame:
        """Queries dealt to shards against the trees, block by block."""
        asked = materialize(asked, "asked")
        blocks = asked.groupBy(*shard).agg(F.ceil(F.count(F.lit(1)) / query_rows).alias("blocks"))
        left = asked.join(blocks, shard).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
        several = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
        right = index.trees.join(blocks, shard).select(*shard, several, "tree")
        by = [*shard, "block"]
        return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(look_up, "query_id long, vec_id long, score double")

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, region, ids = (np.asarray(batch.column(c)) for c in ("dim", "region", "id"))
            count = np.array([shards[d][r] if d in shards else 0 for d, r in zip(dims.tolist(), region.tolist())], dtype=np.int64)
            there = pa.array(count > 0)
            part = pa.array(_part(ids, count))
            kth = pa.nulls(batch.num_rows, pa.float64())
            out = [batch.column("dim"), batch.column("region"), part, batch.column("id"), batch.column("vector"), kth]
            yield pa.RecordBatch.from_arrays([c.filter(there) for c in out], names=[*shard, "id", "vector", "kth"])

    kind = "dim int, region int, part long, id long, vector array<double>, kth double"
    first = materialize(regions(queries, index.centres).mapInArrow(home, kind), "home")
    one = materialize(meet(first), "round-one")
    # The k-th score of a query, as a distance, bounds its second round.
    worst = one.groupBy("query_id").agg(F.count(F.lit(1)).alias("__n"), F.min("score").alias("__s"))
    bounded = first.drop("kth").join(worst, F.col("id") == F.col("query_id"), "left").select(
        "dim", "region", "part", "id", "vector", F.when(F.col("__n") >= k, F.col("__s")).alias("kth")
    )

    def onward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at, rows in _by_dim(batch):
                centres, parts = all_centres[dim], shards[dim]
                region, part, ids = (np.asarray(batch.column(c).take(pa.array(at))) for c in ("region", "part", "id"))
                kth = batch.column("kth").take(pa.array(at)).to_numpy(zero_copy_only=False).astype(np.float64)
                limit = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * kth))
                limit = np.where(np.isnan(limit), np.inf, factor * limit) + 1e-9
                row, to = np.nonzero((_far(_unit(rows), centres) - radius[dim] <= limit[:, None]) & (parts > 0))
                row, to, number = np.repeat(row, parts[to]), np.repeat(to, parts[to]), _counted(parts[to])
                other = (to != region[row]) | (number != part[row])
                row, to, number = row[other], to[other], number[other]
                for start in range(0, len(row), 10_000):
                    here = slice(start, start + 10_000)
                    vector = batch.column("vector").take(pa.array(at[row[here]]))
                    columns = [np.full(len(row[here]), dim, dtype=np.int32), to[here].astype(np.int32), number[here], ids[row[here]]]
                    sofar = pa.array(kth[row[here]], from_pandas=True)
                    yield pa.RecordBatch.from_arrays([*map(pa.array, columns), vector, sofar], names=[*shard, "id", "vector", "kth"])

    near = one.unionByName(meet(bounded.mapInArrow(onward, kind)))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        near.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _counted(times: np.ndarray) -> np.ndarray:
    """0..t-1 for every t, one after the other."""
    return np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
