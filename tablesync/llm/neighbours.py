"""Near duplicates among embeddings: all pairs within an angle, by blocks of vectors.

On unit vectors a cosine of ``threshold`` is a distance ``t``, so the triangle
inequality holds. The upper levels are the same for all rows: centres that
are found in a bounded sample and broadcast.

* A ball of radius ``t / 2`` around a dense centre is a *clique*: any two rows in
  it are near. They are counted and joined by an aggregate, however many they are.
* All other rows belong to the cell of their nearest wide centre. Cells and
  cliques whose balls are farther apart than ``t`` do not meet.

Cells and cliques are cut into blocks of bounded size, each a row of one table.
Pairs of blocks are formed while that table's files are read, so they take no
place on disk; only rows within ``t`` of the other block's ball are compared.
Rows are compared by sketches first: their lengths along a few wide axes and
that of the rest, whose product is no less than the cosine. Pairs that pass are
compared by their cosine. Where these are too many, each block's rows form a
cover tree: the root covers all of it, each next level covers it by balls of
half the radius around some of its points. In a dual traversal, node pairs whose
balls are farther apart than ``t`` are pruned, those that lie within ``t``
altogether are counted as a whole, the others go on to their children. So the
result is exact, while what is compared depends on how well the data separate:
rows without any structure meet all blocks, which takes time, not disk.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import discard, pa_schema, written
from tablesync.llm.components import components

#: Most rows and bytes (of single numbers) of a block, and most files of blocks; rows of the sample; most centres of each kind.
BLOCK, BLOCK_BYTES, FILES, SAMPLE, CENTRES = 8192, 8 << 20, 2000, 4096, 256
#: Rows of two sketches that are multiplied at a time; most candidates a row before trees are built; blocks that a task holds.
TILE, CANDIDATES, HELD = (256, 1024), 16, 8
#: Share of a sample's pairs that sketches may leave open.
PASSED = 2e-6
#: Rows of the sample that a dense centre must have around it.
DENSE = 8
#: Node pairs closer than this to a bound are decided further down.
MARGIN = 1e-7


def reach(threshold: float) -> float:
    """The distance of unit vectors whose cosine is ``threshold``."""
    return float(np.sqrt(2 - 2 * threshold))


def distances(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Distances between the rows of two arrays of unit vectors."""
    return np.sqrt(np.maximum(2 - 2 * (one @ two.T), 0))


def units(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows as vectors of length one, and which of them are any: those with a direction."""
    good = np.isfinite(points).all(1) & points.any(1)
    found = np.where(good[:, None], points, 1.0)
    found /= np.abs(found).max(1, keepdims=True)
    found /= np.sqrt((found * found).sum(1, keepdims=True))
    return found, good


def unit(values: list | None) -> np.ndarray | None:
    """A vector of length one, or None if there is none in this direction."""
    if not values or any(v is None for v in values):
        return None
    found, good = units(np.array([values], np.float64))
    return found[0] if good[0] else None


@dataclass(frozen=True)
class Tree:
    """A cover tree: rows in the order of its nodes, and for each node its centre, radius, rows and children."""

    ids: np.ndarray
    weights: np.ndarray
    points: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    child: np.ndarray
    n_children: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, weights: np.ndarray, points: np.ndarray) -> Tree:
        """The tree of some rows; nodes are laid out level by level, so children lie together."""
        order, members = np.arange(len(ids)), [(0, len(ids))]
        centre, radius, start, stop, child, n_children = [0], [0.0], [0], [len(ids)], [0], [0]
        at = 0
        while at < len(members):
            low, high = members[at]
            mine = order[low:high]
            start[at], stop[at] = low, high
            if high - low > 1:
                far = distances(points[mine[:1]], points[mine])[0]
                radius[at] = float(far.max())
                level = 2.0 ** (np.ceil(np.log2(max(radius[at], 1e-12))) - 1)  # half the level that covers the node
                parts = cover(points, mine, level) if radius[at] > MARGIN else []
                if len(parts) < 2:  # nothing but rounding tells them apart
                    parts = [mine[i : i + 1] for i in range(len(mine))]
                order[low:high] = np.concatenate(parts)
                child[at], n_children[at] = len(members), len(parts)
                for part in parts:
                    members.append((low, low + len(part)))
                    low += len(part)
                    for column in (centre, radius, start, stop, child, n_children):
                        column.append(0)
            at += 1
        start = np.array(start)
        return cls(
            ids[order], weights[order], points[order], start, np.array(radius, np.float64),
            start, np.array(stop), np.array(child), np.array(n_children),
        )

    def dumps(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.__dict__)
        return out.getvalue()

    @classmethod
    def loads(cls, data: bytes) -> Tree:
        with np.load(io.BytesIO(data), allow_pickle=False) as held:
            return cls(**{name: held[name] for name in held.files})


def cover(points: np.ndarray, members: np.ndarray, radius: float) -> list[np.ndarray]:
    """Members in groups within ``radius`` of the first of each; no two first ones are that near."""
    groups, left = [], members
    while len(left):
        some = min(256, len(left))
        near = distances(points[left[:some]], points[left]) <= radius
        near[np.arange(some), np.arange(some)] = True
        taken = np.full(len(left), -1)
        for i in range(some):
            if taken[i] < 0:
                taken[near[i] & (taken < 0)] = i
        for i in np.flatnonzero(taken[:some] == np.arange(some)):
            mine = left[taken == i]
            groups.append(np.concatenate([left[i : i + 1], mine[mine != left[i]]]))
        left = left[taken < 0]
    return groups


class Union:
    """Joined sets of places, many links at a time."""

    def __init__(self, size: int):
        self.of = np.arange(size)

    def join(self, one: np.ndarray, two: np.ndarray) -> None:
        while len(one):
            one, two = self.of[one], self.of[two]
            differ = one != two
            one, two = one[differ], two[differ]
            np.minimum.at(self.of, np.maximum(one, two), np.minimum(one, two))
            while (self.of != (further := self.of[self.of])).any():
                self.of = further


class Meeting:
    """The dual traversal of two trees: near rows of the other tree by weight, and what is joined."""

    def __init__(self, one: Tree, two: Tree | None, threshold: float):
        self.same = two is None
        self.one, self.two = one, one if two is None else two
        self.threshold, self.t = threshold, reach(threshold)
        self.counts = [np.zeros(len(t.ids) + 1, np.int64) for t in (self.one, self.two)]
        self.joined = [np.zeros(len(t.ids) + 1, np.int64) for t in (self.one, self.two)]
        self.before = [np.concatenate([[0], np.cumsum(t.weights)]) for t in (self.one, self.two)]
        self.union = Union(len(self.one.ids) + (0 if self.same else len(self.two.ids)))
        self.shift = 0 if self.same else len(self.one.ids)
        self._walk()

    def _walk(self) -> None:
        root = np.zeros(1, np.int64)
        todo = [(root, root)]
        while todo:
            one, two = todo.pop()
            for i in range(0, len(one), 512):
                for a, b in self._compare(one[i : i + 512], two):
                    todo.append((a, b))
        for tree, joined, shift in zip((self.one, self.two), self.joined, (0, self.shift)):
            along = np.flatnonzero(np.cumsum(joined)[: len(tree.ids)] > 0)  # joined with the next row
            self.union.join(along + shift, along + shift + 1)

    def _compare(self, one: np.ndarray, two: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Decide on pairs of nodes; give those of children that are still open."""
        a, b = self.one, self.two
        cosine = a.points[a.centre[one]] @ b.points[b.centre[two]].T
        apart = np.sqrt(np.maximum(2 - 2 * cosine, 0))
        both = a.radius[one][:, None] + b.radius[two]
        leaf_a, leaf_b = a.n_children[one] == 0, b.n_children[two] == 0
        single = leaf_a[:, None] & leaf_b
        within = np.where(single, cosine >= self.threshold, apart + both <= self.t - MARGIN)
        open_ = ~single & ~within & (apart - both <= self.t + MARGIN)
        x, y = np.nonzero(within)
        if len(x):
            self._near(one[x], two[y])
        for i in np.flatnonzero(open_.any(axis=1)):
            others = two[open_[i]]
            down = self._children(b, others) if not leaf_b[open_[i]].all() or leaf_a[i] else others
            yield self._children(a, one[i : i + 1]), down

    @staticmethod
    def _children(tree: Tree, nodes: np.ndarray) -> np.ndarray:
        """Children of nodes; a node without any stands for itself."""
        n = np.maximum(tree.n_children[nodes], 1)
        first = np.where(tree.n_children[nodes] > 0, tree.child[nodes], nodes)
        return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())

    def _near(self, one: np.ndarray, two: np.ndarray) -> None:
        """All rows of these pairs of nodes are near each other."""
        sides = [(self.one, one, self.two, two, 0), (self.two, two, self.one, one, 1)]
        for tree, mine, other, its, side in sides[: 1 if self.same else 2]:
            before = self.before[1 - side] if not self.same else self.before[0]
            more = before[other.stop[its]] - before[other.start[its]]
            np.add.at(self.counts[side], tree.start[mine], more)
            np.add.at(self.counts[side], tree.stop[mine], -more)
        for tree, mine, side in ((self.one, one, 0), (self.two, two, 1)):
            long = mine[tree.stop[mine] - tree.start[mine] > 1]
            np.add.at(self.joined[side], tree.start[long], 1)
            np.add.at(self.joined[side], tree.stop[long] - 1, -1)
        self.union.join(self.one.start[one], self.two.start[two] + self.shift)

    def rows(self) -> Iterator[tuple[int, int, int]]:
        """Of each row that is near another: id, weight of the near rows, and an id it is joined with."""
        ids = self.one.ids if self.same else np.concatenate([self.one.ids, self.two.ids])
        found = [np.cumsum(c)[:-1] for c in self.counts]
        counts = found[0] if self.same else np.concatenate(found)
        at = np.flatnonzero(counts)
        return zip(ids[at].tolist(), counts[at].tolist(), ids[self.union.of[at]].tolist())


def sketch(points: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Unit vectors along some axes, and the length of what is left: the product of two sketches is no less than their cosine."""
    part = points @ axes
    rest = np.sqrt(np.maximum(1 - (part * part).sum(1), 0))
    return np.column_stack([part, rest]).astype(np.float32)


def bound(threshold: float, axes: np.ndarray) -> np.float32:
    """What the product of the sketches of near rows reaches, for all rounding."""
    return np.float32(threshold - (axes.shape[1] + 9) * 2.0**-23)


def axes_of(sample: np.ndarray, threshold: float) -> np.ndarray:
    """The widest axes of a sample, as many as tell nearly all of its pairs apart, or all axes."""
    dim = sample.shape[1]
    some = sample[:1024]
    if len(some) >= 64:
        widest = np.linalg.eigh(np.cov(sample.T))[1][:, ::-1] if dim > 8 else np.eye(dim)
        far = some @ some.T < threshold
        n = 7
        while n + 8 < dim:
            held = sketch(some, widest[:, :n])
            if ((held @ held.T >= bound(threshold, widest[:, :n])) & far).sum() <= PASSED * far.size:
                return np.ascontiguousarray(widest[:, :n])
            n += max(8, n // 32 * 8)
    return np.eye(dim)


def _candidates(one: np.ndarray, two: np.ndarray | None, least: np.float32) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of rows whose sketches have a product of ``least``; of one with itself, each pair once."""
    same = two is None
    two = one if same else two
    rows, columns = TILE
    across = [np.ascontiguousarray(two[j : j + columns].T) for j in range(0, len(two), columns)]
    for i in range(0, len(one), rows):
        for k, part in enumerate(across):
            j = k * columns
            if same and j + part.shape[1] <= i + 1:
                continue
            passed = one[i : i + rows] @ part >= least
            if not passed.any():
                continue
            x, y = np.nonzero(passed)
            x, y = x + i, y + j
            if same:
                x, y = x[x < y], y[x < y]
            if len(x):
                yield x, y


@dataclass(frozen=True)
class Block:
    """Weights, unit vectors and sketches of some classes, and the ball that holds them."""

    weights: np.ndarray
    points: np.ndarray
    held: np.ndarray
    centre: np.ndarray | None
    far: float

    def part(self, other: Block, t: float) -> np.ndarray:
        """Places of the rows that may be near some row of the other block."""
        if other.centre is None:
            return np.arange(len(self.weights))
        return np.flatnonzero(distances(self.points, other.centre[None])[:, 0] <= other.far + t + MARGIN)


def near_rows(one: Block, two: Block | None, threshold: float, least: np.float32) -> tuple[np.ndarray, ...]:
    """Of each row that is near others: its place, the weight of these, and the place of a row it is joined with.

    Places go through both blocks. Sketches say which pairs are compared; where
    they leave too many of them, trees of the rows concerned meet instead.
    """
    same = two is None
    n = len(one.weights)
    mine = np.arange(n) if same else one.part(two, reach(threshold))
    its = mine if same else two.part(one, reach(threshold))
    other = one if same else two
    weights = one.weights if same else np.concatenate([one.weights, two.weights])
    shift = 0 if same else n
    some, more = np.zeros(n, bool), np.zeros(len(other.weights), bool)
    found, met = [], 0
    for x, y in _candidates(one.held[mine], None if same else other.held[its], least):
        x, y = mine[x], its[y]
        some[x], more[y] = True, True
        met += len(x)
        if met <= CANDIDATES * len(weights):
            found.append((x, y))
    counts, union = np.zeros(len(weights), np.int64), Union(len(weights))
    if met > CANDIDATES * len(weights):
        places = [np.flatnonzero(some | more)] if same else [np.flatnonzero(some), np.flatnonzero(more)]
        trees = [Tree.of(p + s, b.weights[p], b.points[p]) for p, b, s in zip(places, (one, other), (0, shift))]
        rows = np.array(list(Meeting(trees[0], None if same else trees[1], threshold).rows()), np.int64).reshape(-1, 3)
        counts[rows[:, 0]] = rows[:, 1] - (weights[rows[:, 0]] if same else 0)
        union.join(rows[:, 0], rows[:, 2])
    else:
        near = [np.zeros((2, 0), np.int64)]
        for x, y in found:
            for i in range(0, len(x), 8192):
                a, b = x[i : i + 8192], y[i : i + 8192]
                is_near = np.einsum("ij,ij->i", one.points[a], other.points[b]) >= threshold
                near.append(np.array([a[is_near], b[is_near] + shift]))
        a, b = np.concatenate(near, axis=1)
        np.add.at(counts, a, weights[b])
        np.add.at(counts, b, weights[a])
        union.join(a, b)
    at = np.flatnonzero(counts)
    return at, counts[at], union.of[at]


@dataclass(frozen=True)
class Centres:
    """Centres of one dimension: dense ones and wide ones; and the axes of sketches."""

    dense: np.ndarray
    wide: np.ndarray
    axes: np.ndarray

    @classmethod
    def of(cls, sample: np.ndarray, t: float, cells: int, threshold: float) -> Centres:
        """Dense centres by the rows around them, moved to the middle of these; wide ones as they come."""
        near = [distances(sample[i : i + 512], sample) <= t / 2 for i in range(0, len(sample), 512)]
        near = np.concatenate(near)
        left, dense = np.ones(len(sample), bool), []
        while len(dense) < CENTRES:
            around = (near & left).sum(1) * left
            best = int(around.argmax())
            if around[best] < DENSE:
                break
            centre = sample[best]
            for _ in range(3):
                mine = left & (distances(centre[None], sample)[0] <= t / 2)
                if not mine.any():
                    mine = near[best] & left
                middle = sample[mine].mean(0)
                centre = middle / np.linalg.norm(middle)
            dense.append(centre)
            left &= distances(centre[None], sample)[0] > t / 2
            left[best] = False
        empty = np.zeros((0, sample.shape[1]))
        rest = sample[left] if left.any() else sample
        wide = rest[: max(1, min(cells, CENTRES))]
        return cls(np.array(dense) if dense else empty, wide, axes_of(sample, threshold))

    def place(self, points: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each row is in a clique, the number of its clique or cell, and its distance from the centre."""
        wide = distances(points, self.wide)
        home = wide.argmin(1)
        far = wide[np.arange(len(points)), home]
        if not len(self.dense):
            return np.zeros(len(points), bool), home, far
        dense = distances(points, self.dense)
        own = dense.argmin(1)
        near = dense[np.arange(len(points)), own]
        clique = near <= t / 2 - MARGIN
        return clique, np.where(clique, own, home), np.where(clique, near, far)


@dataclass(frozen=True)
class Cell:
    """A clique or cell: its ball, and its blocks, which are numbered through all cells."""

    dim: int
    clique: bool
    cell: int
    centre: np.ndarray | None
    far: float
    first: int
    blocks: int


def _vectors(rows: DataFrame) -> DataFrame:
    """``id, key, dim, vector`` of each row; key and vector are null if it can be near nothing.

    The vector is kept as it came, the key is a digest of the unit vector.
    """
    schema = "id long, key binary, dim int, vector binary"
    target = pa_schema(rows.sparkSession, schema)

    def run(batches):
        for batch in batches:
            lists = batch.column("vector")
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False)  # null components become undefined ones
            starts = np.cumsum(sizes) - sizes
            keys, dims, data = ([None] * len(sizes) for _ in range(3))
            for dim in np.unique(sizes[sizes > 0]).tolist():
                at = np.flatnonzero(sizes == dim)
                values = flat[starts[at][:, None] + np.arange(dim)]
                found, good = units(values.astype(np.float64))
                for i, one, value in zip(at[good].tolist(), found[good], values[good]):
                    keys[i] = hashlib.blake2b(one.tobytes(), digest_size=16).digest()
                    dims[i], data[i] = dim, value.tobytes()
            columns = [pa.array(c, f.type) for c, f in zip((keys, dims, data), list(target)[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(target[0].type), *columns], schema=target)

    return rows.mapInArrow(run, schema)


def _points(data: bytes, dim: int, size: int) -> np.ndarray:
    """Unit vectors of ``size`` kept vectors, which are of single or of double numbers."""
    return units(np.frombuffer(data, f"f{len(data) // (dim * size)}").reshape(size, dim).astype(np.float64))[0]


def _centres(vectors: DataFrame, t: float, threshold: float) -> dict[int, Centres]:
    """Centres of each dimension that the sample has."""
    known = vectors.filter("key is not null")
    sizes = {r["dim"]: r["n"] for r in known.groupBy("dim").agg(F.approx_count_distinct("key").alias("n")).collect()}
    # The sample has the least ranks of all; a share of twice its size holds them without a look at the other vectors.
    share = 2 * SAMPLE / max(1, sum(sizes.values()))
    ranked = known.withColumn("rank", F.xxhash64("key"))
    if share < 1:
        ranked = ranked.filter(F.col("rank") < F.lit(int(share * 2**64) - 2**63))
    distinct = ranked.groupBy("rank", "key", "dim").agg(F.first("vector").alias("vector"))
    sample = distinct.orderBy("rank", "key").limit(SAMPLE).select("dim", "vector").collect()
    found = {}
    for dim in {r["dim"] for r in sample}:
        points = np.concatenate([_points(r["vector"], dim, 1) for r in sample if r["dim"] == dim])
        found[dim] = Centres.of(points, t, -(-sizes[dim] // BLOCK), threshold)
    return found


def _placed(vectors: DataFrame, centres: dict[int, Centres], t: float) -> DataFrame:
    """``dim, clique, cell, far, key, n, least, vector`` of each vector: its place, rows and least id, in parts.

    Equal vectors that are read together are one part already, so a vector
    that very many rows have is no one's burden.
    """
    schema = "dim int, clique boolean, cell int, far double, key binary, n long, least long, vector binary"
    target = pa_schema(vectors.sparkSession, schema)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            part = pa.table(batch.columns[:3], ["id", "key", "dim"]).append_column("at", pa.array(np.arange(batch.num_rows)))
            part = part.group_by("key").aggregate([("id", "min"), ("id", "count", pc.CountOptions(mode="all")), ("at", "min"), ("dim", "min")])
            dims, at = part["dim_min"].to_numpy(), part["at_min"].to_numpy()
            data = batch.column(3)
            for dim in np.unique(dims).tolist():
                mine = np.flatnonzero(dims == dim)
                kept = data.take(pa.array(at[mine]))
                size = len(mine)
                known = centres.get(dim)
                if known is None:
                    place = np.zeros(size, bool), np.zeros(size, np.int64), np.full(size, 2.0)
                else:
                    place = known.place(np.concatenate([_points(v, dim, 1) for v in kept.to_pylist()]), t)
                own = part.take(pa.array(mine))
                columns = [np.full(size, dim), *place, *(own[c].combine_chunks() for c in ("key", "id_count", "id_min")), kept]
                columns = [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, target)]
                yield pa.RecordBatch.from_arrays(columns, schema=target)

    return vectors.filter("key is not null").select("id", "key", "dim", "vector").mapInArrow(run, schema)


def _cells(placed: DataFrame, centres: dict[int, Centres]) -> list[Cell]:
    """All cliques and cells with their balls; there are at most ``CENTRES`` of a kind and dimension."""
    home = ["dim", "clique", "cell"]
    sizes = placed.groupBy(*home).agg(F.approx_count_distinct("key").alias("n"), F.max("far").alias("far")).collect()
    found, first = [], 0
    for row in sorted(sizes, key=lambda r: [r[c] for c in home]):
        known = centres.get(row["dim"])
        centre = None if known is None else (known.dense if row["clique"] else known.wide)[row["cell"]]
        blocks = -(-row["n"] // max(1, min(BLOCK, BLOCK_BYTES // (4 * row["dim"]))))
        found.append(Cell(row["dim"], row["clique"], row["cell"], centre, row["far"], first, max(1, blocks)))
        first += found[-1].blocks
    return found


def _meets(cells: list[Cell], t: float) -> list[list[int]]:
    """The cells that may hold rows near those of each cell. Rows of one clique are near each other anyway."""
    found: list[list[int]] = [[] for _ in cells]
    by_dim: dict[int, list[int]] = {}
    for i, cell in enumerate(cells):
        by_dim.setdefault(cell.dim, []).append(i)
    for mine in by_dim.values():
        if cells[mine[0]].centre is None:
            near = np.ones((len(mine), len(mine)), bool)
        else:
            points, far = np.array([cells[i].centre for i in mine]), np.array([cells[i].far for i in mine])
            near = distances(points, points) - far[:, None] - far <= t + MARGIN
        for i, row in zip(mine, near):
            found[i] = [j for j, meets in zip(mine, row) if meets and not (i == j and cells[i].clique)]
    return found


def _blocks(placed: DataFrame, cells: list[Cell], t: float) -> DataFrame:
    """A row per block: its number, its cell and the cells that this meets; and of its classes ``n, keys, least, vectors``.

    Equal vectors are one class. ``least`` is its least id, where ``named`` says that there is one.
    """
    spark = placed.sparkSession
    homes = [(c.dim, c.clique, c.cell, c.first, c.blocks) for c in cells]
    homes = spark.createDataFrame(homes, "dim int, clique boolean, cell int, first int, blocks int")
    block = (F.col("first") + F.pmod(F.xxhash64("key"), F.col("blocks"))).cast("int").alias("block")
    cut = placed.join(F.broadcast(homes), ["dim", "clique", "cell"]).select(block, "key", "n", "least", "vector")
    schema = "block int, cell int, meets array<int>, weight long, n binary, keys binary, least binary, named binary, vectors binary"
    target, meets = pa_schema(spark, schema), _meets(cells, t)
    firsts = [c.first for c in cells]

    def build(key, rows):
        number = key[0].as_py()
        cell = int(np.searchsorted(firsts, number, "right")) - 1
        keys = np.frombuffer(b"".join(rows["key"].to_pylist()), ">u8").reshape(-1, 2)
        order = np.lexsort((keys[:, 1], keys[:, 0]))
        starts = np.flatnonzero(np.r_[True, (np.diff(keys[order].view(np.int64), axis=0) != 0).any(1)])
        n = np.add.reduceat(rows["n"].to_numpy()[order], starts)
        named = rows["least"].is_valid().to_numpy()[order]
        last = np.iinfo(np.int64).max
        least = np.minimum.reduceat(rows["least"].fill_null(last).to_numpy()[order], starts)
        vectors = rows["vector"].take(pa.array(order[starts])).to_pylist()
        row = [number, cell, meets[cell], int(n.sum()), n.tobytes(), keys[order[starts]].tobytes(), least.tobytes()]
        row += [np.logical_or.reduceat(named, starts).tobytes(), b"".join(vectors)]
        return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(row, target)], schema=target)

    # A file of its own for each block, so that pairs of files are tasks of a like size.
    files = min(cells[-1].first + cells[-1].blocks, FILES) if cells else 1
    return cut.repartition(files, "block").groupBy("block").applyInArrow(build, schema)


def _classes(blocks: DataFrame) -> DataFrame:
    """``key, n, least`` of each class."""
    schema = "key binary, n long, least long"
    target = pa_schema(blocks.sparkSession, schema)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_arrays([*_named(row, slice(None))], schema=target)

    names = ["keys", "n", "least", "named"]
    return blocks.select(*names).mapInArrow(run, schema)


def _named(row: dict, places: np.ndarray | slice, side: str = "") -> tuple[pa.Array, ...]:
    """Keys, rows and least ids of some classes of a block."""
    keys = np.frombuffer(row["keys" + side], "V16")[places].tolist()
    n = np.frombuffer(row["n" + side], np.int64)[places]
    least = np.frombuffer(row["least" + side], np.int64)[places]
    return pa.array(keys, pa.binary()), pa.array(n), pa.array(least, mask=~np.frombuffer(row["named" + side], bool)[places])


def _block_pairs(blocks: DataFrame) -> DataFrame:
    """The blocks of each pair that meets, side by side; a block that meets itself is on both sides.

    Both sides are read from their files by the tasks that hold pairs of files
    against each other, so no pair is ever written down.
    """
    names = ["block", "cell", "n", "keys", "least", "named", "vectors"]
    one = blocks.select("meets", *[F.col(c).alias(f"{c}_1") for c in names])
    two = blocks.select(*[F.col(c).alias(f"{c}_2") for c in names])
    a, b = F.col("block_1"), F.col("block_2")
    # Each pair once, and half of them either way, so that all pairs of files have like numbers.
    once = (a == b) | (((a + b) % 2 == 0) & (a < b)) | (((a + b) % 2 != 0) & (a > b))
    pairs = one.hint("shuffle_replicate_nl").join(two, F.array_contains("meets", F.col("cell_2")) & once)
    return pairs.drop("meets")


def near_links(blocks: DataFrame, cells: list[Cell], centres: dict[int, Centres], threshold: float) -> DataFrame:
    """``cid, n, joined, key, least``: how much weight is near each class besides its own, and a class it is joined with.

    In parts: those of a class add up to the weight of all other classes near it.
    Classes that are near no other have none.
    """
    t = reach(threshold)
    schema = "cid long, n long, joined long, key binary, least long"
    target = pa_schema(blocks.sparkSession, schema)

    def load(row: dict, side: str) -> Block:
        cell = cells[row["cell" + side]]
        weights = np.frombuffer(row["n" + side], np.int64)
        points = _points(row["vectors" + side], cell.dim, len(weights))
        axes = centres[cell.dim].axes if cell.dim in centres else np.eye(cell.dim)
        return Block(weights, points, sketch(points, axes), cell.centre, cell.far)

    def meet(batches):
        held: dict[int, Block] = {}
        for batch in batches:
            for row in batch.to_pylist():
                for side in ("_1", "_2"):
                    number = row["block" + side]
                    held[number] = held.pop(number, None) or load(row, side)  # the last used last
                while len(held) > HELD:
                    del held[next(iter(held))]
                a, b = row["block_1"], row["block_2"]
                dim = held[a].points.shape[1]
                least = bound(threshold, centres[dim].axes if dim in centres else np.eye(dim))
                at, n, joined = near_rows(held[a], None if a == b else held[b], threshold, least)
                size = len(held[a].weights)
                cids = np.concatenate([(a << 32) + np.arange(size), (b << 32) + np.arange(len(held[b].weights))])
                for part, side, places in ((at < size, "_1", at[at < size]), (at >= size, "_2", at[at >= size] - size)):
                    key, _, first = _named(row, places, side)
                    columns = [pa.array(cids[at[part]]), pa.array(n[part]), pa.array(cids[joined[part]]), key, first]
                    yield pa.RecordBatch.from_arrays(columns, schema=target)

    def inside(batches):
        for batch in batches:
            for row in batch.to_pylist():
                key, n, first = _named(row, slice(None))
                cids = (row["block"] << 32) + np.arange(len(n))
                others = row["all"] - n.to_numpy()
                columns = [pa.array(cids), pa.array(others), pa.array(np.full(len(n), row["head"] << 32)), key, first]
                yield pa.RecordBatch.from_arrays(columns, schema=target).filter(pa.array(others > 0))

    across = _block_pairs(blocks).mapInArrow(meet, schema)
    cliques = [i for i, c in enumerate(cells) if c.clique]
    members = blocks.filter(F.col("cell").isin(cliques)).select("block", "cell", "weight", "n", "keys", "least", "named")
    whole = members.groupBy(F.col("cell").alias("of")).agg(F.sum("weight").alias("all"), F.min("block").alias("head"))
    members = members.join(F.broadcast(whole), F.col("cell") == F.col("of")).drop("of", "cell", "weight")
    return across.unionByName(members.mapInArrow(inside, schema))


@contextmanager
def single_rows(spark: SparkSession) -> Iterator[None]:
    """Rows go to Python one at a time in a block, since each holds as much as thousands of others."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def link_near(
    rows: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Near rows of every row: ``vec_id, n_links, component_id, kept``.

    ``n_links`` is the number of other rows whose vectors have a cosine of
    ``threshold`` or more with this one's, in double precision; equal vectors
    are one class that is counted by its rows. ``component_id`` is the smallest
    id among the rows that can be reached by links, and ``kept`` says that it is
    the row's own.

    A row per row of ``rows``. Vectors that are null, empty or zero, or that hold
    null, infinite or undefined components, are near nothing; so are vectors
    of different lengths to each other. Rows of a repeated id are rows of their
    own, each with its vector's links. A row without an id is counted as near to others,
    names no component, and is not kept. Other columns are not read.
    """
    if not 0 < threshold < 1:
        raise ValueError("the threshold is a cosine between 0 and 1")
    named = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    single = dict(named.dtypes)["vector"] == "array<float>"
    named = named.withColumn("vector", F.col("vector").cast("array<float>" if single else "array<double>"))
    t = reach(threshold)
    vectors = written(_vectors(named), "vectors")
    centres = _centres(vectors, t, threshold)
    placed = written(_placed(vectors, centres, t), "placed-vectors")
    keyed = written(vectors.select("id", "key"), "vector-keys")
    discard(vectors)
    cells = _cells(placed, centres)
    blocks = written(_blocks(placed, cells, t), "vector-blocks")
    discard(placed)
    with single_rows(rows.sparkSession):
        parts = written(near_links(blocks, cells, centres, threshold), "near-links")
        classes = written(_classes(blocks), "vector-classes")
    discard(blocks)
    totals = parts.groupBy("cid").agg(F.sum("n").alias("others"), F.first("key").alias("key"), F.min("least").alias("least"))
    reached = components(parts.select(F.col("cid").alias("a"), F.col("joined").alias("b")))
    linked = totals.join(reached, F.col("cid") == F.col("id"), "left")
    linked = linked.select(F.coalesce("component", "cid").alias("root"), F.col("key").alias("of"), "others", "least")
    linked = written(linked, "linked-classes")
    discard(parts)
    least = linked.groupBy(F.col("root").alias("its_root")).agg(F.min("least").alias("component"))
    linked = linked.join(least, F.col("root") == F.col("its_root")).select("of", "others", "component")
    found = classes.join(linked, F.col("key") == F.col("of"), "left").select(
        F.col("key").alias("same"),
        (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("links"),
        F.when(F.col("of").isNull(), F.col("least")).otherwise(F.col("component")).alias("component_id"),
    )
    near = keyed.filter("key is not null").join(found, F.col("key") == F.col("same"))
    near = near.select("id", "links", F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))
    alone = keyed.filter("key is null").select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component_id"))
    return near.union(alone).select(
        F.col("id").alias("vec_id"),
        F.col("links").alias("n_links"),
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
