"""Near embeddings against all cosines."""

import math
import os
import threading
from contextlib import contextmanager, suppress

import numpy as np
import pytest

from tablesync.llm import neighbours as N


def brute(rows, threshold=0.95):
    units = [N.unit(v) for _, v in rows]
    n = len(rows)
    links = [[] for _ in rows]
    for i in range(n):
        for j in range(n):
            if i != j and units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]):
                if units[i] @ units[j] >= threshold:
                    links[i].append(j)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        key = rows[i][0]
        known = [rows[j][0] for j in seen if rows[j][0] is not None]
        component = min(known) if key is not None else None
        out.append((key, len(links[i]), component, key is not None and key == component))
    return out


def planted(rng, dim=16):
    """Groups of several widths, lines of neighbours, and rows without neighbours."""
    rows = [rng.normal(size=dim) for _ in range(120)]
    for width, size in ((0.005, 60), (0.03, 60), (0.06, 50), (0.09, 40)):
        middle = rng.normal(size=dim)
        middle /= np.linalg.norm(middle)
        rows += [(middle + width * rng.normal(size=dim)) * rng.uniform(0.1, 9) for _ in range(size)]
    a, b = rng.normal(size=(2, dim))
    rows += [a * math.cos(x) + b * math.sin(x) for x in np.linspace(0, 1.5, 40)]
    rows += [rows[5], rows[5], rows[130], rows[130] * 2]
    return [[float(x) for x in r] for r in rows]


@pytest.mark.parametrize("block, dense", [(4096, 8), (50, 8), (40, 3), (64, 10**6)])
def test_against_all_cosines(spark, monkeypatch, block, dense):
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "DENSE", dense)
    rng = np.random.default_rng(block)
    vectors = planted(rng)
    rows = list(enumerate(vectors))
    rng.shuffle(vectors)
    rows = [(1000 - i, v) for i, v in enumerate(vectors)]
    rows += [(None, vectors[3]), (7, vectors[3]), (7, [1.0] * 16), (-1, None), (-2, []), (-3, [0.0] * 16), (-4, [1.0, None] * 8)]
    rows += [(-5, [math.nan] + [1.0] * 15), (-6, [math.inf] + [1.0] * 15), (-7, [1.0, 2.0]), (-8, [2.0, 4.0]), (-9, [1e300] * 2), (-10, [1e-300] * 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = [tuple(r) for r in N.link_near(df).collect()]
    assert sorted(found, key=repr) == sorted(brute(rows), key=repr)


def test_tree_covers_its_rows():
    rng = np.random.default_rng(2)
    points = np.array([N.unit(v) for v in planted(rng)])
    tree = N.Tree.loads(N.Tree.of(np.arange(len(points)), np.ones(len(points), np.int64), points).dumps())
    assert sorted(tree.ids.tolist()) == list(range(len(points)))
    for at in range(len(tree.start)):
        mine = tree.points[tree.start[at] : tree.stop[at]]
        assert N.distances(tree.points[tree.centre[at]][None], mine).max() <= tree.radius[at] + N.MARGIN
        if tree.n_children[at]:
            children = range(tree.child[at], tree.child[at] + tree.n_children[at])
            assert sum(tree.stop[c] - tree.start[c] for c in children) == len(mine)
            assert all(tree.radius[c] <= max(tree.radius[at], 1e-7) for c in children)
        else:
            assert len(mine) == 1


def test_meeting_counts_all_pairs():
    rng = np.random.default_rng(3)
    points = np.array([N.unit(v) for v in planted(rng)])
    cut = len(points) // 2
    weights = rng.integers(1, 5, len(points))
    ids = np.arange(len(points))
    one, two = (N.Tree.of(ids[s], weights[s], points[s]) for s in (slice(0, cut), slice(cut, None)))
    found = {i: n for i, n, _ in N.Meeting(one, two, 0.95).rows()}
    near = points[:cut] @ points[cut:].T >= 0.95
    wanted = {i: int(weights[cut:][near[i]].sum()) for i in range(cut) if near[i].any()}
    wanted |= {cut + j: int(weights[:cut][near[:, j]].sum()) for j in range(len(points) - cut) if near[:, j].any()}
    assert found == wanted


def test_empty_table_and_other_columns(spark):
    assert N.link_near(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
    rows = [(1, [1.0, 0.0], 5, "x"), (2, [1.0, 0.1], 6, "y")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n int, key string")
    assert sorted(tuple(r) for r in N.link_near(df).collect()) == [(1, 1, 1, True), (2, 1, 1, False)]


@pytest.mark.parametrize("candidates", [16, 0])
def test_near_rows_counts_all_pairs(candidates, monkeypatch):
    """By cosines of what the sketches leave, and by trees of it."""
    monkeypatch.setattr(N, "CANDIDATES", candidates)
    monkeypatch.setattr(N, "TILE", (64, 96))
    rng = np.random.default_rng(4)
    points = np.array([N.unit(v) for v in planted(rng, 32)])
    points = points[rng.permutation(len(points))]
    weights, cut = rng.integers(1, 5, len(points)), len(points) // 2
    axes = N.axes_of(points[:64], 0.95)
    assert axes.shape[1] < 32
    blocks = [N.Block(weights[s], points[s], N.sketch(points[s], axes), None, 2.0) for s in (slice(0, cut), slice(cut, None))]
    for pair in ((blocks[0], blocks[1]), (blocks[1], None)):
        ones, twos = pair[0], pair[1] or pair[0]
        near = ones.points @ twos.points.T >= 0.95
        if pair[1] is None:
            np.fill_diagonal(near, False)
        wanted = near @ twos.weights
        if pair[1] is not None:
            wanted = np.concatenate([wanted, near.T @ ones.weights])
        at, n, joined = N.near_rows(*pair, 0.95, N.bound(0.95, axes))
        assert dict(zip(at.tolist(), n.tolist())) == {i: int(w) for i, w in enumerate(wanted) if w}
        root = dict(zip(at.tolist(), joined.tolist()))
        shift = 0 if pair[1] is None else len(ones.weights)
        assert all(root[x] == root[y + shift] for x, y in zip(*np.nonzero(near)))


def test_sketches_bound_cosines():
    rng = np.random.default_rng(5)
    points = np.array([N.unit(v) for v in planted(rng, 48)])
    axes = np.linalg.qr(rng.normal(size=(48, 7)))[0]
    held = N.sketch(points, axes)
    cosines = points @ points.T
    assert (held @ held.T >= cosines - (0.95 - N.bound(0.95, axes))).all()


def test_equal_vectors_of_single_and_double_numbers(spark):
    """One class, whatever its multiple; ids may be missing in part or altogether."""
    rows = [(i if i % 3 else None, [0.1 * 2 ** (i % 4), 0.3 * 2 ** (i % 4)]) for i in range(12)] + [(None, [1.0, -5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    single = df.select("vec_id", df["embedding"].cast("array<float>").alias("embedding"))
    wanted = [(i, 11, 1 if i else None, i == 1) for i, _ in rows[:-1]] + [(None, 0, None, False)]
    for table in (df, single):
        assert sorted(map(tuple, N.link_near(table).collect()), key=repr) == sorted(wanted, key=repr)


@contextmanager
def most_shuffled(spark):
    """The most bytes that files of shuffles had at a time in a block, in a list."""
    folders = [f.toString() for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    most, over = [0], threading.Event()

    def now():
        total = 0
        for path in (os.path.join(at, name) for top in folders for at, _, names in os.walk(top) for name in names):
            with suppress(OSError):  # a file may go meanwhile
                total += os.path.getsize(path) if os.path.basename(path).startswith("shuffle") else 0
        return total

    def watch():
        while not over.wait(0.03):
            most[0] = max(most[0], now() - before)

    before = now()
    thread = threading.Thread(target=watch)
    thread.start()
    try:
        yield most
    finally:
        over.set()
        thread.join()


def test_pairs_of_blocks_take_no_disk(spark, monkeypatch):
    """Rows without structure are in blocks that all meet; what is moved follows the rows, not the pairs."""
    monkeypatch.setattr(N, "BLOCK", 20)
    rng = np.random.default_rng(6)
    vectors = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(1000, 64)))]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    with most_shuffled(spark) as most:
        assert N.link_near(df).filter("n_links = 0 and kept").count() == 1000
    # Vectors are 0.5 MB; all pairs of their 50 blocks hold 50 times that.
    assert 0 < most[0] < 4e6
