import random
import re

import numpy as np
import pytest

from tablesync.llm import jaccard as J
from tablesync.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def joined(parents, x):
    while parents[x] != x:
        x = parents[x]
    return x


def brute(rows):
    sets = []
    for i, text in rows:
        words = WORD.findall((text or "").translate(LOWER))
        sets.append((i, {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())))
    parents = {i: i for i, _ in sets if i is not None}
    for a, one in sets:
        for b, two in sets:
            both = len(one & two)
            if None not in (a, b) and both and 100 * both >= 75 * (len(one) + len(two) - both):
                x, y = joined(parents, a), joined(parents, b)
                parents[max(x, y)] = min(x, y)
    return sorted((str(i), len(s), str(None if i is None else joined(parents, i))) for i, s in sets)


@pytest.mark.parametrize("joined, block, common", [(24, 1024, 4), (1, 7, 2), (2, 3, 10**9)])
def test_components_are_those_of_brute_force(spark, docs_of, monkeypatch, joined, block, common):
    """Also with hardly any words joined, so that nearly all links are left to the first shingles, and in small blocks."""
    for name, value in (("JOINED", joined), ("BLOCK", block), ("COMMON", common)):
        monkeypatch.setattr(J, name, value)
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(500)]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    rows, common = [], some(40)
    for group in range(14):
        base = some(rng.choice([3, 5, 6, 12, 30, 90, 300]))
        for _ in range(rng.choice([1, 2, 5, 40])):
            words = list(base)
            for _ in range(rng.randrange(1 + len(words) // 25)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((len(rows) * 7 % 1009, " ".join(words)))
            base = words if rng.random() < 0.5 else base
    # Sets that have a passage in common, and a family whose members are at 0.6 to 0.8.
    rows += [(2000 + i, " ".join(common + some(rng.choice([5, 12, 30])))) for i in range(60)]
    base = some(200)
    for i in range(40):
        words = list(base)
        for _ in range(rng.randrange(3, 7)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((2500 + i, " ".join(words)))
    rows += [(3000, None), (3001, ""), (3002, "One two"), (3003, "one TWO"), (3004, "two one"), (None, "one two"), (3002, "One two"), (3006, rows[3][1]), (3006, rows[60][1]), (3007, rows[-1][1])]
    rows.append((3005, " ".join(some(30_000))))
    found = J.link_similar(docs_of(rows).withColumnRenamed("lang", "component_id")).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == brute(rows)
    if joined == 24:
        assert J.link_similar(docs_of(rows).limit(0)).count() == 0


def bits_apart(*sketches):
    one, two = (np.frombuffer(s, np.uint64) for s in sketches)
    size = min(len(one), len(two))
    return int(np.bitwise_count(J.folded(one, size) ^ J.folded(two, size)).sum())


def at_the_limit(rng, size):
    """Two sets of a similarity of 0.75 or just above."""
    both = rng.integers(1, 1 << 63, size, dtype=np.uint64)
    more = rng.integers(1, 1 << 63, size // 3, dtype=np.uint64)
    half = rng.integers(0, len(more) + 1)
    return [np.unique(np.concatenate([both, part])) for part in (more[:half], more[half:])]


@pytest.mark.parametrize("size", [1, 3, 4, 8, 20, 64, 300, 2000])
def test_sets_at_the_limit_meet(size):
    rng = np.random.default_rng(size)
    for _ in range(30):
        one, two = sorted(at_the_limit(rng, size), key=len)
        if size > 20:
            assert len(np.intersect1d(J.sketch_keys(one), J.sketch_keys(two)))
        common = np.sort(rng.choice(np.union1d(one, two), size // 3, replace=False))
        (first, own), (other, _) = (J.first_shingles(x, common, 75) for x in (one, two))
        assert len(np.intersect1d(first[:own], other))
        for bits in (J.COARSE, J.FINE):
            apart = bits_apart(J.bit_sketch(one, bits), J.bit_sketch(two, bits))
            assert apart <= len(np.setxor1d(one, two)) <= J.most_apart(len(one), len(two), 75)


def test_bits_turn_away_what_is_not_similar():
    rng = np.random.default_rng(1)
    both, more = (rng.integers(1, 1 << 63, n, dtype=np.uint64) for n in (700, 300))
    one, two = np.concatenate([both, more[:150]]), np.concatenate([both, more[150:]])
    assert bits_apart(J.bit_sketch(one, J.FINE), J.bit_sketch(two, J.FINE)) > J.most_apart(850, 850, 75)


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i + 1, i) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (500, 501), (501, 500)]
    found = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    want = {i: 0 for i in range(61)} | {100 + i: 100 for i in range(50)} | {500: 500, 501: 500}
    assert found == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_group_of_near_copies_takes_few_pairs(spark, docs_of, monkeypatch):
    """Without any pairs by words, all is linked by each set's nearest one, not by all pairs of the group."""
    monkeypatch.setattr(J, "SEVERAL", 10**9)
    counted, pairs = [], J._pairs

    def counting(*args):
        found = pairs(*args)
        counted.append(found.count())
        return found

    monkeypatch.setattr(J, "_pairs", counting)
    rng = random.Random(6)
    base = [f"w{rng.randrange(900)}" for _ in range(150)]
    rows = []
    for i in range(80):
        words = list(base)
        for at in rng.sample(range(5, 145), 2):
            words[at] = f"x{i}y{at}"
        rows.append((i, " ".join(words)))
    found = J.link_similar(docs_of(rows)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == brute(rows)
    assert {r.component_id for r in found} == {0} and sum(counted) < len(rows)


def sharing(rng, group, passages=3):
    """Texts that have a passage in common and are of any size, some with near copies."""
    rows = []
    for _ in range(passages):
        passage = [f"p{rng.randrange(10**6)}" for _ in range(30)]
        for _ in range(group):
            words = passage + [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([4, 10, 25, 60, 90, 200]))]
            for _ in range(rng.choice([1, 1, 3])):
                rows.append((len(rows), " ".join(words)))
                words = [*words[:-1], f"x{rng.randrange(10**6)}"]
    return rows


def test_a_common_passage_is_one_group_of_sets(spark, docs_of, monkeypatch):
    """All shingles of a passage lead to the same sets, of which only those of like size may be similar."""
    met, partners = [], J._with_partners

    def counting(rows, *args):
        met.append(rows.count())
        return partners(rows, *args)

    monkeypatch.setattr(J, "SEVERAL", 10**9)
    monkeypatch.setattr(J, "_with_partners", counting)
    rows = sharing(random.Random(8), 20)
    found = J.link_similar(docs_of(rows)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == brute(rows)
    assert len({r.component_id for r in found}) < len(rows)
    assert met[0] < 4 * len(rows)


@pytest.mark.parametrize("longest, common", [(10_000, 10**9), (2, 4)])
def test_runs_in_pieces_and_ids_of_several_texts(spark, docs_of, monkeypatch, longest, common):
    """Two texts of an id may lead to the same ids by different shingles; nothing is left out for that."""
    for name, value in (("LONG", longest), ("COMMON", common), ("SEVERAL", 10**9)):
        monkeypatch.setattr(J, name, value)
    rng = random.Random(9)
    rows = sharing(rng, 6)
    rows += [(i, rows[-1 - i][1]) for i in range(12)] + [(200 + i, rows[i][1]) for i in range(6)]
    for i in range(300, 340, 2):
        words = [f"z{rng.randrange(10**6)}" for _ in range(40)]
        near = [*words[:-1], "end"]
        rows += [(i, " ".join(words)), (i + 1, " ".join(near))]
        # The id's other text shares shingles with the same one, but is not similar to it.
        rows.append((i, " ".join(words[:14] + [f"q{rng.randrange(10**6)}" for _ in range(26)])))
    found = J.link_similar(docs_of(rows)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == brute(rows)


def test_runs_are_cut_by_size_and_stand_for_equal_ones(spark, monkeypatch):
    place = lambda n, mark, late=0, twice=0: n * 8 + twice * 4 + late * 2 + mark
    rows = [(7, 1, place(100, 1)), (7, 2, place(130, 0)), (7, 3, place(300, 1))]  # 3 is too large for both
    rows += [(9, i, p) for _, i, p in rows[:2]]  # as 7, and comes after it
    rows += [(-5, i, p) for _, i, p in rows[:2]]  # so does this one, unsigned
    rows += [(2, i, p + 2) for _, i, p in rows[:2]]  # common ones come last
    rows += [(11, 1, place(100, 0)), (11, 2, place(130, 1))]  # other marks
    rows += [(12, 1, place(100, 0)), (12, 2, place(130, 0))]  # no shingle counts
    rows += [(k, i, place(50, 1, twice=i == 4)) for k in (20, 21) for i in (4, 5)]  # an id of several rows
    keys = spark.createDataFrame(rows, "key long, id long, place long")
    want = [(7, 1, True), (7, 2, False), (11, 1, False), (11, 2, True)]
    want += [(k, i, True) for k in (20, 21) for i in (4, 5)]
    assert sorted(map(tuple, J._runs(keys, 75).collect())) == sorted(want)
    monkeypatch.setattr(J, "LONG", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        rows = [(k, i, place(100 + i, 1)) for k in (1, 2, 3) for i in range(3 + 20 * (k > 1))]
        keys = spark.createDataFrame(rows, "key long, id long, place long")
        found = sorted(map(tuple, J._runs(keys, 75).collect()))
        assert found == sorted((k, i, True) for k, i, _ in rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
