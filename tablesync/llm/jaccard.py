"""Similarity join of shingle sets by parity sketches.

A sketch has buckets; each shingle is XORed into one of them by its hash. Two
sets' sketches differ in no more buckets than the sets have shingles that only
one of them has, and at a similarity of 0.75 that is a seventh of both sizes
together. Sketches are used twice:

* *Words.* Buckets of 64 bits are joined on equality. Sizes fall into bands of
  ratio 4/3, so the larger of two similar sets is in the band of the smaller or
  the next; each set has words for its own band and for the one below. With one
  word more than the bound, a word would have to be the same in both sets. Only
  some are joined (``JOINED``; at 0.75 each is the same, and not empty, with a
  chance of a third or more): they find nearly all links at little cost, and
  what they find is settled with the first set of each word.
* *Bits.* The parity of each bucket is one bit. Sets whose bits differ in more
  places than the bound are not similar. This is exact; with bits enough, few
  pairs but similar ones are left to be compared. Of equal sets that one task
  reads, one takes part.

What the words may have missed is found exactly. Shingles have one order, common
ones last (by a bounded sample, which bears on the cost and not on the result),
and similar sets share one among the first quarter of each. Sets that meet there
and are of different components are held against each other by size and bits: by
few bits first, to leave out sets without any similar one. Of shingles that the
same sets of like size share, the first in order stands for all, before anything
else is joined to their rows. Each set is compared
with the nearest one by these bits, so a large group of similar sets becomes one
component by as many pairs as it has sets. All pairs of what is then still in
different components are held against each other by more bits. A pair
goes on at the first shingle both have, and sets are compared whole before they
link. Shingles that many sets share are dealt out as pairs of blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import discard, map_rows, mix64, pa_schema, written
from tablesync.llm.components import components
from tablesync.llm.substrings import byte_chunks
from tablesync.llm.words import run_hashes, word_hashes

SHINGLE = 5
#: Shingles of the larger set to a word, and words of a sketch that are joined.
FILL, JOINED = 3, 24
#: Words that a set must share with the first set of a word to be compared before all others.
SEVERAL = 3
#: Least bits for a shingle of the two bit sketches.
COARSE, FINE = 1, 8
#: Documents in the sample of common shingles, how many of them must have one, and how many shingles are kept.
SAMPLE, COMMON, KEPT_COMMON = 8192, 4, 200_000
#: First shingles that a set carries along, to tell where a pair meets first.
FIRST = 4
#: Sets of a shingle that are held against each other in one group.
BLOCK = 1024
#: Sets of like size at a shingle that are held in one row; of more, no equal groups are looked for.
LONG = 10_000
#: Digests a task remembers, to tell equal sets; beyond it all are forgotten, and equal sets only cost more.
KEPT_DIGESTS = 500_000


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """The set of a text's shingles, as sorted hashes; of a short text, one of all its words."""
    if not len(words):
        return np.zeros(0, np.uint64)
    if len(words) < size:
        return run_hashes(words, len(words), 1000 + len(words))
    return np.unique(run_hashes(words, size))


@lru_cache(maxsize=1)
def bands(limit: int = 1 << 40) -> np.ndarray:
    """Least size of each band."""
    found = [1]
    while found[-1] < limit:
        found.append(found[-1] * 4 // 3 + 1)
    return np.array(found, np.int64)


def sketch_keys(hashes: np.ndarray) -> np.ndarray:
    """A 64-bit key for each joined, not empty word of a set's sketches for its two bands."""
    own = int(np.searchsorted(bands(), len(hashes), side="right")) - 1
    found = []
    for band in (own - 1, own):
        if band < 0:
            continue
        largest = int(bands()[band + 1]) - 1
        if largest < 3:
            continue  # sets of this size are equal or not similar
        words = max(2, largest // FILL + 1)
        repeats = -(-JOINED // words)
        salts = mix64(np.arange(1, repeats + 1, dtype=np.uint64) + np.uint64(1_000_003 * (2 * band + 2)))
        mixed = mix64(hashes[None, :] ^ salts[:, None])
        word = ((mixed >> np.uint64(32)) * np.uint64(words) >> np.uint64(32)).astype(np.int64)
        word += np.arange(repeats)[:, None] * words
        mixed, word = mixed.ravel(), word.ravel()
        if repeats == 1:
            mixed, word = mixed[word < JOINED], word[word < JOINED]
        if not len(word):
            continue
        order = np.argsort(word)
        word, mixed = word[order], mixed[order]
        begins = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        parity = np.bitwise_xor.reduceat(mix64(mixed), begins)
        place = word[begins].astype(np.uint64) + np.uint64((2 * band + 2) << 20)
        found.append(mix64(parity ^ mix64(place)))
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def bit_sketch(hashes: np.ndarray, bits: int) -> bytes:
    """Parities of a set's buckets: a power of two of them, ``bits`` or more for a shingle."""
    size = 1 << max(6, (bits * len(hashes) - 1).bit_length())
    at = (mix64(hashes) & np.uint64(size - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=size).astype(np.uint8) & 1, bitorder="little").tobytes()


def folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """Sketches, as rows of 64-bit words, of ``size`` words: buckets that fall together are added."""
    while sketch.shape[-1] > size:
        half = sketch.shape[-1] // 2
        sketch = sketch[..., :half] ^ sketch[..., half:]
    return sketch


def most_apart(n, m, percent: int):
    """How many shingles may be in only one of two similar sets of these sizes."""
    return (100 - percent) * (n + m) // (100 + percent)


def are_common(hashes: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Which shingles are among the common ones, which come last."""
    if not len(common):
        return np.zeros(len(hashes), bool)
    return common[np.minimum(np.searchsorted(common, hashes), len(common) - 1)] == hashes


def first_shingles(hashes: np.ndarray, common: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The first shingles of a set in order, of which similar sets share one.

    Also how many of them are enough if the other set is not smaller.
    """
    n, late = len(hashes), are_common(hashes, common)
    ordered = np.concatenate([hashes[~late], hashes[late]])
    return ordered[: n + 1 - -(-percent * n // 100)], n + 1 - -(-2 * percent * n // (100 + percent))


def _lowered(batches: Iterator[list]) -> Iterator[tuple]:
    """Ids and word hashes of texts in lower case."""
    for ids, texts in byte_chunks(batches):
        yield from zip(ids, word_hashes([(t or b"").lower() for t in texts]))


def common_shingles(source: DataFrame) -> np.ndarray:
    """Shingles that many documents of a sample have; only the order of shingles depends on them."""
    rate = min(1.0, SAMPLE / max(source.count(), 1))
    some = source.filter(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(1_000_000)) < int(rate * 1_000_000))

    def run(batches):
        for _, words in _lowered([c.to_pylist() for c in b.columns] for b in batches if b.num_rows):
            yield pa.record_batch([pa.array(shingles(words).view(np.int64))], names=["shingle"])

    counted = some.mapInArrow(run, "shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    found = counted.filter(F.col("n") >= COMMON).orderBy(F.desc("n"), "shingle").limit(KEPT_COMMON).collect()
    return np.sort(np.array([r["shingle"] for r in found], np.int64).view(np.uint64))


def _sets(docs: DataFrame, common: np.ndarray, percent: int) -> DataFrame:
    """``doc_id, n, digest, keys, firsts, own, early, coarse, fine`` of each text.

    ``firsts`` are the first shingles; ``own`` of them count towards sets that
    are not smaller, and ``early`` of them are not common. Keys, firsts and sketches are null in copies of an earlier row of the same task.
    """

    def rows(batches):
        seen: set[bytes] = set()
        for key, words in _lowered(batches):
            held = shingles(words)
            if not len(held):
                yield key, 0, None, None, None, 0, 0, None, None
                continue
            digest = hashlib.blake2b(held.tobytes(), digest_size=16).digest()
            if key is None or digest in seen:
                yield key, len(held), digest, None, None, 0, 0, None, None
                continue
            if len(seen) >= KEPT_DIGESTS:
                seen.clear()
            seen.add(digest)
            firsts, own = first_shingles(held, common, percent)
            early = int(np.count_nonzero(~are_common(firsts, common)))
            sketches = [bit_sketch(held, bits) for bits in (COARSE, FINE)]
            yield key, len(held), digest, sketch_keys(held).view(np.int64), firsts.view(np.int64), own, early, *sketches

    schema = (
        "doc_id long, n long, digest binary, keys array<long>, firsts array<long>, own int, early int, "
        "coarse binary, fine binary"
    )
    return map_rows(docs, schema, rows, 512)


def _shared(keys: DataFrame) -> DataFrame:
    """Rows of ``keys (key, id)`` whose key has two or more ids, and the first id of the key.

    Sorted rows are streamed; only one row is held over between batches.
    """
    names = "key long, id long, first long"
    schema = pa_schema(keys.sparkSession, names)

    def batch(key, ids, first):
        return pa.record_batch([pa.array(c) for c in (key, ids, first)], schema=schema)

    def run(batches):
        held = None  # the last row, the key's first id, and whether the row shares its key with the one before
        for columns in batches:
            key, ids = (c.to_numpy(zero_copy_only=False) for c in columns.columns)
            if not len(key):
                continue
            begins = np.concatenate([[True], key[1:] != key[:-1]])
            if held is not None and held[0] == key[0]:
                begins[0] = False
            origin = np.maximum.accumulate(np.where(begins, np.arange(len(key)), -1))
            first = np.where(origin >= 0, ids[np.maximum(origin, 0)], held[2] if held is not None else 0)
            shares = ~begins
            shares[:-1] |= ~begins[1:]
            if held is not None and (held[3] or not begins[0]):
                yield batch(*[[v] for v in held[:3]])
            out = shares.copy()
            out[-1] = False
            if out.any():
                yield batch(key[out], ids[out], first[out])
            held = (int(key[-1]), int(ids[-1]), int(first[-1]), bool(~begins[-1]))
        if held is not None and held[3]:
            yield batch(*[[v] for v in held[:3]])

    return keys.select("key", "id").repartition("key").sortWithinPartitions("key", "id").mapInArrow(run, names)


def _placed(sets: DataFrame, several: DataFrame) -> DataFrame:
    """``key, id, place`` of all first shingles: in ``place``, the size of the set above three bits.

    They tell whether the id has more than one row, whether the shingle is common, and whether it counts
    towards sets that are not smaller.
    """
    marked = sets.join(several, F.col("id") == F.col("again"), "left").withColumn("twice", F.col("again").isNotNull())
    keys = marked.select(F.posexplode("firsts").alias("at", "key"), "id", "n", "twice", "early", "own")
    bits = [F.col("twice"), F.col("at") >= F.col("early"), F.col("at") < F.col("own")]
    place = F.col("n") * 8 + sum(b.cast("long") * v for b, v in zip(bits, (4, 2, 1)))
    return keys.select("key", "id", place.alias("place"))


def _runs(keys: DataFrame, percent: int) -> DataFrame:
    """Rows ``key, id, mark`` of the sets that may meet a similar one at a key of ``keys (key, id, place)``.

    A key's sets by size are cut where the next one is too large to be similar to any before. A run needs two
    sets, and a shingle that counts. Of keys with the same run, the first in the order of shingles stands for
    all: all its sets have it, so a pair's first shingle is never left out for another one. Runs with an id of
    several rows are left as they are, since its texts differ; so are runs of more than ``LONG``, in pieces.
    """
    names = "one long, two long, late boolean, turned long, ids array<long>, marks array<boolean>"
    schema = pa_schema(keys.sparkSession, names)

    def batch(key, ids, place, begins, piece):
        counts = np.diff(np.concatenate([begins, [len(key)]]))
        mark, twice = (place & 1).astype(bool), np.logical_or.reduceat((place & 4) > 0, begins)
        some = (counts > 1) & np.logical_or.reduceat(mark, begins)
        mixed = mix64((ids.view(np.uint64) << np.uint64(1)) ^ mix64((place & 1).view(np.uint64) + np.uint64(7)))
        mixed ^= mix64(ids.view(np.uint64))
        one, two = (np.add.reduceat(x, begins).view(np.int64) for x in (mix64(mixed), mix64(~mixed)))
        first, late = key[begins], (place[begins] & 2) > 0
        # What is not to be put together goes by its own key, size, and piece of a run.
        one, two = np.where(twice, first, one), np.where(twice, place[begins], two)
        if piece:
            some[0], one[0], two[0] = True, first[0], -piece
        kept = np.repeat(some, counts)
        ends = pa.array(np.concatenate([[0], np.cumsum(counts[some])]), pa.int32())
        lists = [
            pa.ListArray.from_arrays(ends, pa.array(values[kept]), type=schema.field(name).type)
            for name, values in (("ids", ids), ("marks", mark))
        ]
        turned = first ^ np.int64(-(1 << 63))
        columns = [pa.array(c[some]) for c in (one, two, late, turned)]
        return pa.RecordBatch.from_arrays(columns + lists, schema=schema)

    def run(batches):
        held, piece = None, 0  # rows of the last run, and how many pieces of it are gone
        for columns in batches:
            if not columns.num_rows:
                continue
            new = [c.to_numpy(zero_copy_only=False) for c in columns.columns]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            key, n = held[0], held[2] >> 3
            apart = (key[1:] != key[:-1]) | (100 * n[:-1] < percent * n[1:])
            begins = np.concatenate([[0], np.flatnonzero(apart) + 1])
            if last := int(begins[-1]):
                yield batch(*[x[:last] for x in held], begins[:-1], piece and piece + 1)
                held, piece = [x[last:] for x in held], 0
            if len(held[0]) > LONG:
                piece += 1
                yield batch(*[x[:-1] for x in held], np.zeros(1, np.int64), piece)
                held = [x[-1:] for x in held]
        if held is not None:
            yield batch(*held, np.zeros(1, np.int64), piece and piece + 1)

    sorted_keys = keys.repartition("key").sortWithinPartitions("key", "place", "id")
    runs = sorted_keys.mapInArrow(run, names).groupBy("one", "two")
    first = runs.agg(F.min(F.struct("late", "turned", "ids", "marks")).alias("first")).select("first.*")
    key = F.col("turned").bitwiseXOR(F.lit(-(1 << 63))).alias("key")
    met = first.select(key, F.explode(F.arrays_zip("ids", "marks")).alias("met"))
    return met.select("key", F.col("met.ids").alias("id"), F.col("met.marks").alias("mark"))


def _best(shared: DataFrame) -> DataFrame:
    """Each id with that first id of its keys with which it shares most of them."""
    counted = shared.filter("id <> first").groupBy("id", "first").agg(F.count(F.lit(1)).alias("n"))
    counted = counted.filter(F.col("n") >= SEVERAL)
    best = counted.groupBy("id").agg(F.max(F.struct("n", (-F.col("first")).alias("less"))).alias("best"))
    return best.select((-F.col("best.less")).alias("a"), F.col("id").alias("b"))


class _Run:
    """Sets that share a shingle, met one after another, smaller ones first."""

    def __init__(self, percent: int):
        self.percent = percent
        self.rows: list[tuple] = []
        self.numbers = np.zeros((3, 64), np.int64)  # sizes, components, blocks
        # By the length of sketches: the place of the first one, how many there are, and the sketches.
        self.held: dict[int, list] = {}

    def add(self, row: tuple, across: bool) -> list[tuple[int, int]]:
        """Earlier sets that may be similar, and are of another component: places that differ, and place.

        ``across`` leaves out those of the same block.
        """
        _, n, component, block, own, bits, _ = row
        sketch = np.frombuffer(bits, np.uint64)
        sizes, components_, blocks = self.numbers
        low = int(np.searchsorted(sizes[: len(self.rows)], -(-self.percent * n // 100)))
        found: list[tuple[int, int]] = []
        for size, (begins, count, sketches) in self.held.items():
            places = np.arange(max(low, begins), begins + count)
            near = components_[places] != component
            if across:
                near &= blocks[places] != block
            places = places[near]
            if not len(places):
                continue
            least = min(size, len(sketch))
            apart = folded(sketches[places - begins], least) ^ folded(sketch, least)
            apart = np.bitwise_count(apart).sum(axis=1)
            near = apart <= most_apart(n, sizes[places], self.percent)
            # The smaller of two similar sets has the shingle among those that count for it.
            both = zip(apart[near].tolist(), places[near].tolist())
            found += [x for x in both if self.rows[x[1]][4] or (own and sizes[x[1]] == n)]
        self._keep(row, sketch)
        return found

    def picked(self, key: int, places: dict[int, tuple]) -> Iterator[tuple]:
        """Rows at some places, without their sketches, and what is held of each place."""
        for place in sorted(places):
            one, _, component, _, own, _, _ = self.rows[place]
            yield key, one, own, component, *places[place]

    def _keep(self, row: tuple, sketch: np.ndarray) -> None:
        at = len(self.rows)
        if at == self.numbers.shape[1]:
            self.numbers = np.concatenate([self.numbers, self.numbers], axis=1)
        self.numbers[:, at] = row[1:4]
        self.rows.append(row)
        held = self.held.setdefault(len(sketch), [at, 0, np.zeros((16, len(sketch)), np.uint64)])
        if held[1] == len(held[2]):
            held[2] = np.concatenate([held[2], held[2]])
        held[2][held[1]] = sketch
        held[1] += 1


def _met_before(key: int, one: list[int], two: list[int]) -> bool:
    """Whether two sets are known to share a shingle that comes before ``key``."""
    before = one[: one.index(key)] if key in one else one
    return any(x in two for x in before)


def _groups(rows: DataFrame, carried: DataFrame) -> DataFrame:
    """Rows of ``key, id, own, component, size`` dealt out, with ``its, n, bits, firsts`` of their sets, and sorted.

    A group is the sets of two blocks of a key; a key of small ``size`` (its number of rows) has one block.
    Each set meets every block of its key.
    """
    dealt = rows.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = [F.col("key"), F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")]
    met = dealt.select(*group, "id", "component", "block", "own").join(carried, F.col("id") == F.col("its"))
    met = met.select("key", "low", "high", "id", "n", "component", "block", "own", "bits", "firsts")
    return met.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "n", "id")


def _with_partners(rows: DataFrame, carried: DataFrame, percent: int) -> DataFrame:
    """``key, id, own, component, best`` of the rows that some other set of their key may be similar to.

    ``best (apart, other)`` is the earlier one of these sets whose bits are nearest, if there is one.
    """

    def run(batches):
        met, now, near = None, None, {}
        for columns in batches:
            for key, low, high, *row in zip(*columns):
                if (key, low, high) != now:
                    if met is not None:
                        yield from met.picked(now[0], near)
                    now, met, near = (key, low, high), _Run(percent), {}
                if found := met.add(tuple(row), low < high):
                    for _, place in found:
                        near.setdefault(place, (None, None))
                    apart, place = min(found)
                    near[len(met.rows) - 1] = apart, met.rows[place][0]
        if met is not None:
            yield from met.picked(now[0], near)

    schema = "key long, id long, own boolean, component long, apart long, other long"
    found = map_rows(_groups(rows, carried), schema, run, 65_536)
    best = F.min(F.when(F.col("other").isNotNull(), F.struct("apart", "other"))).alias("best")
    return found.groupBy("key", "id", "own", "component").agg(best)


def _nearest(rows: DataFrame) -> DataFrame:
    """Each id with the one other set that is nearest to it at any of its keys: no more pairs than ids."""
    best = rows.groupBy("id").agg(F.min("best").alias("best")).filter("best is not null")
    return best.select(F.col("best.other").alias("a"), F.col("id").alias("b"))


def _pairs(rows: DataFrame, carried: DataFrame, percent: int) -> DataFrame:
    """Pairs of ids that may be similar, each at the first shingle both have."""

    def run(batches):
        met, now = None, None
        for columns in batches:
            for key, low, high, *row in zip(*columns):
                if (key, low, high) != now:
                    now, met = (key, low, high), _Run(percent)
                for _, place in met.add(tuple(row), low < high):
                    other = met.rows[place]
                    if not _met_before(key, row[6], other[6]):
                        yield (other[0], row[0]) if other[0] < row[0] else (row[0], other[0])

    return map_rows(_groups(rows, carried), "a long, b long", run, 65_536).distinct()


class _Join:
    """The steps of one join, over tables in the shared folder."""

    def __init__(self, source: DataFrame, links: DataFrame, percent: int):
        self.source, self.percent = source, percent
        self.links = links
        self.labels: DataFrame | None = None

    def verify(self, pairs: DataFrame) -> None:
        """Compare pairs exactly, and let what links be one component."""
        pairs = written(pairs.select("a", "b"), "pairs")
        wanted = pairs.select(F.col("a").alias("its")).union(pairs.select("b")).distinct()
        percent = self.percent

        def sets(batches):
            for key, words in _lowered(batches):
                yield key, shingles(words).tobytes()

        held = self.source.join(wanted, F.col("doc_id") == F.col("its")).select("doc_id", "text")
        held = written(map_rows(held, "id long, hashes binary", sets, 512), "sets")
        one = held.select(F.col("id").alias("a_id"), F.col("hashes").alias("a_set"))
        two = held.select(F.col("id").alias("b_id"), F.col("hashes").alias("b_set"))
        met = pairs.join(one, F.col("a") == F.col("a_id")).join(two, F.col("b") == F.col("b_id"))

        def linked(batches):
            for a, b, one, two in batches:
                for i, j, x, y in zip(a, b, one, two):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if 100 * both >= percent * (len(x) + len(y) - both):
                        yield i, j

        found = map_rows(met.select("a", "b", "a_set", "b_set"), "a long, b long", linked)
        before = self.links
        self.links = written(found.union(before), "found")
        discard(pairs, held, before)
        self.labels = components(self.links)

    def labelled(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the component of their ``id``."""
        labels = self.labels.select(F.col("id").alias("labelled"), "component")
        joined = rows.join(labels, F.col("id") == F.col("labelled"), "left").drop("labelled")
        return joined.withColumn("component", F.coalesce("component", "id"))

    def open_rows(self, shared: DataFrame) -> DataFrame:
        """Rows of keys whose ids are still in several components, with the ``size`` of their key in rows."""
        rows = written(self.labelled(shared.select("key", "id", "mark")), "labelled")
        keys = rows.groupBy("key").agg(
            F.min("component").alias("least"),
            F.max("component").alias("most"),
            F.max("mark").alias("any"),
            F.count(F.lit(1)).alias("size"),
        )
        keys = keys.filter("least < most and any").select(F.col("key").alias("open"), "size")
        left = written(rows.join(keys, F.col("key") == F.col("open")).drop("open"), "open")
        discard(rows)
        return left


def link_similar(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Components of documents whose shingle sets are similar: ``doc_id, n_shingles, component_id``.

    Shingles are five words (parted by ASCII white space, A-Z in lower case).
    Documents link when 100 x shared >= ``percent`` x united; ``percent`` must be
    75 or more. A row per row of ``docs``; rows of the same id are one node of
    the graph and link by either text. A text without words (or null) is empty
    and links with nothing; a null id is no node and has a null component. Other
    columns are not read.
    """
    if percent < 75:
        raise ValueError("sketches are made for a similarity of 0.75 or more")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    ids = written(_sets(source, common_shingles(source), percent), "shingle-sets")
    holds = F.col("fine").isNotNull().alias("holds")
    whole = ids.filter("doc_id is not null and digest is not null").select("doc_id", "digest", holds)
    # Of equal sets that hold their sketches, the first stands for all.
    firsts = whole.groupBy(F.col("digest").alias("same")).agg(
        F.min(F.when(F.col("holds"), F.col("doc_id"))).alias("first"), F.count(F.lit(1)).alias("n")
    )
    copies = whole.join(firsts.filter("n > 1"), F.col("digest") == F.col("same")).filter("doc_id <> first")
    copies = written(copies.select(F.col("first").alias("a"), F.col("doc_id").alias("b")), "copies")

    # A copy has nothing to add, unless its id has another text as well.
    several = whole.groupBy(F.col("doc_id").alias("again")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    several = written(several.select("again"), "several")
    known = written(copies.select("b").join(several, F.col("b") == F.col("again"), "left_anti").distinct(), "known")

    def without_known(rows: DataFrame) -> DataFrame:
        return written(rows.join(known, F.col("id") == F.col("b"), "left_anti"), "shared")

    join = _Join(source, copies, percent)
    sets = ids.filter("fine is not null").withColumnRenamed("doc_id", "id")
    shared = without_known(_shared(sets.select(F.explode("keys").alias("key"), "id")))
    join.verify(_best(shared))
    discard(shared)

    shared = without_known(_runs(_placed(sets, several), percent))
    left = join.open_rows(shared)
    its = F.col("id").alias("its")
    coarse = sets.select(its, "n", F.col("coarse").alias("bits"), F.lit(None).cast("array<long>").alias("firsts"))
    near = written(_with_partners(left.withColumnRenamed("mark", "own"), coarse, percent), "near")
    fine = sets.select(its, "n", F.col("fine").alias("bits"), F.slice("firsts", 1, FIRST).alias("firsts"))
    join.verify(_nearest(near))
    still = join.open_rows(near.withColumnRenamed("own", "mark"))
    # Written first, so that its size is known: sketches of all sets are shuffled only if many are wanted.
    wanted = written(still.select(F.col("id").alias("wanted")).distinct(), "wanted")
    fine = written(fine.join(wanted, F.col("its") == F.col("wanted"), "left_semi"), "fine")
    join.verify(_pairs(still.withColumnRenamed("mark", "own"), fine, percent))
    discard(shared, left, near, still, wanted, fine, several, known)

    labels = written(join.labels.select(F.col("id").alias("labelled"), "component"), "labels")
    discard(join.links)
    done = ids.select("doc_id", "n").join(labels, F.col("doc_id") == F.col("labelled"), "left")
    return done.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
