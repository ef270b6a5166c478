"""Cheapest repair of conversations, by block tables of normalised cost vectors.

A conversation's turns become symbols: the role's initial (``s``, ``u``, ``a``
or another), and whether the turn is cut short or has to go. Read from the end, the
cost to finish from each of four states (nothing said yet, system said, user
said, assistant said) is a vector of four; less its least entry, only a few
dozen vectors ever occur. So for every vector and every block of four symbols
the next vector and what it adds are a table (``tables``), and a run of turns is
processed a block at a time by lookup.

The audit is traced forwards. A block is expanded backward from the vector to
its right, and in each state the edit that comes first in the alphabet among the
cheapest is taken (D, I, K, R), which makes the whole audit the least one.

No conversation has to fit a task:

1. Damaged turns are sorted by range and numbered, so a long conversation lies
   in many partitions; 4,096 neighbouring numbers are a segment.
2. A segment's symbols become a map from each vector at its end to the one at its
   start. These maps, one short row a segment, are followed from each
   conversation's end.
3. With the vector at its end known, a segment is traced from each of the four
   states; the traces are followed from each conversation's start.
4. Turns and edits meet in order and are streamed in constant memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import map_rows, written

KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 1, 2, 5, 5
SLOTS = 20
#: Symbols of a block, and bits of a row number that are within its segment.
BLOCK, SEGMENT_BITS = 4, 12
START, SYSTEM, USER, ASSISTANT = range(4)
GONE, SYMBOLS = 8, 9
_FAR = 1 << 40
_BLANKS = " \t\n\x0b\x0c\r"
#: A letter for each initial (s, u, a, other) and fault (none, cut short, to go).
LETTERS = "abcdefghijkl"


def _after(state: int, initial: int) -> int | None:
    """The state after a role's initial, if it may follow."""
    if initial == 0:
        return SYSTEM if state == START else None
    if initial == 1:
        return USER if state != USER else None
    return ASSISTANT if initial == 2 and state == USER else None


def _needed(state: int) -> int:
    """The initial an inserted or changed turn gets."""
    return 2 if state == USER else 1


def _closed(costs: list[int]) -> list[int]:
    """Costs to finish when turns may also be inserted first."""
    for _ in range(2):
        costs = [min(c, INSERT + costs[_after(s, _needed(s))]) for s, c in enumerate(costs)]
    return costs


def _choices(costs: list[int], symbol: int, state: int) -> list[tuple[str, int, int]]:
    """Edits that use up a turn: name, state after it, and cost to finish with it."""
    found = [("D", state, DELETE + costs[state])]
    if symbol != GONE:
        initial, extra = symbol // 2, CUT_SHORT * (symbol % 2)
        kept, changed = _after(state, initial), _after(state, _needed(state))
        if kept is not None:
            found.append(("K", kept, KEEP + extra + costs[kept]))
        found.append(("R", changed, REROLE + extra + costs[changed]))
    return found


@dataclass(frozen=True)
class Tables:
    """What precedes each vector: by single symbols and by blocks, and the edits taken."""

    vectors: list[tuple[int, ...]]
    next_one: np.ndarray
    add_one: np.ndarray
    next_block: np.ndarray
    add_block: np.ndarray
    #: (vector to the right, symbol, state) to (edits, state after them, cost).
    edits: dict[tuple[int, int, int], tuple[str, int, int]]


@lru_cache(maxsize=1)
def tables() -> Tables:
    """The tables, made once a worker."""
    last = tuple(_closed([0, _FAR, _FAR, 0]))
    vectors, place = [last], {last: 0}
    next_one, add_one, edits = [], [], {}
    for at, costs in enumerate(vectors):  # grows while it is read
        row_next, row_add = [], []
        for symbol in range(SYMBOLS):
            found = _closed([min(c[2] for c in _choices(costs, symbol, s)) for s in range(4)])
            least = min(found)
            key = tuple(c - least for c in found)
            if key not in place:
                place[key] = len(vectors)
                vectors.append(key)
            row_next.append(place[key])
            row_add.append(least)
            for state in range(4):
                edits[at, symbol, state] = _least_edits(costs, found, symbol, state)
        next_one.append(row_next)
        add_one.append(row_add)
    one, add = np.array(next_one, np.int16), np.array(add_one, np.int32)
    blocks, added = np.arange(len(vectors), dtype=np.int16)[:, None], np.zeros((len(vectors), 1), np.int32)
    for _ in range(BLOCK):  # each symbol comes before those a block already has
        added = (added[:, :, None] + add[blocks]).transpose(0, 2, 1).reshape(len(vectors), -1)
        blocks = one[blocks].transpose(0, 2, 1).reshape(len(vectors), -1)
    return Tables(vectors, one, add, blocks, added, edits)


def _least_edits(right: tuple[int, ...], left: list[int], symbol: int, state: int) -> tuple[str, int, int]:
    """The first edits by name among the cheapest, up to the one that uses up the turn."""
    name, cost = "", 0
    while True:
        options = sorted(_choices(right, symbol, state))
        inserted = _after(state, _needed(state))
        options = [options[0], ("I", inserted, INSERT + left[inserted]), *options[1:]]
        edit, after, total = next(o for o in options if o[2] == left[state])
        cost += left[state] - (left[after] if edit == "I" else right[after])
        name += edit
        state = after
        if edit != "I":
            return name, state, cost


#: What is inserted after the last turn in each state.
TAIL = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}


def symbols(letters: str) -> np.ndarray:
    """Symbols of a segment's letters."""
    code = np.frombuffer(letters.encode(), np.uint8).astype(np.int64) - ord("a")
    return np.where(code % 3 == 2, GONE, code // 3 * 2 + code % 3)


def _codes(found: np.ndarray) -> tuple[list[int], list[int]]:
    """Codes of the whole blocks of a run of symbols, and the symbols left over at its end."""
    whole = len(found) // BLOCK * BLOCK
    weights = SYMBOLS ** np.arange(BLOCK - 1, -1, -1)
    return (found[:whole].reshape(-1, BLOCK) @ weights).tolist(), found[whole:].tolist()


def segment_map(letters: str) -> bytes:
    """For each vector at a segment's end, the one at its start."""
    known = tables()
    codes, rest = _codes(symbols(letters))
    now = np.arange(len(known.vectors))
    for symbol in reversed(rest):
        now = known.next_one[now, symbol]
    for code in reversed(codes):
        now = known.next_block[now, code]
    return now.astype("<i2").tobytes()


@lru_cache(maxsize=500_000)
def _trace_block(right: int, code: int, state: int) -> tuple[str, int, int]:
    """Edits, state after them and cost of one block; it is expanded backward first."""
    known = tables()
    found = [code // SYMBOLS**k % SYMBOLS for k in range(BLOCK - 1, -1, -1)]
    ends = [right]
    for symbol in reversed(found[1:]):
        ends.append(int(known.next_one[ends[-1], symbol]))
    name, cost = "", 0
    for symbol, end in zip(found, reversed(ends)):
        edits, state, more = known.edits[end, symbol, state]
        name += edits
        cost += more
    return name, state, cost


def trace_segment(letters: str, right: int, last: bool) -> list[tuple[str, int, int]]:
    """For each state before a segment: its edits, the state after it, and what they cost."""
    known = tables()
    codes, rest = _codes(symbols(letters))
    single = []
    for symbol in reversed(rest):
        single.append((right, symbol))
        right = int(known.next_one[right, symbol])
    ends = []
    for code in reversed(codes):
        ends.append(right)
        right = int(known.next_block[right, code])
    found = []
    for state in range(4):
        name, cost = [], 0
        for code, end in zip(codes, reversed(ends)):
            edits, state, more = _trace_block(end, code, state)
            name.append(edits)
            cost += more
        for end, symbol in reversed(single):
            edits, state, more = known.edits[end, symbol, state]
            name.append(edits)
            cost += more
        if last:
            name.append(TAIL[state])
            cost += INSERT * len(TAIL[state])
        found.append(("".join(name), state, cost))
    return found


def damage(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults, chosen by a checksum of conversation and turn.

    Of twenty rows, one each is dropped, emptied, stripped of its stops,
    repeated and given to the user. A null role or text, and a null in the
    checksum, is one space.
    """
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    slot = F.crc32(F.concat_ws(":", *named)) % SLOTS
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(slot == 4, "user").otherwise(role).alias("role"),
        F.when(slot == 1, "").when(slot == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(slot == 0, 0).when(slot == 3, 2).otherwise(1).alias("times"),
    ).select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(1), F.col("times"))).alias("one")).drop("one")


def _numbered(turns: DataFrame) -> DataFrame:
    """Turns in order, each with its number ``at`` and what is wrong with it by itself."""
    order = [
        F.col("conv_id").asc_nulls_first(),
        F.col("turn").asc_nulls_first(),
        "role",
        F.substring("text", 1, 64),
        "digest",
    ]
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    ended = F.rtrim("text", F.lit(_BLANKS))
    return (
        turns.withColumn("digest", F.sha2(whole, 256))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns(
            {
                "at": F.monotonically_increasing_id(),
                "is_blank": ended == "",
                "is_open": ~F.right(ended, F.lit(1)).isin(".", "!", "?"),
            }
        )
    )


def _segments(rows: DataFrame) -> DataFrame:
    """``conv_id, segment, letters`` and counts of faults of each segment."""
    firsts = rows.groupBy(F.col("conv_id").alias("of"), F.col("digest").alias("same")).agg(
        F.min("at").alias("first"), F.count(F.lit(1)).alias("n")
    )
    firsts = firsts.filter("n > 1").drop("n")
    seen = rows.select("conv_id", "at", "digest", "is_blank", "is_open", F.left("role", F.lit(1)).alias("initial")).join(
        firsts, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("same")), "left"
    )
    again = ~F.col("is_blank") & F.coalesce(F.col("at") > F.col("first"), F.lit(False))
    short = ~F.col("is_blank") & ~again & F.col("is_open")
    kind = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    fault = F.when(F.col("is_blank") | again, 2).when(short, 1).otherwise(0)
    letter = F.substring(F.lit(LETTERS), kind * 3 + fault + 1, F.lit(1))
    listed = F.array_sort(F.collect_list(F.struct("at", letter.alias("letter"))))
    return seen.groupBy("conv_id", F.shiftright("at", SEGMENT_BITS).alias("segment")).agg(
        F.array_join(F.transform(listed, lambda x: x["letter"]), "").alias("letters"),
        F.count_if("is_blank").alias("blank"),
        F.count_if(again).alias("duplicate"),
        F.count_if(short).alias("truncated"),
    )


def _backward(segments: DataFrame) -> DataFrame:
    """Each segment with the vector at its end, and whether it is its conversation's last."""

    def maps(batches):
        for ids, numbers, letters in batches:
            for row in zip(ids, numbers, letters):
                yield *row, segment_map(row[2])

    def follow(batches):
        now, vector, begun = None, 0, False
        for ids, numbers, letters, found in batches:
            for key, number, text, onward in zip(ids, numbers, letters, found):
                last = not begun or key != now
                if last:
                    now, vector, begun = key, 0, True
                yield key, number, text, vector, last
                vector = int(np.frombuffer(onward, "<i2")[vector])

    names = "conv_id long, segment long, letters string"
    mapped = map_rows(segments.select("conv_id", "segment", "letters"), f"{names}, onward binary", maps, 512)
    order = [F.col("conv_id").asc_nulls_first(), F.col("segment").desc()]
    mapped = mapped.repartition("conv_id").sortWithinPartitions(*order)
    return map_rows(mapped, f"{names}, vector int, last boolean", follow, 512)


def _forward(segments: DataFrame) -> DataFrame:
    """``conv_id, segment, state`` before it, ``piece`` (its edits), ``cost`` and ``illegal`` neighbours of each segment."""

    def traces(batches):
        for columns in batches:
            for key, number, letters, vector, last in zip(*columns):
                found = trace_segment(letters, vector, last)
                initials = np.frombuffer(letters.encode(), np.uint8) - ord("a")
                initials = initials // 3
                wrong = _illegal(initials[:-1], initials[1:])
                edges = int(initials[0]), int(initials[-1])
                yield key, number, *(list(c) for c in zip(*found)), int(wrong.sum()), *edges

    def follow(batches):
        now, state, before, begun = None, START, 0, False
        for columns in batches:
            for key, number, pieces, states, costs, wrong, first, final in zip(*columns):
                if not begun or key != now:
                    now, state, begun = key, START, True
                else:
                    wrong += int(_illegal(np.array([before]), np.array([first]))[0])
                yield key, number, state, pieces[state], costs[state], wrong
                state, before = states[state], final

    names = "conv_id long, segment long"
    traced = map_rows(
        segments.repartition("conv_id", "segment"),
        f"{names}, pieces array<string>, states array<int>, costs array<long>, wrong long, first int, final int",
        traces,
        512,
    )
    traced = traced.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "segment")
    return map_rows(traced, f"{names}, state int, piece string, cost long, illegal long", follow, 512)


def _illegal(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Whether neighbouring initials are none of su, ua, au."""
    return ~(((one == 0) & (two == 1)) | ((one == 1) & (two == 2)) | ((one == 2) & (two == 1)))


@dataclass(frozen=True)
class Repair:
    """What is wrong with conversations, and their repair; see :func:`repair_conversations`."""

    ids: DataFrame
    rows: DataFrame
    segments: DataFrame
    pieces: DataFrame

    def audits(self) -> DataFrame:
        """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` of every conversation."""
        wide = [F.col(f"{name}(turn)").cast("decimal(20,0)") for name in ("max", "min")]
        turns = self.rows.groupBy("conv_id").agg(F.max("turn"), F.min("turn"), F.count_distinct("turn").alias("n"))
        gaps = F.coalesce((wide[0] - wide[1] + 1 - F.col("n")).cast("long"), F.lit(0))
        turns = turns.select(F.col("conv_id").alias("turns_of"), gaps.alias("gaps"))
        faults = ["blank", "duplicate", "truncated"]
        found = self.segments.groupBy(F.col("conv_id").alias("faults_of")).agg(*[F.sum(c).alias(c) for c in faults])
        listed = F.array_sort(F.collect_list(F.struct("segment", "piece")))
        edits = self.pieces.groupBy(F.col("conv_id").alias("edits_of")).agg(
            F.sum("illegal").alias("illegal"),
            F.sum("cost").alias("cost"),
            F.array_join(F.transform(listed, lambda x: x["piece"]), "").alias("audit"),
        )
        joined = self.ids
        for frame, key in ((turns, "turns_of"), (found, "faults_of"), (edits, "edits_of")):
            joined = joined.join(frame, F.col("conv_id").eqNullSafe(F.col(key)), "left")
        counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", *faults, "illegal", "cost")]
        return joined.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"))

    def _in_order(self) -> DataFrame:
        """Edits of each segment, then its turns."""
        segment = F.shiftright("at", SEGMENT_BITS).alias("segment")
        nothing = F.lit(None).cast("string")
        edits = self.pieces.select(
            "conv_id", "segment", F.lit(-1).cast("long").alias("at"), "state", "piece", nothing.alias("role"), nothing.alias("text")
        )
        turns = self.rows.select("conv_id", segment, "at", F.lit(0).alias("state"), nothing.alias("piece"), "role", "text")
        order = [F.col("conv_id").asc_nulls_first(), "segment", "at"]
        return edits.union(turns).repartition("conv_id").sortWithinPartitions(*order)

    def turns(self) -> DataFrame:
        """``conv_id, place, role, text, edit`` of the repaired turns; conversations without any have no row."""

        def rows(batches):
            now, place, begun = None, 0, False
            for key, edit, role, text in _repaired(batches):
                if not begun or key != now:
                    now, place, begun = key, 0, True
                yield key, place, role, text, edit
                place += 1

        return map_rows(self._in_order(), "conv_id long, place long, role string, text string, edit string", rows, 512)

    def digests(self) -> DataFrame:
        """``conv_id, repaired_sha256`` (of ``role:text``, joined by newlines) of every conversation."""

        def rows(batches):
            now, digest = None, None
            for key, _, role, text in _repaired(batches):
                if digest is None or key != now:
                    if digest is not None:
                        yield now, digest.hexdigest()
                    now, digest = key, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if digest is not None:
                yield now, digest.hexdigest()

        found = map_rows(self._in_order(), "repaired_of long, repaired_sha256 string", rows)
        digest = F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
        return self.ids.join(found, F.col("conv_id").eqNullSafe(F.col("repaired_of")), "left").select("conv_id", digest)


def _repaired(batches: Iterator[list]) -> Iterator[tuple]:
    """Repaired turns (conversation, edit, role, text) of rows that :meth:`Repair._in_order` gives."""
    names = {1: "user", 2: "assistant"}
    state, edits, at = START, "", 0
    for columns in batches:
        for key, _, number, begins, piece, role, text in zip(*columns):
            if number < 0:
                state, edits, at = begins, piece, 0
            else:
                edit = edits[at]  # a turn's own edit; what is inserted before it is done
                at += 1
                if edit == "K":
                    state = _after(state, {"s": 0, "u": 1, "a": 2}[role[:1]])
                    yield key, edit, role, text
                elif edit == "R":
                    initial = _needed(state)
                    state = _after(state, initial)
                    yield key, edit, names[initial], text
            while at < len(edits) and edits[at] == "I":
                initial = _needed(state)
                state = _after(state, initial)
                at += 1
                yield key, "I", names[initial], ""


def repair_conversations(turns: DataFrame) -> Repair:
    """The cheapest edits that give each conversation of ``turns (conv_id, turn, role, text)`` the order ``(s?(ua)+)?``.

    Turns are taken by ``turn`` (nulls first); those of the same turn by role,
    then by text (its first 64 characters, then a digest). A turn's first fault
    counts: blank, a role and text seen before, no stop at its end. Blank and
    repeated turns are deleted (2), others may be kept (0), given to the user
    or the assistant (1) or deleted; empty turns may be inserted (5); an open
    end that stays costs 5. Of the cheapest edits, those whose initials come
    first are taken.

    ``turns`` has to have values in role and text (see :func:`damage`); null
    conversations are one conversation. Other columns are not read.
    """
    ids = turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    rows = written(_numbered(turns.select("conv_id", "turn", "role", "text")), "numbered-turns")
    segments = written(_segments(rows), "turn-segments")
    pieces = written(_forward(_backward(segments)), "edits")
    return Repair(ids, rows, segments, pieces)


def repair_digests(turns: DataFrame) -> DataFrame:
    """Faults, cost, audit and digest of the repair of every conversation after :func:`damage`.

    A conversation that loses all its rows has zeros, an empty audit and the
    digest of nothing. An empty table gives no rows.
    """
    named = turns.select("conv_id", "turn", "role", "text")
    found = repair_conversations(damage(named))
    audits = Repair(named.select(F.col("conv_id").cast("long").alias("conv_id")).distinct(), found.rows, found.segments, found.pieces)
    digests = audits.digests().withColumnRenamed("conv_id", "digest_of")
    return audits.audits().join(digests, F.col("conv_id").eqNullSafe(F.col("digest_of"))).drop("digest_of")
