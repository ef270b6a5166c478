"""Repair of conversations against a plain search over all edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from tablesync.llm import repair as R

BLANK = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        slot = zlib.crc32(key.encode()) % 20
        if slot == 0:
            continue
        text = "" if slot == 1 else re.sub("[.!?]", "", text) if slot == 2 else text
        role = "user" if slot == 4 else role
        out += [(conv, turn, role, text)] * (2 if slot == 3 else 1)
    return out


def faults(turns):
    seen, found = set(), []
    for role, text in turns:
        core = text.rstrip(BLANK)
        if not core:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        elif core[-1] not in ".!?":
            found.append("truncated")
        else:
            found.append("")
        seen.add((role, text))
    return found


def cheapest(turns):
    """Least (cost, audit) by search: states are turns used up and roles given so far."""
    found = faults(turns)
    grammar = re.compile("(s?(ua)+)?")
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, tail, out = heapq.heappop(heap)
        if i == len(turns) and tail in ("", "a"):
            return cost, audit, out
        if (i, tail) in done:
            continue
        done.add((i, tail))

        def put(more, edit, used, role, text):
            last = role[:1] if role is not None else tail
            given = "".join(r[:1] for r, _ in out) + (last if role is not None else "")
            if not any(grammar.fullmatch(given + rest) for rest in ("", "a", "ua")):
                return
            then = out if role is None else (*out, (role, text))
            heapq.heappush(heap, (cost + more, audit + edit, i + used, last, then))

        for role in ("user", "assistant"):
            put(5, "I", 0, role, "")
        if i < len(turns):
            role, text = turns[i]
            put(2, "D", 1, None, None)
            if found[i] not in ("blank", "duplicate"):
                extra = 5 if found[i] == "truncated" else 0
                put(extra, "K", 1, role or "?", text)
                for other in ("user", "assistant"):
                    put(1 + extra, "R", 1, other, text)


def expected(rows):
    out = []
    for conv in {r[0] for r in rows}:
        mine = [r for r in damaged(rows) if r[0] == conv]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        numbers = {r[1] for r in mine if r[1] is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        turns = [(r[2], r[3]) for r in mine]
        found = faults(turns)
        pairs = [a[:1] + b[:1] for (a, _), (b, _) in zip(turns, turns[1:])]
        cost, audit, fixed = cheapest(turns)
        text = "\n".join(f"{r}:{t}" for r, t in fixed)
        counts = [found.count(k) for k in ("blank", "duplicate", "truncated")]
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return out


def rows_of(seed, convs, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "no", "", "  \n", "Why? ", "a\t", "really!\x0b", "。", "x.y", " "]
    roles = ["user", "assistant", "system", "tool", "u", "assist", ""]
    rows = []
    for conv in range(convs):
        for turn in range(rng.randrange(longest)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.8 else rng.choice(roles)
            rows.append((conv, turn * rng.choice([1, 1, 1, 2]), role, rng.choice(texts) + (str(turn) + "." if rng.random() < 0.5 else "")))
    rows += [(None, 1, "user", "null conversation."), (900, None, None, None), (901, None, "user", "one."), (901, 5, "user", "one.")]
    rows += [(902, -(1 << 63), "user", "low."), (902, (1 << 63) - 1, "assistant", "high.")]
    rows += [(903, 1, "user", "same."), (903, 1, "user", "same."), (903, 1, "assistant", "same.")]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("bits", [12, 2])
def test_against_search(spark, monkeypatch, bits):
    monkeypatch.setattr(R, "SEGMENT_BITS", bits)
    rows = rows_of(bits, 150, 14)
    rows = [r for r in rows if r[0] != 902] if bits == 2 else rows
    wanted = [r for r in expected([r for r in rows if r[0] != 902])]
    found = [tuple(r) for r in R.repair_digests(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()]
    assert sorted([r for r in found if r[0] != 902], key=repr) == sorted(wanted, key=repr)


def test_one_long_conversation(spark):
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), f"turn {t}" + rng.choice([".", "", "!"])) for t in range(3000)]
    want = expected(rows)
    before = R.SEGMENT_BITS
    try:
        R.SEGMENT_BITS = 5
        df = spark.createDataFrame(rows, SCHEMA).repartition(4)
        found = R.repair_conversations(R.damage(df))
        assert found.segments.count() > 50
        assert [tuple(r) for r in R.repair_digests(df).collect()] == want
        turns = found.turns().orderBy("place").collect()
        text = "\n".join(f"{r['role']}:{r['text']}" for r in turns)
        assert hashlib.sha256(text.encode()).hexdigest() == want[0][-1]
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in turns))
    finally:
        R.SEGMENT_BITS = before


def test_blocks_give_what_single_symbols_give():
    known = R.tables()
    rng = random.Random(1)
    for _ in range(300):
        letters = "".join(rng.choice(R.LETTERS) for _ in range(rng.randrange(1, 30)))
        vectors, codes = list(range(len(known.vectors))), R.symbols(letters).tolist()
        for symbol in reversed(codes):
            vectors = [int(known.next_one[v, symbol]) for v in vectors]
        import numpy as np

        assert np.frombuffer(R.segment_map(letters), "<i2").tolist() == vectors


def test_empty_table_and_other_columns(spark):
    assert R.repair_digests(spark.createDataFrame([], SCHEMA)).collect() == []
    df = spark.createDataFrame([(3, 1, "user", "Hm.", "x", 1, "y")], SCHEMA + ", at string, segment int, digest string")
    row = R.repair_digests(df).first()
    assert (row["conv_id"], row["audit"], row["cost"]) == (3, "D", 2)
