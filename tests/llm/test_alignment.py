"""Alignment of two tokenizers against whole texts, encoded and linked one by one."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tablesync.llm import alignment as A

PATHS = [public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")]


@pytest.fixture(scope="module")
def aligner():
    return A.Aligner(*PATHS)


def plain(aligner, text):
    """Ids, groups and links of a whole text, by comparing all tokens with each other."""
    if not text:
        return None
    a = aligner.one.encode(" " + text, add_special_tokens=False).ids
    b = aligner.two.encode(text)
    spans = []
    for ids, table in ((a, aligner.a_bytes), (b, aligner.b_bytes)):
        at, found = 0, []
        for i in ids:
            found.append((at, at + len(table[i])))
            at += len(table[i])
        if b"".join(table[i] for i in ids) != (" " + text).encode():
            return None
        spans.append(found)
    links = [(x, y) for (s, e), x in zip(spans[0], a) for (t, f), y in zip(spans[1], b) if s < f and t < e]
    cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    groups = []
    for low, high in zip([0, *cuts], cuts):
        parts = [
            ",".join(str(i) for (s, e), i in zip(found, ids) if low <= s and e <= high)
            for found, ids in zip(spans, (a, b))
        ]
        groups.append("|".join(parts))
    return a, b, groups, links


def expected(aligner, rows):
    done = [plain(aligner, text) for _, text in rows]
    counts = Counter(pair for d in done if d for pair in d[3])
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(n, highest.get(b, 0))
    out = []
    for (key, _), d in zip(rows, done):
        if d is None:
            out.append((key, 0, 0, 0, 0, 0, 0, "", ""))
            continue
        a, b, groups, links = d
        shown = ";".join(groups)
        best = sum(counts[p] == highest[p[1]] for p in links)
        total = sum(counts[p] for p in links)
        digest = hashlib.sha256(shown.encode()).hexdigest()
        out.append((key, len(a), len(b), len(groups), len(links), best, total, digest, shown))
    return out


def odd_texts():
    rng = random.Random(4)
    letters = ["a", "B", "ß", "é", "漢", "字", "🙂", "️", "\n", "\t", " ", "  ", " ", "　", "\x1c", "7", "'s", "<s>",
               "<|endoftext|>", "▁", "-", "=", "the", "ing", " und", "http://x.y/", "\r\n", "\x00", "ा"]
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(300)]


def test_against_brute_force(spark, aligner):
    plain_rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(25).select("doc_id", "text").collect()
    rows = [(r["doc_id"], r["text"][:1500]) for r in plain_rows]
    rows += [(10_000 + i, t) for i, t in enumerate(odd_texts())]
    rows += [(None, "no id here"), (1, None), (1, ""), (1, " "), (7, "twice the same"), (7, "twice the same")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = [tuple(r) for r in A.align_documents(df, *PATHS, keep_groups=True).collect()]
    assert sorted(found, key=repr) == sorted(expected(aligner, rows), key=repr)


def test_words_give_what_whole_texts_give(aligner):
    for text in odd_texts():
        words = aligner.split(text)
        assert " " + text == "".join(" " + w for w in words)
        ids = [i for w in words for i in aligner.one.encode(" " + w, add_special_tokens=False).ids]
        assert ids == aligner.one.encode(" " + text, add_special_tokens=False).ids
        if "▁" not in text and text:
            assert [i for w in words for i in aligner.two.encode(w)] == aligner.two.encode(text)


def test_slices():
    a, b = np.array([2, 5, 9, 10]), np.array([1, 2, 7, 9, 10])
    cuts = A.cut_groups(a, b)
    assert [c.tolist() for c in cuts] == [[1, 3, 4], [2, 4, 5]]
    x, y = A.link_slices(a, b, *cuts)
    assert list(zip(x.tolist(), y.tolist())) == [(0, 0), (0, 1), (1, 2), (2, 2), (2, 3), (3, 4)]


def test_packed():
    lists = [np.array([0, 5, 300, 70_000]), np.array([], np.int64), np.array([2**31])]
    assert A.unpacked([A.packed(x) for x in lists]).tolist() == [0, 5, 300, 70_000, 2**31]


def test_empty_table_and_other_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, part long, word int")
    assert A.align_documents(empty, *PATHS).collect() == []
    df = spark.createDataFrame([(1, "a word", 5, 6, "x")], "doc_id long, text string, part long, word int, a string")
    row = A.align_documents(df, *PATHS).first()
    assert (row["doc_id"], row["n_groups"] > 0, row["groups"]) == (1, True, None)


def test_long_text(spark, aligner):
    text = "word " * 60_000 + "x" * 20_000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = A.align_documents(df, *PATHS).first()
    assert row["n_a"] == len(aligner.one.encode(" " + text, add_special_tokens=False).ids)
    assert row["n_b"] == len(aligner.two.encode(text))
    assert row["n_links"] == row["n_a"] + row["n_b"] - row["n_groups"]
