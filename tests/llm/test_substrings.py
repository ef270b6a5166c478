import hashlib
import random
import re

import numpy as np

from tablesync.llm.substrings import remove_repeats
from tablesync.llm.words import run_hashes, sliding, winnowed, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    first = {}
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, words in split:
        for k in range(len(words) - window + 1):
            if i is not None:
                key = tuple(words[k : k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - window + 1):
            if i is not None and first[tuple(words[k : k + window])] < i:
                gone |= set(range(k, k + window))
        left = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((str(i), len(words), len(gone), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out)


def test_removed_words_are_those_of_brute_force(spark, docs_of):
    rng = random.Random(2)
    vocabulary = [f"w{i}é" for i in range(200)]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passages = [some(60), some(51), some(50), some(49), ["a"] * 70]
    rows = []
    for i in range(80):
        words = some(rng.randrange(0, 90))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = rng.choice(passages)
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(words)))
    rows += [(200 + i, rows[5][1]) for i in range(4)] + [(300, None), (301, ""), (None, rows[5][1]), (3, rows[3][1]), (7, " ".join(passages[0]))]
    rows.append((400, " ".join(passages[0] * 300)))
    found = remove_repeats(docs_of(rows).withColumnRenamed("lang", "own")).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in found) == brute(rows, 50)
    assert remove_repeats(docs_of(rows).limit(0)).count() == 0


def test_hashes_do_not_depend_on_the_chunk():
    texts = [b"one two  three", b"", b" two\n", "ünï two one".encode()]
    one, empty, two, last = word_hashes(texts)
    assert len(one) == 3 and not len(empty) and two[0] == one[1] == last[1] and last[2] == one[0]
    assert [x.tolist() for t in texts for x in word_hashes([t])] == [x.tolist() for x in (one, empty, two, last)]


def test_runs_and_winnows():
    values = np.random.default_rng(1).integers(1, 50, 300).astype(np.uint64)
    for length in (1, 2, 5, 16, 50):
        hashes = run_hashes(values, length)
        runs = [tuple(values[i : i + length]) for i in range(len(values) - length + 1)]
        assert len(hashes) == len(runs) and len(set(hashes.tolist())) == len(set(runs))
        least = [min(values[i : i + length]) for i in range(len(values) - length + 1)]
        assert sliding(values, length, np.minimum).tolist() == least
        want = {k for i, m in enumerate(least) for k in range(i, i + length) if values[k] == m}
        assert set(winnowed(values, length).tolist()) == want
