import base64
import hashlib
import random

import public_tokenizers
import tiktoken

from tablesync.llm.bpe import CorpusEncoder, encode_documents

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ALPHABET = ["a", "e", "ab", "the", "ing", " ", "  ", "\n", "é", "ß", "中", "🙂", "1", "23", "'s", "'ll", "aaaa", "²", "\x1c", "_", "́"]


def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_are_those_of_the_library():
    rng = random.Random(5)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(60))) for _ in range(4000)]
    texts += ["", "a" * 3000, "ab" * 999, " " * 500, "<|endoftext|>"]
    known = reference()
    encoder = CorpusEncoder(PATH, public_tokenizers.PATTERN)
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == known.encode_ordinary(text)


def test_merges_that_make_lower_ranks_follow_a_strict_order():
    # "cd" comes before "bcd"-making merges of lower rank appear: every piece by the plain rule.
    from tablesync.llm.bpe import MergeReplay

    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"bc", b"cab", b"ab", b"abab", b"ca", b"aa", b"aaa"]
    replay = MergeReplay({t: i for i, t in enumerate(tokens)})
    rng = random.Random(1)
    pieces = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 12))).encode() for _ in range(3000)]
    ids, begins = replay.encode(pieces)
    for i, piece in enumerate(pieces):
        want = [replay.ranks[piece]] if piece in replay.ranks else replay._alone(piece)
        assert ids[begins[i] : begins[i + 1]].tolist() == want


def test_rows(spark, docs_of):
    known = reference()
    rows = [(1, "Hello there, the world"), (1, "Hello there, the world"), (2, None), (3, ""), (None, "x"), (4, "long " * 40_000)]
    docs = docs_of(rows).withColumnRenamed("lang", "n_tokens")
    found = encode_documents(docs, PATH, public_tokenizers.PATTERN).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in rows)
    texts = {r[0]: r[1] or "" for r in rows}
    for r in found:
        ids = known.encode_ordinary(texts[r.doc_id])
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert encode_documents(docs_of(rows).limit(0), PATH, public_tokenizers.PATTERN).count() == 0
