import hashlib
import random

import public_tokenizers

from tablesync.llm.token_counts import NUMBERS, TokenTree, count_edited, counter_for

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
COUNTER = counter_for(PATH, public_tokenizers.PATTERN)


def whole(text):
    return len(COUNTER.encoding.encode_ordinary(text))


def test_edits_give_the_counts_of_the_edited_text():
    rng = random.Random(3)
    parts = ["a", "b", "the ", " ", "  ", "\n", "'", "l", "s", "1", "23", "é", "#", "\t", "   ", "'ll", "'re"]
    for _ in range(400):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(400)))
        tree = TokenTree(text, COUNTER)
        for _ in range(8):
            start = rng.randrange(len(text) + 1)
            end = min(len(text), start + rng.choice([0, 1, 2, 30, 200]))
            new = "".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 2, 9])))
            tree.edit(start, end, new)
            text = text[:start] + new + text[end:]
            assert tree.text() == text and tree.n_tokens == whole(text)


def test_an_edit_counts_only_what_is_near():
    tree = TokenTree("word " * 50_000, COUNTER)
    assert tree.edit(100_000, 100_004, "other") < 10


def test_rows(spark, docs_of):
    rows = [(1, "call 12345 or 678 or 99999999"), (1, "call 12345 or 678 or 99999999"), (2, None), (3, ""), (None, "2024"), (4, "1234 " * 5_000)]
    found = count_edited(docs_of(rows).withColumnRenamed("lang", "n_edits"), PATH, public_tokenizers.PATTERN).collect()
    assert len(found) == len(rows)
    for got in found:
        text = next(t for i, t in rows if i == got.doc_id) or ""
        after = NUMBERS.sub("<number>", text)
        assert (got.n_before, got.n_tokens) == (whole(text), whole(after))
        assert got.n_edits == len(NUMBERS.findall(text)) and got.text_sha256 == hashlib.sha256(after.encode()).hexdigest()
    assert count_edited(docs_of(rows).limit(0), PATH, public_tokenizers.PATTERN).count() == 0
