import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tablesync.llm import token_files as T

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "The cat's HAT, isn't it?  x\x0by\x1cz w  q", "", "Ünï é ﬁ İstanbul ΣΑΣ ²½", "<|endoftext|>a <|startoftext|>",
    "a.,., ...,b. ,.", "naïve,naïve. 中文 字", "don't 'll x's", "tab\tnew\nline",
]


def test_words_are_encoded_like_whole_texts():
    whole = Tokenizer.from_file(PATH)
    encoder = T.WordEncoder(PATH)
    for text, ids in zip(TEXTS, encoder.encode([t.encode() for t in TEXTS])):
        assert np.frombuffer(ids, encoder.dtype).tolist() == whole.encode(text, add_special_tokens=False).ids


def test_forgetting_words_changes_nothing(monkeypatch):
    encoder = T.WordEncoder(PATH)
    texts = [t.encode() for t in TEXTS]
    first = list(encoder.encode(texts))
    monkeypatch.setattr(T, "KEPT_WORDS", 3)
    assert [next(iter(encoder.encode([t]))) for t in texts] == first


def test_files_are_read_back(spark, docs_of, tmp_path):
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(300)] + [(5, "again"), (7, None), (None, "no id"), (-3, "w " * 30_000)]
    docs = docs_of(rows).withColumnRenamed("lang", "start")
    folder = str(tmp_path / "files")
    manifest = T.write_token_files(docs, PATH, 1, folder)
    found = T.read_token_files(manifest, folder).orderBy("start").collect()
    whole = Tokenizer.from_file(PATH)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    for row, got in zip(order, found, strict=True):
        ids = [*whole.encode(row[1] or "", add_special_tokens=False).ids, 1]
        assert (got.doc_id, got.start, got.n_tokens) == (row[0], start, len(ids))
        assert got.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    fs, place = T.open_folder(folder)
    for file in manifest.collect():
        tokens = T.TokenFile(fs, f"{place}/{file.file}.arrow")
        ids, mask = tokens.sequence_at(0)
        assert len(ids) == len(mask) == T.SEQUENCE and mask.sum() == min(T.SEQUENCE, file.n_tokens)


def test_no_documents(spark, docs_of, tmp_path):
    assert T.token_files(docs_of([(1, "x")]).limit(0), PATH, 1, str(tmp_path / "none")).count() == 0
