import hashlib
import random
import sys
from pathlib import Path

import public_tokenizers
import tiktoken

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))
import corpus_pipeline  # noqa: E402
from tablesync.llm.bpe import load_ranks  # noqa: E402


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(9)
    some = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    passage = some(15)
    rows = [(i, some(60)) for i in range(20)]
    rows += [(30, rows[3][1]), (31, rows[4][1] + " tail"), (32, some(30) + " " + passage), (33, "too short"), (34, None)]
    rows += [(35, some(40) + " token=abcdef123456 end"), (5, rows[5][1]), (None, some(50)), (36, "")]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    encoding = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")),
    )
    texts = dict(rows[:20]) | {35: rows[25][1].replace("abcdef123456", "<secret>"), None: rows[27][1]}
    want = {str(i): encoding.encode_ordinary(t) for i, t in texts.items()}
    assert {str(r.doc_id): r.ids for r in found} == want and len(found) == len(want)
    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in found)


def test_stages_keep_the_columns(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a b", "en", "s", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, "x")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = frame.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.schema.simpleString() == frame.schema.simpleString()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == 0


def test_rows_go_by_their_own_text(spark, tmp_path):
    rng = random.Random(10)
    some = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    passage, copied = some(15), some(50)
    clean = [(None, some(50)), (None, some(60)), (7, some(50)), (7, some(55)), (7, copied), (8, some(50))]
    rows = clean + [(7, copied), (7, copied + " tail"), (None, "short"), (8, "again and again " * 40)]
    rows += [(None, some(30) + " " + passage), (8, some(30) + " " + passage), (9, copied)]
    rows += [(None, f"a menu line of the host\n{some(30)}") for _ in range(60)]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = frame.repartition(3), []
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = corpus_pipeline.written(stage(spark, docs, str(tmp_path)), "stage")
        kept.append(docs.count())
    assert kept == [len(rows) - 2, len(rows) - 5, len(clean) + 60]
    found = [(r.doc_id, r.text) for r in docs.collect()]
    assert sum("menu" in t for _, t in found) == 1
    # Of three similar texts of id 7 one stays; which of them is open.
    own = [(i, copied if t.startswith(copied) else t) for i, t in found if i is not None or len(t.split()) in (50, 60)]
    assert sorted(map(str, own)) == sorted(map(str, clean))


def test_near_duplicates_without_ids_and_clashing_names(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(None, text, 1), (5, text + " more", 2), (None, text + " again", 3), (None, "", 4), (None, None, 5), (6, "", 6), (6, None, 7), (None, "other words here", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row long")
    kept = corpus_pipeline.one_of_each(spark, docs, "")
    assert kept.columns == docs.columns
    found = sorted(r.row for r in kept.collect())
    assert found in ([2, 4, 5, 6, 8], [2, 4, 5, 7, 8])
