import re

import pytest

from tablesync.llm.decontaminate import cut_leaks, find_leaks, without_leaks

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PASSAGE = "One two three four five six seven eight nine ten eleven twelve, thirteen É"
ITEMS = [(2, PASSAGE), (10, "Short item."), (3, ""), (4, None), (None, "nobody owns this"), (2, PASSAGE), (5, "ten eleven twelve thirteen é x y z w v")]
DOCS = [
    (1, "Start. " + PASSAGE + " end"), (2, "a SHORT, item b short item"), (3, None), (4, ""), (5, "clean text"),
    (6, "one two three four five six seven eight nine"), (None, "short item"), (7, "it is so that nobody owns this"),
    (8, ("filler word " * 20_000) + PASSAGE), (1, "clean too"), (9, PASSAGE + " " + PASSAGE),
]


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text):
    own, hit, items = words(text), set(), set()
    for item, passage in ITEMS:
        there = words(passage)
        size = min(10, len(there))
        for k in range(len(there) - size + 1 if there else 0):
            for i in range(len(own) - size + 1):
                if own[i : i + size] == there[k : k + size]:
                    hit |= set(range(i, i + size))
                    items |= {str(item)} if item is not None else set()
    return len(own), len(hit), sorted(items)


@pytest.fixture()
def tables(spark, docs_of):
    return docs_of(DOCS).withColumnRenamed("lang", "items"), spark.createDataFrame(ITEMS, "item_id long, text string")


def test_hits_are_those_of_brute_force(tables):
    found = find_leaks(*tables).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.items) for r in found) == sorted((str(i), *brute(t)) for i, t in DOCS)
    assert all(r.contaminated == (r.n_hit > 0) and r.n_items == len(r.items) for r in found)


def test_large_benchmarks_take_several_passes(tables, monkeypatch):
    import tablesync.llm.decontaminate as D

    monkeypatch.setattr(D, "MAX_BROADCAST_WINDOWS", 4)
    found = find_leaks(*tables).collect()
    assert sorted((str(r.doc_id), r.n_hit) for r in found) == sorted((str(i), brute(t)[1]) for i, t in DOCS)


def test_no_python_runs(tables):
    plan = find_leaks(*tables)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_leaking_documents_go(tables):
    docs, benchmark = tables
    assert {r.doc_id for r in without_leaks(docs, benchmark).collect()} == {3, 4, 5, 6}
    assert without_leaks(docs, benchmark).columns == docs.columns
    assert without_leaks(docs, benchmark.limit(0)).count() == len(DOCS)
    assert find_leaks(docs.limit(0), benchmark).count() == 0


def test_rows_without_an_id_go_by_their_own_text(tables, docs_of):
    docs, benchmark = docs_of(DOCS + [(None, "clean, no id"), (None, None)]), tables[1]
    kept = sorted((str(r.doc_id), str(r.text)) for r in without_leaks(docs, benchmark).collect())
    assert [k for k in kept if k[0] == "None"] == [("None", "None"), ("None", "clean, no id")]
    rows = sorted((str(r.doc_id), str(r.text)) for r in without_leaks(docs, benchmark, by_row=True).collect())
    assert rows == sorted([*kept, ("1", "clean too")])


def test_hit_words_are_cut(tables):
    docs, benchmark = tables
    cut = {r.doc_id: r.text for r in cut_leaks(docs.filter("doc_id in (2, 5)"), benchmark).collect()}
    assert cut == {2: "a b", 5: "clean text"}


def test_each_row_is_cut_by_its_own_text(spark, tables):
    clean = "these are clean words of a text that shares an id only here"
    rows = [(1, PASSAGE + " end"), (1, clean), (None, "a short item"), (None, clean), (None, None), (1, ""), (1, PASSAGE + " end")]
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], "doc_id long, text string, hits string, leaked int, content string")
    cut = cut_leaks(docs, tables[1])
    assert cut.columns == docs.columns
    want = [(1, " end"), (1, clean), (None, "a"), (None, clean), (None, None), (1, ""), (1, " end")]
    assert sorted(((r.doc_id, r.text) for r in cut.collect()), key=repr) == sorted(want, key=repr)
    left = without_leaks(docs, tables[1], by_row=True)
    assert left.columns == docs.columns and left.count() == 4
