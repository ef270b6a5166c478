import re

from tablesync.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text)
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            duplicates += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), duplicates, len(hit)


def test_figures_are_those_of_brute_force():
    texts = [
        "", " \n\t", "one", "a b\na b\n\n a b\n", "é # * $%&|<> x y z\x1cw", "a " * 40,
        " ".join(f"w{i % 11}" for i in range(60)), "x\n" * 9, "a b c d e f g h i a b c d e f g h j" ,
    ]
    for text in texts:
        assert Q.figures(text)[:5] == brute(text)


def letters(i):
    return "".join(chr(97 + (i >> s & 7)) for s in (0, 3, 6, 9))


def test_lines_that_many_documents_share_go(spark, docs_of):
    own = lambda i: " ".join(f"{letters(i)}{letters(k)}" for k in range(30))
    rows = [(i, f"Cookie notice 123 of   this page\n{own(i)}") for i in range(8)]
    rows += [(20 + i, f"{own(400 + i)}\n{own(900)}\n{letters(i)} {'extra ' * 3}") for i in range(2)]
    rows += [(30 + i, "the same copied document\n" + own(777)) for i in range(9)]
    rows += [(50, "short"), (51, None), (52, ""), (53, "again and again " * 40), (None, own(60)), (54, own(61) + "\n" + " ".join(f"u{k}" for k in range(30_000)))]
    found = Q.judge(docs_of(rows).withColumnRenamed("lang", "kept"), max_documents=4).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found}
    assert [by[i].n_removed_words for i in range(8)] == [0] + [6] * 7
    assert all(by[i].kept for i in [*range(8), 20, 21, *range(30, 39), None, 54])
    assert not any(by[i].kept for i in (50, 51, 52, 53)) and all(by[i].base_failed for i in (50, 51, 52, 53))
    for r in found:
        text = next(t for i, t in rows if i == r.doc_id) or ""
        if len(text) < 5000:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(text)
    assert Q.judge(docs_of(rows).limit(0)).count() == 0


def test_depleted_documents_are_rejected(spark, docs_of):
    own = lambda i: " ".join(f"{letters(i)}{letters(k)}" for k in range(25))
    shared = "a b c d e f g h i j k l m n o p q r s t u v"
    rows = [(i, f"{shared}\n{letters(i)} {letters(i + 50)} once") for i in range(9)] + [(40 + i, own(i)) for i in range(3)]
    found = {r.doc_id: r.kept for r in Q.judge(docs_of(rows), max_documents=4).collect()}
    assert [i for i, kept in found.items() if kept and i < 40] == [0]
    kept = {r.doc_id: r for r in Q.keep_good(docs_of(rows), max_documents=4, length_col="n_chars").collect()}
    assert set(kept) == {0, 40, 41, 42} and kept[0].text.startswith(shared)


def test_removed_lines_leave_the_text(spark, docs_of):
    own = lambda i: " ".join(f"{letters(i)}{letters(k)}" for k in range(30))
    rows = [(i, f"menu home about\n{own(i)}") for i in range(8)]
    kept = {r.doc_id: r for r in Q.keep_good(docs_of(rows), max_documents=4, length_col="n_chars").collect()}
    assert kept[0].text == rows[0][1] and all(kept[i].text == own(i) and kept[i].n_chars == len(own(i)) for i in range(1, 8))


def test_lines_count_by_documents_even_beside_a_longer_shared_line(spark, docs_of):
    own = lambda i: " ".join(f"{letters(i)}{letters(k)}" for k in range(30))
    notice = " ".join(f"notice{k}" for k in range(40))
    second = " ".join(f"terms{k}" for k in range(38))
    rows = [(i, f"menu home about\n{notice}\n{own(i)}") for i in range(8)]
    rows += [(20 + i, f"{second}\n{notice} too\n{letters(i)} {letters(i + 50)} once") for i in range(8)]
    rows += [(40 + i, f"Copied {i} line\n{own(900)}") for i in range(9)]
    found = {r.doc_id: r for r in Q.judge(docs_of(rows), max_documents=4).collect()}
    assert [found[i].n_removed_words for i in range(8)] == [0] + [43] * 7
    assert [found[20 + i].n_removed_words for i in range(8)] == [0] + [79] * 7
    assert [i for i in sorted(found) if not found[i].kept] == list(range(21, 28))
    assert all(found[40 + i].n_removed_words == 0 for i in range(9))


def test_clashing_names_stay(spark):
    text = " ".join(f"word{i}" for i in range(30))
    rows = [(1, text, "s", "a", "b", "c", "d"), (1, text + " more", "s", "a", "b", "c", "d")]
    names = "doc_id long, text string, source string, judged string, host string, content string, Removed string"
    kept = Q.keep_good(spark.createDataFrame(rows, names))
    assert kept.columns == names.replace(" string", "").replace(" long", "").split(", ")
    assert sorted(map(tuple, kept.collect())) == sorted(rows)
