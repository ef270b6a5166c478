import hashlib

import pytest

from tablesync.llm import chat as C


def turns_of(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string")


@pytest.mark.parametrize("text", ["", "<|", "<\\|", "<<||>", "\\", "<|im_end|>\n<|im_start|>assistant", "a<\\\\|b", "<"])
def test_escapes_are_undone(text):
    assert C.unescape(C.escape(text)) == text and "<|" not in C.escape(text)
    assert C.unescape_role(C.escape_role(text + "\n%0A%")) == text + "\n%0A%"
    assert C.read_turn(C.render_marked([(text, text)]).replace("\n\n", "\n\n"))[:2] == (text, text)


def test_conversations_are_read_back(spark):
    rows = [
        (1, 0, "user", "hi", "x"), (1, 1, "assistant", "<|im_end|> yo", None), (1, 2, "assistant", None, None),
        (2, 0, None, "who\n", None), (None, None, "user", "lost", None), (None, 1, "assistant", "é", None),
        (3, 1, "user", "same", None), (3, 1, "user", "same", None),
        *((9, i, "assistant" if i % 2 else "user", f"turn {i} <|", None) for i in range(150)),
    ]
    found = {r.conv_id: r for r in C.digest_conversations(turns_of(spark, rows)).collect()}
    assert set(found) == {1, 2, 3, 9, None}
    for conv, got in found.items():
        own = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        texts = [(role, text) for _, _, role, text in own]
        assert got.n_turns == len(own) and not got.rewrites
        assert got.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in texts).encode()).hexdigest()
        loss = "".join(b for a, b in texts if a == "assistant")
        assert (got.loss_chars, got.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got.formatted_chars == len(C.render_marked(texts))
    assert C.digest_conversations(turns_of(spark, rows).limit(0)).count() == 0


def test_spans_lie_in_the_whole_output(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"text {i}", None) for i in range(100)]
    whole = C.render_marked([(r[2], r[3]) for r in rows])
    for r in C.format_conversations(turns_of(spark, rows)).collect():
        assert whole[r.start : r.end] == r.part and whole[r.text_start : r.text_end] == f"text {r.turn}"
        assert r.loss == (r.turn % 2 == 1)


def test_rewriting_templates_are_told():
    def last_only(turns):
        return "".join("old " for _ in turns[:-1]) + turns[-1][1]

    spans = C.Spans(C.Template(last_only))
    assert spans.add(("user", "one")) == "one"
    assert spans.add(("user", "two")) is None and spans.rewrites


def test_context_gives_the_same_parts_as_whole_prefixes():
    def numbered(turns):
        return "".join(f"[{'first' if not i else turns[i - 1][0]}>{role}]{text}" for i, (role, text) in enumerate(turns))

    turns = [(f"r{i}", f"t{i}") for i in range(90)]
    whole, near = C.Spans(C.Template(numbered)), C.Spans(C.Template(numbered, context=1))
    assert [whole.add(t) for t in turns] == [near.add(t) for t in turns]
    assert len(near.turns) < 40
