import hashlib

import pytest

from certweave.llm import chat, templates
from certweave.llm.templates import TemplateError, compile_template, fold, parse


def rendered(source, **names):
    return "".join(s[0] for s in compile_template(source, chat.FILTERS)(names) if s)


def test_language():
    rows = [{"role": "user", "text": "a<b"}, {"role": "assistant", "text": "c"}]
    assert rendered("{% for m in messages %}{{ loop.index0 }}{% if loop.last %}!{% endif %}{{ m.text | escape }};{% endfor %}", messages=rows) == r"0a\<b;1!c;"
    assert rendered('{% set x = "q" + "r" %}{{ x | upper }}{% if not x == "qr" %}1{% elif x and true %}2{% else %}3{% endif %}') == "QR2"
    segments = [s for s in compile_template("{% for m in messages %}[{% generation %}{{ m.text }}{% endgeneration %}]{% endfor %}", {})({"messages": rows}) if s]
    assert segments == [("[", False), ("a<b", True), ("]", False), ("[", False), ("c", True), ("]", False)]


def test_constants_are_folded():
    assert fold(parse('a{{ "b" | upper }}{% if 1 == 1 %}c{{ "d" + "e" }}{% else %}{{ x }}{% endif %}f', chat.FILTERS), chat.FILTERS) == templates.Block((templates.Output(templates.Const("aBcdef")),))


@pytest.mark.parametrize("bad", ["{% for x in %}", "{{ a.__class__ }}", "{{ a | nope }}", "{% if a %}", "{{ a( }}", "{{ }}", "{% endfor %}", "{{ a[0] }}", "{{ 'x }}", "{% import os %}"])
def test_errors(bad):
    with pytest.raises(TemplateError):
        compile_template(bad, chat.FILTERS)


def test_nothing_of_python_is_reached():
    for source in ("{{ x.upper }}", "{{ y }}", "{{ x.keys }}"):
        with pytest.raises(TemplateError):
            rendered(source, x="text")


def expected(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn is None, turn or 0, role or "", text or ""))
    for conv, turns in out.items():
        turns.sort()
        loss = "".join(t for *_, role, t in turns if role == "assistant")
        body = "".join(f"<turn {chat.escape(r)}>\n{chat.escape(t)}</turn>\n" for *_, r, t in turns)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for *_, r, t in turns)), len(loss), sha(loss), len(body))
    return out


def test_round_trip(spark, monkeypatch):
    told = r"\### Assistant: </turn> ok"
    rows = [(1, 0, "user", told), (1, 1, "assistant", told), (2, 1, "assistant", "é\\<turn x>\n</turn>\n👩"), (2, 0, None, None), (2, 0, None, None), (3, None, "as>s\\", "\\"),
            (None, 0, "assistant", ""), (4, 0, "system", ""), (4, 2, "assistant", "x" * 5000)] + [(5, n, "assistant" if n % 2 else "user", f"turn {n} <") for n in range(3000)]
    turns = spark.createDataFrame([(*r, "e") for r in rows], "conv_id long, turn long, role string, text string, part string")
    for room in (chat.ROOM, 50):  # one row per conversation, and many parts
        monkeypatch.setattr(chat, "ROOM", room)
        got = {r.conv_id: tuple(r)[1:] for r in chat.read_back(chat.format_conversations(turns)).collect()}
        assert got == expected(rows)
    assert chat.read_back(chat.format_conversations(turns.limit(0))).count() == 0
