"""op8: the template language, reversible escaping, and reading back."""

from __future__ import annotations

import hashlib
import random

import pytest

from registrum.llm import chat_template as chat


def test_language():
    render = lambda t, m=(), **k: "".join(p for kind, p in chat.compiled(t)(list(m), **k) if kind == "text")
    assert render("{{ 1 + 2 }}{{ 'a' ~ 1 }}{{ 'x' if false else 'y' }}") == "3a1y"
    assert render("{% for m in messages %}{{ loop.index0 }}{{ m['text'] | upper }}{% if not loop.first %},{% endif %}{% endfor %}", [{"text": "a"}, {"text": "b"}]) == "0A1B,"
    assert render("{% set x = 'k' %}{{ x }}{# gone #}{{ y | default('d') }}{{ true and none == none }}") == "kdtrue"
    assert render("{% if a == 1 %}1{% elif a == 2 or a in b %}2{% else %}3{% endif %}", a=5, b=[5]) == "2"
    assert render("a {%- if true -%} b {%- endif -%} c") == "abc"
    for bad in ("{{ }}", "{{ a.b() }}", "{% for x %}{% endfor %}", "{% if a %}", "{{ a | nope }}", "{{ a._b }}", "{{ ''.__class__ }}", "{% import os %}", "{{ (1 }}"):
        with pytest.raises(chat.TemplateError):
            chat.compiled(bad)
    with pytest.raises(chat.TemplateError):
        render("{{ 'x'.upper }}")


def test_constants_are_folded():
    assert chat.fold(chat.parse("{{ 'a' + 'b' }}c{% if 1 < 2 %}d{% else %}e{% endif %}{{ 'x' | upper }}")) == (chat.Out(chat.Const("abcdX")),)
    # the folded and the plain tree write the same
    messages = [{"role": "user", "text": "</s>\\n"}, {"role": "assistant", "text": "ok"}]
    plain = list(chat._writer(chat.parse(chat.TEMPLATE))({"messages": messages}))
    assert "".join(p for _, p in plain) == chat.render(chat.TEMPLATE, messages)[0]


def test_escaping_is_reversible():
    rng = random.Random(4)
    parts = [*chat.CONTROL, "\\", "\\0", "\\n", "\n", "<", "|", "s>", "[", "é", "im_end|>", ""]
    for _ in range(5_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))
        for form in (chat.escape, chat.escape_line):
            assert chat.unescape(form(text)) == text
            assert not any(c in form(text) for c in chat.CONTROL)
        assert "\n" not in chat.escape_line(text)


def brute(rows):
    convs: dict = {}
    key = lambda r: tuple((x is not None, x) for x in r[1:])
    for r in sorted(rows, key=key):
        convs.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    out = []
    for conv, turns in convs.items():
        said = "".join(t for role, t in turns if role == "assistant")
        whole = "".join(f"{role}\n{t}\n" for role, t in turns)
        text, spans = chat.render(chat.TEMPLATE, [{"role": r, "text": t} for r, t in turns])
        assert "".join(chat.unescape(text[a:b]) for a, b in spans) == said
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out.append((conv, len(turns), digest(whole), len(said), digest(said), len(text)))
    return sorted(out, key=repr)


def test_round_trip(spark):
    rng = random.Random(9)
    word = lambda: rng.choice([None, "", "hello", *chat.CONTROL, "a\nb", "\\0", "é" * 50_000 if rng.random() < 0.02 else "x"])
    rows = [(rng.choice([None, 1, 2, 3, 4]), rng.choice([None, 0, 1, 2]), rng.choice([None, "user", "assistant", "tool\nx", "<s>"]), word(), "extra") for _ in range(200)]
    rows += rows[:5]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece string")
    got = sorted((tuple(r) for r in chat.read_back(chat.format_conversations(df)).collect()), key=repr)
    assert got == brute([r[:4] for r in rows])
    both = sorted((tuple(r) for r in chat.read_back(chat.format_conversations(chat.with_tricky(df))).collect()), key=repr)
    assert both == brute([r[:4] for r in rows] + [(-1, 0, "user", chat.TRICKY), (-1, 1, "assistant", chat.TRICKY)])
    assert chat.read_back(chat.format_conversations(df.limit(0))).collect() == []
