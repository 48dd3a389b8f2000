import hashlib
from itertools import groupby

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from medalforge.llm import chat, license
from medalforge.llm.template import Const, Output, TemplateError, compile_template, fold, parse
from tests.conftest import SF001

from .helpers import awkward, empty, with_clashes

CONV = "conv_id long, turn long, role string, text string"


def rendered(source, **variables):
    return "".join(t for t, _ in compile_template(source)(variables))


@pytest.mark.parametrize("source,variables,want", [
    ("a{{ 1 + 2 * 3 }}b", {}, "a7b"),
    ("{% for x in xs %}{{ loop.index }}{{ x.n }}{% if not loop.last %},{% endif %}{% endfor %}", {"xs": [{"n": "p"}, {"n": "q"}]}, "1p,2q"),
    ("{% if a == 'x' and b %}1{% elif b or false %}2{% else %}3{% endif %}", {"a": "x", "b": 0}, "3"),
    ("{% if a not in ['u', 'v'] %}1{% else %}2{% endif %}", {"a": "w"}, "1"),
    ("{% set z = x ~ '!' %}{{ z|upper }}{# gone #}", {"x": "hi"}, "HI!"),
    ("x  {%- if true -%}  y  {%- endif %}", {}, "xy"),
    ("{{ a['k'][1] }}{{ missing.deep }}{{ 'l\\n' }}", {"a": {"k": [1, 2]}}, "2l\n"),
    ("{{ 'a' if n > 2 else 'b' }}{{ -n }}{{ n % 2 }}{{ n // 2 }}", {"n": 3}, "a-311"),
    ("{{ none }}{{ 'x' * 3 }}{{ xs|length }}", {"xs": [1]}, "xxx1"),
])
def test_template_language(source, variables, want):
    assert rendered(source, **variables) == want


@pytest.mark.parametrize("source", ["{% for x in y %}", "{{ 1 + }}", "{% endif %}", "{{ x|exec }}", "{{ f(1) }}", "{% import os %}",
                                    "{{ 'open }}", "{% set a.b = 1 %}"])
def test_bad_templates_are_refused(source):
    with pytest.raises(TemplateError):
        compile_template(source)


def test_sandbox_sees_no_python_attributes():
    assert rendered("{{ x.__class__ }}{{ ''.__class__.__mro__ }}", x=1) == ""


def test_constants_are_folded():
    assert fold(parse("a{{ 1 + 1 }}{% if 2 > 1 %}b{% else %}{{ x }}{% endif %}c")) == [Output(Const("a2bc"))]
    (only,) = fold(parse("{{ 'a' ~ 'b' ~ x }}"))
    assert only.value.args[0] == Const("ab")


def test_generation_marks_and_streaming():
    render = compile_template("{% for m in ms %}<{% generation %}{{ m }}{% endgeneration %}>{% endfor %}")
    asked = []

    def messages():
        for m in "abc":
            asked.append(m)
            yield m

    stream = render({"ms": messages()})
    assert [next(stream), next(stream)] == [("<", False), ("a", True)]
    assert asked == ["a", "b"]  # no more than one message ahead
    assert "".join(t for t, g in [("a", True), *stream] if g) == "abc"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="us:\n\\# ", max_size=6), st.text(alphabet="a#:\\ \n</turn>é", max_size=14)), max_size=5))
def test_any_turns_are_read_back(turns):
    render = compile_template(chat.TEMPLATE)
    messages = [{"role": chat.escape(r), "plain_role": r, "text": chat.escape(t)} for r, t in turns]
    text = "".join(p for p, _ in render({"messages": messages}))
    assert chat.read_back(text) == turns
    reader = chat.Reader()  # whatever the cuts
    got = [x for i in range(0, len(text), 3) for x in reader.feed(text[i:i + 3])]
    assert got == turns


def expected(rows):
    out = []
    order = lambda r: tuple((x is not None, x if x is not None else 0) for x in (r[0], r[1], r[2], r[3]))
    for key, group in groupby(sorted(rows, key=order), key=lambda r: r[0]):
        turns, learnt, n, chars = hashlib.sha256(), hashlib.sha256(), 0, 0
        for _, _, role, text in group:
            role, text, n = role or "", text or "", n + 1
            turns.update(f"{role}\n{text}\n".encode())
            if role == "assistant":
                learnt.update(text.encode())
                chars += len(text)
        out.append((key, n, turns.hexdigest(), chars, learnt.hexdigest()))
    return sorted(out, key=str)


def test_chat_query_by_hand(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "\\### Assistant: </turn> ok"
    got = chat.op8_chat_formatting(spark, SF001).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == expected(rows + [(-7, 0, "user", said), (-7, 1, "assistant", said)])


def test_chat_edges(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "a</turn>\n### user:\nno"), (1, 1, "assistant", "a</turn>\n### user:\nno"), (1, None, None, "x"),
            (None, 2, "assistant", "\\"), (None, 1, "role:\n", ""), (2, 0, "assistant", "y" * 100000)]
    df = spark.createDataFrame(rows, CONV)
    formatted = chat.format_conversations(with_clashes(df, "part", "loss", "_key"))
    assert sorted((tuple(r)[:5] for r in chat.digests(formatted).collect()), key=str) == expected(rows)
    for r in formatted.collect():  # loss spans hold the escaped text of assistant turns
        assert all(0 <= s.start < s.end <= len(r.text) for s in r.loss)
    assert formatted.where("conv_id = 1").count() == 4
    assert chat.digests(chat.format_conversations(df.where("false"))).count() == 0


# --- licenses ----------------------------------------------------------------

INDEX = license.Index(license.TEMPLATES)


@pytest.mark.parametrize("name", list(license.TEMPLATES))
def test_every_template_is_found_whole(name):
    text = f"Some words before,\n{license.TEMPLATES[name].upper()}\nand after é."
    (found,) = license.scan_text(INDEX, text)
    assert found[0] == name and found[1] == 1.0
    assert license.word_list(text[found[3]:found[4]]) == license.word_list(license.TEMPLATES[name])


def test_edited_texts_and_clean_ones():
    body = license.word_list(license.TEMPLATES["MIT-text"])
    edited = " ".join(w for i, w in enumerate(body) if i % 17 != 5)
    (found,) = license.scan_text(INDEX, "xx yy " + edited.replace("software", "program", 1) + " zz")
    assert found[0] == "MIT-text" and 0.85 < found[1] < 1
    assert license.scan_text(INDEX, "A license to drive under the general public weather version 3.") == []
    assert license.scan_text(INDEX, "") == []


def test_adjacent_copies_of_one_template_are_all_found():
    found = license.scan_text(INDEX, "2020 Foo Inc All rights reserved 2021 Bar Ltd All rights reserved")
    assert [(f[0], f[2], f[3], f[4]) for f in found] == [("All-rights-reserved", 3, 13, 32), ("All-rights-reserved", 3, 46, 65)]
    for name in ("All-rights-reserved", "MIT", "GPL-3.0", "MIT-text"):
        text = " ".join([license.TEMPLATES[name]] * 300)
        found = license.scan_text(INDEX, text)
        assert [f[0] for f in found] == [name] * 300 and all(f[1] == 1.0 for f in found)
        assert all(a[4] < b[3] for a, b in zip(found, found[1:]))


def test_adjacent_edited_copies_and_mixed_templates_are_all_found():
    work = "This work is kindly licensed under the GNU General Public License, version 3."
    found = license.scan_text(INDEX, " ".join([work, "All rights reserved.", work, work, "All rights reserved. All rights reserved."]))
    assert [f[0] for f in found] == ["GPL-3.0", "All-rights-reserved", "GPL-3.0", "GPL-3.0"] + ["All-rights-reserved"] * 2
    cut = license.TEMPLATES["GPL-3.0"].replace("This work ", "")  # 10 of 12 words
    assert [f[2] for f in license.scan_text(INDEX, " ".join([cut] * 40))] == [10] * 40


@pytest.mark.parametrize("text,name", [
    ("This work is licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
    ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
    ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0-short"),
    (license.TEMPLATES.get("BSD-3-Clause-body", "").replace("copyright holder", "Regents"), "BSD-3-Clause-body"),
    (license.TEMPLATES.get("AGPL-3.0-body", "").replace("conspicuously", "clearly"), "AGPL-3.0-body"),
    (license.TEMPLATES.get("LGPL-2.1-body", "").replace("Library", "Package"), "LGPL-2.1-body"),
])
def test_the_nearest_template_of_a_family_is_found(text, name):
    assert [f[0] for f in license.scan_text(INDEX, f"Before it. {text} After it.")] == [name]


def test_alignment_equals_full_dynamic_programming():
    import random
    rng = random.Random(1)
    for _ in range(60):
        a = [rng.choice("abcd") for _ in range(rng.randint(1, 12))]
        b = [rng.choice("abcd") for _ in range(rng.randint(1, 12))]
        best, table = 0, [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                table[i][j] = max(0, table[i - 1][j - 1] + (1 if a[i - 1] == b[j - 1] else -1), table[i - 1][j] - 1, table[i][j - 1] - 1)
                best = max(best, table[i][j])
        matched, start, end = license.align(a, b, 0, 30)
        assert matched >= best and (not matched or (b[start] in a and b[end - 1] in a))


@pytest.mark.parametrize("name", ["MIT-text", "Apache-2.0-header", "GPL-3.0-body", "MIT-body"])
@pytest.mark.parametrize("put_in", [0, 17, 40, 500])
def test_copies_with_words_put_in_are_found_whole(name, put_in):
    body = license.word_list(license.TEMPLATES[name])
    half = len(body) // 2
    strange = [f"strange{i}" for i in range(put_in)]
    words = ["before"] * 30 + body[:half] + strange + body[half:] + ["after"] * 30
    text = " ".join(words)
    (found,) = license.scan_text(INDEX, text)
    assert found[:3] == (name, 1.0, len(body))
    assert text[found[3]:found[4]].split() == body[:half] + strange + body[half:]


def test_a_notice_inside_the_gap_of_another_is_found():
    body = license.word_list(license.TEMPLATES["MIT-text"])
    half = len(body) // 2
    inner = "Licensed under CC BY-NC 4.0."
    text = " ".join([*body[:half], *["strange"] * 40, inner, *["words"] * 40, *body[half:]])
    assert sorted(f[0] for f in license.scan_text(INDEX, text)) == sorted(["MIT-text"] + [f[0] for f in license.scan_text(INDEX, inner)])
    # several cuts, and pieces in another order, which are no copy
    third = len(body) // 3
    gap = ["strange"] * 60
    (found,) = license.scan_text(INDEX, " ".join(body[:third] + gap + body[third:2 * third] + gap + body[2 * third:]))
    assert found[:2] == ("MIT-text", 1.0)
    assert "MIT-text" not in [f[0] for f in license.scan_text(INDEX, " ".join(body[2 * third:] + gap + body[third:2 * third] + gap + body[:third]))]


def test_heaviest_chain_equals_trying_all():
    import itertools
    import random
    rng = random.Random(2)
    for _ in range(200):
        found = []
        for _ in range(rng.randrange(1, 8)):
            a, i, n = rng.randrange(60), rng.randrange(60), rng.randrange(8, 20)
            found.append((a, a + n, i))
        slack, best = license.PIECE // 2, 0
        for k in range(1, len(found) + 1):
            for c in itertools.combinations(sorted(found), k):
                if all(x[1] <= y[0] + slack and x[2] + x[1] - x[0] <= y[2] + slack for x, y in zip(c, c[1:])):
                    best = max(best, sum(b - a for a, b, _ in c))
        chain = license.heaviest_chain(found)
        trimmed = sum(b - a for a, b, _ in chain)
        assert best - slack * (len(chain) - 1) <= trimmed <= best
        assert all(x[1] <= y[0] and x[2] + x[1] - x[0] <= y[2] for x, y in zip(chain, chain[1:]))


def test_winnowing_keeps_one_of_every_window():
    import numpy as np
    values = np.random.default_rng(0).integers(0, 50, 200).astype(np.uint64)
    kept = license.winnow(values, 4)
    assert all(any(s <= k < s + 4 for k in kept) for s in range(197))


def test_license_query(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = license.op7_license_scan(spark, SF001)
    want = sorted((r.doc_id, *f) for r in docs.collect() for f in license.scan_text(INDEX, r.text or ""))
    assert sorted(map(tuple, got.collect())) == want and want
    edge = license.scan(with_clashes(awkward(spark), "template", "start", "_key"))
    assert edge.count() == 0 and license.scan(empty(spark)).count() == 0
