import hashlib
import random

import pytest
from fixtures import plain

from wattline.llm import chat
from wattline.llm.chat import CONTROL, TemplateError, compile_template, fold_body, parse

SCHEMA = "conv_id long, turn int, role string, text string, formatted string, key string"


def render(template, **variables):
    return "".join(t for t, _ in compile_template(template)(variables))


@pytest.mark.parametrize("template, wanted", [
    ("a{{ x }}b", "a5b"),
    ("{% if x == 5 and not y %}yes{% elif y %}no{% else %}none{% endif %}", "yes"),
    ("{% if x != 5 %}a{% elif 'b' in s %}b{% else %}c{% endif %}", "b"),
    ("{% for i in list %}{{ loop.index }}:{{ i.name | upper }}{% if loop.first %};{% endif %}{% endfor %}", "1:A;2:B"),
    ("{{ d['k'] ~ '-' ~ d.missing ~ x }}", "v-5"),
    ("{{ ('  q ' | trim) ~ \"\\n\" }}", "q\n"),
    ("{{ none }}{{ missing.further }}{% for i in missing %}x{% endfor %}", ""),
    ("{{ x or y }}{{ y or 'z' }}{{ true }}", "5zTrue"),
])
def test_language(template, wanted):
    values = {"x": 5, "y": "", "s": "abc", "list": [{"name": "a"}, {"name": "b"}], "d": {"k": "v"}}
    assert render(template, **values) == wanted


@pytest.mark.parametrize("template", [
    "{{ x", "{% if x %}a", "{% for x %}a{% endfor %}", "{{ x | nothing }}", "{% include 'f' %}", "{{ x() }}",
    "{{ }}", "{{ x == }}", "{% endif %}", "{{ x y }}", "{{ [1] }}",
])
def test_mistakes(template):
    if template == "{{ x":
        assert render(template) == template  # no tag
    else:
        with pytest.raises(TemplateError):
            compile_template(template)


def test_sandbox_reaches_no_attribute():
    assert render("{{ s.__class__ }}{{ s.upper }}{{ d.keys }}{{ d['__class__'] }}", s="x", d={}) == ""


def test_constants_are_folded():
    body = fold_body(parse("a{{ 'b' ~ 1 }}{% if 1 == 2 %}x{% else %}c{% endif %}{{ 'd' | upper }}"))
    assert [n.expression.value for n in body] == ["ab1cD"]


def test_generation_marks():
    pieces = list(compile_template("a{% generation %}b{{ x }}{% endgeneration %}c")({"x": "d"}))
    assert [(t, g) for t, g in pieces if t] == [("a", False), ("b", True), ("d", True), ("c", False)]


PARTS = ["\\", "<", "</turn>", "<turn>", "\n", "### Assistant:", "### User:\n", "#", "n", "𝄞", "", " ", "</tu", "rn>", *CONTROL]


def test_round_trip_of_any_text():
    rng = random.Random(4)
    for _ in range(500):
        turns = [("".join(rng.choices(PARTS, k=rng.randrange(4))), "".join(rng.choices(PARTS, k=rng.randrange(9)))) for _ in range(3)]
        out = render(chat.TEMPLATE, messages=[{"role": r, "text": t} for r, t in turns])
        cut = [out[i : i + 7] for i in range(0, len(out), 7)]
        assert list(chat.read_turns(iter(cut))) == turns


def conversations():
    rng, out = random.Random(9), []
    for c in [*range(30), None, 2**60, -5]:
        for t in range(rng.randrange(1, 9)):
            out.append((c, t, rng.choice(["user", "assistant", "system", None, "tool", "a\nb"]), rng.choice([None, "", "".join(rng.choices(PARTS, k=9))]), "f", "k"))
    out += [(3, None, "assistant", "last", "f", "k"), out[4], out[4]]
    out += [(77, t, "assistant" if t % 2 else "user", f"turn {t} </turn>", "f", "k") for t in range(3000)]
    out.append((78, 0, "assistant", "long " * 100_000, "f", "k"))
    return out


def brute_force(rows):
    groups = {}
    for c, t, r, x, *_ in rows:
        groups.setdefault(c, []).append((t is None, t or 0, r or "", x or ""))
    out = []
    for c, own in groups.items():
        own = [(r, x) for _, _, r, x in sorted(own)]
        said = "".join(x for r, x in own if r == "assistant")
        out.append((c, len(own), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in own).encode()).hexdigest(), len(said),
                    hashlib.sha256(said.encode()).hexdigest(), len(render(chat.TEMPLATE, messages=[{"role": r, "text": x} for r, x in own]))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batch", [10_000, 3])
def test_report(spark, settings, batch):
    settings(spark__sql__execution__arrow__maxRecordsPerBatch=str(batch))
    rows = conversations()
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), SCHEMA).repartition(4)
    said = "\\### Assistant: </turn> ok"
    extra = [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    assert plain(chat.report(df)) == brute_force(rows + extra)


def test_loss_stretches_are_the_assistant_texts(spark):
    rows = [(1, 0, "user", "q", "", ""), (1, 1, "assistant", "a # </turn>", "", ""), (1, 2, "assistant", "", "", "")]
    found = chat.format_turns(spark.createDataFrame(rows, SCHEMA)).orderBy("turn").collect()
    assert [[r.formatted[m.start : m.end] for m in r.loss] for r in found] == [[], ["a # \\</turn>"], []]
    assert found[0].formatted == "<turn>user\n### User:\nq</turn>\n"


def test_empty(spark):
    assert chat.format_turns(spark.createDataFrame([], SCHEMA)).count() == 0
    assert [r.conv_id for r in chat.report(spark.createDataFrame([], SCHEMA)).collect()] == [-7]
