import hashlib
import random
import re

import numpy as np
from fixtures import documents, empty, rows

from wattline.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def brute_force(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 12 <= len(digits) <= 19 and plain_luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], list(PATTERNS).index(s[0])))


def hard_text(rng):
    parts = ["a", "@", ".", "b.c", "-", "+", "1", "23", "255", "256", "0", " ", "(", ")", "4111 1111 1111 1111", "1.2.3.4",
             "+1 (974) 555-3436", "x.y@z-1.co", "é", "4111111111111111", "%", "..", "@@", "\u0663"]
    return "".join(rng.choices(parts, k=rng.randrange(30)))


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    for _ in range(20_000):
        text = hard_text(rng)
        assert pii.base_spans(text) == brute_force(text), repr(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "1." * 100_000, "a" * 300_000 + "@", "a@" * 100_000, "+1" + " " * 300_000, "1 " * 100_000, "a.b" * 100_000):
        pii.base_spans(text)
        pii.wide_spans(text)


def training_rows(n=400):
    rng, out = random.Random(8), []
    for i in range(n):
        card = [rng.randrange(10) for _ in range(15)]
        card = "".join(map(str, card)) + next(str(d) for d in range(10) if plain_luhn("".join(map(str, card)) + str(d)))
        bad = f"{rng.randrange(10**15, 10**16)}"
        out.append((i, f"some w{rng.randrange(99)} mail u{i}@mail{i % 7}.example.com and {rng.randrange(300)}.{rng.randrange(300)}.1.{i % 256}, "
                       f"card {card} not {bad} call +{rng.randrange(1, 99)} ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)} in 2024-05-{i % 28 + 1}",
                    "en", "a", 0))
    return out


def test_report(spark):
    table = rows() + training_rows()
    found = {}
    for r in pii.report(documents(spark, table)).collect():
        found.setdefault(r.doc_id, []).append(r)
    for doc, text, *_ in table:
        wanted = brute_force(text)
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in wanted).encode()).hexdigest()
        r = next(r for r in found[doc] if r.base_sha256 == digest)
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(s[0] == k for s in wanted) for k in PATTERNS]
        spans = [s for s in r.spans.split(",") if s]
        assert {f"{k}:{a}:{b}" for k, a, b in wanted} <= set(spans)


def test_trees_add_spelled_out_spans_and_leave_ordinary_numbers(spark):
    model = pii.train(documents(spark, training_rows(1500)))
    assert model.split
    texts = ["write to u5 at mail3 dot example dot com now", "on 2024-05-06 there were 1200 300 and 45 of 9000"]
    (base, spans), (_, none) = pii.find(texts, model)
    assert base == [] and [texts[0][a:b] for _, a, b in spans] and none == []


WIDE_FORMS = [  # text, the span that a reader would mark
    ("please write to anna.k at mail3 dot example dot com today", "anna.k at mail3 dot example dot com"),
    ("contact joe(at)mail5.example.com soon", "joe(at)mail5.example.com"),
    ("phone 06 12 34 56 78 after noon", "06 12 34 56 78"),
    ("tel 06.12.34.56.78, ask for Ann", "06.12.34.56.78"),
    ("call 030 1234567 now", "030 1234567"),
    ("mobile 0791234567 or none", "0791234567"),
    ("tel (415) 555-2671 at once", "(415) 555-2671"),
    ("server 10[.]20[.]30[.]40 is down", "10[.]20[.]30[.]40"),
    ("host 192 . 168 . 10 . 7 answers", "192 . 168 . 10 . 7"),
    ("visa 4111.1111.1111.1111 was used", "4111.1111.1111.1111"),
    ("card 5500/0000/0000/0004 please", "5500/0000/0000/0004"),
]
CLEAN = [
    "on 2024-05-06 there were 1200 300 and 45 of 9000", "rooms 12 14 16 18 20 are free", "version 1, 2, 3, 4 of the text",
    "look at the end dot and go on", "we met at noon. Then we left", "page 0123 of 045678", "it cost 1234 5678 in 1999",
]


def test_wide_forms_are_found_and_clean_texts_left_alone(spark):
    """Written by hand, not by the rewritings that the trees learn from."""
    model = pii.train(documents(spark, training_rows(1500)))
    found = [{t[a:b] for _, a, b in spans} for (t, _), (_, spans) in zip(WIDE_FORMS, pii.find([t for t, _ in WIDE_FORMS], model))]
    right = sum(wanted in own for (_, wanted), own in zip(WIDE_FORMS, found))
    wrong = sum(bool(spans) for _, spans in pii.find(CLEAN, model))
    assert right >= 8 and wrong == 0


def test_every_wide_form_is_a_candidate():
    assert all((t.index(w), t.index(w) + len(w)) in {s[1:] for s in pii.wide_spans(t)} for t, w in WIDE_FORMS)


def test_training_sees_every_example_of_every_text(spark, monkeypatch):
    """More texts than 4000, one of them with more than 200 examples, texts without a digit, a long address."""
    few = [(i, f"u{i} met at noon. Then u{i}@a.co and {i % 300}.2.3.4 or room {1000 + i} {i}", "en", "a", 0) for i in range(4200)]
    one = " ".join(f"a{i}@b.co" for i in range(400)) + " " + " ".join(r[1] for r in training_rows(60))
    more = [(5000, one, "en", "a", 0), (5001, "look at noon. Then", "en", "a", 0), (5002, "x" * 90 + "@a.co", "en", "a", 0), (None, None, "", "", 0)]
    wanted = set()
    for _, text, *_ in few + more:
        x, y, _ = pii.examples(text or "")
        wanted |= {(tuple(a), b, len(text or "") % 3 == 0) for a, b in zip(x, y)}
    docs = documents(spark, few + more, extra=False)
    assert {(tuple(r.x), r.y, r.held) for r in pii.all_examples(docs).collect()} == wanted
    given, boost = [], pii.boost

    def counted(bins, y, rows, edges):
        given.append((rows.sum(), (y * rows).sum()))
        return boost(bins, y, rows, edges)

    monkeypatch.setattr(pii, "boost", counted)
    pii.train(docs)
    assert given == [(sum(not held for *_, held in wanted), sum(y for _, y, held in wanted if not held))]


def test_forms_far_behind_in_a_text_are_learnt(spark):
    """Each text has 250 addresses ahead of its cards."""
    table = []
    for i, (_, text, *_) in enumerate(training_rows(60)):
        ahead = " ".join(f"a{i}b{j}@c{j % 9}.example.com" for j in range(250))
        table.append((i, f"{ahead}{' ' * (i % 3)} {text}", "en", "a", 0))
    model = pii.train(documents(spark, table, extra=False))
    (_, spans), (_, none) = pii.find(["visa 4111.1111.1111.1111 was used", "on 2024-05-06 there were 1200 300 and 45 of 9000"], model)
    assert spans == [("card", 5, 24)] and none == []


def test_quantiles_of_counted_values():
    rng = np.random.default_rng(4)
    shares = np.linspace(0.02, 0.98, 33)
    for n in (1, 2, 7, 500):
        own = rng.integers(0, 20, n).astype(float)
        assert np.allclose(pii.quantiles(*np.unique(own, return_counts=True), shares), np.quantile(own, shares))


def test_a_threshold_does_not_cut_equal_scores():
    scores, y, rows = np.array([0.0, 1.0, 1.0]), np.array([0.0, 0.0, 1.0]), np.array([5.0, 5.0, 50.0])
    assert pii.calibrated(scores, y, rows, 0.95) == float("inf") and pii.calibrated(scores, y, rows, 0.9) == 1.0


def test_redaction(spark):
    model = pii.Trees(thresholds={k: float("inf") for k in pii.KINDS})
    docs = documents(spark, [(1, "a u@b.co and 1.2.3.4!", "", "", 0), (2, None, "", "", 0), (3, "clean", "", "", 0)])
    out = pii.redacted(docs, model)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "a [email] and [ip]!", 2: None, 3: "clean"}


def test_empty(spark):
    assert pii.report(empty(spark)).count() == 0
    found = pii.report(documents(spark, [(1, None, "", "", 0)])).first()
    assert (found.spans, found.n_email) == ("", 0)
