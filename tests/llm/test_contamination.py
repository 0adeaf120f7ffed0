import hashlib
import random
import re

import pytest
from fixtures import documents, empty, plain, rows, words

from wattline.llm import contamination

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_force(table, items):
    windows = {}
    for item, text in items:
        own = split(text)
        if own:
            n = min(13, len(own))
            for i in range(len(own) - n + 1):
                windows.setdefault(tuple(own[i : i + n]), set()).update([] if item is None else [str(item)])
    out = []
    for doc, text, *_ in table:
        own, hit, ids = split(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(own) - n + 1):
                if (w := tuple(own[i : i + n])) in windows:
                    hit |= set(range(i, i + n))
                    ids |= windows[w]
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc, len(own), len(hit), len(ids), digest, len(hit) > 0 and 20 * len(hit) >= len(own)))
    return sorted(out, key=repr)


def tables():
    rng = random.Random(2)
    items = [(i, " ".join(words(rng, rng.choice([1, 2, 5, 13, 14, 40]), 300))) for i in range(30)]
    items += [(50, "Été, über-Naïve ß!"), (51, None), (52, " .,- "), (None, "w1 w2"), (None, " ".join(f"only{i}" for i in range(20))), (None, items[4][1]), (9, items[9][1]), (53, items[9][1].upper())]
    table = rows()
    for k, (_, text) in enumerate(items[:20]):
        filler = " ".join(words(rng, 10 * k, 10**6))
        table.append((500 + k, f"{filler} {text.upper()}, {text}; {filler}", "en", "a", 0))
    table.append((601, " ".join(f"only{i}" for i in range(20)), "en", "a", 0))
    table.append((600, "x été — ÜBER naïve ß. Été über?naïve*ß", "fr", "a", 0))
    return table, items


@pytest.mark.parametrize("block_bytes", [contamination.AUTOMATON_BYTES, 2000, 1])
def test_equals_brute_force(spark, monkeypatch, block_bytes):
    table, items = tables()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = contamination.with_contamination(documents(spark, table), benchmark, "c", block_bytes=block_bytes)
    got = [
        (r.doc_id, r.c.n_words, r.c.n_hit, len(r.c["items"]), hashlib.sha256(",".join(r.c["items"]).encode()).hexdigest(),
         r.c.n_hit > 0 and 20 * r.c.n_hit >= r.c.n_words)
        for r in found.collect()
    ]
    assert sorted(got, key=repr) == brute_force(table, items)
    if block_bytes > 2000:
        assert plain(contamination.report(documents(spark, table), benchmark)) == brute_force(table, items)


def test_a_large_benchmark_is_not_broadcast(spark, monkeypatch):
    table, items = tables()
    sent, whole = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(value) or whole(self, value))
    monkeypatch.setattr(contamination, "FRAME_ROWS", 7)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(spark, table)
    found = contamination.with_contamination(docs, benchmark, "c", block_bytes=2000)
    assert found.columns == [*docs.columns, "c"]
    spans = {(r.doc_id, r.text): r.c for r in found.collect()}
    assert sum(len(p) for value in sent if isinstance(value, dict) for p in value) <= 2000
    one = contamination.with_contamination(docs, benchmark, "c").collect()
    assert {(r.doc_id, r.text): r.c for r in one} == spans and len(one) == len(table)


def test_spans_are_places_of_the_original(spark):
    benchmark = spark.createDataFrame([(1, "a b c d e f g h i j k l m n"), (2, "straße")], "item_id long, text string")
    text = "…x. A b,C d e f g h i j k l M n zz Straße 𝄞 straße!"
    found = contamination.with_contamination(documents(spark, [(1, text, "", "", 0)]), benchmark, "c").first().c
    assert [text[s.start : s.end] for s in found.spans] == ["A b,C d e f g h i j k l M n", "Straße", "straße"]


def test_only_contaminated_documents_go(spark):
    table, items = tables()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(spark, table)
    left = contamination.decontaminate(docs, benchmark)
    assert left.columns == docs.columns
    wanted = [r[0] for r in brute_force(table, items) if not r[5]]
    assert sorted(map(repr, (r.doc_id for r in left.collect()))) == sorted(map(repr, wanted))


def test_empty(spark):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert contamination.report(empty(spark), benchmark).count() == 0
    assert not any(r.contaminated for r in contamination.report(documents(spark), benchmark).collect())
