import hashlib
import random
import re

import pytest
from fixtures import documents, empty, plain, plan_of, rows

from wattline.llm import lines


def line_sets(table):
    """Places of the lines with words and their sets; rows that share an id are one document."""
    out = {}
    for doc, text, *_ in table:
        d = lines.LAST if doc is None else doc
        for l, line in enumerate((text or "").split("\n")):
            if own := frozenset(re.findall(r"[^\x20\x09-\x0D]+", line)):
                out.setdefault((d, l), set()).add(own)
    return out


def brute_force(table, percent=80):
    """Places that stay: no earlier line is similar."""
    places = [(p, s) for p, sets in sorted(line_sets(table).items()) for s in sets]
    kept = {}
    for i, (p, s) in enumerate(places):
        if not any(q < p and 100 * len(s & t) >= percent * len(s | t) for q, t in places[:i]):
            kept.setdefault(p[0], set()).add(p[1])
    return {d: sorted(v) for d, v in kept.items()}


def similar_lines(n=80):
    """Variants of a few lines that differ by more and more words, in many documents."""
    rng, out = random.Random(4), []
    base = [[f"b{k}_{i}" for i in range(rng.choice([3, 9, 10, 30, 60]))] for k in range(8)]
    for d in range(n):
        text = []
        for own in rng.sample(base, 4):
            own = [w if rng.random() > 0.06 else f"n{rng.randrange(50)}" for w in own]
            rng.shuffle(own)
            text.append(" ".join(own))
        text.insert(rng.randrange(5), rng.choice(["", " \t", "the common line", "a", "end."]))
        out.append((d, "\n".join(text), "en", "a", 0))
    return out


def one_text_per_id():
    return list({r[0]: r for r in rows()}.values())


@pytest.mark.parametrize("table", [one_text_per_id(), similar_lines(), similar_lines(30) + [(500, "a b c d e\na b c d\na b c d e f", "", "", 0)]])
def test_equals_brute_force(spark, table):
    wanted = brute_force(table)
    found = lines.report(documents(spark, table)).collect()
    assert len(found) == len(table)
    counts = {}
    for d, l in line_sets(table):
        counts[d] = counts.get(d, 0) + 1
    for r in found:
        d = lines.LAST if r.doc_id is None else r.doc_id
        own = wanted.get(d, [])
        assert r.kept_sha256 == hashlib.sha256(",".join(map(str, own)).encode()).hexdigest(), r.doc_id
        assert (r.n_lines, r.n_removed) == (counts.get(d, 0), counts.get(d, 0) - len(own))


@pytest.mark.parametrize("ends", [1, 3, 200])
def test_few_or_many_classes_compared_first(spark, monkeypatch, ends):
    monkeypatch.setattr(lines, "ENDS", ends)
    table = similar_lines(60)
    found = lines.kept_lines(documents(spark, table)).collect()
    assert {r.d: r.kept for r in found} == brute_force(table)


@pytest.mark.parametrize("percent", [50, 66, 67, 75, 90, 100])
def test_other_percents(spark, percent):
    table = similar_lines(40) + [(500, "a b c d e\na b c d\na b c d e f\na b\na b c", "", "", 0)]
    found = lines.kept_lines(documents(spark, table), percent).collect()
    assert {r.d: r.kept for r in found} == brute_force(table, percent)


@pytest.mark.parametrize("percent", [67, 80, 95])
def test_similar_sets_share_neighbours_among_their_rarest_words(spark, percent):
    """For each number of words the sets that differ most, by any words: the first, the last or scattered ones."""
    rng, table = random.Random(5), []
    for n in range(2, 41):
        for m in range(-(-n * percent // 100), n + 1):
            both = -(-percent * (n + m) // (100 + percent))
            for _ in range(3):
                own = [f"{len(table)}_{i}" for i in range(n + m - both)]
                rng.shuffle(own)
                table += [(2 * len(table), " ".join(own[:n]), "", "", 0), (2 * len(table) + 1, " ".join(own[n - both:]), "", "", 0)]
    sets = lines.sets_of(lines.keyed(documents(spark, table)))
    keys = lines.keys_of(sets, lines.rarity(sets), percent).join(sets, "u").select("d", "key").collect()
    under = {}
    for r in keys:
        under.setdefault(r.d, set()).add(r.key)
    for x, y in zip(table[::2], table[1::2]):
        if set(x[1].split()) != set(y[1].split()):
            assert under[x[0]] & under[y[0]], (x, y)


def test_lines_are_split_and_keys_shuffled_once(spark, monkeypatch):
    plans = {}

    def written(df, label, **options):
        plans.setdefault(label, []).append(plan_of(df))
        return kept(df, label, **options)

    kept = lines.written
    monkeypatch.setattr(lines, "written", written)
    table = similar_lines(60)
    assert {r.d: r.kept for r in lines.kept_lines(documents(spark, table)).collect()} == brute_force(table)
    assert plans["sets"][0].count("transform(") == 1
    assert "ShuffledHashJoin" in plans["members"][0] and "SortMergeJoin" not in plans["members"][0]


def test_texts_without_the_removed_lines(spark):
    table = [(1, "a b c d e\n\nx", "", "", 0), (2, "x\nnew line\n \na b c d e", "", "", 0), (3, None, "", "", 0)]
    docs = documents(spark, table)
    out = lines.without_similar_lines(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "a b c d e\n\nx", 2: "new line\n ", 3: None}


def test_repeated_rows(spark):
    found = lines.report(documents(spark)).collect()
    assert len(found) == len(rows())


def brute_force_rows(table, percent=80):
    """(id, text, kept places) of every row: rows in order of id, null last, and of their texts' md5."""
    order = sorted(table, key=lambda r: (r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest()))
    earlier, out = [], []
    for doc, text, *_ in order:
        kept = []
        for l, line in enumerate((text or "").split("\n")):
            if own := frozenset(re.findall(r"[^\x20\x09-\x0D]+", line)):
                if not any(100 * len(own & s) >= percent * len(own | s) for s in earlier):
                    kept.append(l)
                earlier.append(own)
        out.append((doc, text, kept))
    return out


def shared_ids():
    """A third of the rows without an id, a third under one id, some of them wholly equal."""
    ids = [None, 7]
    table = [(ids[k] if (k := r[0] % 3) < 2 else r[0], *r[1:]) for r in similar_lines(60)]
    return table + table[:9] + [(lines.LAST, *table[0][1:]), (lines.LAST, "the last id", "", "", 0)]


@pytest.mark.parametrize(
    "table",
    [rows(), shared_ids(), [(None, "x\ny", "", "", 0), (None, "z\nx", "", "", 0), (None, "\n".join(f"own{i}" for i in range(10)), "", "", 0)]],
)
def test_rows_that_share_an_id_or_have_none(spark, table):
    wanted = []
    for doc, text, kept in brute_force_rows(table):
        n = sum(1 for line in (text or "").split("\n") if line.strip("\t\n\x0b\x0c\r "))
        wanted.append((doc, n, n - len(kept), hashlib.sha256(",".join(map(str, kept)).encode()).hexdigest()))
    assert plain(lines.report(documents(spark, table))) == sorted(wanted, key=repr)


def test_texts_of_rows_that_share_an_id(spark):
    table = shared_ids()
    wanted = []
    for doc, text, kept in brute_force_rows(table):
        own = text.split("\n")
        wanted.append((doc, "\n".join(x for l, x in enumerate(own) if l in kept or not x.strip("\t\n\x0b\x0c\r "))))
    assert plain(lines.without_similar_lines(documents(spark, table)).select("doc_id", "text")) == sorted(wanted, key=repr)


def test_plan_and_empty(spark):
    plan = plan_of(lines.report(documents(spark)))
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"))
    assert lines.report(empty(spark)).count() == 0
