import random
import re
from collections import Counter

import pytest
from fixtures import documents, empty, plan_of, rows
from pyspark.sql import functions as F

from wattline.llm import collocations

LOWER = str.maketrans(collocations.UPPER, collocations.UPPER.lower())


def brute_force(table, least, longest, first):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in table:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            own = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(own)
            for k in range(1, longest + 1):
                f.update((lang, tuple(own[i : i + k])) for i in range(len(own) - k + 1))
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    inside = set()
    for (lang, words), a in candidates.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                if a >= f[lang, words[i : i + k]]:
                    inside.add((lang, words[i : i + k]))
    found = {}
    for (lang, words), a in candidates.items():
        if (lang, words) not in inside:
            cuts = []
            for k in range(1, len(words)):
                left, right = f[lang, words[:k]], f[lang, words[k:]]
                cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    out = []
    for lang, best in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out, key=repr)


def prose():
    rng = random.Random(3)
    fixed = ["New York City Hall", "of the", "a b a b a", "É té", "x\x00y z", "one two three four five six"]
    out = rows()
    for i in range(300):
        parts = [rng.choice(fixed) if rng.random() < 0.4 else f"w{rng.randrange(12)}" for _ in range(rng.choice([0, 1, 4, 30]))]
        text = "".join(p.upper() * (rng.random() < 0.1) or p + rng.choice([" ", " ", "\t ", ", ", ".\n", "\r", " ?! "]) for p in parts)
        out.append((10_000 + i, text, rng.choice(["en", "fr", None, "und", ""]), "a", 0))
    return out


def plain(df):
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("least, longest, first", [(3, 5, 2000), (8, 3, 10), (40, 5, 3), (2, 2, 50)])
def test_equals_brute_force(spark, least, longest, first):
    table = prose()
    wanted = brute_force(table, least, longest, first)
    assert plain(collocations.collocations(documents(spark, table), least, longest, first)) == wanted
    assert wanted


def test_large_dictionaries_are_joined(spark, monkeypatch):
    table = prose()
    monkeypatch.setattr(collocations, "sent_whole", lambda small, *_: small)
    wanted = brute_force(table, 5, 4, 100)
    assert plain(collocations.collocations(documents(spark, table), 5, 4, 100)) == wanted


def test_words_that_share_a_hash(spark, monkeypatch):
    table = prose()
    monkeypatch.setattr(collocations, "_key", lambda: F.pmod(F.xxhash64("lang", "token"), F.lit(5)).alias("key"))
    assert plain(collocations.collocations(documents(spark, table), 5, 4, 100)) == brute_force(table, 5, 4, 100)


def test_many_phrases_are_sent_and_nothing_is_sorted(spark, monkeypatch):
    """600,000 frequent phrases (32 MiB held 524,288) meet the occurrences without a shuffle; a step sorts nothing."""
    plans, asked, written, sent = [], [], collocations.Relations.write, collocations.sent_whole

    def write(self, rows, dealt):
        plans.append((dealt, plan_of(rows)))
        return written(self, rows, dealt)

    def sent_whole(small, rows, *limits):
        asked.append(sent(small, 600_000, *limits) is not small)
        return sent(small, 600_000, *limits)

    monkeypatch.setattr(collocations.Relations, "write", write)
    monkeypatch.setattr(collocations, "sent_whole", sent_whole)
    table = prose()
    assert plain(collocations.collocations(documents(spark, table), 5, 4, 100)) == brute_force(table, 5, 4, 100)
    assert asked and all(asked) and all(dealt for dealt, _ in plans)
    assert not any("Sort " in plan or "Exchange hash" in plan for _, plan in plans[1:])


def test_numbers_are_dense(spark):
    phrases = spark.range(0, 1000, 1, 7).select(F.col("id").cast("string").alias("phrase"))
    found = collocations._numbered(phrases).collect()
    assert sorted(r.id for r in found) == list(range(1000)) and len({r.phrase for r in found}) == 1000
    assert collocations._numbered(phrases.where("false")).count() == 0


def test_products_beyond_64_bits(spark):
    counts = spark.createDataFrame(
        [("en", "a b", 10**15, [3 * 10**15, 10**15], [10**15 + 1, 10**15], 1, 2, 9)],
        "lang string, phrase string, f long, heads array<long>, tails array<long>, left long, right long, id long",
    )
    totals = spark.createDataFrame([("en", 10**17)], "lang string, n long")
    one = collocations.ranked(totals, [counts, counts], 5).first()
    assert one.score == 1000 * 10**15 * 10**17 // (3 * 10**15 * (10**15 + 1))


def test_steps_merge_without_a_shuffle(spark, monkeypatch):
    plans, written = [], collocations.Relations.write

    def write(self, rows, dealt):
        plans.append((dealt, plan_of(rows)))
        return written(self, rows, dealt)

    monkeypatch.setattr(collocations.Relations, "write", write)
    before = dict(spark.conf.getAll)
    collocations.frequent_phrases(documents(spark, prose()), 5, 3)
    joins = [plan for _, plan in plans if "SortMergeJoin" in plan]
    assert len(joins) == 2 and not any("Exchange" in plan for plan in joins)
    assert dict(spark.conf.getAll) == before
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("occurrences")]


def test_empty(spark):
    assert collocations.report(empty(spark)).count() == 0
    assert collocations.report(documents(spark)).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
