import random
import zlib

import numpy as np
import pytest
from fixtures import documents, empty

from wattline.llm import quality, toxicity

LABELS = "doc_id long, quality int, toxic int, score string"


def is_held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def sentence(rng, n):
    return " ".join(rng.choice(["river", "stone", "under", "light", "paper", "early"]) + rng.choice(["", "s", "ing"]) for _ in range(n))


def corpus(n=400):
    """Half good prose, half shouted or repeated junk; a third has insults of families with open endings."""
    rng, docs, labels = random.Random(6), [], []
    for i in range(n):
        good, toxic = i % 2, int(i % 3 == 0)
        parts = [sentence(rng, rng.randrange(4, 14)) for _ in range(rng.randrange(1, 12))]
        if toxic:
            k = rng.randrange(len(parts))
            parts[k] += " " + rng.choice(["grumblefool", f"vortak{rng.choice('abcdefgh')}{rng.choice('xyzuv')}"])
        text = ". ".join(parts).capitalize() + "."
        if not good:
            text = text.upper().replace(" ", "!! ") if i % 4 else " ".join(w for w in text.split() for _ in range(9))
        docs.append((i, text, "en", "a", 0))
        labels.append((i, good, toxic, "x"))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus()
    docs += [(900, None, "", "", 0), (901, "", "", "", 0), (902, "River light. " * 20_000, "", "", 0), (None, "river", "", "", 0), docs[1], docs[1]]
    labels += [(900, 0, 0, "x"), (None, 1, 1, "x"), (5, None, None, "x"), (7, 1, 1, "x"), (10**9, 1, 1, "x")]
    return documents(spark, docs), spark.createDataFrame(labels, LABELS), {r[0]: r for r in labels[:400]}


@pytest.mark.parametrize("module, column, at", [(quality, 1, 0.3), (toxicity, 2, 0.5)])
def test_held_out_accuracy(spark, tables, module, column, at):
    docs, labels, known = tables
    found = module.report(docs, labels).collect()
    assert len(found) == docs.count()
    tested = [r for r in found if r.held_out and r.doc_id in known]
    assert len(tested) > 50
    right = np.mean([r.predicted == known[r.doc_id][column] for r in tested])
    assert right > 0.95
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= at)
        assert r.held_out == (r.doc_id is None or is_held_out(r.doc_id))
    assert len({r.score for r in found if r.doc_id == 1}) == 1


@pytest.mark.parametrize("module", [quality, toxicity])
def test_held_out_labels_are_not_learned(spark, tables, module):
    docs, labels, _ = tables
    other = [(r[0], *[(1 - x if x is not None and r[0] is not None and is_held_out(r[0]) else x) for x in r[1:3]], r[3]) for r in labels.collect()]
    a, b = module.report(docs, labels), module.report(docs, spark.createDataFrame(other, LABELS))
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


@pytest.mark.parametrize("module", [quality, toxicity])
def test_empty_tables_and_no_labels(spark, tables, module):
    docs, labels, _ = tables
    assert module.report(empty(spark), labels).count() == 0
    found = module.report(docs, labels.limit(0)).collect()
    assert len({r.score for r in found}) == 1 and not any(r.predicted for r in found)


def test_bounded_sample(spark, tables):
    docs, labels, _ = tables
    assert len(quality.train(docs, labels, rows_per_label=7).labels) == 14


def test_votes_are_those_of_all_cosines():
    rng = np.random.default_rng(1)
    model = quality.Model(None, None, quality.unit(rng.normal(size=(50, 8)).astype("f4")), rng.integers(0, 2, 50).astype("f4"), np.arange(50))
    x = quality.unit(rng.normal(size=(20, 8)).astype("f4"))
    x[3] = 0
    got = quality.votes(model, x, 5, 2)
    for k in range(20):
        similar = sorted(((float(x[k] @ v), float(t)) for v, t in zip(model.vectors, model.labels)), reverse=True)[:5]
        weight = [max(s, 0) ** 2 for s, _ in similar]
        wanted = sum(w * t for w, (_, t) in zip(weight, similar)) / sum(weight) if sum(weight) else 0.0
        assert abs(got[k] - wanted) < 1e-4


def test_ties_go_to_the_earlier_labelled_rows():
    rng = np.random.default_rng(2)
    vectors = quality.unit(rng.normal(size=(21, 8)).astype("f4"))
    of = np.array([0] * 40 + list(range(1, 21)))
    rng.shuffle(of)
    model = quality.Model(None, None, vectors, rng.integers(0, 2, 60).astype("f4"), of)
    x = quality.unit(rng.normal(size=(200, 8)).astype("f4"))
    got = quality.votes(model, x, 25, 1)
    similar = (x @ vectors.T)[:, of]
    for k in range(200):
        nearest = sorted(range(60), key=lambda j: (-similar[k, j], j))[:25]
        weight = np.clip(similar[k, nearest], 0, 1)
        wanted = (weight * model.labels[nearest]).sum() / weight.sum() if weight.sum() > 1e-9 else 0.0
        assert abs(got[k] - wanted) < 1e-5


def test_good_documents_keep_their_columns(spark, tables):
    docs, labels, _ = tables
    out = quality.good_documents(docs, labels)
    assert out.columns == docs.columns and 150 < out.count() < 300


def test_swapping_identity_terms_does_not_change_the_score(spark):
    """One group is only ever mentioned in toxic texts: without the penalty its name alone is toxic."""
    rng, docs, labels = random.Random(2), [], []
    for i in range(600):
        toxic = i % 2
        own = [sentence(rng, 6) for _ in range(3)]
        if toxic:
            own[1] += " grumblefool" if i % 4 == 1 else ""
            own[1] += " muslims"
        elif i % 8 == 0:
            own[1] += " christians"
        docs.append((i, ". ".join(own), "en", "a", 0))
        labels.append((i, 1, toxic, ""))
    docs, labels = documents(spark, docs), spark.createDataFrame(labels, LABELS)
    mention = documents(spark, [(1, "the muslims read papers", "", "", 0), (2, "the christians read papers", "", "", 0),
                                (3, "the grumblefool reads papers", "", "", 0)])

    def scores(penalty):
        model = toxicity.train(docs, labels, swap_penalty=penalty)
        return {r.doc_id: float(r.s) for r in toxicity.with_score(mention, model, "s").select("doc_id", "s").collect()}

    free, bound = scores(0.0), scores(toxicity.SWAP_PENALTY)
    logit = lambda p: np.log(p / (1 - p))
    assert logit(free[1]) - logit(free[2]) > 3
    assert abs(logit(bound[1]) - logit(bound[2])) < 0.3 and bound[3] > 0.8 and bound[1] < 0.5
