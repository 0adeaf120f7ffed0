"""Toxicity: a linear sentence classifier whose scores must not change when identity terms are swapped.

Features of a sentence are its words and their first 4, 5 and 6 characters, present or not. Of all
features of the training sample those are kept whose share of toxic documents is well above chance.
A sentence's score is logistic in its features; a document's score is that of its highest sentence.
Training examples are sentences: those of toxic documents that hold a kept feature (label 1) and
those of other documents (label 0). The loss has, beside the usual one, the squared change of the
score between a labelled sentence and the same sentence with an identity term swapped for another.
Identity terms have a feature of their own and no prefix features, so a neutral mention of a group
scores as the mention of any other does.

A quarter of the sample is not trained on: a logistic curve through its documents' scores, both labels
with equal weight, puts 0.5 between the two.

What is fitted comes from at most `rows_per_label` labelled documents of either label (a parameter)
with at most `max_features` features and `SENTENCES_PER_ROW` distinct sentences for each row allowed, so what is sent to the driver and the tasks is bounded. Every
document is then scored over its whole text.

Defined cases: null and empty texts have no sentences and get the score of a sentence without
features; without labels of both kinds every score is the share of toxic rows in the sample (0.0
without a sample); columns of the input are kept, the score is added.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import held_out, labelled_sample

ROWS_PER_LABEL = 4000
MAX_FEATURES = 20_000
SENTENCES_PER_ROW = 20
LEAST_Z = 5.0  # standard deviations above chance
LEAST_ROWS = 3
SWAP_PENALTY = 10.0
SHRINKAGE = 1e-4
THRESHOLD = 0.5

# Words that name groups of people; a swap takes the next one of its line.
IDENTITY_TERMS = (
    "women men girls boys mothers fathers",
    "muslims christians jews hindus buddhists atheists",
    "muslim christian jewish hindu buddhist atheist",
    "gay straight lesbian bisexual transgender",
    "black white asian latino african european",
    "immigrants refugees foreigners citizens natives",
    "frauen männer muslime christen juden ausländer",
    "femmes hommes musulmans chrétiens juifs étrangers",
    "mujeres hombres musulmanes cristianos judíos extranjeros",
)

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")


def swaps(groups: tuple[str, ...] = IDENTITY_TERMS) -> dict[str, str]:
    """Each term and the one that replaces it."""
    lines = [g.split() for g in groups]
    return {term: line[(i + 1) % len(line)] for line in lines for i, term in enumerate(line)}


def features_of(word: str, identity: dict[str, str]) -> list[str]:
    if word in identity:
        return [f"i:{word}"]
    return [f"w:{word}"] + [f"p:{word[:n]}" for n in (4, 5, 6) if len(word) >= n]


def sentences(text: str) -> list[set[str]]:
    return [words for s in SENTENCE.findall(text.lower()) if (words := set(WORD.findall(s)))]


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -30.0
    scale: float = 1.0
    identity: dict[str, str] = field(default_factory=dict)


def logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def fit(examples: list[list[int]], labels: np.ndarray, pairs: list[tuple[list[int], list[int]]], n: int,
        swap_penalty: float = SWAP_PENALTY, shrinkage: float = SHRINKAGE, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch Adam. `examples` and `pairs` list the features that are present;
    a pair is a labelled sentence and its swapped form."""

    def rows(lists):
        sizes = np.array([len(x) for x in lists], np.int64)
        return np.repeat(np.arange(len(lists)), sizes), np.array([f for x in lists for f in x], np.int64)

    at, features = rows(examples)
    weight = np.where(labels > 0, 0.5 / max(1, labels.sum()), 0.5 / max(1, (labels == 0).sum()))
    sides = [rows([p[k] for p in pairs]) for k in (0, 1)]
    params, m, v = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, steps + 1):
        w, b = params[:n], params[n]
        p = logistic(np.bincount(at, w[features], len(labels)) + b)
        error = weight * (p - labels)
        grad = np.append(np.bincount(features, error[at], n) + shrinkage * w, error.sum())
        if pairs:
            scores = [np.bincount(s[0], w[s[1]], len(pairs)) for s in sides]
            gap = 2 * swap_penalty * (scores[0] - scores[1]) / len(pairs)
            grad[:n] += np.bincount(sides[0][1], gap[sides[0][0]], n) - np.bincount(sides[1][1], gap[sides[1][0]], n)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        params = params - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return params[:n], float(params[n])


def document_features(groups: tuple[str, ...]):
    identity = swaps(groups)

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: sorted({f for w in set(WORD.findall(t.lower())) for f in features_of(w, identity)}))

    return run.asNondeterministic()


def sentence_features(groups: tuple[str, ...], kept: set[str]):
    """Kept features of every sentence that has one; with an identity term also of its swapped form."""
    identity = swaps(groups)

    def present(words):
        return sorted({f for w in words for f in features_of(w, identity) if f in kept or f[0] == "i"})

    @F.pandas_udf("array<struct<own: array<string>, swapped: array<string>>>")
    def run(texts: pd.Series) -> pd.Series:
        def one(text):
            found = {}
            for words in sentences(text):
                own = present(words)
                if own:
                    other = present({identity.get(w, w) for w in words}) if any(f[0] == "i" for f in own) else None
                    found[tuple(own)] = {"own": own, "swapped": other}
            return list(found.values())

        return texts.map(one)

    return run.asNondeterministic()


def train(docs: DataFrame, labels: DataFrame, rows_per_label: int = ROWS_PER_LABEL, max_features: int = MAX_FEATURES,
          groups: tuple[str, ...] = IDENTITY_TERMS, swap_penalty: float = SWAP_PENALTY) -> Model:
    identity = swaps(groups)
    sample = labelled_sample(docs, labels, "toxic", rows_per_label).persist()
    apart = F.pmod(F.xxhash64(F.lit("calibration"), "doc_id"), F.lit(4)) == 0
    whole, sample = sample, sample.where(~apart)
    try:
        counts = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
        total, toxic = sum(counts.values()), counts.get(1, 0)
        if not toxic or toxic == total:
            share = min(max(toxic / total if total else 0.0, 1e-13), 1 - 1e-13)
            return Model(bias=float(np.log(share / (1 - share))), identity=identity)
        share = toxic / total
        z = (F.col("t") - F.col("n") * share) / F.sqrt(F.col("n") * (share * (1 - share)))
        kept = [
            r.f
            for r in sample.select("label", F.explode(document_features(groups)("text")).alias("f"))
            .groupBy("f")
            .agg(F.sum("label").alias("t"), F.count(F.lit(1)).alias("n"))
            .where((F.col("t") >= LEAST_ROWS) & (z >= LEAST_Z))
            .orderBy(z.desc(), "f")
            .limit(max_features)
            .select("f")
            .collect()
        ]
        names = sorted({f for f in kept if f[0] != "i"}) + sorted(f"i:{t}" for t in identity)
        index = {f: k for k, f in enumerate(names)}
        # distinct sets of kept features only: bounded by the sample, and far smaller than its text
        found = (
            sample.select("label", F.explode(sentence_features(groups, set(names))("text")).alias("s"))
            .select("label", "s.own", "s.swapped")
            .distinct()
            .orderBy(F.xxhash64("label", "own"), "label", "own")
            .limit(SENTENCES_PER_ROW * rows_per_label)
            .collect()
        )
        # a sentence of a toxic document that has no kept feature tells nothing about toxicity
        rows = [([index[f] for f in r.own], r.label) for r in found if not r.label or any(f[0] != "i" for f in r.own)]
        pairs = [([index[f] for f in r.own], [index[f] for f in r.swapped]) for r in found if r.swapped]
        rows += [([], 0)] * max(1, len(rows) // 4)
        weights, bias = fit([r[0] for r in rows], np.array([r[1] for r in rows], float), pairs, len(names), swap_penalty)
        model = Model(dict(zip(names, weights.tolist())), bias, identity=identity)
        seen = with_score(whole.where(apart), model, "p").select("label", "p").collect()
        known = np.array([r.label for r in seen], float)
        if 0 < known.sum() < len(known):
            p = np.clip([r.p for r in seen], 1e-12, 1 - 1e-12)
            slope, offset = curve(np.log(p / (1 - p)), known)
            model.scale, model.bias = slope, slope * bias + offset
        return model
    finally:
        whole.unpersist()


def curve(x: np.ndarray, labels: np.ndarray, steps: int = 50, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and offset of a logistic curve through scores, both labels with equal weight (Newton)."""
    weight = np.where(labels > 0, 0.5 / labels.sum(), 0.5 / (1 - labels).sum())
    design, beta = np.stack([x, np.ones(len(x))], axis=1), np.array([1.0, 0.0])
    for _ in range(steps):
        p = logistic(design @ beta)
        grad = design.T @ (weight * (p - labels)) + ridge * beta * np.array([1.0, 0.0])
        curvature = (design * (weight * p * (1 - p))[:, None]).T @ design + ridge * np.array([[1.0, 0.0], [0.0, 1e-3]])
        step = np.linalg.solve(curvature, grad)
        beta = beta - step / max(1.0, float(np.abs(step).max()))
    return max(float(beta[0]), 1e-3), float(beta[1])


def score_text(text: str, weigh) -> float:
    """Highest logit of a sentence, without the bias."""
    lower = text.lower()
    active = {w: x for w in set(WORD.findall(lower)) if (x := weigh(w))}
    if not active:
        return 0.0
    found = ({f: x for w in words if w in active for f, x in active[w]} for words in sentences(lower))
    return max((sum(f.values()) for f in found), default=0.0)


def with_score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, seen = sent.value, {}

        def weigh(word):
            if (found := seen.get(word)) is None:
                if len(seen) > 500_000:
                    seen.clear()
                found = seen[word] = tuple(
                    (f, model.weights[f]) for f in features_of(word, model.identity) if f in model.weights
                )
            return found

        for texts in batches:
            yield pd.Series([float(logistic(model.scale * score_text(t or "", weigh) + model.bias)) for t in texts], dtype=float)

    return docs.withColumn(column, run.asNondeterministic()(docs["text"]))


def report(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **settings) -> DataFrame:
    model = train(docs, labels, **settings)
    return with_score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
