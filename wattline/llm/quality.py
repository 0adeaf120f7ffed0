"""Quality classifier: votes of the nearest labelled documents in a latent semantic space.

A document is a vector of square roots of term shares. Terms are hashed words, the shapes of words
(letter cases, punctuation runs), words that repeat the one before, and marks between words. Weighted by
inverse document frequency and projected on the leading singular vectors of the labelled sample, it is
compared with every labelled vector: exact cosine products in blocks, one matrix product for each block
of documents. The `neighbours` nearest vote with their label, weighted by a power of the similarity.

Bounds: the labelled vectors (`rows_per_label` for either label) and the projection are all that is
sent to the tasks, 2 * 2000 * 48 and 1300 * 48 numbers. Every document is scored over its whole text.

Defined cases: null and empty texts are similar to nothing and score 0; so do all documents without
labelled rows; ties among neighbours go to the earlier labelled row (by id); columns of the input are kept.
"""

from __future__ import annotations

import operator
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import held_out, labelled_sample, unused

ROWS_PER_LABEL = 2000
DIMENSIONS = 48
NEIGHBOURS = 25
POWER = 4
THRESHOLD = 0.3

WORD_TERMS, SHAPE_TERMS = 1024, 256
REPEATED, TERMS = WORD_TERMS + SHAPE_TERMS, WORD_TERMS + SHAPE_TERMS + 1
BLOCK = 256  # documents in one matrix product

LETTERS = re.compile(r"[^\W\d_]+")
DIGITS = re.compile(r"\d+")
MARKS = re.compile(r"([^\w\s])\1+")


def shape(word: str) -> str:
    """Cases, digits and marks of a word: `Xx,`, `X!`, `x#`."""

    def letters(m):
        s = m.group()
        return "X" if s.isupper() and len(s) > 1 else "Xx" if s[0].isupper() else "x"

    return MARKS.sub(r"\1\1", DIGITS.sub("9", LETTERS.sub(letters, word)))[:12]


def terms(word: str) -> tuple[int, int]:
    plain = "".join(LETTERS.findall(word)).lower()
    return zlib.crc32(plain.encode()) % WORD_TERMS, WORD_TERMS + zlib.crc32(shape(word).encode()) % SHAPE_TERMS


def term_shares(text: str, known: dict[str, tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Terms of a text and the square roots of their shares; two empty arrays for a text without words."""
    words = text.split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    totals = Counter()
    for word, n in Counter(words).items():
        if (own := known.get(word)) is None:
            if len(known) > 500_000:
                known.clear()
            own = known[word] = terms(word)
        totals[own[0]] += n
        totals[own[1]] += n
    if repeats := sum(map(operator.eq, words, words[1:])):
        totals[REPEATED] = 4 * repeats  # one term against hundreds
    at = np.fromiter(totals.keys(), np.int64, len(totals))
    return at, np.sqrt(np.fromiter(totals.values(), float, len(totals)) / len(words))


@dataclass
class Model:
    idf: np.ndarray  # TERMS
    projection: np.ndarray  # TERMS x dimensions
    vectors: np.ndarray  # distinct labelled texts x dimensions, of length 1
    labels: np.ndarray  # of the labelled rows
    of: np.ndarray  # the vector of each labelled row


def unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 1e-12)


def shares_udf():
    @F.pandas_udf("struct<at: array<long>, share: array<double>>")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([term_shares(t, {}) for t in texts], columns=["at", "share"])

    return run.asNondeterministic()


def train(docs: DataFrame, labels: DataFrame, rows_per_label: int = ROWS_PER_LABEL, dimensions: int = DIMENSIONS) -> Model | None:
    """Fitted on the bounded labelled sample; None without labelled rows. Texts stay in the tasks."""
    sample = labelled_sample(docs, labels, "quality", rows_per_label)
    rows = sorted(
        (r.doc_id, r.label, r.s.at, r.s.share) for r in sample.select("doc_id", "label", shares_udf()("text").alias("s")).collect()
    )
    if not rows:
        return None
    matrix = np.zeros((len(rows), TERMS), np.float32)
    for k, (_, _, at, share) in enumerate(rows):
        matrix[k, at] = share
    idf = np.log((1 + len(rows)) / (1 + (matrix > 0).sum(axis=0))).astype(np.float32) + 1
    matrix = unit(matrix * idf)
    values, vectors = np.linalg.eigh((matrix.T @ matrix).astype(np.float64))  # right singular vectors of the sample
    projection = np.ascontiguousarray(vectors[:, ::-1][:, : min(dimensions, len(rows))]).astype(np.float32)
    # rows with the same text share a vector, so that their similarities are equal to the last bit
    places: dict[tuple, int] = {}
    of = np.array([places.setdefault((tuple(at), tuple(share)), len(places)) for _, _, at, share in rows])
    firsts = np.unique(of, return_index=True)[1]
    return Model(idf, projection, unit(matrix[firsts] @ projection), np.array([r[1] for r in rows], np.float32), of)


def votes(model: Model, vectors: np.ndarray, neighbours: int, power: int) -> np.ndarray:
    """Share of label 1 among the nearest, by similarity; 0 where nothing is similar."""
    similar = (vectors @ model.vectors.T)[:, model.of]
    k = min(neighbours, similar.shape[1])
    nearest = np.argpartition(-similar, k - 1, axis=1)[:, :k]
    # of rows that are as similar as the last one chosen, the earlier ones
    last = np.take_along_axis(similar, nearest, axis=1).min(axis=1, keepdims=True)
    above, even = similar > last, similar == last
    for row in np.flatnonzero((above | even).sum(axis=1) > k):
        chosen = np.flatnonzero(above[row])
        nearest[row] = np.concatenate([chosen, np.flatnonzero(even[row])[: k - len(chosen)]])
    weight = np.clip(np.take_along_axis(similar, nearest, axis=1), 0, 1) ** power
    total = weight.sum(axis=1)
    return np.divide((weight * model.labels[nearest]).sum(axis=1), total, out=np.zeros_like(total), where=total > 1e-9)


def with_score(docs: DataFrame, model: Model | None, column: str = "score", neighbours: int = NEIGHBOURS, power: int = POWER) -> DataFrame:
    if model is None:
        return docs.withColumn(column, F.lit(0.0))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, known = sent.value, {}
        for texts in batches:
            scores = np.zeros(len(texts))
            for begin in range(0, len(texts), BLOCK):
                block = np.zeros((min(BLOCK, len(texts) - begin), TERMS), np.float32)
                for k, text in enumerate(texts.iloc[begin : begin + BLOCK]):
                    at, share = term_shares(text or "", known)
                    block[k, at] = share
                scores[begin : begin + BLOCK] = votes(model, unit(unit(block * model.idf) @ model.projection), neighbours, power)
            yield pd.Series(np.clip(scores, 0, 1))

    return docs.withColumn(column, run.asNondeterministic()(docs["text"]))


def report(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **settings) -> DataFrame:
    model = train(docs, labels, **settings)
    return with_score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not rejected, with their own columns."""
    own = unused(docs, "__quality")
    return with_score(docs, train(docs, labels), own).where(F.col(own) >= threshold).drop(own)
