"""Personal data: base patterns, wide candidates around them, and boosted trees that choose among those.

Generators propose overlapping spans: the base patterns of four kinds, and wider forms (addresses with
`at` and `dot` spelled out, numbers with other separators, phone numbers without a plus sign, ...).
Trees over features of the format and of the words before score the wide candidates; a candidate is
added to the base spans if its calibrated probability reaches its kind's threshold. Base spans stay.

There are no labelled spans, so the trees learn from the base patterns: positives are base spans and
spelled-out rewritings of them in their places, negatives are the spans of the same texts that fail the
checks, rewritings with a broken check, and other number groups. All examples of all texts take part, equal
ones once: they are made distinct and put into the bins of the features' quantiles in tasks, and the driver
gets the different rows of bins with their numbers, whose count follows the variety of forms. The threshold of
a kind is the lowest at which its precision on the texts that the trees did not see (a third of them, by length)
is `precision` or more (by monotone calibration, in a block of `LEAST_POSITIVES` or more). A kind with
fewer positives there shares the threshold of all kinds, raised above the highest of its own negatives. Wide
phone numbers (in pairs, two groups or one, and local ones) are positive examples after a word that announces
them only.

Defined cases: null and empty texts have no spans; without any base span in the table only base spans
are found; repeated rows are documents of their own; input columns are kept. Patterns run in time
proportional to the text, also over long runs of digits or letters.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import discard, text_of, written

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.98
LEAST_POSITIVES = 10  # of a calibrated block

# The base patterns.
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")  # without one no number is tried

# Wider forms; every repetition is bounded or possessive.
WIDE = (
    ("email", re.compile(r"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+ ?(?:@|\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}+(?: ?(?:\.|\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]{1,63}+){1,5}")),
    ("ip", re.compile(r"(?<![0-9])[0-9]{1,3}+(?: ?(?:\.|\[\.\]|\(dot\)|,) ?[0-9]{1,3}+){3}(?![0-9])")),
    ("card", re.compile(r"(?<![0-9])[0-9]{4}+(?:[ ._/-]{1,2}[0-9]{2,6}+){2,4}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9])(?:00[0-9]{1,3}[ .-])?\(?[0-9]{2,4}\)?[ ./-]{1,2}[0-9]{3,4}[ ./-][0-9]{3,4}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9])0[0-9](?:[ ./-][0-9]{2}){4}(?![0-9])")),  # in pairs
    ("phone", re.compile(r"(?<![0-9])\(?0[0-9]{2,4}\)?[ ./-][0-9]{6,8}(?![0-9])")),  # in two groups
    ("phone", re.compile(r"(?<![0-9])0[0-9]{8,10}(?![0-9])")),  # in one
)
# Words that announce a kind.
HINTS = {
    "email": ("mail", "contact", "write", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "adresse"),
    "card": ("card", "visa", "credit", "pay", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "ruf"),
}
HINT_CHARS = 40
AT = ("@", "(at)", "[at]", " at ")  # a wide address has one of these


def luhn(digits: str) -> bool:
    doubled = (int(c) * 2 for c in digits[-2::-2])
    return (sum(int(c) for c in digits[::-2]) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def octets_fit(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain: each @ decides its own match, so none is tried twice."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        if start < at and (domain := EMAIL_DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def matches(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """Every match of a base pattern and whether it passes its kind's checks."""
    if "@" in text:
        for start, end in emails(text):
            yield "email", start, end, True
    if not DIGIT.search(text):
        return
    for m in IP.finditer(text):
        yield "ip", *m.span(), octets_fit(m.group())
    for m in CARD.finditer(text):
        digits = digits_of(m.group())
        yield "card", *m.span(), 12 <= len(digits) <= 19 and luhn(digits)
    if "+" in text:
        for m in PHONE.finditer(text):
            yield "phone", *m.span(), 9 <= len(digits_of(m.group())) <= 15


Span = tuple[str, int, int]


def in_order(spans) -> list[Span]:
    return sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def base_spans(text: str) -> list[Span]:
    return in_order((k, a, b) for k, a, b, good in matches(text) if good)


def wide_spans(text: str) -> list[Span]:
    number, address = DIGIT.search(text), any(a in text for a in AT)
    return [(kind, *m.span()) for kind, pattern in WIDE if (address if kind == "email" else number) for m in pattern.finditer(text)]


FEATURES = 20


def describe(text: str, span: Span) -> list[float]:
    """Format and context of a candidate."""
    kind, a, b = span
    own, ahead = text[a:b], text[max(0, a - HINT_CHARS) : a].lower()
    digits = digits_of(own)
    groups = re.findall(r"[0-9]+", own)[:8]
    plain = re.sub(r" ?(?:\(dot\)|\[dot\]|\[\.\]| dot |,) ?", ".", own)
    ending = re.search(r"\.([A-Za-z]{2,12})$", plain)
    octets = [int(g) for g in groups if len(g) <= 3]
    return [
        KINDS.index(kind),
        len(own),
        len(digits),
        len(groups),
        max(map(len, groups), default=0),
        min(map(len, groups), default=0),
        float(bool(digits) and luhn(digits)),
        float(len(octets) == 4 and max(octets) <= 255),
        max(octets, default=0),
        float(own[:1] == "+" or own[:2] == "00"),
        float("(" in own and ")" in own),
        float("@" in own),
        float(" at " in own or "(at)" in own or "[at]" in own),
        len(ending.group(1)) if ending else 0,
        own.count(" "),
        len(set(re.findall(r"[^\w\s]", own))),
        float(text[a - 1 : a].isalnum()) if a else 0.0,
        float(text[b : b + 1].isalnum()),
        float(any(h in ahead for h in HINTS[kind])),
        len(set(digits)),
    ]


def rewritings(text: str, span: Span, good: bool) -> Iterator[tuple[str, Span, bool]]:
    """A base match written otherwise in its place, and with its check broken."""
    kind, a, b = span
    own = text[a:b]
    if kind == "email":
        other = [(own.replace("@", " at ").replace(".", " dot "), True), (own.replace("@", "(at)"), True)]
        other += [(own.rpartition("@")[2].replace(".", " at ", 1), False), (own.replace("@", " at ").replace(".", " . "), False)]
    elif kind == "ip":
        other = [(own.replace(".", "[.]"), good), (own.replace(".", " . "), good), (re.sub(r"^[0-9]+", "999", own), False)]
        other += [(own.replace(".", ", "), False)]
    elif kind == "card":
        digits = digits_of(own)
        grouped = ".".join(digits[i : i + 4] for i in range(0, len(digits), 4))
        broken = digits[:-1] + str((int(digits[-1]) + 5) % 10)
        other = [(grouped, good), (grouped.replace(".", "/"), good)]
        other += [(".".join(broken[i : i + 4] for i in range(0, len(broken), 4)), luhn(broken) and good)]
    else:
        digits = digits_of(own)
        local = f"({digits[-10:-7]}) {digits[-7:-4]}-{digits[-4:]}"
        own_9 = digits[-9:]
        pairs = f"0{own_9[0]} " + " ".join(own_9[i : i + 2] for i in range(1, 9, 2))
        other = [("tel " + x, True) for x in (pairs, pairs.replace(" ", "."), f"0{own_9[:2]} {own_9[2:]}", f"0{own_9}")]
        other += [("tel " + local, True), ("00" + own[1:].replace("(", "").replace(")", ""), good), (f"{digits[-9:-6]} {digits[-6:-3]} {digits[-3:]}", False)]
    for new, positive in other:
        lead = 4 if new.startswith("tel ") else 0
        yield text[max(0, a - HINT_CHARS) : a] + new + text[b : b + 2], (kind, min(a, HINT_CHARS) + lead, min(a, HINT_CHARS) + len(new)), positive


def examples(text: str) -> tuple[list[list[float]], list[int], list[bool]]:
    """Features, labels and whether the example is a rewriting, from one text."""
    found = list(matches(text))
    good = {kind: [(a, b) for k, a, b, ok in found if ok and k == kind] for kind in KINDS}  # apart and in order
    ends = {kind: [b for _, b in own] for kind, own in good.items()}
    x, y, rewritten = [], [], []
    for k, a, b, ok in found:
        x.append(describe(text, (k, a, b)))
        y.append(int(ok))
        rewritten.append(False)
        if ok or k == "ip":
            for other, span, positive in rewritings(text, (k, a, b), ok):
                x.append(describe(other, span))
                y.append(int(positive))
                rewritten.append(True)
    for span in wide_spans(text):
        next_ = bisect_right(ends[span[0]], span[1])
        if next_ == len(ends[span[0]]) or good[span[0]][next_][0] >= span[2]:
            x.append(describe(text, span))
            y.append(0)
            rewritten.append(False)
    return x, y, rewritten


@dataclass
class Trees:
    """Boosted trees of fixed depth: arrays of split features, split values and leaf values."""

    split: list[np.ndarray] = field(default_factory=list)
    value: list[np.ndarray] = field(default_factory=list)
    leaf: list[np.ndarray] = field(default_factory=list)
    prior: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.prior)
        for split, value, leaf in zip(self.split, self.value, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[np.arange(len(x)), split[node]] > value[node])
            out += leaf[node - (2**DEPTH - 1)]
        return out


DEPTH, ROUNDS, RATE = 3, 60, 0.2


def quantiles(values: np.ndarray, counts: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Quantiles of `values` (in order) that occur `counts` times, between the nearest two in proportion."""
    last = np.cumsum(counts)
    at = shares * (last[-1] - 1)
    low, high = (values[np.searchsorted(last, i, "right")] for i in (np.floor(at), np.ceil(at)))
    return low + (high - low) * (at - np.floor(at))


def boost(bins: np.ndarray, y: np.ndarray, rows: np.ndarray, edges: list[np.ndarray]) -> Trees:
    """Newton boosting of the logistic loss; `bins` are how many of a feature's `edges` lie below, in `rows` rows."""
    share = np.clip((y * rows).sum() / rows.sum(), 1e-3, 1 - 1e-3)
    model = Trees(prior=float(np.log(share / (1 - share))))
    columns = [np.ascontiguousarray(bins[:, f]) for f in range(len(edges))]
    score = np.full(len(y), model.prior)
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-score))
        g, h = (p - y) * rows, (p * (1 - p) + 1e-6) * rows
        node, inner = np.zeros(len(y), np.int64), 2**DEPTH - 1
        split, value = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for at in range(inner):
            own = np.flatnonzero(node == at)
            best, below = 1e-6, len(edges[0])
            if rows[own].sum() >= 10:
                g_own, h_own = g[own], h[own]
                gs, hs = g_own.sum(), h_own.sum()
                for f, e in enumerate(edges):
                    bin_ = columns[f][own]
                    gl = np.cumsum(np.bincount(bin_, g_own, len(e) + 1))[:-1]
                    hl = np.cumsum(np.bincount(bin_, h_own, len(e) + 1))[:-1]
                    gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                    if len(gain) and gain.max() > best:
                        best, below = gain.max(), gain.argmax()
                        split[at], value[at] = f, e[below]
            node[own] = 2 * at + 1 + (columns[split[at]][own] > below)
        leaf = np.zeros(2**DEPTH)
        for k in range(2**DEPTH):
            own = node == inner + k
            if own.any():
                leaf[k] = -RATE * g[own].sum() / (h[own].sum() + 1)
        score += leaf[node - inner]
        for parts, new in ((model.split, split), (model.value, value), (model.leaf, leaf)):
            parts.append(new)
    return model


def calibrated(logits: np.ndarray, y: np.ndarray, rows: np.ndarray, precision: float) -> float:
    """Lowest score from which on the share of positives, made monotone, is `precision` or more."""
    scores, own = np.unique(logits, return_inverse=True)
    blocks: list[list[float]] = []  # score, positives, rows
    for s, good, every in zip(scores, np.bincount(own, y * rows, len(scores)), np.bincount(own, rows, len(scores))):
        blocks.append([s, good, every])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            _, n, more = blocks.pop()
            blocks[-1][1] += n
            blocks[-1][2] += more
    return next((s for s, n, every in blocks if n / every >= precision and n >= LEAST_POSITIVES), float("inf"))


ROWS_AT_ONCE = 10_000


def all_examples(docs: DataFrame) -> DataFrame:
    """(x, y, held): the different examples of all texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: set[tuple] = set()

        def table() -> pd.DataFrame:
            return pd.DataFrame([(list(x), y, held) for x, y, held in found], columns=["x", "y", "held"])

        for batch in batches:
            for text in batch["text"]:
                x, y, _ = examples(text)
                found.update((tuple(a), b, len(text) % 3 == 0) for a, b in zip(x, y))
                if len(found) >= ROWS_AT_ONCE:
                    yield table()
                    found.clear()
        if found:
            yield table()

    return docs.select(text_of(docs).alias("text")).mapInPandas(run, "x array<double>, y int, held boolean").distinct()


def train(docs: DataFrame, precision: float = PRECISION) -> Trees:
    """Trees and thresholds from the examples of all documents; the driver gets the values of each feature and
    the different rows of bins, each with its number of examples."""
    none = Trees(thresholds={k: float("inf") for k in KINDS})
    found = written(all_examples(docs), "examples")
    values: list[list[tuple[float, int]]] = [[] for _ in range(FEATURES)]
    for f, v, n in found.where("not held").select(F.posexplode("x").alias("f", "v")).groupBy("f", "v").count().collect():
        values[f].append((v, n))
    if not all(values):
        discard(found)
        return none
    edges = [np.unique(quantiles(*np.array(sorted(own)).T, np.linspace(0.02, 0.98, 33))) for own in values]

    @F.pandas_udf("binary")
    def binned(x: pd.Series) -> pd.Series:
        own = np.array(x.tolist(), float).reshape(-1, FEATURES)
        bins = np.stack([np.searchsorted(e, own[:, f], "left") for f, e in enumerate(edges)], axis=1)
        return pd.Series([row.tobytes() for row in bins.astype(np.uint8)], dtype=object)

    kinds = found.select(F.element_at("x", 1).cast("int").alias("kind"), binned("x").alias("bins"), "y", "held")
    rows = kinds.groupBy("kind", "bins", "y", "held").agg(F.count(F.lit(1)).alias("rows")).toArrow()
    discard(found)
    rows = rows.sort_by([(name, "ascending") for name in ("held", "kind", "bins", "y")])  # sums in one order
    bins = np.frombuffer(b"".join(rows["bins"].to_pylist()), np.uint8).reshape(-1, FEATURES)
    kind, y, held, n = (rows[name].to_numpy() for name in ("kind", "y", "held", "rows"))
    kind, y, n, seen = kind[held], y.astype(float), n.astype(float), ~held
    if not y[seen].any() or y[seen].all():
        return none
    model = boost(bins[seen], y[seen], n[seen], edges)
    lowest = [np.append(e, e[-1] + 1) for e in edges]  # a value of each bin
    scores = model.logits(np.stack([lowest[f][bins[held, f]] for f in range(FEATURES)], axis=1))
    y, n = y[held], n[held]
    for k, name in enumerate(KINDS):
        own = kind == k
        model.thresholds[name] = calibrated(scores[own], y[own], n[own], precision)
    shared = calibrated(scores, y, n, precision)
    for k, name in enumerate(KINDS):
        own = kind == k
        if (y * n)[own].sum() < LEAST_POSITIVES:  # too few for a threshold of its own
            others = scores[own & (y == 0)]
            model.thresholds[name] = max(shared, np.nextafter(others.max(), np.inf) if len(others) else shared)
    return model


def find(texts: list[str], model: Trees) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    base = [base_spans(t) for t in texts]
    within = lambda s, own: any(s[0] == k and a <= s[1] and s[2] <= b for k, a, b in own)
    candidates = [(n, s) for n, t in enumerate(texts) for s in wide_spans(t) if not within(s, base[n])]
    added: dict[int, list[Span]] = {}
    if candidates and model.split:
        scores = model.logits(np.array([describe(texts[n], s) for n, s in candidates]))
        for (n, span), score in zip(candidates, scores):
            if score >= model.thresholds[span[0]]:
                added.setdefault(n, []).append(span)
    return [(b, in_order(b + added.get(n, []))) for n, b in enumerate(base)]


SPAN = "array<struct<kind: string, start: long, end: long>>"


def with_spans(docs: DataFrame, model: Trees, column: str = "pii") -> DataFrame:
    """`docs` with a struct `column`: base and all spans, in code points."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    named = ("kind", "start", "end")

    @F.pandas_udf(f"struct<base: {SPAN}, spans: {SPAN}>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = find([t or "" for t in texts], sent.value)
            yield pd.DataFrame([[[dict(zip(named, s)) for s in spans] for spans in pair] for pair in found], columns=["base", "spans"])

    return docs.withColumn(column, run.asNondeterministic()(docs["text"]))


def redacted(docs: DataFrame, model: Trees) -> DataFrame:
    """The documents with every stretch that spans cover replaced by its first span's kind in brackets."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = []
            for text, (_, spans) in zip(texts, find([t or "" for t in texts], sent.value)):
                parts, done = [], 0
                for kind, a, b in spans:
                    if a >= done:
                        parts += [text[done:a], f"[{kind}]"]
                    done = max(done, b)
                out.append(text if not spans else "".join(parts) + text[done:])
            yield pd.Series(out, dtype=object)

    return docs.withColumn("text", run.asNondeterministic()(docs["text"]))


def report(docs: DataFrame, **settings) -> DataFrame:
    base = F.col("pii")["base"]

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return with_spans(docs.select("doc_id", "text"), train(docs, **settings)).select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("pii")["spans"]).alias("spans"),
    )
