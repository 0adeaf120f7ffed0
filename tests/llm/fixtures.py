"""Small hostile tables and plain helpers."""

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def rows(seed=1, n=60):
    """Ordinary rows, near and exact copies, repeated rows, nulls, blanks and one long text."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        own = words(rng, rng.choice([1, 2, 3, 5, 8, 40, 120]))
        text = " ".join(own[:20]) + ".\n" + " ".join(own[20:]) if len(own) > 20 else " ".join(own)
        out.append((i, text, "en", rng.choice(["a", "b", "é", None]), len(text)))
    base = words(rng, 150, 5000)
    for k in range(12):
        own = list(base)
        for _ in range(k):
            own[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        out.append((n + k, " ".join(own), "en", "a", 0))
    out += [(n + 20, out[3][1], "en", "b", 0), (n + 21, out[3][1].upper(), "en", "b", 0)]
    out += [out[5], out[5], (5, "another text of the same id", "en", "c", 0)]
    out += [(None, "no id at all", None, None, None), (None, "no id at all", None, None, None), (None, None, None, None, None)]
    out += [(n + 30, None, "en", "a", None), (n + 31, "", "en", "a", 0), (n + 32, " \t\n\x0b", "en", None, 4)]
    out += [(-(2**62), "far below, end", "en", "b", 0), (2**62, "far above", "en", "b", 0)]
    out.append((n + 40, " ".join(words(rng, 30_000, 3000)), "en", "b", 0))
    return out


EXTRA = ["score", "size", "key", "n", "shard", "__size", "__quality", "component_id", "taken", "pii", "block", "end", "d", "kept"]
# Names that operators use inside.
EXTRA += [f"__{n}" for n in (
    "empty", "text_hash", "id", "hash", "c0", "d", "h", "kept", "u", "key", "own_key", "at", "n", "items", "bits", "own",
    "fine0", "leaf0", "shard_bytes0", "tree", "contamination", "times", "copy", "0", "toxic",
)]


def documents(spark, own=None, extra=True):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows() if own is None else own, DOCUMENTS).repartition(3)
    return df.withColumns({c: F.lit(f"extra {c}") for c in EXTRA}) if extra else df


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan_of(df, mode="simple"):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
