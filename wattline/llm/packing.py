"""Cost-balanced packing: documents into sequences of at most `SEQUENCE` tokens with alike attention costs.

The cost of a piece of n tokens is linear plus quadratic, `n + QUADRATIC * n ** 2`: what a layer does per token, and
attention inside the piece. Documents, the longest first, go to the sequence of the lowest cost that has room for
them; one that no sequence has room for is cut, and its first part fills up the sequence of the lowest cost.

The work is cut where the documents lie: a task tokenizes its rows one after the other and packs blocks of
`BLOCK_SEQUENCES` full sequences, exactly, cutting the document at the block's end. The last block's tokens that
are left beyond full sequences fill one sequence for each binary digit of their number. So every sequence is full
or has a power of two of tokens, and nothing is padded. No row is shuffled, memory is that of a block, and a task
that is repeated gives the same pieces again. Which documents share a sequence follows from how the input is split;
read from files, the same every time.

Ids are those of the tokenizer file, special strings being ordinary text, then `END`. The ranks of the same
vocabulary give the same ids in a fifth of the time (compared for every code point in the tests); texts that
their pattern can't take (blanks by the hundred thousand) go through the tokenizer file itself.

Defined cases: a null or empty text is the end token alone; every row is a document of its own, repeated ones and
null ids too; a document of any length is cut into sequences; an empty table gives no pieces; other columns are
not read.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import text_of

SEQUENCE = 1024
BLOCK_SEQUENCES = 1024
END = 0
# Attention of n tokens over the work on each: 4 n d against 24 d ** 2 operations at width d = 768.
QUADRATIC = 1 / (6 * 768)
FILE, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def public_paths() -> tuple[str, str]:
    """The vocabulary file and the ranks of the same vocabulary, where they are installed."""
    import public_tokenizers

    return public_tokenizers.path(FILE), public_tokenizers.path(RANKS)


class Tokens:
    """Ids of texts by the vocabulary file `path`; `ranks` has the same vocabulary."""

    def __init__(self, path: str, ranks: str):
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as lines:
            known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.path, self.whole = path, None
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})

    def by_file(self, text: str) -> np.ndarray:
        if self.whole is None:
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.path)
            self.whole.encode_special_tokens = True
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)

    def __call__(self, text: str) -> np.ndarray:
        try:
            ids = self.fast.encode_to_numpy(text, disallowed_special=()) if text else []
        except ValueError:  # its pattern gives up on very long runs of blanks
            ids = self.by_file(text)
        return np.append(np.asarray(ids, np.uint32), np.uint32(END))


def room(tokens: int, sequence: int) -> list[int]:
    """Full sequences, and one for each binary digit of what is left: sizes that add up to `tokens`."""
    full, rest = divmod(tokens, sequence)
    return [sequence] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def assigned(lengths: list[int], sequence: int, quadratic: float = QUADRATIC) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece, for documents of these lengths.

    Sequences and offsets are counted from 0; all sequences are filled.
    """
    sizes = np.array(room(sum(lengths), sequence), np.int64)
    left, cost = sizes.copy(), np.zeros(len(sizes))
    # what is left of each document, the longest first; whole sequences are cut off before the rest
    waiting = [(-n, i, 0) for i, n in enumerate(lengths) if n]
    heapq.heapify(waiting)
    while waiting:
        n, i, start = heapq.heappop(waiting)
        n = -n
        part = min(n, sequence)
        fits = left >= part
        if not fits.any():
            fits = left > 0
        at = int(np.where(fits, cost, np.inf).argmin())
        part = min(part, int(left[at]))
        yield i, start, part, at, int(sizes[at] - left[at])
        left[at] -= part
        cost[at] += part + quadratic * part * part
        if part < n:
            heapq.heappush(waiting, (part - n, i, start + part))


def packed(
    docs: DataFrame,
    paths: tuple[str, str] | None = None,
    sequence: int = SEQUENCE,
    block_sequences: int = BLOCK_SEQUENCES,
    quadratic: float = QUADRATIC,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (32-bit little-endian), doc_tokens, sequence_id, offset.

    `paths`: the vocabulary file and its ranks, `public_paths` where not given. `sequence` is a power of two.
    """
    if sequence < 1 or sequence & (sequence - 1):
        raise ValueError("sequences are filled in powers of two")
    block = sequence * block_sequences

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = Tokens(*(paths or public_paths()))
        number = TaskContext.get().partitionId() << 33
        held, size = [], 0

        def pieces():
            """The held documents, packed."""
            nonlocal number, held, size
            rows = []
            for i, start, part, at, offset in assigned([last - first for _, _, first, last in held], sequence, quadratic):
                doc_id, ids, first, _ = held[i]
                start += first
                own = ids[start : start + part].astype("<u4").tobytes()
                rows.append((doc_id, start, part, own, len(ids), number + at, offset))
            number += len(room(size, sequence))
            held, size = [], 0
            return _frame(sorted(rows, key=lambda r: r[5:]))

        for frame in frames:
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                ids, first = tokens(text), 0
                while first < len(ids):
                    last = min(len(ids), first + block - size)
                    held.append((doc_id, ids, first, last))
                    size += last - first
                    first = last
                    if size == block:
                        yield pieces()
        yield pieces()

    own = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), text_of(docs).alias("text"))
    return own.mapInPandas(run, PIECES)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    columns = dict(zip((c.split()[0] for c in PIECES.split(", ")), zip(*rows) if rows else [()] * 7))
    columns["doc_id"] = pd.array([None if x is None else int(x) for x in columns["doc_id"]], dtype="Int64")
    return pd.DataFrame(columns)


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence of `packed`: sequence_id, ids (32-bit little-endian), pieces (doc_id, start, length)."""
    own = F.struct("offset", "doc_id", "start", "length", "ids")
    whole = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(own)).alias("own"))  # a piece has a token
    ids = F.aggregate("own", F.lit(b""), lambda done, x: F.concat(done, x["ids"]))
    told = F.transform("own", lambda x: F.struct(x["doc_id"], x["start"], x["length"]))
    return whole.select("sequence_id", ids.alias("ids"), told.alias("pieces"))


def report(docs: DataFrame) -> DataFrame:
    return packed(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
