import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from fixtures import documents, empty, rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wattline.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    own = Tokenizer.from_file(public_tokenizers.path(packing.FILE))
    own.encode_special_tokens = True
    return own


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def table():
    hostile = ["<|endoftext|> x", " " * 300_000, "\n" * 5000 + "é", "a" * 20_000, "🎉 中文 \x00 's", "x" * 1023]
    return rows() + [(10_000 + i, t, "en", "a", 0) for i, t in enumerate(hostile)]


def check(made, wanted, sequence):
    """The pieces hold every id once and fill their sequences."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in made:
        by_doc[r.doc_id, r.doc_tokens].append((r.start, r.length, r.ids_crc32))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for own in by_sequence.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end and length > 0
            end += length
        assert end == sequence or end < sequence and end & (end - 1) == 0
    given = defaultdict(list)
    for doc_id, ids in wanted:
        given[doc_id, len(ids)].append(ids)
    assert set(by_doc) == set(given)
    for key, every in given.items():
        pieces = sorted(by_doc[key])
        crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
        # of rows that share an id and a length, all pieces must be there
        assert sum(p[1] for p in pieces) == key[1] * len(every)
        assert all(any(p[2] == crc(ids[p[0] : p[0] + p[1]]) for ids in every) for p in pieces)
        if len(every) == 1:
            assert [p[0] for p in pieces] == [0, *np.cumsum([p[1] for p in pieces])[:-1].tolist()]


@pytest.mark.parametrize("sequence, block", [(1024, 1024), (1024, 3), (64, 50), (1, 1000)])
def test_pieces_hold_every_id_once_and_fill_their_sequences(spark, tokenizer, sequence, block):
    own = [r for r in table() if sequence > 1 or len(r[1] or "") < 200]
    made = packing.packed(documents(spark, own), sequence=sequence, block_sequences=block)
    made = made.withColumn("ids_crc32", F.crc32("ids")).collect()
    check(made, [(r[0], ids_of(tokenizer, r[1])) for r in own], sequence)


def test_report_and_rerun(spark, tokenizer):
    docs = documents(spark, table())
    made = packing.report(docs).collect()
    check(made, [(r[0], ids_of(tokenizer, r[1])) for r in table()], packing.SEQUENCE)
    assert sorted(map(repr, made)) == sorted(map(repr, packing.report(docs).collect()))


def test_ranks_give_the_ids_of_the_file_for_every_code_point(tokenizer):
    tokens = packing.Tokens(*packing.public_paths())
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    texts = ["".join(f"a{x} {x}1{x}{x}\n{x}'s " for x in points[i : i + 50]) for i in range(0, len(points), 50)]
    for text, found in zip(texts, tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
        assert tokens(text).tolist() == [*found.ids, 0]


def test_costs_are_balanced():
    rng = random.Random(5)
    lengths = [min(20_000, 1 + int(rng.lognormvariate(5.5, 1.2))) for _ in range(3000)]
    given, in_order, sizes = defaultdict(float), defaultdict(float), defaultdict(int)
    for _, _, length, at, _ in packing.assigned(lengths, 1024, packing.QUADRATIC):
        given[at] += length + packing.QUADRATIC * length**2
        sizes[at] += length
    at = 0
    for n in lengths:  # one after the other, cut wherever a sequence ends
        while n:
            part = min(n, 1024 - at % 1024)
            in_order[at // 1024] += part + packing.QUADRATIC * part**2
            at, n = at + part, n - part
    full = [given[k] for k in sizes if sizes[k] == 1024]
    assert np.std(full) <= np.std(list(in_order.values())[:-1]) and sum(full) < sum(list(in_order.values())[:-1]) * 1.2
    assert sum(sizes.values()) == sum(lengths)


def test_the_longest_goes_to_the_cheapest_that_has_room():
    made = sorted(packing.assigned([5, 3, 8, 4, 4], 8, 1.0))
    assert made == [(0, 0, 5, 1, 0), (1, 0, 3, 1, 5), (2, 0, 8, 0, 0), (3, 0, 4, 2, 0), (4, 0, 4, 2, 4)]


def test_sequences(spark, tokenizer):
    pieces = packing.packed(documents(spark, table()))
    whole = {r.sequence_id: r for r in packing.sequences(pieces).collect()}
    by = defaultdict(list)
    for r in pieces.collect():
        by[r.sequence_id].append(r)
    assert set(whole) == set(by)
    for key, own in by.items():
        own.sort(key=lambda r: r.offset)
        assert whole[key].ids == b"".join(r.ids for r in own)
        assert [tuple(x) for x in whole[key].pieces] == [(r.doc_id, r.start, r.length) for r in own]


def test_only_powers_of_two(spark):
    with pytest.raises(ValueError, match="powers of two"):
        packing.packed(empty(spark), sequence=1000)


def test_empty(spark):
    assert packing.report(empty(spark)).count() == 0
