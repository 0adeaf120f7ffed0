import hashlib
from collections import defaultdict

import pytest
from fixtures import documents, empty, rows

from wattline.llm import sharding


def bits(doc_id):
    digest = hashlib.md5(("null" if doc_id is None else str(doc_id)).encode()).hexdigest()
    return f"{int(digest[:15], 16):060b}"


def brute_force(table, limit):
    """Split a bucket on the next bit while it is too large: doc -> its bucket."""
    out, open_ = {}, [("", [(r[0], len((r[1] or "").encode())) for r in table])]
    while open_:
        name, members = open_.pop()
        if sum(n for _, n in members) <= limit or len(members) == 1:
            out |= {d: name for d, _ in members}
        else:
            for bit in "01":
                if half := [m for m in members if bits(m[0]).startswith(name + bit)]:
                    open_.append((name + bit, half))
    return out


@pytest.mark.parametrize("limit", [1, 300, 5000, 10**9])
def test_shards_are_those_of_splitting_buckets(spark, limit):
    table = list({r[0]: r for r in rows()}.values())  # one row for each id
    found = sharding.with_shards(documents(spark, table), limit).collect()
    assert {r.doc_id: r.shard for r in found} == brute_force(table, limit)
    total = defaultdict(int)
    for r in found:
        total[r.shard] += r.n_bytes
        assert r.depth == len(r.shard)
    for r in found:
        assert r.shard_bytes == total[r.shard] and (total[r.shard] <= limit or r.shard_rows == 1)


def test_repeats_of_one_id_are_split_too(spark):
    own = [(7, "x" * 100, "en", "a", 0)] * 300 + [(i, "y" * 50, "en", "a", 0) for i in range(100)]
    docs = documents(spark, own)
    found = sharding.with_shards(docs, 1000).collect()
    assert len(found) == 400
    total = defaultdict(int)
    for r in found:
        total[r.shard] += r.n_bytes
        assert r.size == "extra size"
    assert max(total.values()) <= 1000 and all(r.shard_bytes == total[r.shard] for r in found)


@pytest.mark.parametrize("doc", [7, None])
def test_repeats_of_more_than_half_the_limit_are_alone(spark, doc):
    own = [(doc, "x" * 60, "en", "a", 0)] * 1500 + [(doc, "x" * 300, "en", "a", 0), (1, "y", "en", "a", 0)]
    found = sharding.with_shards(documents(spark, own), 100).collect()
    total = defaultdict(list)
    for r in found:
        total[r.shard].append(r.n_bytes)
        assert r.depth == len(r.shard)
    assert len(found) == len(own) and len(total) == len(own)
    assert all((r.shard_bytes, r.shard_rows) == (r.n_bytes, 1) for r in found)
    names = sorted(total)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))


def test_files(spark, tmp_path):
    table = rows()
    sharding.write_shards(documents(spark, table, extra=False), str(tmp_path / "out"), 5000)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(table)
    assert all(len(list(p.glob("*.parquet"))) == 1 for p in (tmp_path / "out").glob("shard=*"))


def test_empty(spark):
    assert sharding.report(empty(spark)).count() == 0
