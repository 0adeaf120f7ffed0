import random
from collections import defaultdict

import numpy as np
import pytest
from fixtures import documents, empty, plain, plan_of, rows
from pyspark.sql import functions as F

from wattline.llm import neardup
from wattline.llm.components import components
from wattline.llm.neardup import Forest

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_set(text, words):
    own = (text or "").encode().translate(LOWER).split()
    if not own:
        return frozenset()
    if len(own) < words:
        return frozenset([tuple(own)])
    return frozenset(tuple(own[i : i + words]) for i in range(len(own) - words + 1))


def brute_force(table, words, percent):
    """Row number -> smallest id reachable over all pairs."""
    sets = [shingle_set(r[1], words) for r in table]
    parent = list(range(len(table)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * len(sets[i] | sets[j]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    ids = defaultdict(list)
    for i in range(len(sets)):
        ids[root(i)].append(table[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return [(table[i][0], len(sets[i]), least[root(i)] if sets[i] else table[i][0]) for i in range(len(sets))]


@pytest.mark.parametrize("words, percent", [(3, 85), (5, 80)])
def test_components_equal_brute_force(spark, words, percent):
    found = neardup.near_components(documents(spark), Forest(words, percent))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=repr)
    assert got == sorted(brute_force(rows(), words, percent), key=repr)


def chain(n, step, seed=3):
    """Each text differs from the one before by a few words: neighbours are near, ends are not."""
    rng = random.Random(seed)
    own, out = [f"v{rng.randrange(10**6)}" for _ in range(200)], []
    for i in range(n):
        out.append((1000 - i, " ".join(own), "en", "a", 0))
        for _ in range(step):
            own[rng.randrange(200)] = f"y{rng.randrange(10**6)}"
    return out


@pytest.mark.parametrize("members, weight", [(4096, 4_000_000), (10, 4_000_000), (4096, 2500)])
def test_large_groups_and_crowded_regions(spark, monkeypatch, members, weight):
    monkeypatch.setattr(neardup, "MOST_MEMBERS", members)
    monkeypatch.setattr(neardup, "MOST_SHINGLES", weight)
    table = chain(60, 3) + rows()
    found = neardup.near_components(documents(spark, table), Forest(3, 85))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=repr)
    assert got == sorted(brute_force(table, 3, 85), key=repr)


@pytest.mark.parametrize("most", [2, 5, 40, 1000])
def test_regions_are_cut_at_the_shortest_common_prefixes(most):
    rng = np.random.default_rng(most)
    values = rng.integers(0, 2, (300, neardup.REACH))
    values = values[np.lexsort(values.T[::-1])]
    common = np.cumprod(values[1:] == values[:-1], axis=1).sum(axis=1)
    n = rng.integers(1, 9, 300)
    blocks = neardup._cut(common, n, most, 100)
    assert all(b - a > 1 and b - a <= most and n[a:b].sum() <= 100 for a, b, _ in blocks)
    assert all(x[1] <= y[0] for x, y in zip(blocks, blocks[1:]))
    for a, b, depth in blocks:
        assert depth == common[a : b - 1].min()
        if depth < neardup.REACH:  # no deeper than needed: with the neighbour it would not fit, or they share less
            for x, y, edge in ((a - 1, b, a - 1), (a, b + 1, b - 1)):
                if 0 <= x and y <= 300 and common[edge] >= depth:
                    whole = [x, y]
                    while whole[0] > 0 and common[whole[0] - 1] >= depth:
                        whole[0] -= 1
                    while whole[1] < 300 and common[whole[1] - 1] >= depth:
                        whole[1] += 1
                    assert whole[1] - whole[0] > most or n[whole[0] : whole[1]].sum() > 100


def test_blocks_are_runs_of_sorted_orders_with_depths_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(neardup, "MOST_MEMBERS", 10)
    forest = Forest(3, 85)
    found = neardup.summaries(documents(spark, chain(60, 1) + rows(), extra=False), forest)
    classes = found.where("key is not null").dropDuplicates(["key"]).cache()
    _, members = neardup._region_members(classes, forest)
    crowded = F.col("members") > 10
    blocks = neardup._ordered_blocks(members, classes, crowded)
    plan = plan_of(blocks)
    assert "rangepartitioning(tree" in plan and "Sort [tree" in plan
    signatures = {bytes(r.key): bytes(r.signature) for r in classes.collect() if r.signature}
    stretches, depths = defaultdict(list), {}
    for r in blocks.collect():
        at = r.tree * 4 * neardup.REACH
        stretches[r.tree, r.block].append(signatures[bytes(r.key)][at : at + 4 * neardup.REACH])
        depths[r.tree, r.block] = r.depth
    for key, own in stretches.items():
        shared = next((i for i in range(neardup.REACH) if len({x[4 * i : 4 * i + 4] for x in own}) > 1), neardup.REACH)
        assert 2 <= len(own) <= 10 and shared == depths[key] >= neardup.DEPTH
    assert len(set(depths.values())) > 2
    order = sorted((t, min(own), max(own)) for (t, _), own in stretches.items())
    assert all(a[0] != b[0] or a[2] <= b[1] for a, b in zip(order, order[1:]))  # runs of the order
    whole = {(r.tree, bytes(r.prefix)): r["count"] for r in members.where(~crowded).groupBy("tree", "prefix").count().collect()}
    for (tree, prefix), size in whole.items():
        assert any(t == tree and own[0].startswith(prefix) and len(own) == size for (t, _), own in stretches.items())


def test_recall_at_the_threshold(spark):
    """Pairs with a similarity of exactly 0.85: 170 shingles of 200."""
    rng = random.Random(11)
    table = []
    for pair in range(150):
        own = [f"p{pair}q{rng.randrange(10**9)}" for _ in range(187)]
        other = own[:172] + [f"p{pair}z{rng.randrange(10**9)}" for _ in range(15)]
        table += [(2 * pair, " ".join(own), "en", "a", 0), (2 * pair + 1, " ".join(other), "en", "a", 0)]
    a, b = (shingle_set(table[k][1], 3) for k in (0, 1))
    assert (len(a & b), len(a | b)) == (170, 200)
    found = neardup.report(documents(spark, table, extra=False)).collect()
    assert sum(r.kept for r in found) == 150


def test_report_and_unique(spark):
    docs = documents(spark)
    found = neardup.report(docs).collect()
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.component_id) for r in found)
    out = neardup.near_unique(docs)
    assert out.columns == docs.columns
    wanted = brute_force(rows(), 5, 80)
    with_words = {c for (i, n, c) in wanted if n and c is not None}
    texts = out.collect()
    assert {r.doc_id for r in texts if shingle_set(r.text, 5)} - {None} == with_words
    assert sum(bool(shingle_set(r.text, 5)) for r in texts) == len(with_words) + 2  # one without an id, two texts of id 5
    assert sum(not shingle_set(r.text, 5) for r in texts) == sum(not n for _, n, _ in wanted)


def test_empty(spark):
    assert neardup.report(empty(spark)).count() == 0
    assert neardup.near_unique(empty(spark)).count() == 0
    assert plain(neardup.report(documents(spark, [(1, None, "", "", 0), (2, "", "", "", 0)]))) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_components_of_a_long_path_and_a_star(spark):
    rng = random.Random(5)
    path = list(range(100, 140))
    rng.shuffle(path)
    links = list(zip(path, path[1:])) + [(1, k) for k in range(2, 60)] + [(70, 70)]
    found = components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.component for r in found.collect()} == {k: 100 for k in path} | {k: 1 for k in range(1, 60)}
