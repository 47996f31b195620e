"""Fingerprints and components against all pairs."""

import random
from collections import defaultdict

import pytest
import xxhash

from rainfold.llm import simhash
from rainfold.llm.components import connected_components
from tests.llm.data import awkward_rows, documents


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(3, len(words))
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def unsigned(n):
    return n & (1 << 64) - 1


def signed(n):
    return n - (1 << 64) if n >> 63 else n


def test_components_against_all_pairs(spark):
    rows = awkward_rows(2, 60)
    rng = random.Random(4)
    for base in [r for r in rows if r[1] and 60 < len(r[1].split()) < 400][:8]:
        for j in range(4):  # near copies: a word or two changed
            words = base[1].split()
            for _ in range(j % 3 + 1):
                words[rng.randrange(len(words))] = "changed"
            rows.append((200 + len(rows), " ".join(words), "en", "s0"))
    got = simhash.components(documents(spark, rows)).collect()
    fps = [plain_fingerprint(t) for _, t, *_ in rows]
    assert sorted(unsigned(r["fp"]) for r in got) == sorted(fps)
    distinct = sorted(set(fps))
    root = groups(distinct, [(a, b) for i, a in enumerate(distinct) for b in distinct[i + 1:] if (a ^ b).bit_count() <= 3])
    least = defaultdict(list)
    for (i, *_), f in zip(rows, fps, strict=True):
        least[root[f]].append(i)
    want = {f: min((i for i in least[root[f]] if i is not None), default=None) for f in distinct}
    assert {unsigned(r["fp"]): r["component_id"] for r in got} == want


@pytest.mark.parametrize("hot", [1, 8, 10_000])
def test_links_connect_as_all_pairs_do(spark, hot):
    rng = random.Random(hot)
    nums = {rng.getrandbits(64) for _ in range(40)}
    for c in [rng.getrandbits(64) for _ in range(3)]:  # crowded halves
        for _ in range(60):
            x = c
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.choice([0, 1, 2, 3, 5, 8, 33, 40, 63])
            nums.add(x)
    nums = sorted(nums)
    pairs = [(a, b) for i, a in enumerate(nums) for b in nums[i + 1:] if (a ^ b).bit_count() <= 3]
    edges = simhash.links(spark.createDataFrame([(signed(n),) for n in nums], "fp long"), hot=hot).collect()
    assert all((unsigned(a) ^ unsigned(b)).bit_count() <= 3 for a, b in edges)
    same = lambda root: sorted(sorted(n for n in nums if root[n] == r) for r in set(root.values()))
    assert same(groups(nums, [(unsigned(a), unsigned(b)) for a, b in edges])) == same(groups(nums, pairs))


def test_connected_components_of_paths_and_stars(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(400, 560, 3)] + [(7, 7), (900, 901), (901, 900)]
    rng.shuffle(edges)
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()}
    nodes = {n for e in edges for n in e}
    want = groups(nodes, edges)
    assert {n: got.get(n, n) for n in nodes} == want


def test_one_document_of_each_group_stays(spark):
    docs = documents(spark, awkward_rows())
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    rows = kept.toPandas()
    assert (rows["doc_id"] == 104).sum() == 1 and not rows["doc_id"].isin([105]).any()
    assert rows["doc_id"].isin([100, 101, 102]).sum() == 1 and not rows["doc_id"].isna().any()


def test_empty_table(spark):
    assert simhash.components(documents(spark, [])).count() == 0
    assert simhash.deduplicate(documents(spark, [])).count() == 0
