"""The mix against seat-by-seat apportionment and block-by-block selection."""

import heapq
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from rainfold.llm import mixing
from tests.llm.data import awkward_rows, documents

WORD = re.compile(mixing.WORD)


def seats(weights, caps, n):
    """Sainte-Laguë, one seat after the other."""
    got = [0] * len(weights)
    heap = [(-Fraction(w), i) for i, w in enumerate(weights) if caps[i] > 0 and w > 0]
    heapq.heapify(heap)
    for _ in range(n):
        if not heap:
            break
        _, i = heapq.heappop(heap)
        got[i] += 1
        if got[i] < caps[i]:
            heapq.heappush(heap, (-Fraction(weights[i], 2 * got[i] + 1), i))
    return got


def levels(sizes, weights):
    """Targets by repeated resharing of what exceeds three times a size."""
    target, free, left = {}, set(sizes), sum(sizes.values())
    while free:
        level = Fraction(left) / sum(weights[s] for s in free)
        full = {s for s in free if level * weights[s] > 3 * sizes[s]}
        if not full:
            return target | {s: level * weights[s] for s in free}
        for s in full:
            target[s] = Fraction(3 * sizes[s])
            left -= 3 * sizes[s]
        free -= full
    return target


@pytest.mark.parametrize(("rows", "shard_words"), [(awkward_rows(), 1 << 20), (awkward_rows(3, 300), 2000), (awkward_rows(5, 3), 50)])
def test_against_seat_by_seat(spark, rows, shard_words):
    got = mixing.mix(documents(spark, rows), shard_words=shard_words).toPandas()
    assert len(got) == len(rows)
    size = lambda t: len(WORD.findall(t or ""))
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += size(t)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    want = levels(sizes, weights)
    by_source = defaultdict(int)
    for r in got.itertuples():
        s = r.source if isinstance(r.source, str) else None
        assert r.source_size == sizes[s] and abs(r.target - float(want[s])) < 1e-6
        assert 0 <= r.taken <= 3 * r.size
        by_source[s] += r.taken
    shards = got.drop_duplicates(["source", "n_blocks", "quota", "turn"]).groupby("source", dropna=False).size()
    quotas = seats([weights[s] for s in order], [3 * -(-sizes[s] // mixing.BLOCK) for s in order], round(sum(sizes.values()) / mixing.BLOCK))
    for s, q in zip(order, quotas, strict=True):
        n = shards[s] if s is not None else shards[shards.index.isna()].sum()
        # A quota is blocks of BLOCK words, but for the last one of each shard.
        assert abs(by_source[s] - q * mixing.BLOCK) <= 3 * mixing.BLOCK * n
        assert abs(by_source[s] - float(want[s])) <= 3 * mixing.BLOCK * (n + 1)


def test_quotas_equal_highest_quotients(spark):
    rows = [(i, w, 3 * w, 1) for i, w in enumerate([905, 17, 350, 350, 1, 76, 2048, 33])]
    total = 700
    df = spark.createDataFrame(rows, "i int, w long, cap long, g int").selectExpr("*", "cast(floor(w * 700 / 3780 + 0.5) as long) as start", f"{total}L as seats")
    got = {r["i"]: r["quota"] for r in mixing.sainte_lague(df, ["g"], "w", "cap", "start", "seats", ["i"]).collect()}
    assert [got[i] for i in range(len(rows))] == seats([r[1] for r in rows], [r[2] for r in rows], total)


def test_taken_is_what_the_ranges_hold_and_reruns_agree(spark):
    rows = awkward_rows(7, 60)
    docs = documents(spark, rows)
    a, b = (mixing.mix(docs.repartition(k), shard_words=3000).toPandas() for k in (2, 7))
    cols = ["doc_id", "size", "taken", "source", "place"]
    assert a[cols].sort_values(cols).astype(str).values.tolist() == b[cols].sort_values(cols).astype(str).values.tolist()
    for r in a.itertuples():
        parts = mixing.taken_ranges(r.place, r.size, r.quota, r.n_blocks, r.turn)
        assert sum(y - x for x, y in parts) == r.taken


def test_documents_hold_the_words_taken(spark):
    rows = awkward_rows(9, 60)
    docs = documents(spark, rows)
    plan = mixing.mix(docs, shard_words=3000).groupBy("doc_id").sum("taken").toPandas()
    out = mixing.mixed_documents(docs, shard_words=3000)
    assert out.columns == docs.columns
    found = out.toPandas()
    have = Counter()
    for r in found.itertuples():
        have[r.doc_id if r.doc_id == r.doc_id else None] += len(WORD.findall(r.text))
        assert r.n_chars == len(r.text) and r.size == "x"
    want = {(None if r[0] != r[0] else r[0]): r[1] for r in plan.values.tolist() if r[1]}
    assert have == want


def test_empty_table(spark):
    assert mixing.mix(documents(spark, [])).count() == 0
    assert mixing.mixed_documents(documents(spark, [])).count() == 0
    assert mixing.mix(documents(spark, [(1, None, None, None)])).collect()[0]["taken"] == 0
