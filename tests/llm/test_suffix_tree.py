"""The suffix tree against a plain count of contexts; base scores exactly."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rainfold.llm import suffix_tree
from rainfold.llm.common import held_out
from tests.llm.data import awkward_rows, documents


def tokens(text):
    return (text or "").encode().lower().split()


def plain_tree(lines, depth):
    """Context to its smoothed distribution, by the definition; the least count."""
    total = sum(map(len, lines))
    least = max(2.0, suffix_tree.P_MIN * total)
    counts = defaultdict(Counter)
    for x in lines:
        body = b"\n" + x
        for i in range(1, len(body)):
            for k in range(depth + 1):
                if i - k >= 0:
                    counts[body[i - k:i]][body[i]] += 1
    probs = {b"": {c: (counts[b""][c] + 0.5) / (total + 128) for c in range(256)}}
    for ctx in sorted((c for c in counts if c and sum(counts[c].values()) >= least), key=len):
        suffix, n = probs[ctx[1:]], sum(counts[ctx].values())
        gain = sum(v * math.log(v / n / suffix[c]) for c, v in counts[ctx].items())
        if gain >= suffix_tree.GAIN:
            room = suffix_tree.DISCOUNT * len(counts[ctx])
            probs[ctx] = {c: (counts[ctx][c] + room * suffix[c]) / (n + room) for c in range(256)}
        else:
            probs[ctx] = suffix
    return probs


def plain_score(probs, line, depth):
    body, out = b"\n" + line, 0.0
    for i in range(1, len(body)):
        k = max(k for k in range(min(i, depth) + 1) if body[i - k:i] in probs)
        out += math.log10(probs[body[i - k:i]][body[i]])
    return out


@pytest.fixture(scope="module")
def scored(spark):
    rows = [r for r in awkward_rows(8, 120) if r[0] not in (107, 113)]
    return rows, suffix_tree.score(documents(spark, rows), ~held_out("doc_id", 7, 2)).toPandas()


def trains(i):
    return i is None or zlib.crc32(str(i).encode()) % 7 != 2


def test_base_scores_and_counts(scored):
    rows, got = scored
    counts = Counter()
    for i, t, *_ in rows:
        if trains(i):
            counts.update([*tokens(t), b"\n"])
    n, v = sum(counts.values()), len(counts)
    want = sorted((-1 if i is None else i, not trains(i), len(x), sum(counts[w] > 0 for w in x), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in x), 6))
                  for i, t, *_ in rows for x in [[*tokens(t), b"\n"]])
    have = sorted((int(np.nan_to_num(r.doc_id, nan=-1)), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got.itertuples())
    assert have == want


def test_scores_are_the_plain_trees(scored):
    rows, got = scored
    probs = plain_tree([suffix_tree.line((t or "").encode()) for i, t, *_ in rows if trains(i)], suffix_tree.DEPTH)
    want = sorted((-1 if i is None else i, round(plain_score(probs, suffix_tree.line((t or "").encode()), suffix_tree.DEPTH), 2)) for i, t, *_ in rows)
    have = sorted((int(np.nan_to_num(r.doc_id, nan=-1)), round(r.score, 2)) for r in got.itertuples())
    assert len(have) == len(want)
    for (i, a), (j, b) in zip(have, want, strict=True):
        assert i == j and abs(a - b) <= 0.02 + 1e-4 * abs(b)


def test_distributions_sum_to_one(scored):
    rows, _ = scored
    for dist in list(plain_tree([suffix_tree.line((t or "").encode()) for i, t, *_ in rows], 3).values())[:200]:
        assert abs(sum(dist.values()) - 1) < 1e-9


def test_held_out_prose_beats_a_flat_model(scored):
    rows, got = scored
    texts = {i: t for i, t, *_ in rows}
    held = got[got.held_out & (got.n_tokens > 30)]
    for r in held.itertuples():
        assert r.score > -len(suffix_tree.line(texts[int(r.doc_id)].encode())) * math.log10(256) / 2


def test_long_nul_and_empty(spark):
    rows = [(1, "w" * 300_000 + " x" * 100_000, "en", "a"), (2, "nul \x00 byte", "en", "a"), (3, None, None, None)]
    got = suffix_tree.score(documents(spark, rows), F.lit(True)).toPandas()
    assert got["n_tokens"].sum() == 100_001 + 1 + 4 + 1 and np.isfinite(got["score"]).all()
    assert suffix_tree.score(documents(spark, []), held_out("doc_id", 7, 2)).count() == 0
    none = suffix_tree.score(documents(spark, rows), F.lit(False)).toPandas()
    assert (none["train_tokens"] == 0).all() and np.isfinite(none["score"]).all()


def test_a_context_is_kept_by_its_evidence_not_its_share(spark):
    rare = "qzjxkvbpfygmhcdulriotnaes"  # 8 occurrences in 4 MB: less than 3 in a million
    rows = [(i, "w" * 200_000, "en", "a") for i in range(20)] + [(100 + i, rare, "en", "a") for i in range(8)]
    got = suffix_tree.score(documents(spark, rows), F.lit(True)).toPandas().set_index("doc_id")
    assert (got.loc[100:, "score"] > -0.5 * len(rare)).all()


def test_groups_of_strings_are_never_cut(spark, monkeypatch):
    rows = [r for r in awkward_rows(9, 60) if r[0] not in (107, 113)]
    docs = documents(spark, rows)
    found = suffix_tree.count_strings(suffix_tree.packets(docs, F.lit(True), "doc_id", "text"), suffix_tree.DEPTH, False).groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    codes, n = (c.to_numpy() for c in found.columns)
    root = (np.bincount(codes & 255, n, 256) + 0.5) / (n.sum() + 128)
    whole = np.log10(suffix_tree.walk(codes, n, root[codes & 255], range(1, suffix_tree.DEPTH + 1)))
    monkeypatch.setattr(suffix_tree, "ROWS", 50)
    import pyarrow as pa

    order = np.lexsort((codes & suffix_tree.BODY, codes >> 32 & 0xFFFFFF))
    batches = [pa.RecordBatch.from_arrays([pa.array(codes[order[a:a + 7]])], names=["code"]) for a in range(0, len(order), 7)]
    parts = [c[0] for c in suffix_tree.together(batches, lambda c: c >> 24 & 0xFFFFFFFF)]
    assert np.array_equal(np.concatenate(parts), codes[order]) and len(parts) > 5
    assert all(a[-1] >> 24 & 0xFFFFFFFF != b[0] >> 24 & 0xFFFFFFFF for a, b in zip(parts, parts[1:]))
    dealt = suffix_tree.learn(spark.createDataFrame(found)).toPandas().set_index("code")["score"]
    assert np.allclose(dealt.loc[codes], whole, atol=1e-4)


def test_strings_cross_the_exchange_packed_by_block_and_bucket(spark, monkeypatch, scored):
    import re

    rows, whole = scored
    docs, train = documents(spark, rows), ~held_out("doc_id", 7, 2)
    monkeypatch.setattr(suffix_tree, "BLOCK_BYTES", 1 << 12)
    monkeypatch.setattr(suffix_tree, "PACKET_BYTES", 1 << 10)
    table = suffix_tree.packets(docs, train, "doc_id", "text")
    strings = suffix_tree.count_strings(table, suffix_tree.DEPTH, True).toPandas()
    asked = suffix_tree.ask_strings(table, suffix_tree.DEPTH, 16).toPandas()
    assert strings.block.nunique() > 4 and not asked.duplicated(["bucket", "block"]).any()
    have = [(r.block, int(c), int(n)) for r in asked.itertuples() for c, n in zip(suffix_tree.expanded_codes(r.keys), suffix_tree.expanded(r.counts, np.int64), strict=True)]
    assert sorted(have) == sorted(strings.itertuples(index=False, name=None))
    result = suffix_tree.score(docs, train)
    assert not re.search("Join|Window", result._jdf.queryExecution().executedPlan().toString())
    got = result.toPandas()
    order = ["doc_id", "n_tokens", "base_score", "score"]
    a, b = (x.sort_values(order, ignore_index=True) for x in (whole, got))
    assert a[order[:3]].equals(b[order[:3]]) and np.allclose(a.score, b.score, rtol=1e-5, atol=1e-3)


def test_packed_numbers_come_back():
    rng = np.random.default_rng(4)
    codes = np.unique(rng.integers(0, 1 << 59, 5000))
    assert np.array_equal(suffix_tree.expanded_codes(suffix_tree.squeezed_codes(codes)), codes)
    for x in (rng.normal(size=100).astype(np.float32), rng.integers(0, 9, 7), np.zeros(0, np.int64)):
        assert np.array_equal(suffix_tree.expanded(suffix_tree.squeezed(x), x.dtype), x)
    ends = codes >> 32 & 0xFFFFFF
    seen = {}
    for bucket, at in suffix_tree.by_bucket(codes, 7):
        assert (np.diff(codes[at]) > 0).all()
        assert all(seen.setdefault(e, bucket) == bucket for e in ends[at].tolist())
    assert sum(len(at) for _, at in suffix_tree.by_bucket(codes, 7)) == len(codes)
