"""Removal against every 400-byte string of a small corpus."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from rainfold.llm import suffix_dedup as S
from tests.llm.data import awkward_rows, documents, prose


def corpus(seed):
    rng = random.Random(seed)
    rows = awkward_rows(seed, 20)
    line = prose(rng, 140)
    exact = (prose(rng, 200) * 2)[:S.SPAN]
    for i in range(30):  # passages in other surroundings, some just long enough or too short
        cut = rng.choice([line, line[:S.SPAN + 5], line[3:S.SPAN + 3], line[:S.SPAN - 1], exact, line[200:]])
        rows.append((300 + i, prose(rng, rng.randint(0, 40)) + cut + prose(rng, rng.randint(0, 40)), "en", "s0"))
    rows.append((400, "ab" * 3000, "en", "s0"))
    rows.append((401, "é漢" * 500 + line, "en", "s0"))
    rows.append((402, "z" * S.SPAN, "en", "s0"))
    rows.append((403, "y" * (S.SPAN + 1), "en", "s0"))
    return rows


def plain(rows):
    raws = [(t or "").encode() for _, t, *_ in rows]
    seen = Counter(raw[i:i + S.SPAN] for raw in raws for i in range(len(raw) - S.SPAN + 1))
    out = []
    for (i, *_), raw in zip(rows, raws, strict=True):
        gone = np.zeros(len(raw) + 1, bool)
        for k in range(len(raw) - S.SPAN + 1):
            if seen[raw[k:k + S.SPAN]] > 1:
                gone[k:k + S.SPAN] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone[:-1]])
        out.append((-1 if i is None else i, len(raw), int(gone.sum()), int((np.diff(np.r_[False, gone]).astype(int) & gone).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("seed", "batches", "hot"), [(1, 4, 2000), (2, 3, 1)])
def test_against_every_string(spark, seed, batches, hot):
    rows = [r for r in corpus(seed) if r[0] != 107]
    got = S.remove_repeats(documents(spark, rows), batches=batches, hot=hot).collect()
    have = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got)
    assert have == plain(rows)
    for r in got:
        if r["kept"] is not None:
            assert hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"]


def test_levels_merge_geometrically(spark):
    family = S.IndexFamily()
    sizes = []
    for i in range(5):
        batch = spark.createDataFrame([(i % 2, 7), (10 + i, 8)], "pre long, gram long")
        met = family.add(batch).collect()
        assert len(met) == (i >= 2)
        sizes.append([n for n, _ in family.levels])
    assert sizes == [[1], [2], [2, 1], [4], [4, 1]]


def test_long_text_is_cut_into_segments(spark, monkeypatch):
    rng = np.random.default_rng(1)
    body = bytes(rng.integers(97, 123, 6000, dtype=np.uint8)).decode()
    text = body[:3000] + body[1000:2500] + body[3000:]
    monkeypatch.setattr(S, "SEGMENT", 1 << 10)
    rows = [(1, text, "en", "s0"), (2, body[4000:4700], "en", "s0")]
    held = list(S.segments((i, t.encode()) for i, t, *_ in rows))
    spans = [(k, s + a) for part in held for k, s, raw in part for a in range(len(raw) - S.SPAN + 1)]
    assert sorted(spans) == [(i, a) for i, t, *_ in rows for a in range(len(t) - S.SPAN + 1)]
    got = S.remove_repeats(documents(spark, rows)).collect()
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == plain(rows)


def test_empty_table(spark):
    assert S.remove_repeats(documents(spark, [])).count() == 0
    assert S.remove_repeats(documents(spark, [(1, None, None, None)])).collect()[0]["n_removed"] == 0


def test_spans_of_copies_are_held_once(spark):
    rng = random.Random(5)
    text, line = prose(rng, 300), prose(rng, 140)
    rows = [(i, text, "en", "s0") for i in range(50)] + [(100 + i, prose(rng, 10) + line + prose(rng, 10), "en", "s0") for i in range(4)] + [(200, text + line, "en", "s0")]
    rows += [(300 + i, rows[50][1], "en", "s0") for i in range(3)]
    docs = documents(spark, rows).select(*S.doc_key("text"), S.utf8("text").alias("text"))
    spans = S.repeated_spans(docs)[1].collect()
    assert len(spans) == len(set(spans))
    assert S.weighted(S.suffixes(docs)).groupBy("t1", "t2", "p", "a").count().where("count > 1").count() == 0
    got = S.remove_repeats(documents(spark, rows)).collect()
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == plain(rows)


def test_shared_passages_go_by_their_bytes_not_their_words(spark):
    rng = random.Random(11)
    short, long = "ab cd efg " * 6 + prose(rng, 60)[:320], prose(rng, 140)  # over 50 words, under and over SPAN bytes
    assert len(short.split()) > 50 and len(short) < S.SPAN < len(long)
    rows = [(100 * k + i, f"{prose(rng, 20)}<{k}{i}>{cut}<{i}{k}>{prose(rng, 20)}", "en", "s0") for k, cut in enumerate((short, long)) for i in range(8)]
    got = S.remove_repeats(documents(spark, rows).repartition(5)).collect()
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == plain(rows)
    assert all((r["n_removed"] >= len(long)) == (r["doc_id"] >= 100) and (r["n_removed"] > 0) == (r["doc_id"] >= 100) for r in got)
