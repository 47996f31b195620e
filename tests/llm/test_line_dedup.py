import random

import numpy as np
from pyspark.sql import functions as F

from rainfold.llm import line_dedup as L
from tests.llm.data import awkward_rows, documents

WHITE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def plain(rows):
    """[(doc_id, n_lines, n_dropped, kept)] by the definition."""
    held = {}
    for at, (i, text, *_) in enumerate(rows):
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= 20:
                held.setdefault(k, []).append(-1 if i is None else i)
    out = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if len(held.get(key(x), ())) < 3 or max(held[key(x)]) == (-1 if i is None else i)]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], bytes(r["kept"]).decode()) for r in df.collect()), key=repr)


def page(rng, pool):
    return "\n".join(rng.choice(pool) if rng.random() < 0.7 else f"line of its own, number {rng.random()}" for _ in range(rng.randint(1, 12)))


def corpus(n=120, seed=5):
    rng = random.Random(seed)
    pool = [f"  Common line {i} with a Tail \t" for i in range(40)] + ["short", "", "exactly twenty chars", "nineteen characters", "É" * 20, "é" * 20, "É" * 19]
    return [(i, page(rng, pool), "en", "s") for i in range(n)]


def test_dedup_by_the_definition(spark):
    rows = corpus() + awkward_rows()
    rows += [(None, "a line that only nulls have here", "en", None)] * 3 + [(900, "a line of one document thrice here", "en", None)] * 3
    got = rows_of(L.dedup(documents(spark, rows), 2))
    assert got == plain(rows)
    assert any(r[2] for r in got)


def test_nothing_gives_nothing(spark):
    assert L.dedup(documents(spark, [])).collect() == []
    only = [(1, None, None, None), (2, "", "en", "s")]
    assert rows_of(L.dedup(documents(spark, only))) == plain(only)


def state(lines):
    counts = {(r["k1"], r["k2"]): r["refs"] for r in lines.counts().collect()}
    return counts, {r["shard"]: L.Cuckoo.of_row(r["keys"], r["slots"], r["stash"]) for r in lines.filters.collect()}


def test_deleting_a_batch_gives_what_was_before(spark):
    first, second = corpus(60, 1), [(1000 + i, *r[1:]) for i, r in enumerate(corpus(60, 2))]
    a, b = documents(spark, first), documents(spark, second)
    before = L.insert(None, L.holders(a))
    both = L.insert(before, L.holders(b))
    assert rows_of(L.clean(a.unionByName(b), both)) == plain(first + second)
    after = L.delete(both, b.select("doc_id"))
    assert rows_of(L.clean(a, after)) == plain(first)
    (was, old), (now, new) = state(before), state(after)
    assert was == now and {s: f.keys for s, f in old.items()} == {s: f.keys for s, f in new.items()}
    for s, f in new.items():
        assert np.count_nonzero(f.slots) + len(f.stash) == f.keys
        assert f.holds(np.array([k2 for k1, k2 in now if (k1 >> 32) % after.shards == s], np.int64)).all()
    again = L.insert(after, L.holders(b))
    assert rows_of(L.clean(a.unionByName(b), again)) == plain(first + second)
    some = L.delete(both, a.select("doc_id").filter(F.col("doc_id") % 2 == 0))
    left = [r for r in first if r[0] % 2] + second
    assert rows_of(L.clean(documents(spark, left), some)) == plain(left)


def test_a_shard_that_gets_too_full_is_built_anew(spark):
    few = [(0, "the only line that there is at first", "en", "s")]
    more = [(i, f"line number {i} of a larger second batch", "en", "s") for i in range(1, 400)]
    small = L.insert(None, L.holders(documents(spark, few)))
    large = L.insert(small, L.holders(documents(spark, more)))
    (f,) = state(large)[1].values()
    assert f.keys == 400 and len(f.slots) * L.SLOTS >= 400 / L.LOAD > np.prod(state(small)[1][0].slots.shape)
    assert f.holds(np.array([r["k2"] for r in large.counts().collect()], np.int64)).all()


def test_cuckoo_holds_what_was_added_and_forgets_what_was_removed():
    rng = np.random.default_rng(0)
    k = rng.integers(-2**63, 2**63 - 1, 30_000)
    f = L.Cuckoo(np.zeros((8192, L.SLOTS), np.uint16), np.zeros(0, np.int64))
    f.add(k[:15_000])
    f.add(k[15_000:])  # 92 % full
    assert f.holds(k).all()
    assert f.holds(rng.integers(-2**63, 2**63 - 1, 100_000)).mean() < 5e-4
    f.remove(k[::2])
    assert f.holds(k[1::2]).all() and f.holds(k[::2]).mean() < 0.01
    f.remove(k[1::2])
    assert f.keys == 0 and not f.slots.any() and not len(f.stash)


def test_cuckoo_with_more_prints_than_places():
    f = L.Cuckoo(np.zeros((1, L.SLOTS), np.uint16), np.zeros(0, np.int64))
    k = np.arange(1, 41, dtype=np.int64) // 4  # equal prints among them
    f.add(k)
    assert f.holds(k).all() and len(f.stash) == 36
    f.remove(k[:20])
    assert f.holds(k[20:]).all()
    f.remove(k[20:])
    assert not f.slots.any() and not len(f.stash)
