import random
import re
from collections import Counter

import numpy as np

from rainfold.llm import phrases as P
from tests.llm.data import awkward_rows, documents

BREAK, WORD = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain(rows, least, top):
    """The ranked phrases by the definition."""
    counts, out = {}, []
    for _, text, lang, _ in rows:
        f = counts.setdefault(lang or "und", Counter())
        for piece in BREAK.split(lower(text or "")):
            words = tuple(WORD.findall(piece))
            for size in (1, 2, 3):
                f.update(words[i:i + size] for i in range(len(words) - size + 1))
    for lang, f in counts.items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        often = {g: c for g, c in f.items() if len(g) > 1 and c >= least}
        kept = []
        for g, a in often.items():
            if any(100 * c >= 50 * a and g in (x[:2], x[1:]) for x, c in often.items() if len(x) > len(g)):
                continue
            score, k = min((1000000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            kept.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        out += [(lang, rank, p.decode(), -a, l, r, n, -s) for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def text_rows(n=160, seed=2):
    rng = random.Random(seed)
    vocab = ["Alpha", "beta", "gamma", "a\x01", "a", "É", "é", "\x85x", "漢", "the", "of"]
    fixed = ["new york city", "ad hoc", "of the", "the the the"]
    def text():
        return " ".join(rng.choice(fixed) if rng.random() < 0.3 else rng.choice(vocab) + rng.choice(["", "", "", ".", ",", "\n", "\t", "\r"]) for _ in range(rng.randint(1, 40)))
    return [(i, text(), rng.choice(["en", "en", "de", None, "und"]), "s") for i in range(n)]


def found(df):
    return sorted(tuple(r) for r in df.collect())


def test_phrases_by_the_definition(spark, monkeypatch):
    monkeypatch.setattr(P, "BUCKET_WORDS", 500)  # several merging tasks
    rows = text_rows() + awkward_rows()
    want = plain(rows, 10, 2000)
    got = found(P.collocations(documents(spark, rows).repartition(5)))
    assert got == want
    assert {r[0] for r in got} >= {"en", "de", "und"} and {len(r[2].split(" ")) for r in got} == {2, 3}


def test_first_rows_a_language_and_ties(spark):
    rows = [(i, "p q. r s. t u. v w x", "en", "s") for i in range(12)]
    assert found(P.collocations(documents(spark, rows), top=3)) == plain(rows, 10, 3)


def test_nothing_gives_nothing(spark):
    assert P.collocations(documents(spark, [])).collect() == []
    assert P.collocations(documents(spark, [(1, None, "en", "s"), (2, "... \n", None, "s"), (3, "once only", "en", "s")])).collect() == []


def test_scores_are_exact_beyond_64_bits(spark):
    a, l, r = 987_654_321_012, 987_654_321_013, 987_654_321_019
    got = spark.createDataFrame([(a, l, r)], "a long, l long, r long").select(P._score("a", "l", "r").alias("s")).first()[0]
    assert got == 1_000_000 * a * a // (l * r)


def test_texts_are_cut_between_pieces_only():
    text = b"one two.three four five.six.seven eight nine ten eleven twelve.x"
    for limit in (3, 8, 20, 1000):
        parts = list(P._parts(text, limit))
        assert b".".join(parts) == text and all(len(p) <= limit or b"." not in p for p in parts)
    assert list(P._parts(b"", 5)) == [b""]


def test_packed_columns_come_back():
    rng = np.random.default_rng(1)
    cols = [np.sort(rng.integers(0, 2**32, 1000)), rng.integers(0, 2**32, 1000), rng.integers(1, 9, 1000)]
    for part in (cols, cols[:1], [c[:0] for c in cols]):
        for a, b in zip(part, P._unpack(P._pack(*part), len(part)), strict=True):
            assert (a == b).all()
