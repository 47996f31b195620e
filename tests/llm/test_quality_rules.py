"""Measures and verdicts by plain Python, thresholds by exact quantiles."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from rainfold.llm import quality_rules as Q
from tests.llm.data import awkward_rows, documents, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_measures(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen = Counter(grams)
    again = {j for i, g in enumerate(grams) if seen[g] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_lines": len(lines),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(again), "upper": sum(c.isupper() for c in text)}


def test_measures_are_the_plain_ones(spark):
    rows = awkward_rows(3, 60) + [(500 + i, "\n".join(["a b c d e f g h i", "x", "", " ", "a b c d e f g h"] * i), "en", "s0") for i in range(4)]
    got = Q.judge(documents(spark, rows)).collect()
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    have = sorted((-1 if r["doc_id"] is None else r["doc_id"], *(r[c] for c in cols), r["base_failed"]) for r in got)
    want = []
    for i, t, *_ in rows:
        m = plain_measures(t)
        want.append((-1 if i is None else i, *(m[c] for c in cols), m["n_words"] < 20 or 100 * m["n_repeat_words"] > 30 * m["n_words"]))
    assert have == sorted(want)


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(11)
    rows = []
    for i in range(900):
        lang, source = ("en", "s0") if i % 3 == 0 else (rng.choice(["en", "de"]), f"s{i % 4}")
        text = prose(rng, rng.randint(30, 120))
        if i % 15 == 0:
            text = " ".join(w + "###" for w in text.split())
        if i % 40 == 7:
            text = text.upper()
        rows.append((i, text, lang, source))
    return rows, Q.judge(documents(spark, rows)).toPandas()


def test_thresholds_are_shrunk_quantiles_of_group_language_and_table(mixed):
    rows, got = mixed
    share, groups = {}, defaultdict(list)
    for i, t, lang, source in rows:
        m = plain_measures(t)
        share[i] = {"symbol_share": m["n_symbols"] / max(m["word_chars"], 1), "dup_line_share": m["n_dup_lines"] / max(m["n_lines"], 1),
                    "repeat_share": m["n_repeat_words"] / m["n_words"], "upper_share": m["upper"] / m["word_chars"], "mean_word": m["word_chars"] / m["n_words"]}
        for g in ((lang, source), lang, None):
            groups[g].append(i)

    def summary(g, m):
        x = sorted(share[i][m] for i in groups[g] if m not in Q.SPARSE or share[i][m] > 0)
        if not x:
            return 0, None
        a, b, c = (x[max(math.ceil(q * len(x)) - 1, 0)] for q in (0.25, 0.5, 0.75))
        return len(x), {"mid": b, "up": c - b, "down": b - a}

    def shrunk(lang, source, m, part):
        value = None
        for g in (None, lang, (lang, source)):
            n, s = summary(g, m)
            if s is not None:
                value = s[part] if g is None else (n * s[part] + Q.PRIOR * value) / (n + Q.PRIOR)
        return value

    verdict, known = {}, {}
    for i, _, lang, source in rows:
        bad = []
        for m, (high, low) in Q.MEASURES.items():
            if (lang, source, m) not in known:
                known[lang, source, m] = [shrunk(lang, source, m, part) for part in ("mid", "up", "down")]
            mid, up, down = known[lang, source, m]
            if mid is not None and share[i][m] > mid + Q.FENCE * max(up, high):
                bad.append(f"{m}_high")
            if mid is not None and low is not None and share[i][m] < mid - Q.FENCE * max(down, low):
                bad.append(f"{m}_low")
        verdict[i] = ",".join(bad)
    assert dict(zip(got.doc_id, got.failed, strict=True)) == verdict


def test_junk_goes_and_prose_stays(mixed):
    _, got = mixed
    junk = (got.doc_id % 15 == 0) | (got.doc_id % 40 == 7)
    assert not got[junk].kept.any()
    assert got[~junk & ~got.base_failed].kept.mean() > 0.99


def test_fences_differ_between_groups_and_come_from_their_rows(spark):
    rng = random.Random(4)
    rows = []
    for i in range(800):
        # one source writes in capitals now and then, the other hardly
        words = prose(rng, 100).split()
        share = rng.uniform(0, 0.3) if i % 2 else rng.uniform(0, 0.05)
        rows.append((i, " ".join(w.upper() if rng.random() < share else w for w in words), "en", f"s{i % 2}"))
    rows += [(1000 + j, " ".join(w.upper() if k % 2 else w for k, w in enumerate(prose(rng, 100).split())), "en", f"s{j}") for j in range(2)]
    docs = documents(spark, rows)
    limits = {r["g_source"]: r["upper_share_high"] for r in Q.fences(Q.shares(Q.measure(docs))).collect()}
    assert limits["s1"] > 2 * limits["s0"]
    kept = {r["doc_id"]: r["kept"] for r in Q.judge(docs).collect()}
    assert (kept[1000], kept[1001]) == (False, True)


def test_only_dataframe_functions(spark):
    plan = Q.measure(documents(spark, awkward_rows()))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_empty_table(spark):
    assert Q.judge(documents(spark, [])).count() == 0
    assert np.all([not r["kept"] for r in Q.judge(documents(spark, [(1, None, None, None)])).collect()])
