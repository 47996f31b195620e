"""Base findings against the plain patterns; the network on a labelled corpus."""

import hashlib
import random
import re

import numpy as np
import pytest

from rainfold.llm import secrets
from tests.llm.data import awkward_rows, documents, prose

PATTERNS = (
    ("assign", re.compile("([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
                          "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), lambda m: len(m[2]) >= 12),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 16),
)


def plain(text):
    found = [(m.start(), k, name, m.end()) for k, (name, p, ok) in enumerate(PATTERNS) for m in p.finditer(text or "") if ok(m)]
    return [(name, s, e) for s, _, name, e in sorted(found)]


def secret_rows(seed=5, n=400):
    rng = random.Random(seed)
    hexes = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))
    forms = [lambda: f"password={hexes(18)}", lambda: f'Token = "{hexes(40)}"', lambda: "AKIA" + hexes(16).upper(), lambda: hexes(32),
             lambda: "API_KEY: 'é'", lambda: "secret=short", lambda: "token: secret: abcdefghijkl0", lambda: "password==" + hexes(11),
             lambda: f"10.20.{rng.randint(0, 255)}.{rng.randint(100, 255)}", lambda: f"user{rng.randint(0, 99)}.name@mail{rng.randint(0, 9)}.example.com",
             lambda: "AKIAAKIA1", lambda: "ſecret=abcdefghijklmnop", lambda: f"phone-{rng.randint(10**6, 10**7)}-office"]
    return [(1000 + i, f"{prose(rng, rng.randint(0, 30))} é漢 {rng.choice(forms)()} {prose(rng, 5)} {rng.choice(forms)()}", "en", "s0") for i in range(n)]


@pytest.fixture(scope="module")
def scanned(spark):
    rows = awkward_rows() + secret_rows()
    docs = documents(spark, rows)
    scanner = secrets.learn(docs)
    return rows, docs, scanner, secrets.scan(docs, scanner).toPandas()


def test_base_findings_are_the_plain_patterns(scanned):
    rows, _, _, got = scanned
    text = lambda spans: ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
    want = sorted((i or -1, *(sum(x[0] == k for x in plain(t)) for k in ("assign", "access", "hex")), hashlib.sha256(text(plain(t)).encode()).hexdigest()) for i, t, *_ in rows)
    have = sorted((int(np.nan_to_num(r.doc_id, nan=-1)) or -1, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got.itertuples())
    assert have == want


def test_spans_keep_the_base_and_add_only_untouched_candidates(scanned):
    rows, _, _, got = scanned
    texts = {i: t or "" for i, t, *_ in rows if i is not None}
    for r in got[got.doc_id.notna()].itertuples():
        spans = [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in r.spans.split(",") if x)]
        base = plain(texts[int(r.doc_id)])
        assert [x for x in spans if x[0] != "net"] == base
        assert [x[1] for x in spans] == sorted(x[1] for x in spans)
        for _, s, e in (x for x in spans if x[0] == "net"):
            assert all(e <= bs or s >= be for _, bs, be in base)


def test_network_tells_held_out_findings_apart(scanned):
    _, _, scanner, _ = scanned
    held = secret_rows(seed=77, n=200)
    scores, marks = [], []
    for _, t, *_ in held:
        raw = t.encode()
        base = secrets.base_spans(raw)
        for s, _, e in base:
            scores.append(scanner.score([secrets.window(t, s, e)])[0])
            marks.append(1)
        for s, e in secrets.candidates(raw, base):
            scores.append(scanner.score([secrets.window(t, s, e)])[0])
            marks.append(0)
    scores, marks = np.array(scores), np.array(marks)
    found = scores >= scanner.threshold
    assert found[marks == 1].mean() >= 0.95
    assert found[marks == 0].mean() <= 0.1
    # Calibrated: the mean probability is near the share of findings.
    assert abs(scores.mean() - marks.mean()) < 0.1


def test_every_finding_trains_or_calibrates(spark, monkeypatch):
    docs = documents(spark, secret_rows(seed=9, n=1500))
    found = secrets.findings(docs).distinct()
    want = sorted((r["kind"], bytes(r["window"])) for r in found.collect())
    seen = {}
    for name in ("fit", "calibrate"):
        real = getattr(secrets, name)

        def spy(scanner, rows, counts, real=real, name=name):
            seen[name] = sorted((r["kind"], bytes(r["window"])) for r in rows.collect())
            assert counts == {b: sum((k < 3) == b for k, _ in seen[name]) for b in (True, False)}
            real(scanner, rows, counts)

        monkeypatch.setattr(secrets, name, spy)
    monkeypatch.setattr(secrets, "PART_ROWS", 512)  # several parts
    monkeypatch.setattr(secrets, "TRAIN_ROWS", 100, raising=False)  # what a draw would take
    scanner, again = secrets.learn(docs), secrets.learn(docs)
    assert len(want) > 2000 and sorted(seen["fit"] + seen["calibrate"]) == want
    assert 0.2 < len(seen["calibrate"]) / len(want) < 0.3
    assert np.array_equal(scanner.state(), again.state()) and scanner.threshold == again.threshold
    p = scanner.score([w for _, w in seen["calibrate"]])
    kinds = np.array([k for k, _ in seen["calibrate"]])
    kept = [np.sort(p[kinds == k]) for k in range(3)]
    assert abs(scanner.threshold - max(0.5, min(s[int((1 - secrets.RECALL) * len(s))] for s in kept))) < 1e-6
    assert (p[kinds < 3] >= scanner.threshold).mean() > 0.97 and (p[kinds == 3] >= scanner.threshold).mean() < 0.05


def test_lowest_is_an_order_statistic(spark):
    rng = np.random.default_rng(3)
    z = np.clip(np.r_[rng.normal(0, 9, 700), np.full(300, -2.5)], -30, 30).astype(np.float32)
    kinds, bits = rng.integers(0, 3, len(z)), z.view(np.int32)
    rows = spark.createDataFrame([(int(k), int(p)) for k, p in zip(kinds, bits ^ (bits >> 31 & 0x7FFFFFFF), strict=True)], "kind int, place int")
    for share in (0.0, 0.02, 0.4, 0.9):
        assert secrets.lowest(rows, share) == min(np.sort(z[kinds == k])[int(share * (kinds == k).sum())] for k in range(3))


def test_redaction_masks_every_span_and_nothing_else(scanned):
    rows, docs, scanner, _ = scanned
    out = secrets.redact(docs, scanner)
    assert out.columns == docs.columns
    have = sorted((str(r["doc_id"]), r["text"] is None, r["text"] or "", r["n_chars"] or 0, r["row"]) for r in out.collect())
    want = []
    for i, t, *_ in rows:
        text = t
        if t is not None:
            for s, e in reversed(merged(secrets.scan_texts([t.encode()], scanner)[0])):
                text = text[:s] + secrets.MASK + text[e:]
        want.append((str(i), t is None, text or "", len(text or ""), "x"))
    assert have == sorted(want)


def merged(spans):
    out = []
    for s, _, e in spans:
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def test_without_findings_and_empty(spark):
    docs = documents(spark, [(1, "plain words only", "en", "s0")])
    assert secrets.learn(docs) is None
    assert secrets.scan(docs, None).collect()[0]["spans"] == ""
    assert secrets.scan(documents(spark, []), None).count() == 0
    assert secrets.redact(documents(spark, []), None).count() == 0
