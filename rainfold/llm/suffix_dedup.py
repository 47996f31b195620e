"""Exact substring removal with a logarithmic family of sparse suffix arrays.

A byte goes if a string of ``SPAN`` bytes that covers it starts anywhere else
in the corpus as well, in the same document or another.

*Suffixes.*  Of the SPAN - GRAM + 1 strings of GRAM bytes in a span, the
smallest hash (the last of equals) is the span's anchor: equal spans have
their anchor at the same place.  So only suffixes that start at anchors are
indexed, about one in 180 bytes, and each stands for the spans that it anchors,
a run of neighbouring starts [a, b]; ``whole`` is the hash of the text from a
to b + SPAN.

*Index family.*  The corpus comes in batches.  A batch's suffixes are counted
and sorted into a suffix array (by their first 8 bytes, then the hash of
GRAM), merge-scanned against the arrays of all existing levels, and added as a
level of its own; levels of equal size merge geometrically.  Suffixes that the
scan meets elsewhere are the long matches that remain to be verified.

*Spans.*  A met suffix whose ``whole`` occurs again has all its spans repeated.
For suffixes that others share but for their surroundings, the surrounding
text of each distinct one goes to the task of its suffix, where the hashes of
all spans of equal distance to the anchor are compared.  Where more than
``HOT`` surroundings share one suffix, its spans are dealt out one by one
instead, keyed by their hashes, so that no task holds them together.

Hashes are 64 bits wide and always compared together with the suffix's own 64
bits and 8 bytes of text.

*Copies.*  Rows with the same text have the same suffixes: each is kept once, with
the number of copies as its weight in every count, and so are its spans.

Edge cases: null and empty texts, and those shorter than SPAN, keep everything;
repeated rows lose everything from SPAN bytes on; documents are told apart by
two hashes of their text, so null and repeated ids do no harm; long texts are
hashed in overlapping segments; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import materialize, ship_package, utf8

SPAN = 400
GRAM = 48
REACH = SPAN - GRAM + 1  # strings of GRAM bytes in a span
BATCHES = 4
HOT = 2000
#: Bytes hashed at a time; longer texts are cut into overlapping segments.
SEGMENT = 1 << 21

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, as far as needed."""
    if 0 not in _POWERS or len(_POWERS[0][0]) < n:
        m = max(n, 1 << 12)
        up, down = (np.cumprod(np.r_[np.uint64(1), np.full(m - 1, x, np.uint64)], dtype=np.uint64) for x in (_BASE, _INVERSE))
        _POWERS[0] = (up, down)
    return _POWERS[0]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class Hashes:
    """Hashes of any substrings of a byte array, from prefix sums mod 2^64."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * up[:len(data)], out=self.sums[1:])

    def of(self, starts, ends) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def least_at(h: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values, the place of the smallest (last of equals)."""
    n = len(h)
    low = np.uint64((1 << 22) - 1)  # room for a place in a segment
    packed = (h & ~low) | (low - np.arange(n, dtype=np.uint64))
    m = -(-n // width) * width
    block = np.full(m, np.iinfo(np.uint64).max, np.uint64)
    block[:n] = packed
    rows = block.reshape(-1, width)
    right = np.minimum.accumulate(rows, 1).ravel()
    left = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    least = np.minimum(left[:n - width + 1], right[width - 1:n])
    return (low - (least & low)).astype(np.int64)


def anchors(text: np.ndarray, hashes: Hashes, ends: np.ndarray):
    """(anchor, a, b) of the spans in a byte array; ``ends`` gives for each place
    where its document ends."""
    n = len(text) - SPAN + 1
    starts = np.arange(len(text) - GRAM + 1)
    at = least_at(hashes.of(starts, starts + GRAM), REACH)
    fits = np.flatnonzero(np.arange(n) + SPAN <= ends[:n])
    if not len(fits):
        return np.zeros((3, 0), np.int64)
    owner = at[fits]
    new = np.flatnonzero((np.diff(fits) != 1) | (np.diff(owner) != 0) | (np.diff(ends[fits]) != 0)) + 1
    first, last = np.r_[0, new], np.r_[new - 1, len(fits) - 1]
    return np.stack([owner[first], fits[first], fits[last]])


def segments(rows):
    """(keys, byte array, document number at each place, ends, shift) of bounded
    size from (key, bytes) rows; a long text comes in overlapping segments.
    Adjacent segments share no span start."""
    held, size = [], 0
    for key, raw in rows:
        if len(raw) < SPAN:
            continue
        for a in range(0, len(raw) - SPAN + 1, SEGMENT):
            part = raw[a:a + SEGMENT + SPAN - 1]
            if held and size + len(part) > SEGMENT:
                yield held
                held, size = [], 0
            held.append((key, a, part))
            size += len(part)
    if held:
        yield held


def analysed(held):
    """The spans of a segment's parts: byte array, hashes, each anchor's part,
    and anchor, a, b as places in the array; with the parts' first places."""
    data = np.frombuffer(b"".join(p for _, _, p in held), np.uint8)
    sizes = np.array([len(p) for _, _, p in held])
    firsts = np.cumsum(sizes) - sizes
    ends = np.repeat(firsts + sizes, sizes)
    hashes = Hashes(data)
    p, a, b = anchors(data, hashes, ends)
    return data, hashes, np.searchsorted(firsts, a, "right") - 1, p, a, b, firsts


def heads(data: np.ndarray, hashes: Hashes, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A suffix's first 8 bytes, as a number that sorts like them, and its hash."""
    first = data[p[:, None] + np.arange(8)].copy().view(">u8").ravel().astype(np.uint64)
    return (first ^ np.uint64(1 << 63)).view(np.int64), hashes.of(p, p + GRAM).view(np.int64)


def doc_key(text: str) -> list[Column]:
    body = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(body).alias("t1"), F.conv(F.substring(F.md5(body), 1, 15), 16, 10).cast("long").alias("t2")]


def suffixes(docs: DataFrame) -> DataFrame:
    """(t1, t2, p, a, b, pre, gram, whole) of a table (t1, t2, text in bytes)."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            keys = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
            for held in segments(((k, x.as_py() or b"") for k, x in zip(keys, b.column(2), strict=True))):
                data, hashes, part, p, a, last, firsts = analysed(held)
                if not len(p):
                    continue
                pre, gram = heads(data, hashes, p)
                shift = np.array([s for _, s, _ in held])[part] - firsts[part]
                cols = [np.array([k[i] for k, _, _ in held])[part] for i in (0, 1)]
                cols += [p + shift, a + shift, last + shift, pre, gram, hashes.of(a, last + SPAN).view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["t1", "t2", "p", "a", "b", "pre", "gram", "whole"])

    ship_package(docs.sparkSession)
    return docs.mapInArrow(run, "t1 long, t2 long, p long, a long, b long, pre long, gram long, whole long")


def weighted(suffixes: DataFrame) -> DataFrame:
    """Each text's suffixes once, with the number of its copies."""
    place = ["t1", "t2", "p", "a", "b", "pre", "gram", "whole"]
    return suffixes.groupBy(*place).agg(F.count(F.lit(1)).alias("copies"))


class IndexFamily:
    """Levels of sparse suffix arrays: tables (pre, gram, n), each suffix once."""

    def __init__(self):
        self.levels: list[tuple[int, DataFrame]] = []  # (batches in it, array)

    def add(self, suffixes: DataFrame) -> DataFrame:
        """Add a batch; returns the suffixes (pre, gram) that occur elsewhere in
        it or in a level."""
        n = F.sum("copies") if "copies" in suffixes.columns else F.count(F.lit(1))
        array = suffixes.groupBy("pre", "gram").agg(n.alias("n"))
        array = materialize(array.sortWithinPartitions("pre", "gram"), "suffix-array")
        met = array.where("n > 1").select("pre", "gram")
        for _, level in self.levels:
            met = met.unionByName(array.join(level.select("pre", "gram"), ["pre", "gram"], "left_semi").select("pre", "gram"))
        met = materialize(met.distinct(), "suffix-met")
        self.levels.append((1, array))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (m, new), (_, old) = self.levels.pop(), self.levels.pop()
            merged = new.unionByName(old).groupBy("pre", "gram").agg(F.sum("n").alias("n"))
            self.levels.append((2 * m, materialize(merged.sortWithinPartitions("pre", "gram"), "suffix-array")))
        return met


def surroundings(docs: DataFrame) -> DataFrame:
    """(pre, gram, whole, before, around) of a table (t1, t2, text, places): for
    the anchors at the listed places, how many bytes before them their spans
    begin, and the text of all their spans."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            wanted = [set(x) for x in b.column(3).to_pylist()]
            for held in segments(((i, x.as_py()) for i, x in enumerate(b.column(2)))):
                data, hashes, part, p, a, last, firsts = analysed(held)
                place = p + np.array([s for _, s, _ in held])[part] - firsts[part]
                use = np.array([q in wanted[held[j][0]] for q, j in zip(place.tolist(), part.tolist(), strict=True)], bool)
                p, a, last = p[use], a[use], last[use]
                if not len(p):
                    continue
                pre, gram = heads(data, hashes, p)
                whole = hashes.of(a, last + SPAN).view(np.int64)
                raw = data.tobytes()
                around = [raw[x:y + SPAN] for x, y in zip(a.tolist(), last.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pre), pa.array(gram), pa.array(whole), pa.array((p - a).astype(np.int32)), pa.array(around, pa.binary())],
                    names=["pre", "gram", "whole", "before", "around"])

    return docs.mapInArrow(run, "pre long, gram long, whole long, before int, around binary")


def span_hashes(around: list[bytes], before: np.ndarray):
    """Of each surrounding all its spans: row, distance to the anchor, hash."""
    sizes = np.array([len(x) for x in around])
    hashes = Hashes(np.frombuffer(b"".join(around), np.uint8))
    counts = sizes - SPAN + 1
    row = np.repeat(np.arange(len(around)), counts)
    inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    start = (np.cumsum(sizes) - sizes)[row] + inner
    return row, before[row] - inner, hashes.of(start, start + SPAN)


def runs(row: np.ndarray, dist: np.ndarray):
    """Maximal runs of falling distances (rising starts) within rows: row, first
    and last distance."""
    if not len(row):
        return row, dist, dist
    new = np.flatnonzero((np.diff(row) != 0) | (np.diff(dist) != -1)) + 1
    first, last = np.r_[0, new], np.r_[new - 1, len(row) - 1]
    return row[first], dist[first], dist[last]


RUNS = "pre long, gram long, whole long, far int, near int"


def compare(around: DataFrame) -> DataFrame:
    """Runs of repeated spans of each surrounding (pre, gram, whole, before,
    around, n), rows of a suffix together: far and near are the distances to the
    anchor of the run's first and last span."""

    def run(batches):
        import pyarrow as pa

        def repeated(rows):
            pre, gram, whole, before, text, n = (list(c) for c in zip(*rows, strict=True))
            pre, gram, whole = (np.array(c, np.int64) for c in (pre, gram, whole))
            group = np.cumsum(np.r_[0, (np.diff(pre) != 0) | (np.diff(gram) != 0)])
            row, dist, h = span_hashes(text, np.array(before))
            key = mix(h ^ mix(group[row].astype(np.uint64) * np.uint64(1024) + dist.astype(np.uint64)))
            _, at = np.unique(key, return_inverse=True)
            again = np.bincount(at, np.array(n, float)[row])[at] > 1
            row, far, near = runs(row[again], dist[again])
            cols = [pre[row], gram[row], whole[row], far.astype(np.int32), near.astype(np.int32)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["pre", "gram", "whole", "far", "near"])

        held, size = [], 0
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if size > SEGMENT and r[:2] != held[-1][:2]:
                    yield repeated(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[4])
        if held:
            yield repeated(held)

    rows = around.select("pre", "gram", "whole", "before", "around", "n")
    return rows.repartition("pre", "gram").sortWithinPartitions("pre", "gram").mapInArrow(run, RUNS)


def compare_hot(around: DataFrame) -> DataFrame:
    """The same for suffixes with many surroundings: a row a span, keyed by its hash."""

    def spread(batches):
        import pyarrow as pa

        for b in batches:
            text, before = b.column(4).to_pylist(), b.column(3).to_numpy()
            for a in range(0, len(text), 1024):
                row, dist, h = span_hashes(text[a:a + 1024], before[a:a + 1024])
                cols = [b.column(i).to_numpy()[a + row] for i in (0, 1, 2)] + [dist.astype(np.int32), h.view(np.int64), b.column(5).to_numpy()[a + row]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["pre", "gram", "whole", "dist", "h", "n"])

    spans = around.select("pre", "gram", "whole", "before", "around", "n").mapInArrow(spread, "pre long, gram long, whole long, dist int, h long, n long")
    again = spans.groupBy("pre", "gram", "dist", "h").agg(F.sum("n").alias("m")).where("m > 1").drop("m")
    found = spans.join(again, ["pre", "gram", "dist", "h"], "left_semi")
    # Neighbouring distances of one surrounding (SPAN at most) make a run.
    mine = Window.partitionBy("pre", "gram", "whole")
    turn = F.col("dist") - F.row_number().over(mine.orderBy("dist"))
    return found.withColumn("run", turn).groupBy("pre", "gram", "whole", "run").agg(F.max("dist").cast("int").alias("far"), F.min("dist").cast("int").alias("near")).drop("run")


def repeated_spans(docs: DataFrame, batches: int = BATCHES, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """Of a table (t1, t2, text in bytes): the rows with a met suffix, and
    (t1, t2, first, last) runs of starts of repeated spans."""
    found = materialize(weighted(suffixes(docs)), "suffixes")
    family = IndexFamily()
    met = None
    for i in range(batches):
        batch = found.where(F.pmod(F.xxhash64("t1"), F.lit(batches)) == i)
        new = family.add(batch)
        met = new if met is None else met.unionByName(new)
    # Written, not just distinct: a join with a table in its own right can split a suffix that is all over.
    met = materialize(met.distinct(), "suffix-met")
    seen = materialize(found.join(met, ["pre", "gram"], "left_semi"), "suffix-seen")
    wholes = seen.groupBy("pre", "gram", "whole").agg(F.sum("copies").alias("n"))
    shared = Window.partitionBy("pre", "gram")
    kinds = materialize(wholes.withColumn("kinds", F.count(F.lit(1)).over(shared)), "suffix-kinds")
    # All spans of a whole that occurs again are repeated; of others with the same suffix, some may be.
    full = seen.join(kinds.where("n > 1").select("pre", "gram", "whole"), ["pre", "gram", "whole"], "left_semi").select("t1", "t2", F.col("a").alias("first"), F.col("b").alias("last"))
    open_ = kinds.where("kinds > 1")
    one = seen.join(open_, ["pre", "gram", "whole"]).groupBy("pre", "gram", "whole", "n", "kinds").agg(F.min(F.struct("t1", "t2", "p")).alias("at"))
    places = one.select("at.*").groupBy("t1", "t2").agg(F.collect_list("p").alias("places"))  # a document's own, at most one in a byte
    # Copies go before the join: they meet in the tasks that read them, not all in one.
    matched = materialize(docs.dropDuplicates(["t1", "t2"]).join(seen.select("t1", "t2").distinct(), ["t1", "t2"], "left_semi"), "suffix-docs")
    texts = matched.join(places, ["t1", "t2"]).select("t1", "t2", "text", "places")
    around = surroundings(texts).join(open_.select("pre", "gram", "whole", "n", "kinds"), ["pre", "gram", "whole"])
    around = materialize(around, "suffix-around")
    parts = compare(around.where(F.col("kinds") <= hot)).unionByName(compare_hot(around.where(F.col("kinds") > hot)))
    rest = seen.join(kinds.where("n = 1 and kinds > 1").select("pre", "gram", "whole"), ["pre", "gram", "whole"], "left_semi")
    some = rest.join(parts, ["pre", "gram", "whole"]).select("t1", "t2", (F.col("p") - F.col("far")).alias("first"), (F.col("p") - F.col("near")).alias("last"))
    return matched, full.unionByName(some)


def _cut(raw: bytes, spans) -> tuple[bytes, int, int]:
    """What is left of a text, and how many bytes and runs go."""
    out, at, removed, n = [], 0, 0, 0
    end = -1
    for s, last in sorted(spans):
        e = last + SPAN
        if s > end:  # a new run: whatever lies between stays
            n += 1
            out.append(raw[at:s])
            removed += e - s
        elif e > end:
            removed += e - end
        end = max(end, e)
        at = end
    return b"".join([*out, raw[at:]]), removed, n


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", batches: int = BATCHES, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes; null
    where nothing goes) and kept_sha256."""
    rows = df.select(F.col(key).alias("doc_id"), *doc_key(text), utf8(text).alias("text"))
    matched, spans = repeated_spans(rows.select("t1", "t2", "text"), batches, hot)
    spans = materialize(spans, "suffix-spans")
    of_text = spans.groupBy("t1", "t2").agg(F.collect_list(F.struct("first", "last")).alias("spans"))  # a text's own, each once

    def run(batches):
        import pyarrow as pa

        for b in batches:
            out = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                kept, removed, n = _cut(x.as_py(), [(s["first"], s["last"]) for s in y.as_py()])
                out.append((kept, removed, n, hashlib.sha256(kept).hexdigest()))
            kept, removed, n, sha = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(removed, pa.int64()), pa.array(n, pa.int64()), pa.array(kept, pa.binary()), pa.array(sha)],
                names=["t1", "t2", "n_removed", "n_spans", "kept", "sha"])

    ship_package(df.sparkSession)
    cut = matched.join(of_text, ["t1", "t2"]).select("t1", "t2", "text", "spans").mapInArrow(
        run, "t1 long, t2 long, n_removed long, n_spans long, kept binary, sha string")
    none = F.lit(0).cast("long")
    whole = F.coalesce(F.col("text"), F.lit(b""))
    plain = rows.select("doc_id", "t1", "t2", F.length(whole).cast("long").alias("n_bytes"), F.sha2(whole, 256).alias("own_sha"))
    return plain.join(cut, ["t1", "t2"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", none).alias("n_removed"), F.coalesce("n_spans", none).alias("n_spans"),
        "kept", F.coalesce("sha", "own_sha").alias("kept_sha256"))
