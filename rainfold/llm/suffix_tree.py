"""Language-model scoring with a probabilistic suffix tree over bytes.

A text is its tokens (A-Z lower-cased words between ASCII white space), each
followed by a space, then one end mark.  The tree holds contexts of up to
``DEPTH`` bytes: those that occur ``FLOOR`` times, whatever the corpus, and whose
next-byte distribution diverges from their longest suffix's by ``GAIN`` nats
over all their occurrences.  A retained context's distribution is smoothed with
its suffix's (Witten-Bell); every byte is scored by the longest retained suffix
of what stands before it.  The tree grows with the corpus and is never in one
place: the corpus is written once, compressed, in blocks of at most about
``BLOCK_BYTES``, and each block asks for all its distinct strings of a context and
its next byte, with their training counts (0 for those that only other texts
have).  The asks of a block for a bucket of context ends are one compressed row;
all blocks' asks meet at the bucket, where the strings' counts are added up and
walked through the levels, and every ask goes back with its strings' scores.

``base_score`` needs the training count of every token, asked for in the same way:
each block gets its own small dictionary back.  Buckets are as many as the corpus
asks for.  No task needs the whole vocabulary, or the whole tree.

Edge cases: a null or empty text is the end mark alone; null ids train;
without training texts every byte has probability 1 / 256; repeated rows count as
often as they occur and are scored alike; a long text is a block of its own;
an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, ship_package, slices, utf8

DEPTH = 6
#: Levels walked with the strings dealt by their last byte; the deeper ones have them by their last SHALLOW.
SHALLOW = 3
#: Occurrences of a context, at any corpus size.
FLOOR = 2
#: The share of the training bytes that a context must make up: none.
P_MIN = 0.0
GAIN = 20.0
DISCOUNT = 3.0
BLOCK_BYTES = 16 << 20
#: Bytes of lines in a packet: what is compressed, and scored, at a time.
PACKET_BYTES = 1 << 20
#: Rows that a task takes at a time, at least; a group of strings stays together.
ROWS = 1 << 18
#: Packets of the corpus for each bucket of asks, and buckets at least.
BUCKET_PACKETS, BUCKETS = 16, 16
END = 10  # the end mark; no token has it
BODY = (1 << 56) - 1


def line(text: bytes) -> bytes:
    """Lower-case tokens, each with a space, and the end mark."""
    words = text.lower().split()
    return b" ".join(words) + b" \n" if words else b"\n"


def packets(df: DataFrame, train: Column, key: str, text: str) -> DataFrame:
    """(block, ids, train, packet): the table's lines, a packet a row, dealt
    into blocks; ids and train are lists of the packet's lines."""

    def run(batches):
        import pyarrow as pa
        import zstandard
        from pyspark import TaskContext

        block, filled, pack = TaskContext.get().partitionId() << 24, 0, zstandard.ZstdCompressor(level=3)
        for b in batches:
            rows = ((i, line(x.as_py() or b"")) for i, x in enumerate(b.column(1)))
            for part in slices(rows, lambda r: len(r[1]), PACKET_BYTES):
                size = sum(len(x) for _, x in part)
                if filled and filled + size > BLOCK_BYTES:
                    block, filled = block + 1, 0
                filled += size
                at = pa.array([i for i, _ in part])
                one = pa.array([0, len(part)], pa.int32())
                lists = [pa.ListArray.from_arrays(one, b.column(c).take(at)) for c in (0, 2)]
                raw = pack.compress(b"".join(x for _, x in part))
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *lists, pa.array([raw], pa.binary())], names=["block", "ids", "train", "packet"])

    ship_package(df.sparkSession)
    rows = df.select(F.col(key).alias("doc_id"), utf8(text).alias("text"), F.coalesce(train, F.lit(True)).alias("train"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return materialize(rows.mapInArrow(run, f"block long, ids array<{kind}>, train array<boolean>, packet binary"), "lm-packets")


def opened(packet: bytes) -> list[bytes]:
    """The packet's lines, without their end marks."""
    import zstandard

    return zstandard.ZstdDecompressor().decompress(packet).split(b"\n")[:-1]


def stream(lines: list[bytes]) -> np.ndarray:
    """An end mark, then the lines with theirs, as bytes."""
    return np.frombuffer(b"\n".join([b"", *lines, b""]), np.uint8)


def strings(text: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """For each byte after the first: how many bytes of context it has, up to
    ``depth``, those bytes, the nearest one highest, and itself, as a number."""
    n = len(text) - 1
    code = text[1:].astype(np.int64)
    inside, size = np.ones(n, bool), np.zeros(n, np.int64)
    for k in range(min(depth, n)):  # the byte k + 1 places before the next one
        byte = np.zeros(n, np.int64)
        byte[k:] = text[:n - k]
        code |= np.where(inside, byte, 0) << (8 * (DEPTH - k))
        size += inside
        inside &= byte != END
    return code | size << 56


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One list of distinct numbers with counts from several sorted ones."""
    codes, n = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.argsort(codes, kind="stable")  # merges the sorted runs
    codes, n = codes[order], n[order]
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    return codes[first], np.add.reduceat(n, first)


def squeezed(x: np.ndarray) -> bytes:
    """An array, compressed by byte planes."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes())


def expanded(raw: bytes, kind) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def squeezed_codes(codes: np.ndarray) -> bytes:
    """Ascending numbers, as differences."""
    return squeezed(np.diff(codes, prepend=np.int64(0)))


def expanded_codes(raw: bytes) -> np.ndarray:
    return np.cumsum(expanded(raw, np.int64))


def by_bucket(codes: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """The buckets of the strings' context ends (SHALLOW bytes), and where their strings are."""
    ends = (codes >> 32 & 0xFFFFFF).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bucket = ((ends >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0])
    for at in np.split(order, starts[1:]):
        if len(at):
            yield int(bucket[at[0]]), at


ASK = "bucket long, block long, keys binary, counts binary"


def asks(rows: list[tuple]):
    import pyarrow as pa

    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["bucket", "block", "keys", "counts"])


def met(batches) -> Iterator[list[tuple]]:
    """The rows of each bucket, from batches sorted by it."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    for _, group in itertools.groupby(rows, lambda r: r[0]):
        yield list(group)


def count_tokens(table: DataFrame, buckets: int) -> DataFrame:
    """Each block's distinct tokens with the training counts of the whole corpus
    (block, keys, counts), and once a bucket the number n of its training tokens
    and v of distinct ones."""

    def ask(batches):
        def tokens(block, words):
            parts = [[] for _ in range(buckets)]
            for w in words:
                parts[zlib.crc32(w) % buckets].append(w)
            for i, part in enumerate(parts):
                if part:
                    yield asks([(i, block, pack.compress(b" ".join(part)), squeezed(np.array([words[w] for w in part], np.int64)))])

        import zstandard

        pack = zstandard.ZstdCompressor(level=3)
        now, words = None, Counter()
        for b in batches:
            for block, train, packet in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                if block != now:
                    yield from tokens(now, words)
                    now, words = block, Counter()
                lines = opened(packet.as_py())
                learnt = list(itertools.compress(lines, train))
                words.update(itertools.chain.from_iterable(map(bytes.split, learnt)))
                words[b"\n"] += len(learnt)
                for w in set().union(*(x.split() for x, t in zip(lines, train, strict=True) if not t)):
                    words[w] += 0
        yield from tokens(now, words)

    def answer(batches):
        import pyarrow as pa
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        for rows in met(batches):
            total = Counter()
            for _, _, keys, counts in rows:
                for w, n in zip(unpack.decompress(keys).split(b" "), expanded(counts, np.int64).tolist(), strict=True):
                    total[w] += n
            n, v = sum(total.values()), sum(c > 0 for c in total.values())
            for _, block, keys, _ in rows:
                counts = squeezed(np.array([total[w] for w in unpack.decompress(keys).split(b" ")], np.int64))
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([keys], pa.binary()), pa.array([counts], pa.binary()), pa.array([n]), pa.array([v])], names=["block", "keys", "counts", "n", "v"])
                n = v = 0

    asked = table.select("block", "train", "packet").mapInArrow(ask, ASK).repartition("bucket").sortWithinPartitions("bucket")
    return asked.mapInArrow(answer, "block long, keys binary, counts binary, n long, v long")


def found_strings(batches, depth: int, by_block: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(block, codes, n): the distinct strings of (block, train, packet) rows with
    their training counts, of all or with ``by_block`` of each block."""
    now, found = None, []
    for b in batches:
        for block, train, packet in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            if by_block and block != now:
                if found:
                    yield now, *merged(found)
                now, found = block, []
            lines = opened(packet.as_py())
            for trained in (True, False):
                some = [x for x, t in zip(lines, train, strict=True) if t == trained]
                if some:
                    codes, n = np.unique(strings(stream(some), depth), return_counts=True)
                    found.append((codes, n.astype(np.int64) * trained))
            if len(found) >= 16:
                found = [merged(found)]
    if found:
        yield now or 0, *merged(found)


def count_strings(table: DataFrame, depth: int, by_block: bool) -> DataFrame:
    """(block, code, n): a task's distinct strings with their training counts,
    or with ``by_block`` each block's."""

    def run(batches):
        import pyarrow as pa

        for block, codes, n in found_strings(batches, depth, by_block):
            for a in range(0, len(codes), 200_000):
                part = codes[a:a + 200_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), block)), pa.array(part), pa.array(n[a:a + 200_000])], names=["block", "code", "n"])

    return table.select("block", "train", "packet").mapInArrow(run, "block long, code long, n long")


def ask_strings(table: DataFrame, depth: int, buckets: int) -> DataFrame:
    """(bucket, block, keys, counts): each block's strings and their training counts."""

    def run(batches):
        for block, codes, n in found_strings(batches, depth, True):
            for bucket, at in by_bucket(codes, buckets):
                yield asks([(bucket, block, squeezed_codes(codes[at]), squeezed(n[at]))])

    return table.select("block", "train", "packet").mapInArrow(run, ASK)


def walk(code: np.ndarray, n: np.ndarray, p: np.ndarray, levels: range) -> np.ndarray:
    """The strings' probabilities after ``levels``, from those of the level
    before (``p``).  All strings whose contexts end alike, for as many bytes as
    the first level has, must be there."""
    p = p.copy()
    for k in levels:
        at = np.flatnonzero(code >> 56 >= k)
        if not len(at):
            break
        body = code[at] & BODY
        kinds, first, back = np.unique(body >> (8 * (DEPTH - k + 1)) << 8 | body & 255, return_index=True, return_inverse=True)
        count, q = np.bincount(back, n[at]), p[at[first]]
        starts = np.flatnonzero(np.r_[True, np.diff(kinds >> 8) != 0])
        sizes = np.diff(np.r_[starts, len(kinds)])
        seen = count > 0
        total = np.add.reduceat(count, starts)
        sums = np.repeat(np.maximum(total, 1), sizes)
        room = DISCOUNT * np.repeat(np.add.reduceat(seen.astype(float), starts), sizes)
        gain = np.add.reduceat(count * np.log(np.where(seen, count / sums / q, 1)), starts)
        kept = np.repeat((total >= FLOOR) & (gain >= GAIN), sizes)
        p[at] = np.where(kept, (count + room * q) / (sums + room), q)[back]
    return p


def together(batches, group) -> Iterator[list[np.ndarray]]:
    """Columns of at least about ROWS rows, ``group`` of the first never cut."""
    held, size, last = [], 0, None
    for b in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        if not len(cols[0]):
            continue
        key = group(cols[0])
        new = np.flatnonzero(np.r_[last is not None and key[0] != last, key[1:] != key[:-1]])
        if size >= ROWS and len(new):
            held.append([c[:new[-1]] for c in cols])
            yield [np.concatenate(c) for c in zip(*held, strict=True)]
            cols = [c[new[-1]:] for c in cols]
            held, size = [], 0
        held.append(cols)
        size, last = size + len(cols[0]), key[-1]
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def shallow(code):
    """A string cut to SHALLOW bytes of context, as a number or a column."""
    mask = BODY & ~((1 << 8 * (DEPTH - SHALLOW + 1)) - 1) | 255
    if isinstance(code, np.ndarray):
        return code & mask | np.minimum(code >> 56, SHALLOW) << 56
    return code.bitwiseAND(F.lit(mask)).bitwiseOR(F.shiftleft(F.least(F.shiftright(code, 56), F.lit(SHALLOW).cast("long")), 56))


def learnt(asked: DataFrame, few: DataFrame, buckets: int) -> DataFrame:
    """(block, keys, scores): the log10 probabilities of each ask's strings' bytes,
    by the suffix tree of them all; ``few`` has the strings (code, n) cut to SHALLOW."""
    root = np.full(256, 0.5)
    for r in few.groupBy((F.col("code") % 256).alias("b")).agg(F.sum("n").alias("n")).collect():
        root[r["b"]] += r["n"]
    root /= root.sum()

    def first(batches):
        for code, n in together(batches, lambda c: c >> 48 & 255):
            p = walk(code, n, root[code & 255], range(1, SHALLOW + 1))
            order = np.argsort(code)
            code, p = code[order], p[order]
            for bucket, at in by_bucket(code, buckets):
                yield asks([(bucket, -1, squeezed_codes(code[at]), squeezed(p[at]))])

    def rest(batches):
        import pyarrow as pa

        for rows in met(batches):
            known, worth = (np.concatenate(c) for c in zip(*((expanded_codes(k), expanded(p, np.float64)) for _, block, k, p in rows if block < 0), strict=True))
            order = np.argsort(known)
            known, worth = known[order], worth[order]
            found = []
            for _, block, keys, counts in rows:
                if block >= 0:
                    found.append((expanded_codes(keys), expanded(counts, np.int64)))
                if len(found) >= 16:
                    found = [merged(found)]
            if not found:
                continue
            code, n = merged(found)
            p = walk(code, n, worth[np.searchsorted(known, shallow(code))], range(SHALLOW + 1, DEPTH + 1))
            scores = np.log10(np.maximum(p, 1e-30)).astype(np.float32)
            for _, block, keys, _ in rows:
                if block >= 0:
                    mine = squeezed(scores[np.searchsorted(code, expanded_codes(keys))])
                    yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([keys], pa.binary()), pa.array([mine], pa.binary())], names=["block", "keys", "scores"])

    ends = F.shiftright(F.col("code"), 48).bitwiseAND(F.lit(255))
    top = few.select("code", "n").repartition(ends).sortWithinPartitions(ends).mapInArrow(first, ASK)
    both = top.unionByName(asked).repartition("bucket").sortWithinPartitions("bucket")
    return both.mapInArrow(rest, "block long, keys binary, scores binary")


def learn(found: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(code, score): the log10 probability of each string's byte, by the suffix
    tree of all strings (code, n)."""

    def ask(batches):
        for b in batches:
            code, n = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            order = np.argsort(code)
            code, n = code[order], n[order]
            for bucket, at in by_bucket(code, buckets):
                yield asks([(bucket, 0, squeezed_codes(code[at]), squeezed(n[at]))])

    def rows(batches):
        import pyarrow as pa

        for b in batches:
            for keys, scores in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(expanded_codes(keys)), pa.array(expanded(scores, np.float32))], names=["code", "score"])

    few = found.groupBy(shallow(F.col("code")).alias("code")).agg(F.sum("n").alias("n"))
    return learnt(found.select("code", "n").mapInArrow(ask, ASK), few, buckets).mapInArrow(rows, "code long, score float")


def score(df: DataFrame, train: Column, key: str = "doc_id", text: str = "text", depth: int = DEPTH) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    table = packets(df, train, key, text)
    buckets = max(BUCKETS, table.count() // BUCKET_PACKETS)
    counted = materialize(count_tokens(table, buckets), "lm-counts")
    sums = counted.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n_train, kinds = sums["n"] or 0, sums["v"] or 0
    room = math.log10(n_train + kinds + 1)
    few = materialize(count_strings(table, min(depth, SHALLOW), False).groupBy("code").agg(F.sum("n").alias("n")), "lm-strings")
    worth = learnt(ask_strings(table, depth, buckets), few, buckets)
    id_kind = df.schema[key].dataType

    def run(batches):
        import pyarrow as pa
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        now, words, codes, logs, ready = None, {}, [], [], False
        for b in batches:
            for i, (block, turn) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
                if block != now:
                    now, words, codes, logs, ready = block, {}, [], [], False
                if turn == 0:
                    asked, counts = unpack.decompress(b.column(2)[i].as_py()), expanded(b.column(3)[i].as_py(), np.int64)
                    words.update(zip(asked.split(b" "), (math.log10(c + 1) if c else 0.0 for c in counts.tolist()), strict=True))
                    continue
                if turn == 1:
                    codes.append(expanded_codes(b.column(2)[i].as_py()))
                    logs.append(expanded(b.column(3)[i].as_py(), np.float32))
                    continue
                if not ready:
                    codes, logs, ready = np.concatenate(codes), np.concatenate(logs), True
                    order = np.argsort(codes)
                    codes, logs = codes[order], logs[order]
                out, lines = [], opened(b.column(6)[i].as_py())
                end = words.get(b"\n", 0.0)
                for doc, trained, x in zip(b.column(4)[i].as_py(), b.column(5)[i].as_py(), lines, strict=True):
                    each = [words[w] for w in x.split()]
                    each.append(end)
                    out.append((doc, not trained, len(each), len(each) - each.count(0.0), n_train, math.fsum(each) - room * len(each)))
                ends = np.cumsum([0, *(len(x) + 1 for x in lines)])
                own, back = np.unique(strings(stream(lines), depth), return_inverse=True)
                each = logs[np.searchsorted(codes, own)][back]
                scores = np.add.reduceat(each.astype(np.float64), ends[:-1])
                kinds = [keys, pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
                cols = [pa.array(col, kind) for col, kind in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(scores)], names=names)

    from pyspark.sql.pandas.types import to_arrow_type

    keys = to_arrow_type(id_kind)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kind = id_kind.simpleString()
    tokens = counted.select("block", F.lit(0).alias("turn"), "keys", F.col("counts").alias("worth"))
    scores = worth.select("block", F.lit(1).alias("turn"), "keys", F.col("scores").alias("worth"))
    both = tokens.unionByName(scores).unionByName(table.withColumn("turn", F.lit(2)), allowMissingColumns=True)
    both = both.select("block", "turn", "keys", "worth", "ids", "train", "packet").repartition("block").sortWithinPartitions("block", "turn")
    return both.mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
