"""Packing token sequences by Karmarkar-Karp multiway differencing.

``tokenize`` turns documents into pieces: runs of 4,096 ids leave as full
sequences, the rest of a document is cut into parts of at most ``part`` ids.
``pack`` deals the parts into groups of bounded size by a hash of the piece
number, and divides each group into windows: every part begins as a partial
partition of its own; the two partitions with the widest spread merge again
and again, the largest window of one on the smallest of the other, until one
is left.  That gives windows of nearly equal length; a group starts with
ceil(total / capacity) windows and takes one more as long as one overflows.

Edge cases: a null or empty text is the end id alone; repeated rows and null
ids are packed like any other; an empty table gives no rows.  Equal lengths
are taken in piece order, so reruns agree.
"""

from __future__ import annotations

import gc
import heapq
import itertools
import zlib

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, ship_package, texts, utf8

CAPACITY = 4096
PART = 1024
END_ID = 2
#: Windows in a group, about; bounds a group's rows whatever the input's size.
GROUP_WINDOWS = 128
#: Words, and runs, whose ids a Python worker remembers at a time.
CACHE_WORDS, CACHE_RUNS = 600_000, 600_000
#: Text that a worker splits into words at a time.
SPLIT_BYTES = 2 << 20

PIECES = "doc_id {key}, piece long, start long, length long, ids_crc32 long, doc_tokens long"


#: Words that the tokenizer's normalizer and pre-tokenizer treat simply: printable
#: Latin letters, digits and punctuation.  Others are encoded one by one.
SIMPLE = regex.compile(r"[!-~\u00a1-\u012f\u0131-\u024f]+")
#: What the pre-tokenizer splits words into (part of the tokenizer's definition).
RUNS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
ENDS = frozenset(bytes([c]) for c in b".,;:!?|%&$#*")


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit bytes.

    The tokenizer drops white space and never joins over it, so a text's ids
    are those of its (ASCII space separated) words in turn.  Words, and the
    runs of letters or signs that they consist of, are encoded once.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        ids = range(self.tokenizer.get_vocab_size())
        self.last = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in ids])
        self.words: dict[bytes, bytes] = {}
        self.runs: dict[bytes, bytes] = {}

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def learn_runs(self, new: list[bytes]) -> None:
        """Encode runs together; each ends with a word-end token."""
        for at in range(0, len(new), 1000):
            part = new[at:at + 1000]
            ids = self.ids(b" ".join(part).decode())
            edges = [0, *(4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()]
            if len(edges) != len(part) + 1:
                raise ValueError("the tokenizer doesn't end runs as expected")
            raw = ids.tobytes()
            self.runs.update(zip(part, [raw[a:b] for a, b in itertools.pairwise(edges)], strict=True))

    def learn(self, words: list[bytes]) -> None:
        alone, ended, split = [], [], []
        for w in words:
            # bytes count as letters where they are ASCII
            if w.isalpha():
                alone.append((w, w.lower()))
            elif w[-1:] in ENDS and w[:-1].isalpha():
                ended.append((w, w[:-1].lower(), w[-1:]))
            else:
                s = w.decode()
                if b"<|" in w or not SIMPLE.fullmatch(s):
                    self.words[w] = self.ids(s).tobytes()
                else:
                    split.append((w, [r.encode() for r in RUNS.findall(s.lower())]))
        runs = self.runs
        wanted = {r for _, r in alone}
        wanted.update(r for _, r, _ in ended)
        wanted.update(e for _, _, e in ended)
        wanted.update(r for _, part in split for r in part)
        self.learn_runs([r for r in wanted if r not in runs])
        self.words.update((w, runs[r]) for w, r in alone)
        self.words.update((w, runs[r] + runs[e]) for w, r, e in ended)
        self.words.update((w, b"".join([runs[r] for r in part])) for w, part in split)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        # the tokenizer lower-cases; in ASCII texts that can be done beforehand, but for its special tokens
        split = [(t.lower() if t.isascii() and b"<|" not in t else t).split() for t in texts]
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        if len(self.runs) > CACHE_RUNS:
            self.runs.clear()
        known = self.words
        self.learn([w for w in set().union(*split) if w not in known])
        return [b"".join([known[w] for w in s]) for s in split]


def _uncollected(batches):
    """The batches, with Python's cycle collector off meanwhile: the dictionaries
    hold bytes only, and looking through them again and again is a third of the time."""
    gc.disable()
    try:
        yield from batches
    finally:
        gc.enable()


_ENCODERS: dict[str, Encoder] = {}


def cuts(n: int, capacity: int, part: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, then near-equal parts."""
    out = [(at, capacity) for at in range(0, n - capacity + 1, capacity)]
    at = len(out) * capacity
    k = -(-(n - at) // part)
    edges = [at + (n - at) * i // k for i in range(k + 1)] if k else []
    return out + [(a, b - a) for a, b in itertools.pairwise(edges)]


def tokenize(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
             capacity: int = CAPACITY, part: int = PART, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece (a number unique in the table), start,
    length, ids_crc32, doc_tokens."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        if tokenizer not in _ENCODERS:
            _ENCODERS[tokenizer] = Encoder(tokenizer)
        encoder = _ENCODERS[tokenizer]
        number = TaskContext.get().partitionId() << 40
        for rows in texts(_uncollected(batches), SPLIT_BYTES):
            out = []
            for (k, _), ids in zip(rows, encoder.encode([t for _, t in rows]), strict=True):
                ids += end
                n = len(ids) // 4
                view = memoryview(ids)
                for a, m in cuts(n, capacity, part):
                    out.append((k, number, a, m, zlib.crc32(view[4 * a:4 * (a + m)]), n))
                    number += 1
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], keys)] + [pa.array(c, pa.int64()) for c in cols[1:]],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "doc_tokens"])

    from pyspark.sql.pandas.types import to_arrow_type

    ship_package(df.sparkSession)
    rows = df.select(F.col(key).alias("doc_id"), utf8(text).alias("text"))
    kind = rows.schema["doc_id"].dataType
    keys = to_arrow_type(kind)
    return rows.mapInArrow(run, PIECES.format(key=kind.simpleString()))


def differencing(lengths: np.ndarray, k: int) -> np.ndarray:
    """Window number (0 to k - 1) of each length, by Karmarkar-Karp differencing."""
    n = len(lengths)
    if k == 1:
        return np.zeros(n, int)
    # A partition is its k window sums, falling, and a tree of members for each
    # window: -1 empty, below n one part, else a pair kept in ``pairs``.
    pairs: list[tuple[int, int]] = []
    heap = []
    for i, x in enumerate(lengths.tolist()):
        sums, tree = np.zeros(k, np.int64), np.full(k, -1, np.int64)
        sums[0], tree[0] = x, i
        heap.append((-x, i, sums, tree))
    heapq.heapify(heap)
    for turn in range(n, 2 * n - 1):
        _, _, s, a = heapq.heappop(heap)
        _, _, t, b = heapq.heappop(heap)
        sums, other = s + t[::-1], b[::-1]
        tree = np.where(a < 0, other, a)
        for j in np.flatnonzero((a >= 0) & (other >= 0)).tolist():
            tree[j] = n + len(pairs)
            pairs.append((int(a[j]), int(other[j])))
        order = np.argsort(-sums, kind="stable")
        sums, tree = sums[order], tree[order]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), turn, sums, tree))
    window = np.empty(n, int)
    stack = [(int(x), w) for w, x in enumerate(heap[0][3]) if x >= 0]
    while stack:
        x, w = stack.pop()
        if x < n:
            window[x] = w
        else:
            stack += [(y, w) for y in pairs[x - n]]
    return window


def windows(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Window number of each length; no window exceeds the capacity."""
    k = max(1, -(-int(lengths.sum()) // capacity))
    while True:
        window = differencing(lengths, k)
        if np.bincount(window, lengths).max() <= capacity:
            return window
        k += 1


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_windows: int = GROUP_WINDOWS) -> DataFrame:
    """Give every piece a sequence and its place there: sequence_id, offset.

    Full pieces are sequences of their own (odd ids) and aren't shuffled; the
    windows of the groups have even ids.
    """
    ship_package(pieces.sparkSession)
    cut = F.col("length") < capacity
    total = pieces.where(cut).agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(total / (capacity * group_windows)))

    def one(key, pdf):
        import pandas as pd

        pdf = pdf.sort_values("piece", kind="stable", ignore_index=True)
        window = windows(pdf["length"].to_numpy(), capacity)
        pdf["sequence_id"] = 2 * (window.astype("int64") * groups + int(key[0]))
        pdf["offset"] = pdf.groupby(pd.Series(window))["length"].cumsum() - pdf["length"]
        return pdf.drop(columns="pack_group")

    schema = pieces.schema.simpleString()[len("struct<"):-1].replace(":", " ")
    parts = pieces.where(cut).withColumn("pack_group", F.pmod(F.xxhash64("piece"), F.lit(groups)))
    return (
        parts.groupBy("pack_group").applyInPandas(one, f"{schema}, sequence_id long, offset long")
        .unionByName(pieces.where(~cut).withColumns({"sequence_id": F.col("piece") * 2 + 1, "offset": F.lit(0).cast("long")}))
    )


def pack_documents(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Tokenize and pack a table; the pieces are written once in between."""
    pieces = materialize(tokenize(df, tokenizer, key, text, capacity, min(PART, capacity)), "pieces")
    return pack(pieces, capacity).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
