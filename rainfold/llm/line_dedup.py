"""Line dedup that can take documents in and out again.

A line's key is the line without white space at its ends, A-Z lower-cased.  A key
of at least ``LEAST_CHARS`` code points that is found in at least ``LEAST_DOCS``
documents loses all its lines except in the document of the largest id.

What is known of the lines is a ``Lines``: a cuckoo filter for every shard of the
keys' 128-bit hashes, and exact tables behind the filters.

* ``refs`` (shard, key, refs): how many documents hold a key, as a log of signed
  counts, a row for each key and batch.
* ``holders`` (key, document, refs): which documents hold it, signed likewise.
* ``filters``: buckets of four 16-bit fingerprints a shard.  A key that its filter
  doesn't know is new and goes in without a look at the tables; only those that
  it may know are joined with ``refs``.  A filter that would pass ``LOAD`` is built
  anew, larger, from the exact counts of its shard.

Documents are inserted in batches and deleted by id.  A deletion adds negative
counts, and keys that no document holds any more leave their filters, so that
inserting and deleting a batch gives what there was before.  Counts are summed
before they are shuffled: a line that every document has is one row a task.

Defined cases: a null or empty text is one empty line and stays; every row is a
document, also one that repeats another, rows of one doc_id keep or lose a key
together; a null doc_id is below all others; a key held by null ids only stays;
an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, ship_package, slices, utf8

LEAST_CHARS = 20
LEAST_DOCS = 3
#: Keys that a shard is laid out for, by the first batch.
KEYS_PER_SHARD = 1 << 12
SLOTS = 4
#: A filter is built anew when its keys fill more than this part of its slots.
LOAD = 0.85
#: Rounds of moving fingerprints before what is left goes to the shard's stash.
ROUNDS = 200

WHITE = b" \t\n\x0b\x0c\r"
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
FILTER = "shard long, keys long, slots binary, stash binary"
HELD = "k1 long, k2 long, doc_id long, body long, refs long"
KEY = ["k1", "k2"]


# --------------------------------------------------------------------------
# cuckoo filter of one shard
# --------------------------------------------------------------------------

def _prints(k2: np.ndarray) -> np.ndarray:
    return ((k2.view(np.uint64) & np.uint64(0xFFFF)) % np.uint64(0xFFFF) + np.uint64(1)).astype(np.uint16)


class Cuckoo:
    """``slots`` (buckets, 4), 0 for none, and a stash of (bucket, print) codes
    that found no place.  A print's two buckets follow from either of them."""

    def __init__(self, slots: np.ndarray, stash: np.ndarray, keys: int = 0):
        self.slots, self.stash, self.keys = slots, stash, keys

    @classmethod
    def sized(cls, keys: int) -> Cuckoo:
        """Room for twice as many keys, so that a shard can grow for a while."""
        buckets = 1
        while buckets * SLOTS * LOAD < 2 * keys:
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), np.uint16), np.zeros(0, np.int64))

    @classmethod
    def of_row(cls, keys: int, slots: bytes, stash: bytes) -> Cuckoo:
        return cls(np.frombuffer(slots, np.uint16).reshape(-1, SLOTS).copy(), np.frombuffer(stash, np.int64).copy(), keys)

    def row(self, shard: int) -> dict:
        return {"shard": [shard], "keys": [self.keys], "slots": [self.slots.tobytes()], "stash": [self.stash.tobytes()]}

    def _first(self, k2):
        return ((k2.view(np.uint64) >> np.uint64(16)) & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def _other(self, at, fp):
        return at ^ ((fp.astype(np.int64) * 0x5BD1E995 >> 8) & (len(self.slots) - 1))

    @staticmethod
    def _code(at, fp):
        return at << 16 | fp.astype(np.int64)

    def holds(self, k2: np.ndarray) -> np.ndarray:
        fp, at = _prints(k2), self._first(k2)
        out = np.zeros(len(k2), bool)
        for bucket in (at, self._other(at, fp)):
            out |= (self.slots[bucket] == fp[:, None]).any(1) | np.isin(self._code(bucket, fp), self.stash)
        return out

    def add(self, k2: np.ndarray) -> None:
        """Put keys in, all at once: each to a free slot of its bucket or of its
        other one; then the first that waits at a bucket takes a slot there and
        the print that it drives out waits at that one's other bucket."""
        self.keys += len(k2)
        fp, at = _prints(k2), self._first(k2)
        tried = np.zeros(len(fp), bool)
        for turn in range(ROUNDS):
            if not len(fp):
                return
            order = np.argsort(at, kind="stable")
            fp, at, tried = fp[order], at[order], tried[order]
            rank = np.arange(len(at)) - np.searchsorted(at, at)
            free = self.slots[at] == 0
            put = rank < free.sum(1)
            nth = (np.cumsum(free, 1) == rank[:, None] + 1) & free
            self.slots[at[put], nth[put].argmax(1)] = fp[put]
            fp, at, tried, rank = fp[~put], at[~put], tried[~put], rank[~put]
            lead = np.ones(len(at), bool)
            lead[1:] = at[1:] != at[:-1]
            push = lead & tried
            slot = (fp[push].astype(np.int64) + turn) % SLOTS
            fp[push], self.slots[at[push], slot] = self.slots[at[push], slot], fp[push].copy()
            at, tried = self._other(at, fp), np.ones(len(at), bool)
        self.stash = np.concatenate([self.stash, self._code(at, fp)])

    def remove(self, k2: np.ndarray) -> None:
        """Take keys out that are in: one print each."""
        self.keys -= len(k2)
        fp, at = _prints(k2), self._first(k2)
        at = np.minimum(at, self._other(at, fp))
        while len(fp):
            # keys that look alike go one after the other
            _, now = np.unique(self._code(at, fp), return_index=True)
            f, left = fp[now], np.ones(len(now), bool)
            for bucket in (at[now], self._other(at[now], f)):
                hit = self.slots[bucket] == f[:, None]
                found = hit.any(1) & left
                self.slots[bucket[found], hit[found].argmax(1)] = 0
                left &= ~found
            for bucket, p in zip(at[now][left], f[left], strict=True):
                either = np.array([bucket, self._other(np.array([bucket]), np.array([p]))[0]])
                code = np.flatnonzero(np.isin(self.stash, self._code(either, np.array([p, p]))))
                self.stash = np.delete(self.stash, code[:1])
            rest = np.ones(len(fp), bool)
            rest[now] = False
            fp, at = fp[rest], at[rest]


def _filter_of(table: pa.Table) -> Cuckoo | None:
    if not table.num_rows:
        return None
    r = table.to_pylist()[0]
    return Cuckoo.of_row(r["keys"], r["slots"], r["stash"])


def _column(table, name):
    return table[name].to_numpy().astype(np.int64)


def _probe(key, keys, filters):
    """The batch's keys of a shard, and whether its filter may know them."""
    known = _filter_of(filters)
    maybe = known.holds(_column(keys, "k2")) if known else np.zeros(keys.num_rows, bool)
    return pa.table({c: keys[c].cast(pa.int64()) for c in ("k1", "k2", "refs")} | {"maybe": pa.array(maybe)})


def _grow(key, keys, filters):
    """A shard's filter with its new keys; one without a row is built from all."""
    known = _filter_of(filters) or Cuckoo.sized(keys.num_rows)
    order = np.lexsort((_column(keys, "k1"), _column(keys, "k2")))
    known.add(_column(keys, "k2")[order])
    return pa.table(known.row(key[0].as_py()), FILTER_ARROW)


def _shrink(key, keys, filters):
    known = _filter_of(filters)
    known.remove(_column(keys, "k2"))
    return pa.table(known.row(key[0].as_py()), FILTER_ARROW)


FILTER_ARROW = pa.schema([("shard", pa.int64()), ("keys", pa.int64()), ("slots", pa.binary()), ("stash", pa.binary())])


# --------------------------------------------------------------------------
# what is known of the lines
# --------------------------------------------------------------------------

@dataclass(frozen=True)
class Lines:
    shards: int
    refs: DataFrame
    holders: DataFrame
    filters: DataFrame
    netted: bool = True

    def shard(self) -> Column:
        return F.pmod(F.shiftright("k1", 32), F.lit(self.shards))

    def held(self) -> DataFrame:
        """(key, document, refs) of the documents that are in."""
        if self.netted:
            return self.holders
        return self.holders.groupBy(*KEY, "doc_id", "body").agg(F.sum("refs").alias("refs")).filter("refs > 0")

    def counts(self, of: DataFrame | None = None) -> DataFrame:
        """(key, refs): the exact counts, of some keys if given."""
        rows = self.refs if of is None else self.refs.join(of.select(*KEY), KEY, "left_semi")
        return rows.groupBy(*KEY).agg(F.sum("refs").alias("refs")).filter("refs > 0")


def _key(line: bytes) -> bytes | None:
    """A line's hash, or none if its key is too short."""
    import xxhash

    key = line.strip(WHITE)
    if len(key) < LEAST_CHARS or (len(key) < 4 * LEAST_CHARS and len(key.decode()) < LEAST_CHARS):
        return None
    return xxhash.xxh3_128_digest(key)


def _lines_of(text: bytes) -> list[bytes]:
    return text.translate(LOWER).split(b"\n")


def _holders(batches):
    for b in batches:
        docs, bodies, texts = b.column(0), b.column(1), b.column(2)
        for part in slices(range(b.num_rows), lambda i: len(texts[i].as_buffer() or b"") + 64):
            keys, rows = [], []
            for i in part:
                found = {_key(x) for x in _lines_of(texts[i].as_py() or b"")} - {None}
                keys.extend(sorted(found))
                rows.extend([i] * len(found))
            k = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(k[:, 0].copy()), pa.array(k[:, 1].copy()), docs.take(at), bodies.take(at),
                                              pa.array(np.ones(len(k), np.int64))], names=["k1", "k2", "doc_id", "body", "refs"])


def _documents(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("body"), utf8("text").alias("text"), *more)


def holders(docs: DataFrame) -> DataFrame:
    """(key, document, 1) for every key that is long enough, written once: what
    ``insert`` takes.  A document is its id and its text's hash."""
    ship_package(docs.sparkSession)
    return materialize(_documents(docs).mapInArrow(_holders, HELD), "line-holders")


def _sharded(rows: DataFrame, lines: Lines):
    return rows.withColumn("shard", lines.shard()).groupBy("shard")


def _grown(lines: Lines, fresh: DataFrame) -> DataFrame:
    """The filters with fresh keys; those that would get too full anew from all
    keys of their shard."""
    fresh = materialize(fresh.select(*KEY).withColumn("shard", lines.shard()), "line-fresh")
    more = fresh.groupBy("shard").agg(F.count(F.lit(1)).alias("more"))
    load = lines.filters.join(more, "shard").select("shard", (F.col("keys") + F.col("more") > LOAD * F.octet_length("slots") / 2).alias("full"))
    full = materialize(load.filter("full").select("shard"), "line-full")
    live = lines.counts().withColumn("shard", lines.shard()).join(full, "shard", "left_semi")
    feed = fresh.unionByName(live.select(*KEY, "shard"))
    usable = lines.filters.join(full, "shard", "left_anti")
    out = feed.groupBy("shard").cogroup(usable.groupBy("shard")).applyInArrow(_grow, FILTER)
    same = lines.filters.join(more, "shard", "left_anti")
    return materialize(same.unionByName(out), "line-filters")


def insert(lines: Lines | None, held: DataFrame) -> Lines:
    """``lines`` with the documents of ``held`` (see ``holders``)."""
    ship_package(held.sparkSession)
    batch = held.groupBy(*KEY).agg(F.sum("refs").alias("refs"))
    if lines is None:
        batch = materialize(batch, "line-refs")
        shards = max(1, batch.count() // KEYS_PER_SHARD)
        first = Lines(shards, batch, held, held.sparkSession.createDataFrame([], FILTER))
        feed = _sharded(batch.select(*KEY), first)
        empty = first.filters.groupBy("shard")
        return replace(first, filters=materialize(feed.cogroup(empty).applyInArrow(_grow, FILTER), "line-filters"))
    probed = _sharded(batch, lines).cogroup(lines.filters.groupBy("shard")).applyInArrow(_probe, "k1 long, k2 long, refs long, maybe boolean")
    probed = materialize(probed, "line-refs")
    asked = probed.filter("maybe")
    fresh = probed.filter("NOT maybe").select(*KEY).unionByName(asked.select(*KEY).join(lines.counts(asked), KEY, "left_anti"))
    filters = _grown(lines, fresh)
    return replace(lines, filters=filters, refs=lines.refs.unionByName(probed.drop("maybe")), holders=lines.holders.unionByName(held))


def delete(lines: Lines, gone: DataFrame) -> Lines:
    """``lines`` without the documents whose ``doc_id`` is in ``gone``."""
    ids = gone.select(F.col("doc_id").cast("long").alias("_id")).distinct()
    out = lines.held().join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    out = materialize(out.withColumn("refs", -F.col("refs")).select(*lines.holders.columns), "line-holders")
    batch = materialize(out.groupBy(*KEY).agg(F.sum("refs").alias("refs")), "line-refs")
    after = replace(lines, refs=lines.refs.unionByName(batch), holders=lines.holders.unionByName(out), netted=False)
    dead = materialize(batch.select(*KEY).join(after.counts(batch), KEY, "left_anti").withColumn("shard", lines.shard()), "line-dead")
    less = dead.groupBy("shard").cogroup(lines.filters.join(dead, "shard", "left_semi").groupBy("shard")).applyInArrow(_shrink, FILTER)
    return replace(after, filters=materialize(lines.filters.join(dead, "shard", "left_anti").unionByName(less), "line-filters"))


# --------------------------------------------------------------------------
# documents without their repeated lines
# --------------------------------------------------------------------------

def doomed(lines: Lines, least: int = LEAST_DOCS) -> DataFrame:
    """(doc_id, body, keys): the hashes of the lines that a document loses."""
    often = lines.counts().filter(F.col("refs") >= least).select(*KEY)
    held = materialize(lines.held().join(often, KEY).select(*KEY, "doc_id", "body"), "line-often")
    last = held.groupBy(*KEY).agg(F.max("doc_id").alias("last"))
    lose = held.join(last, KEY).filter(~F.col("doc_id").eqNullSafe(F.col("last")))
    return lose.groupBy("doc_id", "body").agg(F.collect_set(F.struct(*KEY)).alias("keys"))


def _cut(batches):
    for b in batches:
        ids, texts, doomed = b.column(0), b.column(1), b.column(2)
        for part in slices(range(b.num_rows), lambda i: len(texts[i].as_buffer() or b"") + 64):
            count, dropped, kept = [], [], []
            for i in part:
                text, keys = texts[i].as_py() or b"", doomed[i]
                lost = {np.array([k["k1"], k["k2"]], np.int64).tobytes() for k in keys.as_py()} if keys.is_valid else ()
                if not lost:
                    count.append(text.count(b"\n") + 1)
                    dropped.append(0)
                    kept.append(text)
                    continue
                whole = text.split(b"\n")
                stay = [x for x, low in zip(whole, _lines_of(text), strict=True) if _key(low) not in lost]
                count.append(len(whole))
                dropped.append(len(whole) - len(stay))
                kept.append(b"\n".join(stay))
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(part)), pa.array(count, pa.int64()), pa.array(dropped, pa.int64()),
                                              pa.array(kept, pa.binary())], names=["doc_id", "n_lines", "n_dropped", "kept"])


def clean(docs: DataFrame, lines: Lines) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept)``: every document's remaining text (binary)."""
    ship_package(docs.sparkSession)
    lose = doomed(lines).select(F.col("doc_id").alias("_id"), F.col("body").alias("_body"), "keys")
    met = _documents(docs).join(lose, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("body") == F.col("_body")), "left")
    return met.select("doc_id", "text", "keys").mapInArrow(_cut, "doc_id long, n_lines long, n_dropped long, kept binary")


def dedup(docs: DataFrame, batches: int = 2) -> DataFrame:
    """``clean`` of documents that arrive in some batches (by a hash of their ids)."""
    held, lines = holders(docs), None
    for n in range(batches):
        lines = insert(lines, held.filter(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == n))
    return clean(docs, lines)
