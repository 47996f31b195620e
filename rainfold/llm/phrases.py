"""Phrase collocations: which neighbouring words belong together, language by language.

Texts are lower-cased (A-Z), cut at ``[.,;:!?`` and line breaks``]`` into pieces and
these into words.  A phrase of two or three words that occurs at least ``LEAST``
times is scored by its cuts: a² / (l · r) of its count and of its parts' counts, the
lowest cut counts.  A phrase inside a longer one that has at least half of its
occurrences goes.

Counting follows the external estimation of n-gram models.

* Texts are read once and kept as packed **blocks** of word numbers (about 16 MB of
  text a block, one language each).  Words that occur ``LEAST`` times get numbers
  in their order; no phrase with another word can be a candidate, so those others
  break a block like a piece's end.
* Each block sorts its grams of two and of three words, counts them, and writes
  them as sorted, packed streams, a stream for each of the tasks that they are
  dealt to (by a hash of the whole gram, so a very common word is no hot key).
* A task merges its sorted streams and keeps what occurs ``LEAST`` times.
* Merge joins of the counts in prefix order (w1 w2 | w3) give the left part's count
  and how often a phrase is continued to the right, in suffix order (w1 | w2 w3)
  the right part's count and how often it is continued to the left.  No counts are
  looked up in a hash table; a skewed run of a join is split by Spark.

Counts are exact, and so are scores (products are decimals of 38 digits; counts
below 10¹⁵).  Defined cases: a null lang is ``und``; a null or empty text has no
words; repeated rows count each; a lang without candidates has no rows; an empty
table gives none; other columns aren't read.  A piece is never cut, so it must fit
a task's memory; longer texts are cut between pieces.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.relational import position_index
from .common import materialize, ship_package, utf8

#: Occurrences that a phrase needs.
LEAST = 10
#: A phrase goes if a longer one around it has this share of its occurrences, in hundredths.
ABSORBED = 50
#: Phrases kept a language.
TOP = 2000
#: Text that a task gathers before it writes a block.
BLOCK_BYTES = 16 << 20
#: Word occurrences a merging task is laid out for.
BUCKET_WORDS = 4 << 20
#: Shares of a language whose best phrases are found apart first.
SHARES = 64

_BREAKS = b".,;:!?\n\x0b\x0c\r"
#: A-Z to a-z, every break to a full stop, the other white space to a space.
TABLE = bytes(b + 32 if 65 <= b <= 90 else 46 if b in _BREAKS else 32 if b == 9 else b for b in range(256))

BLOCKS = "block long, lang string, n long, words array<string>, counts array<long>, tokens binary"
STREAMS = "size int, bucket long, lang string, entries long, data binary"
GRAMS = "size int, lang string, w1 long, w2 long, w3 long, f long"


# --------------------------------------------------------------------------
# packed numbers
# --------------------------------------------------------------------------

def _pack(*columns: np.ndarray) -> bytes:
    """32-bit columns as compressed byte planes; the first is stored as steps."""
    import zstandard

    columns = [np.ascontiguousarray(c, dtype="<u4") for c in columns]
    if len(columns) > 1 and len(columns[0]):
        columns[0] = np.diff(columns[0], prepend=columns[0][:1] * 0)
    return zstandard.ZstdCompressor(level=1).compress(b"".join(c.view(np.uint8).reshape(-1, 4).T.tobytes() for c in columns))


def _unpack(data: bytes, columns: int) -> list[np.ndarray]:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(columns, 4, -1)
    out = [np.ascontiguousarray(p.T).view("<u4").ravel() for p in planes]
    if columns > 1:
        out[0] = np.cumsum(out[0], dtype=np.uint32)
    return out


# --------------------------------------------------------------------------
# blocks of word numbers
# --------------------------------------------------------------------------

def _parts(text: bytes, limit: int):
    """A text in parts of about ``limit`` bytes, cut at piece ends only."""
    while len(text) > limit:
        at = text.rfind(b".", 0, limit)
        at = at if at > 0 else text.find(b".", limit)
        if at < 0:
            break
        yield text[:at]
        text = text[at + 1:]
    yield text


def _block(number: int, lang: str, parts: list[bytes]) -> pa.RecordBatch | None:
    tokens = pa.array(b".".join(parts).replace(b".", b" . ").split(), pa.binary()).dictionary_encode()
    words = tokens.dictionary.to_pylist()
    is_word = np.array([w != b"." for w in words], bool)
    if not is_word.any():
        return None
    numbers = np.where(is_word, np.cumsum(is_word), 0)[tokens.indices.to_numpy()]
    counts = np.bincount(numbers, minlength=is_word.sum() + 1)[1:]
    return pa.RecordBatch.from_pydict({
        "block": pa.array([number], pa.int64()), "lang": pa.array([lang], pa.string()), "n": pa.array([int(counts.sum())], pa.int64()),
        "words": pa.array([[w.decode() for w in words if w != b"."]], pa.list_(pa.string())),
        "counts": pa.array([counts.tolist()], pa.list_(pa.int64())), "tokens": pa.array([_pack(numbers)], pa.binary())})


def _blocks(batches):
    from pyspark import TaskContext

    number, held, sizes = TaskContext.get().partitionId() << 32, {}, {}

    def flush(lang):
        nonlocal number
        out, number = _block(number, lang, held.pop(lang)), number + 1
        del sizes[lang]
        return out

    for b in batches:
        langs, texts = b.column(0), b.column(1)
        for i in range(b.num_rows):
            lang = langs[i].as_py()
            for part in _parts((texts[i].as_py() or b"").translate(TABLE), BLOCK_BYTES):
                held.setdefault(lang, []).append(part)
                sizes[lang] = sizes.get(lang, 0) + len(part) + 1
                if sum(sizes.values()) > BLOCK_BYTES and (made := flush(max(sizes, key=sizes.get))):
                    yield made
    for lang in list(held):
        if made := flush(lang):
            yield made


def blocks(docs: DataFrame) -> DataFrame:
    """The texts as packed word numbers, a row a block with its words and their counts."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), utf8("text").alias("text"))
    return materialize(rows.mapInArrow(_blocks, BLOCKS), "phrase-blocks")


def vocabulary(packed: DataFrame, least: int = LEAST) -> DataFrame:
    """``(lang, word, f, id)``: the words that occur often enough, numbered by language in their order."""
    words = packed.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).groupBy("lang", F.col("w.words").alias("word"))
    often = words.agg(F.sum("w.counts").alias("f")).filter(F.col("f") >= least)
    return materialize(position_index(often, "word", key="lang", idx="id"), "phrase-words")


# --------------------------------------------------------------------------
# sorted streams of counts
# --------------------------------------------------------------------------

def _deal(buckets: int, *words: np.ndarray) -> np.ndarray:
    h = np.zeros(len(words[0]), np.uint64)
    for w in words:
        h = (h ^ w.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _counted(numbers: np.ndarray):
    """The sorted grams of two and of three words of a block: (columns, counts)."""
    g = numbers.astype(np.int64)
    pair = g[:-1] << 32 | g[1:]
    whole = (g[:-1] > 0) & (g[1:] > 0)
    pairs, counts = np.unique(pair[whole], return_counts=True)
    yield (pairs >> 32, pairs & 0xFFFFFFFF), counts
    triple = whole[:-1] & whole[1:]
    first = np.searchsorted(pairs, pair[:-1][triple])
    triples, counts = np.unique(first << 32 | g[2:][triple], return_counts=True)
    head = pairs[triples >> 32]
    yield (head >> 32, head & 0xFFFFFFFF, triples & 0xFFFFFFFF), counts


def _streams(buckets: int):
    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                lang, known = b.column("lang")[r].as_py(), b.column("known")[r]
                (numbers,) = _unpack(b.column("tokens")[r].as_py(), 1)
                ids = np.zeros(int(b.column("size")[r].as_py()) + 1, np.uint32)
                if known.is_valid:
                    ids[known.values.field("pos").to_numpy() + 1] = known.values.field("id").to_numpy()
                for words, counts in _counted(ids[numbers]):
                    bucket = _deal(buckets, *words)
                    order = np.argsort(bucket, kind="stable")
                    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
                    out = {"size": [], "bucket": [], "lang": [], "entries": [], "data": []}
                    for k in np.flatnonzero(np.diff(ends)):
                        mine = order[ends[k]:ends[k + 1]]
                        for name, v in zip(out, (len(words), int(k), lang, len(mine), _pack(*[w[mine] for w in words], counts[mine])), strict=True):
                            out[name].append(v)
                    kinds = [pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out))
    return run


def _merge(least: int):
    def run(key, table):
        size, out = key[0].as_py(), []
        langs = np.array(table["lang"].to_pylist(), object)
        for lang in sorted(set(langs)):
            parts = [_unpack(table["data"][int(i)].as_py(), size + 1) for i in np.flatnonzero(langs == lang)]
            *words, f = (np.concatenate(c).astype(np.int64) for c in zip(*parts, strict=True))
            head = words[0] << 32 | words[1]
            # each part is sorted already: the stable sort merges their runs
            order = np.argsort(head, kind="stable") if size == 2 else np.lexsort((words[2], head))
            new = np.ones(len(order), bool)
            new[1:] = np.diff(head[order]) != 0
            if size == 3:
                new[1:] |= np.diff(words[2][order]) != 0
            starts = np.flatnonzero(new)
            total = np.add.reduceat(f[order], starts)
            often = total >= least
            at = order[starts[often]]
            out.append(pa.table({
                "size": pa.array(np.full(len(at), size, np.int32)), "lang": pa.array([lang] * len(at), pa.string()),
                **{f"w{j + 1}": pa.array(words[j][at]) if j < size else pa.nulls(len(at), pa.int64()) for j in range(3)}, "f": pa.array(total[often])}))
        return pa.concat_tables(out)
    return run


def grams(packed: DataFrame, words: DataFrame, least: int = LEAST) -> DataFrame:
    """``(size, lang, w1, w2, w3, f)``: the grams of two and three words (by
    number) that occur often enough, with their counts."""
    asked = packed.select("block", "lang", F.posexplode("words").alias("pos", "word")).join(words.select("lang", "word", "id"), ["lang", "word"])
    answers = asked.groupBy(F.col("block").alias("_block")).agg(F.collect_list(F.struct("pos", "id")).alias("known"))
    met = packed.select("block", "lang", F.size("words").alias("size"), "tokens").join(answers, F.col("block") == F.col("_block"), "left")
    buckets = max(1, (packed.agg(F.sum("n")).first()[0] or 0) // BUCKET_WORDS)
    streams = met.select("lang", "size", "tokens", "known").mapInArrow(_streams(buckets), STREAMS)
    return materialize(streams.groupBy("size", "bucket").applyInArrow(_merge(least), GRAMS), "phrase-grams")


# --------------------------------------------------------------------------
# parts, extensions and scores
# --------------------------------------------------------------------------

def _score(a: str, left: str, right: str) -> Column:
    big = lambda c: f"CAST({c} AS DECIMAL(15, 0))"
    return F.expr(f"CAST((CAST(1000000 AS DECIMAL(7, 0)) * ({big(a)} * {big(a)})) div ({big(left)} * {big(right)}) AS BIGINT)")


def _merged(rows: DataFrame, counts: DataFrame, on: dict[str, str], how: str = "inner") -> DataFrame:
    """A merge join of two count streams on (lang, words)."""
    other = counts.select(F.col("lang").alias("_lang"), *[F.col(b).alias(f"_{b}") for b in on.values()],
                          *[c for c in counts.columns if c not in ("lang", *on.values())]).hint("merge")
    met = F.col("lang") == F.col("_lang")
    for a, b in on.items():
        met &= F.col(a) == F.col(f"_{b}")
    return rows.join(other, met, how).drop("_lang", *[f"_{b}" for b in on.values()])


def candidates(counts: DataFrame, words: DataFrame, absorbed: int = ABSORBED) -> DataFrame:
    """``(lang, phrase, a, l, r, score)`` of the phrases that no longer one absorbs."""
    pairs, triples = counts.filter("size = 2"), counts.filter("size = 3")
    # prefix order: w1 w2 | w3, and suffix order: w1 | w2 w3
    right = triples.groupBy("lang", "w1", "w2").agg(F.max("f").alias("right_most"))
    left = triples.groupBy("lang", "w2", "w3").agg(F.max("f").alias("left_most"))
    two = _merged(_merged(pairs, right, {"w1": "w1", "w2": "w2"}, "left"), left, {"w1": "w2", "w2": "w3"}, "left")
    longer = F.greatest(F.coalesce("right_most", F.lit(0)), F.coalesce("left_most", F.lit(0)))
    two = two.filter(100 * longer < absorbed * F.col("f")).select("lang", "w1", "w2", "w3", "f", F.lit(None).cast("long").alias("f12"), F.lit(None).cast("long").alias("f23"))
    three = _merged(triples, pairs.select("lang", "w1", "w2", F.col("f").alias("f12")), {"w1": "w1", "w2": "w2"})
    three = _merged(three, pairs.select("lang", "w1", "w2", F.col("f").alias("f23")), {"w2": "w1", "w3": "w2"}).select(two.columns)
    rows = two.unionByName(three)
    for j in (1, 2, 3):
        rows = _merged(rows, words.select("lang", "id", F.col("f").alias(f"f{j}"), F.col("word").alias(f"t{j}")), {f"w{j}": "id"}, "left")
    rows = rows.select("*", _score("f", "f1", "coalesce(f23, f2)").alias("s1"), _score("f", "f12", "f3").alias("s2"))
    first = F.col("s2").isNull() | (F.col("s1") <= F.col("s2"))
    return rows.select("lang", F.concat_ws(" ", "t1", "t2", "t3").alias("phrase"), F.col("f").alias("a"),
                       F.when(first, F.col("f1")).otherwise(F.col("f12")).alias("l"),
                       F.when(first, F.coalesce("f23", "f2")).otherwise(F.col("f3")).alias("r"),
                       F.when(first, F.col("s1")).otherwise(F.col("s2")).alias("score"))


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's best phrases."""
    packed = blocks(docs)
    words = vocabulary(packed, least)
    found = candidates(grams(packed, words, least), words)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each share of a language first, so that no task ranks all of one
    salt = F.pmod(F.hash("phrase"), F.lit(SHARES))
    for by in (["lang", salt], ["lang"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= top)
    best = found.withColumn("rank", F.col("rank").cast("long"))
    total = packed.groupBy(F.col("lang").alias("_lang")).agg(F.sum("n").alias("n"))
    return best.join(total, F.col("lang") == F.col("_lang")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
