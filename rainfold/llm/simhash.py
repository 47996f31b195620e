"""SimHash near-duplicates by multi-index hashing.

A document's fingerprint has a bit set where over half of its shingles'
64-bit hashes have it.  Equal fingerprints are one class.  Between classes,
links of at most three differing bits are found by multi-index hashing: of two
such fingerprints one 32-bit half differs in at most one bit, so every class
looks up the Hamming ball of radius 1 of either half (33 values) in that
half's table, and complete distances are verified in the join.

A half's value that more than ``HOT`` classes share (a large group of near
copies) isn't joined pair by pair.  With the half as good as fixed, each class
near it goes to the points z of the other half that are close enough for its
whole distance t to (value, z) to be at most 2.  Two classes link exactly if
they meet at a point with t <= 1 for one of them, and everything that meets
there is within 3 of that one: a star replaces the pairs, at most 529 rows a
class, and a point has at most 1,585 of them.

Edge cases: null and empty texts have fingerprint 0 and are linked like any
other; repeated rows are one class; null ids are left out of the smallest id
(a component of null ids only has a null id); a very long text is hashed in
blocks; an empty table gives no rows.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import materialize, ship_package, texts, utf8
from .components import connected_components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
HOT = 256
HALF = (1 << 32) - 1
#: Hashes whose bits are counted at a time.
BLOCK = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text's word shingles (bytes split at white space)."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    k = min(shingle, len(words))
    starts = [0, *itertools.accumulate(len(w) + 1 for w in words)]
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, np.int64), len(words) - k + 1
    for at in range(0, n, BLOCK):
        spans = zip(starts[at:min(at + BLOCK, n)], starts[at + k:], strict=False)
        h = np.array([digest(line[a:b - 1], SEED) for a, b in spans], np.uint64)
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(sum(1 << int(i) for i in np.flatnonzero(2 * ones > n)))


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""

    def run(batches):
        import pyarrow as pa

        for rows in texts(batches):
            found = np.array([fingerprint(t, shingle) for _, t in rows], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], keys), pa.array(found)], names=["doc_id", "fp"])

    from pyspark.sql.pandas.types import to_arrow_type

    ship_package(df.sparkSession)
    rows = df.select(F.col(key).alias("doc_id"), utf8(text).alias("text"))
    kind = rows.schema["doc_id"].dataType
    keys = to_arrow_type(kind)
    return rows.mapInArrow(run, f"doc_id {kind.simpleString()}, fp long")


def _masks(bits: int) -> list[int]:
    """All 32-bit numbers with at most ``bits`` bits set, fewest first."""
    return [sum(1 << i for i in c) for k in range(bits + 1) for c in itertools.combinations(range(32), k)]


def _longs(values: list[int]) -> Column:
    return F.expr("array(" + ",".join(f"{v}L" for v in values) + ")")


def links(classes: DataFrame, hot: int = HOT) -> DataFrame:
    """(a, b) edges between distinct fingerprints (column fp): every link of at
    most MAX_BITS bits, but within a hot value a star for those that meet."""
    halves = F.array(F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(HALF)))
    half = classes.select("fp", F.posexplode(halves).alias("seg", "val"))
    # A half's number is the key's sign bit side: 2 * value + half fits a long.
    key = lambda val: val * 2 + F.col("seg")
    table = half.select(key(F.col("val")).alias("key"), F.col("fp").alias("b"))
    probes = half.select("fp", "seg", "val", F.explode(_longs(_masks(1))).alias("mask")).select(
        key(F.col("val").bitwiseXOR(F.col("mask"))).alias("key"), F.col("fp").alias("a"), (F.col("mask") != 0).cast("int").alias("e"))
    crowded = materialize(table.groupBy("key").count().where(F.col("count") > hot).select("key"), "hot-halves")
    # Merge joins throughout: the probes are 33 times what the planner expects of them.
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS
    if crowded.isEmpty():
        return probes.hint("merge").join(table, "key").where((F.col("a") < F.col("b")) & near).select("a", "b")
    pairs = probes.hint("merge").join(table.join(crowded, "key", "left_anti"), "key").where((F.col("a") < F.col("b")) & near).select("a", "b")
    # The other half's points: those within 2 of a class whose half is the value, within 1 if it differs in a bit.
    other = F.when(F.col("key") % 2 == 0, F.col("a").bitwiseAND(F.lit(HALF))).otherwise(F.shiftrightunsigned("a", 32))
    ball = F.when(F.col("e") == 0, _longs(_masks(2))).otherwise(_longs(_masks(1)))
    met = probes.hint("merge").join(crowded, "key").select("key", "a", "e", other.alias("rest"), F.explode(ball).alias("mask")).select(
        "key", F.col("rest").bitwiseXOR(F.col("mask")).alias("z"), "a", (F.col("e") + F.bit_count("mask")).alias("t"))
    first = F.min(F.struct("t", "a")).over(Window.partitionBy("key", "z"))
    stars = met.withColumn("first", first).where((F.col("first.t") <= 1) & (F.col("first.a") != F.col("a"))).select("a", F.col("first.a").alias("b"))
    return pairs.unionByName(stars)


def components(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable over links)."""
    found = materialize(fingerprints(df, key, text, shingle), "fingerprints")
    classes = materialize(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = connected_components(links(classes.select("fp")))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").withColumn("root", F.coalesce("root", "fp")).select("fp", "least", "root")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return found.join(named, "fp").select("doc_id", "fp", "component_id")


def deduplicate(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``df`` that stay: of each component the one with the smallest
    id (null ids last; of rows that share it, the first)."""
    numbered = materialize(df.select(F.struct(*df.columns).alias("doc"), F.monotonically_increasing_id().alias("row")), "numbered")
    doc = F.col("doc")
    rank = F.struct(doc[key].isNull().alias("none"), doc[key].alias("id"), F.col("row").alias("row"))
    found = components(numbered.select(rank.alias("rank"), doc[text].alias("text")), "rank", "text", shingle)
    stay = found.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id.row").alias("row"))
    return numbered.join(stay, "row", "left_semi").select("doc.*")


def fingerprint_text(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
