"""Mixing sources to target weights by Sainte-Laguë apportionment.

The words of a source are laid out in shards (about ``shard_words`` words
each, documents in the order of a seeded hash) and cut into blocks of
``block`` words.  Blocks are seats: the highest quotients weight / (2k + 1)
take them, first among the sources, then, with the sizes as weights, among
the shards of each source, so that every shard has an integer quota.  A shard
of n blocks with quota q takes every block q // n times, and the q mod n
blocks from a seeded place on (round the end) once more.  Neighbouring blocks
keep documents whole, but for two in a shard.  All of it is arithmetic on
running totals: no row per block is ever made.

Only seats near the rounded targets are ranked, a few a row: the rounded
targets miss the seats by at most half a seat a row and what the ceilings round
up, and rows share in that by weight.

Edge cases: a null text has size 0; a null source is a source of its own and
comes last; null ids and repeated rows are mixed like any others (among rows
equal in all read columns it is open which one gets which share); documents
without words take 0; an empty table gives no rows; a ``text`` of any length
is only counted and cut.  Other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, ship_package

WEIGHTS = (5, 2, 1)
CEILING = 3
BLOCK = 16
SHARD_WORDS = 1 << 20
SEED = 20

WORD = r"[^\x20\x09-\x0D]+"


def sainte_lague(df: DataFrame, group: list[str], weight: str, cap: str, start: str, seats: str, order: list[str]) -> DataFrame:
    """Add ``quota``: of each group's ``seats``, those that the row's quotients
    ``weight`` / (2k + 1), k below ``cap``, win; ties go by ``order``.

    ``start`` is the row's rounded target (at most ``cap``).
    """
    whole = Window.partitionBy(*group)
    free = F.sum(F.when(F.col(start) < F.col(cap), F.col(weight)).otherwise(0)).over(whole)
    off = F.abs(F.col(seats) - F.sum(start).over(whole)) + F.count(F.lit(1)).over(whole) / 2
    reach = F.ceil(off * F.least(F.col(weight) / F.greatest(free, F.lit(1e-300)), F.lit(1.0))) + 2
    near = (
        df.withColumn("_lo", F.greatest(F.col(start) - reach, F.lit(0)))
        .withColumn("_hi", F.least(F.col(start) + reach, F.col(cap)))
        .withColumn("_lo", F.least("_lo", "_hi"))
        .withColumn("_need", F.col(seats) - F.sum("_lo").over(whole))
    )
    seat = near.withColumn("_k", F.explode_outer(F.when(F.col("_hi") > F.col("_lo"), F.sequence("_lo", F.col("_hi") - 1))))
    quotient = F.col(weight).cast("double") / (2 * F.col("_k") + 1)
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(quotient.desc_nulls_last(), *order))
    won = seat.withColumn("_won", (F.col("_k").isNotNull() & (rank <= F.col("_need"))).cast("long"))
    return won.groupBy(*df.columns).agg((F.first("_lo") + F.sum("_won")).alias("quota"))


def targets(sources: DataFrame, weights=WEIGHTS, ceiling: int = CEILING) -> DataFrame:
    """(source, source_size) with its ``weight`` and ``target``.

    Shares run out at ``ceiling`` times the size; in the order in which sources
    reach it, the first source that doesn't gives the level of all the rest.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    n = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (n % len(weights) + 1).cast("int"))
    s = sources.withColumn("weight", weight).withColumn("_cap", (ceiling * F.col("source_size")).cast("double"))
    by_cap = Window.orderBy(F.col("_cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = by_cap.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    s = (
        s.withColumn("_left", F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        .withColumn("_level", F.col("_left") / F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
    )
    level = F.min(F.when(F.col("_level") * F.col("weight") <= F.col("_cap"), F.struct(F.col("_cap") / F.col("weight"), F.col("_level").alias("level")))).over(everything)["level"]
    return s.withColumn("target", F.least(F.col("_cap"), level * F.col("weight"))).drop("_left", "_level", "_cap")


def _taken(x: Column, block: int) -> Column:
    """Words the mix takes of a shard's first ``x`` words."""
    j = F.floor(x / block)
    n, u, extra = F.col("n_blocks"), F.col("turn"), F.col("quota") % F.col("n_blocks")
    base, over = F.floor(F.col("quota") / n), F.greatest(u + extra - n, F.lit(0))
    full = base * j + F.greatest(F.least(j, u + extra) - u, F.lit(0)) + F.least(j, over)
    here = base + F.when(((j >= u) & (j < u + extra)) | (j < over), 1).otherwise(0)
    return block * full + (x - block * j) * here


def hash60(*parts: Column) -> Column:
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 12), 16, 10).cast("long")


def mix(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS, ceiling: int = CEILING,
        block: int = BLOCK, shard_words: int = SHARD_WORDS, seed: int = SEED, row: str | None = None) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, quota and
    n_blocks of its shard, turn (the first block taken once more), place (words
    before it in the shard), taken, and the column ``row``, if one is named."""
    carried = [row] if row else []
    counted = materialize(
        df.select(
            *carried, F.col(key).alias("doc_id"), F.col(source).alias("source"),
            F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.md5(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"),
        ), "mix")
    place = hash60(F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text_hash"))
    sources = counted.groupBy("source").agg(F.sum("size").alias("source_size"))
    total = F.sum("source_size").over(Window.partitionBy())
    plan = targets(sources.withColumn("_seats", F.round(total / block).cast("long")), weights, ceiling)
    plan = sainte_lague(
        plan.withColumns({"_limit": ceiling * F.ceil(F.col("source_size") / block), "_all": F.lit(1)})
        .withColumn("_start", F.when(F.col("target") < ceiling * F.col("source_size"), F.least(F.floor(F.col("target") / block + 0.5), "_limit")).otherwise(F.col("_limit"))),
        ["_all"], "weight", "_limit", "_start", "_seats", ["source"],
    ).select("source", "source_size", "target", F.col("quota").alias("source_quota"),
             F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1)).alias("n_shards"))
    plan = materialize(plan, "mix-sources")
    dealt = (
        counted.withColumn("_place", place)
        .join(plan, counted["source"].eqNullSafe(plan["source"])).drop(plan["source"])
        .withColumn("shard", F.col("_place") % F.col("n_shards"))
    )
    shards = (
        dealt.groupBy("source", "shard", "source_size", "source_quota").agg(F.sum("size").alias("shard_size"))
        .withColumn("n_blocks", F.ceil(F.col("shard_size") / block))
        .withColumn("_limit", ceiling * F.col("n_blocks"))
        .withColumn("_start", F.least(F.floor(F.col("source_quota") * F.col("shard_size") / F.greatest("source_size", F.lit(1)) + 0.5), "_limit"))
    )
    shards = sainte_lague(shards, ["source"], "shard_size", "_limit", "_start", "source_quota", ["shard"])
    shards = shards.withColumn("turn", hash60(F.lit(str(seed)), F.coalesce("source", F.lit("")), F.col("shard")) % F.greatest("n_blocks", F.lit(1)))
    shards = shards.select(F.col("source").alias("_source"), F.col("shard").alias("_shard"), "n_blocks", "quota", "turn")
    laid = Window.partitionBy("source", "shard").orderBy("_place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = dealt.withColumn("place", F.coalesce(F.sum("size").over(laid), F.lit(0)))
    rows = rows.join(shards, rows["source"].eqNullSafe(shards["_source"]) & (rows["shard"] == shards["_shard"]))
    share = F.when(F.col("size") > 0, _taken(F.col("place") + F.col("size"), block) - _taken(F.col("place"), block)).otherwise(0)
    return rows.withColumn("taken", share.cast("long")).select(
        "doc_id", "source", "size", "source_size", "target", "quota", "n_blocks", "turn", "place", "taken", *carried)


def taken_ranges(place: int, size: int, quota: int, n_blocks: int, turn: int, block: int = BLOCK) -> list[tuple[int, int]]:
    """Word ranges [a, b) of a document that the mix takes, one list of ranges
    for each time round: all of it ``quota`` // ``n_blocks`` times, then its
    words in the blocks that are taken once more."""
    if not size:
        return []
    base, extra = divmod(quota, n_blocks)
    out = [(0, size)] * base
    for a, b in ((turn, min(turn + extra, n_blocks)), (0, max(turn + extra - n_blocks, 0))):
        a, b = max(a * block - place, 0), min(b * block - place, size)
        if a < b:
            out.append((a, b))
    return out


def mixed_documents(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", n_chars: str = "n_chars", **settings) -> DataFrame:
    """The documents as the mix takes them, columns as before: ``text`` holds
    the taken words (with the white space between them), later times round
    after a line break; documents of which nothing is taken go, and where there
    is a column ``n_chars`` it is counted anew."""
    block = settings.get("block", BLOCK)
    ship_package(df.sparkSession)
    numbered = materialize(df.select(F.struct(*df.columns).alias("doc"), F.monotonically_increasing_id().alias("row")), "numbered")
    doc = F.col("doc")
    rows = numbered.select("row", doc[key].alias("doc_id"), doc[text].alias("text"), doc[source].alias("source"))
    plan = mix(rows, row="row", **settings).where(F.col("taken") > 0)
    plan = plan.select("row", F.struct("place", "size", "quota", "n_blocks", "turn").alias("share"))
    spans = re.compile(WORD)

    @F.udf("string", useArrow=True)
    def cut(body, share):
        if body is None:
            return None
        words, parts = None, []
        for a, b in taken_ranges(*share, block):
            if b - a == share[1]:
                parts.append(body)
            else:
                words = words or [m.span() for m in spans.finditer(body)]
                parts.append(body[words[a][0]:words[b - 1][1]])
        return "\n".join(parts)

    # Documents that are taken once as they are don't go through Python.
    once = (F.col("share.quota") == F.col("share.n_blocks"))
    kept = numbered.join(plan, "row")
    changed = {text: F.when(once, doc[text]).otherwise(F.col("cut"))}
    if n_chars in df.columns:
        changed[n_chars] = F.when(once, doc[n_chars]).otherwise(F.length("cut").cast(df.schema[n_chars].dataType))
    body = F.when(~once, doc[text])
    return kept.withColumn("cut", cut(body, F.struct(*[F.col("share")[c] for c in ("place", "size", "quota", "n_blocks", "turn")]))).select(
        *[changed[c].alias(c) if c in changed else doc[c].alias(c) for c in df.columns])
