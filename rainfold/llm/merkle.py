"""Merkle manifest of a dataset: a persistent tree with one version per change.

A row is a leaf: the digest of its fields.  The leaves of a language ascend by
doc_id (rows that share one by their leaf) and every eight consecutive nodes
become their parent until one is left, the subroot; the subroots, by language,
are the leaves of the last tree, whose top is the root.

The tree is built in aligned blocks of 8³ leaves: a task makes the three levels
of a block, the blocks' tops are the leaves of the next tier, and so on, so a
task never holds more than a block and every tier is 512 times smaller.  A
changed leaf makes a **version**: its path's nodes are copied within its block,
all others are shared with the first version, and the copy of the block's top is
continued through the upper tiers along the block's own path.  Versions don't
know of each other, so any number of them costs a path each.

Defined cases: a null field reads ``-``; null doc_ids come first in their
language; rows that are equal in every field have equal leaves and either order;
a null lang is a language of its own, before all others; an empty table gives no
rows; other columns, whatever their names, are neither read nor kept.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.relational import position_index
from .common import materialize, ship_package

ARITY = 8
#: Levels that a task makes of a block of ARITY ** BLOCK_LEVELS leaves.
BLOCK_LEVELS = 3
BLOCK = ARITY ** BLOCK_LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

STEPS = "array<struct<l:string,r:string>>"
TIER = f"tree string, pos long, steps {STEPS}, top string"
PROVEN = "tree string, block long, pos long, doc_id long, leaf string, proof_sha256 string, copies array<string>"


# --------------------------------------------------------------------------
# leaves
# --------------------------------------------------------------------------

def leaf(text: Column | None = None) -> Column:
    """A row's digest, with another text if one is given."""
    def part(name: str) -> Column:
        c = F.col(name).cast("string") if text is None or name != "text" else text
        return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))

    return F.sha2(F.concat(*map(part, FIELDS)), 256)


def lowered(text: str = "text") -> Column:
    """The text with A-Z lower-cased and everything else as it was."""
    return F.translate(F.col(text).cast("string"), UPPER, LOWER)


def tampered(third: int = 3) -> Column:
    """Whether a row counts as tampered with: 3 divides crc32 of its decimal doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % third == 0, F.lit(False))


def leaves(docs: DataFrame, changed: Column, text: Column) -> DataFrame:
    """``(tree, pos, doc_id, leaf, changed)``: every row's place in its language's
    tree, its digest, and the digest of its changed form where it has one.

    Places are numbered over sampled ranges of (language, doc_id, leaf), so a
    language of most rows spreads over many tasks; texts never leave the scan.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    rows = docs.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf().alias("leaf"),
                       F.when(changed, leaf(text)).alias("changed"))
    placed = position_index(rows.select("tree", F.struct("doc_id", "leaf").alias("at"), "changed"), "at", key="tree", idx="pos")
    return materialize(placed.select("tree", (F.col("pos") - 1).alias("pos"), "at.doc_id", "at.leaf", "changed"), "merkle-leaves")


# --------------------------------------------------------------------------
# one aligned block
# --------------------------------------------------------------------------

def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _levels(nodes: list[str], block: int) -> list[list[str]]:
    """A block's levels.  Every block but the first of its tree makes all of
    them; the first stops at one node, as it is full or the only one."""
    out = [nodes]
    while len(out) <= BLOCK_LEVELS if block else len(out[-1]) > 1:
        below = out[-1]
        out.append([_digest("".join(below[i:i + ARITY])) for i in range(0, len(below), ARITY)])
    return out


def _siblings(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    """The digests left and right of a path within its runs, level by level."""
    out = []
    for level in levels[:-1]:
        run = at - at % ARITY
        out.append(("".join(level[run:at]), "".join(level[at + 1:run + ARITY])))
        at //= ARITY
    return out


def _sorted(table):
    return table.sort_by("pos")


def _tier(key, table):
    tree, block = key[0].as_py(), key[1].as_py()
    table = _sorted(table)
    levels = _levels(table["digest"].to_pylist(), block)
    steps = [[{"l": a, "r": b} for a, b in _siblings(levels, i)] for i in range(table.num_rows)]
    kind = pa.list_(pa.struct([("l", pa.string()), ("r", pa.string())]))
    return pa.table({"tree": pa.array([tree] * len(steps), pa.string()), "pos": table["pos"].cast(pa.int64()), "steps": pa.array(steps, kind),
                     "top": pa.array([levels[-1][0]] * len(steps), pa.string())})


def _top(key, table):
    levels = _levels(_sorted(table)["leaf"].to_pylist(), key[1].as_py())
    return pa.table({"tree": pa.array([key[0].as_py()], pa.string()), "pos": pa.array([key[1].as_py()], pa.int64()),
                     "digest": pa.array([levels[-1][0]], pa.string())})


def _proven(key, table, path):
    """Every leaf's proof, and the copies that its version makes in the block."""
    block = key[1].as_py()
    table = _sorted(table)
    levels = _levels(table["leaf"].to_pylist(), block)
    above = "".join(s["l"] + s["r"] for s in path["steps"][0].as_py()).encode()
    proofs, copies = [], []
    for i, changed in enumerate(table["changed"].to_pylist()):
        proof, made = hashlib.sha256(), [changed or levels[0][i]]
        for left, right in _siblings(levels, i):
            proof.update((left + right).encode())
            made.append(_digest(left + made[-1] + right))
        proof.update(above)
        proofs.append(proof.hexdigest())
        copies.append(made)
    same = lambda v, t: pa.array([v] * len(copies), t)
    return pa.table({"tree": same(key[0].as_py(), pa.string()), "block": same(block, pa.int64()), "pos": table["pos"].cast(pa.int64()),
                     "doc_id": table["doc_id"].cast(pa.int64()), "leaf": table["leaf"].cast(pa.string()), "proof_sha256": pa.array(proofs, pa.string()),
                     "copies": pa.array(copies, pa.list_(pa.string()))})


# --------------------------------------------------------------------------
# tiers
# --------------------------------------------------------------------------

def _blocked(rows: DataFrame):
    return rows.withColumn("block", F.expr(f"pos div {BLOCK}"))


def climb(nodes: DataFrame) -> DataFrame:
    """``(tree, pos, steps, top)``: for every node of ``(tree, pos, digest)`` the
    siblings on its way to its tree's top, and that top, tier by tier."""
    tiers = []
    while True:
        tier = materialize(_blocked(nodes).groupBy("tree", "block").applyInArrow(_tier, TIER), "merkle-tier")
        tiers.append(tier)
        nodes = tier.filter(F.col("pos") % BLOCK == 0).select("tree", F.expr(f"pos div {BLOCK}").alias("pos"), F.col("top").alias("digest"))
        if not nodes.agg(F.max("pos")).first()[0]:
            break
    out = tiers[0]
    for n, tier in enumerate(tiers[1:], 1):
        up = tier.select(F.col("tree").alias("_tree"), F.col("pos").alias("_pos"), F.col("steps").alias("_steps"), F.col("top").alias("_top"))
        met = out.join(up, (F.col("tree") == F.col("_tree")) & (F.expr(f"pos div {BLOCK ** n}") == F.col("_pos")))
        out = met.select("tree", "pos", F.concat("steps", "_steps").alias("steps"), F.col("_top").alias("top"))
    return out


def build(placed: DataFrame) -> DataFrame:
    """``(tree, block, steps, top, subroot, root)``: the first version, a row for
    every block of leaves: its top and the siblings on the way to the root."""
    ship_package(placed.sparkSession)
    tops = materialize(_blocked(placed).groupBy("tree", "block").applyInArrow(_top, "tree string, pos long, digest string"), "merkle-tops")
    inner = materialize(climb(tops), "merkle-blocks")
    subroots = inner.filter(F.col("pos") == 0).select("tree", F.col("top").alias("digest"))
    ordered = position_index(subroots, "tree", idx="pos").select("tree", (F.col("pos") - 1).alias("pos"), "digest")
    ordered = materialize(ordered, "merkle-subroots")
    outer = climb(ordered.select(F.lit("").alias("tree"), "pos", "digest")).select(
        F.col("pos").alias("_at"), F.col("steps").alias("_steps"), F.col("top").alias("root"))
    by_lang = ordered.join(outer, F.col("pos") == F.col("_at")).select(F.col("tree").alias("_tree"), F.col("digest").alias("subroot"), "_steps", "root")
    whole = inner.join(by_lang, F.col("tree") == F.col("_tree")).join(
        tops.select(F.col("tree").alias("_t"), F.col("pos").alias("_p"), "digest"), (F.col("tree") == F.col("_t")) & (F.col("pos") == F.col("_p")))
    return materialize(whole.select("tree", F.col("pos").alias("block"), F.concat("steps", "_steps").alias("steps"), F.col("digest").alias("top"),
                                    "subroot", "root"), "merkle-paths")


def versions(placed: DataFrame, paths: DataFrame) -> DataFrame:
    """``(tree, pos, doc_id, leaf, proof_sha256, copies, subroot, root)``.

    ``copies``: the nodes that a row's version has of its own, from its leaf
    (changed, or else as it was) to its root; all others are the first version's.
    """
    ship_package(placed.sparkSession)
    inside = _blocked(placed).groupBy("tree", "block").cogroup(paths.select("tree", "block", "steps").groupBy("tree", "block")).applyInArrow(_proven, PROVEN)
    up = paths.select(F.col("tree").alias("_tree"), F.col("block").alias("_block"), "steps", "subroot", "root")
    met = inside.join(up, (F.col("tree") == F.col("_tree")) & (F.col("block") == F.col("_block")))
    node = lambda made, s: F.sha2(F.concat(s["l"], F.element_at(made, -1), s["r"]), 256)
    grown = F.aggregate("steps", F.col("copies"), lambda made, s: F.concat(made, F.array(node(made, s))))
    return met.select("tree", "pos", "doc_id", "leaf", "proof_sha256", grown.alias("copies"), "subroot", "root")


def copied_nodes(found: DataFrame) -> DataFrame:
    """``(tree, version, level, pos, digest)``: the nodes that the versions of
    changed leaves hold of their own, a row each (``version`` is the leaf's place)."""
    mine = found.filter(F.element_at("copies", 1) != F.col("leaf")).select("tree", F.col("pos").alias("version"), F.posexplode("copies").alias("level", "digest"))
    return mine.select("tree", "version", "level", F.expr("version div CAST(pow(8, level) AS BIGINT)").alias("pos"), "digest")


def manifest(docs: DataFrame) -> DataFrame:
    """The first version's digests and proofs of every row, and whether the row's
    leaf, tampered with where that is called for, still folds to the root."""
    placed = leaves(docs, tampered(), lowered())
    folded = F.element_at("copies", -1)
    return versions(placed, build(placed)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", folded.alias("folded_root"), (folded == F.col("root")).alias("verified"))
