"""Registered queries of the training-data operators and their DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language, line_dedup, merkle, mixing, mtree, oracle, packing, phrases, quality_cnn, quality_rules, secrets, simhash, suffix_dedup, suffix_tree
from .common import held_out, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op10_karmarkar_karp_packing(spark, sf_dir):
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer_path())


@query
def op3_sainte_lague_mixing(spark, sf_dir):
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


@query
def op6_compression_language_id(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    out = held_out("doc_id", 4, 2)
    found = language.identify(docs, language.learn(docs, ~out))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", "rejected")


@query
def op9_byte_cnn_quality(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = quality_cnn.learn(docs, read(spark, sf_dir, "labels"), ~held_out("_key", 3, 1))
    return quality_cnn.classify(docs, model).select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", "predicted")


@query
def op4_simhash_multi_index(spark, sf_dir):
    found = simhash.components(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_text().alias("fingerprint"), "component_id")


@query
def op2_secret_char_cnn(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.learn(docs))


@query
def op1_suffix_tree_scoring(spark, sf_dir):
    return suffix_tree.score(read(spark, sf_dir, "documents"), ~held_out("doc_id", 7, 2))


@query
def op5_adaptive_quality_rules(spark, sf_dir):
    return quality_rules.judge(read(spark, sf_dir, "documents"))


@query
def op7_suffix_array_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents")).drop("kept")


@query
def op8_mtree_top_k(spark, sf_dir):
    return mtree.top_k(read(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


@query
def op11_cuckoo_line_dedup(spark, sf_dir):
    found = line_dedup.dedup(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op12_merkle_manifest(spark, sf_dir):
    return merkle.manifest(read(spark, sf_dir, "documents"))


@query
def op13_stream_collocations(spark, sf_dir):
    return phrases.collocations(read(spark, sf_dir, "documents"))


ORACLE |= {
    "op13_stream_collocations": oracle.collocations_sql(),
    "op11_cuckoo_line_dedup": oracle.line_dedup_sql(),
    "op12_merkle_manifest": oracle.merkle_sql(),
    "op3_sainte_lague_mixing": oracle.mixing_sql(),
    "op5_adaptive_quality_rules": oracle.rules_sql(),
    "op8_mtree_top_k": oracle.top_k_sql(),
}
