"""Registered queries of the numbered operators, with their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import (collocations, common, embeddings, jaccard, langid, lines, mixing, packing, pieces, pii, quality, repair, secrets,
               toxicity)


def _read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents")
    return mixing.mix(docs, common.word_count(F.col("text"))).select(
        "doc_id", "source", "size", "source_size", "target", "copies", "taken")


QUERIES = {"op1_mix_sources": op1_mix_sources}
ORACLE: dict[str, str] = {"op1_mix_sources": mixing.oracle_sql()}


def op2_quality_rules(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents")
    rules = quality.learn(docs, _read(spark, sf_dir, "labels"))
    q = F.col("q")
    return docs.select("doc_id", quality.measure(F.col("text")).alias("q")).select(
        "doc_id", *[q[c].alias(c) for c in quality.BASE], quality.base_failed(q).alias("base_failed"),
        (~quality.base_failed(q) & rules.verdict(q)).alias("kept"), rules.rule_number(q).alias("rule"))


QUERIES["op2_quality_rules"] = op2_quality_rules


def _joined(spans):
    """kind:start:end, comma-joined, of an array of spans."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(spans, kind):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op7_secret_formats(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.learn(docs))
    base = F.filter("spans", lambda s: s["kind"] != secrets.KINDS[3])
    return found.select("doc_id", *[_count(F.col("spans"), k).alias(f"n_{k}") for k in secrets.KINDS],
                        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


QUERIES["op7_secret_formats"] = op7_secret_formats


def op3_sanitise_terms(spark, sf_dir):
    found = pii.sanitise(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", *[_count(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS[:4]],
                        F.size("terms").cast("long").alias("n_term"), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                        _joined(F.concat("base", "terms")).alias("spans"))


QUERIES["op3_sanitise_terms"] = op3_sanitise_terms


def op5_pack_sequences(spark, sf_dir):
    return packing.pack(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES["op5_pack_sequences"] = op5_pack_sequences


def _held_out():
    """The rows that models don't learn from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op6_rank_language(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.learn(docs, ~_held_out()))
    return found.select("doc_id", _held_out().alias("held_out"), "lang_pred", "score")


QUERIES["op6_rank_language"] = op6_rank_language


def op10_toxicity_windows(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents")
    net = toxicity.learn(docs, _read(spark, sf_dir, "labels"), ~_held_out())
    return toxicity.score(docs, net).select("doc_id", _held_out().alias("held_out"), "score",
                                            (F.col("score") >= 0.7).cast("int").alias("predicted"), "at_word")


QUERIES["op10_toxicity_windows"] = op10_toxicity_windows


def op4_ngram_jaccard(spark, sf_dir):
    return jaccard.near_duplicates(_read(spark, sf_dir, "documents"), words=3, percent=90)


QUERIES["op4_ngram_jaccard"] = op4_ngram_jaccard


def op8_embedding_links(spark, sf_dir):
    return embeddings.near_duplicates(_read(spark, sf_dir, "embeddings"))


QUERIES["op8_embedding_links"] = op8_embedding_links


def op9_line_runs(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents")
    out = lines.dedup(docs.select("doc_id", "text"))
    deleted = F.col("line_dedup.deleted")
    return out.select("doc_id", "line_dedup.n_lines", F.size(deleted).cast("long").alias("n_deleted"),
                      F.array_join(deleted.cast("array<string>"), ",").alias("deleted"), F.md5("text").alias("clean_md5"))


QUERIES["op9_line_runs"] = op9_line_runs
ORACLE["op9_line_runs"] = lines.oracle_sql()


def op11_phrase_collocations(spark, sf_dir):
    return collocations.collocations(_read(spark, sf_dir, "documents"))


QUERIES["op11_phrase_collocations"] = op11_phrase_collocations
ORACLE["op11_phrase_collocations"] = collocations.oracle_sql()


def op12_sentence_pieces(spark, sf_dir):
    return pieces.digests(_read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES["op12_sentence_pieces"] = op12_sentence_pieces


def op13_conversation_repair(spark, sf_dir):
    return repair.repaired_conversations(_read(spark, sf_dir, "conversations"))


QUERIES["op13_conversation_repair"] = op13_conversation_repair
