"""The registered queries of the operators and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulseloom.llm import (alignment, byte_bpe, codes, common, counting, jaccard, neighbours, packing, quality, secrets, sharding,
                           suffixes, token_files, warc)

QUERIES, SQL = {}, {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_secret_scan(spark, sf_dir):
    return secrets.report(common.documents(spark, sf_dir))


@query
def op2_quality_rules(spark, sf_dir):
    return quality.judge(common.documents(spark, sf_dir))


@query
def op3_token_planes(spark, sf_dir):
    return token_files.report(common.documents(spark, sf_dir))


@query
def op4_token_counts(spark, sf_dir):
    return counting.report(common.documents(spark, sf_dir))


@query
def op5_ngram_jaccard(spark, sf_dir):
    return jaccard.report(common.documents(spark, sf_dir))


@query
def op6_binary_packing(spark, sf_dir):
    return packing.report(common.documents(spark, sf_dir))


@query
def op7_jump_shards(spark, sf_dir):
    return sharding.place(common.documents(spark, sf_dir), 24)


@query
def op8_warc_transactions(spark, sf_dir):
    return warc.report(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query
def op9_byte_bpe(spark, sf_dir):
    return byte_bpe.report(common.documents(spark, sf_dir))


@query
def op10_vantage_trees(spark, sf_dir):
    return neighbours.report(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op11_token_alignment(spark, sf_dir):
    return alignment.report(common.documents(spark, sf_dir))


@query
def op12_vector_codes(spark, sf_dir):
    return codes.report(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op13_suffix_dedup(spark, sf_dir):
    return suffixes.report(common.documents(spark, sf_dir))


SQL["op2_quality_rules"] = quality.as_sql()
SQL["op8_warc_transactions"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS newest FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> newest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> newest THEN newest END AS refers_to
FROM g"""
