"""Corpus preparation: quality rules, near duplicates, secret masking and packing."""

from __future__ import annotations

from pulseloom.llm import common, jaccard, packing, quality, secrets


def quality_rules(spark, docs, sf_dir):
    """Documents that pass the threshold table."""
    return quality.keep(docs)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near copies."""
    return jaccard.keep_one(docs)


def secret_scan(spark, docs, sf_dir):
    """All documents, with every reported span masked."""
    return secrets.mask(docs)


def binary_packing(spark, docs, sf_dir):
    """The pieces of all documents and their sequences."""
    return packing.report(docs)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("secret_scan", secret_scan),
          ("binary_packing", binary_packing)]

# packing counts tokens, which SQL cannot
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages over the documents, each staged for the next one."""
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = common.staged(stage(spark, docs, sf_dir), common.run_dir(spark, name))
    return STAGES[-1][1](spark, docs, sf_dir)
