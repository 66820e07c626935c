"""Training-corpus pipeline: five stages from documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; a stage's
result is written and read again as the next one's docs. All but the last
return the columns of documents.

1. language ID: documents whose language cannot be told (``und``) go.
2. line dedup: lines that repeat across documents stay in the first only.
3. SimHash near-dedup: one document of each class stays.
4. mixing: clean text is kept (rate 1), and of the domains that are over their
   target weight beside it (poor, toxic) documents are drawn with lower rates; a
   domain under its weight stays whole. The totals reached are logged.
5. best-fit packing into sequences of 4096 tokens.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from sunlight.llm import language_id, line_dedup, mixing, packing, simhash
from sunlight.llm.common import stash, table


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.fit(spark, docs)
    found = language_id.identify(spark, docs, model, names=("__language", "__score"))
    return found.where(found["__language"] != language_id.UNKNOWN).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(spark, docs, report=("__lines", "__dropped")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(spark, docs)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed, targets, reached = mixing.mix(spark, docs, mixing.label_domains(table(spark, sf_dir, "labels")),
                                         keep_domain="good")
    for domain, target, total in zip(mixing.DOMAINS, targets, reached):
        logging.getLogger(__name__).info("mixing: %s reaches %.0f of %.0f tokens", domain, total, target)
    return mixing.sample_by_rate(mixed)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(spark, docs, packing.production_tokenizer()).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("language_id", keep_known_language), ("line_dedup", drop_repeated_lines),
          ("simhash_near_dedup", drop_near_duplicates), ("mixing", mix_to_weights),
          ("best_fit_packing", pack)]

# Fingerprints, a fitted classifier and a tokenizer are not SQL; tests/llm compares the stages
# with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
