"""Raw documents to packed training sequences: five stages, each written as Parquet and read again.

Edge cases, in all stages: null texts count as empty and stay (toxicity: no match; near duplicates: copies of one
another; personal data: null; mix: never taken, since they have no word; packing: a row without a bin); null ids, repeated
rows and further columns, whatever their names, are kept as each operator's module says; an empty table stays empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tracewell.llm import mixing, packing, pii, simhash_wide, toxicity
from tracewell.llm.common import delete, shared_dir, table, workspace


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold, by a grammar learned from ``labels``."""
    return toxicity.keep_clean(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (0.8 or more of their five-word shingles): the one with the
    smallest id."""
    return simhash_wide.keep_one(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced by the kind in brackets."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often (0 to 2 times) as its source's token target takes it."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its bin, the bin's length and the place in it."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can't express learned models, Newton iterations or best-fit packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the ``documents`` of a folder. When a stage is written, its input and what it had set down on the
    way are deleted, and all of it if a stage fails; the last stage's rows stay in the shared folder, for the caller."""
    docs, before = table(spark, sf_dir, "documents"), ()
    at = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    try:
        for k, (name, stage) in enumerate(STAGES):
            path = f"{at}/{k}-{name}"
            with workspace(spark):
                stage(spark, docs, sf_dir).write.parquet(path)
            delete(spark, *before)
            docs, before = spark.read.parquet(path), (path,)
    except BaseException:
        delete(spark, at)
        raise
    return docs
