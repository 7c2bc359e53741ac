"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)``, where ``docs`` is what the stage
before kept, read from Parquet, and works on all of it.  All but the last
return the columns of ``documents``, whatever other columns there are.  Null
text counts as empty, rows without a doc_id are judged by their text, repeated
rows are judged each, and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessella.llm import exact_dedup, jaccard, language_id, packing, toxicity
from tessella.llm.common import materialize, release


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts predicted toxic go (a score at the threshold too); labels come from the ``labels`` table."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null texts, texts without a letter, and texts unlike any language learned, go."""
    return language_id.keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal up to white space one row stays, that of the smallest doc_id; an id with several texts keeps them."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by shared shingles the smallest doc_id stays; rows without one, and without words, stay."""
    return jaccard.keep_representatives(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining documents with their places in sequences."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("language", drop_unidentified), ("exact_dedup", drop_copies), ("jaccard", drop_near_copies), ("packing", pack_sequences)]

#: The first stages are learned models, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``; every stage is a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
        if before is not None:
            release(before)
        before = docs
    return docs
