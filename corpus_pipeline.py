"""Corpus pipeline: documents through toxicity, exact and near duplicates, decontamination and mixing.

Every stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the columns of
``docs``. Rows are told apart by id and text, so that null and repeated ids do no harm. A stage drops
what its operator rejects and nothing else:

1. toxicity: documents with a score of 0.5 or more go;
2. exact_dedup: of equal texts the one with the largest id stays;
3. near_dedup: of a component of near duplicates (five words, 0.8) the one with the smallest id stays;
4. decontaminate: documents that hold a benchmark window go;
5. mixing: every document as often as the mix takes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm import decontaminate, exact_dedup, mixing, near_dedup, toxicity
from weekloom.llm.common import stored, table, text_key, without


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", text_key(F.col("text")).alias("text_key"))


def _dropped(found: DataFrame) -> DataFrame:
    return found.filter("NOT kept").select(F.col("id").alias("doc_id"), "text_key")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    index = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, index, out="__toxicity")
    return scored.filter(F.col("__toxicity.score") < 0.5).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without(docs, _dropped(exact_dedup.exact_dedup(*exact_dedup.halves(_keyed(docs)), carry=("text_key",))))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without(docs, _dropped(near_dedup.near_duplicates(_keyed(docs), carry=("text_key",))))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, found.filter("n_hit > 0").select(F.col("id").alias("doc_id"), "text_key"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emitted(mixing.mixed(docs))


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies), ("decontaminate", drop_contaminated), ("mixing", mix)]

#: The first stage is a model, which SQL does not express; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
