"""The corpus pipeline: stages over ``documents``, each written and read again by the next.

Every stage takes what its predecessor kept and returns the columns of ``documents``; the last one adds
the size, shard and slot of every row. An empty table passes through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina import tune
from lamina.llm import decontaminate, jaccard, mixing, quality, sharding
from lamina.llm.queries import DOMAIN_WEIGHTS, quality_model
from lamina.llm.tables import numbered
from lamina.runtime import materialize, scratch_scope


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject (a score of 0.3 or more).

    Null and empty texts are judged like any text without words.
    """
    model = quality_model(docs, _table(spark, sf_dir, "labels"))
    # The score must not replace a column of the documents that is called like it.
    named = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"), F.col("text"))
    scored = quality.score_quality(named, model).where("score >= 0.3")
    return scored.select("row.*")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by n-gram similarity, directly or over others, the one of the smallest id.

    Two documents link when their sets of runs of five words have a Jaccard similarity of 0.8 or more.
    Rows are told apart by a number of their own, whatever their ids: one row of each group stays, and every
    row that is linked with none. A null id is the smallest only where there is no other.
    """
    rows = numbered(docs, "__row")
    tune(spark)
    with scratch_scope(spark):
        found = jaccard.jaccard_components(rows, n=5, num=80, den=100, id_column="__row")
        grouped = found.where("n_links > 0").select(F.col("doc_id").alias("__row"), F.col("component_id").alias("__group"))
        grouped = materialize(grouped, "grouped-documents")
        order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row").alias("__id")
        members = beside(rows.select("__row", order), grouped, "__row", "inner")
        members = materialize(members.select("__row", "__group", "__id"), "grouped-rows")
        first = members.groupBy("__group").agg(F.min("__id")["__row"].alias("__first"))
        others = members.join(first, "__group").where("__row != __first").select("__row")
        others = materialize(others, "linked-copies", lasting=True)
    return beside(rows, others, "__row", "left_anti").select(*[f"`{c}`" for c in docs.columns])


_BROADCAST_ROWS = 2_000_000  # numbers of rows, 16 bytes each


def beside(rows: DataFrame, chosen: DataFrame, on: str, how: str) -> DataFrame:
    """``rows`` joined to a written table of row numbers, which is broadcast up to a number of rows."""
    return rows.join(F.broadcast(chosen) if chosen.count() <= _BROADCAST_ROWS else chosen, on, how)


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of ten words or more that they share with benchmark items.

    A document more than half of whose words are such goes; null and empty texts and those that share nothing stay as
    they are, and so do repeated rows and columns of any name. Items without words match nothing.
    """
    items = _table(spark, sf_dir, "benchmark")
    length = "n_chars" if "n_chars" in docs.columns else None
    return decontaminate.remove_items(docs, items, window=10, max_coverage=0.5, length_column=length)


def reach_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the numbers that bring the domains to their target shares of the tokens.

    A warning names the shares that are not reached. Null and empty texts have no tokens and the rate of the labels'
    frequencies; repeated rows get the same copies each; no column is replaced, whatever it is called.
    """
    labels = _table(spark, sf_dir, "labels").withColumn("domain", mixing.domain_of_labels())
    # What mixing adds must not replace a column of the documents that is called like it.
    named = docs.select("doc_id", "text", F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"))
    mixed = mixing.mix(named, labels, DOMAIN_WEIGHTS, anchor="clean", columns=["row"])
    return mixing.taken(mixed, ["row.*"])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its size, its shard of sixteen and its slot there.

    Equal texts share a shard, null ones as a group of size 1 a row; columns called size, shard or slot are replaced.
    """
    return sharding.minimax_shards(docs, n_shards=16)


STAGES = [
    ("quality", keep_good),
    ("near duplicates", keep_one_of_each_group),
    ("decontamination", remove_benchmarks),
    ("mixing", reach_targets),
    ("sharding", shard),
]

# A trained classifier, and rates found by iteration, are beyond SQL. tests/llm/test_pipeline.py holds every stage and
# run() against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next; an empty table passes through."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
