"""Corpus catalog: stores as views, existence checks, projects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.ids import get_or_create

# Project settings of the bootstrap step.
PROJECT_TYPES = {
    "SequenceLabeling": "SequenceLabelingProject",
    "DocumentClassification": "TextClassificationProject",
    "Seq2seq": "Seq2seqProject",
}
DEFAULT_PROJECT_TYPE = "SequenceLabeling"
EXAMPLE_TYPE_FILTER = "T047, T048, T184"


def register(spark: SparkSession, stores: dict[str, DataFrame]) -> None:
    """Every store becomes a temp view for ad hoc ``spark.sql``."""
    for name, df in stores.items():
        df.createOrReplaceTempView(name)


def exists(spark: SparkSession, name: str) -> bool:
    """Does a table or view exist."""
    return spark.catalog.tableExists(name)


def all_empty(frames: list[DataFrame]) -> bool:
    """Do all object groups have zero members (one cheap probe each)."""
    return all(df.isEmpty() for df in frames)


def first_run(spark: SparkSession, stores: list[str]) -> bool:
    """S12 + A6: every store of the catalog is missing or empty."""
    return all_empty([spark.table(name) for name in stores if exists(spark, name)])


def projects_get_or_create(existing: DataFrame, names: DataFrame,
                           project_type: str = DEFAULT_PROJECT_TYPE,
                           type_filter: str = "") -> DataFrame:
    """U6 + K11: one project per requested name; existing names keep their
    id, new ones get the next ids in name order, with their settings."""
    ids, _ = get_or_create(existing.select(F.col("name"), F.col("id")), names.select("name"), "name")
    rt = F.create_map(*[x for kv in PROJECT_TYPES.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    filters = F.when(F.lit(type_filter) == "", F.array().cast("array<string>")).otherwise(
        F.split(F.lit(type_filter), r",\s*"))
    return ids.select(
        "name", "id", "created",
        F.lit(project_type).alias("project_type"),
        rt[F.lit(project_type)].alias("resource_type"),
        filters.alias("filters"))
