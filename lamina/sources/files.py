"""CSV and Parquet files."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Header CSV in UTF-8 with a declared schema; an empty field is NULL.

    A line that does not fit the schema keeps its text in ``_corrupt_record`` instead of failing
    the job; nothing is inferred, so the files are read once.
    """
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(full)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def reader(
    spark: SparkSession, folder: str, fmt: str, schemas: Mapping[str, str]
) -> Callable[[str], DataFrame]:
    """A function that opens exported source tables by name, ``<folder>/<name>.<fmt>``.

    Lines of a CSV file that do not fit keep their text in ``_corrupt_record``; the clean layer
    rejects them and drops the text.
    """
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unknown export format {fmt!r}")

    def read(name: str) -> DataFrame:
        path = f"{folder.rstrip('/')}/{name}.{fmt}"
        if fmt == "parquet":
            return read_parquet(spark, path)
        return read_csv(spark, path, schemas[name])

    return read


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("encoding", "UTF-8").csv(path)


def read_parquet(
    spark: SparkSession, path: str, schema: str | T.StructType | None = None
) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)
