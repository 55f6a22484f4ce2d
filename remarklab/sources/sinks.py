"""Writing stages, reports and models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.profile import completeness
from ..schema import c, select_existing


def write_stage(df: DataFrame, path: str, columns=None, partition_by: str | None = None) -> None:
    """Overwrite a Parquet stage with the listed columns that exist."""
    out = df if columns is None else select_existing(df, columns)
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def verify_stage(spark: SparkSession, path: str) -> DataFrame:
    """Read a stage back: (column_name, non_null, nulls, pct_complete) in one pass."""
    return completeness(spark.read.parquet(path))


def write_json_report(df: DataFrame, path: str) -> None:
    """A report frame as a folder of JSON lines, each task's rows in a file of its own."""
    df.write.mode("overwrite").json(path)


# a document is one row: sections beyond this many rows are no report
DOCUMENT_ROWS = 10_000


def report_document(sections: dict[str, DataFrame], max_rows: int = DOCUMENT_ROWS) -> DataFrame:
    """One row, one array-of-structs column per report section: a single JSON document.

    Sections of more than ``max_rows`` rows are refused; write those with ``write_json_report``.
    """
    out = None
    for name, frame in sections.items():
        if frame.limit(max_rows + 1).count() > max_rows:
            raise ValueError(f"section {name} has more than {max_rows} rows")
    for name, frame in sections.items():
        packed = frame.agg(F.collect_list(F.struct(*[c(x) for x in frame.columns])).alias("v")).scalar()
        spark = frame.sparkSession
        out = spark.range(1).select(packed.alias(name)) if out is None else out.withColumn(name, packed)
    return out


def sample_predictions(
    df: DataFrame, columns: list[str], n: int = 1000, order: str = "id"
) -> DataFrame:
    """The first n predictions with their text and labels, for inspection."""
    return select_existing(df, columns).orderBy(c(order)).limit(n)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
