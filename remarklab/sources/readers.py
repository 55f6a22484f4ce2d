"""Comment sources: CSV dumps, Parquet stages."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..config import DEFAULTS
from ..operators.joins import fits
from ..operators.rows import exact_sample, hash_sample
from ..schema import COMMENT_SCHEMA, c, missing_columns
from ..session import cache_stage

CORRUPT = "_corrupt_record"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_comments_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType = COMMENT_SCHEMA
) -> DataFrame:
    """CSV with header, line breaks inside quotes and doubled quotes as escapes.

    Records that do not fit the schema keep their text in ``_corrupt_record``. Quoted line breaks
    make a file one task; for large files see ``read_comments_csv_split``.
    """
    return (
        spark.read.schema(_with_corrupt(schema))
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def read_comments_csv_split(
    spark: SparkSession, path: str | list[str], record_start: str = "comment,",
    schema: T.StructType = COMMENT_SCHEMA, header_start: str = "type,",
) -> DataFrame:
    """As ``read_comments_csv``, with large files read in parallel splits.

    Every record starts with the same constant first field, so a line break followed by it
    separates records, and Spark can split a file there. A body may contain that text too; it
    then leaves pieces with an odd number of quotes. Splits that hold such pieces, or that begin
    inside such a body, are found first (one row per split); only their pieces are put in order and
    joined again where the quotes are balanced. So the result is exact either way (as long as no id
    is itself the word that starts records or the header), and no file is read by one task.
    """
    separator = "\n" + record_start
    pieces = spark.read.option("lineSep", separator).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("no"),
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    odd = (quotes % 2).cast("bigint")
    by_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = cache_stage(
        pieces.groupBy("file", "block").agg(F.sum(odd).alias("odd"))
        .withColumn("inside", F.coalesce(F.sum("odd").over(by_file), F.lit(0)) % 2)
        .filter("odd > 0 OR inside = 1").select("file", "block", "inside"),
        durable=True,
    )
    clean = pieces.select("value")
    if splits.head() is not None:
        small = F.broadcast if fits(splits, DEFAULTS.broadcast_rows) else (lambda x: x)
        torn = _joined_pieces(pieces.withColumn("odd", odd).join(small(splits), ["file", "block"]), separator)
        clean = pieces.join(small(splits), ["file", "block"], "left_anti").select("value").unionByName(torn)
    # every piece has lost its start, except the header (and the first record of a file without one)
    first_field = F.lit(record_start)
    record = F.when(
        F.col("value").startswith(header_start) | F.col("value").startswith(record_start), F.col("value")
    ).otherwise(F.concat(first_field, F.col("value")))
    record = F.regexp_replace(record, r"[\r\n]+$", "")
    options = {"escape": '"', "quote": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    full = _with_corrupt(schema)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.fields)
    rows = (
        clean.filter(~F.col("value").startswith(header_start))
        .select(F.from_csv(record, ddl, options).alias("x"))
        .select(*[F.col("x")[f.name].alias(f.name) for f in full.fields])
    )
    return rows


def _joined_pieces(pieces: DataFrame, separator: str) -> DataFrame:
    """Pieces of torn splits, joined to whole records (column ``value``).

    A piece starts a record if the quotes before it in its file are balanced; the pieces up to the next
    start belong to it, over the borders of splits. Each window holds the pieces of one split.
    """
    in_split = Window.partitionBy("file", "block").orderBy("no")
    before = F.coalesce(F.sum("odd").over(in_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("inside")
    numbered = pieces.withColumn("start", (before % 2 == 0).cast("int")).withColumn(
        "record", F.sum("start").over(in_split.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    # pieces before the first start of a split belong to the last record that an earlier split started
    starts = numbered.groupBy("file", "block").agg(F.max("record").alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    started = F.when(F.col("n") > 0, F.struct("block", F.col("n").alias("record")))
    last = starts.select("file", "block", F.last(started, ignorenulls=True).over(earlier).alias("last"))
    own = F.when(F.col("record") > 0, F.struct("block", F.col("record").cast("bigint").alias("record"))).otherwise(
        F.struct(F.col("last.block").alias("block"), F.col("last.record").cast("bigint").alias("record"))
    )
    parts = numbered.join(last, ["file", "block"]).select("file", own.alias("of"), F.struct("block", "no", "value").alias("p"))
    whole = parts.groupBy("file", "of").agg(F.array_sort(F.collect_list("p")).alias("p"))
    return whole.select(F.array_join(F.transform("p", lambda x: x["value"]), separator).alias("value"))


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt-record column, bad rows)."""
    bad = c(CORRUPT).isNotNull()
    return df.filter(~bad).drop(CORRUPT), df.filter(bad)


def read_comments_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.parquet(*paths)


def read_first_available(spark: SparkSession, paths: list[str], required: list[str] = ()) -> DataFrame:
    """The first of several Parquet stages that exists and has the required columns."""
    problems = []
    for path in paths:
        try:
            df = spark.read.parquet(path)
        except AnalysisException as error:
            problems.append(f"{path}: {error.getCondition()}")
            continue
        missing = missing_columns(df, required)
        if not missing:
            return df
        problems.append(f"{path}: lacks {', '.join(missing)}")
    raise FileNotFoundError("no usable stage: " + "; ".join(problems))


def csv_to_parquet_sample(
    spark: SparkSession, csv_path: str, out_path: str, fraction: float = 0.1, seed: int = 42,
    exact: bool = False, key: str = "id",
) -> None:
    """Sample a CSV dump by key hash (or to an exact row count) and store it as Parquet."""
    rows, _ = split_corrupt(read_comments_csv_split(spark, csv_path))
    sample = exact_sample(rows, key, fraction, seed=seed) if exact else hash_sample(rows, key, fraction, seed)
    sample.write.mode("overwrite").parquet(out_path)
