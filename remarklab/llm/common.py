"""Helpers that the operators share: Arrow passes over texts, name clashes, durable cuts."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

# rows that one Arrow batch holds at most, and bytes of text that a function gets at once
BATCH_ROWS = 512
BATCH_BYTES = 2 << 20


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package: Spark's own file service copies it to them."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), os.path.basename(root) + ".zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker gets at once: texts may be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def slices(batch: pa.RecordBatch, column: int, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``limit`` bytes of text each; no row is cut."""
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
    start = total = 0
    for i, n in enumerate(lengths):
        if total and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


def free_name(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores in front until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


_HELD: dict = {}


def held(key, make: Callable):
    """What ``make`` returns, kept by this worker from task to task until it needs another key: workers are used again
    by later jobs, and one that kept the tables of every operator would hold all of them at once."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def append_columns(
    df: DataFrame, text: str, schema: str, make: Callable[[], Callable[[list], Iterable[pa.Array]]],
    keep: list[str] | None = None,
) -> DataFrame:
    """Add the columns of ``schema`` that a function computes from the values of column ``text``.

    ``make()`` runs once per task and returns the function; it gets a list of values and returns one
    array per new column. ``keep`` names the columns to keep (all by default); a kept column whose
    name clashes with a new one gives way to it.
    """
    ship_package(df.sparkSession)
    small_batches(df.sparkSession)
    new = T.StructType.fromDDL(schema)
    taken = {f.name.lower() for f in new}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
    source = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias(free_name(kept, "__text")))
    out = T.StructType(list(source.schema)[:-1] + list(new))
    types = to_arrow_schema(new).types

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            last = batch.num_columns - 1
            for part in slices(batch, last):
                columns = [x if isinstance(x, pa.Array) else pa.array(x, t)
                           for x, t in zip(fn(part.column(last).to_pylist()), types, strict=True)]
                yield pa.RecordBatch.from_arrays(part.columns[:last] + columns, names=out.names)

    return source.mapInArrow(run, out)


def lower_ascii(text: str) -> str:
    """A-Z in lower case, every other character as it is."""
    return text.translate(ASCII_LOWER)


ASCII_LOWER = {i: i + 32 for i in range(65, 91)}


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; NULL for a NULL id."""
    return F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % modulus


def cut(df: DataFrame) -> DataFrame:
    """Write a frame to the folder named by ``spark.checkpoint.dir`` and read it back.

    The folder is shared, so a lost executor costs nothing; the lineage ends here.
    """
    from remarklab.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# a key with more than one in HOT rows is hot, so there are fewer than HOT; its rows are spread over SALTS tasks
HOT, SALTS = 200, 64


def join_spread(rows: DataFrame, table: DataFrame, key: str, spread: str) -> DataFrame:
    """Inner join on ``key`` with a table of one row per key, where one key may hold a third of the rows.

    Rows of hot keys get a salt from a hash of the column ``spread``, and their row of the table is
    copied once per salt. The list of hot keys is broadcast: it has fewer than ``HOT`` entries.
    """
    counts = rows.groupBy(key).count()
    least = rows.count() // HOT
    hot = cut(counts.where(F.col("count") > max(least, SALTS)).select(key, F.lit(True).alias("__hot")))
    salt = F.when(F.col("__hot"), F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    salts = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    many = rows.join(F.broadcast(hot), key, "left").withColumn("__salt", salt).drop("__hot")
    copies = table.join(F.broadcast(hot), key, "left").withColumn("__salt", F.explode(salts)).drop("__hot")
    return many.join(copies, [key, "__salt"]).drop("__salt")
