"""Tables as files sorted by key with an index of their ranges: an upsert rewrites only files it hits.

A folder holds ``data`` (files, never changed), ``index`` (per version the files with their lowest and
highest key) and ``commits`` (one row per finished version). Readers take the last commit, so a writer
that fails leaves nothing visible. One writer at a time; files of old versions stay for readers that
still use them, and for the folder's own retention.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oncolake.operators.consolidate import pick_by_key
from oncolake.operators.staging import stage_table

#: Rows of a file at most; a changed file is split where it grows beyond.
ROWS_PER_FILE = 1_000_000
KEYS = ("resource_type", "id")


def write_sorted_table(
    rows: DataFrame, folder: str, keys: Sequence[str] = KEYS, files: int | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Write a table as the first version in ``folder``, or as a new one that replaces all rows.

    Rows of a repeated key become one, the greatest. Keys must not be null: such rows raise an error.
    ``owner`` is a column of the files and may not be one of the rows.
    """
    if "owner" in rows.columns:
        raise ValueError("rename the column owner first")
    rows = _one_per_key(rows, keys).withColumn("owner", F.lit(0).cast("long"))
    path = _write(rows, folder, keys, files, rows_per_file)
    _commit(_ranges(rows.sparkSession, path, keys), folder)


def read_sorted_table(
    spark: SparkSession, folder: str, keys: Sequence[str] = KEYS, between: tuple | None = None
) -> DataFrame:
    """The rows of the last version; with ``between`` (two key tuples, both inclusive) only files and rows in there."""
    index = table_index(spark, folder)
    if between:
        low, high = (F.struct(*[F.lit(x).alias(k) for x, k in zip(end, keys)]) for end in between)
        index = index.filter((F.col("high") >= low) & (F.col("low") <= high))
    rows = _read(spark, folder, [r.file for r in index.select("file").collect()])
    if between:
        rows = rows.filter(F.struct(*keys).between(low, high))
    return rows.drop("owner")


def upsert_sorted_table(
    changes: DataFrame, folder: str, keys: Sequence[str] = KEYS, files: int | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> DataFrame:
    """Replace rows by key and add new ones. Gives the index rows of the files that were rewritten.

    A file owns the keys from its lowest to the lowest of the next one. Only files that own a key
    of the batch are read and written, so the cost follows the batch and the files it touches. A
    rewritten file is never merged with another, so ranges stay apart. An empty batch commits nothing.
    """
    spark = changes.sparkSession
    index = table_index(spark, folder)
    columns = [c for c in _read(spark, folder, [index.select("file").first().file]).columns if c != "owner"]
    batch = stage_table(_one_per_key(changes.select(*columns), keys), "changes")
    owned = stage_table(_owners(batch.select(*keys), index, keys), "owned")
    hit = stage_table(index.join(owned.select("owner").distinct(), "owner", "left_semi"), "hit")
    paths = {r.owner: r.file for r in hit.select("owner", "file").collect()}  # a path per file to open
    if not paths:
        return hit
    old = _read(spark, folder, list(paths.values())).drop("owner")
    old = old.withColumn("__file", F.col("_metadata.file_path"))
    names = hit.select("owner", F.substring_index("file", "/", -2).alias("__name"))
    old = old.withColumn("__name", F.substring_index("__file", "/", -2)).join(names, "__name").drop("__name", "__file")
    kept = old.join(batch.select(*keys), list(keys), "left_anti").select(*columns, "owner")
    merged = kept.unionByName(batch.join(owned, list(keys)).select(*columns, "owner"))
    path = _write(merged, folder, keys, files, rows_per_file)
    _commit(index.join(hit, "owner", "left_anti").drop("owner").unionByName(_ranges(spark, path, keys)), folder)
    return hit


def table_index(spark: SparkSession, folder: str) -> DataFrame:
    """Files of the last version: ``owner`` (a number), ``file`` (below ``data``), ``low``, ``high``, ``rows``."""
    last = spark.read.parquet(f"{folder}/commits").agg(F.max_by("version", "number")).first()[0]
    return spark.read.parquet(f"{folder}/index/{last}")


def _one_per_key(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    for key in keys:
        checked = F.when(F.col(key).isNull(), F.raise_error(F.lit(f"{key} is null"))).otherwise(F.col(key))
        rows = rows.withColumn(key, checked)
    rest = [name for name in rows.columns if name not in keys]
    return pick_by_key(rows, keys, rest) if rest else rows.distinct()


def _read(spark: SparkSession, folder: str, files: list[str]) -> DataFrame:
    if files:
        return spark.read.parquet(*[f"{folder}/data/{file}" for file in files])
    first = table_index(spark, folder).select("file").first().file
    return spark.read.parquet(f"{folder}/data/{first}").limit(0)


def _write(rows: DataFrame, folder: str, keys: Sequence[str], files: int | None, rows_per_file: int) -> str:
    """Sorted files, none of which holds keys of two owners; a hot owner is spread over tasks by key."""
    order = ["owner", *keys]
    placed = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    path = f"{folder}/data/{uuid.uuid4().hex}"
    # The writer sorts by the partition column alone unless the rows are sorted by it already.
    writer = placed.sortWithinPartitions(*order).write.partitionBy("owner")
    writer.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return path


def _ranges(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """One row per file that was written, from its key columns alone."""
    key = F.struct(*keys)
    name = F.concat(F.lit(path.rsplit("/", 1)[1] + "/"), F.substring_index("_metadata.file_path", "/", -2))
    rows = spark.read.parquet(path).select(name.alias("file"), key.alias("key"))
    return rows.groupBy("file").agg(
        F.min("key").alias("low"), F.max("key").alias("high"), F.count(F.lit(1)).alias("rows")
    )


def _commit(index: DataFrame, folder: str) -> None:
    spark, version = index.sparkSession, uuid.uuid4().hex
    numbered = index.select(F.monotonically_increasing_id().alias("owner"), "file", "low", "high", "rows")
    numbered.write.parquet(f"{folder}/index/{version}")
    try:
        number = spark.read.parquet(f"{folder}/commits").agg(F.max("number")).first()[0] + 1
    except Exception as error:  # no commit yet
        if "PATH_NOT_FOUND" not in str(error):
            raise
        number = 0
    row = spark.range(1).select(F.lit(number).alias("number"), F.lit(version).alias("version"))
    row.write.mode("append").parquet(f"{folder}/commits")


def _owners(rows: DataFrame, index: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with the file that owns them: the last one whose lowest key is not above, or the first file.

    Keys and lowest keys are range partitioned together; a partition hands the last file it knows on to
    the next ones. So no key meets all files, and the index is not sent anywhere whole.
    """
    points = rows.select(*keys, F.lit(None).cast("long").alias("owner"), F.lit(1).alias("__kind")).unionByName(
        index.select(*[F.col(f"low.{k}").alias(k) for k in keys], "owner", F.lit(0).alias("__kind"))
    )
    order = [*keys, "__kind"]
    placed = points.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    placed = stage_table(placed, "points")
    parts = placed.groupBy("__part").agg(F.max_by("owner", F.when(F.col("owner").isNotNull(), F.struct(*order))).alias("__last"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    carried = parts.select("__part", F.last("__last", ignorenulls=True).over(before).alias("__carried"))
    within = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    known = placed.withColumn("__own", F.last("owner", ignorenulls=True).over(within)).filter("__kind = 1")
    first = index.agg(F.min_by("owner", "low")).first()[0]
    return known.join(carried, "__part").select(
        *keys, F.coalesce("__own", "__carried", F.lit(first)).alias("owner")
    )
