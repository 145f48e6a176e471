"""Durable intermediate tables, numbered parts of groups and skew-proof joins and ranks."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the session's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="oncolake-")
        context.setCheckpointDir(folder)
    return folder


def stage_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Unlike a cache it survives lost executors, and unlike ``checkpoint()`` later readers fetch only
    the columns and partitions they use. Hashed ids, most of many tables, are hex digits, which only a
    codec with entropy coding halves. The shuffles of the write are deleted with its end; else their files
    stay until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        # A new plan: whether it deletes its shuffles is settled when it is made.
        writer = df.select("*").write.mode("overwrite").option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    return staged


def drop_staged(*tables: DataFrame) -> None:
    """Delete tables as ``stage_table`` returned them, which nothing reads from here on."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table._staged_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def setting(spark: SparkSession, name: str, value) -> Iterator[None]:
    """A setting of the session for some actions."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def few_rows_at_once(spark: SparkSession, rows: int = 32):
    """For actions on written tables with whole bundles in a row.

    Each task holds a batch of rows in one array per column; with the session's 4,096 rows of some 100 KB
    that array, and its copies as it grows, are most of an executor.
    """
    return setting(spark, "spark.sql.parquet.columnarReaderBatchSize", rows)


def small_scans(spark: SparkSession, mb: int = 32):
    """For actions that make many rows of each row they scan and group them before a shuffle.

    A task's share of a scan grows with the table up to ``spark.sql.files.maxPartitionBytes``; packed
    reports of that size make groups that no longer fit into a task's memory and are spilled.
    """
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    number, unit = re.match(r"(\d+)\s*([kmgt]?)", before.lower()).groups()
    given = int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]
    return setting(spark, name, min(given, mb << 20))


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality of equally named key columns."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def rank_in_groups(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str = "rank"
) -> DataFrame:
    """Exact row number per group, also when one group holds most of the rows.

    The rows are range partitioned by group and order and staged, so a big group spans many
    partitions. Each row is numbered within its part and shifted by the pre-aggregated sizes of the
    parts before it.
    """
    order = [F.col(item) if isinstance(item, str) else item for item in order]
    names = [f"__order{i}" for i in range(len(order))]
    ordered = df.select("*", *[item.alias(alias) for item, alias in zip(order, names)])
    placed = ordered.repartitionByRange(*keys, *names).withColumn("__part", F.spark_partition_id())
    staged = stage_table(placed, "rank")
    parts = staged.groupBy(*keys, "__part").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parts.select(
        *[F.col(key).alias(f"__{key}") for key in keys],
        F.col("__part").alias("__shift_part"),
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__shift"),
    )
    local = staged.withColumn(
        "__local",
        F.row_number().over(Window.partitionBy(*keys, "__part").orderBy(*names)),
    )
    condition = local["__part"] == shifts["__shift_part"]
    for key in keys:
        condition = condition & local[key].eqNullSafe(shifts[f"__{key}"])
    return local.join(shifts, condition).select(
        *df.columns, (F.col("__local") + F.col("__shift")).cast("int").alias(name)
    )


def number_parts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int | None, part: str = "part"
) -> DataFrame:
    """Add a part number. Without ``max_rows`` every group is one part.

    With it, the first ``max_rows`` rows of a group by ``order`` are part 0, the next ones part 1, and
    so on. Ranks are exact also for a group that spans many partitions.
    """
    if max_rows is None:
        return df.withColumn(part, F.lit(0))
    ranked = rank_in_groups(df, keys, order, "__rank")
    number = F.floor((F.col("__rank") - 1) / F.lit(max_rows)).cast("int")
    return ranked.withColumn(part, number).drop("__rank")


def left_join_hot_right(left: DataFrame, right: DataFrame, condition: Column, left_key: Column,
                        right_key: Column) -> DataFrame:
    """Left outer join whose right side may hold a hot key.

    The adaptive planner may not split the right side of an outer join, but it may split either
    side of an inner one. So matches come from an inner join and the rest from an anti join against
    the distinct right keys, which are pre-aggregated to one row per key.
    """
    matched = left.join(right, condition, "inner")
    keys = right.select(right_key.alias("__key")).distinct()
    unmatched = left.join(keys, left_key.eqNullSafe(keys["__key"]) & left_key.isNotNull(), "left_anti")
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
    return matched.unionAll(unmatched.select(*[unmatched[c] for c in left.columns], *empty))


def full_join_hot_left(many: DataFrame, one: DataFrame, condition: Column, many_key: Column,
                       one_key: Column) -> DataFrame:
    """Full outer join of a large table with a hot key and a table that is unique by that key.

    A left join can be split on the large side; rows of the unique table without a partner come
    from an anti join against the distinct keys of the large table.
    """
    left = many.join(one, condition, "left")
    keys = many.select(many_key.alias("__key")).distinct()
    alone = one.join(keys, one_key == keys["__key"], "left_anti")
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in many.schema.fields]
    return left.unionAll(alone.select(*empty, *[alone[c] for c in one.columns]))
