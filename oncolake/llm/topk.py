"""Exact top-k inner products: blocks by descending length, rotated partial sums, residual bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oncolake.llm.shipping import ship_package, small_batches
from oncolake.llm.textbytes import release_memory
from oncolake.operators.staging import stage_table

#: Vectors in a block of candidates and of queries, vectors in a norm band, queries that meet a band in
#: one group, and vectors the rotation is fitted on. None of them changes a result.
BLOCK, QUERY_BLOCK, BAND, SLOT, SAMPLE = 4096, 512, 16_384, 8192, 10_000
#: A round takes this many times the bands before it; lengths that a round fetches to the driver.
GROWTH, LENGTHS = 4, 1024
#: Rotated dimensions after which candidates are pruned.
STEPS = (4, 8, 16, 32)


def whole_vectors(
    rows: DataFrame, key: str, vector: str, is_query: str = "false", scale: int = 256
) -> DataFrame:
    """(id, v, norm2, asked): components times ``scale``, rounded down, without unusable vectors.

    Null ids, null vectors, empty vectors and vectors with a null or non-finite component take no part.
    """
    value = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(
        value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    rows = rows.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & finite)
    whole = F.transform(value, lambda x: F.floor(x * scale))
    asked = F.coalesce(F.expr(is_query), F.lit(False)).alias("asked")
    rows = rows.select(F.col(key).cast("long").alias("id"), whole.alias("v"), asked)
    norm2 = F.aggregate("v", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))
    return rows.withColumn("norm2", norm2)


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """A list column as a matrix; shorter vectors are filled up with zeros."""
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(int)
    if (sizes == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _packed(rows: DataFrame, width: int, size: int) -> DataFrame:
    """Rows of a partition as blocks of at most ``size`` vectors, in their order, with a length that none exceeds."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting_ids, waiting, band, longest = [], [], None, 0.0
        for batch in batches:
            if not batch.num_rows:
                continue
            band = batch.column(2)[0].as_py()
            longest = max(longest, float(np.sqrt(batch.column(3).to_numpy().max())))
            waiting_ids.append(batch.column(0).to_numpy().astype(np.int64))
            waiting.append(_matrix(batch.column(1), width))
            while sum(map(len, waiting)) >= size:
                ids, table = np.concatenate(waiting_ids), np.concatenate(waiting)
                yield _block(band, longest, ids[:size], table[:size])
                waiting_ids, waiting = [ids[size:]], [table[size:]]
        if sum(map(len, waiting)):
            yield _block(band, longest, np.concatenate(waiting_ids), np.concatenate(waiting))

    return rows.mapInArrow(pack, "band int, longest double, ids binary, vectors binary")


def _block(band: int, longest: float, ids: np.ndarray, table: np.ndarray) -> pa.RecordBatch:
    columns = [
        pa.array([band], pa.int32()), pa.array([longest]), pa.array([ids.tobytes()]), pa.array([table.tobytes()])
    ]
    return pa.RecordBatch.from_arrays(columns, names=["band", "longest", "ids", "vectors"])


def top_of_block(
    q_ids: np.ndarray, q: np.ndarray, floor: np.ndarray, x_ids: np.ndarray, x: np.ndarray,
    rotation: np.ndarray, k: int,
) -> list[tuple[int, int, int]]:
    """Up to ``k`` best (query, id, score) per query among the candidates that reach its floor.

    Partial sums over rotated dimensions plus the product of what is left of both lengths bound a
    score from above. A pair below the floor drops out; the rest is scored in whole numbers.
    """
    qr, xr = q @ rotation, x @ rotation
    slack = 1e-9 * np.linalg.norm(qr, axis=1)[:, None] * np.linalg.norm(xr, axis=1)[None, :] + 1e-6
    q_left, x_left = _left(qr), _left(xr)
    alive = q_left[0][:, None] * x_left[0][None, :] + slack >= floor[:, None]
    alive &= q_ids[:, None] != x_ids[None, :]
    some = np.flatnonzero(alive.any(axis=0))
    x, xr, x_ids, alive, slack = x[some], xr[some], x_ids[some], alive[:, some], slack[:, some]
    x_left = x_left[:, some]
    partial, begin = np.zeros(alive.shape), 0
    for end in [*[s for s in STEPS if s < q.shape[1]], q.shape[1]]:
        if not len(x_ids):
            return []
        partial += qr[:, begin:end] @ xr[:, begin:end].T
        bound = partial + q_left[end][:, None] * x_left[end][None, :] + slack
        alive &= bound >= floor[:, None]
        begin = end
        some = alive.any(axis=0)
        if some.sum() < len(some) // 2:
            x, xr, x_ids, alive, slack = x[some], xr[some], x_ids[some], alive[:, some], slack[:, some]
            partial, x_left = partial[:, some], x_left[:, some]
    found = []
    for row in range(len(q_ids)):
        at = np.flatnonzero(alive[row])
        if len(at) > k:
            # By the sums so far, no more than the slack away from the scores.
            least = np.partition(partial[row, at] - slack[row, at], len(at) - k)[len(at) - k]
            at = at[partial[row, at] + slack[row, at] >= least]
        if not len(at):
            continue
        score = x[at] @ q[row]
        best = np.lexsort((x_ids[at], -score))[:k]
        found += [(int(q_ids[row]), int(x_ids[at[b]]), int(score[b])) for b in best if score[b] >= floor[row]]
    return found


def _left(rotated: np.ndarray) -> np.ndarray:
    """Row d: the length of each vector without its first d rotated dimensions."""
    squares = np.cumsum((rotated**2)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.vstack([squares.T, np.zeros(len(rotated))]))


def _score(pairs: DataFrame, rotation: np.ndarray, k: int) -> DataFrame:
    width = len(rotation)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids = np.frombuffer(row["q_ids"], np.int64)
                q = np.frombuffer(row["q_vectors"], np.int64).reshape(-1, width)
                floor = np.frombuffer(row["floors"], np.float64)
                x_ids = np.frombuffer(row["ids"], np.int64)
                x = np.frombuffer(row["vectors"], np.int64).reshape(-1, width)
                found = top_of_block(q_ids, q, floor, x_ids, x, rotation, k)
                columns = [pa.array(c, pa.int64()) for c in zip(*found)] or [pa.array([], pa.int64())] * 3
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])
        release_memory()

    return pairs.mapInArrow(run, "query_id long, vec_id long, score long")


def _best(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_inner_products(
    rows: DataFrame, is_query: str, key: str = "vec_id", vector: str = "embedding", k: int = 5
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best candidates of each query, ties to smaller ids.

    Queries are the rows where the SQL condition ``is_query`` holds; candidates all rows
    with another id. Vectors become whole numbers first (``whole_vectors``); a shorter vector counts
    as filled up with zeros. Rows of a repeated id are all candidates, and one of them is the query.
    Candidates lie in bands of descending length. The band of the longest gives each query a floor.
    Each further round takes more bands, leaves out those too short for the floors of a query block
    before any vector moves, scores the others block by block and raises the floors. An empty
    table gives no rows.
    """
    spark = rows.sparkSession
    ship_package(spark)
    whole = whole_vectors(rows, key, vector, is_query)
    count, width = whole.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    sample = whole.orderBy(F.xxhash64("id"), "id").select("v").limit(SAMPLE).toArrow().column(0)
    sample = _matrix(sample.combine_chunks() if isinstance(sample, pa.ChunkedArray) else sample, width)
    _, _, rotation = np.linalg.svd(sample.astype(float).T @ sample.astype(float))
    rotation = rotation.T
    bands = -(-count // BAND)
    order = [F.desc("norm2"), F.col("id")]
    placed = whole.repartitionByRange(bands, *order).sortWithinPartitions(*order)
    placed = placed.withColumn("band", F.spark_partition_id())
    blocks = stage_table(_packed(placed.select("id", "v", "band", "norm2"), width, BLOCK), "blocks")
    asked = whole.filter("asked").groupBy("id").agg(F.min(F.struct("v", "norm2")).alias("q"))
    asked = stage_table(asked.select("id", "q.v", "q.norm2"), "queries")
    slots = max(1, -(-asked.count() // SLOT))
    best, begin, end = None, 0, 1
    while begin < bands:
        queries = stage_table(_query_blocks(_with_floors(asked, best, k), width, slots), "query-blocks")
        found = _score(block_pairs(queries, blocks, begin, end), rotation, k)
        if best is not None:
            found = best.select("query_id", "vec_id", "score").unionAll(found)
        best = stage_table(_best(found, k), "best")
        begin, end = end, min(bands, end * GROWTH)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _with_floors(asked: DataFrame, best: DataFrame | None, k: int) -> DataFrame:
    """Queries with the score of their ``k``-th best so far and the least length that may reach it."""
    lowest = F.lit(float("-inf"))
    if best is None:
        return asked.select("id", "v", lowest.alias("floor"), lowest.alias("need"))
    floors = best.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("floor"))
    need = F.when(F.col("floor") > 0, F.col("floor") * (1 - 1e-9) / F.sqrt("norm2")).otherwise(lowest)
    rows = asked.join(floors, "id", "left")
    return rows.select("id", "v", F.coalesce("floor", lowest).alias("floor"), need.alias("need"))


def _query_blocks(queries: DataFrame, width: int, slots: int) -> DataFrame:
    """Blocks of queries that need candidates of similar length, with the least length of each block."""
    order = [F.desc("need"), F.col("id")]
    placed = queries.repartitionByRange(slots, *order).sortWithinPartitions(*order)
    placed = placed.withColumn("slot", F.spark_partition_id()).select("slot", "id", "v", "floor", "need")
    size = QUERY_BLOCK

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, size):
                part = batch.slice(begin, size)
                ids, floors, need = (part.column(i).to_numpy() for i in (1, 3, 4))
                columns = [
                    part.column(0)[:1], pa.array([ids.astype(np.int64).tobytes()]),
                    pa.array([_matrix(part.column(2), width).tobytes()]),
                    pa.array([floors.astype(float).tobytes()]), pa.array([need.min()], pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["slot", "q_ids", "q_vectors", "floors", "need"])

    return placed.mapInArrow(pack, "slot int, q_ids binary, q_vectors binary, floors binary, need double")


def block_pairs(queries: DataFrame, blocks: DataFrame, begin: int, end: int) -> DataFrame:
    """Query blocks with the candidate blocks of bands ``begin`` to ``end`` that are long enough for them.

    Bands are of descending length, so a query block needs a run of bands from the first one on. How far
    it goes is read from the longest vectors of at most ``LENGTHS`` runs of bands. Vectors move only
    for (band, slot) pairs in that reach, each of which is a key of its own.
    """
    step = -(-(end - begin) // LENGTHS)
    runs = blocks.filter(F.col("band").between(begin, end - 1)).groupBy(
        F.floor((F.col("band") - begin) / step).cast("int").alias("run")
    ).agg(F.max("longest").alias("longest"))
    known = dict(runs.collect())
    longest, reach = 0.0, []
    for run in range(-(-(end - begin) // step) - 1, -1, -1):
        longest = max(longest, known.get(run, 0.0))  # an empty run must not end the reach
        reach.append(longest)
    lengths = F.lit(np.array(reach[::-1], np.float64))
    last = F.least(F.lit(end), begin + step * F.size(F.filter(lengths, lambda x: x >= F.col("need")))) - 1
    wanted = queries.withColumn("last", last).filter(F.col("last") >= begin)
    wanted = wanted.withColumn("band", F.explode(F.sequence(F.lit(begin), F.col("last")))).drop("last", "need")
    keys = wanted.select("band", "slot").distinct()
    return wanted.join(blocks.drop("longest").join(keys, "band"), ["band", "slot"])


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every vector whose id is divisible by 50."""
    small_batches(spark)
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_inner_products(rows, "vec_id % 50 = 0")


OP3_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""
