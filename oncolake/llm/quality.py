"""Quality classifier: boosted trees over statistics of whole documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oncolake.llm import boosting
from oncolake.llm.shipping import ship_package, small_batches
from oncolake.llm.textbytes import LOWER, pieces, rows_of, span_hashes, utf8, words

#: Rows with labels a model is fitted on at most, picked by a hash of their id.
SAMPLE_ROWS = 20_000
THRESHOLD = 0.3
FOLDS = 5

FEATURES = (
    "log_words word_length long_word spaces upper digits stops commas bangs bars marks other "
    "not_ascii repeated_byte distinct_words commonest_word line_length repeated_lines "
    "closed_lines capital_words shouted_words marked_words"
).split()


def _classes() -> np.ndarray:
    table = np.zeros((256, 10))
    for column, members in enumerate(
        (b" \t", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".", b",;:", b"!?", b"|", b"#$%&*@^~",
         b"<>{}[]()=_+/\\\"'`-")
    ):
        table[list(members), column] = 1
    table[128:, 9] = 1
    return table


_CLASSES = _classes()


def document_statistics(column: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text; null and empty texts give a row of zeros.

    Everything is counted over whole texts, by array operations over a batch.
    """
    data, starts = utf8(column)
    count, size = len(starts) - 1, np.diff(starts)
    out = np.zeros((count, len(FEATURES)))
    if not len(data):
        return out
    row = rows_of(starts)
    counts = np.bincount(row * 256 + data, minlength=count * 256).reshape(count, 256)
    shares = (counts @ _CLASSES) / np.maximum(size, 1)[:, None]
    begins, ends, first = words(data, starts)
    number = np.diff(first)
    many = np.maximum(number, 1)
    out[:, 0] = np.log1p(number)
    owner = rows_of(first)
    length = ends - begins
    out[:, 1] = np.bincount(owner, length, count) / many
    longest = np.zeros(count)
    np.maximum.at(longest, owner, length)
    out[:, 2] = np.log1p(longest)
    out[:, 3:13] = shares
    same = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & (row[2:] == row[:-2])
    out[:, 13] = np.bincount(row[2:], same, count) / np.maximum(size, 1)
    hashes = span_hashes(LOWER[data], begins, ends)
    order = np.lexsort((hashes, owner))
    _repeats(out, owner[order], hashes[order], many, count)
    # Lines: a text without line ends is one line.
    breaks = np.flatnonzero(data == 10)
    line_begin = np.union1d(starts[:-1][size > 0], breaks + 1)
    line_begin = line_begin[line_begin < len(data)]
    line_end = np.append(line_begin[1:], len(data))
    line_row = row[line_begin]
    lines = np.maximum(np.bincount(line_row, minlength=count), 1)
    out[:, 16] = np.log1p(size / lines)
    line_hash = span_hashes(data, line_begin, line_end)
    order = np.lexsort((line_hash, line_row))
    again = (line_hash[order][1:] == line_hash[order][:-1]) & (line_row[order][1:] == line_row[order][:-1])
    out[:, 17] = np.bincount(line_row[order][1:], again, count) / lines
    final = line_end - 1 - (data[line_end - 1] == 10)
    final = np.maximum(final, line_begin)
    out[:, 18] = np.bincount(line_row, np.isin(data[final], list(b".!?\"")), count) / lines
    upper = (data >= 65) & (data < 91)
    ups = np.concatenate([[0], np.cumsum(upper)])
    letters = ups[ends] - ups[begins]
    out[:, 19] = np.bincount(owner, upper[begins], count) / many
    out[:, 20] = np.bincount(owner, letters * 2 > length, count) / many
    out[:, 21] = np.bincount(owner, _CLASSES[data[ends - 1], 5:9].any(axis=1), count) / many
    return out


def _repeats(out, owner, hashes, many, count) -> None:
    """Share of distinct words and of the commonest word, from sorted words."""
    if not len(owner):
        return
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    heads = np.flatnonzero(new)
    runs = np.diff(np.append(heads, len(owner)))
    out[:, 14] = np.bincount(owner[heads], minlength=count) / many
    most = np.zeros(count)
    np.maximum.at(most, owner[heads], runs)
    out[:, 15] = most / many


def held_out(doc_id: str = "doc_id"):
    """Rows that are never learnt from: crc32 of the id as text leaves no rest by five."""
    return F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0


def fit_quality(
    documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS
) -> boosting.Trees:
    """Fit trees on the statistics of at most ``sample_rows`` labelled documents.

    Only the text and the label of rows that are not held out are used. The sample has the ids with
    the smallest hashes, so it is the same in every run, and one text of each, the smallest; its
    size bounds the broadcast and what the driver receives. Labels of null ids, null labels and labels without a document are left out.
    """
    label = labels.select("doc_id", F.col("quality").alias("label"))
    label = label.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    label = label.groupBy("doc_id").agg(F.min("label").alias("label"))
    label = label.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = documents.select("doc_id", "text").join(F.broadcast(label), "doc_id")
    rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("text", "label")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                table = document_statistics(piece.column(0))
                columns = [pa.array(column) for column in table.T]
                yield pa.RecordBatch.from_arrays([piece.column(1), *columns], names=["label", *FEATURES])

    schema = "label int, " + ", ".join(f"{name} double" for name in FEATURES)
    ship_package(documents.sparkSession)
    found = rows.mapInArrow(measure, schema).toArrow()
    target = found.column("label").to_numpy().astype(float)
    table = np.stack([found.column(name).to_numpy() for name in FEATURES], axis=1)
    return boosting.fit(table, target)


def score_quality(documents: DataFrame, model: boosting.Trees, name: str = "score") -> DataFrame:
    """The rows with a column ``name``: the probability of good quality, from the text alone.

    One narrow pass, no shuffle. All other columns pass through; an existing column ``name`` is
    replaced. Null and empty texts get the score of a row of zeros.
    """
    kept = [c for c in documents.columns if c != name]
    rows = documents.select(*kept)
    schema = rows.select("*", F.lit(0.0).alias(name)).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                at = piece.schema.get_field_index("text")
                scores = pa.array(model.predict(document_statistics(piece.column(at))))
                yield pa.RecordBatch.from_arrays([*piece.columns, scores], names=[*kept, name])

    ship_package(documents.sparkSession)
    return rows.mapInArrow(score, schema)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its quality score, learnt from the rows that are not held out."""
    small_batches(spark)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_quality(documents, labels)
    scored = score_quality(documents.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
