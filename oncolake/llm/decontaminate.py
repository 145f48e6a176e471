"""Benchmark decontamination: q-gram lemma in diagonal bands, verified by banded alignment.

A document is contaminated if a region of it lies within an edit budget of a benchmark passage, both
normalised (lower case, runs of other than letters and digits as one space). A passage is a whole
item, or, of an item longer than ``SEGMENT``, each of its overlapping segments.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oncolake.llm.shipping import ship_package, small_batches
from oncolake.llm.textbytes import mix, pieces, utf8

#: Bytes of a q-gram, edits allowed per byte of passage, and the longest passage taken whole.
Q, RATE, SEGMENT = 12, 0.05, 240
#: Benchmark text in one index; a larger benchmark is searched in blocks of about this many bytes.
BLOCK_BYTES = 8 << 20

_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def normalize(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the normalised texts; each begins and ends without a space."""
    data, starts = utf8(pc.utf8_lower(column.cast(pa.large_string())))
    keep = _ALNUM[data]
    gap = np.zeros(len(data), bool)
    gap[1:] = ~keep[1:] & keep[:-1]
    gap[starts[:-1][starts[:-1] < len(data)]] = False  # no space before a first word
    data = np.where(keep, data, np.uint8(0x20))
    bounds = np.concatenate([[0], np.cumsum(keep | gap)])[starts]
    out = data[keep | gap]
    # A gap at the end of a text is no gap.
    ends = bounds[1:][np.diff(bounds) > 0] - 1
    trailing = np.zeros(len(out) + 1, np.int64)
    trailing[ends[out[ends] == 0x20] + 1] = 1
    if not trailing.any():
        return out, bounds
    shift = np.cumsum(trailing)
    return np.delete(out, np.flatnonzero(trailing) - 1), bounds - shift[bounds]


def qgrams(data: np.ndarray) -> np.ndarray:
    """A 64-bit code of the Q bytes from each position."""
    count = len(data) - Q + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    data = np.ascontiguousarray(data)
    head = np.ndarray((count,), "<u8", data, 0, (1,))
    tail = np.ndarray((count,), "<u4", data, 8, (1,))
    return mix(head ^ (tail.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


class PassageIndex:
    """Q-grams of passages, sorted, with a bitmap that turns most text positions away."""

    def __init__(self, items: list[tuple[int, str]], rate: float = RATE, segment: int = SEGMENT):
        data, starts = normalize(pa.array([text for _, text in items], pa.large_string()))
        self.passages, self.items, self.budget, codes, owner, place = [], [], [], [], [], []
        for (item, _), begin, end in zip(items, starts[:-1], starts[1:]):
            size = int(end - begin)
            steps = [0]
            if size > segment:
                count = math.ceil((size - segment) / (segment // 2)) + 1
                steps = np.linspace(0, size - segment, count).astype(int).tolist()
            for step in steps:
                passage = data[begin + step : min(begin + step + segment, end)]
                if len(passage) < Q:
                    continue  # shorter than a q-gram: no evidence
                # The lemma needs at least one common q-gram: len + 1 - q * (budget + 1) >= 1.
                budget = min(int(rate * len(passage)), len(passage) // Q - 1)
                grams = qgrams(passage)
                owner.append(np.full(len(grams), len(self.passages)))
                place.append(np.arange(len(grams)))
                codes.append(grams)
                self.passages.append(passage)
                self.items.append(item)
                self.budget.append(budget)
        code = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        order = np.argsort(code, kind="stable")
        self.code = code[order]
        self.owner = np.concatenate(owner)[order] if codes else np.zeros(0, np.int64)
        self.place = np.concatenate(place)[order] if codes else np.zeros(0, np.int64)
        self.sizes = np.array([len(p) for p in self.passages], np.int64)
        self.limit = np.array(self.budget, np.int64)
        self.need = self.sizes + 1 - Q * (self.limit + 1)
        self.bits = max(16, int(np.ceil(np.log2(len(code) * 16 + 1))))
        self.bitmap = np.zeros(1 << self.bits, bool)
        self.bitmap[(self.code >> np.uint64(64 - self.bits)).astype(np.int64)] = True

    def search(self, column: pa.Array) -> list[list[tuple[int, int, int, int]]]:
        """For each text the verified (item, begin, end, edits), positions in normalised bytes."""
        found: list[list[tuple[int, int, int, int]]] = [[] for _ in range(len(column))]
        data, starts = normalize(column)
        code = qgrams(data)
        at = np.flatnonzero(self.bitmap[(code >> np.uint64(64 - self.bits)).astype(np.int64)])
        if not len(at) or not len(self.code):
            return found
        low = np.searchsorted(self.code, code[at], "left")
        many = np.searchsorted(self.code, code[at], "right") - low
        at, low, many = at[many > 0], low[many > 0], many[many > 0]
        text = np.searchsorted(starts, at, "right") - 1
        whole = at + Q <= starts[text + 1]
        at, low, many, text = at[whole], low[whole], many[whole], text[whole]
        entry = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
        passage, place = self.owner[entry], self.place[entry]
        at, text = np.repeat(at, many), np.repeat(text, many)
        # Diagonals relative to the text, shifted so that none is negative.
        diagonal = at - starts[text] - place + self.sizes[passage]
        width = self.limit[passage] + 1
        # Band c covers diagonals c*width .. c*width + 2*width - 1, so a run of budget + 1
        # diagonals lies within a band; every hit counts for two bands.
        band = diagonal // width
        keys = np.concatenate([np.stack([text, passage, band]), np.stack([text, passage, band - 1])], axis=1)
        order = np.lexsort(keys[::-1])
        keys = keys[:, order]
        new = np.ones(keys.shape[1], bool)
        new[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
        heads = np.flatnonzero(new)
        hits = np.diff(np.append(heads, keys.shape[1]))
        enough = hits >= self.need[keys[1, heads]]
        done: set[tuple[int, int, int]] = set()
        for t, p, c in keys[:, heads[enough]].T.tolist():
            if (t, p, c - 1) in done:
                continue  # the overlapping band before this one was verified already
            begin, wide = int(starts[t]), int(self.limit[p]) + 1
            first = c * wide - int(self.sizes[p])
            result = align(self.passages[p], data[begin : int(starts[t + 1])], first, 2 * wide,
                           int(self.limit[p]))
            if result is not None:
                done.add((t, p, c))
                found[t].append((self.items[p], *result))
        return found


def align(passage: np.ndarray, text: np.ndarray, first: int, width: int, budget: int):
    """(begin, end, edits) of the best alignment of the whole passage in a band, if within budget.

    The band holds the diagonals (text position minus passage position) from ``first`` on, widened
    by the budget on both sides. Text before and behind the region is free. An exact copy on a
    diagonal is the alignment without edits; else the edit table is filled row by row.
    """
    size = len(passage)
    for diagonal in range(max(first, 0), min(first + width, len(text) - size + 1)):
        if text[diagonal] == passage[0] and np.array_equal(text[diagonal : diagonal + size], passage):
            return diagonal, diagonal + size, 0
    if budget <= 0:
        return None
    first, width = first - budget, width + 2 * budget
    padded = np.zeros(size + width, np.uint8)
    low, high = max(first, 0), min(first + size + width, len(text))
    if high > low:
        padded[low - first : high - first] = text[low:high]
    inside = np.arange(first, first + size + width)
    inside = (inside >= 0) & (inside < len(text))
    far = np.int64(size + width + 9)
    steps = np.arange(width, dtype=np.int64)
    # Column w of row i stands for text position first + i + w; all starts are free in row 0.
    cost = np.where((first + steps >= 0) & (first + steps <= len(text)), 0, far)
    start = first + steps
    for row in range(size):
        differs = (padded[row : row + width] != passage[row]) | ~inside[row : row + width]
        change = cost + differs + np.where(inside[row : row + width], 0, far)
        drop = np.append(cost[1:], far) + 1  # a passage byte without text
        best = np.minimum(change, drop)
        came = np.where(change <= drop, start, np.append(start[1:], 0))
        # Text bytes without passage: cost[w] = min over v <= w of best[v] + (w - v).
        slack = best - steps
        run = np.minimum.accumulate(slack)
        pick = np.maximum.accumulate(np.where(slack == run, steps, 0))
        cost, start = run + steps, came[pick]
        if cost.min() > budget:
            return None
    end = int(cost.argmin())
    if cost[end] > budget:
        return None
    return int(start[end]), int(min(first + size + end, len(text))), int(cost[end])


def find_leaks(
    documents: DataFrame, benchmark: DataFrame, rate: float = RATE, segment: int = SEGMENT,
    name: str = "leaks", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows with ``name``: array of (item_id, begin, end, edits) of all benchmark regions.

    Narrow passes without a shuffle. The index of passages goes to every task; its size is checked
    first, and a benchmark above ``block_bytes`` is searched block after block, each in a pass of
    its own over the same rows. Null and empty texts have no regions; items that are null or shorter
    than a q-gram after normalising match nothing; repeated items are reported under each id.
    """
    ship_package(documents.sparkSession)
    items = benchmark.select(F.col("item_id"), F.col("text").alias("item")).filter("item is not null")
    total = items.agg(F.sum(F.octet_length("item"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    kept = [c for c in documents.columns if c != name]
    leak = "struct<item_id:bigint,begin:bigint,end:bigint,edits:bigint>"
    rows = documents.select(*kept, F.array().cast(f"array<{leak}>").alias(name))
    for block in range(blocks):
        mine = F.pmod(F.xxhash64("item_id", "item"), F.lit(blocks)) == block
        index = PassageIndex(sorted(map(tuple, items.filter(mine).distinct().collect()),
                                    key=lambda x: (x[0] is None, x[0] or 0, x[1])), rate, segment)
        rows = rows.mapInArrow(_searcher(index, kept, name), rows.schema)
    return rows


def _searcher(index: PassageIndex, kept: list[str], name: str):
    kind = pa.list_(pa.struct([(f, pa.int64()) for f in ("item_id", "begin", "end", "edits")]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                before = piece.column(len(kept)).to_pylist()
                found = index.search(piece.column(piece.schema.get_field_index("text")))
                fields = ("item_id", "begin", "end", "edits")
                leaks = [old + [dict(zip(fields, x)) for x in sorted(set(new), key=str)]
                         for old, new in zip(before, found)]
                columns = [*piece.columns[:-1], pa.array(leaks, kind)]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, name])

    return search


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items found in it and the number of regions."""
    small_batches(spark)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_leaks(documents, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id",
        (F.size("leaks") > 0).alias("contaminated"),
        F.size("leaks").cast("long").alias("n_regions"),
        F.array_sort(F.array_distinct(F.transform("leaks", lambda x: x["item_id"]))).alias("item_ids"),
    )
