"""Removal of passages that an earlier document has: a distributed merge sort of sampled suffixes.

Of each window of ``length`` bytes the suffix that starts at its least q-gram (by hash) is its anchor,
so equal windows have equal anchors and about every twentieth suffix is enough to find all matches.

1. Documents are packed into runs of bounded size, written once.
2. Runs exchange their sorted anchor keys as differences; what comes back is a bit per key, set where
   another document has the key too.
3. Runs exchange the suffixes of such anchors: sorted, front-coded (the part shared with the suffix
   before is left out), with the bytes in front of the anchor. A loser tree merges the runs of a
   bucket; it knows how much of each head agrees with the last suffix and compares only what follows.
4. Neighbours in suffix order show which windows an earlier document has. Their places go back to the
   runs, where the covered bytes are cut out.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oncolake.llm.shipping import ship_package, small_batches
from oncolake.llm.textbytes import mix, release_memory, span_hashes, utf8
from oncolake.operators.staging import stage_table

#: Bytes of an anchor's q-gram, text bytes in a run, and text bytes that a bucket stands for. The last
#: two set memory per task and numbers of rows; no result depends on them.
Q, RUN_BYTES, BUCKET_BYTES = 16, 8 << 20, 4 << 20
KEY_BITS = 40
_OTHER = np.random.default_rng(11).permutation(256).astype(np.uint8)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value, bytes of equal rank side by side."""
    parts = [struct.pack("<I", len(arrays))]
    for array in arrays:
        array = np.ascontiguousarray(array)
        planes = array.view(np.uint8).reshape(-1, array.itemsize).T.tobytes()
        parts += [array.dtype.str.encode().ljust(4), struct.pack("<Q", len(array)), planes]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def unpack(value: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(value)
    at, out = 4, []
    for _ in range(struct.unpack_from("<I", data)[0]):
        dtype = np.dtype(data[at : at + 4].decode().strip())
        size = struct.unpack_from("<Q", data, at + 4)[0]
        at += 12
        planes = np.frombuffer(data, np.uint8, size * dtype.itemsize, at).reshape(dtype.itemsize, size)
        out.append(np.ascontiguousarray(planes.T).view(dtype).reshape(size))
        at += size * dtype.itemsize
    return out


def anchors(data: np.ndarray, starts: np.ndarray, length: int):
    """(key, anchor, first window, last window, row) of each run of windows with one anchor.

    The least of the q-grams of a window by 32 hash bits, the leftmost of equal ones, so that the
    choice depends on the window's bytes alone. Windows do not cross rows.
    """
    empty = (np.uint64, np.int64, np.int64, np.int64, np.int64)
    found = [tuple(np.zeros(0, kind) for kind in empty)]
    data = np.ascontiguousarray(data)
    step, width = 1 << 18, length - Q + 1
    for begin in range(0, len(data) - length + 1, step):
        # A part of all windows at a time; one anchor may come up in two parts, for windows of each.
        end = min(begin + step, len(data) - length + 1)
        count = end - begin + width - 1
        head = np.ndarray((count,), "<u8", data, begin, (1,))
        tail = np.ndarray((count,), "<u8", data, begin + Q - 8, (1,))
        code = mix(head ^ (tail * np.uint64(0x9E3779B97F4A7C15)))
        least = (code & np.uint64(0xFFFFFFFF00000000)) | np.arange(count, dtype=np.uint64)
        done = 1
        while done * 2 <= width:
            least = np.minimum(least[:-done], least[done:])
            done *= 2
        if done < width:
            least = np.minimum(least[: len(least) - (width - done)], least[width - done :])
        at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        window = np.arange(begin, end)
        row = np.searchsorted(starts, window, "right") - 1
        inside = window + length <= starts[row + 1]
        window, at, row = window[inside], at[inside], row[inside]
        if not len(at):
            continue
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        found.append((code[at[first]], at[first] + begin, window[first], window[last], row[first]))
    return tuple(np.concatenate(column) for column in zip(*found))


def _keys(code: np.ndarray) -> np.ndarray:
    """Keys of anchors, scrambled once more: anchors are least hashes and would crowd the low ranges."""
    return mix(code ^ np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(64 - KEY_BITS)


def _bucket_bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted keys: buckets are equal ranges of keys."""
    edges = [(b << KEY_BITS) // buckets for b in range(buckets + 1)]
    return np.searchsorted(keys, np.array(edges, np.uint64))


class LoserTree:
    """Merges sorted runs; each element comes with the length it shares with the one before it.

    Every leaf holds the head of a run and how many bytes it shares with the last winner. Of two
    heads that share different lengths the one that shares more is less; only heads that share the
    same length are compared, and what they share becomes known for the loser.
    """

    def __init__(self, runs: list[tuple[list[int], list[int]]], size: int):
        self.runs, self.bits = runs, size * 8
        self.width = 1
        while self.width < max(1, len(runs)):
            self.width *= 2
        self.at = [0] * len(runs)
        self.head: list[int | None] = [keys[0] if keys else None for keys, _ in runs]
        self.head += [None] * (self.width - len(runs))
        self.shared = [0] * self.width
        self.loser = [0] * self.width
        self.winner = self._build(1)

    def _build(self, node: int) -> int:
        if node >= self.width:
            return node - self.width
        return self._play(node, self._build(2 * node), self._build(2 * node + 1))

    def _play(self, node: int, one: int, two: int) -> int:
        """The winner of two leaves; the loser stays at the node."""
        head, shared = self.head, self.shared
        a, b = head[one], head[two]
        if a is None or b is None:
            wins = a is not None
        elif shared[one] != shared[two]:
            wins = shared[one] > shared[two]
        else:
            wins = a <= b
            both = (self.bits - (a ^ b).bit_length()) >> 3
            shared[two if wins else one] = both
        self.loser[node] = two if wins else one
        return one if wins else two

    def merge(self) -> Iterator[tuple[int, int, int]]:
        """(run, index in the run, bytes shared with the element before), in order."""
        head, shared, at, loser = self.head, self.shared, self.at, self.loser
        while head[self.winner] is not None:
            leaf = self.winner
            yield leaf, at[leaf], shared[leaf]
            at[leaf] += 1
            keys, common = self.runs[leaf]
            if at[leaf] < len(keys):
                head[leaf], shared[leaf] = keys[at[leaf]], common[at[leaf]]
            else:
                head[leaf], shared[leaf] = None, 0
            node = (leaf + self.width) >> 1
            while node:
                leaf = self._play(node, leaf, loser[node])
                node >>= 1
            self.winner = leaf


def _shared_with_before(table: np.ndarray) -> np.ndarray:
    """How many leading bytes each row of a table shares with the row before."""
    out = np.zeros(len(table), np.uint8)
    if len(table) > 1:
        differs = table[1:] != table[:-1]
        out[1:] = np.where(differs.any(axis=1), differs.argmax(axis=1), table.shape[1])
    return out


def _slices(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray, width: int, step: int = 1) -> np.ndarray:
    """Rows of bytes from ``begins`` on, forwards or backwards, filled up with zeros."""
    at = begins[:, None] + step * np.arange(width)
    out = data[np.clip(at, 0, max(len(data) - 1, 0))] if len(data) else np.zeros(at.shape, np.uint8)
    out[np.arange(width) >= sizes[:, None]] = 0
    return out


def _sorted_suffixes(data, places, length):
    """The order of suffixes at ``places[0]`` by their bytes, and their rows."""
    anchor, first, last = places
    sizes = last + length - anchor
    rows = _slices(data, anchor, sizes, length)
    padded = np.zeros((len(rows), -(-length // 8) * 8), np.uint8)
    padded[:, :length] = rows
    words = padded.reshape(len(rows), padded.shape[1] // 8, 8).view(">u8")[:, :, 0]
    order = np.lexsort(words.T[::-1])
    return order, rows[order]


def _encode_run(data, places, ids, length) -> bytes:
    order, rows = _sorted_suffixes(data, places, length)
    anchor, first, last = (p[order] for p in places)
    shared = _shared_with_before(rows)
    sizes = last + length - anchor
    shared = np.minimum(shared, sizes).astype(np.uint8)
    left = _slices(data, anchor - 1, anchor - first, length, -1)
    columns = np.arange(length)
    rest = rows[(columns >= shared[:, None]) & (columns < sizes[:, None])]
    before = left[columns < (anchor - first)[:, None]]
    return pack(shared, sizes.astype(np.uint8), (anchor - first).astype(np.uint8), rest, before, ids[order], anchor)


def _decode_run(value: bytes, length: int):
    """(rows, sizes, left rows, left sizes, ids, anchors) of a front-coded run."""
    shared, sizes, lefts, rest, before, ids, anchor = unpack(value)
    columns = np.arange(length)
    rows = np.zeros((len(shared), length), np.uint8)
    rows[(columns >= shared[:, None]) & (columns < sizes[:, None])] = rest
    # A byte that was left out is that of the last row that has it written.
    number = np.arange(len(shared))
    for column in range(int(shared.max(initial=0))):
        source = np.maximum.accumulate(np.where(shared <= column, number, 0))
        rows[:, column] = np.where(column < sizes, rows[source, column], 0)
    left = np.zeros((len(shared), length), np.uint8)
    left[columns < lefts[:, None]] = before
    return rows, sizes.astype(np.int64), left, lefts.astype(np.int64), ids, anchor


def repeated_windows(runs: list, length: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each decoded run the (begin, end) of byte ranges that a smaller id has too.

    Suffixes of all runs come from the loser tree in order. Equal ones with equal bytes in front are
    one variant; the windows of each variant are compared once.
    """
    size = len(runs)
    keyed = []
    for rows, *_ in runs:
        raw = rows.tobytes()
        keys = [int.from_bytes(raw[i : i + length], "big") for i in range(0, len(raw), length)]
        keyed.append((keys, _shared_with_before(rows).tolist()))
    merged = np.array(list(LoserTree(keyed, length).merge()), np.int64).reshape(-1, 3)
    del keyed
    offsets = np.cumsum([0] + [len(r[0]) for r in runs])
    order = offsets[merged[:, 0]] + merged[:, 1]
    rows, sizes, left, lefts, ids, anchor = (np.concatenate(x)[order] for x in zip(*runs))
    # Within equal suffixes the bytes in front tell variants apart.
    equal = (merged[:, 2] == length)
    block = np.cumsum(~equal)
    code = span_hashes(left.ravel(), np.arange(len(left)) * length, (np.arange(len(left)) + 1) * length)
    code = mix(code ^ (lefts * 256 + sizes).astype(np.uint64))
    place = np.lexsort((code, block))
    new = np.ones(len(place), bool)
    new[1:] = (block[place][1:] != block[place][:-1]) | (code[place][1:] != code[place][:-1])
    variant = np.empty(len(place), np.int64)
    variant[place] = np.cumsum(new) - 1
    example = place[new]
    least = np.full(len(example), np.iinfo(np.int64).max)
    np.minimum.at(least, variant, ids)
    # All windows of all variants: the bytes in front, turned round, and the suffix.
    wide = np.concatenate([left[example][:, ::-1], rows[example]], axis=1)
    low = length - sizes[example]  # the last window begins so far before the anchor
    count = lefts[example] - low + 1
    owner = np.repeat(np.arange(len(example)), count)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    begin = owner * (2 * length) + length - lefts[example][owner] + inner
    flat = wide.ravel()
    one, two = span_hashes(flat, begin, begin + length), span_hashes(_OTHER[flat], begin, begin + length)
    sort = np.lexsort((two, one))
    same = np.zeros(len(sort), bool)
    same[1:] = (one[sort][1:] == one[sort][:-1]) & (two[sort][1:] == two[sort][:-1])
    window = np.empty(len(sort), np.int64)
    window[sort] = np.cumsum(~same) - 1
    earliest = np.full(int(window.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(earliest, window, least[owner])
    known = earliest[window]  # by variant and window: the smallest id that has it
    heads = np.cumsum(count) - count
    out = []
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    for r in range(size):
        mine = back[offsets[r] : offsets[r + 1]]
        v, doc, at = variant[mine], ids[mine], anchor[mine]
        entry = np.repeat(np.arange(len(mine)), count[v])
        inside = np.arange(len(entry)) - np.repeat(np.cumsum(count[v]) - count[v], count[v])
        hit = known[heads[v][entry] + inside] < doc[entry]
        edge = np.ones(len(hit), bool)
        edge[1:] = (entry[1:] != entry[:-1]) | ~hit[:-1]
        start = np.flatnonzero(hit & edge)
        stop = np.ones(len(hit), bool)
        stop[:-1] = (entry[1:] != entry[:-1]) | ~hit[1:]
        end = np.flatnonzero(hit & stop)
        base = at - lefts[mine]
        out.append((base[entry[start]] + inside[start], base[entry[end]] + inside[end] + length))
    return out


def _packs(documents: DataFrame, run_bytes: int) -> DataFrame:
    """Documents with an id as runs: (run, ids, ends, text), each about ``run_bytes`` of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, sizes, texts, held = TaskContext.get().partitionId() << 32, [], [], [], 0

        def row() -> pa.RecordBatch:
            values = [number, pack(np.concatenate(ids), np.cumsum(np.concatenate(sizes))), _squeezed(texts)]
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=["run", "rows", "text"])

        for batch in batches:
            data, starts = utf8(batch.column(1))
            own = batch.column(0).to_numpy()
            begin = 0
            while begin < len(own):
                end = int(np.searchsorted(starts, starts[begin] + max(run_bytes - held, 1), "right")) - 1
                end = min(max(end, begin + 1), len(own))
                ids.append(own[begin:end])
                sizes.append(np.diff(starts[begin : end + 1]))
                texts.append(data[starts[begin] : starts[end]].tobytes())
                held += len(texts[-1])
                begin = end
                if held >= run_bytes:
                    yield row()
                    number, ids, sizes, texts, held = number + 1, [], [], [], 0
        if ids:
            yield row()
        release_memory()

    return documents.mapInArrow(run, "run long, rows binary, text binary")


def _squeezed(texts: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b"".join(texts))


def _opened(rows: bytes, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, data, starts) of a run."""
    ids, ends = unpack(rows)
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(text), np.uint8)
    return ids, data, np.concatenate([[0], ends])


def cut_repeated(
    documents: DataFrame, length: int = 50, run_bytes: int = RUN_BYTES, bucket_bytes: int = BUCKET_BYTES,
    with_text: bool = True,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, with ``with_text``, kept (binary).

    Whole texts as UTF-8 bytes; null and empty texts have no bytes. A byte goes if some string of
    ``length`` bytes over it also starts in a document with a smaller doc_id, judged on the input.
    Rows of a repeated doc_id are one document for that question and are returned each; rows of a
    null doc_id are neither smaller nor greater than others and keep all bytes. Other columns are
    not read. ``length`` is from 2 * Q to 255.
    """
    if not 2 * Q <= length <= 255:
        raise ValueError("length has to be from 32 to 255")
    spark = documents.sparkSession
    ship_package(spark)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    packs = stage_table(_packs(rows.filter("doc_id is not null"), run_bytes), "packs")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))

    def send_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run, *packed in zip(*(c.to_pylist() for c in batch.columns)):
                ids, data, starts = _opened(*packed)
                code, _, _, _, row = anchors(data, starts, length)
                keys, several = _several(_keys(code), ids[row])
                bounds = _bucket_bounds(keys, buckets)
                full = np.flatnonzero(np.diff(bounds))
                values = [pack(np.diff(keys[a:b], prepend=np.uint64(0)), several[a:b])
                          for a, b in zip(bounds[full], bounds[full + 1])]
                yield _rows(full, run, values)
            release_memory()

    sent = packs.mapInArrow(send_keys, "bucket int, run long, value binary")
    flags = sent.groupBy("bucket").applyInArrow(_mark_shared, "bucket int, run long, value binary")
    flags = flags.groupBy("run").agg(F.sort_array(F.collect_list(F.struct("bucket", "value"))).alias("flags"))

    def send_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run, packed_rows, text, marks in zip(*(c.to_pylist() for c in batch.columns)):
                ids, data, starts = _opened(packed_rows, text)
                code, anchor, first, last, row = anchors(data, starts, length)
                key = _keys(code)
                known = np.unique(key)
                bits = np.zeros(len(known), bool)
                bounds = _bucket_bounds(known, buckets)
                for mark in marks:
                    a, b = bounds[mark["bucket"]], bounds[mark["bucket"] + 1]
                    bits[a:b] = unpack(mark["value"])[0]
                want = bits[np.searchsorted(known, key)]
                order = np.flatnonzero(want)[np.argsort(key[want], kind="stable")]
                bounds = _bucket_bounds(key[order], buckets)
                full = np.flatnonzero(np.diff(bounds))
                values = []
                for a, b in zip(bounds[full], bounds[full + 1]):
                    some = order[a:b]
                    places = anchor[some], first[some], last[some]
                    values.append(_encode_run(data, places, ids[row[some]], length))
                yield _rows(full, run, values)
            release_memory()

    def merge_bucket(table: pa.Table) -> pa.Table:
        runs = [_decode_run(value, length) for value in table.column("value").to_pylist()]
        found = repeated_windows(runs, length)
        names = table.column("run").to_pylist()
        kept = [(n, pack(*f)) for n, f in zip(names, found) if len(f[0])]
        release_memory()
        return pa.table(
            {"run": pa.array([n for n, _ in kept], pa.int64()), "value": pa.array([v for _, v in kept], pa.binary())}
        )

    marked = packs.join(flags, "run").select("run", "rows", "text", "flags")
    suffixes = marked.mapInArrow(send_suffixes, "bucket int, run long, value binary")
    ranges = suffixes.groupBy("bucket").applyInArrow(merge_bucket, "run long, value binary")
    ranges = ranges.groupBy("run").agg(F.collect_list("value").alias("ranges"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed_rows, text, values in zip(*(c.to_pylist() for c in batch.columns)):
                yield _cut_run(*_opened(packed_rows, text), values or [], with_text)
            release_memory()

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += ", kept binary" * with_text
    done = packs.join(ranges, "run", "left").select("rows", "text", "ranges").mapInArrow(cut, schema)
    raw = F.coalesce("text", F.lit("")).cast("binary")
    zero = F.lit(0).cast("long")
    alone = rows.filter("doc_id is null").select(
        "doc_id", F.octet_length(raw).cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"),
        F.sha2(raw, 256).alias("kept_sha256"), *[raw.alias("kept")] * with_text,
    )
    return done.unionAll(alone)


def _rows(buckets, run: int, values: list[bytes]) -> pa.RecordBatch:
    columns = [pa.array(np.asarray(buckets), pa.int32()), pa.array([run] * len(values), pa.int64()),
               pa.array(values, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "run", "value"])


def _several(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and whether documents of several ids have each."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(keys)) - 1 if len(keys) else heads
    return keys[heads], ids[heads] != ids[tails]


def _mark_shared(table: pa.Table) -> pa.Table:
    """For each run of a bucket a bit per key: several documents of all runs have it."""
    runs = [unpack(value) for value in table.column("value").to_pylist()]
    keys = [np.cumsum(step, dtype=np.uint64) for step, _ in runs]
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")  # sorted runs one after the other: a merge
    ranked = every[order]
    again = np.zeros(len(ranked), bool)
    again[1:] = ranked[1:] == ranked[:-1]
    again[:-1] |= again[1:]
    shared = np.empty(len(every), bool)
    shared[order] = again
    ends = np.cumsum([len(k) for k in keys])
    values = [pack(bits | several) for bits, (_, several) in zip(np.split(shared, ends[:-1]), runs)]
    return table.set_column(table.schema.get_field_index("value"), "value", pa.array(values, pa.binary())).select(
        ["bucket", "run", "value"]
    )


def _cut_run(ids, data, starts, values: list[bytes], with_text: bool) -> pa.RecordBatch:
    """The documents of a run without the bytes of the ranges."""
    change = np.zeros(len(data) + 1, np.int32)
    for value in values:
        begin, end = unpack(value)
        np.add.at(change, begin, 1)
        np.add.at(change, end, -1)
    gone = np.cumsum(change[:-1]) > 0
    sums = np.concatenate([[0], np.cumsum(gone)])
    opens = gone.copy()
    opens[1:] &= ~gone[:-1]
    inner = starts[:-1][starts[:-1] < len(data)]
    opens[inner] = gone[inner]
    spans = np.concatenate([[0], np.cumsum(opens)])
    kept = data[~gone].tobytes()
    left = starts - sums[starts]
    texts = [kept[a:b] for a, b in zip(left[:-1].tolist(), left[1:].tolist())]
    columns = [
        pa.array(ids, pa.int64()), pa.array(np.diff(starts), pa.int64()), pa.array(np.diff(sums[starts]), pa.int64()),
        pa.array(np.diff(spans[starts]), pa.int64()), pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
    ]
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    if with_text:
        columns.append(pa.array(texts, pa.binary()))
        names.append("kept")
    return pa.RecordBatch.from_arrays(columns, names=names)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 50-byte strings that an earlier document has."""
    small_batches(spark)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return cut_repeated(documents, with_text=False)
