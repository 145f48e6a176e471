"""Byte-level BPE: encoding by ranks with a hierarchical-bitmap queue, and decoding."""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import itertools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oncolake.llm.shipping import ship_package, small_batches
from oncolake.llm.textbytes import pieces

#: Pre-tokens kept in a worker's memory, and the longest one kept. They bound memory only: what is
#: not kept is encoded again.
CACHE_WORDS, CACHE_LENGTH = 900_000, 40
#: Bytes of a pre-token up to which a bucket is one bit mask of positions instead of a heap.
SHORT = 64
#: Pre-tokens of one text handled at a time.
CHUNK = 1 << 16


class RankQueue:
    """Positions by merge rank; the smallest rank is found by two find-first-set steps.

    Each rank has a bucket of positions. A bit per rank says that its bucket is in use, a bit per
    group of ranks that the group has such a bit. Groups have about the square root of all ranks.
    """

    def __init__(self, ranks: int):
        self.width = max(1, int(np.ceil(np.sqrt(max(ranks, 1)))))
        self.groups = [0] * (ranks // self.width + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            heapq.heappush(bucket, position)
            return
        self.buckets[rank] = [position]
        group, bit = divmod(rank, self.width)
        self.groups[group] |= 1 << bit
        self.top |= 1 << group

    def pop(self) -> tuple[int, int] | None:
        """The smallest rank and its leftmost position."""
        if not self.top:
            return None
        group = (self.top & -self.top).bit_length() - 1
        bits = self.groups[group]
        bit = (bits & -bits).bit_length() - 1
        rank = group * self.width + bit
        bucket = self.buckets[rank]
        position = heapq.heappop(bucket)
        if not bucket:
            del self.buckets[rank]
            self.groups[group] = bits & (bits - 1)
            if not self.groups[group]:
                self.top &= self.top - 1
        return rank, position


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordCache(dict):
    """What is known of words; computed where missing, and kept for words of bounded length."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute

    def __missing__(self, word: str):
        value = self.compute(word)
        if len(word) <= CACHE_LENGTH:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = value
        return value


class ByteBpe:
    """Encoder and decoder of one rank file; every match of the pattern is encoded separately."""

    def __init__(self, rank_file: bytes, pattern: str):
        lines = (line.split() for line in rank_file.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.queue = RankQueue(max(self.ranks.values(), default=0) + 1)
        self.cache = WordCache(lambda word: _packed(self.merge(word.encode("utf-8"))))

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token.

        Parts are a linked list over byte positions. The queue gives the pair of the smallest rank,
        the leftmost first; an entry is stale if the pair at its position has another rank by now.
        """
        whole = self.ranks.get(word)
        if whole is not None:
            return [whole]
        return self._merge_short(word) if len(word) <= SHORT else self._merge_long(word)

    def _merge_short(self, word: bytes) -> list[int]:
        """The same with the queue in local names: buckets and groups are bit masks."""
        known, size = self.ranks.get, len(word)
        after, before = list(range(1, size + 1)), list(range(-1, size))
        pair = [-1] * size
        top, groups, buckets = 0, {}, {}
        for at in range(size - 1):
            rank = known(word[at : at + 2])
            if rank is not None:
                pair[at] = rank
                if rank in buckets:
                    buckets[rank] |= 1 << at
                else:
                    buckets[rank] = 1 << at
                    group = rank >> 8
                    groups[group] = groups.get(group, 0) | 1 << (rank & 255)
                    top |= 1 << group
        while top:
            low = top & -top
            group = low.bit_length() - 1
            bits = groups[group]
            first = bits & -bits
            rank = (group << 8) + first.bit_length() - 1
            places = buckets[rank]
            place = places & -places
            if places == place:
                del buckets[rank]
                groups[group] = bits ^ first
                if bits == first:
                    top ^= low
            else:
                buckets[rank] = places ^ place
            at = place.bit_length() - 1
            if pair[at] != rank:
                continue
            middle = after[at]
            end = after[middle]
            after[at], pair[middle] = end, -1
            if end < size:
                before[end] = at
                rank = known(word[at : after[end]])
            else:
                rank = None
            left = before[at]
            found = ((at, rank),) if left < 0 else ((at, rank), (left, known(word[left:end])))
            for place, rank in found:
                if rank is None:
                    pair[place] = -1
                    continue
                pair[place] = rank
                if rank in buckets:
                    buckets[rank] |= 1 << place
                else:
                    buckets[rank] = 1 << place
                    group = rank >> 8
                    groups[group] = groups.get(group, 0) | 1 << (rank & 255)
                    top |= 1 << group
        return self._ids(word, after)

    def _merge_long(self, word: bytes) -> list[int]:
        ranks, queue, size = self.ranks, self.queue, len(word)
        after = list(range(1, size + 1)) + [size]
        before = list(range(-1, size))
        pair = [-1] * (size + 1)
        for position in range(size - 1):
            rank = ranks.get(word[position : position + 2])
            if rank is not None:
                pair[position] = rank
                queue.push(rank, position)
        while (entry := queue.pop()) is not None:
            rank, position = entry
            if pair[position] != rank:
                continue
            middle = after[position]
            end = after[middle]
            after[position], before[end] = end, position
            pair[middle] = -1
            for left in (before[position], position):
                if left < 0:
                    continue
                right = after[left]
                new = ranks.get(word[left : after[right]]) if right < size else None
                pair[left] = -1 if new is None else new
                if new is not None:
                    queue.push(new, left)
        return self._ids(word, after)

    def _ids(self, word: bytes, after: list[int]) -> list[int]:
        ids, position, size = [], 0, len(word)
        while position < size:
            ids.append(self.ranks[word[position : after[position]]])
            position = after[position]
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if len(text) <= CHUNK:
            return b"".join(map(self.cache.__getitem__, self.pattern.findall(text)))
        matches = (match.group() for match in self.pattern.finditer(text))
        parts = iter(lambda: list(itertools.islice(matches, CHUNK)), [])
        return b"".join(b"".join(map(self.cache.__getitem__, part)) for part in parts)

    def decode(self, ids: bytes) -> bytes:
        """The bytes that packed ids stand for."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.lru_cache(maxsize=2)
def tokenizer(rank_file: bytes, pattern: str) -> ByteBpe:
    """One tokenizer per worker process, with its cache."""
    return ByteBpe(rank_file, pattern)


def encode_documents(
    documents: DataFrame, rank_file: bytes, pattern: str, text: str = "text", with_ids: bool = True
) -> DataFrame:
    """Encode and decode every whole text; one narrow pass without a shuffle.

    Adds ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, with ``with_ids``, ``ids`` (packed
    little-endian unsigned 32-bit integers). Other columns pass through; existing columns of these
    names are replaced. Null and empty texts have no tokens. The rank file has a fixed size, and
    goes to the workers with the function.
    """
    added = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
    kept = [c for c in documents.columns if c == text or c not in added]
    rows = documents.select(*kept)
    schema = rows.select(
        "*", F.lit(0).cast("long").alias("n_tokens"), F.lit("").alias("ids_sha256"),
        F.lit("").alias("decoded_sha256"), *[F.lit(b"").alias("ids")] * with_ids,
    ).schema
    ship_package(documents.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(rank_file, pattern)
        for batch in batches:
            for piece in pieces(batch, text, 8 << 20):
                out = ([], [], [], [])
                for value in piece.column(piece.schema.get_field_index(text)):
                    ids = bpe.encode(value.as_py() or "")
                    out[0].append(len(ids) // 4)
                    out[1].append(hashlib.sha256(ids).hexdigest())
                    out[2].append(hashlib.sha256(bpe.decode(ids)).hexdigest())
                    if with_ids:
                        out[3].append(ids)
                columns = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()),
                           pa.array(out[2], pa.string()), pa.array(out[3], pa.binary())]
                columns = [*piece.columns, *columns[: len(added)]]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *added])

    return rows.mapInArrow(encode, schema)


def multi_50k() -> tuple[bytes, str]:
    """Rank file and pattern of the public tokenizer for many languages."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        return file.read(), public_tokenizers.PATTERN


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of tokens and digests of its ids and of the decoded bytes."""
    small_batches(spark)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode_documents(documents, *multi_50k(), with_ids=False).drop("text")
