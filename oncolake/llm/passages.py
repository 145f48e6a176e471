"""Repeated passages: confirmed by counts, compiled into sharded Aho-Corasick automata, found by streaming.

A window is ``WINDOW`` consecutive words. Its anchor is the run of ``GRAM`` words in it with the
least hash, so equal windows have equal anchors wherever they stand; consecutive windows of one
anchor make a stretch. Stretches whose anchor recurs are counted as wholes. Of a stretch that is seen
once, but whose anchor is not, the single windows are counted. Both ways confirm passages: word
sequences of which every window recurs.

Documents lie in packs of bounded size. A pack's automata get each confirmed passage that stands in
the pack once, wherever and however often it stands there; a run of the texts through the automata
finds every occurrence, and what an occurrence covers is repeated.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterable, Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oncolake.llm.shipping import ship_package, small_batches
from oncolake.llm.textbytes import mix, pieces, powers, release_memory, span_hashes, utf8, words
from oncolake.operators.staging import checkpoint_dir, stage_table

WINDOW, GRAM = 35, 6
#: Bytes of text in a pack; one longer text is a pack of its own.
PACK_BYTES = 1 << 21
#: Words of passages in one automaton; more passages make more automata.
AUTOMATON_WORDS = 1 << 19
#: Letters that words are written with in an automaton: nodes then have few branches.
DIGITS = 64

_BASES = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)]
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(which: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _TABLES.get(which, (powers(_BASES[0], 1),) * 2)
    if len(up) < count:
        base = _BASES[which]
        up, down = powers(base, count), powers(np.uint64(pow(int(base), -1, 1 << 64)), count)
        if count <= 1 << 20:
            _TABLES[which] = up, down
    return up[:count], down[:count]


def _sequence_hashes(codes: np.ndarray, which: int):
    """A function that hashes spans of a sequence of word codes by their content."""
    up, down = _power_tables(which, len(codes) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(codes + _BASES[which]) * up[:-1])])
    return lambda begins, ends: mix((sums[ends] - sums[begins]) * down[begins] + (ends - begins).astype(np.uint64))


def stretches(data: np.ndarray, starts: np.ndarray, window: int, gram: int) -> dict[str, np.ndarray]:
    """All stretches of some texts: first word (counted over all texts), windows, anchor and content hash."""
    begins, ends, bounds = words(data, starts)
    codes = span_hashes(data, begins, ends)
    nothing = {name: np.zeros(0, np.int64) for name in ("at", "windows", "gram", "passage")}
    if len(codes) < window:
        return nothing
    hashed = _sequence_hashes(codes, 0)
    first = np.arange(len(codes) - gram + 1)
    grams = hashed(first, first + gram)
    # Leftmost least gram of each window, by shrinking steps as in a sparse table.
    span = window - gram + 1
    order, width = first.copy(), 1
    while width < span:
        step = min(width, span - width)
        left, right = order[: len(order) - step], order[step:]
        order = np.where(grams[right] < grams[left], right, left)
        width += step
    order = order[: len(codes) - window + 1]
    at = np.arange(len(order))
    row = np.searchsorted(bounds, at, "right") - 1
    inside = at + window <= bounds[row + 1]
    at, anchor = at[inside], order[inside]
    if not len(at):
        return nothing
    # Windows of one anchor that follow each other; an anchor never serves two texts.
    fresh = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    count = np.diff(np.concatenate([fresh, [len(at)]]))
    begin = at[fresh]
    whole = _sequence_hashes(codes, 1)(begin, begin + count + window - 1)
    return {
        "at": begin, "windows": count,
        "gram": grams[anchor[fresh]].view(np.int64), "passage": whole.view(np.int64),
    }


def pack_documents(documents: DataFrame, text: str) -> DataFrame:
    """(shard, pack): all rows and columns, compressed, in packs of about ``PACK_BYTES`` of text.

    The table is written once, bucketed by shard, so that joining small tables to it later does not
    move the texts again.
    """
    spark = documents.sparkSession

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for piece in pieces(batch, text, PACK_BYTES):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, piece.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(piece)
                body = pa.array([sink.getvalue().to_pybytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), body], names=["shard", "pack"])
                number += 1

    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"packs_{uuid.uuid4().hex}"
    packed = documents.mapInArrow(pack, "shard long, pack binary").repartition(count, "shard")
    writer = packed.write.format("parquet").option("compression", "none").bucketBy(count, "shard")
    writer.option("path", f"{checkpoint_dir(spark)}/{name}").saveAsTable(name)
    return spark.table(name)


def unpack(pack: bytes) -> pa.Table:
    return pa.ipc.open_stream(pack).read_all()


def _in_packs(text: str, find):
    """A function over batches of (shard, pack) that applies ``find`` to each pack's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, pack in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield find(shard, *utf8(unpack(pack.as_buffer()).column(text)))
            release_memory()

    return run


def _anchors(window: int, gram: int):
    def find(shard: int, data: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
        grams, times = np.unique(stretches(data, starts, window, gram)["gram"], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(grams, pa.int64()), pa.array(times, pa.int64())], names=["gram", "times"])

    return find


_STRETCH = "gram long, passage long, shard long, at int, windows int, times int"


def _stretch_rows(window: int, gram: int):
    """Each different stretch of a pack with its first place there and the number of its places."""

    def find(shard: int, data: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
        found = stretches(data, starts, window, gram)
        order = np.lexsort((found["at"], found["passage"], found["gram"]))
        grams, passage = found["gram"][order], found["passage"][order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (grams[1:] != grams[:-1]) | (passage[1:] != passage[:-1])
        first = np.flatnonzero(fresh)
        times = np.diff(np.concatenate([first, [len(order)]]))
        own = order[first]
        return pa.RecordBatch.from_arrays(
            [pa.array(grams[first], pa.int64()), pa.array(passage[first], pa.int64()),
             pa.array(np.full(len(own), shard), pa.int64()), pa.array(found["at"][own], pa.int32()),
             pa.array(found["windows"][own], pa.int32()), pa.array(times, pa.int32())],
            names=[name.split()[0] for name in _STRETCH.split(", ")],
        )

    return find


_HASHED = "gram long, shard long, at int, times long, hashes array<long>"


def _window_hashes(text: str, window: int):
    """For stretches of a pack that are to be compared the hash of each window."""

    def hashes(packs: pa.Table, wanted: pa.Table) -> pa.Table:
        if not packs.num_rows or not wanted.num_rows:
            return pa.table({n: pa.array([], t) for n, t in zip(("gram", "shard", "at", "times", "hashes"), types)})
        data, starts = utf8(unpack(packs.column("pack")[0].as_buffer()).column(text))
        begins, ends, _ = words(data, starts)
        hashed = _sequence_hashes(span_hashes(data, begins, ends), 1)
        at = wanted.column("at").to_numpy().astype(np.int64)
        count = wanted.column("windows").to_numpy().astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(count)])
        first = np.repeat(at, count) + np.arange(bounds[-1]) - np.repeat(bounds[:-1], count)
        values = pa.array(hashed(first, first + window).view(np.int64))
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)
        return pa.table({**{n: wanted.column(n) for n in ("gram", "shard", "at", "times")}, "hashes": lists})

    types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
    return hashes


class PassageFinder:
    """Aho-Corasick automata over the words of some passages, each of bounded size.

    Every word is written with the same number of digits, each place with digits of its own, so that
    matches begin and end with words.
    """

    def __init__(self, passages: Iterable[Sequence[bytes]]):
        passages = [passage for passage in passages if passage]
        known = dict.fromkeys(itertools.chain.from_iterable(passages))
        self.width = 1
        while DIGITS**self.width < len(known):
            self.width += 1
        places = [(DIGITS**i, DIGITS * i) for i in range(self.width)]
        for code, word in enumerate(known):
            known[word] = "".join([chr(code // power % DIGITS + shift) for power, shift in places])
        self.codes, self.other = known, chr(DIGITS * self.width) * self.width
        self.keys = {"".join([known[word] for word in passage]) for passage in passages}

    def automata(self) -> Iterator[ahocorasick.Automaton]:
        size, automaton = 0, None
        for key in self.keys:
            automaton = automaton or ahocorasick.Automaton(ahocorasick.STORE_INTS)
            automaton.add_word(key, len(key) // self.width)
            size += len(key) // self.width
            if size >= AUTOMATON_WORDS:
                automaton.make_automaton()
                yield automaton
                size, automaton = 0, None
        if automaton:
            automaton.make_automaton()
            yield automaton

    def covered(self, texts: Sequence[Sequence[bytes]]) -> list[np.ndarray]:
        """For each word of the texts whether an occurrence of a passage covers it."""
        get, other, width = self.codes.get, self.other, self.width
        written = ["".join([get(word, other) for word in parts]) for parts in texts]
        depths = [np.zeros(len(parts) + 1, np.int64) for parts in texts]
        for automaton in self.automata():
            for text, depth in zip(written, depths):
                found = np.array([x for match in automaton.iter(text) for x in match], np.int64).reshape(-1, 2)
                ends = (found[:, 0] + 1) // width
                np.add.at(depth, ends - found[:, 1], 1)
                np.subtract.at(depth, ends, 1)
        return [np.cumsum(depth)[:-1] > 0 for depth in depths]


def _search(text: str, names: list[str]):
    """The rows of a pack with what is left of their texts."""

    def search(packs: pa.Table, places: pa.Table) -> pa.Table:
        table = unpack(packs.column("pack")[0].as_buffer())
        # Bytes split at space and the control characters from tab to carriage return, and only there.
        texts = [(value or "").encode().split() for value in table.column(text).to_pylist()]
        every = list(itertools.chain.from_iterable(texts))
        spans = zip(places.column("at").to_pylist(), places.column("until").to_pylist())
        covered = PassageFinder(every[at:until] for at, until in spans).covered(texts)
        del every
        kept = [b" ".join(itertools.compress(parts, (~gone).tolist())).decode() for parts, gone in zip(texts, covered)]
        counts = [pa.array([len(parts) for parts in texts], pa.int64()),
                  pa.array([int(gone.sum()) for gone in covered], pa.int64())]
        release_memory()
        return pa.table([*[table.column(c) for c in names], *counts, pa.array(kept, pa.string())],
                        names=[*names, "n_words", "n_removed", "kept"])

    return search


def confirmed_places(packs: DataFrame, text: str, window: int, gram: int) -> DataFrame:
    """(shard, at, until): where confirmed passages stand, each once per pack, in words of the pack."""
    anchors = packs.mapInArrow(_in_packs(text, _anchors(window, gram)), "gram long, times long")
    recurring = anchors.groupBy("gram").agg(F.sum("times").alias("times")).filter("times > 1").select("gram")
    found = packs.mapInArrow(_in_packs(text, _stretch_rows(window, gram)), _STRETCH)
    found = stage_table(found.join(recurring, "gram", "left_semi"), "stretches")
    kinds = found.groupBy("gram", "passage").agg(
        F.sum("times").alias("times"), F.min(F.struct("shard", "at", "windows")).alias("place")
    )
    kinds = stage_table(kinds, "kinds")
    mixed = kinds.groupBy("gram").agg(F.count_if(F.col("times") == 1).alias("single"), F.count(F.lit(1)).alias("kinds"))
    mixed = mixed.filter("single > 0 AND kinds > 1").select("gram")
    wanted = kinds.join(mixed, "gram").select("gram", "times", "place.*")
    # Windows of stretches seen once that occur in another stretch of the same anchor.
    hashed = packs.groupBy("shard").cogroup(wanted.groupBy("shard")).applyInArrow(_window_hashes(text, window), _HASHED)
    hashed = stage_table(hashed, "windows")
    again = hashed.select("gram", "times", F.explode("hashes").alias("hash")).groupBy("gram", "hash").agg(
        F.sum("times").alias("seen")
    )
    single = hashed.filter("times = 1").select("gram", "shard", "at", F.posexplode("hashes").alias("offset", "hash"))
    offsets = single.join(again.filter("seen > 1").drop("seen"), ["gram", "hash"]).groupBy("shard", "at").agg(
        F.sort_array(F.collect_list("offset")).alias("offsets")  # at most window - gram + 1 of them
    )
    begins = F.filter("offsets", lambda o: ~F.array_contains("offsets", o - 1))
    ends = F.filter("offsets", lambda o: ~F.array_contains("offsets", o + 1))
    runs = F.explode(F.zip_with(begins, ends, lambda b, e: F.struct(b.alias("b"), e.alias("e"))))
    parts = offsets.select("shard", "at", runs.alias("run")).select(
        "shard", (F.col("at") + F.col("run.b")).alias("at"), (F.col("at") + F.col("run.e") + window).alias("until")
    )
    whole = found.join(kinds.filter("times > 1").select("gram", "passage"), ["gram", "passage"], "left_semi")
    return whole.select("shard", "at", (F.col("at") + F.col("windows") + (window - 1)).alias("until")).unionAll(parts)


def remove_passages(
    documents: DataFrame, text: str = "text", window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """Adds ``n_words``, ``n_removed`` and ``kept`` to every document.

    A word goes if a window of ``window`` words that covers it also starts elsewhere, in the same
    document or another; windows are judged on the input. ``kept`` holds the other words, joined by
    one space. Words are runs of characters other than space and the control characters from tab to
    carriage return. A null text has no words; a text shorter than a window keeps all of them.
    Repeated rows are documents of their own, so their windows recur. Columns of the three names are
    replaced, all others pass through. An empty table gives an empty one. ``gram`` changes speed only.
    """
    names = ("n_words", "n_removed", "kept")
    others = documents.select(*[c for c in documents.columns if c not in names])
    ship_package(documents.sparkSession)
    packs = pack_documents(others, text)
    places = confirmed_places(packs, text, window, gram)
    schema = others.select(
        "*", *[F.lit(0).cast(kind).alias(n) for n, kind in zip(names, ("long", "long", "string"))]
    ).schema
    return packs.groupBy("shard").cogroup(places.groupBy("shard")).applyInArrow(_search(text, others.columns), schema)


def op13_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its words in windows that occur anywhere else."""
    small_batches(spark)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = remove_passages(documents)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP13_SQL = r"""
WITH numbered AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), starts AS (
  SELECT r, unnest(range(1, len(w) - 33)) AS s FROM numbered WHERE len(w) >= 35
), windows AS (
  SELECT r, s, sha256(array_to_string(list_slice(w, s, s + 34), ' ')) AS h FROM starts JOIN numbered USING (r)
), again AS (
  SELECT h FROM windows GROUP BY h HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT r, unnest(range(s, s + 35)) AS i FROM windows SEMI JOIN again USING (h)
), words AS (
  SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM numbered
), kept AS (
  SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (r, i) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM numbered LEFT JOIN kept USING (r)
"""
