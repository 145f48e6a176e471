"""MinHash near-duplicates by tensored banding, confirmed on full shingle sets.

Two collections of half keys are made from few minhashes; every pair of a half key of the first and
one of the second is a table. ``HALVES`` = 8 half keys of ``ROWS`` = 2 minhashes each make 64 tables
of 4 minhashes out of 32 instead of 256. Texts of similarity 0.85 miss each other in all tables with
probability 7e-5 (1 - (1 - (1 - 0.85**2)**8)**2).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oncolake.llm.graph import components
from oncolake.llm.shipping import ship_package, small_batches
from oncolake.llm.textbytes import LOWER, mix, pieces, rows_of, span_hashes, utf8, words
from oncolake.operators.staging import stage_table

HALVES, ROWS = 8, 2

_SALTS = np.random.default_rng(7).integers(1, 2**63, 2 * HALVES * ROWS, dtype=np.uint64)


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text (sorted), and the offsets of the texts.

    A-Z are lower-cased, words are runs of other than space and control characters 9 to 13. A text of
    fewer than ``size`` words has one shingle, its whole sequence; one without words has none.
    """
    data, starts = utf8(column)
    data = LOWER[data]
    begins, ends, first = words(data, starts)
    if not len(begins):
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    word = span_hashes(data, begins, ends)
    number = np.diff(first)
    owner = rows_of(first)
    value = word.copy()
    for step in range(1, size):
        follows = np.zeros(len(word), np.uint64)
        follows[:-step] = word[step:]
        inside = np.arange(len(word)) + step < first[owner + 1]
        value = np.where(inside, mix(value + follows * np.uint64(2 * step + 1)), value)
    at = np.arange(len(word)) - first[owner]
    keep = at <= np.maximum(number[owner] - size, 0)
    value, owner = value[keep], owner[keep]
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.searchsorted(owner, np.arange(len(starts)))


def _signatures(value: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Half keys, one row per text that has shingles: first collection, then second."""
    full = np.flatnonzero(np.diff(bounds))
    out = np.zeros((len(full), 2 * HALVES), np.uint64)
    for key in range(2 * HALVES):
        for row in range(ROWS):
            hashed = mix(value ^ _SALTS[key * ROWS + row])
            out[:, key] = mix(out[:, key] * np.uint64(31) + np.minimum.reduceat(hashed, bounds[full]))
    return out


def _measure(documents: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, a fingerprint of the set, and the half keys; text is read once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                value, bounds = shingle_sets(piece.column(1), size)
                count = np.diff(bounds)
                full = count > 0
                prints = _prints(value, bounds)
                keys = np.zeros((len(count), 2 * HALVES), np.int64)
                if full.any():
                    keys[full] = _signatures(value, bounds).view(np.int64)
                offsets = np.arange(0, keys.size + 1, 2 * HALVES, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(count.astype(np.int64)), pa.array(prints[0]),
                     pa.array(prints[1]), pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))],
                    names=["doc_id", "n_shingles", "print_a", "print_b", "halves"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_shingles long, print_a long, print_b long, halves array<long>"
    return documents.select("doc_id", "text").mapInArrow(run, schema)


def _sets(documents: DataFrame, size: int) -> DataFrame:
    """doc_id and the whole set of shingle hashes; of a repeated doc_id the largest set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                value, bounds = shingle_sets(piece.column(1), size)
                lists = pa.ListArray.from_arrays(
                    bounds.astype(np.int32), pa.array(value.view(np.int64))
                )
                prints = _prints(value, bounds)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(prints[0]), pa.array(prints[1]), lists],
                    names=["doc_id", "print_a", "print_b", "shingles"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, print_a long, print_b long, shingles array<long>"
    found = documents.select("doc_id", "text").mapInArrow(run, schema)
    largest = F.struct(F.size("shingles").cast("long"), "print_a", "print_b")
    return found.groupBy("doc_id").agg(F.max_by("shingles", largest).alias("shingles"))


def _prints(value: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Two 64-bit fingerprints of each set."""
    full = np.diff(bounds) > 0
    out = np.zeros((2, len(full)), np.int64)
    if full.any():
        at = bounds[:-1][full]
        out[0, full] = np.add.reduceat(mix(value), at).view(np.int64)
        out[1, full] = np.add.reduceat(mix(value ^ np.uint64(0x5DEECE66D)), at).view(np.int64)
    return out


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough, by whole numbers."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    joined = pairs.join(left, "a").join(right, "b")
    return joined.filter(_allowed(both, F.size("sa"), F.size("sb"), percent)).select("a", "b")


def _hopeful(sets: DataFrame, percent: int) -> DataFrame:
    """(rep, n, common) of the sets that may be similar enough to another one at all.

    ``common`` counts the shingles that some other set has too. An intersection holds only such
    shingles, so a set of which less than the wanted share is common has no link.
    """
    shingle = sets.select("doc_id", F.explode("shingles").alias("shingle"))
    own = shingle.groupBy("shingle").agg(F.count(F.lit(1)).alias("found"), F.min("doc_id").alias("rep"))
    own = own.filter("found = 1").groupBy("rep").agg(F.count(F.lit(1)).alias("own"))
    sizes = sets.select(F.col("doc_id").alias("rep"), F.size("shingles").cast("long").alias("n"))
    common = F.col("n") - F.coalesce("own", F.lit(0))
    found = sizes.join(own, "rep", "left").select("rep", "n", common.alias("common"))
    return found.filter(F.lit(100) * F.col("common") >= F.lit(percent) * F.col("n"))


def _against_pivots(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """For pairs (rep, p): the size of the intersection, and a bit per shingle of p that rep has."""
    left = sets.select(F.col("doc_id").alias("rep"), F.col("shingles").alias("x"))
    right = sets.select(F.col("doc_id").alias("p"), F.col("shingles").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both, bits = [], []
            x, y = batch.column(2), batch.column(3)
            for one, other in zip(x, y):
                has = np.isin(other.values.to_numpy(), one.values.to_numpy(), assume_unique=True)
                both.append(int(has.sum()))
                packed = np.packbits(np.append(has, np.zeros(-len(has) % 64, bool)))
                bits.append(packed.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(both, pa.int64()),
                 pa.array(bits, pa.list_(pa.int64()))],
                names=["rep", "p", "both", "bits"],
            )

    kind = sets.schema["doc_id"].dataType.simpleString()
    rows = pairs.join(left, "rep").join(right, "p").select("rep", "p", "x", "y")
    return rows.mapInArrow(run, f"rep {kind}, p {kind}, both long, bits array<long>")


def _allowed(both: Column, n: Column, m: Column, percent: int) -> Column:
    """Whether an intersection of this size makes sets of n and m shingles similar enough."""
    return F.lit(100) * both >= F.lit(percent) * (n + m - both)


def near_duplicates(documents: DataFrame, percent: int = 80, size: int = 5) -> DataFrame:
    """One row per document: n_shingles, component_id (smallest doc_id reached) and kept.

    Documents are linked if 100 * intersection >= percent * union of their sets of ``size``-word
    shingles. Rows of equal sets count as one class; the class, represented by its smallest doc_id,
    is looked up once. Sets with too many shingles of their own are proven to have no link. Every
    table bucket ties its members to one of them by a pair; members that this does not join are
    compared with the members of other components of the bucket in a second step, where common
    shingles allow a link. So no link is lost by the short cut, and a bucket of many similar texts
    costs about as many pairs as it has texts. Null and empty texts have no shingles,
    are linked with nothing and kept. Rows of a repeated doc_id count as one document, by the row of
    the largest set, and each of them is returned with its own n_shingles and the common component;
    rows of a null doc_id are linked with nothing and kept. Only ``doc_id`` and ``text`` are read.
    """
    ship_package(documents.sparkSession)
    measured = stage_table(_measure(documents, size), "minhash")
    some = measured.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    # An id counts once, by its largest set; ids of equal sets are one class.
    largest = F.max(F.struct("n_shingles", "print_a", "print_b", "halves")).alias("best")
    single = stage_table(some.groupBy("doc_id").agg(largest).select("doc_id", "best.*"), "single")
    classes = stage_table(
        single.groupBy("print_a", "print_b", "n_shingles").agg(
            F.min("doc_id").alias("rep"), F.first("halves").alias("halves")
        ),
        "classes",
    )
    # Tables: every pair of half keys of the two collections.
    first = F.slice("halves", 1, HALVES)
    second = F.slice("halves", HALVES + 1, HALVES)
    keys = F.flatten(
        F.transform(first, lambda x, i: F.transform(second, lambda y, j: F.xxhash64(x, y, i * HALVES + j)))
    )
    keyed = classes.select(F.col("rep"), F.explode(keys).alias("key"))
    crowded = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    shared = stage_table(keyed.join(crowded, "key", "left_semi"), "buckets")
    wanted = documents.select("doc_id", "text").join(
        shared.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi"
    )
    sets = stage_table(_sets(wanted, size), "sets")
    hopeful = stage_table(_hopeful(sets, percent), "hopeful")
    # A bucket's pivot is the member that has the least of its own.
    member = shared.join(hopeful, "rep").select("key", F.struct("rep", "n", "common").alias("m"))
    order = F.struct(F.col("m.common") / F.col("m.n"), F.col("m.n"), F.col("m.rep"))
    pivots = member.groupBy("key").agg(F.max_by("m", order).alias("p"), F.count(F.lit(1)).alias("members"))
    member = stage_table(member.join(pivots.filter("members > 1"), "key"), "members")
    others = member.filter("m.rep != p.rep")
    star = others.select("m.rep", F.col("p.rep").alias("p")).distinct()
    facts = stage_table(_against_pivots(star, sets), "facts")
    sized = others.select("m.rep", F.col("p.rep").alias("p"), "m.n", F.col("p.n").alias("pn")).distinct()
    linked = facts.join(sized, ["rep", "p"]).filter(_allowed(F.col("both"), F.col("n"), F.col("pn"), percent))
    links = stage_table(linked.select(F.col("rep").alias("a"), F.col("p").alias("b")), "links")
    joined = stage_table(components(links), "joined")
    # Second step: members of a bucket outside its pivot's component against the other members.
    joined = joined.withColumnRenamed("node", "rep")
    state = others.filter("members > 2").select("key", "m.*", F.col("p.rep").alias("p"))
    state = state.join(facts, ["rep", "p"]).join(joined, "rep", "left")
    home = joined.select(F.col("rep").alias("p"), F.col("component").alias("home"))
    state = state.join(home, "p", "left").select(
        "key",
        F.struct(
            "rep", "n", "common", "bits", (F.col("common") - F.col("both")).alias("rest"),
            F.coalesce("component", "rep").alias("c"),
        ).alias("m"),
        F.coalesce("home", "p").alias("home"),
    )
    state = stage_table(state, "state")
    outside = state.filter("m.c != home").select("key", "m")
    inside = state.select("key", F.col("m").alias("o"))
    # Both are compared with the same pivot: the shingles of it that they share, and those that
    # others have too but the pivot lacks, bound the intersection.
    m, o = F.col("m"), F.col("o")
    within = F.aggregate(
        F.zip_with("m.bits", "o.bits", lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0), lambda t, x: t + x
    )
    extra = outside.join(inside, "key").filter(
        (m["c"] != o["c"])
        & _allowed(F.least("m.common", "o.common"), m["n"], o["n"], percent)
        & _allowed(within + F.least("m.rest", "o.rest"), m["n"], o["n"], percent)
    )
    extra = extra.select(F.least("m.rep", "o.rep").alias("a"), F.greatest("m.rep", "o.rep").alias("b")).distinct()
    more = stage_table(_confirmed(extra, sets, percent), "links")
    if more.isEmpty():
        reached = joined.withColumnRenamed("rep", "node")
    else:
        reached = components(links.unionAll(more))
    group = classes.join(reached, classes["rep"] == reached["node"], "left").select(
        "print_a", "print_b", "n_shingles", F.coalesce("component", "rep").alias("component")
    )
    group = single.join(group, ["print_a", "print_b", "n_shingles"]).select("doc_id", "component")
    out = measured.select("doc_id", "n_shingles").join(group, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one_of_each(documents: DataFrame, percent: int = 80, size: int = 5) -> DataFrame:
    """The documents without those whose component has a smaller doc_id, with all their columns.

    Of rows with a repeated doc_id one stays, that with the longest text. Rows of a null doc_id stay.
    """
    found = near_duplicates(documents, percent, size)
    marks = found.groupBy("doc_id").agg(F.first("kept").alias("kept"), F.count(F.lit(1)).alias("copies"))
    marks = marks.filter(F.col("doc_id").isNotNull() & (~F.col("kept") | (F.col("copies") > 1)))
    marks = stage_table(marks, "marks")
    single = documents.join(marks.select("doc_id"), "doc_id", "left_anti").select(*documents.columns)
    again = marks.filter("kept").select("doc_id")
    if again.isEmpty():
        return single
    rows = documents.join(again, "doc_id", "left_semi").select(F.struct(*documents.columns).alias("row"))
    order = F.struct(F.length(F.coalesce("row.text", F.lit(""))), "row")
    one = rows.groupBy("row.doc_id").agg(F.max_by("row", order).alias("row"))
    return single.unionByName(one.select("row.*"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component at 85 percent of three-word shingles."""
    small_batches(spark)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(documents, percent=85, size=3)
