"""Spelling variants: PartEnum signatures of letter multisets, joined on equality and verified.

A word's letters are a binary vector: dimension (letter, k) is set if the letter occurs k times or
more. One replaced letter changes two dimensions, one more or less letter changes one. Dimensions
are dealt out to ``PARTS`` parts, and a word signs itself once for every choice of parts to leave out:
two for words of its own length, one for words a letter longer or shorter. Two words within the
distance leave out the parts where they differ, so they share that signature, and only there is the
pair counted. Since one edit spares the front or the back half of a word, the half is in the key too.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oncolake.llm.shipping import ship_package, small_batches
from oncolake.llm.textbytes import mix, release_memory, rows_of
from oncolake.operators.staging import stage_table

PARTS = 4
#: Choices of parts to leave out: pairs for equal lengths, then single parts for lengths one apart.
PAIRS = list(itertools.combinations(range(PARTS), 2))
#: Signatures are joined in this many rows at once; a larger group is joined on masked words instead.
ROWS, HOT = 1 << 16, 512
#: Letters compared at once.
CELLS = 1 << 22
#: A word takes its form from a near word that is this many times as frequent.
TIMES = 10

_CODE_BITS = np.uint64(31)
_SIGNED = "key long, tag long, n long, word string"
_FOUND = "id long, near long, best_n long, best_id long, key long, tag long, n long, word string"


def letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all words in one array, and the offsets of the words."""
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32)
    return flat.astype(np.uint64), np.concatenate([[0], np.cumsum(lengths)])


def part_of(letter: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
    """The part that a dimension belongs to."""
    return ((letter + occurrence) % np.uint64(PARTS)).astype(np.int64)


def part_sums(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For every word and part the sum of the codes of the dimensions that are set."""
    row = rows_of(starts)
    order = np.lexsort((flat, row))
    letter, row = flat[order], row[order]
    fresh = np.ones(len(letter), bool)
    fresh[1:] = (letter[1:] != letter[:-1]) | (row[1:] != row[:-1])
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(letter)), 0))
    occurrence = (np.arange(len(letter)) - first + 1).astype(np.uint64)
    code = mix(letter << np.uint64(32) | occurrence)
    part = part_of(letter, occurrence)
    sums = np.zeros((len(starts) - 1, PARTS), np.uint64)
    for number in range(PARTS):
        running = np.concatenate([[np.uint64(0)], np.cumsum(np.where(part == number, code, np.uint64(0)))])
        sums[:, number] = running[starts[1:]] - running[starts[:-1]]
    return sums


def ordered_hash(flat: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of code points, in order."""
    base = 0x9E3779B97F4A7C15
    up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(flat), base, np.uint64)]))
    down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(flat), pow(base, -1, 1 << 64), np.uint64)]))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(flat + np.uint64(1)) * up[:-1])])
    return mix((sums[ends] - sums[begins]) * down[begins] + (ends - begins).astype(np.uint64))


def signatures(words: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(role, keys of all words) for every signature; role 1 is the longer word of lengths one apart.

    The low five bits of a key tell the choice of parts and the half.
    """
    flat, starts = letters(words)
    sums = part_sums(flat, starts)
    total = sums.sum(axis=1)
    lengths = np.diff(starts)

    def key(code: int, kept: np.ndarray, length: np.ndarray, half: np.ndarray) -> np.ndarray:
        mixed = mix(kept + mix(half + mix(length.astype(np.uint64) + np.uint64(code << 40))))
        return (mixed & ~_CODE_BITS) | np.uint64(code)

    for role in (0, 1):
        length = lengths - role
        middle = starts[:-1] + np.maximum(length, 0) // 2
        front = ordered_hash(flat, starts[:-1], middle)
        back = ordered_hash(flat, np.minimum(middle + role, starts[1:]), starts[1:])
        for side, half in enumerate((front, back)):
            if not role:
                for number, (a, b) in enumerate(PAIRS):
                    yield 0, key(2 * number + side, total - sums[:, a] - sums[:, b], length, half)
            for number in range(PARTS):
                code = 2 * (len(PAIRS) + number) + side
                yield role, key(code, total - sums[:, number], length, half)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        identity = batch.column(0).to_numpy()
        for role, keys in signatures(batch.column(2)):
            tags = pa.array(identity * 2 + role)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), tags, batch.column(1), batch.column(2)],
                names=["key", "tag", "n", "word"],
            )
        release_memory()


def _pairs(begins: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of all pairs (i < j) of rows within the given groups."""
    later = np.repeat(ends, ends - begins) - np.arange(begins[0], ends[-1]) - 1 if len(begins) else np.zeros(0, int)
    bounds = np.concatenate([[0], np.cumsum(later)])
    at = 0
    while at < len(later):
        stop = max(int(np.searchsorted(bounds, bounds[at] + CELLS // 8, "right")) - 1, at + 1)
        count = later[at:stop]
        left = np.repeat(np.arange(at, stop), count)
        right = left + 1 + np.arange(len(left)) - np.repeat(bounds[at:stop] - bounds[at], count)
        yield left + (begins[0] if len(begins) else 0), right + (begins[0] if len(begins) else 0)
        at = stop


def _occurrence(block: np.ndarray, letter: np.ndarray) -> np.ndarray:
    return (block == letter[:, None]).sum(axis=1).astype(np.uint64)


def verified(flat: np.ndarray, starts: np.ndarray, code: np.ndarray, role: np.ndarray,
             left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs are one edit apart and belong to the signature they met under.

    ``code`` is that of the pair's signature. Of all signatures a near pair shares, exactly one
    counts it: the half is the front one if the edit is not in it, and the parts left out are those
    of the dimensions that differ (with the next part, should both lie in one).
    """
    ok = np.zeros(len(left), bool)
    longer = role[left] != role[right]
    first = np.where(longer & (role[left] == 1), right, left)  # the shorter word comes first
    second = np.where(longer & (role[left] == 1), left, right)
    size, other = np.diff(starts)[first], np.diff(starts)[second]
    same = code < 2 * len(PAIRS)
    fits = np.where(same, size == other, longer & (other == size + 1))
    side = code % 2
    for length in np.unique(size[fits]):
        chosen = np.flatnonzero(fits & (size == length))
        for cut in range(0, len(chosen), max(CELLS // (int(length) + 1), 1)):
            rows = chosen[cut : cut + max(CELLS // (int(length) + 1), 1)]
            equal = rows[same[rows]]
            a = flat[starts[first[equal], None] + np.arange(length)]
            b = flat[starts[second[equal], None] + np.arange(length)]
            differ = a != b
            one = differ.sum(axis=1) == 1
            equal, a, b = equal[one], a[one], b[one]
            at = differ[one].argmax(axis=1) if length else np.zeros(0, int)
            x, y = a[np.arange(len(at)), at], b[np.arange(len(at)), at]
            p, q = part_of(x, _occurrence(a, x)), part_of(y, _occurrence(b, y))
            q = np.where(p == q, (p + 1) % PARTS, q)
            number = np.zeros((PARTS, PARTS), np.int64)
            for index, (u, v) in enumerate(PAIRS):
                number[u, v] = number[v, u] = index
            ok[equal] = (number[p, q] == code[equal] // 2) & ((at >= length // 2) == (side[equal] == 0))
            apart = rows[~same[rows]]
            a = flat[starts[first[apart], None] + np.arange(length)]
            b = flat[starts[second[apart], None] + np.arange(length + 1)]
            differ = a != b[:, :length]
            at = np.where(differ.any(axis=1), differ.argmax(axis=1) if length else 0, length)
            tail = np.arange(length) >= at[:, None]
            one = ~((a != b[:, 1:]) & tail).any(axis=1)
            apart, b, at = apart[one], b[one], at[one]
            x = b[np.arange(len(at)), at]
            p = part_of(x, _occurrence(b, x))
            ok[apart] = (p == code[apart] // 2 - len(PAIRS)) & ((at >= length // 2) == (side[apart] == 0))
    return ok


def _tally(identity: np.ndarray, n: np.ndarray, left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
    """Near words and the most frequent one (ties to the smaller id) of every word in some pairs."""
    own = np.concatenate([identity[left], identity[right]])
    their, count = np.concatenate([identity[right], identity[left]]), np.concatenate([n[right], n[left]])
    order = np.lexsort((their, -count, own))
    own, their, count = own[order], their[order], count[order]
    fresh = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, int)
    near = np.diff(np.concatenate([fresh, [len(own)]]))
    return _row(id=own[fresh], near=near, best_n=count[fresh], best_id=their[fresh])


def _row(**columns) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    fields = [f.strip().split() for f in _FOUND.split(",")]
    types = {"long": pa.int64(), "string": pa.string()}
    arrays = [pa.array(columns[name], types[kind]) if name in columns else pa.nulls(size, types[kind])
              for name, kind in fields]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def _masked(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Rows of a hot signature under new keys: the word without one letter of the half that may differ.

    Near words share such a key, and words that share one are near, so its groups are small.
    """
    keys = table.column("key").to_numpy().view(np.uint64)
    tags = table.column("tag").to_numpy()
    out: dict[str, list] = {"key": [], "tag": [], "n": [], "word": []}
    for key, tag, n, word in zip(keys, tags, table.column("n").to_pylist(), table.column("word").to_pylist()):
        code, role = int(key & _CODE_BITS), int(tag & 1)
        middle = (len(word) - role) // 2
        if code < 2 * len(PAIRS) or role:
            span = range(middle, len(word)) if code % 2 == 0 else range(0, middle + role)
            flat, _ = letters(pa.array([word]))
            front = ordered_hash(flat, np.zeros(len(span), int), np.array(span, dtype=int))
            back = ordered_hash(flat, np.array(span, dtype=int) + 1, np.full(len(span), len(word)))
            place = np.array(span, dtype=np.uint64) if code < 2 * len(PAIRS) else np.uint64(0)
            if role:  # the word without the letter, wherever that was: as the shorter word signs
                masks = np.unique([_whole(word[:i] + word[i + 1 :]) for i in span])
            else:
                masks = mix(front + mix(back + mix(place + key)))
        else:
            masks = np.array([_whole(word)], np.uint64)
        fresh = (mix(masks + key) & ~_CODE_BITS) | np.uint64(code)
        out["key"] += fresh.view(np.int64).tolist()
        out["tag"] += [int(tag)] * len(fresh)
        out["n"] += [n] * len(fresh)
        out["word"] += [word] * len(fresh)
        if len(out["key"]) >= ROWS:
            yield _row(**out)
            out = {name: [] for name in out}
    if out["key"]:
        yield _row(**out)


def _whole(word: str) -> np.uint64:
    flat, starts = letters(pa.array([word]))
    return ordered_hash(flat, starts[:1], starts[1:])[0]


def _meet(limit: int | None):
    """Joins rows that come sorted by key; groups above ``limit`` go out under masked keys."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        hot = None  # the key of a group that is already known to be above the limit
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                if batch.num_rows:
                    held.append(batch)
                if sum(b.num_rows for b in held) < ROWS:
                    continue
            if not held:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            keys = table.column("key").to_numpy()
            if batch is None:
                end = len(keys)
            else:
                end = int(np.searchsorted(keys, keys[-1], "left"))
            if limit is not None and hot is not None and keys[0] == hot:
                begin = int(np.searchsorted(keys, hot, "right"))
                yield from _masked(table.slice(0, begin))
                table, keys, end = table.slice(begin), keys[begin:], max(end - begin, 0)
            if limit is not None and batch is not None and len(keys) - end > limit:
                hot = keys[-1]
                yield from _masked(table.slice(end))
                table, keys = table.slice(0, end), keys[:end]
            held = table.slice(end).to_batches()
            yield from _join(table.slice(0, end), keys[:end], limit)
            release_memory()

    return groups


def _join(table: pa.Table, keys: np.ndarray, limit: int | None) -> Iterator[pa.RecordBatch]:
    if len(keys) < 2:
        return
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    ends = np.concatenate([begins[1:], [len(keys)]])
    size = ends - begins
    if limit is not None:
        for begin, end in zip(begins[size > limit], ends[size > limit]):
            yield from _masked(table.slice(begin, end - begin))
        keep = np.repeat((size > 1) & (size <= limit), size)
    else:
        keep = np.repeat(size > 1, size)
    table, keys = table.filter(pa.array(keep)), keys[keep]
    if not len(keys):
        return
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    ends = np.concatenate([begins[1:], [len(keys)]])
    tags, n = table.column("tag").to_numpy(), table.column("n").to_numpy()
    flat, starts = letters(table.column("word").combine_chunks())
    identity, role = tags >> 1, tags & 1
    code = (keys.view(np.uint64) & _CODE_BITS).astype(np.int64)
    for left, right in _pairs(begins, ends):
        fits = (role[left] != role[right]) | (code[left] < 2 * len(PAIRS))
        left, right = left[fits], right[fits]
        good = verified(flat, starts, code[left], role, left, right)
        if good.any():
            yield _tally(identity, n, left[good], right[good])


def near_words(words: DataFrame) -> DataFrame:
    """(id, n_near, best_n, best_id) of every word of (id, n, word) that has a word one edit away."""
    ship_package(words.sparkSession)
    signed = words.select("id", "n", "word").mapInArrow(_sign, _SIGNED)

    def joined(rows: DataFrame, limit: int | None) -> DataFrame:
        return rows.repartition("key").sortWithinPartitions("key").mapInArrow(_meet(limit), _FOUND)

    first = stage_table(joined(signed, HOT), "near")
    again = joined(first.filter("key IS NOT NULL").select("key", "tag", "n", "word"), None)
    found = first.filter("key IS NULL").unionAll(again)
    best = F.max(F.struct("best_n", (-F.col("best_id")).alias("best_id")))
    tallied = found.groupBy("id").agg(F.sum("near").alias("n_near"), best.alias("best"))
    return tallied.select("id", "n_near", F.col("best.best_n").alias("best_n"), (-F.col("best.best_id")).alias("best_id"))


def group_spellings(words: DataFrame, word: str = "word", n: str = "n", times: int = TIMES) -> DataFrame:
    """For each distinct word its form, the root of its forms, and how many words are one edit away.

    ``form`` is the near word of largest count (ties: smallest in code-point order) if that count is
    ``times`` (2 or more) the word's own; ``root`` is reached by following forms, the word itself if it
    has none. Counts of a repeated word are added up; a null word or a count that is null or below one
    does not take part; the empty word is a word. Other columns are not read, so their names may clash.
    An empty table gives an empty one. Words of any length and script are compared by code points.
    """
    if times < 2:
        raise ValueError("times must be 2 or more, or forms could go in circles")
    counted = words.select(F.col(word).alias("word"), F.col(n).cast("long").alias("n"))
    counted = counted.filter("word IS NOT NULL AND n > 0").groupBy("word").agg(F.sum("n").alias("n"))
    # Range partitions in order of words: ids ascend with the words.
    ordered = counted.repartitionByRange("word").sortWithinPartitions("word")
    known = stage_table(ordered.withColumn("id", F.monotonically_increasing_id()), "words")
    near = stage_table(near_words(known), "near")
    formed = known.join(near, "id", "left").withColumn(
        "form_id", F.when(F.col("best_n") >= F.lit(times) * F.col("n"), F.col("best_id"))
    )
    formed = stage_table(formed.select("id", "word", "n", "n_near", "best_n", "form_id"), "forms")
    links = formed.filter("form_id IS NOT NULL").select("id", F.col("form_id").alias("to"))
    # Every step multiplies the count by ``times``, which bounds the path; each round doubles it.
    top = formed.agg(F.max("n")).first()[0] or 1
    for _ in range(max(math.ceil(math.log2(math.log(top, times) + 1)), 0)):
        ahead = links.select(F.col("id").alias("__at"), F.col("to").alias("__to"))
        links = links.join(ahead, links["to"] == ahead["__at"], "left")
        links = stage_table(links.select("id", F.coalesce("__to", "to").alias("to")), "roots")
    name = known.select(F.col("id").alias("__id"), F.col("word").alias("__word"))
    form = name.select(F.col("__id").alias("form_id"), F.col("__word").alias("form"))
    root = links.join(name, links["to"] == name["__id"]).select("id", F.col("__word").alias("root"))
    forms = formed.filter("form_id IS NOT NULL").join(form, "form_id").join(root, "id")
    plain = formed.filter("form_id IS NULL").select(
        "word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"), F.lit(None).cast("long").alias("form_n"),
    )
    return plain.unionByName(
        forms.select("word", "form", "root", "n", "n_near", F.col("best_n").alias("form_n"))
    )


def misspelt_words(documents: DataFrame, least: int = 7, times: int = 2, one_in: int = 31) -> DataFrame:
    """(word, n): runs of Latin letters, some of them without one letter, of ``least`` letters or more.

    Only A-Z are lower-cased. Of a run whose CRC-32 of ``doc_id:run`` is divisible by ``one_in`` the
    letter at that number modulo its length goes. A null text has no runs; a null doc_id is written as
    nothing. Words seen less than ``times`` are left out. Repeated rows count again.
    """
    run = F.expr(f"explode(regexp_extract_all(text, '([A-Za-z\\u00C0-\\u00FF]{{{least},}})', 1))")
    upper, lower = (bytes(range(a, a + 26)).decode() for a in (0x41, 0x61))
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    runs = documents.select(number.alias("doc"), run.alias("run"))
    runs = runs.select("doc", F.translate("run", upper, lower).alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % one_in == 0, cut).otherwise(F.col("run"))
    words = runs.select(word.alias("word")).filter(F.length("word") >= least)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= times)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms and roots of the words of all documents, some of them damaged."""
    small_batches(spark)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return group_spellings(misspelt_words(documents))
