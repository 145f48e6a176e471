"""Conversation structure repair: rank-convergence parallel Viterbi over chunks of turns.

Turns are to read ``(s?(ua)+)?`` by the initials of their roles. A state is what was written last:
nothing, s, u or a. The backward cost of a state is the least cost to finish from there. Chunks of a
conversation start from a guessed cost vector at their end, all at once. A fix-up pass gives each
chunk the vector its successor arrived at; it runs again only until its vectors differ from the old
ones by a constant, for from there on they stay so. Passes go on until no chunk changes. Then the
constants are added up, and the edits are traced forward, always by the least letter that keeps the
cost at its minimum.
"""

from __future__ import annotations

import functools
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oncolake.llm.shipping import ship_package, small_batches
from oncolake.operators.staging import stage_table

#: Rows that a chunk may hold, as a power of two.
CHUNK_BITS = 14

NOTHING, S, U, A = range(4)
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: What may follow, and the role an inserted or changed turn then has.
_AFTER = {NOTHING: U, S: U, U: A, A: U}
_ROLE = {U: "user", A: "assistant"}
#: Least costs after the last turn: nothing and a may end, u lacks a, s lacks both.
END = (0, 4, 2, 0)
GUESS = (0, 0, 0, 0)

#: A turn as one letter: its role's initial, in capitals if truncated; x if it must go.
SYMBOLS = "suaoSUAOx"
SPACES = " \t\n\x0b\x0c\r"


def _kept(symbol: str, state: int) -> int | None:
    """The state after keeping a turn, None if it may not follow."""
    after = {"s": S, "u": U, "a": A}.get(symbol.lower())
    if after == S:
        return S if state == NOTHING else None
    return after if after is not None and after == _AFTER[state] else None


@functools.lru_cache(maxsize=1 << 16)
def step(symbol: str, ahead: tuple[int, ...]) -> tuple[tuple[int, ...], int, tuple[tuple[str, int], ...]]:
    """One turn backwards.

    From the cost vector behind a turn: the vector before it, less its least element; that element;
    and for each state the least letters of the edits up to and with this turn, and the state after.
    """
    fee = TRUNCATED if symbol.isupper() else 0
    costs = []
    for state in range(4):
        found = [DELETE + ahead[state]]
        if symbol != "x":
            after = _kept(symbol, state)
            if after is not None:
                found.append(fee + ahead[after])
            found.append(REROLE + fee + ahead[_AFTER[state]])
        costs.append(min(found))
    for _ in range(3):  # inserts in front of the turn
        costs = [min(costs[q], INSERT + costs[_AFTER[q]]) for q in range(4)]
    choices = []
    for state in range(4):
        letters, at = "", state
        while True:
            after = None if symbol == "x" else _kept(symbol, at)
            if DELETE + ahead[at] == costs[at]:
                letters += "D"
                break
            if INSERT + costs[_AFTER[at]] == costs[at]:
                letters, at = letters + "I", _AFTER[at]
                continue
            if after is not None and fee + ahead[after] == costs[at]:
                letters, at = letters + "K", after
            else:
                letters, at = letters + "R", _AFTER[at]
            break
        choices.append((letters, at))
    least = min(costs)
    return tuple(c - least for c in costs), least, tuple(choices)


def run_back(symbols: str, ahead: tuple[int, ...], known: bytes = b"", constant: int = 0) -> tuple[bytes, int]:
    """The cost vectors behind every turn of a chunk and before its first (four bytes each), the least
    element taken off, and the sum of what was taken off.

    ``known`` and ``constant`` are those of an earlier run from another start. Where the new run
    arrives at an equal vector, the rest differs by a constant only and is taken over.
    """
    out = bytearray(4 * (len(symbols) + 1))
    out[4 * len(symbols) :] = bytes(ahead)
    total = constant
    for i in range(len(symbols) - 1, -1, -1):
        before = step(symbols[i], tuple(known[4 * i + 4 : 4 * i + 8]))[1] if known else 0
        ahead, least, _ = step(symbols[i], ahead)
        total += least - before
        vector = bytes(ahead)
        if known and known[4 * i : 4 * i + 4] == vector:
            out[: 4 * i + 4] = known[: 4 * i + 4]
            break
        out[4 * i : 4 * i + 4] = vector
    return bytes(out), total


def trace(symbols: str, vectors: bytes, state: int) -> Iterator[tuple[str, str, int]]:
    """For each turn its symbol, the letters of its edits, its own last, and the state behind it."""
    for i, symbol in enumerate(symbols):
        letters, state = step(symbol, tuple(vectors[4 * i + 4 : 4 * i + 8]))[2][state]
        yield symbol, letters, state


def _run(batch: pa.RecordBatch, results: list[tuple[bytes, int]]) -> pa.RecordBatch:
    vectors, totals = pa.array([v for v, _ in results], pa.binary()), pa.array([t for _, t in results], pa.int64())
    names = [*batch.schema.names[:4], "vectors", "constant"]
    return pa.RecordBatch.from_arrays([*batch.columns[:4], vectors, totals], names=names)


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        following, symbols = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        yield _run(batch, [run_back(s, END if f is None else GUESS) for s, f in zip(symbols, following)])


def _fix_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*[batch.column(i).to_pylist() for i in range(3, 7)])
        yield _run(batch, [(o, c) if a is None else run_back(s, tuple(a), o, c) for s, o, c, a in rows])


def converge(chunks: DataFrame) -> DataFrame:
    """Adds ``vectors`` and ``constant`` to (conv_id, block, following, symbols).

    ``vectors`` are the backward costs behind each turn less their least element, ``constant`` the sum
    of what was taken off within the chunk. Passes are Spark jobs over the table of chunks, each written
    to the shared folder. A chunk of turns that must all go hands on whatever vector it gets, so a run
    of k such chunks takes k passes; others settle in the first or second.
    """
    kind = chunks.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, block long, following long, symbols string, vectors binary, constant long"
    current = stage_table(chunks.mapInArrow(_first_pass, schema), "chunks")
    # Only conversations of several chunks guess.
    if not current.filter("following IS NOT NULL").limit(1).count():
        return current
    while True:
        size = F.length("symbols")
        arrived = current.select(
            F.col("conv_id").alias("__conv"), F.col("block").alias("__block"),
            F.substring("vectors", 1, 4).alias("__ahead"),
        )
        last = F.substring(F.col("vectors"), 4 * size + 1, F.lit(4))
        joined = current.join(
            arrived,
            current["conv_id"].eqNullSafe(arrived["__conv"]) & (current["following"] == arrived["__block"]),
            "left",
        )
        wrong = F.when(F.col("__ahead") != last, F.col("__ahead"))
        todo = stage_table(
            joined.select("conv_id", "block", "following", "symbols", "vectors", "constant", wrong.alias("ahead")),
            "chunks",
        )
        if not todo.filter("ahead IS NOT NULL").limit(1).count():
            return current
        current = stage_table(todo.mapInArrow(_fix_up, schema), "chunks")


_EDITS = (
    "conv_id {kind}, step long, edit string, fault string, turn long, role string, text string, "
    "source_role string, cost long"
)


class _Writer:
    """The edits of conversations that come one after the other, turn by turn."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.conversation = None
        self.state, self.number, self.begun = NOTHING, 0, False

    def _insert(self) -> None:
        self.state = _AFTER[self.state]
        self._add("I", None, None, _ROLE[self.state], "", None, INSERT)

    def _add(self, *values) -> None:
        self.rows.append((self.conversation, self.number, *values))
        self.number += 1

    def begin(self, conversation) -> None:
        if not self.begun or conversation != self.conversation:
            self.finish()
            self.conversation, self.state, self.number, self.begun = conversation, NOTHING, 0, True

    def turn(self, symbol: str, letters: str, after: int, turn: int, role: str, text: str, blank: bool) -> None:
        for _ in letters[:-1]:
            self._insert()
        edit, self.state = letters[-1], after
        fault = ("blank" if blank else "duplicate") if symbol == "x" else "truncated" if symbol.isupper() else None
        cost = {"K": 0, "R": REROLE, "D": DELETE}[edit] + (TRUNCATED if edit != "D" and symbol.isupper() else 0)
        self._add(edit, fault, turn, _ROLE[after] if edit == "R" else role, text, role, cost)

    def finish(self) -> None:
        while self.state in (S, U):
            self._insert()

    def batch(self, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        if self.rows:
            types = [kind] + [pa.int64() if t.split()[1] == "long" else pa.string() for t in _EDITS.split(", ")[1:]]
            names = [t.split()[0] for t in _EDITS.split(", ")]
            columns = [pa.array(values, t) for values, t in zip(zip(*self.rows), types)]
            self.rows = []
            yield pa.RecordBatch.from_arrays(columns, names=names)


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams whole conversations, each chunk in front of its turns, and yields their edits."""
    writer, kind = _Writer(), pa.null()
    steps: Iterator[tuple[str, str, int]] = iter(())
    for batch in batches:
        kind = batch.column(0).type
        columns = [batch.column(name).to_pylist() for name in
                   ("conv_id", "kind", "turn", "role", "text", "blank", "symbols", "vectors")]
        for conversation, sort, turn, role, text, blank, symbols, vectors in zip(*columns):
            if sort == 0:
                writer.begin(conversation)
                steps = trace(symbols, vectors, writer.state)
            else:
                writer.turn(*next(steps), turn, role, text, blank)
        yield from writer.batch(kind)
    writer.finish()
    yield from writer.batch(kind)


def repair_conversations(
    rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The cheapest edits that give every conversation turns of the form ``(s?(ua)+)?``.

    One row per edit: ``conv_id``, ``step`` (from 0), ``edit`` (K keep, R change role, D delete,
    I insert), ``fault`` (blank, duplicate, truncated or null), ``turn``, ``role`` and ``text`` after
    the edit, ``source_role`` (null for inserted turns), ``cost``. Of equally cheap edits those whose
    letters come first in ASCII order are taken. Rows of a conversation come together and in order.

    A null role or text counts as one space; a null turn comes first; rows of a null conversation
    are one. Rows of one turn are taken by role, then text, so repeated rows are neighbours and all
    but the first are duplicates. An empty role has no initial, its turn cannot be kept. Other
    columns are not read, so their names may clash. An empty table gives an empty one. A conversation
    of any length is cut into chunks; only writing its edits, in order, is one stream.
    """
    ship_package(rows.sparkSession)
    source = rows.select(
        F.col(conversation).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    # Rows that are equal in all columns may still go to several partitions.
    order = ["conv_id", "turn", "role", "text", "__row"]
    placed = source.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(*order)
    ended = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    staged = stage_table(
        placed.sortWithinPartitions(*order).select(
            "conv_id", "turn", "role", "text",
            F.monotonically_increasing_id().alias("pos"),
            F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("said"),
            F.substring("role", 1, 1).alias("initial"),
            (ended == "").alias("blank"),
            (~ended.isin(".", "!", "?")).alias("truncated"),
        ),
        "turns",
    )
    narrow = staged.select("conv_id", "pos", "said", "initial", "blank", "truncated")
    again = narrow.groupBy("conv_id", "said").agg(F.min("pos").alias("__first"), F.count(F.lit(1)).alias("__times"))
    again = again.filter("__times > 1").select(F.col("conv_id").alias("__conv"), F.col("said").alias("__said"), "__first")
    told = narrow.join(
        again, narrow["conv_id"].eqNullSafe(again["__conv"]) & (narrow["said"] == again["__said"]), "left"
    )
    duplicate = F.coalesce(F.col("pos") > F.col("__first"), F.lit(False))
    letter = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    symbol = F.when(F.col("blank") | duplicate, "x").when(F.col("truncated"), F.upper(letter)).otherwise(letter)
    block = F.shiftright("pos", CHUNK_BITS)
    chunks = told.select("conv_id", "pos", block.alias("block"), symbol.alias("symbol")).groupBy("conv_id", "block")
    turns = F.sort_array(F.collect_list(F.struct("pos", "symbol")))
    spelled = chunks.agg(F.array_join(turns["symbol"], "").alias("symbols"))
    lead = F.expr("lead(block) OVER (PARTITION BY conv_id ORDER BY block)")
    settled = converge(spelled.select("conv_id", "block", lead.alias("following"), "symbols"))

    def missing(name: str, kind: str) -> Column:
        return F.lit(None).cast(kind).alias(name)

    heads = settled.select(
        "conv_id", "block", F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("pos"), missing("turn", "long"),
        missing("role", "string"), missing("text", "string"), missing("blank", "boolean"), "symbols", "vectors",
    )
    bodies = staged.select(
        "conv_id", block.alias("block"), F.lit(1).alias("kind"), "pos", "turn", "role", "text", "blank",
        missing("symbols", "string"), missing("vectors", "binary"),
    )
    stream = heads.unionAll(bodies).repartition("conv_id").sortWithinPartitions("conv_id", "block", "kind", "pos")
    return stream.mapInArrow(_repair, _EDITS.format(kind=rows.schema[conversation].dataType.simpleString()))


def damage_conversations(rows: DataFrame) -> DataFrame:
    """Rows with the faults that CRC-32 of ``conv_id:turn`` modulo 20 deals out; nulls count as a space."""
    space = F.lit(" ")
    key = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    dealt = rows.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
        (F.crc32(F.concat(key[0], F.lit(":"), key[1])) % 20).alias("dealt"),
    ).filter("dealt != 0")
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("dealt") == 3, 2).otherwise(1)))
    text = F.when(F.col("dealt") == 1, "").when(F.col("dealt") == 2, F.regexp_replace("text", "[.!?]", ""))
    return dealt.select(
        "conv_id", "turn", F.when(F.col("dealt") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"), times.alias("time"),
    ).drop("time")


_REPORT = (
    "conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


class _Report:
    """Running figures of one conversation's edits."""

    def __init__(self, conversation):
        self.conversation = conversation
        self.turns: list[int] = []  # first, last, number of different ones
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal = self.cost = 0
        self.before = None
        self.audit = io.StringIO()
        self.digest, self.empty = hashlib.sha256(), True

    def add(self, edit: str, fault: str, turn: int, role: str, text: str, source_role: str, cost: int) -> None:
        self.audit.write(edit)
        self.cost += cost
        if edit != "D":
            self.digest.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
            self.empty = False
        if edit == "I":
            return
        if fault:
            self.faults[fault] += 1
        if self.before is not None and self.before + source_role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = source_role[:1]
        if turn is not None:
            if not self.turns:
                self.turns = [turn, turn, 1]
            elif turn != self.turns[1]:
                self.turns[1:] = [turn, self.turns[2] + 1]

    def row(self) -> tuple:
        gaps = self.turns[1] - self.turns[0] + 1 - self.turns[2] if self.turns else 0
        return (self.conversation, gaps, *self.faults.values(), self.illegal, self.cost, self.audit.getvalue(),
                self.digest.hexdigest())


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    report, kind = None, pa.null()

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        names = [t.split()[0] for t in _REPORT.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    for edits in batches:
        kind, done = edits.column(0).type, []
        for conversation, step_, *values in zip(*[c.to_pylist() for c in edits.columns]):
            if step_ == 0:
                if report:
                    done.append(report.row())
                report = _Report(conversation)
            report.add(*values)
        if done:
            yield batch(done)
    if report:
        yield batch([report.row()])


def report_repairs(edits: DataFrame) -> DataFrame:
    """Figures of every conversation of a table as ``repair_conversations`` returns it, as it comes.

    Texts go through a digest as a stream; of a conversation only its letters are held.
    """
    return edits.mapInArrow(_reports, _REPORT.format(kind=edits.schema["conv_id"].dataType.simpleString()))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by a rule and repaired: faults, cost and letters of the edits, digest."""
    small_batches(spark)
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return repair_damaged(rows)


def repair_damaged(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows``; one that has no rows left after the damage has no faults."""
    found = report_repairs(repair_conversations(damage_conversations(rows)))
    ids = rows.select(F.col("conv_id").alias("__conv")).distinct()
    joined = ids.join(found, ids["__conv"].eqNullSafe(found["conv_id"]), "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(
        F.col("__conv").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
