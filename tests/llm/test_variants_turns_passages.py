"""Spelling variants, conversation repair and repeated passages against plain versions."""

import collections
import hashlib
import heapq
import random
import re
import zlib

import duckdb
import pytest

from oncolake.llm import passages, spelling, turns
from oncolake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# Spelling variants ----------------------------------------------------------------------------

def plain_words(rows):
    seen = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            seen[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 7 and n >= 2}


def plain_variants(words):
    without = collections.defaultdict(set)
    near = collections.defaultdict(set)
    for w in words:
        for i in range(len(w)):
            without[w[:i], w[i + 1 :]].add(w)
            if w[:i] + w[i + 1 :] in words:
                near[w].add(w[:i] + w[i + 1 :])
                near[w[:i] + w[i + 1 :]].add(w)
    for group in without.values():
        for w in group:
            near[w] |= group - {w}
    best = {w: min(near[w], key=lambda v: (-words[v], v)) for w in words if near[w]}
    form = {w: v for w, v in best.items() if words[v] >= 10 * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def variants(rows):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_spelling_query_equals_plain_version(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES["op11_spelling_variants"](spark, SF).collect()
    assert variants(found) == plain_variants(plain_words(rows))


@pytest.mark.parametrize("hot", [1, 6, 512])
def test_spelling_groups_equal_plain_version(spark, monkeypatch, hot):
    monkeypatch.setattr(spelling, "HOT", hot)
    monkeypatch.setattr(spelling, "ROWS", 64)
    monkeypatch.setattr(spelling, "CELLS", 512)
    rnd = random.Random(5)
    words = collections.Counter()
    for _ in range(700):  # many near words, repeated letters, empty and one-letter words, other scripts
        words["".join(rnd.choice("aabé\U0001f600") for _ in range(rnd.randrange(0, 7)))] += rnd.choice([1, 3, 40, 900])
    words["a" * 5000] += 2
    words["a" * 4999 + "b"] += 30
    words["a" * 5001] += 30
    rows = [(w, n, "x", 1) for w, n in words.items()] + [("aaab", 5, "y", 2), (None, 9, "z", 3), ("ab", None, "z", 4), ("ba", 0, "z", 5)]
    words["aaab"] += 5
    table = spark.createDataFrame(rows, "word string, n long, form string, id int")
    assert variants(spelling.group_spellings(table).collect()) == plain_variants(words)


def test_spelling_odd_rows(spark):
    schema = "doc_id long, text string, word string, n int"
    assert spelling.group_spellings(spelling.misspelt_words(spark.createDataFrame([], schema))).count() == 0
    long = "Straßenbahn " * 3000
    rows = [(None, "abcdefgh Abcdefgh", "w", 1), (1, None, "w", 1), (2, "", "w", 1), (3, long, "w", 1), (3, long, "w", 1)]
    table = spark.createDataFrame(rows, schema)
    found = spelling.group_spellings(spelling.misspelt_words(table)).collect()
    assert variants(found) == plain_variants(plain_words([r[:2] for r in rows]))
    with pytest.raises(ValueError):
        spelling.group_spellings(spelling.misspelt_words(table), times=1)


# Conversation repair --------------------------------------------------------------------------

def plain_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        dealt = zlib.crc32(key.encode()) % 20
        if dealt:
            text = "" if dealt == 1 else re.sub("[.!?]", "", text) if dealt == 2 else text
            own += [(turn, "user" if dealt == 4 else role, text)] * (2 if dealt == 3 else 1)
    return {c: sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, own in out.items()}


def plain_repair(rows):
    """A search over all edits by cost, then letters."""
    seen, faults = set(), []
    for _, role, text in rows:
        black = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not black else "duplicate" if (role, text) in seen
                      else "truncated" if black[-1] not in ".!?" else None)
        seen.add((role, text))
    marks = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(marks, marks[1:]))
    known = [r[0] for r in rows if r[0] is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, last, out = heapq.heappop(heap)
        if (i, last) in done:
            continue
        if i == len(rows) and last in ("", "a"):
            break
        done.add((i, last))

        def write(price, letter, ahead, role, text):
            mark = role[:1]
            if (mark == "s" and not last) or (mark == "u" and last in ("", "s", "a")) or (mark == "a" and last == "u"):
                heapq.heappush(heap, (cost + price, audit + letter, ahead, mark, (*out, f"{role}:{text}")))

        if i < len(rows):
            _, role, text = rows[i]
            fee = faults[i] == "truncated"
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last, out))
            if faults[i] not in ("blank", "duplicate"):
                write(fee, "K", i + 1, role, text)
                for other in ("user", "assistant"):
                    write(2 + fee, "R", i + 1, other, text)
        for other in ("user", "assistant"):
            write(2, "I", i, other, "")
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


def test_repair_query_equals_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = QUERIES["op12_conversation_repair"](spark, SF).collect()
    assert {r[0]: tuple(r[1:]) for r in found} == {c: plain_repair(own) for c, own in plain_damage(rows).items()}


@pytest.mark.parametrize("bits", [2, 14])
def test_repair_of_odd_conversations(spark, monkeypatch, bits):
    monkeypatch.setattr(turns, "CHUNK_BITS", bits)  # with 2, most conversations span several chunks
    rnd = random.Random(bits)
    texts = ["a.", "b", "", "c!", " ", None, "d? \n", "e..", "é\U0001f600", "zz?", "q!", "r."]
    roles = ["user", "assistant"] * 3 + ["system", "tool", None, ""]
    rows = [(None if conv % 30 == 0 else conv, rnd.choice([t, t, t, None, t + rnd.randrange(5)]), rnd.choice(roles),
             rnd.choice(texts), "x") for conv in range(90) for t in range(rnd.randrange(12))]
    rows += [(900, t, rnd.choice(["user", "assistant", "system"]), rnd.choice([f"{t}.", "", f"{t}"]), "x") for t in range(150)]
    rows += [(901, t, "user", "", "x") for t in range(25)] + [(902, 0, "user", "w" * 100_000, "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string")
    found = {r[0]: tuple(r[1:]) for r in turns.repair_damaged(table).collect()}
    assert found == {c: plain_repair(own) for c, own in plain_damage([r[:4] for r in rows]).items()}
    assert turns.repair_damaged(table.filter("false")).count() == 0


def test_stitched_costs_and_fix_up(spark):
    rnd = random.Random(8)
    symbols = "".join(rnd.choice(turns.SYMBOLS) for _ in range(400))
    vectors, total = turns.run_back(symbols, turns.END)
    guessed = turns.run_back(symbols, turns.GUESS)
    assert turns.run_back(symbols, turns.END, *guessed) == (vectors, total)
    chunks = [(7, i, i + 1 if i < 39 else None, symbols[10 * i : 10 * i + 10]) for i in range(40)]
    chunks += [(8, i, i + 1 if i < 4 else None, "x" * 5) for i in range(5)]  # only the last pass reaches the first
    table = spark.createDataFrame(chunks, "conv_id long, block long, following long, symbols string")
    found = turns.converge(table).collect()
    own = sorted((r for r in found if r.conv_id == 7), key=lambda r: r.block)
    assert b"".join(bytes(r.vectors)[:-4] for r in own) + bytes(own[-1].vectors)[-4:] == vectors
    assert sum(r.constant for r in own) == total
    state, cost = turns.NOTHING, 0
    for symbol, letters, after in turns.trace(symbols, vectors, state):
        cost += 2 * letters.count("I") + {"D": 3, "R": 2, "K": 0}[letters[-1]] + (letters[-1] != "D" and symbol.isupper())
        state = after
    assert cost + turns.END[state] == total + vectors[turns.NOTHING]
    assert all(bytes(r.vectors) == bytes(turns.END) * 6 for r in found if r.conv_id == 8)


def test_edits_are_whole_rows(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "user", "And"), (1, 2, "user", "So?")]
    edits = turns.repair_conversations(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"))
    found = [(r.edit, r.fault, r.role, r.text, r.source_role, r.cost) for r in edits.collect()]
    assert found == [("I", None, "user", "", None, 2), ("K", None, "assistant", "Hi.", "assistant", 0),
                     ("K", "truncated", "user", "And", "user", 1), ("R", None, "assistant", "So?", "user", 2)]


# Repeated passages ----------------------------------------------------------------------------

def plain_removed(texts, window):
    parts = [(t or "").encode().split() for t in texts]
    seen = collections.Counter(tuple(p[i : i + window]) for p in parts for i in range(len(p) - window + 1))
    out = []
    for p in parts:
        gone = set()
        for i in range(len(p) - window + 1):
            if seen[tuple(p[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(p), len(gone), b" ".join(w for i, w in enumerate(p) if i not in gone).decode()))
    return out


def test_passages_query_equals_plain_version_and_sql(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: (n, gone, hashlib.sha256(kept.encode()).hexdigest())
            for r, (n, gone, kept) in zip(rows, plain_removed([r.text for r in rows], passages.WINDOW))}
    found = QUERIES["op13_repeated_passages"](spark, SF).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert {r[0]: r[1:] for r in con.sql(passages.OP13_SQL).fetchall()} == want


@pytest.mark.parametrize("window,gram,size", [(5, 2, 100), (6, 1, 2000), (35, 6, 1 << 21)])
def test_passages_equal_plain_version(spark, monkeypatch, window, gram, size):
    monkeypatch.setattr(passages, "PACK_BYTES", size)
    monkeypatch.setattr(passages, "AUTOMATON_WORDS", 100)
    rnd = random.Random(window)
    text = lambda n, k: " ".join(rnd.choice("abcdefghijklmnopqrstuvwxyz"[:k]) for _ in range(n))
    shared = [text(60, 26), text(45, 26), text(window, 26), text(window - 1, 26)]
    texts = [None, "", " \t\n", "a", text(4000, 3), "b " * 500, "é x\x1cy " * 80]
    for i in range(150):
        kind = rnd.randrange(4)
        body = text(rnd.randrange(80), 26)
        if kind:
            one = rnd.choice(shared).split()
            cut = rnd.randrange(len(one))
            one = one if kind == 1 else one[cut:] if kind == 2 else one[:cut] + ["new"] + one[cut:]
            body = body + rnd.choice([" ", "\n", " \t "]) + " ".join(one) + " " + text(rnd.randrange(50), 26)
        texts.append(body)
    texts += texts[20:24]
    rows = [(rnd.choice([i, i, None]), t, i, "kept", 5) for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id long, text string, row int, kept string, shard int")
    found = passages.remove_passages(table, window=window, gram=gram)
    assert found.columns == ["doc_id", "text", "row", "shard", "n_words", "n_removed", "kept"]
    got = {r.row: (r.n_words, r.n_removed, r.kept) for r in found.collect()}
    assert got == dict(enumerate(plain_removed(texts, window)))
    assert passages.remove_passages(table.filter("false")).count() == 0


def test_automaton_decides(spark, monkeypatch):
    """Occurrences come from the automata: of two copies in a pack one place is told, and without automata none is found."""
    rows = [(i, " ".join(f"w{j}" for j in range(50))) for i in range(4)]
    table = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    packs = passages.pack_documents(table, "text")
    assert packs.count() == 1
    told = [(r.at, r.until) for r in passages.confirmed_places(packs, "text", 35, 6).collect()]
    assert told and all(until <= 50 for _, until in told)
    assert [r.kept for r in passages.remove_passages(table).sort("doc_id").collect()] == [""] * 4
    monkeypatch.setattr(passages.PassageFinder, "automata", lambda self: iter(()))
    assert not any(passages.PassageFinder([[b"a", b"b"]]).covered([[b"a", b"b"]])[0])


def test_matches_begin_and_end_with_words(monkeypatch):
    monkeypatch.setattr(passages, "DIGITS", 2)
    words = [str(i).encode() for i in range(100)]
    texts = [words, words[::-1], [*words[40:60], b"other", *words[60:80]], []]
    finder = passages.PassageFinder([words[i : i + 5] for i in range(0, 60, 3)] + [[]])
    assert finder.width == 6
    for text, covered in zip(texts, finder.covered(texts)):
        want = [False] * len(text)
        for i in range(len(text) - 4):
            if any(text[i : i + 5] == words[j : j + 5] for j in range(0, 60, 3)):
                want[i : i + 5] = [True] * 5
        assert covered.tolist() == want
