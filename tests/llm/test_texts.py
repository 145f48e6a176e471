"""Operators on documents against plain versions, with odd rows."""

import base64
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from oncolake.llm import byte_bpe, decontaminate, minhash, pii, quality, suffixes, viterbi

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, key string, n_bytes int"


def rows(spark, texts):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, None, None, None, 1.0, "k", 2) for i, t in texts], SCHEMA)


def odd_texts():
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(1, 8)))
    base = [" ".join(word() for _ in range(rnd.randrange(30, 120))) for _ in range(6)]
    texts = [(0, None), (1, ""), (2, " \n "), (3, "one"), (4, "two words"), (None, base[0]), (None, None)]
    for i in range(5, 60):
        words = rnd.choice(base).split()
        for _ in range(rnd.choice([0, 0, 1, 3, 20])):
            words[rnd.randrange(len(words))] = word()
        texts.append((i, " ".join(words)))
    texts += [(60, "x" * 60_000), (61, "long text of words " * 4000), (62, texts[20][1]), (63, texts[21][1].upper())]
    texts += [texts[25], texts[26]]  # repeated rows
    return texts


def shingles(text, size):
    table = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(table))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def near_groups(texts, percent, size):
    sets = {}
    for i, t in texts:
        if i is not None and len(shingles(t, size)) >= len(sets.get(i, ())):
            sets[i] = shingles(t, size)
    least = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    return sets, least


@pytest.mark.parametrize("percent,size", [(85, 3), (80, 5)])
def test_near_duplicates(spark, percent, size):
    texts = odd_texts()
    sets, least = near_groups(texts, percent, size)
    found = minhash.near_duplicates(rows(spark, texts), percent, size).collect()
    assert len(found) == len(texts)
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), least[r.doc_id])
            assert r.kept == (r.doc_id == r.component_id)


def test_keep_one_of_each(spark):
    texts = odd_texts()
    _, least = near_groups(texts, 80, 5)
    kept = minhash.keep_one_of_each(rows(spark, texts))
    assert kept.columns == rows(spark, texts).columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(i for i in least if least[i] == i)
    assert ids.count(None) == 2


def test_near_duplicates_of_a_large_similar_group(spark):
    """Members that miss the pivot but are linked with others are found in the second step."""
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(150):
        words = list(base)
        for _ in range(rnd.choice([2, 3, 4, 5])):
            words[rnd.randrange(120)] = rnd.choice(["p", "q", "r"])
        texts.append((i, " ".join(words)))
    _, least = near_groups(texts, 80, 5)
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(rows(spark, texts)).collect()}
    assert found == least


def brute_cut(texts, length=50):
    first = {}
    for i, t in sorted((x for x in texts if x[0] is not None), key=lambda x: x[0]):
        data = (t or "").encode()
        for at in range(len(data) - length + 1):
            first.setdefault(data[at : at + length], i)
    out = []
    for i, t in texts:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            if i is not None and first[data[at : at + length]] < i:
                gone[at : at + length] = b"\1" * length
        kept = bytes(x for x, y in zip(data, gone) if not y)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (not k or not gone[k - 1]))
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_cut_repeated(spark):
    texts = odd_texts() + [(70, "a" * 700), (71, "a" * 400 + "b"), (72, "\0" * 120), (73, "\0" * 80)]
    found = suffixes.cut_repeated(rows(spark, texts).repartition(3), run_bytes=6000, bucket_bytes=30_000).collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == brute_cut(texts)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in found)


def test_loser_tree_knows_shared_lengths():
    rnd = random.Random(2)
    runs = [sorted(bytes(rnd.choice(b"ab") for _ in range(6)) for _ in range(rnd.randrange(0, 30))) for _ in range(5)]
    same = lambda a, b: next((i for i in range(6) if a[i] != b[i]), 6)
    given = [([int.from_bytes(x, "big") for x in run], [0] + [same(a, b) for a, b in zip(run, run[1:])]) for run in runs]
    out = list(suffixes.LoserTree(given, 6).merge())
    merged = [runs[r][i] for r, i, _ in out]
    assert merged == sorted(x for run in runs for x in run)
    assert [s for *_, s in out[1:]] == [same(a, b) for a, b in zip(merged, merged[1:])]


def test_byte_bpe_equals_the_library(spark):
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    texts = odd_texts() + [(80, "it's 12345 中文 ß\u0000 \n\n  \t end<|endoftext|>  ")]
    found = byte_bpe.encode_documents(rows(spark, texts), *byte_bpe.multi_50k()).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode_ordinary(r.text or "")
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(r.ids).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_rank_queue_order():
    queue = byte_bpe.RankQueue(1000)
    for rank, position in [(999, 1), (5, 9), (5, 2), (64, 0)]:
        queue.push(rank, position)
    assert [queue.pop() for _ in range(5)] == [(5, 2), (5, 9), (64, 0), (999, 1), None]


def test_token_counts_equal_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer, models

    vocabulary, known = viterbi.piece_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    least = min(s for _, s in vocabulary)
    entries = [("<unk>", 0.0), *vocabulary, *((f"<0x{i:02X}>", least) for i in range(256))]
    library = Tokenizer(models.Unigram(entries, 0, True))
    texts = odd_texts() + [(80, "  two  spaces\n\tand 中😀 | ▁▁ x")]
    found = viterbi.count_tokens(rows(spark, texts), vocabulary, known).collect()
    for r in found:
        seen = "▁" + r.text.replace(" ", "▁") if r.text else ""
        assert r.n_tokens == (len(library.encode(seen).ids) if seen else 0)


def brute_distance(passage, text):
    before = [0] * (len(text) + 1)
    for i, c in enumerate(passage, 1):
        row = [i]
        for j, d in enumerate(text, 1):
            row.append(min(before[j - 1] + (c != d), before[j] + 1, row[j - 1] + 1))
        before = row
    return min(before)


def test_leaks_equal_plain_alignment(spark):
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdefg") for _ in range(rnd.randrange(2, 8)))
    items = [(i, " ".join(word() for _ in range(rnd.randrange(6, 70)))) for i in range(8)]
    texts = []
    for i in range(60):
        leak = list(rnd.choice(items)[1])
        for _ in range(rnd.choice([0, 1, 3, 6, 12])):
            leak[rnd.randrange(len(leak))] = rnd.choice(["", "x", "yz"])
        texts.append((i, " ".join(word() for _ in range(40)) + ". " + "".join(leak).upper() + "! " + word()))
    texts += odd_texts()[:7]
    benchmark = spark.createDataFrame(items + [(90, None), (91, ""), (92, "short"), items[0]], "item_id long, text string")
    documents = rows(spark, texts)
    index = decontaminate.PassageIndex(items)
    norm = lambda t: decontaminate.normalize(pa.array([t or ""]))[0].tobytes()
    for size in (1 << 20, 300):  # one block, several blocks
        found = decontaminate.find_leaks(documents, benchmark, block_bytes=size).collect()
        assert len(found) == len(texts)
        for r in found:
            want = {index.items[p] for p, passage in enumerate(index.passages)
                    if brute_distance(passage.tobytes(), norm(r.text)) <= index.budget[p]}
            assert {x.item_id for x in r.leaks} == want


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def base_spans(text):
    def luhn(d):
        return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0

    out = []
    for kind, pattern in BASE:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": all(int(p) < 256 for p in m.group().split(".")) if kind == "ip" else 0,
                    "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def test_pii_base_spans_and_redaction(spark):
    texts = odd_texts() + [
        (100, "a@b.c_d@e.f x@y x@y.z."), (101, "1.2.3.4.5.6.7.8 300.1.1.1 000.0.0.255"),
        (102, "é 4111 1111 1111 1111 é +1 (017) 555-7713 1" + "2" * 5000), (103, "+1(((( +++1234567 😀 +49 30 1234567"),
        (104, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" end'),
    ]
    documents = rows(spark, texts)
    model = pii.fit_pii(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    found = pii.redact(pii.find_pii(documents, model).withColumn("raw", F.col("text"))).collect()
    assert len(found) == len(texts)
    for r in found:
        assert [(s.kind, s.start, s.end) for s in r.pii if s.base] == base_spans(r.raw)
        assert base_spans(r.text) == []
        if not r.pii:
            assert r.text == r.raw
    assert any(s.kind == "secret" for r in found for s in r.pii)
    empty = documents.filter("false")
    assert pii.find_pii(empty, pii.fit_pii(empty)).count() == 0


def test_quality(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.fit_quality(documents, labels)
    scored = quality.score_quality(rows(spark, odd_texts()), model)
    assert scored.columns.count("score") == 1
    found = scored.collect()
    assert len(found) == len(odd_texts()) and all(0 <= r.score <= 1 for r in found)
    held = quality.score_quality(documents, model).join(labels, "doc_id").filter(quality.held_out())
    rate = held.select(F.avg(((F.col("score") >= 0.3).cast("int") == F.col("quality")).cast("int"))).first()[0]
    assert rate > 0.95
    none = quality.fit_quality(documents, labels.filter("false"))
    assert {r.score for r in quality.score_quality(rows(spark, odd_texts()), none).collect()} == {0.5}


def test_empty_tables(spark):
    none = rows(spark, []).filter("false")
    assert minhash.near_duplicates(none).count() == 0
    assert suffixes.cut_repeated(none).count() == 0
    assert byte_bpe.encode_documents(none, *byte_bpe.multi_50k()).count() == 0
    assert viterbi.count_tokens(none, (("a", -1.0),), False).count() == 0
    assert decontaminate.find_leaks(none, spark.createDataFrame([], "item_id long, text string")).count() == 0


def disguised(spark, count=60, filler="word und mot "):
    """Documents with base cases and, as often, cases of the same kinds that no base rule matches."""
    rnd = random.Random(9)
    digits = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    texts = []
    for i in range(count):
        a, b, c = "2" + digits(2), digits(3), digits(4)
        texts.append((4 * i, f"{filler}+1 ({a}) {b}-{c} {filler} mia.{digits(2)}@mail{i % 9}.example.com {filler}"))
        texts.append((4 * i + 1, f"{filler}({b}) {a}-{c} {filler} leo{digits(2)} (at) mail{i % 9} (dot) org {filler}"))
        texts.append((4 * i + 2, f"{filler}{a}-{b}-{c} {filler} {digits(8)} {filler} 9807915762804490 {filler}"))
        texts.append((4 * i + 3, f'{filler}4111.1111.1111.1111 {filler} token = "{digits(12)}abcdef{digits(12)}" {filler}'))
    return rows(spark, texts)


@pytest.mark.parametrize("with_base", [True, False])
def test_pii_finds_cases_that_no_base_rule_matches(spark, with_base):
    documents = disguised(spark)
    if not with_base:
        documents = documents.filter("doc_id % 4 > 0")
    found = pii.redact(pii.find_pii(documents, pii.fit_pii(documents))).collect()
    for r in found:
        left = re.sub(r"\[[A-Z]+\]|word und mot|token =|\"", "", r.text).split()
        # Phones, addresses, cards and secrets are gone; other numbers stay.
        want = ["[0-9]{8}", "9807915762804490"] if r.doc_id % 4 == 2 else []
        assert len(left) == len(want) and all(map(re.fullmatch, want, left)), r.text


def test_pii_looks_at_what_a_base_span_leaves_free(spark):
    documents = rows(spark, [(1, "from 192.168.17.10 743-555-3824 on"), (2, "+1 (202) 555-0143 x 743-555-3824")])
    model = pii.fit_pii(documents)
    found = {r.doc_id: r.text for r in pii.redact(pii.find_pii(documents, model)).collect()}
    assert found == {1: "from [IP] [NUMBER] on", 2: "[PHONE] x [NUMBER]"}


def test_stages_keep_columns_of_any_name(spark):
    """Nulls, empty and repeated rows, and extra columns with names that operators use themselves."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, "null id a@b.de", "de", "s", 14), (900001, None, None, None, None), (900002, "", "de", "s", 0), (900002, "", "de", "s", 0)],
        docs.schema,
    )
    extra = ["pii_email", "PII_free", "row", "score", "component_id", "n_tokens", "key", "x", "held_out", "features"]
    table = docs.unionByName(odd).select("*", *[F.lit(f"own {c}").alias(c) for c in extra])
    table = table.repartition(3).cache()
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, table, sf)
        assert out.columns == table.columns, name
        rows = out.collect()
        assert rows and all(r[c] == f"own {c}" for r in rows for c in extra), name
        assert stage(spark, table.filter("false"), sf).count() == 0, name
    masked = {r.doc_id: r.text for r in corpus_pipeline.pii_stage(spark, table, sf).collect()}
    assert "a@b.de" not in masked[None] and masked[900001] is None and masked[900002] == ""


def test_pii_is_fitted_on_all_documents(spark, monkeypatch):
    """Neither a limit nor a sample stands between the documents and the counts."""
    documents = spark.createDataFrame([(i, f"mail me: jane{i}@example.org, tel. +49 30 90{i:04d}") for i in range(40)], "doc_id long, text string")

    def refused(*_, **__):
        raise AssertionError("rows are left out")

    for name in ("limit", "sample", "sampleBy", "orderBy"):
        monkeypatch.setattr(type(documents), name, refused)
    assert pii.fit_pii(documents).threshold <= 1.1
