"""Personal data: overlapping candidate spans, scored by boosted trees, redacted above a threshold.

Everything that sees a text is a built-in column function. Base spans (``BASE``) are exact rules and
always stay. Wider generators propose further spans in the text that these leave free; trees over format
and context features score them, and a threshold calibrated on the training cells selects. The trees
learn from copies of base matches whose giveaway is hidden, since that is what is left to be found.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oncolake.llm import boosting

# The base rules. Quantifiers are possessive where what follows cannot match what they
# take, and a look-behind keeps a run from being tried again at each of its characters; both only
# save time. \G lets a match begin where the one before ended.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Generators of further candidates.
WIDE = {
    "email_like": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]{1,64}+ ?(?:\(at\)|\[at\]|@) ?"
                  r"[A-Za-z0-9-]{1,63}+(?: ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z0-9-]{1,63}+){1,8}+",
    "number_like": r"[(+]{0,2}[0-9](?:[ ().-]{0,2}[0-9]){6,}+",
    "secret": r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]{0,64}+[0-9])[A-Za-z0-9_/+-]{16,}+",
}
MARKS = {
    "email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]",
    "email_like": "[EMAIL]", "number_like": "[NUMBER]", "secret": "[SECRET]",
}
#: Share of the selected training candidates that have to be personal data.
PRECISION = 0.99
CONTEXT = 24
#: Stands for each character of a base span where the wide generators of ``FREE`` look; they match none.
FILLER = "\ufffc"
FREE = ("email_like", "number_like")
#: Fixed values that are fitted on with the documents, for tables without base spans of some kind or
#: without other numbers. They pass through the same rules as a document.
EXAMPLES = "\n".join([
    "jane.doe@example.org", "office@mail.example.co.uk", "contact: j_smith7@host-3.example.com",
    "+1 (202) 555-0143", "phone: +1 (743) 555-3824", "+44 20 7946 0958", "tel. +49 30 901820", "+33 1 23 45 67 89",
    "4111111111111111", "card: 5500005555555559",
    "1234567", "20240115", "123456789", "1234567890", "2024-01-15 10", "15.01.2024", "1 000 000", "12 500 000",
    "4111111111111112", "some-long-identifier-name-2", "path/to/some/file_name_07", "looked (at) it. Then",
] * 25)

FEATURES = (
    "kind length digits letters upper separators at dots groups octets luhn plus bracket hex "
    "cue_mail cue_phone cue_card cue_secret assigned quoted"
).split()


def spans(text: Column, pattern: str) -> Column:
    """Non-overlapping matches from the left: array of (start, end, match, before), code points.

    The text between matches gives their places: lengths of parts and matches are summed up.
    """
    parts = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.filter(
        F.zip_with(
            parts, found,
            lambda part, match: F.struct(
                F.length(part).alias("gap"), match.alias("match"), F.right(part, F.lit(CONTEXT)).alias("before")
            ),
        ),
        lambda pair: pair["match"].isNotNull(),
    )
    kind = "struct<at:int,out:array<struct<start:int,end:int,match:string,before:string>>>"
    empty = F.struct(F.lit(0).alias("at"), F.array().alias("out")).cast(kind)

    def place(state: Column, pair: Column) -> Column:
        begin = state["at"] + pair["gap"]
        end = begin + F.length(pair["match"])
        span = F.struct(
            begin.alias("start"), end.alias("end"), pair["match"].alias("match"), pair["before"].alias("before")
        )
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out")).cast(kind)

    return F.aggregate(pairs, empty, place, lambda state: state["out"])


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check sum of a digit string is right."""
    each = F.transform(
        F.filter(F.split(F.reverse(digits), ""), lambda d: d != ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(each, F.lit(0), lambda total, d: total + d) % 10 == 0


def _holds(kind: str, span: Column) -> Column:
    """The test that a match of a base rule has to pass."""
    match = span["match"]
    digits = _digits(match)
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.length(digits).between(16, 19) & _luhn(F.substring(digits, 1, 19))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _may_match(kind: str, text: Column) -> Column:
    """A cheap test that every text with a match passes."""
    if kind == "email":
        return F.contains(text, F.lit("@"))
    if kind == "phone":
        return F.contains(text, F.lit("+"))
    if kind == "email_like":
        return F.contains(text, F.lit("@")) | F.contains(text, F.lit("at)")) | F.contains(text, F.lit("at]"))
    return text.rlike("[0-9]")


_SPAN = "array<struct<start:int,end:int,match:string,before:string>>"


def _overlaid(text: Column) -> Column:
    """The text with ``FILLER`` at every place of a base span; lengths and places stay."""
    kind = "struct<at:int,out:array<string>>"
    ordered = F.array_sort(
        F.concat(*[F.transform(f"pii_{k}", lambda s: F.struct(s["start"], s["end"])) for k in BASE])
    )

    def step(state: Column, span: Column) -> Column:
        begin, end = F.greatest(state["at"], span["start"]), F.greatest(state["at"], span["end"])
        before = F.substring(text, state["at"] + 1, begin - state["at"])
        added = F.array(before, F.repeat(F.lit(FILLER), F.greatest(end - begin, F.lit(0))))
        covered = span["end"] <= state["at"]
        out = F.when(covered, state["out"]).otherwise(F.concat(state["out"], added))
        return F.struct(end.alias("at"), out.alias("out")).cast(kind)

    done = F.aggregate(
        ordered,
        F.struct(F.lit(0).alias("at"), F.array().alias("out")).cast(kind),
        step,
        lambda state: F.concat(
            F.array_join(state["out"], ""), F.substring(text, state["at"] + 1, F.length(text))
        ),
    )
    return F.when(F.size(ordered) > 0, done).otherwise(text)


def with_candidates(documents: DataFrame, text: str = "text") -> DataFrame:
    """The rows with one array column of spans per kind: ``pii_email`` and so on; null text: empty.

    Numbers and addresses are proposed in what base spans leave free, secrets in the whole text.
    """
    whole = F.coalesce(F.col(text), F.lit(""))

    def found(kind: str, source: Column) -> Column:
        return F.when(_may_match(kind, source), spans(source, {**BASE, **WIDE}[kind])).otherwise(
            F.array().cast(_SPAN)
        )

    rows = documents.withColumns({f"pii_{kind}": found(kind, whole) for kind in BASE})
    # A base match that fails its test is dropped; what it covered is not tried again.
    rows = rows.withColumns({f"pii_{kind}": F.filter(f"pii_{kind}", partial(_holds, kind)) for kind in BASE})
    rows = rows.withColumn("pii_free", _overlaid(whole))
    return rows.withColumns(
        {f"pii_{kind}": found(kind, F.col("pii_free") if kind in FREE else whole) for kind in WIDE}
    ).drop("pii_free")


def _count(match: Column, wanted: str) -> Column:
    return F.length(F.regexp_replace(match, f"[^{wanted}]", ""))


def features(kind: str, span: Column) -> list[Column]:
    """Small whole numbers that describe a candidate's format and what stands before it."""
    match, before = span["match"], F.lower(span["before"])
    digits, shape = _digits(match), F.regexp_replace(match, "[A-Za-z0-9]+", "x")
    few = lambda column, top: F.least(column, F.lit(top)).cast("int")
    cue = lambda words: before.rlike(rf"(?:{words})[^a-z0-9]{{0,4}}$").cast("int")
    return [
        F.lit(list(WIDE).index(kind)),
        few(F.length(match), 48),
        few(F.length(digits), 24),
        few(_count(match, "A-Za-z"), 24),
        few(_count(match, "A-Z"), 8),
        few(_count(match, " ().-"), 8),
        match.rlike("@|[(\\[]at[)\\]]").cast("int"),
        few(_count(match, "."), 4),
        few(_count(shape, "x"), 6),
        match.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$").cast("int"),
        F.when(F.length(digits).between(12, 19), _luhn(digits).cast("int")).otherwise(0),
        F.contains(match, F.lit("+")).cast("int"),
        F.contains(match, F.lit("(")).cast("int"),
        match.rlike("^[0-9a-fA-F]+$").cast("int"),
        cue("mail|e-mail|contact|write"),
        cue("phone|tel|call|mobile|fax"),
        cue("card|visa|account|iban"),
        cue("token|secret|password|passwd|pwd|api[_ -]?key|key"),
        before.rlike("[=:] ?[\"']?$").cast("int"),
        before.rlike("[\"']$").cast("int"),
    ]


def _is_positive(kind: str, span: Column) -> Column:
    """Whether what stands before a training candidate names it."""
    before = F.lower(span["before"])
    if kind == "secret":
        return before.rlike(
            "(?:token|secret|password|passwd|pwd|api[_ -]?key)[a-z_]{0,8} ?[\"']? ?[=:] ?[\"']?$"
        )
    if kind == "number_like":
        # Bare digits after such a word may be any number.
        return before.rlike("(?:phone|tel|call|mobile|fax)[.:]{0,2} ?$") & _is_grouped(span["match"])
    return F.lit(False)


def _is_grouped(match: Column) -> Column:
    return match.rlike("[0-9][ ().-]+[0-9]+[ ().-]+[0-9]")


def _copies(kind: str, span: Column) -> Column:
    """Spans like a base span without what the base rule goes by: plus, @, the separators of cards."""
    match = span["match"]
    if kind == "email":
        name, host = F.substring_index(match, "@", 1), F.substring_index(match, "@", -1)
        ways = [(" (at) ", " (dot) "), ("(at)", "(dot)"), (" [at] ", " [dot] "), ("[at]", "[dot]"),
                (" (at) ", "."), ("(at)", "."), ("[at]", "."), (" @ ", ".")]
        texts = [F.concat(name, F.lit(at), F.replace(host, F.lit("."), F.lit(dot))) for at, dot in ways]
    elif kind == "phone":
        whole = F.substring(match, 2, 64)
        national = F.regexp_replace(match, r"^\+[0-9]{1,3}[ .-]+", "")
        flat = lambda x, mark: F.regexp_replace(F.regexp_replace(x, "^[^0-9]+", ""), "[ ().-]+", mark)
        texts = [whole, national, *[flat(x, mark) for x in (whole, national) for mark in "-. "]]
    else:
        texts = [F.regexp_replace(_digits(match), "([0-9]{4})(?=[0-9])", f"$1{mark}") for mark in (".", "  ")]
    wide = "email_like" if kind == "email" else "number_like"
    good = F.filter(F.array_distinct(F.array(*texts)), lambda x: x.rlike(f"^(?:{WIDE[wide]})$"))
    if kind != "email":  # bare digits could be any number
        good = F.filter(good, lambda x: ~F.contains(x, F.lit("+")) & _is_grouped(x))
    made = lambda x: F.struct(
        span["start"].alias("start"), span["end"].alias("end"), x.alias("match"), span["before"].alias("before")
    )
    return F.transform(F.transform(good, made), partial(_cell, wide, True))


#: Features that tell the format of a number, and the written forms of addresses that copies have.
_FORMAT = [FEATURES.index(name) for name in ("digits", "separators", "dots", "groups", "bracket")]
_HIDDEN_EMAIL = (r"^[^ (\[@]+(?: ?\(at\) ?| ?\[at\] ?| @ )[A-Za-z0-9-]+"
                 r"(?:(?: ?\(dot\) ?| ?\[dot\] ?|\.)[A-Za-z0-9-]+)+$")


def _cell(kind: str, made: bool, span: Column) -> Column:
    hidden = span["match"].rlike(_HIDDEN_EMAIL) if kind == "email_like" else F.lit(False)
    return F.struct(
        *[column.cast("int").alias(name) for name, column in zip(FEATURES, features(kind, span))],
        (F.lit(1) if made else _is_positive(kind, span).cast("int")).alias("label"),
        F.lit(int(made)).alias("made"), hidden.cast("int").alias("hidden"),
    )


def _unlabelled(cells: list, table: np.ndarray) -> np.ndarray:
    """Candidates without a label: no word names them, and they are written like a copy."""
    made = np.array([r["made"] for r in cells], bool)
    open_ = np.array([not r["made"] and not r["label"] for r in cells], bool)
    # The check sum tells cards (16 digits and more) from other long numbers.
    long = table[:, FEATURES.index("digits")] >= 16
    form = np.column_stack([table[:, [0, *_FORMAT]], table[:, FEATURES.index("luhn")] * long])
    numbers = form[:, 0] == list(WIDE).index("number_like")
    known = {tuple(row) for row in form[made & numbers].tolist()}
    same = np.array([tuple(row) in known for row in form.tolist()], bool) & numbers
    return open_ & (same | np.array([r["hidden"] for r in cells], bool))


@dataclass
class PiiModel:
    """Trees and the probability from which a candidate is personal data."""

    trees: boosting.Trees
    threshold: float


def fit_pii(documents: DataFrame, precision: float = PRECISION) -> PiiModel:
    """Fit the trees on the candidates of all documents.

    Labels are weak: copies of base spans without their giveaway, secrets after a naming word and
    grouped numbers after a word for phones are positive, other candidates outside base spans negative.
    Those written like a copy have no label and are left out, so that real cases do not
    count against their own form. ``EXAMPLES`` are added. Candidates of equal features are counted first, so the driver receives at most
    one cell per combination of small whole numbers, however many documents there are. The threshold is the smallest probability above which
    the share of positives reaches ``precision``, measured by trees fitted on the other half and on ``EXAMPLES``, which all fits have.
    """
    texts = documents.select("text", F.lit(0).alias("fixed"))
    fixed = documents.sparkSession.range(1).select(F.lit(EXAMPLES).alias("text"), F.lit(1).alias("fixed"))
    rows = with_candidates(texts.unionByName(fixed))
    proposed = [F.transform(F.filter(f"pii_{kind}", _outside), partial(_cell, kind, False)) for kind in WIDE]
    proposed += [F.flatten(F.transform(f"pii_{kind}", partial(_copies, kind))) for kind in ("email", "card", "phone")]
    cells = rows.select("fixed", F.explode(F.concat(*proposed)).alias("cell")).select("fixed", "cell.*")
    cells = cells.groupBy(*FEATURES, "label", "made", "hidden", "fixed").agg(F.count(F.lit(1)).alias("weight"))
    rows = cells.collect()
    table = np.array([[r[name] for name in FEATURES] for r in rows], float).reshape(len(rows), len(FEATURES))
    labelled = np.flatnonzero(~_unlabelled(rows, table))
    rows, table = [rows[i] for i in labelled], table[labelled]
    target = np.array([r["label"] for r in rows], float)
    weight = np.array([r["weight"] for r in rows], float)
    trees = boosting.fit(table, target, weight, trees=24, depth=3, rate=0.3, least=2.0)
    order = np.lexsort(table.T)
    fold = np.empty(len(rows), int)
    fold[order] = np.arange(len(rows)) % 2
    always = np.array([r["fixed"] for r in rows], bool)
    chance = np.empty(len(rows))
    for side in (0, 1):
        rest, own = (fold != side) | always, fold == side
        half = boosting.fit(table[rest], target[rest], weight[rest], trees=24, depth=3, rate=0.3, least=2.0)
        chance[own] = half.predict(table[own])
    rank = np.argsort(-chance, kind="stable")
    share = np.cumsum((weight * target)[rank]) / np.cumsum(weight[rank])
    last = np.append(np.diff(chance[rank]) != 0, True)
    good = np.flatnonzero(last & (share >= precision))
    threshold = max(0.5, float(chance[rank][good[-1]])) if len(good) else 1.1
    return PiiModel(trees, threshold)


def find_pii(documents: DataFrame, model: PiiModel, text: str = "text", name: str = "pii") -> DataFrame:
    """The rows with ``name``: array of (kind, start, end, base), by kind as listed, then start.

    Base spans first; a wide candidate is added if its score reaches the threshold and it does not lie
    within a base span. Null and empty texts have none. All other columns pass through, whatever their
    names: they are set aside as one struct while spans are found.
    """
    rows = documents.drop(name).select(F.struct("*").alias("row"), F.col(text).alias("text"))
    rows = with_candidates(rows)
    parts = [F.transform(f"pii_{kind}", partial(_row, kind, True)) for kind in BASE]
    for kind in WIDE:
        # Features once per candidate, then the trees over them.
        scored = F.transform(F.filter(f"pii_{kind}", _outside), partial(_measured, kind))
        chosen = F.filter(
            scored,
            lambda s: model.trees.as_column([F.get(s["x"], F.lit(i)) for i in range(len(FEATURES))])
            >= F.lit(model.threshold),
        )
        parts.append(F.transform(chosen, partial(_row, kind, False)))
    free = name
    while free.lower() in {"row", *(c.lower() for c in documents.columns)}:
        free += "_"
    spanned = rows.select("row", F.concat(*parts).alias(free))
    return spanned.select("row.*", F.col(free).alias(name))


def _outside(span: Column) -> Column:
    """No base span holds the whole candidate."""
    return ~reduce(
        lambda a, b: a | b,
        [F.exists(f"pii_{k}", lambda o: (o["start"] <= span["start"]) & (span["end"] <= o["end"])) for k in BASE],
    )


def _measured(kind: str, span: Column) -> Column:
    return F.struct(
        span["start"].alias("start"), span["end"].alias("end"),
        F.array(*[column.cast("int") for column in features(kind, span)]).alias("x"),
    )


def _row(kind: str, base: bool, span: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"), span["start"].alias("start"), span["end"].alias("end"), F.lit(base).alias("base")
    )


def redact(documents: DataFrame, pii: str = "pii", text: str = "text") -> DataFrame:
    """The text with a mark in place of every span of ``pii``; overlapping spans become one mark."""
    marks = F.create_map(*[F.lit(x) for pair in MARKS.items() for x in pair])
    ordered = F.array_sort(
        F.transform(pii, lambda s: F.struct(s["start"], (-s["end"]).alias("back"), s["end"], s["kind"]))
    )
    kind = "struct<at:int,out:array<string>>"
    whole = F.col(text)

    def step(state: Column, span: Column) -> Column:
        before = F.substring(whole, state["at"] + 1, span["start"] - state["at"])
        out = F.when(
            span["start"] >= state["at"],
            F.concat(state["out"], F.array(before, F.element_at(marks, span["kind"]))),
        ).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), out.alias("out")).cast(kind)

    done = F.aggregate(
        ordered,
        F.struct(F.lit(0).alias("at"), F.array().alias("out")).cast(kind),
        step,
        lambda state: F.concat(
            F.array_join(state["out"], ""),
            F.substring(whole, state["at"] + 1, F.length(whole)),
        ),
    )
    return documents.withColumn(text, F.when(F.size(pii) > 0, done).otherwise(F.col(text)))


def _listed(pii: Column) -> Column:
    return F.array_join(
        F.transform(pii, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data: counts and digest of the base spans, and all spans."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_pii(documents, fit_pii(documents))
    base = F.filter("pii", lambda s: s["base"])
    kinds = F.transform("pii", lambda s: s["kind"])
    counts = [
        F.size(F.filter(kinds, partial(operator.eq, kind))).cast("long").alias(f"n_{kind}") for kind in BASE
    ]
    return found.select(
        "doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("pii")).alias("spans")
    )
