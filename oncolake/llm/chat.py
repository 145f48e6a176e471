"""Chat formatting with a grammar round trip, in built-in functions only.

    conversation = turn*
    turn         = "<s>" ["[INST]" role] "[/INST]" text "</s>"

Roles and texts hold no control string. A conversation is rendered as it is, parsed again and
compared with its source; where the two differ it is rendered with escapes. An escape puts one more
backslash behind the bracket of whatever looks like a control string with any number of backslashes;
the parser takes one away, so escaping loses nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BEGIN, ROLE, TEXT, END = "<s>", "[INST]", "[/INST]", "</s>"
CONTROL = r"[<\[]/?(?:s>|INST\])"
LIKE = r"([<\[])(\\*)(/?(?:s>|INST\]))"
ESCAPED = r"([<\[])\\(\\*)(/?(?:s>|INST\]))"

_TURNS = "array<struct<role:string,text:string>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, LIKE, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def render(turns: Column, escaped: bool) -> Column:
    """The text of an array of (role, text)."""
    write = escape if escaped else lambda text: text

    def turn(t: Column) -> Column:
        role = F.when(t["role"].isNull(), F.lit("")).otherwise(F.concat(F.lit(ROLE), write(t["role"])))
        return F.concat(F.lit(BEGIN), role, F.lit(TEXT), write(t["text"]), F.lit(END))

    return F.array_join(F.transform(turns, turn), "")


def parse(formatted: Column) -> Column:
    """The turns of a rendered conversation; null if it is not a sentence of the grammar."""
    parts = F.split(formatted, END, -1)
    parts = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))

    def raw(part: Column) -> Column:
        body = F.substring(part, F.lit(len(BEGIN) + 1), F.length(part))
        named = F.startswith(body, F.lit(ROLE))
        head = F.substring_index(body, TEXT, 1)
        role = F.when(named, F.substring(head, F.lit(len(ROLE) + 1), F.length(head)))
        return F.struct(
            F.startswith(part, F.lit(BEGIN)).alias("begun"),
            (named | (head == "")).alias("headed"),
            role.alias("role"),
            F.substring(body, F.length(head) + len(TEXT) + 1, F.length(body)).alias("text"),
        )

    read = F.transform(parts, raw)
    legal = F.forall(
        read,
        lambda t: t["begun"] & t["headed"] & ~F.coalesce(t["role"], F.lit("")).rlike(CONTROL)
        & ~t["text"].rlike(CONTROL),
    )
    plain = F.transform(
        read, lambda t: F.struct(unescape(t["role"]).alias("role"), unescape(t["text"]).alias("text"))
    )
    return F.when(legal & ((formatted == "") | F.endswith(formatted, F.lit(END))), plain)


def loss_spans(formatted: Column, trained: str = "assistant") -> Column:
    """Where the texts of a role stand in a rendered conversation: array of (start, end)."""
    parts = F.split(formatted, END, -1)
    kind = "struct<at:int,out:array<struct<start:int,end:int>>>"
    head = F.lit(BEGIN + ROLE + trained + TEXT)

    def step(state: Column, part: Column) -> Column:
        end = state["at"] + F.length(part)
        span = F.struct((state["at"] + F.length(head)).alias("start"), end.alias("end"))
        out = F.when(F.startswith(part, head), F.concat(state["out"], F.array(span))).otherwise(state["out"])
        return F.struct((end + len(END)).alias("at"), out.alias("out")).cast(kind)

    empty = F.struct(F.lit(0).alias("at"), F.array().alias("out")).cast(kind)
    return F.aggregate(parts, empty, step, lambda state: state["out"])


def format_conversations(
    rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: its id, ``formatted``, ``escaped`` and ``identical``.

    Turns are ordered by ``turn``, null first, ties by role and text; repeated rows are repeated
    turns. A null text counts as empty, a null role has no role part, rows of a null id are one
    conversation. Other columns are not read. ``identical`` tells that the parsed text equals the
    source; it holds by construction. A conversation is one value, so its turns meet in one row.
    """
    source = rows.groupBy(F.col(conversation).alias("conv_id")).agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.col(turn).alias("turn"),
                    F.col(role).alias("role"),
                    F.coalesce(F.col(text), F.lit("")).alias("text"),
                )
            )
        ).alias("turns")
    )
    turns = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    source = source.select("conv_id", turns.cast(_TURNS).alias("source"))
    first = source.withColumn("plain", render(F.col("source"), False))
    first = first.withColumn("same", F.coalesce(parse(F.col("plain")) == F.col("source"), F.lit(False)))
    chosen = first.withColumn("formatted", F.when(F.col("same"), F.col("plain")).otherwise(
        render(F.col("source"), True)
    ))
    again = F.col("same") | F.coalesce(parse(F.col("formatted")) == F.col("source"), F.lit(False))
    return chosen.select("conv_id", "formatted", (~F.col("same")).alias("escaped"), again.alias("identical"))


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one of control strings only: digests read back from its rendering."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    formatted = format_conversations(rows.unionAll(probe))
    read = formatted.withColumn("turns", parse(F.col("formatted")))
    whole = F.array_join(
        F.transform(
            "turns", lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n"))
        ),
        "",
    )
    trained = F.filter("turns", lambda t: F.coalesce(t["role"] == "assistant", F.lit(False)))
    loss = F.array_join(F.transform(trained, lambda t: t["text"]), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "escaped",
        "identical",
    )


OP1_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), measured AS (
  SELECT *, len(regexp_extract_all(coalesce(role, ''), '[<\[]\\*/?(s>|INST\])'))
          + len(regexp_extract_all(text, '[<\[]\\*/?(s>|INST\])')) AS controls
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(CASE WHEN role IS NULL THEN 14 ELSE 20 + length(role) END + length(text) + controls) AS BIGINT)
    AS formatted_chars,
  bool_or(controls > 0) AS escaped, true AS identical
FROM measured GROUP BY conv_id
"""
