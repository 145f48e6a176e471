"""Identifiers: slugs, hashed resource ids and fallback chains."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# German letters are spelled out, not stripped.
GERMAN = {"ä": "ae", "ö": "oe", "ü": "ue", "ß": "ss", "Ä": "Ae", "Ö": "Oe", "Ü": "Ue"}


def _accent_table() -> tuple[str, str]:
    """Latin letters whose decomposition starts with a plain letter, and those plain letters."""
    marked, plain = [], []
    for point in range(0x00C0, 0x0250):
        letter = chr(point)
        base = unicodedata.normalize("NFKD", letter)
        if len(base) > 1 and base[0].isascii() and base[0].isalpha() and letter not in GERMAN:
            if all(unicodedata.combining(mark) for mark in base[1:]):
                marked.append(letter)
                plain.append(base[0])
    return "".join(marked), "".join(plain)


_MARKED, _PLAIN = _accent_table()


def nonblank(value: Column) -> Column:
    """The trimmed text, or null when nothing is left."""
    return F.nullif(F.trim(value), F.lit(""))


def first_nonblank(*values: Column) -> Column:
    """The first value that carries text."""
    return F.coalesce(*[F.when(F.trim(v) != "", v) for v in values])


def slugify(value: Column) -> Column:
    """Identifier-safe text: letter case kept, other runs become one dash, outer dashes go."""
    text = value
    for letter, spelled in GERMAN.items():
        text = F.replace(text, F.lit(letter), F.lit(spelled))
    text = F.translate(text, _MARKED, _PLAIN)
    text = F.regexp_replace(text, r"[^\x00-\x7F]+", "")
    text = F.regexp_replace(text, r"[^A-Za-z0-9_]+", "-")
    return F.regexp_replace(text, r"^-|-$", "")


def resource_id(system: Column | str, value: Column) -> Column:
    """SHA-256 hex of ``system|value``; null when the value is null."""
    system = F.lit(system) if isinstance(system, str) else system
    return F.sha2(F.concat(system, F.lit("|"), value), 256)


def text_hash(value: Column) -> Column:
    """SHA-256 hex of the UTF-8 text."""
    return F.sha2(value, 256)


def max_id(text: Column, prefix: str = "") -> Column:
    """``F.max`` of a text column; hashed ids after ``prefix`` go through the shuffle as bytes.

    Bytes have the order of their hex digits, so only the largest of either kind are compared as texts.
    """
    hashed = text.rlike(rf"^\Q{prefix}\E[0-9a-f]{{64}}\z")
    largest = F.max(F.when(hashed, F.unhex(F.right(text, F.lit(64)))))
    return F.greatest(F.concat(F.lit(prefix), F.lower(F.hex(largest))), F.max(F.when(~hashed, text)))


def packed(text: Column) -> Column:
    """A text as bytes, hashed ids and references to them (``Type/id``) in half the space; see ``unpacked``.

    Different texts give different bytes, null stays null. Hex digits of a hash are nothing that a shuffle's
    codec could make smaller. Bytes are looked at, as a pattern takes three times as long.
    """
    data, size = text.cast("binary"), F.octet_length(text)
    last = F.substring(data, size - 63, F.lit(64)).cast("string")
    digest = F.when(size >= 64, F.unhex(last))
    hashed = F.concat(F.lit(bytearray(b"\1")), digest, F.substring(data, F.lit(1), size - 64))
    return F.when(digest.isNotNull() & (F.lower(last) == last), hashed).otherwise(
        F.concat(F.lit(bytearray(b"\0")), data)
    )


def packed_reference(kind: str, data: Column) -> Column:
    """The packed reference ``Type/id`` of a packed id."""
    hashed = (F.substring(data, 1, 1) == F.lit(bytearray(b"\1"))) & (F.octet_length(data) == 33)
    return F.when(hashed, F.concat(data, F.lit(bytearray(f"{kind}/".encode())))).otherwise(
        packed(F.concat(F.lit(f"{kind}/"), unpacked(data)))
    )


def unpacked(data: Column) -> Column:
    """The text that ``packed`` was given."""
    kind = F.substring(data, 34, 1 << 30).cast("string")
    hashed = F.concat(kind, F.lower(F.hex(F.substring(data, 2, 32))))
    return F.when(F.substring(data, 1, 1) == F.lit(bytearray(b"\1")), hashed).otherwise(
        F.substring(data, 2, (1 << 31) - 1).cast("string")
    )
