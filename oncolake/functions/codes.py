"""Codings, quantities, references and absent markers as structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from oncolake import config as C
from oncolake.config import MappingConfig
from oncolake.schemas import CODINGS


def make_coding(
    system: str | Column | None,
    code: str | Column | None,
    display: str | Column | None = None,
    version: str | Column | None = None,
    user_selected: bool | None = None,
    code_absent: str | Column | None = None,
    version_absent: str | Column | None = None,
    ordinal: Column | None = None,
) -> Column:
    """One coding. Absent reasons stand in for a missing code or version."""
    members = [
        ("system", "string", system),
        ("version", "string", version),
        ("code", "string", code),
        ("display", "string", display),
        ("user_selected", "boolean", user_selected),
        ("code_absent", "string", code_absent),
        ("version_absent", "string", version_absent),
        ("ordinal", "decimal(18,6)", ordinal),
    ]
    if not any(isinstance(value, Column) for *_, value in members):
        fields = ", ".join(f"'{name}', {sql_literal(value, kind)}" for name, kind, value in members)
        return F.expr(f"named_struct({fields})")
    return F.struct(*[constant_or_column(name, kind, value) for name, kind, value in members])


def sql_literal(value, kind: str) -> str:
    """SQL text of a constant of a type; None gives a typed null."""
    if value is None:
        return f"CAST(NULL AS {kind})"
    if isinstance(value, bool):
        return str(value).lower()
    quoted = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{quoted}'"


def constant_or_column(name: str, kind: str, value) -> Column:
    """A named member; constants are given as SQL, which builds faster than nested calls."""
    if isinstance(value, Column):
        return value.cast(kind).alias(name)
    return F.expr(f"{sql_literal(value, kind)} AS {name}")


def snomed(cfg: MappingConfig, code, display=None, **more) -> Column:
    return make_coding(C.SNOMED, code, display, cfg.snomed_version, **more)


def loinc(cfg: MappingConfig, code, display=None) -> Column:
    return make_coding(C.LOINC, code, display, cfg.loinc_version)


def ops(cfg: MappingConfig, code, display=None) -> Column:
    return make_coding(C.OPS, code, display, cfg.ops_version)


def onco(cfg: MappingConfig, code_list: str, code, display=None) -> Column:
    """A coding of one of the oncology module's own code lists."""
    return make_coding(cfg.code_system(code_list), code, display)


def one(coding: Column, when: Column | None = None) -> Column:
    """A list with one coding, or null when the condition does not hold."""
    listed = F.array(coding).cast(CODINGS)
    return listed if when is None else F.when(when, listed)


def many(*codings: Column) -> Column:
    return F.array_compact(F.array(*codings)).cast(CODINGS)


def quantity(value: Column, unit: Column) -> Column:
    return F.when(
        value.isNotNull(),
        F.struct(value.cast("decimal(18,6)").alias("value"), unit.alias("unit")),
    )


def reference(kind: str, identifier: Column) -> Column:
    """``Type/id`` text; null when the id is null."""
    return F.concat(F.lit(f"{kind}/"), identifier)


def data_absent(reason: str | Column) -> Column:
    """The extension that says why a value is missing; null when there is no reason."""
    reason = F.lit(reason) if isinstance(reason, str) else reason
    return F.when(
        reason.isNotNull(),
        F.array(F.struct(F.lit(C.DATA_ABSENT_REASON).alias("url"), reason.alias("valueCode"))),
    )


def lookup(value: Column, table: dict[str, str]) -> Column:
    """Value of a short fixed table, null for an unknown key."""
    pairs = [F.lit(item) for pair in table.items() for item in pair]
    return F.try_element_at(F.create_map(*pairs), value)


def icd_coding(code: Column, version: Column) -> Column:
    """A diagnosis coding with the catalogue year, or a marker that the year is unknown."""
    from oncolake.functions.dates import icd_version_year

    year = icd_version_year(version)
    return make_coding(
        C.ICD10GM,
        code,
        version=year,
        version_absent=F.when(year.isNull(), F.lit("unknown")),
    )


def require_reference(ref: Column, kind: str, identifier: Column | None = None) -> Column:
    """Error text when a reference is missing or of another type, else null.

    A patient may be given by identifier alone.
    """
    wrong = F.concat(F.lit(f"reference must point to a {kind}: "), F.coalesce(ref, F.lit("none")))
    ok = F.coalesce(F.substring_index(ref, "/", 1) == kind, F.lit(False))
    if kind == "Patient" and identifier is not None:
        ok = ok | (ref.isNull() & F.coalesce(F.trim(identifier) != "", F.lit(False)))
    return F.when(~ok, wrong)
