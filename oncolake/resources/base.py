"""Shared parts of the mapping jobs: rows per report element and typed resource rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oncolake import schemas
from oncolake.config import MappingConfig
from oncolake.functions.codes import constant_or_column, make_coding, many, one, reference
from oncolake.functions.dates import report_partial_date
from oncolake.functions.ids import resource_id, slugify

# What a mapping job needs to know about the report a row comes from.
KEYS = [
    "patient_id",
    "patient_ref",
    "patient_identifier",
    "tumor_id",
    "report_id",
    "source_document",
    "rank_key",
    "condition_id",
    "condition_value",
]

# The order in which the jobs of a section emit resources; the condition always comes first.
EMIT_ORDER = {
    "Diagnose": (
        "performance metastases specimen course_histology grading lymph study genetics ctnm ptnm "
        "prostate classifications evidence earlier"
    ),
    "Verlauf": (
        "progress metastases performance specimen course_histology grading lymph study genetics tnm "
        "prostate classifications"
    ),
    "SYST": "systemic medication study adverse",
    "ST": "radiotherapy study adverse",
    "Tod": "deaths",
    "OP": (
        "surgeries residual specimen course_histology grading lymph study genetics tnm prostate"
    ),
    "Pathologie": (
        "specimen course_histology grading lymph metastases genetics ctnm ptnm prostate "
        "classifications report"
    ),
    "Tumorkonferenz": "board",
}
_SLOT = 1_000_000_000


def emit_base(section: str, job: str) -> int:
    """First ``emit_seq`` of a job within its section; single resources count on from there."""
    section_number = list(EMIT_ORDER).index(section) + 1
    return (section_number * 100 + EMIT_ORDER[section].split().index(job)) * _SLOT


def section(name: str, path: str = "") -> Column:
    """A part of the report, e.g. ``section("Diagnose", "Menge_FM.Fernmetastase")``."""
    column = F.col("report")[name]
    for field in filter(None, path.split(".")):
        column = column[field]
    return column


def rows_of(reports: DataFrame, job: str, items: dict[str, Column], context: dict[str, Column] | None = None) -> DataFrame:
    """One row per report and section that has the item: keys, ``section, seq, item``.

    A report rarely has two sections; all of them are looked at in one pass. ``context`` columns of
    the report are kept.
    """
    extra = [column.alias(name) for name, column in (context or {}).items()]
    if len(items) == 1:
        ((name, item),) = items.items()
        return reports.filter(item.isNotNull()).select(
            *KEYS, *extra, F.lit(name).alias("section"), F.lit(emit_base(name, job)).alias("seq"),
            item.alias("item"),
        )
    found = [
        F.when(
            item.isNotNull(),
            F.struct(F.lit(name).alias("section"), F.lit(emit_base(name, job)).alias("seq"), item.alias("item")),
        )
        for name, item in items.items()
    ]
    exploded = reports.select(*KEYS, *extra, F.explode(F.array_compact(F.array(*found))).alias("__row"))
    return exploded.select(*KEYS, *(context or {}), "__row.*")


def elements_of(reports: DataFrame, job: str, arrays: dict[str, Column], context: dict[str, Column] | None = None) -> DataFrame:
    """One row per array element: keys, ``section, seq, pos, item``; positions start at 0."""
    rows = rows_of(reports, job, arrays, context)
    return rows.select(
        *KEYS, *(context or {}), "section", "seq", F.posexplode("item").alias("pos", "item")
    ).withColumn("seq", F.col("seq") + F.col("pos"))


def typed(
    df: DataFrame,
    cfg: MappingConfig,
    fields: dict[str, str],
    resource_type: str,
    system: str | Column,
    value: Column,
    profile: str | Column,
    slug: bool = True,
    seq: Column | None = None,
    source_section: Column | None = None,
    **columns: Column,
) -> DataFrame:
    """A resource table: the common columns and the declared fields, missing ones null."""
    identifier = slugify(value) if slug else value
    system = F.lit(cfg.identifier_system(system)) if isinstance(system, str) else system
    have = set(df.columns)
    keyed = df.withColumn("__value", identifier)
    common = {
        "resource_type": F.lit(resource_type),
        "id": resource_id(system, F.col("__value")),
        "identifier_system": system,
        "identifier_value": F.col("__value"),
        "profile": profile if isinstance(profile, Column) else F.lit(profile),
        "emit_seq": seq if seq is not None else F.col("seq"),
        "source_section": source_section if source_section is not None else F.col("section"),
    }
    for name in KEYS[: KEYS.index("condition_id")]:
        common[name] = F.col(name) if name in have else None
    unknown = set(columns) - set(fields)
    if unknown:
        raise KeyError(f"no such fields of {resource_type}: {sorted(unknown)}")
    declared = [constant_or_column(n, kind, common[n]) for n, kind in schemas.COMMON.items()]
    declared += [constant_or_column(n, kind, columns.get(n)) for n, kind in fields.items()]
    return keyed.select(*declared)


def observations(
    df: DataFrame,
    cfg: MappingConfig,
    kind: str,
    system: str | Column,
    value: Column,
    profile: str | Column,
    focus: bool = True,
    **columns: Column,
) -> DataFrame:
    """Observation rows; the primary condition is their focus unless told otherwise."""
    if focus and "focus_refs" not in columns:
        columns["focus_refs"] = F.array_compact(F.array(reference("Condition", F.col("condition_id"))))
    seq = columns.pop("seq", None)
    return typed(
        df,
        cfg,
        schemas.OBSERVATIONS,
        "Observation",
        system,
        value,
        cfg.profile(profile) if isinstance(profile, str) else profile,
        seq=seq,
        kind=F.lit(kind),
        **columns,
    )


def effective_or_absent(element: Column) -> dict[str, Column]:
    """Effective date columns where the date must be given or marked unknown."""
    date = report_partial_date(element)
    return {"effective": date, "effective_absent": F.when(date.isNull(), F.lit("unknown"))}


def concept(cfg: MappingConfig, code_list: str, code: Column, display: Column | None = None) -> Column:
    """A list with one coding of an oncology code list, null for a null code."""
    return one(make_coding(cfg.code_system(code_list), code, display), code.isNotNull())


__all__ = [
    "KEYS",
    "concept",
    "effective_or_absent",
    "elements_of",
    "emit_base",
    "many",
    "observations",
    "one",
    "rows_of",
    "section",
    "typed",
]
