"""Changelog semantics and consolidation of report versions (batch side)."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oncolake.operators.staging import number_parts, same_keys

COMPLETED, STARTED = "behandlungsende", "behandlungsbeginn"
STATUS_CHANGE, STATUS_REPORT = "statusaenderung", "statusmeldung"

# Therapy and course sections with their id and the reasons that win.
PREFERRED_REASONS = {
    "SYST": ("_SYST_ID", COMPLETED, STARTED),
    "ST": ("_ST_ID", COMPLETED, STARTED),
    "Verlauf": ("_Verlauf_ID", STATUS_CHANGE, STATUS_REPORT),
    "Tumorkonferenz": ("_Tumorkonferenz_ID", COMPLETED, STARTED),
}
# Position of a section in a consolidated report.
SECTION_RANK = {
    "Diagnose": 0,
    "OP": 0,
    "Tod": 0,
    "SYST": 1,
    "ST": 2,
    "Verlauf": 3,
    "Tumorkonferenz": 4,
    "Pathologie": 5,
}


def _columns(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(name) if isinstance(name, str) else name for name in names]


def pick_by_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], last: bool = True
) -> DataFrame:
    """One whole row per key: the last (or first) by ``order``, which should be a total order.

    An aggregate rather than a window: each task reduces its rows to one per key before the
    shuffle, so a hot key costs no more than any other.
    """
    chosen = F.max_by if last else F.min_by
    rest = [name for name in df.columns if name not in keys]
    picked = df.groupBy(*keys).agg(
        chosen(F.struct(*rest), F.struct(*_columns(order))).alias("__row")
    )
    return picked.select(*keys, "__row.*").select(*df.columns)


def rows_of_winners(df: DataFrame, winners: DataFrame, row: str) -> DataFrame:
    """The whole rows of some row ids, with further columns that ``winners`` brings.

    Winners are decided on narrow rows; only here are bodies read, and only columns that are used
    later on, as a join lets the scan be pruned and an aggregate over whole rows does not.
    """
    if winners.columns == [row]:
        return df.join(winners, row, "left_semi")
    named = winners.withColumnRenamed(row, "__row")
    return df.join(named, df[row] == named["__row"]).drop("__row")


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    deleted: Column | None = None,
) -> DataFrame:
    """Table view of a changelog: the newest record per key, keys whose newest record deletes go."""
    latest = pick_by_key(df, keys, order)
    return latest if deleted is None else latest.filter(~F.coalesce(deleted, F.lit(False)))


def key_by_patient(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Bring the rows of a patient together, spread by report so that no patient fills one task."""
    return df.repartition(*([partitions] if partitions else []), "patient_id", "report_id")


def retain_latest_version(
    df: DataFrame,
    keys: Sequence[str] = ("patient_id", "report_id"),
    order: Sequence[str | Column] = ("version", "export_id"),
    row: str | None = None,
) -> DataFrame:
    """Per patient and report id, the row with the highest version; the export id breaks ties.

    Rows with a null in a key are nobody's version: all of them stay. ``row`` names a column that
    identifies each row of a table that reads the same every time (a written one): then winners are
    decided on keys, order and row ids, and whole rows are fetched afterwards.
    """
    keyed = reduce(operator.and_, [F.col(key).isNotNull() for key in keys])
    if row is None:
        return pick_by_key(df.filter(keyed), keys, order).unionByName(df.filter(~keyed))
    own = F.when(~keyed, F.col(row))
    groups = df.groupBy(*keys, own.alias("__own"))
    winners = groups.agg(F.max_by(row, F.struct(*_columns(order))).alias(row)).select(row)
    return rows_of_winners(df, winners, row)


def first_report_of_message(df: DataFrame) -> DataFrame:
    """Only the first report of the first patient of each message."""
    return df.filter((F.col("patient_pos") == 0) & (F.col("report_pos") == 0))


def group_by_tumor(
    df: DataFrame, keys: Sequence[str] = ("patient_id", "tumor_id"), *aggregates: Column
) -> DataFrame:
    """One row per patient and tumour with its number of reports and any further aggregates."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("reports"), *aggregates)


def latest_master_data(
    df: DataFrame,
    keys: Sequence[str] = ("patient_id",),
    value: str = "master",
    order: Sequence[str | Column] = ("report_date", "report_id"),
) -> DataFrame:
    """The value carried by the newest report of each key."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*_columns(order))).alias(value))


def keep_all_events(df: DataFrame, is_event: Column | None = None) -> DataFrame:
    """Every diagnosis, surgery and death report; nothing is merged."""
    if is_event is None:
        report = F.col("report")
        is_event = (
            report["Diagnose"].isNotNull() | report["OP"].isNotNull() | report["Tod"].isNotNull()
        )
    return df.filter(is_event)


def reason_rank(reason: Column, primary: str, secondary: str) -> Column:
    """0 for the primary reason, 1 for the secondary one, 2 for any other or none."""
    reason = F.lower(reason)
    return F.when(reason == primary, 0).when(reason == secondary, 1).otherwise(2)


def prefer_by_reason(
    df: DataFrame,
    keys: Sequence[str],
    reason: Column,
    primary: str,
    secondary: str,
    tie: Sequence[str | Column],
) -> DataFrame:
    """Per key one row: the primary reason, else the secondary one, else any; ``tie`` decides."""
    rank = reason_rank(reason, primary.lower(), secondary.lower())
    return pick_by_key(df, keys, [rank, *_columns(tie)], last=False)


def _newest_first() -> list[Column]:
    age = -F.coalesce(F.datediff("report_date", F.lit("1900-01-01")), F.lit(0))
    return [age, F.col("report_id")]


def _preferred(section: str):
    def select(df: DataFrame) -> DataFrame:
        id_field, primary, secondary = PREFERRED_REASONS[section]
        part = F.col("report")[section]
        keyed = df.filter(part.isNotNull()).withColumn("therapy_id", part[id_field])
        return prefer_by_reason(
            keyed,
            ["patient_id", "tumor_id", "therapy_id"],
            F.col("report")[section]["Meldeanlass"],
            primary,
            secondary,
            _newest_first(),
        )

    select.__doc__ = f"Per {section} id of a tumour the report with the winning reason."
    return select


systemic_reports = _preferred("SYST")
radiotherapy_reports = _preferred("ST")
progress_reports = _preferred("Verlauf")
board_reports = _preferred("Tumorkonferenz")


def _selection_entries(include_pathology: bool) -> Column:
    """For each section a report carries the key under which it competes, and its preference."""
    report = F.col("report")
    entries = []
    for section, rank in SECTION_RANK.items():
        if section == "Pathologie" and not include_pathology:
            continue
        part = report[section]
        if section in PREFERRED_REASONS:
            id_field, primary, secondary = PREFERRED_REASONS[section]
            key, preference = part[id_field], reason_rank(part["Meldeanlass"], primary, secondary)
        else:
            key, preference = F.concat_ws("|", "report_id", "export_id"), F.lit(0)
        entry = F.struct(
            F.lit(section).alias("section"),
            F.lit(rank).alias("section_rank"),
            # An entry without an id is selected by its own report, not together with others.
            F.coalesce(key, F.concat(F.lit("?"), F.concat_ws("|", "report_id", "export_id"))).alias("selection_key"),
            preference.alias("preference"),
        )
        entries.append(F.when(part.isNotNull(), entry))
    return F.array_compact(F.array(*entries))


_COMPETING = ["patient_id", "tumor_id", "section", "selection_key"]


def consolidate_reports(df: DataFrame, include_pathology: bool = True, row: str | None = None) -> DataFrame:
    """The reports that make up each patient's and tumour's current picture.

    Diagnosis, surgery and death reports all stay; of a therapy, course or board the report with
    the winning reason stays. All rules are one aggregate: a report's selection key is its therapy
    id, or the report itself where every report stays. Adds ``section`` and ``section_rank``.

    ``row`` as in ``retain_latest_version``: winners are decided on narrow rows, reports fetched later.
    """
    entries = F.explode(_selection_entries(include_pathology))
    if row is not None:
        narrow = df.select(*_NARROW, row, entries.alias("__entry"))
        return rows_of_winners(df, _winning_entries(narrow, row).select(row, "section", "section_rank"), row)
    keyed = df.withColumn("__entry", entries).select(*df.columns, "__entry.*")
    picked = pick_by_key(keyed, _COMPETING, ["preference", *_newest_first()], last=False)
    return picked.drop("selection_key", "preference")


def rule_members() -> Column:
    """The report with no more than the rules of consolidation read: which sections it has, their ids and reasons."""
    report = F.col("report")
    members = []
    for section in SECTION_RANK:
        names = [PREFERRED_REASONS[section][0], "Meldeanlass"] if section in PREFERRED_REASONS else []
        kept = [report[section][name].alias(name) for name in names] or [F.lit(True).alias("given")]
        members.append(F.when(report[section].isNotNull(), F.struct(*kept)).alias(section))
    return F.when(report.isNotNull(), F.struct(*members)).alias("report")


_NARROW = ["patient_id", "tumor_id", "report_id", "export_id", "report_date"]


def _winning_entries(narrow: DataFrame, row: str) -> DataFrame:
    """One row per section of a patient's tumour and selection key: the report that wins."""
    keyed = narrow.select(*_NARROW, row, "__entry.*")
    order = F.struct("preference", *_newest_first())
    won = keyed.groupBy(*_COMPETING).agg(
        F.min_by(F.struct("report_id", "export_id", row, "section_rank"), order).alias("__won")
    )
    return won.select("patient_id", "tumor_id", "section", "__won.*")


def winning_reports(df: DataFrame, row: str = "row_id", include_pathology: bool = True) -> DataFrame:
    """Which reports ``retain_latest_version`` and ``consolidate_reports`` keep, decided on narrow rows.

    One row per winning section: ``patient_id, tumor_id, section, report_id, export_id, section_rank``
    and the report's row id. No report body is shuffled or sorted.
    """
    narrow = df.select(*_NARROW, "version", row, _selection_entries(include_pathology).alias("__entries"))
    own = F.when(F.col("patient_id").isNull() | F.col("report_id").isNull(), F.col(row))
    newest = narrow.groupBy("patient_id", "report_id", own.alias("__own")).agg(
        F.max_by(
            F.struct("tumor_id", "export_id", "report_date", row, "__entries"), F.struct("version", "export_id")
        ).alias("__new")
    )
    entries = newest.select("patient_id", "report_id", "__new.*").select(
        *_NARROW, row, F.explode("__entries").alias("__entry")
    )
    return _winning_entries(entries, row)


def current_reports(df: DataFrame, row: str = "row_id", include_pathology: bool = True) -> DataFrame:
    """The reports of ``winning_reports``, each fetched once per section it wins for.

    ``row`` must identify rows of a table that reads the same every time (a written one).
    """
    winners = winning_reports(df, row, include_pathology)
    return rows_of_winners(df, winners.select(row, "section", "section_rank"), row)


def merge_report_group(
    df: DataFrame,
    keys: Sequence[str],
    item: Column,
    order: Sequence[str | Column],
    header: dict[str, Column],
    header_order: Sequence[str | Column],
    max_rows: int | None = None,
) -> DataFrame:
    """One merged row per group: header values of the newest row and its items in fixed order.

    With ``max_rows`` a group becomes as many rows as it needs, each with that many items at most:
    ``part`` 0 holds the first items, part 1 the next ones. All carry the same header.
    """
    newest = F.struct(*_columns(header_order))
    values = [F.max_by(value, newest).alias(name) for name, value in header.items()]
    ordered = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(_columns(order))])
    if max_rows is None:
        pairs = F.sort_array(F.collect_list(F.struct(ordered.alias("order"), item.alias("item"))))
        whole = df.groupBy(*keys).agg(*values, pairs.alias("__items"))
        return whole.select(
            *keys, F.lit(0).alias("part"), *header,
            F.transform("__items", lambda pair: pair["item"]).alias("items"),
        )
    heads = df.groupBy(*keys).agg(*values)
    parted = number_parts(
        df.select(*keys, ordered.alias("__order"), item.alias("__item")),
        keys,
        ["__order"],
        max_rows,
    )
    lists = parted.groupBy(*keys, "part").agg(
        F.sort_array(F.collect_list(F.struct("__order", "__item"))).alias("__items")
    )
    merged = lists.join(heads, same_keys(lists, heads, keys))
    return merged.select(
        *[lists[key] for key in keys],
        "part",
        *header,
        F.transform("__items", lambda pair: pair["__item"]).alias("items"),
    )


def bundle_key(patient_id: Column, condition_id: Column) -> Column:
    """``Patient/<id> - Condition/<id>``, or only the patient; null for a blank patient id."""
    patient = F.concat(F.lit("Patient/"), F.nullif(F.trim(patient_id), F.lit("")))
    condition = F.concat(F.lit("Condition/"), condition_id)
    return F.when(patient.isNotNull(), F.concat_ws(" - ", patient, condition))
