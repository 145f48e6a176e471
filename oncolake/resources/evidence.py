"""Ids of the observations a diagnosis report gives rise to, computed within the report row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from oncolake.config import MappingConfig
from oncolake.functions.ids import resource_id, slugify
from oncolake.resources.histology import LYMPH_NODE_COUNTS, base_value
from oncolake.resources.prostate import prostate_observation_ids
from oncolake.resources.tnm import grouping_id, id_base, member_id_list


def diagnosis_observation_ids(cfg: MappingConfig) -> Column:
    """All observation ids of a diagnosis section in emission order.

    Needs ``report`` and ``report_id``. The list is bounded by the report itself, so it is built in
    the row instead of collecting mapped resources.
    """
    diagnosis = F.col("report")["Diagnose"]
    report_id = F.col("report_id")

    def identifier(system: str, value: Column) -> Column:
        return resource_id(cfg.identifier_system(system), slugify(value))

    def single(present: Column, system: str, value: Column) -> Column:
        return F.array_compact(F.array(F.when(present.isNotNull(), identifier(system, value))))

    def listed(items: Column, make) -> Column:
        return F.coalesce(F.transform(items, make), F.array().cast("array<string>"))

    histology = diagnosis["Histologie"]
    base = base_value(histology, report_id)
    parts = [
        single(
            diagnosis["Allgemeiner_Leistungszustand"],
            "allgemeiner-leistungszustand-ecog-id",
            F.concat(F.lit("ECOG-"), report_id),
        ),
        listed(
            diagnosis["Menge_FM"]["Fernmetastase"],
            lambda _, i: identifier(
                "fernmetastasen-observation-id", F.concat_ws("-", report_id, F.lit("Diagnose"), i)
            ),
        ),
        single(histology["Grading"], "grading-observation-id", F.concat(base, F.lit("-grading"))),
        F.array_compact(
            F.array(
                *[
                    F.when(
                        histology[field].isNotNull(),
                        identifier(
                            "lymphknotenuntersuchung-observation-id", F.concat(base, F.lit(f"-{suffix}"))
                        ),
                    )
                    for field, suffix, *_ in LYMPH_NODE_COUNTS
                ]
            )
        ),
        single(
            diagnosis["Modul_Allgemein"]["Studienteilnahme"],
            "studienteilnahme-observation-id",
            F.concat(report_id, F.lit("-Studienteilnahme")),
        ),
        listed(
            diagnosis["Menge_Genetik"]["Genetische_Variante"],
            lambda g, i: identifier(
                "genetische-variante-observation-id",
                F.concat_ws(
                    "-", F.lit("GenetischeAusprägung"), F.lit("Diagnose"), report_id, g["Auspraegung"], i
                ),
            ),
        ),
    ]
    for field, kind in (("cTNM", "clinical"), ("pTNM", "pathologic")):
        tnm = diagnosis[field]
        tnm_base = id_base(tnm, histology, report_id, kind)
        both = F.array_append(member_id_list(cfg, tnm, tnm_base), grouping_id(cfg, tnm_base))
        parts.append(F.when(tnm.isNotNull(), both).otherwise(F.array().cast("array<string>")))
    module = diagnosis["Modul_Prostata"]
    parts.append(F.array_compact(F.array(*prostate_observation_ids(cfg, module, report_id))))
    parts.append(
        listed(
            diagnosis["Menge_Weitere_Klassifikation"]["Weitere_Klassifikation"],
            lambda c: identifier(
                "weitere-klassifikation-observation-id",
                F.concat_ws(
                    "-", report_id, c["Name"], F.substring(c["Datum"]["_VALUE"], 1, 10), c["Stadium"]
                ),
            ),
        )
    )
    return F.concat(*parts)
