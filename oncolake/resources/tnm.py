"""TNM staging: member observations and the grouping observation that lists them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oncolake import config as C
from oncolake.config import DEFAULT, MappingConfig
from oncolake.functions.clinical import tnm_suffixes, uicc_stage
from oncolake.functions.codes import make_coding, many, one
from oncolake.functions.dates import partial_date
from oncolake.functions.ids import first_nonblank, resource_id, slugify
from oncolake.resources.base import emit_base, observations, section

# Codes (SNOMED CT) of the three categories by prefix; other prefixes use the last.
CATEGORY_CODES = {
    "T": {
        "c": ("399504009", "cT category (observable entity)"),
        "u": ("399504009", "cT category (observable entity)"),
        "p": ("384625004", "pT category (observable entity)"),
        "": ("78873005", "T category (observable entity)"),
    },
    "N": {
        "c": ("399534004", "cN category (observable entity)"),
        "p": ("371494008", "pN category (observable entity)"),
        "": ("277206009", "N category (observable entity)"),
    },
    "M": {
        "c": ("399387003", "cM category (observable entity)"),
        "p": ("371497001", "pM category (observable entity)"),
        "": ("277208005", "M category (observable entity)"),
    },
}
# Other members as field, id suffix, profile, system, code, display and value code.
# A value code means the member states a fixed descriptor, none means it carries the reported text.
OTHER_MEMBERS = (
    ("a_Symbol", "a", "a-symbol", "loinc", "101660-9", "Cancer staging during autopsy",
     ("421426001", "Tumor staging descriptor a (tumor staging)")),
    ("m_Symbol", "m", "m-symbol", "loinc", "42030-7",
     "Multiple tumors reported as single primary Cancer", None),
    ("L", "L", "l-kategorie", "snomed", "395715009",
     "Status of lymphatic (small vessel) invasion by tumor (observable entity)", None),
    ("Pn", "Pn", "pn-kategorie", "snomed", "371513001",
     "Presence of direct invasion by primary malignant neoplasm to nerve (observable entity)", None),
    ("r_Symbol", "r", "r-symbol", "loinc", "101659-1", "Cancer staging after tumor recurrence",
     ("421188008", "Tumor staging descriptor r (tumor staging)")),
    ("S", "S", "s-kategorie", "snomed", "399424006",
     "Serum tumor marker category (observable entity)", None),
    ("V", "V", "v-kategorie", "snomed", "371493002",
     "Status of venous (large vessel) invasion by tumor (observable entity)", None),
    ("y_Symbol", "y", "y-symbol", "loinc", "101658-3", "Cancer staging after multimodality therapy",
     ("421755005", "Tumor staging descriptor y (tumor staging)")),
)
GROUPING_CODES = {
    "clinical": ("399537006", "Clinical TNM stage grouping"),
    "pathologic": ("399588009", "Pathologic TNM stage grouping"),
    "generic": ("399390009", "TNM stage grouping"),
}
# Section paths with the kind of staging and the emitting job.
SOURCES = (
    ("Diagnose", "cTNM", "clinical", "ctnm"),
    ("Diagnose", "pTNM", "pathologic", "ptnm"),
    ("Verlauf", "TNM", "generic", "tnm"),
    ("OP", "TNM", "generic", "tnm"),
    ("Pathologie", "cTNM", "clinical", "ctnm"),
    ("Pathologie", "pTNM", "pathologic", "ptnm"),
)
ID_SUFFIX = {"clinical": "-c", "pathologic": "-p", "generic": ""}


def id_base(tnm: Column, histology: Column, report_id: Column, kind: str) -> Column:
    """TNM id, else histology id, else report id, with a letter for the kind of staging."""
    base = first_nonblank(tnm["_ID"], histology["_Histologie_ID"], report_id)
    return F.concat(base, F.lit(ID_SUFFIX[kind]))


def normalize_tnm(reports: DataFrame, kind: str | None = None) -> DataFrame:
    """One row per staging of any section: keys, ``section, seq, kind, base, item``."""
    from oncolake.resources.base import KEYS

    entries = []
    for name, field, staging, job in SOURCES:
        if kind in (None, staging):
            item = section(name, field)
            entry = F.struct(
                F.lit(name).alias("section"),
                F.lit(emit_base(name, job)).alias("seq"),
                F.lit(staging).alias("kind"),
                id_base(item, section(name, "Histologie"), F.col("report_id"), staging).alias("base"),
                item.alias("item"),
            )
            entries.append(F.when(item.isNotNull(), entry))
    found = F.explode(F.array_compact(F.array(*entries))).alias("__row")
    return reports.select(*KEYS, found).select(*KEYS, "__row.*")


def _by_prefix(category: str, prefix: Column, part: int) -> Column:
    chosen = None
    for key, value in CATEGORY_CODES[category].items():
        if key:
            chosen = (F if chosen is None else chosen).when(prefix == key, value[part])
    return chosen.otherwise(CATEGORY_CODES[category][""][part])


def _member_system(cfg: MappingConfig, name: str) -> str:
    return cfg.identifier_system(f"tnm-{name}-observation-id")


def tnm_members(cfg: MappingConfig, tnm: Column) -> list[Column]:
    """The members of one staging as structs, null where the category is not reported."""

    def member(number, present, suffix, profile, system, code, display, value_system, value,
               value_display=None, prefix=None, suffixes=None):
        text = lambda v: (v if isinstance(v, Column) else F.lit(v)).cast("string")
        flag = lambda name: suffixes[name] if suffixes is not None else F.lit(False)
        return F.when(
            present,
            F.struct(
                F.lit(number).alias("number"),
                F.lit(suffix).alias("suffix"),
                F.lit(cfg.profile(f"tnm-{profile}")).alias("profile"),
                F.lit(_member_system(cfg, profile)).alias("identifier_system"),
                text(C.SNOMED if system == "snomed" else C.LOINC).alias("system"),
                text(cfg.snomed_version if system == "snomed" else cfg.loinc_version).alias("version"),
                text(code).alias("code"),
                text(display).alias("display"),
                text(value_system).alias("value_system"),
                text(cfg.snomed_version if value_system == C.SNOMED else None).alias("value_version"),
                text(value).alias("value"),
                text(value_display).alias("value_display"),
                text(prefix).alias("prefix"),
                flag("sn").alias("sn"),
                flag("itc_positive").alias("itc_positive"),
                flag("itc_negative").alias("itc_negative"),
            ),
        )

    members = []
    for number, name in enumerate(CATEGORY_CODES):
        prefix = F.coalesce(tnm[f"c_p_u_Praefix_{name}"], F.lit("c"))
        value, suffixes = F.concat(F.lit(name), tnm[name]), None
        if name != "T":
            suffixes = tnm_suffixes(value)
            value = suffixes["value"]
        members.append(
            member(number, tnm[name].isNotNull(), name, f"{name.lower()}-kategorie", "snomed",
                   _by_prefix(name, prefix, 0), _by_prefix(name, prefix, 1), C.TNM_UICC, value,
                   prefix=prefix, suffixes=suffixes)
        )
    for number, (field, suffix, profile, system, code, display, fixed) in enumerate(OTHER_MEMBERS, 3):
        members.append(
            member(number, tnm[field].isNotNull(), suffix, profile, system, code, display,
                   C.SNOMED if fixed else C.TNM_UICC, fixed[0] if fixed else tnm[field],
                   fixed[1] if fixed else None)
        )
    return members


def member_id_list(cfg: MappingConfig, tnm: Column, base: Column) -> Column:
    """Ids of the reported members of one staging, in emission order."""
    ids = []
    for name in CATEGORY_CODES:
        system = _member_system(cfg, f"{name.lower()}-kategorie")
        ids.append(F.when(tnm[name].isNotNull(), resource_id(system, slugify(F.concat(base, F.lit(f"-{name}"))))))
    for field, suffix, profile, *_ in OTHER_MEMBERS:
        value = slugify(F.concat(base, F.lit(f"-{suffix}")))
        ids.append(F.when(tnm[field].isNotNull(), resource_id(_member_system(cfg, profile), value)))
    return F.array_compact(F.array(*ids))


def grouping_id(cfg: MappingConfig, base: Column) -> Column:
    return resource_id(cfg.identifier_system("tnm-grouping-observation-id"), slugify(base))


def map_tnm(reports: DataFrame, cfg: MappingConfig = DEFAULT, kind: str | None = None) -> DataFrame:
    """Up to eleven member observations per staging and a grouping observation that refers to them.

    ``kind`` limits the job to clinical, pathologic or generic staging.
    """
    stagings = normalize_tnm(reports, kind)
    item = F.col("item")
    method = one(
        make_coding(cfg.code_system("tnm-version"), item["Version"]), item["Version"].isNotNull()
    )
    rows = stagings.withColumn(
        "member", F.explode(F.array_compact(F.array(*tnm_members(cfg, item))))
    )
    m = F.col("member")
    uicc = lambda code: make_coding(C.TNM_UICC, code, code)
    members = observations(
        rows,
        cfg,
        "tnm",
        m["identifier_system"],
        F.concat_ws("-", "base", m["suffix"]),
        m["profile"],
        seq=F.col("seq") + m["number"],
        code=one(make_coding(m["system"], m["code"], m["display"], m["version"])),
        code_extension=one(uicc(m["prefix"]), m["prefix"].isNotNull()),
        effective=partial_date(item["Datum"]),
        method=method,
        value_kind=F.lit("concept"),
        value_codings=one(make_coding(m["value_system"], m["value"], m["value_display"], m["value_version"])),
        value_suffixes=many(
            F.when(m["sn"], uicc(F.lit("sn"))),
            F.when(m["itc_positive"], uicc(F.lit("i+"))),
            F.when(m["itc_negative"], uicc(F.lit("i-"))),
        ),
    )
    stage = uicc_stage(item["UICC_Stadium"])

    def grouping_code(part):
        kinds = F.col("kind")
        return (
            F.when(kinds == "clinical", GROUPING_CODES["clinical"][part])
            .when(kinds == "pathologic", GROUPING_CODES["pathologic"][part])
            .otherwise(GROUPING_CODES["generic"][part])
        )

    groupings = observations(
        stagings,
        cfg,
        "tnm_grouping",
        "tnm-grouping-observation-id",
        F.col("base"),
        "tnm-klassifikation",
        seq=F.col("seq") + 100,
        code=one(make_coding(C.SNOMED, grouping_code(0), grouping_code(1), cfg.snomed_version)),
        effective=partial_date(item["Datum"]),
        method=method,
        value_kind=F.when(stage.isNotNull(), "concept"),
        value_codings=one(
            make_coding(C.TNM_UICC, stage, F.concat(F.lit("Stadium "), F.when(stage == "okk", "X").otherwise(stage))),
            stage.isNotNull(),
        ),
        member_ids=member_id_list(cfg, item, F.col("base")),
    )
    return members.unionByName(groupings)
