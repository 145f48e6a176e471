"""Clinical value rules: staging suffixes, scores, categories and duplicate codes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from oncolake.functions.codes import lookup

# Stage groups that may be reported; the display text is "Stadium <code>".
UICC_STAGES = (
    "okk", "0", "0a", "0is", "I", "IA", "IA1", "IA2", "IA3", "IB", "IB1", "IB2", "IC", "IS",
    "II", "IIA", "IIA1", "IIA2", "IIB", "IIC", "III", "IIIA", "IIIA1", "IIIA2", "IIIB", "IIIC",
    "IIIC1", "IIIC2", "IIID", "IV", "IVA", "IVA1", "IVA2", "IVB", "IVC",
)

# Application codes of an irradiation.
APPLICATION_CODES = (
    "P", "P-ST", "P-4D", "P-ST4D", "PRCN", "PRCN-ST", "PRCN-4D", "PRCN-ST4D", "PRCJ", "PRCJ-4D",
    "PRCJ-ST", "PRCJ-ST4D", "K", "KHDR", "KLDR", "KPDR", "I", "IHDR", "ILDR", "IPDR", "MSIRT",
    "MPRRT", "MPSMA", "MRJT", "MRIT", "M", "S",
)

# Gleason score and pattern codes (SNOMED CT).
GLEASON_SCORE = {
    "2": "49878003",
    "3": "46677009",
    "4": "18430005",
    "5": "74013009",
    "6": "84556003",
    "7": "57403001",
    "7a": "57403001",
    "7b": "57403001",
    "8": "33013007",
    "9": "58925000",
    "10": "24514009",
}
GLEASON_GRADE_GROUP = {
    "3+3": "1279715000",
    "3+4": "1279714001",
    "4+3": "1279716004",
    "3+5": "1279718003",
    "4+4": "1279717008",
    "5+3": "1279719006",
    "4+5": "1279720000",
    "5+4": "1279721001",
    "5+5": "1279722008",
}
GLEASON_PATTERN = {
    "1": "369770006",
    "2": "369771005",
    "3": "369772003",
    "4": "369773008",
    "5": "369774002",
}


def tnm_suffixes(value: Column) -> Column:
    """``struct(value, sn, itc_positive, itc_negative)`` of an N or M category.

    ``sn``, ``i+`` and ``i-`` may follow the category, each with or without parentheses; the value
    is the text before the first of them.
    """
    text = F.trim(value)
    pattern = r"\(?(i-|i\+|sn)\)?"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    first = F.regexp_instr(text, F.lit(pattern))
    head = F.when(first > 0, F.trim(text.substr(F.lit(1), first - 1))).otherwise(text)
    return F.struct(
        head.alias("value"),
        F.array_contains(found, "sn").alias("sn"),
        F.array_contains(found, "i+").alias("itc_positive"),
        F.array_contains(found, "i-").alias("itc_negative"),
    )


def uicc_stage(value: Column) -> Column:
    """The stage group when it is a known one, else null."""
    return F.when(value.isin(*UICC_STAGES), value)


def ecog_bucket(value: Column) -> Column:
    """ECOG 0 to 4, or U, from an ECOG grade or a Karnofsky percentage."""
    text = F.upper(F.regexp_replace(value, r"[\s%_]|ECOG|KARNOFSKY", ""))
    folded = (
        F.when(text.isin("0", "1", "2", "3", "4"), text)
        .when(text.isin("90", "100"), "0")
        .when(text.isin("70", "80"), "1")
        .when(text.isin("50", "60"), "2")
        .when(text.isin("30", "40"), "3")
        .when(text.isin("10", "20"), "4")
    )
    return F.when(value.isNotNull(), F.coalesce(folded, F.lit("U")))


def gleason_score(primary: Column, secondary: Column, result: Column) -> Column:
    """The reported score, else the sum of both patterns (7a for 3+4, 7b for 4+3)."""
    total = (primary.try_cast("int") + secondary.try_cast("int")).cast("string")
    letter = (
        F.when((primary == "3") & (secondary == "4"), "a")
        .when((primary == "4") & (secondary == "3"), "b")
        .otherwise("")
    )
    return F.when(F.trim(result) != "", result).otherwise(F.concat(total, letter))


def gleason_grade_group(primary: Column, secondary: Column, score: Column) -> Column:
    """``struct(text, code, ordinal)``: grade group of both patterns, else code of the score."""
    both = primary.isNotNull() & secondary.isNotNull()
    text = F.when(both, F.concat_ws("+", primary, secondary)).otherwise(score)
    code = F.when(both, lookup(text, GLEASON_GRADE_GROUP)).otherwise(lookup(text, GLEASON_SCORE))
    digits = F.nullif(F.regexp_extract(score, r"^(\d{1,2})[ab]?$", 1), F.lit(""))
    return F.struct(
        text.alias("text"), code.alias("code"), digits.cast("decimal(18,6)").alias("ordinal")
    )


def ops_category(code: Column) -> Column:
    """``struct(code, display)`` of the procedure category, by the first character."""
    first = F.substring(code, 1, 1)

    def pick(surgical, diagnostic, other):
        return F.when(first == "5", surgical).when(first == "1", diagnostic).otherwise(other)

    return F.struct(
        pick("387713003", "165197003", "394841004").alias("code"),
        pick("Surgical procedure", "Diagnostic assessment", "Other category").alias("display"),
    )


def application_code(application: Column) -> Column:
    """Composed application code of an irradiation, null when the parts give no valid code."""
    outer, contact, metabolic = (
        application["Perkutan"],
        application["Kontakt"],
        application["Metabolisch"],
    )

    def text(value):
        return F.coalesce(value, F.lit(""))

    breathing = outer["Stereotaktisch"].isNotNull() | outer["Atemgetriggert"].isNotNull()
    composed = (
        F.when(
            outer.isNotNull(),
            F.concat(
                F.lit("P"),
                text(outer["Radiochemo"]),
                F.when(breathing, "-").otherwise(""),
                text(outer["Stereotaktisch"]),
                text(outer["Atemgetriggert"]),
            ),
        )
        .when(
            contact.isNotNull(),
            F.concat(text(contact["Interstitiell_endokavitaer"]), text(contact["Rate_Type"])),
        )
        .when(
            metabolic.isNotNull(),
            F.concat(
                F.lit("M"),
                F.when(metabolic["Metabolisch_Typ"] == "M", "").otherwise(
                    text(metabolic["Metabolisch_Typ"])
                ),
            ),
        )
        .otherwise("S")
    )
    code = F.upper(composed)
    return F.when(application.isNotNull() & code.isin(*APPLICATION_CODES), code)


def distinct_by_code(
    items: Column,
    code: Callable[[Column], Column] = lambda item: item["Code"],
    version: Callable[[Column], Column] = lambda item: item["Version"],
) -> Column:
    """One item per code: the greatest version as text, the earlier item on a tie.

    A missing version never replaces another one. Result is ordered by code. Sorting puts the
    winner last among its code, so one look at the next item decides; the cost is n log n.
    """
    keyed = F.array_sort(
        F.transform(
            items,
            lambda item, i: F.struct(
                code(item).alias("code"),
                F.coalesce(version(item), F.lit("")).alias("version"),
                (-i).alias("earlier"),
                item.alias("item"),
            ),
        )
    )
    following = F.slice(keyed, F.lit(2), F.greatest(F.size(keyed), F.lit(1)))
    pairs = F.arrays_zip(keyed.alias("this"), following.alias("next"))
    last = F.filter(
        pairs,
        lambda pair: pair["next"].isNull() | ~pair["this"]["code"].eqNullSafe(pair["next"]["code"]),
    )
    return F.transform(last, lambda pair: pair["this"]["item"])
