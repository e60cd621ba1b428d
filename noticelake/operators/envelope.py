"""Common envelope of notices: projection, case, stage and decoded codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Stages by notice type; all other types are INIT.
STAGES = {"TenderResultNotice": "RESULT", "ContractPerformingNotice": "EXECUTION", "NoticeUpdateNotice": "UPDATE", "AgreementUpdateNotice": "UPDATE"}
ENVELOPE = (
    "objectId", "noticeType", "noticeNumber", "bzpNumber", "publicationDate", "publicationDateDay", "cpvCode", "isTenderAmountBelowEU", "orderObject", "clientType", "orderType", "tenderType",
    "organizationName", "organizationCity", "organizationCountry", "organizationNationalId", "organizationId", "organizationProvince", "tenderId", "submittingOffersDate", "procedureResult",
    "contractors", "clientTypeName", "provinceName", "caseId", "noticeStage",
)


def decode(code: Column, dictionary: dict[str, str]) -> Column:
    """The name of a code by a literal map; null for unknown and null codes."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in dictionary.items() for x in kv]), code) if dictionary else F.lit(None).cast("string")


def notice_stage(notice_type: Column) -> Column:
    out = F.lit("INIT")
    for t, s in STAGES.items():
        out = F.when(notice_type == t, s).otherwise(out)
    return out


def publication_day(published: Column | str) -> Column:
    """The date part of an ISO text, null if it is no date."""
    return F.try_to_date(F.substring(published, 1, 10)).cast("string")


def build_envelope(df: DataFrame, client_types: dict[str, str], provinces: dict[str, str]) -> DataFrame:
    """The envelope's columns that ``df`` has or that derive from it, in their order."""
    new = {
        "clientTypeName": decode(F.col("clientType"), client_types), "provinceName": decode(F.col("organizationProvince"), provinces),
        "caseId": F.coalesce("tenderId", "objectId"), "noticeStage": notice_stage(F.col("noticeType")), "publicationDateDay": publication_day("publicationDate"),
    }
    out = df.withColumns(new)
    return out.select(*[c for c in ENVELOPE if c in out.columns])
