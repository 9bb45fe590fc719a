"""Raw to staging: cast, trim, lower-case, default. One row in, one row out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_type, bool_default, clean_text, trimmed
from ..schemas import CONTRACT
from ..sources import Frames

# Text columns that are cleaned, by table; every other column is cast to its contract type.
CLEANED = {
    "applicants": {"source", "education_level"},
    "requisitions": {"department", "seniority_level", "location"},
    "applications": {"current_stage", "final_outcome"},
    "stage_history": {"stage_name"},
    "interviews": set(),
    "offers": {"decision"},
    "hires": set(),
}
# Flags that default to false and change their name.
FLAGS = {"referral_flag": "is_referral", "completed_flag": "is_completed"}
# Free text keeps its case.
TRIMMED = {"feedback_text"}


def stage(raw: DataFrame, table: str, lenient: bool = False) -> DataFrame:
    columns = []
    for field in CONTRACT[table].fields:
        c = F.col(field.name)
        if field.name in CLEANED[table]:
            columns.append(clean_text(c).alias(field.name))
        elif field.name in TRIMMED:
            columns.append(trimmed(c).alias(field.name))
        elif field.name in FLAGS:
            columns.append(bool_default(c).alias(FLAGS[field.name]))
        else:
            columns.append(as_type(c, field.dataType, lenient).alias(field.name))
    return raw.select(*columns)


def stg_applicants(raw: DataFrame) -> DataFrame:
    return stage(raw, "applicants")


def stg_requisitions(raw: DataFrame) -> DataFrame:
    return stage(raw, "requisitions")


def stg_applications(raw: DataFrame) -> DataFrame:
    return stage(raw, "applications")


def stg_stage_history(raw: DataFrame) -> DataFrame:
    return stage(raw, "stage_history")


def stg_interviews(raw: DataFrame) -> DataFrame:
    return stage(raw, "interviews")


def stg_offers(raw: DataFrame) -> DataFrame:
    return stage(raw, "offers")


def stg_hires(raw: DataFrame) -> DataFrame:
    return stage(raw, "hires")


def stage_all(raw: Mapping[str, DataFrame]) -> Frames:
    return Frames(tuple(raw), lambda table: stage(raw[table], table))
