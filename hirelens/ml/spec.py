"""What each model predicts, from which features, and which columns would leak."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class LeakageError(ValueError):
    pass


@dataclass(frozen=True)
class ModelSpec:
    name: str
    label: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    boolean: tuple[str, ...]
    forbidden: tuple[str, ...]
    classes: tuple[str, str]
    id: str = "application_id"

    @property
    def features(self) -> tuple[str, ...]:
        return (*self.numeric, *self.categorical, *self.boolean)

    def assert_no_leakage(self) -> None:
        leaks = sorted({self.label, *self.forbidden} & set(self.features))
        if leaks:
            raise LeakageError(f"{self.name} may not use {', '.join(leaks)}")

    def labelled(self, df: DataFrame) -> DataFrame:
        """Rows with a label, reduced to id, features and a 0/1 ``label``."""
        self.assert_no_leakage()
        known = df.filter(F.col(self.label).isNotNull())
        return self.inputs(known, self.id, F.col(self.label).cast("double").alias("label"))

    def inputs(self, df: DataFrame, *keep) -> DataFrame:
        """``keep`` plus the features in the types Spark ML takes.

        Numbers become doubles with nulls as they are; a missing flag is false.
        """
        return df.select(
            *keep,
            *[F.col(c).cast("double").alias(c) for c in self.numeric],
            *[F.col(c) for c in self.categorical],
            *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in self.boolean],
        )


# Feature lists and the columns each model must not see.
_ROLE = ("department", "seniority_level", "location")
_CANDIDATE_AND_ROLE = ("candidate_source", *_ROLE)
_CANDIDATE_COLUMNS = ("candidate_source", "referral_flag", "resume_years_experience")
_PROCESS_COLUMNS = (
    "interview_rounds_completed",
    "avg_feedback_score",
    "min_feedback_score",
    "interviewer_count",
    "max_gap_between_rounds_days",
    "max_stage_dwell_days",
)
_OFFER_COLUMNS = ("offer_to_band_ratio", "days_to_respond", "reached_offer_stage")
_CONTEXT_COLUMNS = ("final_outcome", "current_stage", "application_id", "applied_date")
_LABELS = ("label_missed_target", "label_was_dropped", "label_offer_declined")


def _other_labels(label: str) -> tuple[str, ...]:
    return tuple(c for c in _LABELS if c != label)


TIME_TO_FILL = ModelSpec(
    name="time_to_fill_risk",
    label="label_missed_target",
    numeric=("recruiter_concurrent_open_reqs",),
    categorical=_ROLE,
    boolean=("is_niche_location",),
    forbidden=(
        *_CANDIDATE_COLUMNS,
        *_PROCESS_COLUMNS,
        *_OFFER_COLUMNS,
        *_CONTEXT_COLUMNS,
        *_other_labels("label_missed_target"),
    ),
    classes=("hit_target", "missed_target"),
)
DROP_OFF = ModelSpec(
    name="drop_off_risk",
    label="label_was_dropped",
    numeric=(
        "resume_years_experience",
        *_PROCESS_COLUMNS,
        "recruiter_concurrent_open_reqs",
    ),
    categorical=_CANDIDATE_AND_ROLE,
    boolean=("referral_flag", "is_niche_location"),
    forbidden=(*_OFFER_COLUMNS, *_CONTEXT_COLUMNS, *_other_labels("label_was_dropped")),
    classes=("stayed", "dropped"),
)
OFFER_DECLINE = ModelSpec(
    name="offer_decline_risk",
    label="label_offer_declined",
    numeric=("offer_to_band_ratio", "resume_years_experience"),
    categorical=_CANDIDATE_AND_ROLE,
    boolean=("referral_flag", "is_niche_location"),
    forbidden=(
        "days_to_respond",
        "reached_offer_stage",
        *_PROCESS_COLUMNS,
        *_CONTEXT_COLUMNS,
        *_other_labels("label_offer_declined"),
    ),
    classes=("accepted", "declined"),
)
MODELS = {spec.name: spec for spec in (TIME_TO_FILL, DROP_OFF, OFFER_DECLINE)}

PLAIN_LANGUAGE = {
    "resume_years_experience": "years of experience",
    "interview_rounds_completed": "interview rounds so far",
    "avg_feedback_score": "average interview feedback",
    "min_feedback_score": "lowest interview feedback",
    "interviewer_count": "different interviewers met",
    "max_gap_between_rounds_days": "longest wait between interviews, in days",
    "max_stage_dwell_days": "longest time in one stage, in days",
    "recruiter_concurrent_open_reqs": "other open requisitions of the recruiter",
    "offer_to_band_ratio": "offer relative to the band midpoint",
    "candidate_source": "channel the candidate came from",
    "department": "hiring department",
    "seniority_level": "level of the role",
    "location": "place of work",
    "referral_flag": "whether the candidate was referred",
    "is_niche_location": "whether few candidates live near the role",
}
