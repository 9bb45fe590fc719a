"""Check results in SQL, from plain lists of checks."""

from __future__ import annotations

from .relations import in_list

# What each column may hold.
DOMAINS = {
    "source": ("referral", "job_board", "linkedin", "university", "agency"),
    "candidate_source": ("referral", "job_board", "linkedin", "university", "agency"),
    "seniority_level": ("junior", "mid", "senior", "staff", "principal"),
    "final_outcome": ("hired", "rejected", "withdrawn", "in_progress"),
    "decision": ("accepted", "declined", "expired"),
    "feedback_score": (1, 2, 3, 4, 5),
}
RANGES = {
    "actual_time_to_fill_days": (0, 1000),
    "avg_time_to_fill_days": (0, 1000),
    "max_time_to_fill_days": (0, 1000),
    "min_feedback_score": (1, 5),
    "avg_feedback_score": (1, 5),
    "days_to_respond": (0, 365),
}
SOURCES_OF = {"mart_ml_features": "features"}  # table name -> relation

# The checks as (table, check, column, parent).

# Declared on the staging layer.
STAGING = (
    ("stg_applicants", "not_null", "applicant_id", None),
    ("stg_applicants", "unique", "applicant_id", None),
    ("stg_applicants", "accepted_values", "source", None),
    ("stg_applicants", "not_null", "is_referral", None),
    ("stg_requisitions", "not_null", "req_id", None),
    ("stg_requisitions", "unique", "req_id", None),
    ("stg_requisitions", "accepted_values", "seniority_level", None),
    ("stg_requisitions", "not_null", "target_time_to_fill_days", None),
    ("stg_applications", "not_null", "application_id", None),
    ("stg_applications", "unique", "application_id", None),
    ("stg_applications", "not_null", "applicant_id", None),
    ("stg_applications", "not_null", "req_id", None),
    ("stg_applications", "accepted_values", "final_outcome", None),
    ("stg_stage_history", "not_null", "application_id", None),
    ("stg_stage_history", "not_null", "stage_name", None),
    ("stg_interviews", "not_null", "interview_id", None),
    ("stg_interviews", "unique", "interview_id", None),
    ("stg_interviews", "not_null", "application_id", None),
    ("stg_interviews", "accepted_values", "feedback_score", None),
    ("stg_offers", "not_null", "offer_id", None),
    ("stg_offers", "unique", "offer_id", None),
    ("stg_offers", "not_null", "application_id", None),
    ("stg_offers", "accepted_values", "decision", None),
    ("stg_hires", "not_null", "hire_id", None),
    ("stg_hires", "unique", "hire_id", None),
    ("stg_hires", "not_null", "offer_id", None),
    ("stg_hires", "unique", "offer_id", None),
)

# Declared on the star schema, and the one foreign key that no other list has.
DECLARED = (
    ("dim_applicant", "not_null", "applicant_key", None),
    ("dim_applicant", "unique", "applicant_key", None),
    ("dim_applicant", "not_null", "applicant_id", None),
    ("dim_applicant", "unique", "applicant_id", None),
    ("dim_requisition", "not_null", "requisition_key", None),
    ("dim_requisition", "unique", "requisition_key", None),
    ("dim_requisition", "not_null", "req_id", None),
    ("dim_requisition", "unique", "req_id", None),
    ("dim_requisition", "accepted_values", "seniority_level", None),
    ("dim_recruiter", "not_null", "recruiter_key", None),
    ("dim_recruiter", "unique", "recruiter_key", None),
    ("dim_recruiter", "not_null", "recruiter_id", None),
    ("dim_recruiter", "unique", "recruiter_id", None),
    ("dim_date", "not_null", "date_key", None),
    ("dim_date", "unique", "date_key", None),
    ("dim_date", "not_null", "date_day", None),
    ("dim_date", "unique", "date_day", None),
    ("fact_applications", "not_null", "application_id", None),
    ("fact_applications", "unique", "application_id", None),
    ("fact_applications", "not_null", "applicant_key", None),
    ("fact_applications", "relationship", "applicant_key", "dim_applicant.applicant_key"),
    ("fact_applications", "not_null", "requisition_key", None),
    ("fact_applications", "relationship", "requisition_key", "dim_requisition.requisition_key"),
    ("fact_applications", "not_null", "recruiter_key", None),
    ("fact_applications", "relationship", "recruiter_key", "dim_recruiter.recruiter_key"),
    ("fact_applications", "not_null", "applied_date_key", None),
    ("fact_applications", "relationship", "applied_date_key", "dim_date.date_key"),
    ("fact_applications", "accepted_values", "final_outcome", None),
    ("fact_offers", "not_null", "offer_id", None),
    ("fact_offers", "unique", "offer_id", None),
    ("fact_offers", "not_null", "application_id", None),
    ("fact_offers", "relationship", "application_id", "fact_applications.application_id"),
    ("fact_offers", "not_null", "requisition_key", None),
    ("fact_offers", "relationship", "requisition_key", "dim_requisition.requisition_key"),
    ("fact_offers", "not_null", "recruiter_key", None),
    ("fact_offers", "relationship", "recruiter_key", "dim_recruiter.recruiter_key"),
    ("fact_offers", "not_null", "offer_date_key", None),
    ("fact_offers", "relationship", "offer_date_key", "dim_date.date_key"),
    ("fact_offers", "accepted_values", "decision", None),
    ("fact_offers", "relationship", "applicant_key", "dim_applicant.applicant_key"),
    ("fact_requisitions", "not_null", "req_id", None),
    ("fact_requisitions", "unique", "req_id", None),
    ("fact_requisitions", "not_null", "requisition_key", None),
    ("fact_requisitions", "unique", "requisition_key", None),
    ("fact_requisitions", "relationship", "requisition_key", "dim_requisition.requisition_key"),
    ("fact_requisitions", "not_null", "recruiter_key", None),
    ("fact_requisitions", "relationship", "recruiter_key", "dim_recruiter.recruiter_key"),
    ("fact_requisitions", "not_null", "opened_date_key", None),
    ("fact_requisitions", "relationship", "opened_date_key", "dim_date.date_key"),
)

# The blocking expectations on the star schema.
EXPECTED = (
    ("dim_applicant", "not_null", "applicant_key", None),
    ("dim_applicant", "unique", "applicant_key", None),
    ("dim_applicant", "not_null", "applicant_id", None),
    ("dim_requisition", "not_null", "requisition_key", None),
    ("dim_requisition", "unique", "requisition_key", None),
    ("dim_requisition", "not_null", "req_id", None),
    ("dim_recruiter", "not_null", "recruiter_key", None),
    ("dim_recruiter", "unique", "recruiter_key", None),
    ("dim_date", "not_null", "date_key", None),
    ("dim_date", "unique", "date_key", None),
    ("fact_applications", "not_null", "application_id", None),
    ("fact_applications", "unique", "application_id", None),
    ("fact_applications", "not_null", "applicant_key", None),
    ("fact_applications", "relationship", "applicant_key", "dim_applicant.applicant_key"),
    ("fact_applications", "not_null", "requisition_key", None),
    ("fact_applications", "relationship", "requisition_key", "dim_requisition.requisition_key"),
    ("fact_applications", "not_null", "recruiter_key", None),
    ("fact_applications", "relationship", "recruiter_key", "dim_recruiter.recruiter_key"),
    ("fact_applications", "not_null", "applied_date_key", None),
    ("fact_applications", "relationship", "applied_date_key", "dim_date.date_key"),
    ("fact_applications", "between", "actual_time_to_fill_days", None),
    ("fact_applications", "between", "min_feedback_score", None),
    ("fact_applications", "between", "avg_feedback_score", None),
    ("fact_applications", "accepted_values", "final_outcome", None),
    ("fact_offers", "not_null", "offer_id", None),
    ("fact_offers", "unique", "offer_id", None),
    ("fact_offers", "not_null", "application_id", None),
    ("fact_offers", "relationship", "application_id", "fact_applications.application_id"),
    ("fact_offers", "not_null", "requisition_key", None),
    ("fact_offers", "relationship", "requisition_key", "dim_requisition.requisition_key"),
    ("fact_offers", "not_null", "recruiter_key", None),
    ("fact_offers", "relationship", "recruiter_key", "dim_recruiter.recruiter_key"),
    ("fact_offers", "not_null", "offer_date_key", None),
    ("fact_offers", "relationship", "offer_date_key", "dim_date.date_key"),
    ("fact_offers", "between", "days_to_respond", None),
    ("fact_offers", "accepted_values", "decision", None),
    ("fact_requisitions", "not_null", "req_id", None),
    ("fact_requisitions", "unique", "req_id", None),
    ("fact_requisitions", "not_null", "requisition_key", None),
    ("fact_requisitions", "relationship", "requisition_key", "dim_requisition.requisition_key"),
    ("fact_requisitions", "not_null", "recruiter_key", None),
    ("fact_requisitions", "relationship", "recruiter_key", "dim_recruiter.recruiter_key"),
    ("fact_requisitions", "not_null", "opened_date_key", None),
    ("fact_requisitions", "relationship", "opened_date_key", "dim_date.date_key"),
    ("fact_requisitions", "between", "avg_time_to_fill_days", None),
    ("fact_requisitions", "between", "max_time_to_fill_days", None),
)

# Declared on the feature mart.
FEATURES = (
    ("mart_ml_features", "not_null", "application_id", None),
    ("mart_ml_features", "unique", "application_id", None),
    ("mart_ml_features", "accepted_values", "candidate_source", None),
    ("mart_ml_features", "accepted_values", "seniority_level", None),
    ("mart_ml_features", "not_null", "referral_flag", None),
    ("mart_ml_features", "not_null", "interview_rounds_completed", None),
    ("mart_ml_features", "not_null", "recruiter_concurrent_open_reqs", None),
    ("mart_ml_features", "not_null", "max_stage_dwell_days", None),
    ("mart_ml_features", "not_null", "reached_offer_stage", None),
    ("mart_ml_features", "not_null", "label_was_dropped", None),
)


def _row(table: str, kind: str, column: str, evaluated: str, unexpected: str, source: str, allowed: str = "0") -> str:
    return (
        f"SELECT '{table}' AS table_name, '{kind}' AS check_name, '{column}' AS column_name, "
        f"CAST({evaluated} AS BIGINT) AS evaluated, CAST({unexpected} AS BIGINT) AS unexpected, "
        f"{unexpected} <= {allowed} AS passed FROM {source}"
    )


def relation(table: str, soiled: bool = False) -> str:
    name = SOURCES_OF.get(table, table)
    return f"soiled_{name}" if soiled else name


def _check(table: str, kind: str, column: str, parent: str | None, soiled: bool) -> str:
    source = relation(table, soiled)
    if kind == "not_null":
        return _row(table, kind, column, "count(*)", f"count(*) - count({column})", source)
    if kind == "unique":
        rows = f"(SELECT count(*) AS n FROM {source} WHERE {column} IS NOT NULL GROUP BY {column})"
        return _row(table, kind, column, "coalesce(sum(n), 0)", "coalesce(sum(n) FILTER (WHERE n > 1), 0)", rows)
    if kind == "accepted_values":
        bad = f"count_if({column} NOT IN {in_list(DOMAINS[column])})"
        return _row(table, kind, column, f"count({column})", bad, source)
    if kind == "between":
        low, high = RANGES[column]
        return _row(table, kind, column, f"count({column})", f"count_if({column} NOT BETWEEN {low} AND {high})", source)
    owner, field = parent.split(".")
    known = f"SELECT {field} FROM {relation(owner, soiled)} WHERE {field} IS NOT NULL"
    bad = f"count_if({column} IS NOT NULL AND {column} NOT IN ({known}))"
    return _row(table, kind, column, f"count({column})", bad, source)


def check_rows(suite: tuple, soiled: bool = False) -> list[str]:
    return [_check(*check, soiled) for check in suite]


def mostly_between(table: str, column: str, low: int, high: int, mostly: str, soiled: bool = False) -> str:
    bad = f"count_if({column} NOT BETWEEN {low} AND {high})"
    return _row(table, "between", column, f"count({column})", bad, relation(table, soiled), f"count({column}) * (1 - {mostly})")


def pinned(table: str, expected: int, soiled: bool = False) -> str:
    return _row(table, "row_count", "*", "count(*)", f"abs(count(*) - {expected})", relation(table, soiled))


def implication(soiled: bool = False) -> str:
    all_missed, any_missed = "all_hires_missed_target", "any_hire_missed_target"
    return _row(
        "fact_requisitions",
        "implies",
        all_missed,
        f"count_if({all_missed})",
        f"count_if({all_missed} AND {any_missed} IS DISTINCT FROM true)",
        relation("fact_requisitions", soiled),
    )


def iff_offer(column: str, soiled: bool = False) -> str:
    condition = f"({column} IS NOT NULL) = reached_offer_stage"
    return _row(
        "mart_ml_features",
        "expression_true",
        f"{column} iff reached_offer_stage",
        f"count({condition})",
        f"count_if(NOT ({condition}))",
        relation("mart_ml_features", soiled),
    )


# ---- the same tables with planted faults ------------------------------------------

# (id, {column: the wrong value, or None for nulls alone}) by table.
SOILED = {
    "stg_applicants": ("applicant_id", {"applicant_id": "'gone'", "source": "'radio'", "is_referral": None}),
    "stg_requisitions": ("req_id", {"req_id": "'gone'", "seniority_level": "'boss'", "target_time_to_fill_days": None}),
    "stg_applications": (
        "application_id", {"application_id": "'gone'", "applicant_id": None, "req_id": None, "final_outcome": "'lost'"}
    ),
    "stg_stage_history": ("application_id", {"application_id": "'gone'", "stage_name": None}),
    "stg_interviews": ("interview_id", {"interview_id": "'gone'", "application_id": None, "feedback_score": "9"}),
    "stg_offers": ("offer_id", {"offer_id": "'gone'", "application_id": None, "decision": "'maybe'"}),
    "stg_hires": ("hire_id", {"hire_id": "'gone'", "offer_id": "'gone'"}),
    "dim_applicant": ("applicant_id", {"applicant_key": "'parent'", "applicant_id": "'gone'"}),
    "dim_requisition": ("req_id", {"requisition_key": "'parent'", "req_id": "'gone'", "seniority_level": "'boss'"}),
    "dim_recruiter": ("recruiter_id", {"recruiter_key": "'parent'", "recruiter_id": "'gone'"}),
    "dim_date": ("date_day", {"date_key": "17760704", "date_day": None}),
    "fact_applications": (
        "application_id",
        {
            "applicant_key": "'orphan'", "requisition_key": "'orphan'", "recruiter_key": "'orphan'",
            "applied_date_key": "19000101", "final_outcome": "'lost'", "actual_time_to_fill_days": "-3",
            "min_feedback_score": "0", "avg_feedback_score": "7", "application_id": "'gone'",
        },
    ),
    "fact_offers": (
        "offer_id",
        {
            "application_id": "'orphan'", "requisition_key": "'orphan'", "recruiter_key": "'orphan'",
            "offer_date_key": "19000101", "applicant_key": "'orphan'", "decision": "'maybe'", "days_to_respond": "400",
            "offer_id": "'gone'",
        },
    ),
    "fact_requisitions": (
        "req_id",
        {
            "requisition_key": "'orphan'", "recruiter_key": "'orphan'", "opened_date_key": "19000101",
            "avg_time_to_fill_days": "1001", "max_time_to_fill_days": "-1", "any_hire_missed_target": "false",
            "req_id": "'gone'",
        },
    ),
    "features": (
        "application_id",
        {
            "candidate_source": "'radio'", "seniority_level": "'boss'", "referral_flag": None,
            "interview_rounds_completed": None, "recruiter_concurrent_open_reqs": None, "max_stage_dwell_days": "-5",
            "reached_offer_stage": None, "label_was_dropped": None, "label_offer_declined": None,
            "offer_to_band_ratio": None, "application_id": "'gone'",
        },
    ),
}
NULL_SHARE, WRONG_SHARE, TWICE_SHARE = 23, 31, 29


def _draw(tag: str, id_column: str, share: int) -> str:
    """True for one row in ``share``, chosen by a digest of its id."""
    return f"('0x' || substr(md5('{tag}:' || CAST({id_column} AS VARCHAR)), 1, 8))::BIGINT % {share} = 0"


def soiled_relation(name: str) -> str:
    id_column, columns = SOILED[name]
    swaps = ", ".join(
        f"CASE WHEN {_draw(c + ' null', id_column, NULL_SHARE)} THEN NULL"
        + (f" WHEN {_draw(c + ' wrong', id_column, WRONG_SHARE)} THEN {wrong}" if wrong else "")
        + f" ELSE {c} END AS {c}"
        for c, wrong in columns.items()
    )
    twice = f"SELECT * FROM {name} WHERE {_draw('twice', id_column, TWICE_SHARE)}"
    return f"SELECT * REPLACE ({swaps}) FROM (SELECT * FROM {name} UNION ALL {twice})"
