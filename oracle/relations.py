"""Named relations the oracles build on, as SQL text with their own joins and rollups."""

from __future__ import annotations

# Fixed values of the data contract, stated here on their own.
SOURCES = ("referral", "job_board", "linkedin", "university", "agency")
SENIORITY = ("junior", "mid", "senior", "staff", "principal")
STAGES = ("applied", "screen", "phone_interview", "onsite", "final")
NICHE_LOCATIONS = ("boise", "reno", "berlin")
SENIOR_LEVELS = ("senior", "staff", "principal")
NULL_KEY_SENTINEL = "_dbt_utils_surrogate_key_null_"

# Fixed values of the stand-in data.
EDUCATION = ("none", "school", "apprenticeship", "degree", "doctorate")
DEPARTMENTS = ("design", "legal", "logistics", "people", "product", "research", "security")
LOCATIONS = ("lisbon", "oslo", "boise", "toronto", "reno", "nairobi", "berlin", "osaka")
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
FEEDBACK = ("Not a fit", "Some gaps", "Acceptable", "Good", "Excellent")


def array(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def in_list(values) -> str:
    return "(" + ", ".join(str(v) if isinstance(v, int) else f"'{v}'" for v in values) + ")"


def pick(values, index: str) -> str:
    return f"{array(values)}[CAST({index} AS INTEGER) + 1]"


def half_up(num: str, den: str, digits: int) -> str:
    """num / den rounded half up in integer arithmetic; null over nothing."""
    unit = 10**digits
    den = f"CAST(NULLIF({den}, 0) AS HUGEINT)"
    return f"(CAST((2 * CAST({num} AS HUGEINT) * {unit} + {den}) // (2 * {den}) AS DOUBLE) / {unit})"


def key(column: str) -> str:
    return f"md5(coalesce({column}, '{NULL_KEY_SENTINEL}'))"


def day_key(column: str) -> str:
    return f"CAST(strftime({column}, '%Y%m%d') AS INTEGER)"


def clean(column: str) -> str:
    return f"lower(nullif(trim({column}, ' '), '')) AS {column}"


DAY0 = "DATE '2024-01-01'"
OPENED = f"({DAY0} + CAST({{p}} * 37 % 540 AS INTEGER))"
APPLIED = f"({DAY0} + CAST({{p}} * 37 % 540 AS INTEGER) + CAST({{o}} % 46 AS INTEGER))"
HAS_OFFER = "(o_orderstatus = 'F' OR (o_orderstatus = 'P' AND o_orderkey % 4 = 0))"
NICHE = in_list(NICHE_LOCATIONS)


def requisition_rows(recruiter: str) -> str:
    return f"""
SELECT 'REQ' || p_partkey AS req_id,
       upper({pick(DEPARTMENTS, 'p_partkey % 7')}) AS department,
       upper({pick(SENIORITY, 'p_size % 5')}) AS seniority_level,
       {pick(LOCATIONS, 'p_partkey % 8')} || '  ' AS location,
       CAST(45 + p_size AS INTEGER) AS target_time_to_fill_days,
       {OPENED.format(p='p_partkey')} AS opened_date,
       'HM' || (p_partkey % 97) AS hiring_manager_id,
       {recruiter} AS recruiter_id
FROM part"""


def application_rows(join: str) -> str:
    return f"""
SELECT 'APN' || o_orderkey AS application_id,
       'APP' || o_custkey AS applicant_id,
       'REQ' || part AS req_id,
       {APPLIED.format(p='part', o='o_orderkey')} AS applied_date,
       {pick(STAGES, 'CAST(left(o_orderpriority, 1) AS INTEGER) - 1')} AS current_stage,
       CASE WHEN o_orderstatus = 'F' THEN 'hired'
            WHEN o_orderstatus = 'P' AND o_orderkey % 4 = 0 THEN 'rejected'
            WHEN o_orderstatus = 'P' THEN 'withdrawn'
            WHEN o_orderkey % 2 = 0 THEN 'rejected'
            ELSE 'in_progress' END AS final_outcome
FROM orders {join} JOIN first_part ON l_orderkey = o_orderkey"""


def staged_requisitions(source: str) -> str:
    return f"""
SELECT req_id, {clean('department')}, {clean('seniority_level')}, {clean('location')},
       target_time_to_fill_days, opened_date, hiring_manager_id, recruiter_id
FROM {source}"""


RELATIONS: dict[str, str] = {
    "first_part": "SELECT l_orderkey, min(l_partkey) AS part FROM lineitem GROUP BY l_orderkey",
    "lines": """
SELECT l_orderkey AS o, l_linenumber AS ln, CAST(min(l_quantity) AS INTEGER) AS q,
       min(l_suppkey) AS supplier, min(l_returnflag) AS flag
FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "raw_requisitions": requisition_rows("'REC' || (p_partkey % 50)"),
    "dirty_requisitions": requisition_rows(
        "CASE WHEN p_partkey % 211 = 0 THEN NULL ELSE 'REC' || (p_partkey % 50) END"
    ),
    "raw_offers": f"""
SELECT 'OFF' || o_orderkey AS offer_id, 'APN' || o_orderkey AS application_id, o_orderkey AS o,
       {APPLIED.format(p='part', o='o_orderkey')} + 20 AS offer_date,
       CAST(10 * (80 + o_custkey % 50) * (75 + o_orderkey % 51) AS BIGINT) AS salary,
       CAST(1000 * (80 + o_custkey % 50) AS BIGINT) AS midpoint,
       {APPLIED.format(p='part', o='o_orderkey')} + 21 + CAST(o_orderkey % 45 AS INTEGER) AS response_date,
       CASE WHEN o_orderstatus = 'F' THEN 'Accepted'
            WHEN o_orderkey % 45 > 20 THEN 'Expired' ELSE 'Declined' END AS decision
FROM orders JOIN first_part ON l_orderkey = o_orderkey
WHERE {HAS_OFFER}""",
    # ---- staging
    "stg_applicants": f"""
SELECT applicant_id, {clean('source')}, applied_date, resume_years_experience, education_level,
       coalesce(referral_flag, false) AS is_referral
FROM (SELECT 'APP' || c_custkey AS applicant_id,
             ' ' || {pick(SOURCES, f"list_position({array(SEGMENTS)}, c_mktsegment) - 1")} AS source,
             {DAY0} + CAST(c_custkey % 560 AS INTEGER) AS applied_date,
             CAST(c_nationkey AS DOUBLE) AS resume_years_experience,
             {pick(EDUCATION, 'c_nationkey % 5')} AS education_level,
             CASE WHEN c_custkey % 10 <> 0 THEN c_mktsegment = '{SEGMENTS[0]}' END AS referral_flag
      FROM customer)""",
    "stg_requisitions": staged_requisitions("raw_requisitions"),
    "stg_applications": application_rows(""),
    "stg_stage_history": f"""
SELECT 'APN' || o AS application_id, {pick(STAGES, 'ln - 1')} AS stage_name,
       {APPLIED.format(p='part', o='o')} + CAST(4 * (ln - 1) AS INTEGER) AS entered_date,
       {APPLIED.format(p='part', o='o')} + CAST(4 * (ln - 1) AS INTEGER) + q AS exited_date
FROM lines JOIN first_part ON l_orderkey = o
WHERE ln <= 5""",
    "stg_interviews": f"""
SELECT 'INT-' || o || '-' || ln AS interview_id, 'APN' || o AS application_id,
       CAST(ln - 2 AS INTEGER) AS interview_round, 'IVR' || supplier AS interviewer_id,
       {APPLIED.format(p='part', o='o')} + CAST(4 * (ln - 1) AS INTEGER) AS scheduled_date,
       flag <> 'R' AS is_completed, CAST(1 + q % 5 AS INTEGER) AS feedback_score,
       {pick(FEEDBACK, 'q % 5')} AS feedback_text
FROM lines JOIN first_part ON l_orderkey = o
WHERE ln BETWEEN 3 AND 5""",
    "stg_offers": """
SELECT offer_id, application_id, offer_date, CAST(salary AS DOUBLE) AS offer_salary,
       CAST(midpoint AS DOUBLE) AS band_midpoint, response_date, lower(decision) AS decision
FROM raw_offers""",
    "stg_hires": """
SELECT 'HIRE' || o AS hire_id, offer_id, response_date + 7 + CAST(o % 18 AS INTEGER) AS start_date
FROM raw_offers WHERE decision = 'Accepted'""",
    # ---- intermediate
    "funnel": """
SELECT a.application_id, a.applicant_id, a.req_id, a.applied_date, a.current_stage, a.final_outcome, """
    + ", ".join(
        f"max(exited_date - entered_date) FILTER (WHERE stage_name = '{s}') AS days_in_{s}" for s in STAGES
    )
    + """,
       coalesce(max(exited_date), a.applied_date) - coalesce(min(entered_date), a.applied_date)
         AS total_days_to_decision,
       nullif(count(stage_name), 0) AS stages_recorded,
       a.final_outcome = 'withdrawn' AS was_dropped,
       CASE WHEN a.final_outcome = 'withdrawn' THEN a.current_stage END AS drop_stage
FROM stg_applications a LEFT JOIN stg_stage_history h ON h.application_id = a.application_id
GROUP BY a.application_id, a.applicant_id, a.req_id, a.applied_date, a.current_stage, a.final_outcome""",
    "pace": """
SELECT hire_id, offer_id, application_id, req_id, department, seniority_level, location, recruiter_id,
       hiring_manager_id, opened_date, start_date AS filled_date, target_time_to_fill_days,
       start_date - opened_date AS actual_time_to_fill_days,
       start_date - opened_date - target_time_to_fill_days AS days_over_target,
       start_date - opened_date > target_time_to_fill_days AS missed_target
FROM stg_requisitions JOIN stg_applications USING (req_id)
     JOIN stg_offers USING (application_id) JOIN stg_hires USING (offer_id)""",
    "outcomes": f"""
SELECT offer_id, application_id, offer_date, response_date,
       CAST(salary AS DOUBLE) AS offer_salary, CAST(midpoint AS DOUBLE) AS band_midpoint,
       CAST(salary - midpoint AS DOUBLE) AS offer_vs_band_delta,
       {half_up('salary', 'midpoint', 4)} AS offer_to_band_ratio,
       CASE WHEN midpoint <> 0 THEN 100 * salary < 90 * midpoint END AS is_below_band,
       response_date - offer_date AS days_to_respond, lower(decision) AS decision,
       decision = 'Accepted' AS is_accepted, decision <> 'Accepted' AS is_declined
FROM raw_offers""",
    "fills": "SELECT req_id, min(filled_date) AS filled_date FROM pace GROUP BY req_id",
    # ---- dimensions
    "dim_applicant": f"""
SELECT {key('applicant_id')} AS applicant_key, applicant_id, source AS applicant_source,
       resume_years_experience, education_level, is_referral
FROM stg_applicants""",
    "dim_requisition": f"""
SELECT {key('req_id')} AS requisition_key, req_id, department, seniority_level, location,
       location IN {NICHE} AS is_niche_location, recruiter_id, hiring_manager_id,
       target_time_to_fill_days, opened_date
FROM stg_requisitions""",
    "dim_recruiter": f"""
SELECT {key('recruiter_id')} AS recruiter_key, recruiter_id, count(*) AS total_requisitions_owned
FROM stg_requisitions WHERE recruiter_id IS NOT NULL GROUP BY recruiter_id""",
    "calendar": "SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2025-12-31', INTERVAL 1 DAY)) AS DATE) AS d",
    "dim_date": f"""
SELECT {day_key('d')} AS date_key, d AS date_day, CAST(year(d) AS INTEGER) AS year,
       CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
       CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofweek(d) AS INTEGER) AS day_of_week,
       dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend,
       CAST(date_trunc('month', d) AS DATE) AS first_day_of_month
FROM calendar""",
    # ---- facts
    "interview_stats": f"""
SELECT application_id, count(*) AS interview_count, max(interview_round) AS max_interview_round,
       {half_up('sum(feedback_score)', 'count(feedback_score)', 3)} AS avg_feedback_score,
       min(feedback_score) AS min_feedback_score, count(DISTINCT interviewer_id) AS distinct_interviewers
FROM stg_interviews GROUP BY application_id""",
    "fact_applications": f"""
SELECT f.application_id, {key('f.applicant_id')} AS applicant_key, {key('f.req_id')} AS requisition_key,
       {key('r.recruiter_id')} AS recruiter_key, {day_key('f.applied_date')} AS applied_date_key,
       f.* EXCLUDE (application_id), r.recruiter_id,
       coalesce(interview_count, 0) AS interview_count, max_interview_round, avg_feedback_score,
       min_feedback_score, coalesce(distinct_interviewers, 0) AS distinct_interviewers,
       f.final_outcome = 'hired' AS is_hired,
       p.actual_time_to_fill_days, p.days_over_target, p.missed_target
FROM funnel f LEFT JOIN pace p ON p.application_id = f.application_id
     LEFT JOIN interview_stats i ON i.application_id = f.application_id
     LEFT JOIN stg_requisitions r ON r.req_id = f.req_id""",
    "fact_offers": f"""
SELECT o.offer_id, {key('a.applicant_id')} AS applicant_key, {key('a.req_id')} AS requisition_key,
       {key('r.recruiter_id')} AS recruiter_key, {day_key('o.offer_date')} AS offer_date_key,
       o.* EXCLUDE (offer_id), a.applicant_id, a.req_id, r.recruiter_id
FROM outcomes o LEFT JOIN stg_applications a ON a.application_id = o.application_id
     LEFT JOIN stg_requisitions r ON r.req_id = a.req_id""",
    "activity": """
SELECT req_id, count(*) AS applications_received, """
    + ", ".join(
        f"count_if(final_outcome = '{outcome}') AS {outcome}_count"
        for outcome in ("hired", "rejected", "withdrawn", "in_progress")
    )
    + """, count_if(was_dropped) AS dropped_count
FROM funnel GROUP BY req_id""",
    "req_pace": f"""
SELECT req_id, count(*) AS hire_count,
       {half_up('sum(actual_time_to_fill_days)', 'count(*)', 1)} AS avg_time_to_fill_days,
       min(actual_time_to_fill_days) AS min_time_to_fill_days,
       max(actual_time_to_fill_days) AS max_time_to_fill_days,
       bool_or(missed_target) AS any_hire_missed_target, bool_and(missed_target) AS all_hires_missed_target
FROM pace GROUP BY req_id""",
    "fact_requisitions": f"""
SELECT r.*, {key('r.req_id')} AS requisition_key, {key('r.recruiter_id')} AS recruiter_key,
       {day_key('r.opened_date')} AS opened_date_key, """
    + ", ".join(
        f"coalesce(a.{c}, 0) AS {c}"
        for c in (
            "applications_received",
            "hired_count",
            "rejected_count",
            "withdrawn_count",
            "in_progress_count",
            "dropped_count",
        )
    )
    + """,
       coalesce(p.hire_count, 0) AS hire_count, p.req_id IS NOT NULL AS is_filled,
       p.* EXCLUDE (req_id, hire_count)
FROM stg_requisitions r LEFT JOIN activity a ON a.req_id = r.req_id LEFT JOIN req_pace p ON p.req_id = r.req_id""",
    # ---- features
    "gaps": """
SELECT *, scheduled_date - lag(scheduled_date) OVER (
         PARTITION BY application_id ORDER BY interview_round, scheduled_date, interview_id) AS gap_from_prev_round
FROM stg_interviews""",
    "max_gaps": """
SELECT application_id, max(gap_from_prev_round) AS max_gap_between_rounds_days
FROM gaps GROUP BY application_id""",
    "recruiter_load": """
SELECT a.application_id, own.recruiter_id, a.applied_date,
       count(other.req_id) AS recruiter_concurrent_open_reqs
FROM stg_applications a JOIN stg_requisitions own ON own.req_id = a.req_id
     LEFT JOIN (SELECT r.*, f.filled_date FROM stg_requisitions r LEFT JOIN fills f ON f.req_id = r.req_id) other
       ON other.recruiter_id = own.recruiter_id AND other.req_id <> own.req_id
          AND other.opened_date <= a.applied_date
          AND coalesce(other.filled_date > a.applied_date, true)
GROUP BY ALL""",
    "features": f"""
SELECT f.application_id, c.source AS candidate_source, c.is_referral AS referral_flag, c.resume_years_experience,
       coalesce(i.interview_count, 0) AS interview_rounds_completed, i.avg_feedback_score, i.min_feedback_score,
       coalesce(i.distinct_interviewers, 0) AS interviewer_count, g.max_gap_between_rounds_days,
       greatest({", ".join(f"coalesce(f.days_in_{s}, 0)" for s in STAGES)}) AS max_stage_dwell_days,
       r.department, r.seniority_level, r.location, r.location IN {NICHE} AS is_niche_location,
       coalesce(l.recruiter_concurrent_open_reqs, 0) AS recruiter_concurrent_open_reqs,
       o.offer_to_band_ratio, o.days_to_respond, o.offer_id IS NOT NULL AS reached_offer_stage,
       f.current_stage, f.final_outcome, f.applied_date,
       p.missed_target AS label_missed_target, f.was_dropped AS label_was_dropped,
       CASE WHEN o.offer_id IS NOT NULL THEN o.decision = 'declined' END AS label_offer_declined
FROM funnel f
     LEFT JOIN stg_applicants c ON c.applicant_id = f.applicant_id
     LEFT JOIN stg_requisitions r ON r.req_id = f.req_id
     LEFT JOIN interview_stats i ON i.application_id = f.application_id
     LEFT JOIN max_gaps g ON g.application_id = f.application_id
     LEFT JOIN recruiter_load l ON l.application_id = f.application_id
     LEFT JOIN outcomes o ON o.application_id = f.application_id
     LEFT JOIN pace p ON p.application_id = f.application_id""",
    "lifetime": """
SELECT recruiter_id, count(*) - 1 AS recruiter_concurrent_open_reqs
FROM stg_requisitions GROUP BY recruiter_id""",
    "open_reqs": f"""
SELECT r.req_id, r.department, r.seniority_level, r.location, r.location IN {NICHE} AS is_niche_location,
       r.target_time_to_fill_days,
       coalesce(l.recruiter_concurrent_open_reqs, 0) AS recruiter_concurrent_open_reqs
FROM fact_requisitions r LEFT JOIN lifetime l ON l.recruiter_id = r.recruiter_id
WHERE NOT r.is_filled""",
    # ---- dirty variant, only what its orphan check reads
    "dirty_stg_requisitions": staged_requisitions("dirty_requisitions"),
    "dirty_stg_applications": application_rows("LEFT"),
    "dirty_keys": f"""
SELECT {key('a.applicant_id')} AS applicant_key, {key('a.req_id')} AS requisition_key,
       {key('r.recruiter_id')} AS recruiter_key, {day_key('a.applied_date')} AS applied_date_key
FROM dirty_stg_applications a LEFT JOIN dirty_stg_requisitions r ON r.req_id = a.req_id""",
}
