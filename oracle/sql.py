"""One SQL text per registered query."""

from __future__ import annotations

import re

from .checks import (
    DECLARED,
    EXPECTED,
    FEATURES,
    SOILED,
    STAGING,
    check_rows,
    iff_offer,
    implication,
    mostly_between,
    pinned,
    relation,
    soiled_relation,
)
from .relations import NICHE, NICHE_LOCATIONS, SENIOR_LEVELS, SENIORITY, half_up, in_list
from .relations import RELATIONS as CLEAN_RELATIONS

RELATIONS = {**CLEAN_RELATIONS, **{f"soiled_{name}": soiled_relation(name) for name in SOILED}}
_NAME = re.compile(rf"(?:FROM|JOIN)\s+({'|'.join(RELATIONS)})\b")


def with_relations(select: str) -> str:
    """``select`` behind the relations it needs, in dependency order."""
    needed: dict[str, str] = {}

    def add(text: str) -> None:
        for name in _NAME.findall(text):
            if name not in needed:
                body = RELATIONS[name]
                add(body)
                needed[name] = body

    add(select)
    ctes = ",\n".join(f"{name} AS ({body})" for name, body in needed.items())
    return f"WITH {ctes}\n{select}" if needed else select


def percent(part: str, whole: str, digits: int = 2) -> str:
    return half_up(f"100 * ({part})", whole, digits)


def contrast(source: str, flag: str, hit: str, flagged: str, rest: str) -> str:
    return f"""
SELECT grp, n, {percent('h', 'n', 1)} AS value, round(gap, 1) + 0.0 AS gap
FROM (SELECT *, sum(side * 100.0 * h / n) OVER () AS gap
      FROM (SELECT '{flagged}' AS grp, 1 AS side, count_if({flag}) AS n, count_if({flag} AND {hit}) AS h FROM {source}
            UNION ALL
            SELECT '{rest}', -1, count_if(NOT {flag}), count_if(NOT {flag} AND {hit}) FROM {source}))"""


REFERRAL = contrast(
    "fact_offers JOIN dim_applicant USING (applicant_key)", "is_referral", "is_accepted", "referral", "non_referral"
)
BAND = contrast("fact_offers", "coalesce(is_below_band, false)", "is_declined", "below_band", "at_or_above_band")
DWELL = contrast(
    "(SELECT * FROM features WHERE max_stage_dwell_days > 0)",
    "(max_stage_dwell_days > 10)",
    "label_was_dropped",
    "long_dwell",
    "short_dwell",
)
HARD = f"(seniority_level IN {in_list(SENIOR_LEVELS)} AND location IN {in_list(NICHE_LOCATIONS)})"
FILLED = "(SELECT * FROM pace WHERE actual_time_to_fill_days >= 0)"
HARD_TO_FILL = contrast(FILLED, HARD, "missed_target", "senior_niche", "others")
SENIORITY_PACE = f"""
SELECT seniority_level, count(*) AS n_hires,
       {half_up('sum(target_time_to_fill_days)', 'count(*)', 1)} AS avg_target,
       {half_up('sum(actual_time_to_fill_days)', 'count(*)', 1)} AS avg_actual,
       {half_up('count_if(missed_target)', 'count(*)', 1)} AS miss_rate
FROM {FILLED} WHERE seniority_level IN {in_list(SENIORITY)} GROUP BY seniority_level"""
OUTCOME_SHARE = f"""
SELECT final_outcome, n, {percent('n', 'sum(n) OVER ()', 1)} AS value
FROM (SELECT final_outcome, count(*) AS n FROM stg_applications WHERE final_outcome IS NOT NULL GROUP BY 1)"""

KPI = f"""
SELECT total_applications, total_offers, total_hires, total_requisitions, a.* EXCLUDE (total_applications, total_hires),
       o.* EXCLUDE (total_offers)
FROM (SELECT count(*) AS total_applications, count_if(is_hired) AS total_hires,
             {percent('count_if(is_hired)', 'count(*)')} AS overall_hire_rate,
             {percent('count_if(was_dropped)', 'count(*)')} AS overall_dropout_rate,
             {half_up('sum(actual_time_to_fill_days)', 'count(actual_time_to_fill_days)', 1)} AS avg_time_to_fill_days,
             {percent('count_if(missed_target)', 'count(missed_target)')} AS target_miss_rate
      FROM fact_applications) a,
     (SELECT count(*) AS total_offers,
             {percent('count_if(is_accepted)', 'count(*)')} AS overall_offer_accept_rate,
             {percent('count_if(is_accepted AND is_referral)', 'count_if(is_referral)')} AS referral_accept_rate,
             {percent('count_if(is_accepted AND NOT is_referral)', 'count_if(NOT is_referral)')}
               AS non_referral_accept_rate
      FROM fact_offers LEFT JOIN dim_applicant USING (applicant_key)) o,
     (SELECT count(*) AS total_requisitions FROM fact_requisitions)"""


def fixed_score(id_column: str, prefix: int) -> str:
    return f"(CAST(substr({id_column}, {prefix + 1}) AS BIGINT) * 7919 % 10000) / 10000.0"


ADVICE = {
    "fill_low": "No action: this role is on pace.",
    "fill_niche": "Search a wider area, allow remote work, or relax the fill target.",
    "fill_other": "Check sourcing channels and tighten interview scheduling.",
    "dropout_low": "No action: the candidate is engaged.",
    "dropout_stalled": "Follow up now or bring the next step forward.",
    "dropout_other": "Check in and agree on a timeline.",
    "offer_low": "No action: acceptance is likely.",
    "offer_below_band": "Raise the offer or stress equity, growth and flexibility.",
    "offer_other": "Close in person and stress what matters to the candidate.",
}


def advice(case: str) -> str:
    return "'" + ADVICE[case].replace("'", "''") + "'"


BAND_OF = "CASE WHEN score >= 0.6 THEN 'high' WHEN score >= 0.4 THEN 'elevated' ELSE 'low' END"


def recommended(source: str, keep: str, calm: str, text: str, reasons: list[str]) -> str:
    listed = ", ".join(reasons)
    return f"""
SELECT {keep}, score, {BAND_OF} AS risk_band,
       CASE WHEN score < 0.4 THEN {advice(calm)} ELSE {text} END AS recommendation,
       CASE WHEN score < 0.4 THEN '' ELSE concat_ws(' | ', {listed}) END AS rationale
FROM ({source})"""


FILL_TEXT = f"CASE WHEN is_niche_location THEN {advice('fill_niche')} ELSE {advice('fill_other')} END"
FILL_REASONS = [
    "CASE WHEN is_niche_location THEN 'niche location with few candidates' ELSE 'slow profile against its target' END",
    f"CASE WHEN seniority_level IN {in_list(SENIOR_LEVELS)} THEN seniority_level || ' roles take longer to fill' END",
    "CASE WHEN recruiter_concurrent_open_reqs >= 250 THEN 'recruiter has ' || recruiter_concurrent_open_reqs"
    " || ' other open requisitions' END",
]
RECOMMEND_FILL = recommended(
    f"SELECT *, {fixed_score('req_id', 3)} AS score FROM open_reqs", "req_id", "fill_low", FILL_TEXT, FILL_REASONS
)
RECOMMEND_DROPOUT = recommended(
    f"SELECT *, {fixed_score('application_id', 3)} AS score FROM features",
    "application_id",
    "dropout_low",
    f"CASE WHEN max_stage_dwell_days >= 10 THEN {advice('dropout_stalled')} ELSE {advice('dropout_other')} END",
    [
        "CASE WHEN max_stage_dwell_days >= 10 THEN 'one stage has lasted ' || max_stage_dwell_days || ' days'"
        " ELSE 'profile withdraws more often' END",
        "CASE WHEN interview_rounds_completed = 0 THEN 'no interview yet' END",
    ],
)
RECOMMEND_OFFER = recommended(
    f"SELECT offer_id, f.*, {fixed_score('offer_id', 3)} AS score"
    " FROM fact_offers JOIN features f USING (application_id)",
    "offer_id",
    "offer_low",
    f"CASE WHEN offer_to_band_ratio < 0.9 THEN {advice('offer_below_band')} ELSE {advice('offer_other')} END",
    [
        "CASE WHEN offer_to_band_ratio < 0.9 THEN 'offer is ' || CAST(round_even(offer_to_band_ratio * 100, 0) AS INTEGER)"
        " || '% of the band midpoint' ELSE 'profile declines more often' END",
        "CASE WHEN NOT referral_flag THEN 'not a referral' END",
    ],
)
AT_RISK = f"""
SELECT req_id, department, seniority AS seniority, location, niche, fill_risk, band
FROM (SELECT req_id, department, seniority_level AS seniority, location, is_niche_location AS niche,
             score AS fill_risk, {BAND_OF} AS band
      FROM (SELECT *, {fixed_score('req_id', 3)} AS score FROM open_reqs))
ORDER BY fill_risk DESC, req_id LIMIT 20"""

SCORED = (
    f"(SELECT {fixed_score('application_id', 3)} AS score, final_outcome = 'withdrawn' AS label FROM stg_applications)"
)
AUC = f"""
SELECT CAST(sum(pos * (2 * below + neg)) AS DOUBLE) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE) * 2) AS auc,
       CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives
FROM (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM (SELECT score, count_if(label) AS pos, count_if(NOT label) AS neg FROM {SCORED} GROUP BY score))"""


def _report_row(name: str, precision: str, recall: str, f1: str, support: str) -> str:
    return (
        f"SELECT '{name}' AS row_name, round({precision}, 6) AS precision, round({recall}, 6) AS recall, "
        f"round({f1}, 6) AS f1, CAST({support} AS BIGINT) AS support FROM m"
    )


def _average(a: str, b: str) -> str:
    return f"(({a}) + ({b})) / 2.0"


def _weighted(a: str, b: str) -> str:
    return f"(({a}) * (tn + fp) + ({b}) * (tp + fn)) / (tp + fp + fn + tn)"


_P0, _R0, _F0 = "1.0 * tn / (tn + fn)", "1.0 * tn / (tn + fp)", "2.0 * tn / (2 * tn + fn + fp)"
_P1, _R1, _F1 = "1.0 * tp / (tp + fp)", "1.0 * tp / (tp + fn)", "2.0 * tp / (2 * tp + fp + fn)"
_ACC = "1.0 * (tp + tn) / (tp + fp + fn + tn)"
REPORT = (
    "SELECT * FROM (WITH m AS (SELECT count_if(label AND score >= 0.5) AS tp, count_if(NOT label AND score >= 0.5) AS fp, "
    "count_if(label AND score < 0.5) AS fn, count_if(NOT label AND score < 0.5) AS tn "
    f"FROM {SCORED})\n"
    + "\nUNION ALL ".join(
        [
            _report_row("stayed", _P0, _R0, _F0, "tn + fp"),
            _report_row("dropped", _P1, _R1, _F1, "tp + fn"),
            _report_row("accuracy", _ACC, _ACC, _ACC, "tp + fp + fn + tn"),
            _report_row("macro avg", _average(_P0, _P1), _average(_R0, _R1), _average(_F0, _F1), "tp + fp + fn + tn"),
            _report_row(
                "weighted avg", _weighted(_P0, _P1), _weighted(_R0, _R1), _weighted(_F0, _F1), "tp + fp + fn + tn"
            ),
        ]
    )
    + ")"
)


def _long(signal: str, select: str, grp: str = "grp", gap: str = "gap", value: str = "value", n: str = "n") -> str:
    return (
        f"SELECT '{signal}' AS signal, {grp} AS grp, {n} AS n, CAST({value} AS DOUBLE) AS value, "
        f"CAST({gap} AS DOUBLE) AS gap FROM ({select})"
    )


SIGNAL_REPORT = "\nUNION ALL ".join(
    [
        _long("referral_accept", REFERRAL),
        _long("below_band_decline", BAND),
        _long("long_dwell_withdrawal", DWELL),
        _long("senior_niche_miss", HARD_TO_FILL),
        _long("outcome_share", OUTCOME_SHARE, "final_outcome", "NULL"),
        *[
            _long(f"seniority_{m}", SENIORITY_PACE, "seniority_level", "NULL", m, "n_hires")
            for m in ("avg_target", "avg_actual", "miss_rate")
        ],
    ]
)

KPI_VIEW = "\nUNION ALL ".join(
    [
        f"SELECT '{section}' AS section, '{metric}' AS metric, CAST({column} AS DOUBLE) AS value FROM ({KPI})"
        for section, metric, column in [
            *[
                ("totals", c, c)
                for c in ("total_applications", "total_offers", "total_hires", "total_requisitions")
            ],
            *[
                ("rates", c, c)
                for c in (
                    "overall_hire_rate",
                    "overall_offer_accept_rate",
                    "overall_dropout_rate",
                    "avg_time_to_fill_days",
                    "target_miss_rate",
                )
            ],
            ("accept_rate", "referral", "referral_accept_rate"),
            ("accept_rate", "non_referral", "non_referral_accept_rate"),
        ]
    ]
)

ORPHANS = "\nUNION ALL ".join(
    f"SELECT '{column}' AS fk, CAST({column} AS VARCHAR) AS orphan_key, count(*) AS row_count FROM dirty_keys "
    f"WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {column_of} FROM {dim}) GROUP BY {column}"
    for column, dim, column_of in (
        ("applicant_key", "dim_applicant", "applicant_key"),
        ("requisition_key", "dim_requisition", "requisition_key"),
        ("recruiter_key", "dim_recruiter", "recruiter_key"),
        ("applied_date_key", "dim_date", "date_key"),
    )
)

ORPHANS_DIRTY = "\nUNION ALL ".join(
    f"SELECT '{table}' AS child, '{column}' AS fk, CAST({column} AS VARCHAR) AS orphan_key, count(*) AS row_count "
    f"FROM {relation(table, True)} WHERE {column} IS NOT NULL AND {column} NOT IN "
    f"(SELECT {parent.split('.')[1]} FROM {relation(parent.split('.')[0], True)} WHERE {parent.split('.')[1]} IS NOT NULL) "
    f"GROUP BY {column}"
    for table, kind, column, parent in DECLARED
    if kind == "relationship"
)

CONTRACT_TABLES = ("applicants", "requisitions", "applications", "stage_history", "interviews", "offers", "hires")
EACH_COUNT = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM stg_{t}" for t in CONTRACT_TABLES
)
ROW_COUNTS = f"{EACH_COUNT} UNION ALL SELECT 'total', CAST(sum(row_count) AS BIGINT) FROM ({EACH_COUNT})"

OPEN_AS_OF = f"""
SELECT r.req_id, r.department, r.seniority_level, r.location, r.location IN {NICHE} AS is_niche_location,
       r.target_time_to_fill_days, count(other.req_id) AS recruiter_concurrent_open_reqs
FROM fact_requisitions r
     LEFT JOIN (SELECT q.*, f.filled_date FROM stg_requisitions q LEFT JOIN fills f ON f.req_id = q.req_id) other
       ON other.recruiter_id = r.recruiter_id AND other.req_id <> r.req_id
          AND other.opened_date <= DATE '2025-03-01' AND coalesce(other.filled_date > DATE '2025-03-01', true)
WHERE NOT r.is_filled
GROUP BY ALL"""

SUMMARY = (
    "SELECT table_name, count_if(passed) AS passed_checks, count(*) AS total_checks, bool_and(passed) AS passed FROM ("
    + "\nUNION ALL ".join([*check_rows(EXPECTED), implication()])
    + ") GROUP BY table_name"
)

# Texts put into every other interview, with the header line of the file inside.
CSV_TABLES = ("applicants", "requisitions", "applications", "stage_history", "interviews", "hires")
INTERVIEW_HEADER = (
    "interview_id,application_id,interview_round,interviewer_id,scheduled_date,completed_flag,feedback_score,feedback_text"
)
CSV_FREE_TEXT = f"""
SELECT interview_id, CASE WHEN length(interview_id) % 2 = 0 THEN
    '"{INTERVIEW_HEADER}"' || chr(10) || chr(10) || ',' || interview_id || ' said ""no"", "' || feedback_text || '"' || chr(10)
    END AS feedback_text
FROM stg_interviews"""

# ---- the split, medians, dictionaries and stored models ---------------------------

DIGEST = "(('0x' || substr(md5({}), 1, 8))::BIGINT % 2147483648)"
SPLIT = f"""
SELECT application_id, label, CASE WHEN place <= max(place) FILTER (WHERE rank <= ceil(0.25 * n)) OVER (PARTITION BY label)
       THEN 'test' ELSE 'train' END AS part
FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY place) AS rank, count(*) OVER (PARTITION BY label) AS n
      FROM (SELECT application_id, final_outcome = 'withdrawn' AS label,
                   {DIGEST.format("'42:' || application_id")} AS place FROM stg_applications))"""

NUMBERS = (
    "resume_years_experience", "interview_rounds_completed", "avg_feedback_score", "min_feedback_score", "interviewer_count",
    "max_gap_between_rounds_days", "max_stage_dwell_days", "recruiter_concurrent_open_reqs", "offer_to_band_ratio",
)
MEDIANS = "\nUNION ALL ".join(f"SELECT '{c}' AS feature, median(CAST({c} AS DOUBLE)) AS median FROM features" for c in NUMBERS)
CATEGORIES = ("candidate_source", "department", "location", "seniority_level")
LEVELS = "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS level, row_number() OVER (ORDER BY {c} COLLATE C) - 1 AS place"
    f" FROM (SELECT DISTINCT {c} FROM features WHERE {c} IS NOT NULL)"
    for c in CATEGORIES
)
ONE_HOT = "SELECT application_id, " + ", ".join(
    f"(SELECT coalesce(string_agg(CASE WHEN l.{c} = f.{c} THEN '1' ELSE '0' END, '' ORDER BY l.{c}), '')"
    f" FROM (SELECT DISTINCT {c} FROM features WHERE {c} IS NOT NULL) l) AS {c}"
    for c in CATEGORIES
) + " FROM features f"

DROP_OFF_MARGIN = """-0.4e0
    + CASE WHEN max_gap_between_rounds_days <= 6 THEN CASE WHEN candidate_source = 'referral' THEN -0.8e0 ELSE -0.1e0 END
           WHEN max_stage_dwell_days <= 9 OR max_stage_dwell_days IS NULL THEN 0.2e0 ELSE 0.9e0 END
    + CASE WHEN avg_feedback_score IS NULL THEN 0.4e0 ELSE -0.05e0 END"""
FILL_MARGIN = """-1.1e0 + 0.004e0 * coalesce(recruiter_concurrent_open_reqs, 12)
    + 0.3e0 * CASE WHEN is_niche_location THEN 1 ELSE 0 END
    + CASE seniority_level WHEN 'principal' THEN 0.8e0 WHEN 'staff' THEN 0.5e0 ELSE 0e0 END
    + CASE WHEN location = 'boise' THEN 0.6e0 ELSE 0e0 END"""
OFFER_MARGIN = """2.5e0 - 3.25e0 * coalesce(CAST(offer_to_band_ratio AS DOUBLE), 1) - 0.02e0 * coalesce(CAST(resume_years_experience AS DOUBLE), 4)
    - 0.4e0 * CASE WHEN referral_flag THEN 1 ELSE 0 END + CASE WHEN candidate_source = 'agency' THEN 0.3e0 ELSE 0e0 END"""


def chance(margin: str, digits: int = 4) -> str:
    return f"round(1 / (1 + exp(-({margin}))), {digits})"


DROPOUT_STORED = RECOMMEND_DROPOUT.replace(fixed_score("application_id", 3), chance(DROP_OFF_MARGIN))
OFFER_STORED = RECOMMEND_OFFER.replace(
    f"SELECT offer_id, f.*, {fixed_score('offer_id', 3)} AS score FROM fact_offers JOIN features f USING (application_id)",
    f"SELECT *, {chance(OFFER_MARGIN)} AS score"
    " FROM (SELECT offer_id, f.* FROM fact_offers JOIN features f USING (application_id))",
)
AT_RISK_STORED = AT_RISK.replace(fixed_score("req_id", 3), chance(FILL_MARGIN))

DROP_OFF_NUMBERS = tuple(c for c in NUMBERS if c != "offer_to_band_ratio")
ECHO = (
    "SELECT application_id, "
    + ", ".join([*DROP_OFF_NUMBERS, *CATEGORIES, "referral_flag", "is_niche_location"])
    + " FROM features"
)
SAMPLES = (
    "SELECT application_id, label, score, CASE WHEN score >= 0.5 THEN 'dropped' ELSE 'stayed' END AS predicted, "
    "CASE WHEN label = 1 THEN 'dropped' ELSE 'stayed' END AS actual, "
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in (*DROP_OFF_NUMBERS, "referral_flag", "is_niche_location"))
    + f", {', '.join(CATEGORIES)} FROM (SELECT *, {chance(DROP_OFF_MARGIN, 6)} AS score, "
    "CAST(label_was_dropped AS DOUBLE) AS label FROM features WHERE label_was_dropped IS NOT NULL) ORDER BY application_id LIMIT 4"
)

OFFER_FEATURES = {
    "offer_to_band_ratio": "offer relative to the band midpoint",
    "resume_years_experience": "years of experience",
    "candidate_source": "channel the candidate came from",
    "department": "hiring department",
    "seniority_level": "level of the role",
    "location": "place of work",
    "referral_flag": "whether the candidate was referred",
    "is_niche_location": "whether few candidates live near the role",
}


def _turn(turn: int, source: str) -> str:
    """One turn of the keyed bijection: half a or b plus a digest of the other."""
    to, other, radix = ("a", "b", "low") if turn % 2 == 0 else ("b", "a", "high")
    number = DIGEST.format(f"'42:' || repeat || ':{turn}:' || {other}")
    return f"(SELECT * REPLACE (({to} + {number}) % {radix} AS {to}) FROM {source})"


def _auc_of(rows: str, by: str) -> str:
    return f"""(SELECT {by}, CAST(sum(pos * (2 * below + neg)) AS DOUBLE) / (CAST(sum(pos) AS DOUBLE) * sum(neg) * 2) AS auc
    FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY {by} ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
          FROM (SELECT {by}, m, count_if(label) AS pos, count_if(NOT label) AS neg FROM {rows} GROUP BY ALL)) GROUP BY {by})"""


_SWAPPED = "\nUNION ALL ".join(
    f"SELECT '{f}' AS feature, repeat, label_offer_declined AS label, {chance(OFFER_MARGIN, 9)} AS m"
    f" FROM (SELECT r.* REPLACE (d.{f} AS {f}), d.repeat FROM placed r JOIN donors d ON d.target = r.pos)"
    for f in OFFER_FEATURES
)
_STEP = "(SELECT pos, repeat, low, high, n, spot % low AS a, spot // low AS b FROM walks WHERE spot >= n OR step = 0)"
for _t in range(4):
    _STEP = _turn(_t, _STEP)
IMPORTANCE_STORED = f"""SELECT * FROM (WITH RECURSIVE placed AS (
    SELECT *, row_number() OVER (ORDER BY application_id) - 1 AS pos FROM features WHERE label_offer_declined IS NOT NULL
), size AS (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS low FROM placed
), walks AS (
    SELECT pos, repeat, low, (n + low - 1) // low AS high, n, pos AS spot, 0 AS step FROM placed, size, range(1, 3) t(repeat)
    UNION ALL
    SELECT w.pos, w.repeat, w.low, w.high, w.n, s.b * s.low + s.a, w.step + 1
    FROM walks w JOIN {_STEP} s ON s.pos = w.pos AND s.repeat = w.repeat WHERE w.spot >= w.n OR w.step = 0
), donors AS (
    SELECT w.spot AS target, w.repeat, p.* FROM walks w JOIN placed p ON p.pos = w.pos WHERE w.step > 0 AND w.spot < w.n
), swapped AS ({_SWAPPED}
), base AS (SELECT auc FROM {_auc_of(f"(SELECT 1 AS one, label_offer_declined AS label, {chance(OFFER_MARGIN, 9)} AS m FROM placed)", "one")})
SELECT feature, CASE feature {' '.join(f"WHEN '{f}' THEN '{d}'" for f, d in OFFER_FEATURES.items())} END AS description,
       round(avg((SELECT auc FROM base) - auc), 6) AS mean, round(stddev_pop((SELECT auc FROM base) - auc), 6) AS sd
FROM {_auc_of("swapped", "feature, repeat")} GROUP BY feature)"""

QUERIES: dict[str, str] = {
    **{f"stg_{t}": f"SELECT * FROM stg_{t}" for t in CONTRACT_TABLES},
    "application_funnel": "SELECT * FROM funnel",
    "hire_pace": "SELECT * FROM pace",
    "offer_outcomes": "SELECT * FROM outcomes",
    "dim_applicant": "SELECT * FROM dim_applicant",
    "dim_requisition": "SELECT * FROM dim_requisition",
    "dim_recruiter": "SELECT * FROM dim_recruiter",
    "dim_date": "SELECT * FROM dim_date",
    "fact_applications": "SELECT * FROM fact_applications",
    "fact_offers": "SELECT * FROM fact_offers",
    "fact_requisitions": "SELECT * FROM fact_requisitions",
    "round_gaps": "SELECT interview_id, application_id, interview_round, scheduled_date, gap_from_prev_round FROM gaps",
    "max_round_gap": "SELECT * FROM max_gaps",
    "req_first_fill": "SELECT * FROM fills",
    "recruiter_load_daily": "SELECT * FROM recruiter_load",
    "lifetime_load": "SELECT * FROM lifetime",
    "open_reqs_as_of": OPEN_AS_OF,
    "ml_features": "SELECT * FROM features",
    "kpi_summary": KPI,
    "kpi_view": KPI_VIEW,
    "signal_referral": REFERRAL,
    "signal_band": BAND,
    "signal_dwell": DWELL,
    "signal_niche": HARD_TO_FILL,
    "seniority_pace": SENIORITY_PACE,
    "outcome_distribution": OUTCOME_SHARE,
    "signal_report": SIGNAL_REPORT,
    "first_touch": """
SELECT a.* EXCLUDE (applied_date), coalesce(min(p.applied_date), a.applied_date) AS applied_date
FROM stg_applicants a LEFT JOIN stg_applications p USING (applicant_id) GROUP BY ALL""".replace(
        "GROUP BY ALL", "GROUP BY applicant_id, source, resume_years_experience, education_level, is_referral, a.applied_date"
    ),
    "outcome_counts": "SELECT final_outcome, count(*) AS application_count FROM stg_applications GROUP BY 1",
    "csv_round_trip": "SELECT * FROM stg_offers",
    **{f"csv_round_trip_{name}": f"SELECT * FROM stg_{name}" for name in CSV_TABLES},
    "csv_free_text": CSV_FREE_TEXT,
    "row_counts": ROW_COUNTS,
    "dq_staging": "\nUNION ALL ".join(check_rows(STAGING)),
    "dq_marts_declared": "\nUNION ALL ".join(check_rows(DECLARED)),
    "dq_marts": "\nUNION ALL ".join(check_rows(EXPECTED)),
    "dq_features": "\nUNION ALL ".join(
        [*check_rows(FEATURES), iff_offer("label_offer_declined"), iff_offer("offer_to_band_ratio")]
    ),
    "dq_orphans": ORPHANS,
    "dq_staging_dirty": "\nUNION ALL ".join(check_rows(STAGING, True)),
    "dq_marts_declared_dirty": "\nUNION ALL ".join(check_rows(DECLARED, True)),
    "dq_marts_dirty": "\nUNION ALL ".join([*check_rows(EXPECTED, True), implication(True)]),
    "dq_features_dirty": "\nUNION ALL ".join(
        [*check_rows(FEATURES, True), iff_offer("label_offer_declined", True), iff_offer("offer_to_band_ratio", True)]
    ),
    "dq_tolerance": "\nUNION ALL ".join(
        [
            mostly_between("mart_ml_features", "max_stage_dwell_days", 0, 10, "0.5", True),
            mostly_between("mart_ml_features", "max_stage_dwell_days", -4, 400, "0.99", True),
            mostly_between("fact_offers", "days_to_respond", 0, 365, "0.95", True),
            pinned("stg_offers", 6095),
            pinned("stg_offers", 6095, True),
        ]
    ),
    "dq_orphans_dirty": ORPHANS_DIRTY,
    "dq_flag_implication": implication(),
    "dq_summary": SUMMARY,
    "recommend_fill": RECOMMEND_FILL,
    "recommend_dropout": RECOMMEND_DROPOUT,
    "recommend_offer": RECOMMEND_OFFER,
    "at_risk_topk": AT_RISK,
    "missing_ids": "SELECT application_id FROM dirty_stg_applications WHERE req_id IS NULL",
    "auc_exact": AUC,
    "classification_report": REPORT,
    "split_rows": f"SELECT application_id, part FROM ({SPLIT})",
    "split_counts": f"SELECT part, label, count(*) AS row_count FROM ({SPLIT}) GROUP BY ALL",
    "impute_medians": MEDIANS,
    "category_levels": LEVELS,
    "one_hot_rows": ONE_HOT,
    "score_applications_stored": DROPOUT_STORED,
    "score_offers_stored": OFFER_STORED,
    "score_requisitions_stored": AT_RISK_STORED,
    "scored_features": ECHO,
    "sample_predictions_stored": SAMPLES,
    "importance_stored": IMPORTANCE_STORED,
    "class_weights": """
SELECT label, count(*) AS "rows", sum(count(*)) OVER () / (2.0 * count(*)) AS weight
FROM (SELECT CAST(final_outcome = 'withdrawn' AS DOUBLE) AS label FROM stg_applications) GROUP BY label""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_relations(select).strip() for name, select in QUERIES.items()}
