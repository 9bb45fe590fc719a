"""The seven contract tables. Column order is the contract: CSVs load by position."""

from pyspark.sql import types as T

STRING, DATE, INT, BOOL = T.StringType(), T.DateType(), T.IntegerType(), T.BooleanType()
YEARS, MONEY = T.DecimalType(5, 1), T.DecimalType(12, 2)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


CONTRACT: dict[str, T.StructType] = {
    "applicants": _struct(
        applicant_id=STRING,
        source=STRING,
        applied_date=DATE,
        resume_years_experience=YEARS,
        education_level=STRING,
        referral_flag=BOOL,
    ),
    "requisitions": _struct(
        req_id=STRING,
        department=STRING,
        seniority_level=STRING,
        location=STRING,
        target_time_to_fill_days=INT,
        opened_date=DATE,
        hiring_manager_id=STRING,
        recruiter_id=STRING,
    ),
    "applications": _struct(
        application_id=STRING,
        applicant_id=STRING,
        req_id=STRING,
        applied_date=DATE,
        current_stage=STRING,
        final_outcome=STRING,
    ),
    "stage_history": _struct(
        application_id=STRING,
        stage_name=STRING,
        entered_date=DATE,
        exited_date=DATE,
    ),
    "interviews": _struct(
        interview_id=STRING,
        application_id=STRING,
        interview_round=INT,
        interviewer_id=STRING,
        scheduled_date=DATE,
        completed_flag=BOOL,
        feedback_score=INT,
        feedback_text=STRING,
    ),
    "offers": _struct(
        offer_id=STRING,
        application_id=STRING,
        offer_date=DATE,
        offer_salary=MONEY,
        band_midpoint=MONEY,
        response_date=DATE,
        decision=STRING,
    ),
    "hires": _struct(
        hire_id=STRING,
        offer_id=STRING,
        start_date=DATE,
    ),
}
