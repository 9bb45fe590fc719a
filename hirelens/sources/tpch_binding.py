"""The contract tables derived from the driver's order tables.

No hiring data ships with the driver, so its star schema stands in: parts are
requisitions, customers applicants, orders applications, line items stages and
interviews. All values follow from integer arithmetic on keys, which keeps them
identical in any engine. ``dirty=True`` keeps what the clean variant repairs:
repeated line items, orders without line items, parts without a recruiter.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..domain import DATE_SPINE_START, SENIORITY, SOURCES, STAGES
from ..schemas import CONTRACT
from .tables import Frames

# Fixed values of the stand-in data; three of the places are those that the contract calls niche.
EDUCATION = ("none", "school", "apprenticeship", "degree", "doctorate")
DEPARTMENTS = ("design", "legal", "logistics", "people", "product", "research", "security")
LOCATIONS = ("lisbon", "oslo", "boise", "toronto", "reno", "nairobi", "berlin", "osaka")
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
FEEDBACK = ("Not a fit", "Some gaps", "Acceptable", "Good", "Excellent")


def _array(values: tuple[str, ...]) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def _pick(values: tuple[str, ...], index: str) -> str:
    return f"element_at({_array(values)}, int({index}) + 1)"


def _opened(part: str) -> str:
    return f"date_add(date'{DATE_SPINE_START}', int({part} * 37 % 540))"


def _applied(order: str) -> str:
    return f"date_add({_opened('part')}, int({order} % 46))"


def _application(order: str) -> str:
    return f"concat('APN', {order})"


# Columns of a line item; a number for the one-letter flag keeps their aggregate a hash aggregate.
LINE_COLUMNS = {"quantity": "int(l_quantity)", "supplier": "l_suppkey", "flag": "ascii(l_returnflag)"}
# Line numbers that stand for stages and for interviews, with the columns these read.
STAGE_LINES = (range(1, 6), ("quantity",))
INTERVIEW_LINES = (range(3, 6), ("quantity", "supplier", "flag"))

HAS_OFFER = "(o_orderstatus = 'F' or (o_orderstatus = 'P' and o_orderkey % 4 = 0))"


def _conform(df: DataFrame, table: str, columns: dict[str, str]) -> DataFrame:
    """``columns`` (SQL text by name) cast to the contract's types, in its order."""
    return df.selectExpr(
        *[f"cast({columns[f.name]} as {f.dataType.simpleString()}) as {f.name}" for f in CONTRACT[table].fields]
    )


# Contract tables whose plans end dealt by application, so that they can be stored in buckets of it without an exchange.
BY_APPLICATION = ("applications", "stage_history", "interviews", "offers")


class Binding:
    """Contract tables of one driver directory; every attribute is a lazy frame.

    ``keep`` and ``keep_lines`` may store the orders and the lines that several tables start from;
    they return what is read.
    """

    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        dirty: bool = False,
        keep: Callable[[DataFrame], DataFrame] = lambda orders: orders,
        keep_lines: Callable[[DataFrame], DataFrame] = lambda lines: lines,
    ):
        self.dirty, self.keep, self.keep_lines = dirty, keep, keep_lines
        names = ("customer", "part", "orders", "lineitem")
        self.driver = Frames(names, lambda name: spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))

    def contract(self) -> Frames:
        return Frames(tuple(CONTRACT), lambda name: getattr(self, name))

    @property
    def requisitions(self) -> DataFrame:
        recruiter = "concat('REC', p_partkey % 50)"
        if self.dirty:
            recruiter = f"if(p_partkey % 211 = 0, null, {recruiter})"
        return _conform(
            self.driver["part"],
            "requisitions",
            {
                "req_id": "concat('REQ', p_partkey)",
                "department": f"upper({_pick(DEPARTMENTS, 'p_partkey % 7')})",
                "seniority_level": f"initcap({_pick(SENIORITY, 'p_size % 5')})",
                "location": f"concat({_pick(LOCATIONS, 'p_partkey % 8')}, '  ')",
                "target_time_to_fill_days": "p_size + 45",
                "opened_date": _opened("p_partkey"),
                "hiring_manager_id": "concat('HM', p_partkey % 97)",
                "recruiter_id": recruiter,
            },
        )

    @property
    def applicants(self) -> DataFrame:
        source = _pick(SOURCES, f"array_position({_array(SEGMENTS)}, c_mktsegment) - 1")
        return _conform(
            self.driver["customer"],
            "applicants",
            {
                "applicant_id": "concat('APP', c_custkey)",
                "source": f"concat(' ', initcap({source}))",
                "applied_date": f"date_add(date'{DATE_SPINE_START}', int(c_custkey % 560))",
                "resume_years_experience": "c_nationkey",
                "education_level": _pick(EDUCATION, "c_nationkey % 5"),
                "referral_flag": f"if(c_custkey % 10 = 0, null, {source} = 'referral')",
            },
        )

    @cached_property
    def _orders(self) -> DataFrame:
        """Orders with their application and the smallest part of their line items as ``part``."""
        part = self._lines.select("application_id", "part")
        if self.dirty:
            part = part.groupBy("application_id").agg(F.min("part").alias("part"))
        orders = self.driver["orders"].selectExpr(
            f"{_application('o_orderkey')} as application_id",
            "o_orderkey",
            "o_custkey",
            "o_orderstatus",
            "left(o_orderpriority, 1) as priority",
        )
        return self.keep(orders.join(part, "application_id", "left" if self.dirty else "inner"))

    @property
    def applications(self) -> DataFrame:
        return _conform(
            self._orders,
            "applications",
            {
                "application_id": "application_id",
                "applicant_id": "concat('APP', o_custkey)",
                "req_id": "concat('REQ', part)",
                "applied_date": _applied("o_orderkey"),
                "current_stage": f"upper({_pick(STAGES, 'int(priority) - 1')})",
                "final_outcome": f"""concat(case
                    when o_orderstatus = 'F' then 'hired'
                    when o_orderstatus = 'P' then if({HAS_OFFER}, 'rejected', 'withdrawn')
                    when o_orderkey % 2 = 0 then 'rejected'
                    else 'in_progress' end, ' ')""",
            },
        )

    @cached_property
    def _lines(self) -> DataFrame:
        """Line items by application with their order's ``part``: the only exchange of them.

        Clean: one row per application with the smallest value of each column of each line number.
        Line numbers are few and fixed, so one aggregate holds them all, combined on the map side.
        """
        lines = self.driver["lineitem"].selectExpr(
            f"{_application('l_orderkey')} as application_id", "l_linenumber", "l_partkey", *[f"{c} as {name}" for name, c in LINE_COLUMNS.items()]
        )
        part = F.min("l_partkey").alias("part")
        if self.dirty:
            parts = lines.groupBy("application_id").agg(part)
            return self.keep_lines(lines.drop("l_partkey").join(parts, "application_id"))
        wanted = dict.fromkeys((name, n) for numbers, columns in (STAGE_LINES, INTERVIEW_LINES) for n in numbers for name in columns)
        smallest = [F.expr(f"min({name}) filter (where l_linenumber = {n})").alias(f"{name}_{n}") for name, n in wanted]
        return self.keep_lines(lines.groupBy("application_id").agg(part, *smallest))

    def _numbered(self, numbers: range, columns: tuple[str, ...]) -> DataFrame:
        """Lines numbered in ``numbers``; clean: one row per (l_orderkey, l_linenumber)."""
        key = F.expr("cast(substring(application_id, 4) as bigint)").alias("l_orderkey")
        if self.dirty:
            return self._lines.filter(F.col("l_linenumber").isin(*numbers)).withColumn("l_orderkey", key)
        unfolded = ", ".join(
            f"struct({n} as l_linenumber, " + ", ".join(f"{name}_{n} as {name}" for name in columns) + ")"
            for n in numbers
        )
        unfolding = self._lines.select("application_id", key, "part", F.expr(f"inline(array({unfolded}))"))
        return unfolding.filter("quantity is not null")

    @property
    def stage_history(self) -> DataFrame:
        entered = f"date_add({_applied('l_orderkey')}, (l_linenumber - 1) * 4)"
        return _conform(
            self._numbered(*STAGE_LINES),
            "stage_history",
            {
                "application_id": "application_id",
                "stage_name": f"initcap({_pick(STAGES, 'l_linenumber - 1')})",
                "entered_date": entered,
                "exited_date": f"date_add({entered}, quantity)",
            },
        )

    @property
    def interviews(self) -> DataFrame:
        return _conform(
            self._numbered(*INTERVIEW_LINES),
            "interviews",
            {
                "interview_id": "concat_ws('-', 'INT', l_orderkey, l_linenumber)",
                "application_id": "application_id",
                "interview_round": "l_linenumber - 2",
                "interviewer_id": "concat('IVR', supplier)",
                "scheduled_date": f"date_add({_applied('l_orderkey')}, (l_linenumber - 1) * 4)",
                "completed_flag": "flag <> ascii('R')",
                "feedback_score": "1 + quantity % 5",
                "feedback_text": f"concat(' ', {_pick(FEEDBACK, 'quantity % 5')})",
            },
        )

    @cached_property
    def _offers(self) -> DataFrame:
        """Orders with an offer: its salary, dates and decision."""
        return (
            self._orders.filter(f"{HAS_OFFER} and part is not null")
            .selectExpr(
                "application_id",
                "o_orderkey",
                f"date_add({_applied('o_orderkey')}, 20) as offer_date",
                "80 + o_custkey % 50 as midpoint_k",
                """case when o_orderstatus = 'F' then 'Accepted'
                   when o_orderkey % 45 > 20 then 'Expired' else 'Declined' end as decision""",
            )
            .selectExpr("*", "date_add(offer_date, int(1 + o_orderkey % 45)) as response_date")
        )

    @property
    def offers(self) -> DataFrame:
        return _conform(
            self._offers,
            "offers",
            {
                "offer_id": "concat('OFF', o_orderkey)",
                "application_id": "application_id",
                "offer_date": "offer_date",
                "offer_salary": "midpoint_k * 10 * (75 + o_orderkey % 51)",
                "band_midpoint": "midpoint_k * 1000",
                "response_date": "response_date",
                "decision": "decision",
            },
        )

    @property
    def hires(self) -> DataFrame:
        return _conform(
            self._offers.filter("decision = 'Accepted'"),
            "hires",
            {
                "hire_id": "concat('HIRE', o_orderkey)",
                "offer_id": "concat('OFF', o_orderkey)",
                "start_date": "date_add(response_date, int(7 + o_orderkey % 18))",
            },
        )
