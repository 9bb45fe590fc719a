"""The whole warehouse as one re-runnable job."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from .. import __version__
from ..domain import CONTRACT_VOCABULARY, Vocabulary
from ..quality import (
    FEATURE_CHECKS,
    MART_CHECKS,
    MART_EXPECTATIONS,
    OWN_CHECKS,
    STAGING_CHECKS,
    Check,
    gate,
    run_suite,
    with_values,
)
from ..schemas import CONTRACT
from ..sources import Frames, Tables, at_once, contract_frames, inputs_key, land
from ..sources.contract import FREE_TEXT
from . import dims, facts, features, intermediate
from .staging import stage_all

FEATURE_MART = "mart_ml_features"


# Stored tables with the key that later joins use. These intermediates are
# stored because several marts read each of them, or to keep the plan of the widest narrow; the rest of that layer, like
# staging, stays a set of views.
INTERMEDIATE = {
    "int_application_funnel": "application_id",
    "int_hire_pace": "application_id",
    "int_interview_visits": "application_id",
    "int_interview_rollup": "application_id",
    "int_req_windows": "req_id",
    "int_recruiter_load": "recruiter_id",
}
MARTS = {
    "dim_applicant": "applicant_key",
    "dim_requisition": "req_id",
    "dim_recruiter": "recruiter_key",
    "dim_date": "date_key",
    "fact_applications": "application_id",
    "fact_offers": "application_id",
    "fact_requisitions": "req_id",
    FEATURE_MART: "application_id",
}
# Where raw tables are bucketed on the application, these come out in the same buckets without an exchange.
_ALIGNED = {"int_application_funnel", "int_interview_visits", "int_interview_rollup"}
_BUCKETED = {"int_application_funnel", "int_hire_pace", "int_interview_rollup", "fact_applications", "fact_offers", FEATURE_MART}


class Warehouse:
    """The layers over the seven raw tables.

    ``plan`` is the lazy frame of any derived table. ``table`` is what another
    plan should read: the stored copy, written on first use, if the warehouse
    has storage, else the plan itself.
    """

    def __init__(
        self, spark: SparkSession, raw: Mapping[str, DataFrame], tables: Tables | None = None,
        vocabulary: Vocabulary = CONTRACT_VOCABULARY,
    ):
        self.spark, self.raw, self.tables, self.vocabulary = spark, raw, tables, vocabulary
        self.stg = stage_all(raw)
        self.plans = Frames(("int_offer_outcomes", *INTERMEDIATE, *MARTS), self._plan)
        self.stored: dict[str, DataFrame] = {}

    def plan(self, name: str) -> DataFrame:
        return self.plans[name]

    def table(self, name: str) -> DataFrame:
        if name in self.stored:
            return self.stored[name]
        if self.tables is None or name not in {**INTERMEDIATE, **MARTS}:
            return self.plan(name)
        return self.store(name)

    def store(self, name: str) -> DataFrame:
        """Write one table; plans made afterwards read the files."""
        layer, key = ("marts", MARTS[name]) if name in MARTS else ("intermediate", INTERMEDIATE[name])
        bucketed = _ALIGNED if self.tables.root else _BUCKETED
        self.stored[name] = self.tables.write(self.plan(name), layer, name, (key,) if name in bucketed else ())
        return self.stored[name]

    def reopen(self, names: Collection[str]) -> None:
        """Take tables as an earlier run stored them."""
        for name in set(names) - set(self.stored):
            self.stored[name] = self.tables.read("marts" if name in MARTS else "intermediate", name)

    def staged(self) -> Frames:
        return Frames([f"stg_{name}" for name in self.stg], lambda name: self.stg[name.removeprefix("stg_")])

    def marts(self) -> Frames:
        return Frames(tuple(MARTS), self.table)

    def _plan(self, name: str) -> DataFrame:
        s, t = self.stg, self.table
        match name:
            case "int_application_funnel":
                return intermediate.application_funnel(s["applications"], s["stage_history"])
            case "int_hire_pace":
                return intermediate.hire_pace(s["hires"], s["offers"], s["applications"], s["requisitions"])
            case "int_offer_outcomes":
                return intermediate.offer_outcomes(s["offers"])
            case "int_req_windows":
                return intermediate.req_windows(s["requisitions"], intermediate.first_fill(t("int_hire_pace")))
            case "dim_applicant":
                return dims.dim_applicant(s["applicants"])
            case "int_interview_rollup":
                return facts.interview_rollup(t("int_interview_visits"))
            case "int_interview_visits":
                return facts.interview_visits(s["interviews"])
            case "int_recruiter_load":
                return features.load_curve(t("int_req_windows"), s["applications"])
            case "dim_requisition":
                return dims.dim_requisition(s["requisitions"], self.vocabulary.niche_locations)
            case "dim_recruiter":
                return dims.dim_recruiter(s["requisitions"])
            case "dim_date":
                return dims.dim_date(self.spark, self.vocabulary.first_day, self.vocabulary.end_day)
            case "fact_applications":
                return facts.fact_applications(
                    t("int_application_funnel"), s["requisitions"], t("int_interview_rollup"), t("int_hire_pace")
                )
            case "fact_offers":
                return facts.fact_offers(t("int_offer_outcomes"), s["applications"], s["requisitions"])
            case "fact_requisitions":
                return facts.fact_requisitions(
                    s["requisitions"], intermediate.with_drop_flags(s["applications"]), t("int_hire_pace")
                )
            case "mart_ml_features":
                return features.ml_features(
                    t("int_application_funnel"),
                    s["applicants"],
                    t("int_req_windows"),
                    t("int_interview_rollup"),
                    t("int_recruiter_load"),
                    t("int_offer_outcomes"),
                    t("int_hire_pace"),
                    self.vocabulary.niche_locations,
                )
        raise KeyError(name)


def build(
    spark: SparkSession, src: str, tables: Tables, strict: bool = True, force: bool = False,
    multi_line: Collection[str] = FREE_TEXT, keep: int = 2, vocabulary: Vocabulary = CONTRACT_VOCABULARY,
) -> dict[str, int] | None:
    """Land, clean, join, check and publish; the rows landed, or None when that is done already.

    The build writes a new generation of tables. Readers (``open_warehouse``) keep the published
    one, whole, until the new one has passed all its checks; with ``strict`` a failed check stops
    the build before anything that depends on the table is written. After publishing, all but the
    last ``keep`` published generations are removed.

    Whether there is anything to do follows from the content of the inputs, not from file names
    or times: one pass over them gives a fingerprint. An interrupted or failed build of the same
    inputs resumes behind its last finished step; ``force`` starts anew. Tables in ``multi_line``
    may hold line breaks inside quotes. ``vocabulary`` gives the value lists that the checks
    accept, the niche places and the days of the calendar.
    """
    frames = contract_frames(spark, src, multi_line)
    inputs = inputs_key(frames, strict=strict, version=__version__, vocabulary=vocabulary)
    ledger = tables.ledger
    pointer = ledger.current()
    if not force and pointer is not None and pointer.inputs == inputs and tables.is_built():
        return None
    generation = ledger.begin(inputs, fresh=force)
    fresh = tables.at(generation)
    finished = ledger.steps(generation)

    def step(name: str, work: Callable[[], object]) -> None:
        if name not in finished:
            work()
            ledger.append(generation, name, inputs)

    step("land", lambda: land(frames, fresh))
    house = Warehouse(spark, _raw(fresh), fresh, vocabulary)

    def check(frames: Mapping[str, DataFrame], checks: Sequence[Check]) -> None:
        gate(run_suite(frames, with_values(checks, vocabulary.values())))

    for name, df in house.staged().items():
        fresh.view(df, name)
    if strict:
        step("check staging", lambda: check(house.staged(), STAGING_CHECKS))
    first = ("int_application_funnel", "int_hire_pace", "int_interview_visits")
    step("intermediate", lambda: _store(house, first, ("int_interview_rollup", "int_req_windows"), ("int_recruiter_load",)))
    house.reopen(INTERMEDIATE)
    fresh.view(house.plan("int_offer_outcomes"), "int_offer_outcomes")
    facts = [name for name in MARTS if name != FEATURE_MART]
    step("marts", lambda: _store(house, facts))
    house.reopen(facts)
    if strict:
        marts = [*MART_CHECKS, *OWN_CHECKS, *MART_EXPECTATIONS]
        step("check marts", lambda: check(house.marts(), marts))
    step("features", lambda: _store(house, (FEATURE_MART,)))
    house.reopen((FEATURE_MART,))
    if strict:
        step("check features", lambda: check(house.marts(), FEATURE_CHECKS))
    landed = {name: df.count() for name, df in house.raw.items()}
    fresh.publish(inputs, keep)
    return {**landed, "total": sum(landed.values())}


def _store(house: Warehouse, *groups: Collection[str]) -> None:
    """Write tables, those of a group at once; a group may read the ones before it."""
    for names in groups:
        at_once(house.store, names)


def open_warehouse(spark: SparkSession, tables: Tables) -> Warehouse:
    """The published build, read from storage; an error when nothing is published.

    A warehouse once opened stays at its generation, whatever is published meanwhile.
    """
    current = tables.current()
    house = Warehouse(spark, _raw(current), current)
    house.reopen({**INTERMEDIATE, **MARTS})
    return house


def _raw(tables: Tables) -> Frames:
    return Frames(tuple(CONTRACT), lambda name: tables.read("raw", name))
