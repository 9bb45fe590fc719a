
from __future__ import annotations

import datetime
import hashlib
import math
import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens import operators as ops
from hirelens.ml.metrics import classification_report, roc_auc
from hirelens.ml.importance import permutation_importance
from hirelens.ml.prep import LINEAR, TREES, class_weights
from hirelens.ml.ranks import medians
from hirelens.ml.spec import DROP_OFF, MODELS, OFFER_DECLINE, TIME_TO_FILL, ModelSpec
from hirelens.ml.split import stratified_split
from hirelens.ml.train import (
    TrainedModel,
    TrainResult,
    importance_view,
    load,
    metrics_frame,
    sample_predictions,
    save,
    train,
)
from hirelens.ml.vocabulary import level_table, levels, one_hot
from hirelens.plans import dims, features, kpi, signals
from hirelens.plans.intermediate import req_first_fill, with_drop_flags
from hirelens.plans.staging import stage
from hirelens.plans.warehouse import Warehouse
from hirelens.quality import (
    FEATURE_CHECKS,
    MART_CHECKS,
    MART_EXPECTATIONS,
    OWN_CHECKS,
    STAGING_CHECKS,
    Check,
    between,
    orphans,
    row_count,
    run_suite,
    summarise,
)
from hirelens.schemas import CONTRACT
from hirelens.scoring import (
    at_risk_view,
    missing_ids,
    open_requisitions,
    rank_at_risk,
    recommend_dropout,
    recommend_fill,
    recommend_offer,
    score_applications,
    score_offers,
    score_open_requisitions,
)
from hirelens.session import configure, shared_dir
from hirelens.sources import Frames, Tables, read_contract_csv, row_counts, signature, write_csv
from hirelens.sources.tpch_binding import BY_APPLICATION, Binding
from oracle import oracle_sql as _oracle_sql

try:  # the training-data operators may be left out of an installation
    import corpus_pipeline
    from hirelens.llm import queries as _llm
except ImportError as error:
    if error.name not in ("corpus_pipeline", "hirelens.llm"):
        raise
    _llm = None

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime.date(2025, 3, 1)


_houses: dict[tuple, Warehouse] = {}
DRIVER_TABLES = ("customer", "part", "orders", "lineitem")


def _house(spark: SparkSession, sf_dir: str, dirty: bool = False) -> Warehouse:
    """The warehouse over a driver directory, landed once per session and state of its files.

    Contract tables are written to the shared folder first, as a load would
    leave them; intermediates and marts follow when a query first reads them.
    """
    configure(spark)
    session = spark.sparkContext.applicationId
    files = signature(spark, *(f"{sf_dir.rstrip('/')}/{name}.parquet" for name in DRIVER_TABLES))
    key = (session, sf_dir, dirty, files)
    if key not in _houses:
        variant = hashlib.sha256(repr(key[1:]).encode()).hexdigest()[:16]
        tables = Tables(spark, f"{shared_dir(spark)}/{session}/{variant}", buckets=_buckets(spark, sum(f[1] for f in files)))
        orders, lines = (partial(tables.write, layer="raw", name=name, bucket_by=("application_id",)) for name in ("orders", "lines"))
        raw = Frames(tuple(CONTRACT), partial(_landed, Binding(spark, sf_dir, dirty, orders, lines).contract(), tables))
        _houses[key] = Warehouse(spark, raw, tables)
    return _houses[key]


def _buckets(spark: SparkSession, size: int) -> int:
    """Buckets of about a MB of the driver's files, eight at least, into which shuffle partitions divide."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(8, size >> 20)
    return max(n for n in range(1, partitions + 1) if partitions % n == 0 and n <= wanted)


def _landed(contract: Frames, tables: Tables, name: str) -> DataFrame:
    return tables.write(contract[name], "raw", name, ("application_id",) if name in BY_APPLICATION else ())


def _lazy_house(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The same plans straight over the driver tables, nothing stored."""
    configure(spark)
    return Warehouse(spark, Binding(spark, sf_dir).contract())


def _doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparison with engines that average in doubles."""
    return df.select(
        *[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes]
    )


def _plan(name: str) -> Query:
    """The plan of one table; the tables below it may be stored."""
    return lambda spark, sf_dir: _doubles(_house(spark, sf_dir).plan(name))


def _staged(name: str) -> Query:
    return lambda spark, sf_dir: _doubles(_lazy_house(spark, sf_dir).stg[name])


def _on(plan: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, sf_dir: _doubles(plan(_house(spark, sf_dir)))


def _suite(checks: list[Check]) -> Query:
    return _on(lambda h: run_suite(h.marts(), checks))


# ---- plans over the warehouse -------------------------------------------------


def _dim_date(h: Warehouse) -> DataFrame:
    dates = h.stg["requisitions"].select(F.col("opened_date").alias("day")).unionByName(
        h.stg["hires"].select(F.col("start_date").alias("day"))
    )
    return dims.dim_date_covering(dates, "day")


def _round_gaps(h: Warehouse) -> DataFrame:
    visits = h.stg["interviews"].select("interview_id", "application_id", "interview_round", "scheduled_date")
    return ops.round_gaps(visits, "application_id", "interview_round", "scheduled_date", "interview_id")


def _max_round_gap(h: Warehouse) -> DataFrame:
    return ops.max_round_gap(
        h.stg["interviews"], "application_id", "interview_round", "scheduled_date", "max_gap_between_rounds_days"
    )


def _recruiter_load(h: Warehouse) -> DataFrame:
    return features.recruiter_load(h.stg["applications"], h.table("int_req_windows"))


def _first_fill(h: Warehouse) -> DataFrame:
    return req_first_fill(h.stg["hires"], h.stg["offers"], h.stg["applications"])


def _open_reqs(h: Warehouse) -> DataFrame:
    return open_requisitions(h.table("fact_requisitions"), h.table("dim_requisition"), h.stg["requisitions"])


def _open_reqs_as_of(h: Warehouse) -> DataFrame:
    return open_requisitions(
        h.table("fact_requisitions"),
        h.table("dim_requisition"),
        h.stg["requisitions"],
        "as_of",
        h.table("int_req_windows"),
        AS_OF,
    )


def _kpis(h: Warehouse) -> DataFrame:
    return kpi.kpi_summary(
        h.table("fact_applications"), h.table("fact_offers"), h.table("fact_requisitions"), h.table("dim_applicant")
    )


def _signal_report(h: Warehouse) -> DataFrame:
    return signals.signal_report(
        h.table("fact_offers"),
        h.table("dim_applicant"),
        h.table("mart_ml_features"),
        h.table("int_hire_pace"),
        h.stg["applications"],
    )


def _first_touch(h: Warehouse) -> DataFrame:
    return ops.first_touch(h.stg["applicants"], h.stg["applications"], "applicant_id", "applied_date")


def _dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Foreign keys without a parent in the variant that keeps orphans."""
    clean, dirty = _house(spark, sf_dir), _house(spark, sf_dir, dirty=True)
    facts = dirty.table("fact_applications")
    parents = {
        "applicant_key": ("dim_applicant", "applicant_key"),
        "requisition_key": ("dim_requisition", "requisition_key"),
        "recruiter_key": ("dim_recruiter", "recruiter_key"),
        "applied_date_key": ("dim_date", "date_key"),
    }
    return reduce(
        DataFrame.unionByName,
        [
            orphans(facts, fk, clean.table(parent), column).select(
                F.lit(fk).alias("fk"), F.col(fk).cast("string").alias("orphan_key"), "row_count"
            )
            for fk, (parent, column) in parents.items()
        ],
    )


# Planted faults by table: the id that draws them, and what a column then holds (None: nulls alone).
SOILED: dict[str, tuple[str, dict[str, object]]] = {
    "stg_applicants": ("applicant_id", {"applicant_id": "gone", "source": "radio", "is_referral": None}),
    "stg_requisitions": ("req_id", {"req_id": "gone", "seniority_level": "boss", "target_time_to_fill_days": None}),
    "stg_applications": (
        "application_id",
        {"application_id": "gone", "applicant_id": None, "req_id": None, "final_outcome": "lost"},
    ),
    "stg_stage_history": ("application_id", {"application_id": "gone", "stage_name": None}),
    "stg_interviews": ("interview_id", {"interview_id": "gone", "application_id": None, "feedback_score": 9}),
    "stg_offers": ("offer_id", {"offer_id": "gone", "application_id": None, "decision": "maybe"}),
    "stg_hires": ("hire_id", {"hire_id": "gone", "offer_id": "gone"}),
    "dim_applicant": ("applicant_id", {"applicant_key": "parent", "applicant_id": "gone"}),
    "dim_requisition": ("req_id", {"requisition_key": "parent", "req_id": "gone", "seniority_level": "boss"}),
    "dim_recruiter": ("recruiter_id", {"recruiter_key": "parent", "recruiter_id": "gone"}),
    "dim_date": ("date_day", {"date_key": 17760704, "date_day": None}),
    "fact_applications": (
        "application_id",
        {
            **dict.fromkeys(("applicant_key", "requisition_key", "recruiter_key"), "orphan"),
            "applied_date_key": 19000101,
            "final_outcome": "lost",
            "actual_time_to_fill_days": -3,
            "min_feedback_score": 0,
            "avg_feedback_score": 7,
            "application_id": "gone",
        },
    ),
    "fact_offers": (
        "offer_id",
        {
            **dict.fromkeys(("application_id", "applicant_key", "requisition_key", "recruiter_key"), "orphan"),
            "offer_date_key": 19000101,
            "decision": "maybe",
            "days_to_respond": 400,
            "offer_id": "gone",
        },
    ),
    "fact_requisitions": (
        "req_id",
        {
            **dict.fromkeys(("requisition_key", "recruiter_key"), "orphan"),
            "opened_date_key": 19000101,
            "avg_time_to_fill_days": 1001,
            "max_time_to_fill_days": -1,
            "any_hire_missed_target": False,
            "req_id": "gone",
        },
    ),
    "mart_ml_features": (
        "application_id",
        {
            "candidate_source": "radio",
            "seniority_level": "boss",
            **dict.fromkeys(("referral_flag", "interview_rounds_completed", "recruiter_concurrent_open_reqs")),
            "max_stage_dwell_days": -5,
            **dict.fromkeys(("reached_offer_stage", "label_was_dropped", "label_offer_declined", "offer_to_band_ratio")),
            "application_id": "gone",
        },
    ),
}
NULL_SHARE, WRONG_SHARE, TWICE_SHARE = 23, 31, 29


def _soil(table: str, df: DataFrame) -> DataFrame:
    """``df`` with nulls, wrong values and repeated rows where a digest of the id says so."""
    id_col, columns = SOILED[table]

    def drawn(tag: str, share: int) -> Column:
        digits = F.substring(F.md5(F.concat(F.lit(f"{tag}:"), F.col(id_col).cast("string")).cast("binary")), 1, 8)
        return F.conv(digits, 16, 10).cast("long") % share == 0

    twice = df.unionByName(df.filter(drawn("twice", TWICE_SHARE)))
    types = dict(df.dtypes)
    soiled = {}
    for c, wrong in columns.items():
        value = F.col(c) if wrong is None else F.when(drawn(f"{c} wrong", WRONG_SHARE), F.lit(wrong).cast(types[c])).otherwise(F.col(c))
        soiled[c] = F.when(~drawn(f"{c} null", NULL_SHARE), value)
    return twice.select(*[soiled[c].alias(c) if c in soiled else F.col(c) for c in df.columns])


def _soiled(h: Warehouse) -> Frames:
    staged, marts = h.staged(), h.marts()  # a table is stored when a check names it
    return Frames(tuple(SOILED), lambda name: _soil(name, (staged if name.startswith("stg_") else marts)[name]))


def _dirty_suite(checks: list[Check]) -> Query:
    return _on(lambda h: run_suite(_soiled(h), checks))


def _tolerances(h: Warehouse) -> DataFrame:
    """Checks that allow a share of wrong rows, and pinned row counts."""
    soiled = _soiled(h)
    loose = [
        between("mart_ml_features", "max_stage_dwell_days", 0, 10, mostly=0.5),
        between("mart_ml_features", "max_stage_dwell_days", -4, 400, mostly=0.99),
        between("fact_offers", "days_to_respond", 0, 365, mostly=0.95),
        row_count("stg_offers", 6095),
    ]
    return run_suite(h.staged(), [row_count("stg_offers", 6095)]).unionByName(run_suite(soiled, loose))


def _dq_orphans_dirty(h: Warehouse) -> DataFrame:
    """Keys without a parent over all relationships, children and parents both soiled."""
    soiled = _soiled(h)
    found = []
    for check in [*MART_CHECKS, *OWN_CHECKS]:
        if check.kind == "relationship":
            keys = orphans(soiled[check.table], check.column, soiled[check.parent[0]], check.parent[1])
            key = F.col(check.column).cast("string").alias("orphan_key")
            found.append(keys.select(F.lit(check.table).alias("child"), F.lit(check.column).alias("fk"), key, "row_count"))
    return reduce(DataFrame.unionByName, found)


def _csv_again(h: Warehouse, table: str, df: DataFrame) -> DataFrame:
    """``df`` written as the contract file of a table and read back by position."""
    folder = h.tables.location("csv", uuid.uuid4().hex)
    write_csv(df, f"{folder}/{table}.csv")
    return read_contract_csv(h.spark, folder, table)


def _csv_round_trip(table: str) -> Query:
    """A contract table written as CSV, read back and staged."""
    return _on(lambda h: stage(_csv_again(h, table, h.raw[table]), table))


def _csv_free_text(h: Warehouse) -> DataFrame:
    """Interviews whose texts hold quotes, commas, line breaks and header lines, written and read back."""
    head = ",".join(CONTRACT["interviews"].names)
    planted = F.concat(F.lit(f'"{head}"\n\n,'), "interview_id", F.lit(' said ""no"", "'), F.trim("feedback_text"), F.lit('"\n'))
    texts = h.raw["interviews"].withColumn("feedback_text", F.when(F.length("interview_id") % 2 == 0, planted))
    return _csv_again(h, "interviews", texts).select("interview_id", "feedback_text")


# ---- rules and metrics over a fixed score -------------------------------------


def _fixed(df: DataFrame, id_col: str, out: str = "score") -> DataFrame:
    """A reproducible score in [0, 1) from the digits of an id with a 3-letter prefix."""
    number = F.substring(F.col(id_col), 4, 18).cast("long")
    return df.withColumn(out, (number * 7919 % 10000) / F.lit(10000.0))


def _flat(df: DataFrame, id_col: str) -> DataFrame:
    action = F.col("recommended_action")
    return df.select(
        id_col,
        "score",
        action["risk_band"].alias("risk_band"),
        action["recommendation"].alias("recommendation"),
        F.concat_ws(" | ", action["rationale"]).alias("rationale"),
    )


def _recommend_fill(h: Warehouse) -> DataFrame:
    action = recommend_fill(
        F.col("score"),
        F.col("is_niche_location"),
        F.col("seniority_level"),
        F.col("recruiter_concurrent_open_reqs"),
    )
    return _flat(_fixed(_open_reqs(h), "req_id").withColumn("recommended_action", action), "req_id")


def _recommend_dropout(h: Warehouse) -> DataFrame:
    action = recommend_dropout(
        F.col("score"), F.col("max_stage_dwell_days"), F.col("interview_rounds_completed")
    )
    scored = _fixed(h.table("mart_ml_features"), "application_id")
    return _flat(scored.withColumn("recommended_action", action), "application_id")


def _recommend_offer(h: Warehouse) -> DataFrame:
    action = recommend_offer(F.col("score"), F.col("offer_to_band_ratio"), F.col("referral_flag"))
    offers = h.table("fact_offers").select("offer_id", "application_id")
    scored = _fixed(offers.join(h.table("mart_ml_features"), "application_id"), "offer_id")
    return _flat(scored.withColumn("recommended_action", action), "offer_id")


def _at_risk(h: Warehouse) -> DataFrame:
    return at_risk_view(rank_at_risk(_fixed(_open_reqs(h), "req_id", "fill_risk_score")))


def _scored_labels(h: Warehouse) -> DataFrame:
    dropped = with_drop_flags(h.stg["applications"])
    return _fixed(dropped, "application_id").select("application_id", F.col("was_dropped").alias("label"), "score")


def _classification(h: Warehouse) -> DataFrame:
    report = classification_report(_scored_labels(h), "label", "score", ("stayed", "dropped"))
    return report.select(
        "row_name", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support"
    )


def _class_weights(h: Warehouse) -> DataFrame:
    labels = _scored_labels(h).select(F.col("label").cast("double").alias("label"))
    return class_weights(labels, "label")


def _split_counts(h: Warehouse) -> DataFrame:
    labels = _scored_labels(h)
    parts = zip(("train", "test"), stratified_split(labels, "label", "application_id"))
    return reduce(
        DataFrame.unionByName,
        [
            df.groupBy("label").agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("part"), "label", "row_count")
            for n, df in parts
        ],
    )


def _split_rows(h: Warehouse) -> DataFrame:
    """Each application's side of the split."""
    train_rows, test_rows = stratified_split(_scored_labels(h), "label", "application_id")
    sides = [df.select("application_id", F.lit(n).alias("part")) for n, df in (("train", train_rows), ("test", test_rows))]
    return sides[0].unionByName(sides[1])


def _impute_medians(h: Warehouse) -> DataFrame:
    """The exact median of every number a model sees, over the whole feature mart."""
    numbers = sorted({c for spec in MODELS.values() for c in spec.numeric})
    found = medians(h.table("mart_ml_features"), numbers)
    return h.spark.createDataFrame(list(found.items()), "feature string, median double")


CATEGORIES = sorted({c for spec in MODELS.values() for c in spec.categorical})


def _one_hot_rows(h: Warehouse) -> DataFrame:
    """Each application's categories as zeros and ones, in the dictionary's order."""
    features = h.table("mart_ml_features")
    hot = one_hot(features, levels(features, CATEGORIES))
    return hot.select("application_id", *[F.concat_ws("", f"{c}_hot").alias(c) for c in CATEGORIES])


# ---- models as stored tables -----------------------------------------------------

# Small models written down here: they are saved, read back and applied like trained ones.
_LEAF = (None, None, None, None)
STORED = {
    DROP_OFF.name: TrainedModel(
        DROP_OFF,
        TREES,
        (
            (0, 0, "max_gap_between_rounds_days", 6.0, None, False, None),
            (0, 1, "candidate_source", None, "referral", False, None),
            (0, 2, "max_stage_dwell_days", 9.0, None, True, None),
            (0, 3, *_LEAF, -0.8),
            (0, 4, *_LEAF, -0.1),
            (0, 5, *_LEAF, 0.2),
            (0, 6, *_LEAF, 0.9),
            (1, 0, "avg_feedback_score", math.inf, None, False, None),
            (1, 1, *_LEAF, -0.05),
            (1, 2, *_LEAF, 0.4),
        ),
        -0.4,
    ),
    TIME_TO_FILL.name: TrainedModel(
        TIME_TO_FILL,
        LINEAR,
        (
            (None, None, -1.1, None),
            ("recruiter_concurrent_open_reqs", None, 0.004, 12.0),
            ("seniority_level", "principal", 0.8, None),
            ("seniority_level", "staff", 0.5, None),
            ("location", "boise", 0.6, None),
            ("is_niche_location", None, 0.3, 0.0),
        ),
    ),
    OFFER_DECLINE.name: TrainedModel(
        OFFER_DECLINE,
        LINEAR,
        (
            (None, None, 2.5, None),
            ("offer_to_band_ratio", None, -3.25, 1.0),
            ("resume_years_experience", None, -0.02, 4.0),
            ("candidate_source", "agency", 0.3, None),
            ("referral_flag", None, -0.4, 0.0),
        ),
    ),
}


def _stored(h: Warehouse, spec: ModelSpec) -> TrainedModel:
    folder = h.tables.location("models", "stored")
    save(STORED[spec.name], folder)
    return load(h.spark, folder, spec.name)


def _scored_flat(df: DataFrame, id_col: str, score: str) -> DataFrame:
    return _flat(df.withColumnRenamed(score, "score"), id_col)


def _stored_applications(h: Warehouse) -> DataFrame:
    scored = score_applications(h.table("mart_ml_features"), _stored(h, DROP_OFF).score)
    return _scored_flat(scored, "application_id", "dropout_risk_score")


def _stored_offers(h: Warehouse) -> DataFrame:
    scored = score_offers(h.table("fact_offers"), h.table("mart_ml_features"), _stored(h, OFFER_DECLINE).score)
    return _scored_flat(scored, "offer_id", "decline_risk_score")


def _stored_requisitions(h: Warehouse) -> DataFrame:
    return at_risk_view(score_open_requisitions(_open_reqs(h), _stored(h, TIME_TO_FILL).score))


def _features_echo(h: Warehouse) -> DataFrame:
    """The features that come back with each scored application."""
    return score_applications(h.table("mart_ml_features"), _stored(h, DROP_OFF).score).select("application_id", "features.*")


def _stored_importance(h: Warehouse) -> DataFrame:
    """Permutation importance of the stored offer model over all labelled offers.

    Scores are rounded, so that equal ones are equal in any engine.
    """
    model, test = _stored(h, OFFER_DECLINE), OFFER_DECLINE.labelled(h.table("mart_ml_features"))

    def score(df: DataFrame) -> DataFrame:
        return model.score(df).withColumn("score", F.round("score", 9))

    base = roc_auc(score(test), "label", "score").first()["auc"]
    found = permutation_importance(score, test, OFFER_DECLINE, test.count(), base, repeats=2)
    return importance_view(found, len(OFFER_DECLINE.features)).select(
        "feature", "description", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd")
    )


def _stored_samples(h: Warehouse) -> DataFrame:
    test = DROP_OFF.labelled(h.table("mart_ml_features"))
    return sample_predictions(_stored(h, DROP_OFF), test).withColumn("score", F.round("score", 6))


def _missing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applications asked for that have no features: those without a requisition."""
    asked = _house(spark, sf_dir, dirty=True).stg["applications"].select("application_id")
    return missing_ids(asked, _house(spark, sf_dir).table("mart_ml_features"), "application_id")


# ---- models --------------------------------------------------------------------

_trained: dict[tuple[str, str], TrainResult] = {}


def _train(spark: SparkSession, sf_dir: str, spec: ModelSpec) -> TrainResult:
    """One training per warehouse and model; several queries use it."""
    house = _house(spark, sf_dir)
    key = (house.tables.root, spec.name)
    if key not in _trained:
        _trained[key] = train(house.table("mart_ml_features"), spec)
    return _trained[key]


def _metrics(spec: ModelSpec) -> Query:
    return lambda spark, sf_dir: metrics_frame(spark, _train(spark, sf_dir, spec))


def _importance(spec: ModelSpec) -> Query:
    return lambda spark, sf_dir: importance_view(_train(spark, sf_dir, spec).importance(), len(spec.features))


def _score_requisitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    scorer = _train(spark, sf_dir, TIME_TO_FILL).model.score
    return score_open_requisitions(_open_reqs(_house(spark, sf_dir)), scorer)


def _score_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    scorer = _train(spark, sf_dir, DROP_OFF).model.score
    return score_applications(_house(spark, sf_dir).table("mart_ml_features"), scorer)


def _score_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    scorer = _train(spark, sf_dir, OFFER_DECLINE).model.score
    house = _house(spark, sf_dir)
    return score_offers(house.table("fact_offers"), house.table("mart_ml_features"), scorer)


def entry(spark: SparkSession) -> DataFrame:
    """The feature mart: every application with its features and labels."""
    return _plan("mart_ml_features")(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return {
        **{
            f"stg_{name}": _staged(name)
            for name in (
                "applicants",
                "requisitions",
                "applications",
                "stage_history",
                "interviews",
                "offers",
                "hires",
            )
        },
        "application_funnel": _plan("int_application_funnel"),
        "hire_pace": _plan("int_hire_pace"),
        "offer_outcomes": _plan("int_offer_outcomes"),
        "dim_applicant": _plan("dim_applicant"),
        "dim_requisition": _plan("dim_requisition"),
        "dim_recruiter": _plan("dim_recruiter"),
        "dim_date": _on(_dim_date),
        "fact_applications": _plan("fact_applications"),
        "fact_offers": _plan("fact_offers"),
        "fact_requisitions": _plan("fact_requisitions"),
        "round_gaps": _on(_round_gaps),
        "max_round_gap": _on(_max_round_gap),
        "req_first_fill": _on(_first_fill),
        "recruiter_load_daily": _on(_recruiter_load),
        "lifetime_load": _on(
            lambda h: ops.lifetime_load(h.stg["requisitions"], "recruiter_id", "recruiter_concurrent_open_reqs")
        ),
        "open_reqs_as_of": _on(_open_reqs_as_of),
        "ml_features": _plan("mart_ml_features"),
        "kpi_summary": _on(_kpis),
        "kpi_view": _on(lambda h: kpi.kpi_view(_kpis(h))),
        "signal_referral": _on(lambda h: signals.signal_referral(h.table("fact_offers"), h.table("dim_applicant"))),
        "signal_band": _on(lambda h: signals.signal_band(h.table("fact_offers"))),
        "signal_dwell": _on(lambda h: signals.signal_dwell(h.table("mart_ml_features"))),
        "signal_niche": _on(lambda h: signals.signal_niche(h.table("int_hire_pace"))),
        "seniority_pace": _on(lambda h: signals.seniority_pace(h.table("int_hire_pace"))),
        "outcome_distribution": _on(lambda h: signals.outcome_distribution(h.stg["applications"])),
        "signal_report": _on(_signal_report),
        "first_touch": _on(_first_touch),
        "outcome_counts": _on(lambda h: kpi.outcome_counts(h.stg["applications"])),
        "csv_round_trip": _csv_round_trip("offers"),
        **{f"csv_round_trip_{name}": _csv_round_trip(name) for name in CONTRACT if name != "offers"},
        "csv_free_text": _on(_csv_free_text),
        "row_counts": _on(lambda h: row_counts(h.raw)),
        "dq_staging": _on(lambda h: run_suite(h.staged(), STAGING_CHECKS)),
        "dq_marts_declared": _suite([*MART_CHECKS, *OWN_CHECKS]),
        "dq_marts": _suite([c for c in MART_EXPECTATIONS if c.kind != "implies"]),
        "dq_features": _suite(FEATURE_CHECKS),
        "dq_orphans": _dq_orphans,
        "dq_staging_dirty": _dirty_suite(STAGING_CHECKS),
        "dq_marts_declared_dirty": _dirty_suite([*MART_CHECKS, *OWN_CHECKS]),
        "dq_marts_dirty": _dirty_suite(MART_EXPECTATIONS),
        "dq_features_dirty": _dirty_suite(FEATURE_CHECKS),
        "dq_tolerance": _on(_tolerances),
        "dq_orphans_dirty": _on(_dq_orphans_dirty),
        "dq_flag_implication": _suite([c for c in MART_EXPECTATIONS if c.kind == "implies"]),
        "dq_summary": _on(lambda h: summarise(run_suite(h.marts(), MART_EXPECTATIONS))),
        "recommend_fill": _on(_recommend_fill),
        "recommend_dropout": _on(_recommend_dropout),
        "recommend_offer": _on(_recommend_offer),
        "at_risk_topk": _on(_at_risk),
        "missing_ids": _missing_ids,
        "auc_exact": _on(lambda h: roc_auc(_scored_labels(h), "label", "score")),
        "classification_report": _on(_classification),
        "class_weights": _on(_class_weights),
        "split_counts": _on(_split_counts),
        "split_rows": _on(_split_rows),
        "impute_medians": _on(_impute_medians),
        "category_levels": _on(lambda h: level_table(h.table("mart_ml_features"), CATEGORIES)),
        "one_hot_rows": _on(_one_hot_rows),
        "score_applications_stored": _on(_stored_applications),
        "score_offers_stored": _on(_stored_offers),
        "score_requisitions_stored": _on(_stored_requisitions),
        "scored_features": _on(_features_echo),
        "importance_stored": _on(_stored_importance),
        "sample_predictions_stored": _on(_stored_samples),
        **{f"model_metrics_{spec.name}": _metrics(spec) for spec in MODELS.values()},
        **{f"importance_{spec.name}": _importance(spec) for spec in MODELS.values()},
        "score_requisitions": _score_requisitions,
        "score_applications": _score_applications,
        "score_offers": _score_offers,
        **(_llm.queries() | {"pipeline": corpus_pipeline.run} if _llm else {}),
    }


def oracle_sql() -> dict[str, str]:
    return _oracle_sql() | (_llm.oracle_sql() if _llm else {})
