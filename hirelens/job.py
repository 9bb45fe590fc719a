"""From contract files to served models: the warehouse build, three trainings and their reports."""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import SparkSession

from .domain import CONTRACT_VOCABULARY, Vocabulary
from .ml.spec import MODELS
from .ml.train import TrainConfig, TrainedModel, load_models, save, save_report, train
from .plans.warehouse import FEATURE_MART, build, open_warehouse
from .sources import Tables
from .sources.contract import FREE_TEXT

DEFAULT = TrainConfig()


def _step(name: str, config: TrainConfig) -> str:
    return f"train {name} {config}"


def models_folder(tables: Tables, models_root: str | None = None) -> str:
    """Where the models of a generation lie: beside its tables, or under ``models_root`` for catalog tables."""
    if models_root:
        return f"{models_root.rstrip('/')}/{tables.generation}"
    return tables.folder("models")


def run(
    spark: SparkSession, src: str, tables: Tables, config: TrainConfig = DEFAULT, strict: bool = True,
    force: bool = False, multi_line: Collection[str] = FREE_TEXT, models_root: str | None = None,
    progress: Callable[[str], None] = lambda step: None, vocabulary: Vocabulary = CONTRACT_VOCABULARY,
) -> list[str]:
    """Build, train the three models and store them with their reports; the steps that had to be run.

    Every finished step is recorded with its generation of tables. A second call with the same
    inputs and configuration does nothing; after an interruption it goes on with the first step
    that is missing; changed inputs give a new generation and new models.
    """
    ran = []

    def note(step: str) -> None:
        ran.append(step)
        progress(step)

    if build(spark, src, tables, strict, force, multi_line, vocabulary=vocabulary) is not None:
        note("build")
    house, ledger = open_warehouse(spark, tables), tables.ledger
    current = house.tables
    pointer = ledger.current()
    finished = ledger.steps(current.generation)
    folder = models_folder(current, models_root)
    for name, spec in MODELS.items():
        step = _step(name, config)
        if step in finished:
            continue
        result = train(house.table(FEATURE_MART), spec, config)
        save(result.model, folder)
        save_report(spark, result, result.importance(config), folder)
        ledger.append(current.generation, step, pointer.inputs)
        note(f"train {name}")
    return ran


def is_complete(tables: Tables, config: TrainConfig = DEFAULT) -> bool:
    """Whether a build is published and all models are trained on it."""
    pointer = tables.ledger.current()
    if pointer is None:
        return False
    finished = tables.ledger.steps(pointer.generation)
    return all(_step(name, config) in finished for name in MODELS)


def open_models(
    spark: SparkSession, tables: Tables, config: TrainConfig = DEFAULT, models_root: str | None = None
) -> dict[str, TrainedModel]:
    """The three models of the published build; an error where one isn't trained yet."""
    current = tables.current()
    finished = tables.ledger.steps(current.generation)
    missing = [name for name in MODELS if _step(name, config) not in finished]
    if missing:
        raise LookupError(f"not trained on the published build yet: {', '.join(missing)}")
    return load_models(spark, models_folder(current, models_root))
