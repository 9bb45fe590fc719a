"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Texts, merged_counts, text_slices

BITS = 16
SIZES = (1, 2, 3)
MAX_LANGUAGES = 1000
UNDETERMINED = "und"
_STEP = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], np.uint32)


def code_points(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The texts' lower-cased code points in one array, and each text's bounds in it."""
    lowered = [(s or "").lower() for s in texts.strings()]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, np.cumsum([0, *map(len, lowered)])


def hashed_ngrams(codes: np.ndarray, n: int, bits: int = BITS) -> np.ndarray:
    """The bucket of the ``n`` characters from each place on."""
    width = max(0, len(codes) - n + 1)
    total = np.full(width, n * 0x3243F6A9 & 0xFFFFFFFF, np.uint32)
    with np.errstate(over="ignore"):
        for i in range(n):
            total += codes[i : i + width] * _STEP[i]
            total ^= total >> np.uint32(15)
            total *= np.uint32(0x2C1B3C6D)
    return total >> np.uint32(32 - bits)


def range_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of values[starts[i]:ends[i]] along the first axis; zero where a range is empty."""
    out = np.zeros((len(starts), *values.shape[1:]), values.dtype)
    full = np.flatnonzero(ends > starts)
    if len(full):
        edges = np.stack([starts[full], ends[full]], axis=1).ravel()
        inside = edges if edges[-1] < len(values) else edges[:-1]
        out[full] = np.add.reduceat(values, inside, axis=0)[::2]
    return out


@dataclass(frozen=True)
class LanguageModel:
    """Languages in order, their log priors and log probabilities, a (2**BITS, languages) matrix."""

    languages: list[str]
    prior: np.ndarray
    matrix: np.ndarray

    def scores(self, texts: Texts) -> np.ndarray:
        """Posterior probabilities, one row per text."""
        codes, bounds = code_points(texts)
        total = np.tile(self.prior, (len(texts), 1))
        for n in SIZES:
            rows = self.matrix[hashed_ngrams(codes, n)]
            total += range_sums(rows, np.minimum(bounds[:-1], len(rows)), np.maximum(bounds[1:] - n + 1, bounds[:-1]).clip(max=len(rows)))
        total -= total.max(axis=1, keepdims=True)
        weights = np.exp(total)
        return weights / weights.sum(axis=1, keepdims=True)


def fit_language_model(df: DataFrame, text: Column, language: Column, smoothing: float = 0.5) -> LanguageModel:
    """Count the n-grams of every row with a language; texts that are null count as empty.

    Counts are exact and over all rows; the driver gets 2**BITS numbers per language.
    Without any row the model has no language and finds every text undetermined.
    """
    rows = df.select(text.alias("text"), language.alias("lang")).filter("lang is not null")
    shares = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(shares) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = [r["lang"] for r in shares]
    index = {x: i for i, x in enumerate(languages)}
    width = 1 << BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        totals = np.zeros((len(languages), width), np.int64)
        for batch, texts in text_slices(batches):
            codes, bounds = code_points(texts)
            lang = np.array([index[x] for x in batch.column(1).to_pylist()])
            owner = np.repeat(lang, np.diff(bounds))
            text_of = np.repeat(np.arange(len(texts)), np.diff(bounds))
            for n in SIZES:
                grams = hashed_ngrams(codes, n)
                inside = text_of[: len(grams)] == text_of[n - 1 :][: len(grams)]
                cells = owner[: len(grams)][inside] * width + grams[inside]
                totals += np.bincount(cells, minlength=totals.size).reshape(totals.shape)
        yield from enumerate(totals)

    found = merged_counts(rows, count, width) if languages else {}
    counts = np.array([found.get(i, np.zeros(width, np.int64)) for i in range(len(languages))], float).reshape(-1, width)
    smooth = counts + smoothing
    matrix = np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.copy()
    rows_all = sum(r["n"] for r in shares)
    return LanguageModel(languages, np.array([math.log(r["n"] / rows_all) for r in shares]), matrix)


def identify(df: DataFrame, model: LanguageModel, text_col: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``df`` with the predicted language and its posterior probability, for every whole text.

    A text that is null or has no letter, and any text under a model without languages, is
    ``und`` with score 0. Of equal scores the alphabetically first language wins. Rows are
    scored one by one; all other columns stay, columns named like the two results are replaced.
    """
    held = df.sparkSession.sparkContext.broadcast(model)  # at most MAX_LANGUAGES x 2**BITS numbers
    kept = [c for c in df.columns if c not in (pred, score)]
    slot = kept.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        names = [str(i) if i != slot else "text" for i in range(len(kept))]
        renamed = (pa.RecordBatch.from_arrays(b.columns, names=names) for b in batches)
        for batch, texts in text_slices(renamed):
            langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            if m.languages:
                posterior = m.scores(texts)
                best = posterior.argmax(axis=1)
                for i, s in enumerate(texts.strings()):
                    if s and any(map(str.isalpha, s)):
                        langs[i], scores[i] = m.languages[best[i]], float(posterior[i, best[i]])
            columns = [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, pred, score])

    rows = df.select(*[F.col(f"`{c}`") for c in kept])
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields]).add(pred, "string").add(score, "double"))
