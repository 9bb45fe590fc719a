"""Quality classifier: supervised subword embeddings, averaged per document, with a softmax output."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Texts, text_slices
from .language import hashed_ngrams, range_sums

BITS = 16
NGRAMS = (2, 3, 4)
MAX_TRAIN_ROWS = 6000
_SPACES = np.array([0x20, *range(0x09, 0x0E)], np.uint32)


def features(texts: Texts) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Hashed words and character n-grams, case kept: (buckets, starts, ends of each text's own).

    A word is what stands between white space; an n-gram may begin or end with white space,
    which marks a word's edge, but holds none inside. Repeating a word at once or after one
    other is a feature too, whatever the word.
    """
    strings = [f" {s} " if s else "" for s in texts.strings()]
    codes = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.cumsum([0, *map(len, strings)])
    space = (codes == 32) | ((codes >= 9) & (codes <= 13))
    text_of = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(bounds))
    for n in NGRAMS:
        grams = hashed_ngrams(codes, n, BITS)
        ok = text_of[: len(grams)] == text_of[n - 1 :][: len(grams)]
        for i in range(1, n - 1):
            ok &= ~space[i : i + len(grams)]
        ok &= ~(space[: len(grams)] & space[n - 1 :][: len(grams)])
        place = np.searchsorted(np.flatnonzero(ok), bounds)
        yield grams[ok], place[:-1], place[1:]
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    if len(starts):
        ends = np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1
        words = _word_hashes(codes, starts, ends)
        where = np.searchsorted(starts, bounds)
        yield words, where[:-1], where[1:]
        for back in (1, 2):  # a word met again one or two words on, as a feature of its own
            again = np.flatnonzero(words[back:] == words[:-back]) + back
            again = again[again - back >= where[:-1][np.searchsorted(where, again, "right") - 1]]
            place = np.searchsorted(again, where)
            yield np.full(len(again), back, words.dtype), place[:-1], place[1:]


def _word_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    lengths = ends - starts
    longest = int(lengths.max())
    powers = np.full(longest, 0x01000193, np.uint32)
    powers[0] = 1
    with np.errstate(over="ignore"):
        powers = np.cumprod(powers, dtype=np.uint32)
        total = np.cumsum(lengths)
        at = np.arange(total[-1]) - np.repeat(total - lengths, lengths)
        values = (codes[np.repeat(starts, lengths) + at] + np.uint32(0x9E3779B1)) * np.uint32(0x85EBCA77)
        values ^= values >> np.uint32(13)
        sums = np.add.reduceat(values * powers[at], total - lengths, dtype=np.uint32)
        sums ^= sums >> np.uint32(16)
        sums *= np.uint32(0x7FEB352D)
    return sums >> np.uint32(32 - BITS)


@dataclass(frozen=True)
class QualityModel:
    """``logit[b]``: what a feature in bucket b adds to the log odds before averaging, and the bias.

    The softmax over two classes of a mean of embeddings is a mean of numbers: the output
    layer is applied to the embedding table once, when training ends.
    """

    logit: np.ndarray
    bias: float

    def scores(self, texts: Texts) -> np.ndarray:
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for buckets, starts, ends in features(texts):
            total += range_sums(self.logit[buckets], starts, ends)
            count += ends - starts
        return 1 / (1 + np.exp(-(total / np.maximum(count, 1) + self.bias)))


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], dim: int = 8, epochs: int = 5, rate: float = 0.2, seed: int = 11) -> QualityModel:
    """Stochastic gradient descent over (label, buckets, weights); weights of a row sum to 1."""
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / dim, 1 / dim, (1 << BITS, dim))
    out, bias = np.zeros((dim, 2)), np.zeros(2)
    steps = max(1, epochs * len(rows))
    done = 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            label, buckets, weights = rows[i]
            lr = rate * (1 - done / steps)
            done += 1
            hidden = weights @ table[buckets]
            z = hidden @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1  # gradient of the loss by z
            back = out @ p
            out -= lr * np.outer(hidden, p)
            bias -= lr * p
            # the averaged gradient is shared by few distinct buckets: scale it up as if each counted once
            table[buckets] -= (lr * len(buckets)) * weights[:, None] * back[None, :] / max(1, len(buckets)) ** 0.5
    return QualityModel(table @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0]))


def fit_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    max_rows: int = MAX_TRAIN_ROWS,
) -> QualityModel:
    """Train on at most ``max_rows`` labelled documents: those whose ids hash lowest.

    ``labels`` has one label of 0 or 1 per id; null ids and labels are left out, an id with
    several labels counts as its largest. Without rows the model gives 0.5 to all.
    """
    chosen = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
        .orderBy(F.xxhash64("id"), "id").limit(max_rows)
    )
    # at most max_rows ids: a broadcast of a bounded size
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").select("text", "label")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            parts = list(features(texts))
            found = []
            for i in range(len(texts)):
                own = np.concatenate([b[s[i] : e[i]] for b, s, e in parts]) if parts else np.zeros(0, np.uint32)
                buckets, counts = np.unique(own, return_counts=True)
                found.append((buckets.astype(np.uint16).tobytes(), (counts / max(1, counts.sum())).astype(np.float32).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([x for x, _ in found], pa.binary()), pa.array([y for _, y in found], pa.binary())],
                names=["label", "buckets", "weights"],
            )

    got = rows.mapInArrow(extract, "label int, buckets binary, weights binary").toLocalIterator()
    examples = [(r["label"], np.frombuffer(r["buckets"], np.uint16).astype(np.int64), np.frombuffer(r["weights"], np.float32)) for r in got]
    return train(sorted(examples, key=lambda x: (x[0], x[1].tobytes(), x[2].tobytes())))


def score_quality(df: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", cut_off: float = 0.3) -> DataFrame:
    """(id, score, predicted) of every row: the probability of label 1 over the whole text.

    Null and empty texts have no features and get the bias alone. Rows are scored one by one.
    """
    held = df.sparkSession.sparkContext.broadcast(model)  # 2**BITS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            scores = held.value.scores(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array((scores >= cut_off).astype(np.int32))],
                names=["id", "score", "predicted"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, score double, predicted int").withColumnRenamed("id", id_col)
