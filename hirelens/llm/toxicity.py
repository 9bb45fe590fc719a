"""Toxicity: a chain of linear classifiers over the categories, in order.

Each later model also sees the probabilities of the categories before it. It is trained on
out-of-fold probabilities, which earlier models gave to rows they had not seen, so that it
does not learn to trust them more than they deserve.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Texts, text_slices
from .language import range_sums
from .words import _BYTE, _powers, mixed

MAX_TRAIN_ROWS = 12_000
MAX_VOCABULARY = 50_000
MIN_DOCUMENTS = 3
MIN_Z = 4.0
FOLDS = 3
_WORD = np.zeros(256, bool)
_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = True


def tokens(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of letters, digits and non-ASCII bytes, A-Z lower-cased, and each text's bounds."""
    data, bounds = texts.data, texts.bounds
    inside = _WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begin = bounds[:-1][bounds[:-1] < len(data)]
    first[begin] = inside[begin]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    lengths = np.diff(np.append(starts, len(data)))
    place = np.arange(len(data) - starts[0], dtype=np.int64) - np.repeat(starts - starts[0], lengths)
    with np.errstate(over="ignore"):
        values = _BYTE[data[starts[0] :]] * _powers(int(lengths.max()))[place]
        values[~inside[starts[0] :]] = 0
        sums = np.add.reduceat(values, starts - starts[0])
    return mixed(sums), np.searchsorted(starts, bounds)


@dataclass(frozen=True)
class Chain:
    """A sorted vocabulary of word hashes; per category its word weights, bias and weights of earlier probabilities."""

    categories: tuple[str, ...]
    vocabulary: np.ndarray
    weights: np.ndarray
    biases: np.ndarray
    links: np.ndarray

    def scores(self, texts: Texts) -> np.ndarray:
        """Probabilities, one row per text and one column per category; a word counts once per text."""
        hashes, bounds = tokens(texts)
        at = np.searchsorted(self.vocabulary, hashes).clip(max=max(0, len(self.vocabulary) - 1))
        known = self.vocabulary[at] == hashes if len(self.vocabulary) else np.zeros(len(hashes), bool)
        text_of = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(bounds))[known]
        cells = np.unique(text_of * len(self.vocabulary) + at[known]) if known.any() else np.zeros(0, np.int64)
        words = cells % max(1, len(self.vocabulary))
        edges = np.searchsorted(cells // max(1, len(self.vocabulary)), np.arange(len(texts) + 1))
        out = np.zeros((len(texts), len(self.categories)))
        for k in range(len(self.categories)):
            z = self.biases[k] + range_sums(self.weights[k][words], edges[:-1], edges[1:])
            out[:, k] = _sigmoid(z + out[:, :k] @ self.links[k, :k])
        return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _fit(rows: list[np.ndarray], y: np.ndarray, extra: np.ndarray, size: int, epochs: int, seed: int) -> tuple[np.ndarray, float, np.ndarray]:
    """Logistic regression on word presence and earlier probabilities by AdaGrad steps, row by row."""
    rng = np.random.default_rng(seed)
    w, g, bias, gb = np.zeros(size), np.full(size, 1e-2), 0.0, 1e-2
    link, gl = np.zeros(extra.shape[1]), np.full(extra.shape[1], 1e-2)
    decay = 1e-5
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            x = rows[i]
            z = bias + w[x].sum() + extra[i] @ link
            e = 1 / (1 + np.exp(-max(-40.0, min(40.0, z)))) - y[i]
            if abs(e) < 1e-4:
                continue
            step = e + decay * w[x]
            g[x] += step * step
            w[x] -= 0.3 * step / np.sqrt(g[x])
            gb += e * e
            bias -= 0.3 * e / gb**0.5
            step = e * extra[i]
            gl += step * step
            link -= 0.3 * step / np.sqrt(gl)
    return w, bias, link


def telling_words(words: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Words in ``MIN_DOCUMENTS`` rows whose share differs between a category's rows and the rest by ``MIN_Z`` deviations.

    At most ``MAX_VOCABULARY``, those that differ most; of equals the lowest hashes.
    """
    flat = np.concatenate([*words, np.zeros(0, np.uint64)])
    found, at = np.unique(flat, return_inverse=True)
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    count, z = np.bincount(at, minlength=len(found)), np.zeros(len(found))
    for c in range(labels.shape[1]):
        n1 = labels[:, c].sum()
        n0 = len(words) - n1
        if not n1 or not n0:
            continue
        inside = np.bincount(at, labels[row, c], len(found))
        share = count / len(words)
        spread = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n1 + 1 / n0))
        z = np.maximum(z, np.abs(inside / n1 - (count - inside) / n0) / spread)
    good = np.flatnonzero((count >= MIN_DOCUMENTS) & (z >= MIN_Z))
    return np.sort(found[good[np.argsort(-z[good], kind="stable")[:MAX_VOCABULARY]]])


def train_chain(words: list[np.ndarray], labels: np.ndarray, categories: Sequence[str], epochs: int = 12, seed: int = 5) -> Chain:
    """Fit the chain to rows of distinct word hashes; ``labels`` has a column of 0 or 1 per category."""
    keep = telling_words(words, labels)
    rows = []
    for x in words:
        at = np.searchsorted(keep, x).clip(max=max(0, len(keep) - 1))
        rows.append(at[keep[at] == x] if len(keep) else np.zeros(0, np.int64))
    n, k = labels.shape
    fold = np.random.default_rng(seed).integers(0, FOLDS, n)
    unseen = np.zeros((n, k))
    weights, biases, links = np.zeros((k, len(keep))), np.zeros(k), np.zeros((k, k))
    for c in range(k):
        y, extra = labels[:, c].astype(float), unseen[:, :c]
        if c + 1 < k:
            for f in range(FOLDS):
                inside, outside = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
                w, b, link = _fit([rows[i] for i in inside], y[inside], extra[inside], len(keep), epochs, seed)
                z = [b + w[rows[i]].sum() + extra[i] @ link for i in outside]
                unseen[outside, c] = _sigmoid(np.array(z))
        weights[c], biases[c], links[c, :c] = _fit(rows, y, extra, len(keep), epochs, seed)
    return Chain(tuple(categories), keep, weights, biases, links)


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, categories: Sequence[str], id_col: str = "doc_id", text_col: str = "text",
    max_rows: int = MAX_TRAIN_ROWS, graded: str | None = None,
) -> Chain:
    """Train on at most ``max_rows`` labelled documents, those whose ids hash lowest.

    ``labels`` has a 0/1 column per category. Rows with a null id or label are left out; an
    id with several rows counts with each category's largest label. Without rows every
    probability is 0.5. ``graded`` names a last category, derived by ``severe`` from the first.
    """
    known = labels.filter(" and ".join(f"`{c}` is not null" for c in [id_col, *categories]))
    chosen = (
        known.groupBy(F.col(id_col).alias("id"))
        .agg(F.array(*[F.max(c).cast("int") for c in categories]).alias("y"))
        .orderBy(F.xxhash64("id"), "id").limit(max_rows)
    )
    # at most max_rows ids: a broadcast of a bounded size
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").select("text", "y")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            hashes, bounds = tokens(texts)
            own = [np.unique(hashes[a:b]).tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(own, pa.binary())], names=["y", "words"])

    got = [(tuple(r["y"]), bytes(r["words"])) for r in rows.mapInArrow(extract, "y array<int>, words binary").toLocalIterator()]
    got.sort()
    y = np.array([a for a, _ in got], float).reshape(len(got), len(categories))
    words = [np.frombuffer(b, np.uint64) for _, b in got]
    if graded:
        return train_chain(words, np.column_stack([y, severe(words, y[:, 0])]), (*categories, graded))
    return train_chain(words, y, categories)


def severe(words: list[np.ndarray], marked: np.ndarray) -> np.ndarray:
    """1 for marked rows with at least as many telling words as the median marked row that has any.

    A word is telling if ``MIN_DOCUMENTS`` marked rows hold it and its share of them is 20 times
    its share of the others.
    """
    inside = [w for w, m in zip(words, marked) if m]
    outside = np.concatenate([*(w for w, m in zip(words, marked) if not m), np.zeros(0, np.uint64)])
    found, count = np.unique(np.concatenate([*inside, np.zeros(0, np.uint64)]), return_counts=True)
    others, times = np.unique(outside, return_counts=True)
    rest = np.zeros(len(found))
    if len(others):
        at = np.searchsorted(others, found).clip(max=len(others) - 1)
        rest = np.where(others[at] == found, times[at], 0)
    share, other_share = count / max(1, len(inside)), rest / max(1, len(words) - len(inside))
    telling = found[(count >= MIN_DOCUMENTS) & (share > 20 * other_share)]
    held = np.array([np.isin(w, telling).sum() if m else 0 for w, m in zip(words, marked)], float)
    some = held[held > 0]
    return (held >= (np.median(some) if len(some) else np.inf)).astype(float)


def score_toxicity(df: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text", cut_off: float = 0.5) -> DataFrame:
    """(id, one probability per category, toxic) of every row over its whole text.

    ``toxic`` is whether the first category's probability reaches ``cut_off``. Null and empty
    texts hold no word and are not toxic. Rows are scored one by one.
    """
    held = df.sparkSession.sparkContext.broadcast(chain)  # at most MAX_VOCABULARY words
    names = ["id", *(f"p_{c}" for c in chain.categories), "toxic"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            scores = held.value.scores(texts)
            empty = np.diff(texts.bounds) == 0
            toxic = (scores[:, 0] >= cut_off) & ~empty
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(scores[:, k]) for k in range(scores.shape[1])), pa.array(toxic)], names=names
            )

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = ", ".join([f"id {kind}", *(f"p_{c} double" for c in chain.categories), "toxic boolean"])
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
