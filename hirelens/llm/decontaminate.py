"""Benchmark decontamination: CGK random-walk embeddings, bit-sampling tables, exact edit distance.

Texts and items are sequences of lower-cased words. A CGK walk copies symbols of a sequence
to an output three times as long, and moves on or stays by a random bit of (step, symbol);
sequences a few edits apart fall into step again, so edit distance becomes Hamming distance.
A table samples a few output places; windows of an item's size that agree with an item on a
table's sample are candidates. The exact word edit distance then decides.

Windows stand where a run of words agrees with an item. An item of m words within e edits
keeps a run of at least (m - e) / (e + 1) words, so with runs no longer than that no window
that could match is left out.

The longer a window, the less likely its walk is still in step at the end, so items above
``PIECE`` words are looked for in pieces: of a passage within the edit limit of the whole item, at
least one piece's part is within the limit of that piece, mostly several are. Each candidate is
decided by the edit distance of the whole item. The walks, and the places of a sample, follow from
``RECALL``: they are those with which simulated passages at the edit limit are found that often.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Texts, text_slices
from .toxicity import tokens
from .words import mixed, ngrams

SIMILARITY = 0.8  # an item of m words leaks if a passage is within floor(m * (1 - 0.8)) word edits
RECALL = 0.98  # share of the passages at the edit limit that are to be found
PIECE = 59  # words of an item that are compared at once
PLANS = ((6, 6), (12, 6), (24, 6), (12, 4), (24, 4), (24, 3), (24, 2), (24, 1))  # (walks, places of a sample)
TABLES = 12  # samples of each walk
RUN = 3
TRIALS = 400
MAX_BLOCK_WORDS = 2_000_000
_PAD = np.uint64(0x5BD1E995)


def edits(m: int, similarity: float) -> int:
    return int(math.floor(m * (1 - similarity) + 1e-9))


def run_length(m: int, e: int) -> int:
    return max(1, min(RUN, math.ceil((m - e) / (e + 1))))


def embed(windows: np.ndarray, sizes: np.ndarray, walks: int) -> np.ndarray:
    """CGK outputs, (windows, walks, 3 x longest); of a window of m words the first 3m places count."""
    n, longest = windows.shape
    padded = np.concatenate([windows, np.full((n, 1), _PAD)], axis=1)
    padded[np.arange(longest + 1) >= sizes[:, None]] = _PAD
    rows, limit = np.repeat(np.arange(n), walks), np.repeat(sizes, walks)
    at = np.zeros(n * walks, np.int64)
    out = np.empty((n * walks, 3 * longest), np.uint64)
    walk = np.tile(np.arange(1, walks + 1, dtype=np.uint64), n) * np.uint64(1_000_003)
    for j in range(3 * longest):
        symbol = padded[rows, at]
        out[:, j] = symbol
        move = mixed(symbol ^ mixed(walk + np.uint64(j))) >> np.uint64(63)
        at = np.minimum(at + move.astype(np.int64), limit)
    return out.reshape(n, walks, 3 * longest)


_SPOTS = np.random.Generator(np.random.PCG64(23)).random((max(w for w, _ in PLANS), TABLES, max(k for _, k in PLANS)))


def signatures(windows: np.ndarray, sizes: np.ndarray, walks: int, sample: int) -> np.ndarray:
    """One 64-bit key per window and table; the window's size and the table are part of it."""
    out = embed(windows, sizes, walks)
    places = (_SPOTS[None, :walks, :, :sample] * (3 * sizes)[:, None, None, None]).astype(np.int64)
    symbols = np.take_along_axis(out, places.reshape(len(windows), walks, -1), axis=2).reshape(places.shape)
    table = np.arange(walks * TABLES, dtype=np.uint64).reshape(1, walks, TABLES)
    key = sizes.astype(np.uint64)[:, None, None] * np.uint64(1009) + table
    for k in range(sample):
        key = mixed(key ^ symbols[..., k])
    return key.reshape(len(windows), -1)


@lru_cache
def plan(similarity: float, recall: float = RECALL, size: int = PIECE) -> tuple[int, int]:
    """The first of ``PLANS`` that finds ``recall`` of simulated passages: items of ``size`` random words,
    half with words replaced, half with words replaced, added and left out, as many as the limit allows."""
    rng = np.random.default_rng(5)
    items = [rng.integers(1, 2**63, size).astype(np.uint64) for _ in range(TRIALS)]
    texts = []
    for k, item in enumerate(items):
        part, e = item.tolist(), edits(size, similarity)
        spots = rng.permutation(size)[:e] if k % 2 else [int(rng.integers(len(part) - e)) for _ in range(e)]
        for p in spots:
            kind = 0 if k % 2 else int(rng.integers(3))
            part[p : p + (kind != 1)] = [int(rng.integers(1, 2**63))] * (kind != 2)
        texts.append(np.concatenate([rng.integers(1, 2**63, 30).astype(np.uint64), np.array(part, np.uint64), rng.integers(1, 2**63, 30).astype(np.uint64)]))
    bounds = np.cumsum([0, *map(len, texts)])
    for walks, sample in PLANS:
        known = Items(list(range(TRIALS)), items, similarity, walks, sample)
        found = {(text, item) for _, text, _, item, _, _ in known.candidates(np.concatenate(texts), bounds)}
        if sum(text == item for text, item in found) >= recall * TRIALS:
            return walks, sample
    raise ValueError(f"no plan finds {recall} of the passages with a similarity of {similarity}")


def edit_distance(item: np.ndarray, passage: np.ndarray) -> int:
    """Fewest word edits between the item and any part of the passage."""
    line = np.zeros(len(passage) + 1, np.int64)
    steps = np.arange(len(passage) + 1)
    for word in item:
        change = np.concatenate([[line[0] + 1], np.minimum(line[1:] + 1, line[:-1] + (passage != word))])
        line = np.minimum.accumulate(change - steps) + steps
    return int(line.min())


def closest_part(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """(edits, first word) of the part of the passage that is closest to the item; of equals the first to end, at its longest."""

    def last_line(item: np.ndarray, passage: np.ndarray, line: np.ndarray) -> np.ndarray:
        steps = np.arange(len(passage) + 1)
        for word in item:
            change = np.concatenate([[line[0] + 1], np.minimum(line[1:] + 1, line[:-1] + (passage != word))])
            line = np.minimum.accumulate(change - steps) + steps
        return line

    ends = last_line(item, passage, np.zeros(len(passage) + 1, np.int64))
    end = int(ends.argmin())
    back = last_line(item[::-1], passage[:end][::-1], np.arange(end + 1))
    return int(ends[end]), end - int(np.flatnonzero(back == ends[end])[-1])


def may_be_near(item: np.ndarray, passage: np.ndarray, e: int) -> bool:
    """False only if the passage holds fewer than all but ``e`` of the item's words, repeats counted."""
    words, need = np.unique(item, return_counts=True)
    at = np.searchsorted(words, passage).clip(max=len(words) - 1)
    have = np.bincount(at[words[at] == passage], minlength=len(words))
    return int(np.minimum(need, have).sum()) >= len(item) - e


@dataclass
class Items:
    """A block of items: their words, their pieces, the runs that place windows, and the tables."""

    ids: list
    whole: list[np.ndarray]
    similarity: float
    walks: int = PLANS[0][0]
    sample: int = PLANS[0][1]

    def __post_init__(self) -> None:
        self.whole_sizes = np.array([len(w) for w in self.whole], np.int64)
        cut = [np.array_split(w, max(1, math.ceil(len(w) / PIECE))) for w in self.whole]
        self.words = [piece for pieces in cut for piece in pieces]
        self.item = np.repeat(np.arange(len(cut)), [len(pieces) for pieces in cut])
        self.parts = np.array([len(pieces) for pieces in cut], np.int64)
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.offset = (np.cumsum(self.sizes) - self.sizes) - (np.cumsum(self.whole_sizes) - self.whole_sizes)[self.item]
        self.runs: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        length = np.array([run_length(m, edits(m, self.similarity)) if m else 0 for m in self.sizes], np.int64)
        for q in sorted({int(x) for x in length if x}):
            grams, owner, offset = [], [], []
            for i in np.flatnonzero(length == q):
                g = ngrams(self.words[i], q)
                grams.append(g)
                owner.append(np.full(len(g), i))
                offset.append(np.arange(len(g)))
            flat = np.concatenate(grams)
            order = np.argsort(flat, kind="stable")
            self.runs[q] = flat[order], np.concatenate(owner)[order], np.concatenate(offset)[order]
        some = np.flatnonzero(self.sizes)
        keys, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for lo in range(0, len(some), 1024):
            part = some[lo : lo + 1024]
            cells = np.zeros((len(part), int(self.sizes[part].max())), np.uint64)
            for row, i in enumerate(part):
                cells[row, : self.sizes[i]] = self.words[i]
            found = signatures(cells, self.sizes[part], self.walks, self.sample)
            keys.append(found.ravel())
            owner.append(np.repeat(part, found.shape[1]))
        flat = np.concatenate(keys)
        order = np.argsort(flat, kind="stable")
        self.keys, self.owner = flat[order], np.concatenate(owner)[order]

    def windows(self, hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Distinct (text, start, size) of windows that stand on a common run."""
        found = []
        for q, (grams, owner, offset) in self.runs.items():
            here = ngrams(hashes, q)
            lo = np.searchsorted(grams, here)
            spots = np.flatnonzero(grams[lo.clip(max=len(grams) - 1)] == here)
            text = np.searchsorted(bounds, spots, "right") - 1
            whole = spots + q <= bounds[text + 1]
            spots, text = spots[whole], text[whole]
            if not len(spots):
                continue
            lo, hi = lo[spots], np.searchsorted(grams, here[spots], "right")
            each = np.repeat(np.arange(len(spots)), hi - lo)
            at = np.arange(len(each)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[each]
            start = spots[each] - offset[at]
            found.append(np.stack([text[each], np.maximum(start, bounds[text[each]]), self.sizes[owner[at]]], axis=1))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)

    def candidates(self, hashes: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int, int, bool]]:
        """(piece, text, start, item, size, equal) of windows that agree with a piece in a table."""
        windows = self.windows(hashes, bounds)
        padded = np.concatenate([hashes, np.zeros(int(self.sizes.max(initial=0)) + 1, np.uint64)])
        windows = windows[np.argsort(windows[:, 2], kind="stable")]  # like sizes together, for little padding
        for lo in range(0, len(windows), 512):
            part = windows[lo : lo + 512]
            sizes = part[:, 2]
            place = part[:, 1][:, None] + np.arange(int(sizes.max()))
            cells = np.where(place < bounds[part[:, 0] + 1][:, None], padded[np.minimum(place, len(padded) - 1)], _PAD)
            keys = signatures(cells, sizes, self.walks, self.sample)
            at = np.searchsorted(self.keys, keys)
            window, table = np.nonzero(self.keys[at.clip(max=len(self.keys) - 1)] == keys)
            pairs = set()
            for w, t in zip(window.tolist(), table.tolist()):
                k = at[w, t]
                while k < len(self.keys) and self.keys[k] == keys[w, t]:
                    pairs.add((w, int(self.owner[k])))
                    k += 1
            for w, piece in sorted(pairs):
                text, start, m = (int(x) for x in part[w])
                yield piece, text, start, int(self.item[piece]), m, np.array_equal(cells[w, :m], self.words[piece])

    def leaks(self, hashes: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, edits, place) for every item found in a text, at its closest window."""
        best: dict[tuple[int, int], tuple[int, int]] = {}
        far: dict[tuple[int, int], set[int]] = {}  # where items of several pieces would start
        for piece, text, start, item, m, equal in self.candidates(hashes, bounds):
            if self.parts[item] > 1:
                far.setdefault((text, item), set()).add(start - int(self.offset[piece]))
                continue
            known, e = best.get((text, item)), edits(m, self.similarity)
            if known and known[0] == 0:
                continue
            if equal:
                distance = 0
            else:
                around = hashes[max(bounds[text], start - e) : min(bounds[text + 1], start + m + e)]
                distance = edit_distance(self.words[piece], around)
            if distance <= e and (known is None or distance < known[0]):
                best[text, item] = distance, start - int(bounds[text])
        for (text, item), starts in far.items():
            found = self._closest(self.whole[item], hashes, int(bounds[text]), int(bounds[text + 1]), sorted(starts))
            if found:
                best[text, item] = found
        for (text, item), (distance, place) in sorted(best.items()):
            yield text, item, distance, place

    def _closest(self, item: np.ndarray, hashes: np.ndarray, begin: int, end: int, starts: list[int]) -> tuple[int, int] | None:
        """(edits, place) of the passage closest to a whole item, if one is within the limit.

        The passage begins up to e words off where a piece's run puts it, and is up to e words
        longer than the item. Starts within e words are one comparison.
        """
        e, best, at = edits(len(item), self.similarity), None, 0
        while at < len(starts) and (best is None or best[0]):
            first = last = starts[at]
            while at < len(starts) and starts[at] <= first + e:
                last = starts[at]
                at += 1
            lo, hi = max(begin, first - e), min(end, last + len(item) + 2 * e)
            around = hashes[lo:hi]
            if not may_be_near(item, around, e):
                continue
            distance, place = closest_part(item, around)
            if distance <= e and (best is None or distance < best[0]):
                best = distance, lo + place - begin
        return best


def _blocks(items: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[list[tuple]]:
    """The items in blocks of about ``most`` words, so what is broadcast is bounded however many there are."""
    rows = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    size = F.coalesce(F.sum(F.size(F.split("text", r"\s+"))), F.lit(0))
    blocks = max(1, math.ceil(rows.agg(size).first()[0] / most))
    for b in range(blocks):
        yield [(r["id"], r["text"]) for r in rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).toLocalIterator()]


def find_leaks(
    docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", block_words: int = MAX_BLOCK_WORDS,
) -> DataFrame:
    """(id, item id, edits, similarity, place) for every item that a document's whole text holds.

    ``edits`` is the word edit distance between the item and the closest passage, at most
    ``floor(words * (1 - similarity))``; ``similarity`` is 1 - edits / words and ``place`` the
    passage's first word. Of passages at the edit limit, a share of about ``RECALL`` is found, whatever
    the item's length; closer ones are found more often, equal ones always. Case, white space and punctuation don't count. Items without a word
    match nothing, nor do null and empty texts. A repeated document row yields its rows again;
    of items with the same id the closest counts. Items are taken in blocks of about
    ``block_words`` words, each compared with all documents.
    """
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    doc_kind, item_kind = docs.schema[id_col].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    arrow_item = pa.int64() if item_kind == "bigint" else pa.int32() if item_kind == "int" else pa.string()
    walks, sample = plan(similarity)
    out = None
    for block in _blocks(items, item_id, item_text, block_words):
        words = [tokens(Texts(pa.array([t], pa.string())))[0] for _, t in block]
        held = docs.sparkSession.sparkContext.broadcast(Items([i for i, _ in block], words, similarity, walks, sample))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            known = held.value
            for batch, texts in text_slices(batches, most=1 << 20):
                hashes, bounds = tokens(texts)
                found: dict[tuple, tuple] = {}
                for text, item, distance, place in known.leaks(hashes, bounds):
                    key, value = (text, known.ids[item]), (distance, -int(known.whole_sizes[item]), place)
                    found[key] = min(found.get(key, value), value)
                if found:
                    keys, values = list(found), list(found.values())
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array([k[0] for k in keys])),
                            pa.array([k[1] for k in keys], arrow_item),
                            pa.array([v[0] for v in values], pa.int32()),
                            pa.array([1 + v[0] / v[1] for v in values], pa.float64()),
                            pa.array([v[2] for v in values], pa.int64()),
                        ],
                        names=["doc", "item", "edits", "similarity", "place"],
                    )

        part = rows.mapInArrow(run, f"doc {doc_kind}, item {item_kind}, edits int, similarity double, place long")
        out = part if out is None else out.unionByName(part)
    return out.withColumnsRenamed({"doc": id_col, "item": item_id})
