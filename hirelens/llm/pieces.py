"""Unigram encoding and decoding: Viterbi over a double-array trie of pieces.

Pieces carry space marks only at their front, so the best segmentation of a text is the
chain of the best segmentations of its words (a run of marks and what follows), and each
distinct word of a slice is segmented once, many words in step. Characters without a piece
cost ``lowest score - 10`` and become their UTF-8 bytes' pieces.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Texts, kept_in_process, text_slices
from .token_counts import MARK, chunks, load_pieces

UNKNOWN_PENALTY = 10.0
MAX_PIECES = 1 << 20
MEMO_WORDS = 200_000
STEP_BYTES = 64  # longer words are segmented one by one


class DoubleArray:
    """Byte strings in two arrays: child(node, byte) = base[node] + byte + 1 where check agrees."""

    def __init__(self, keys: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        value = [-1]
        for key, v in keys.items():
            node = 0
            for byte in key:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    value.append(-1)
                node = children[node][byte]
            value[node] = v
        size = 2 * len(children) + 1024
        used = bytearray(size)
        base, check, values = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        used[0] = 1
        place, free = {0: 0}, 1
        values[0] = value[0]
        stack = [0]
        while stack:
            node = stack.pop()
            kids = sorted(children[node])
            if not kids:
                continue
            while used[free]:
                free += 1
            at, tries = max(0, free - kids[0] - 1), 0
            while True:
                if at + 300 > len(used):
                    more = len(used)
                    used.extend(bytes(more))
                    base = np.append(base, np.zeros(more, np.int32))
                    check = np.append(check, np.full(more, -1, np.int32))
                    values = np.append(values, np.full(more, -1, np.int32))
                if not any(used[at + k + 1] for k in kids):
                    break
                at, tries = at + 1, tries + 1
            if tries > 32:  # too full here: go on behind
                free = at
            base[place[node]] = at
            for k in kids:
                used[at + k + 1] = 1
                child = children[node][k]
                place[child] = at + k + 1
                check[at + k + 1] = place[node]
                values[at + k + 1] = value[child]
                stack.append(child)
        self.base, self.check, self.value = base, check, values


class Unigram:
    """The segmenter and its inverse; plain arrays, of the vocabulary's size."""

    def __init__(self, pieces: dict[str, tuple[int, float]], by_byte: dict[int, int]):
        if len(pieces) > MAX_PIECES:
            raise ValueError(f"{len(pieces)} pieces; a broadcast vocabulary has at most {MAX_PIECES}")
        size = max([*(i for i, _ in pieces.values()), *by_byte.values()]) + 1
        self.score = np.zeros(size)
        written: list[bytes] = [b""] * size
        for text, (i, score) in pieces.items():
            self.score[i] = score
            written[i] = text.replace(MARK, " ").encode()
        for byte, i in by_byte.items():
            written[i] = bytes([byte])
        self.trie = DoubleArray({t.replace(MARK, " ").encode(): i for t, (i, _) in pieces.items()})
        self.unknown = min(s for _, s in pieces.values()) - UNKNOWN_PENALTY
        self.by_byte = np.array([by_byte[b] for b in range(256)], np.int32)
        self.out = np.frombuffer(b"".join(written), np.uint8)
        self.out_at = np.cumsum([0, *map(len, written)])

    def one(self, word: bytes) -> list[int]:
        """Viterbi over one word; of equal scores the segmentation whose last piece starts first."""
        trie, n = self.trie, len(word)
        base, check, value, score = trie.base, trie.check, trie.value, self.score
        best, back = [-np.inf] * (n + 1), [(-1, -1)] * (n + 1)
        best[0], start = 0.0, 0
        while start < n:
            width = int(_WIDTH[word[start]])
            node, at, single = 0, start, False
            while at < n:
                child = base[node] + word[at] + 1
                if check[child] != node:
                    break
                node, at = child, at + 1
                piece = value[node]
                if piece >= 0:
                    single |= at == start + width
                    if best[start] + score[piece] > best[at]:
                        best[at], back[at] = best[start] + score[piece], (start, int(piece))
            if not single and best[start] + self.unknown > best[start + width]:
                best[start + width], back[start + width] = best[start] + self.unknown, (start, -1)
            start += width
        path: list[int] = []
        while n > 0:
            start, piece = back[n]
            path.extend([piece] if piece >= 0 else (int(self.by_byte[x]) for x in reversed(word[start:n])))
            n = start
        return path[::-1]

    def many(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``one`` for each word: all ids, and each word's number of them.

        Words of up to ``STEP_BYTES`` bytes walk the trie in step, sorted by length.
        """
        sizes = np.array([len(w) for w in words])
        order = np.argsort(sizes, kind="stable")
        order, long = order[sizes[order] <= STEP_BYTES], order[sizes[order] > STEP_BYTES]
        flat, lengths = [], np.zeros(len(words), np.int64)
        for lo in range(0, len(order), 20_000):
            part = order[lo : lo + 20_000]
            ids, lengths[part] = self._in_step([words[i] for i in part.tolist()])
            flat.append(ids)
        for i in long.tolist():
            ids = np.array(self.one(words[i]), np.int32)
            lengths[i] = len(ids)
            flat.append(ids)
        done = np.concatenate([order, long])
        ends = np.cumsum(lengths[done])
        start = np.empty(len(words), np.int64)
        start[done] = ends - lengths[done]
        return ragged(np.concatenate(flat), start, start + lengths), lengths

    def _in_step(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        trie = self.trie
        n, length = np.array([len(w) for w in words]), max(map(len, words))
        data = np.frombuffer(b"".join(w.ljust(length + 1, b"\0") for w in words), np.uint8).reshape(len(words), length + 1)
        best = np.full((len(words), length + 5), -np.inf)
        start_of = np.zeros((len(words), length + 5), np.int32)
        piece_of = np.full((len(words), length + 5), -1, np.int32)
        best[:, 0] = 0.0
        lead = (data & 0xC0) != 0x80
        for start in range(length):
            rows = np.flatnonzero((n > start) & lead[:, start])
            if not len(rows):
                continue
            width = _WIDTH[data[rows, start]]
            single = np.zeros(len(rows), bool)
            here = best[rows, start]
            live, node, at = np.arange(len(rows)), np.zeros(len(rows), np.int32), start
            while len(live):
                going = n[rows[live]] > at
                live, node = live[going], node[going]
                child = trie.base[node] + data[rows[live], at].astype(np.int32) + 1
                found = trie.check[child] == node
                live, node = live[found], child[found]
                at += 1
                piece = trie.value[node]
                ends = piece >= 0
                if ends.any():
                    i, p = live[ends], piece[ends]
                    single[i] |= at == start + width[i]
                    total = here[i] + self.score[p]
                    better = total > best[rows[i], at]
                    r = rows[i[better]]
                    best[r, at], start_of[r, at], piece_of[r, at] = total[better], start, p[better]
            lone = np.flatnonzero(~single)
            if len(lone):
                r, end = rows[lone], start + width[lone]
                total = here[lone] + self.unknown
                better = total > best[r, end]
                r, end = r[better], end[better]
                best[r, end], start_of[r, end], piece_of[r, end] = total[better], start, -1
        # back from the ends, all words in step; ids fill a table from the right
        table, filled = np.empty((len(words), length + 1), np.int32), np.zeros(len(words), np.int64)
        rows, at = np.arange(len(words)), n.copy()
        while len(rows):
            piece, start = piece_of[rows, at], start_of[rows, at]
            known = piece >= 0
            table[rows[known], length - filled[rows[known]]] = piece[known]
            filled[rows[known]] += 1
            for i in np.flatnonzero(~known).tolist():  # a character without a piece: its bytes, the last first
                r = rows[i]
                for byte in data[r, start[i] : at[i]][::-1].tolist():
                    table[r, length - filled[r]] = self.by_byte[byte]
                    filled[r] += 1
            at = start
            rows, at = rows[at > 0], at[at > 0]
        return table[np.arange(length, -1, -1)[None, :] < filled[:, None]], filled

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of a sequence of pieces, without the leading space."""
        return ragged(self.out, self.out_at[ids], self.out_at[ids + 1])[1:].tobytes()


_WIDTH = np.array([1] * 0xC0 + [2] * 0x20 + [3] * 0x10 + [4] * 0x10)


def ragged(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """values[starts[0]:ends[0]], values[starts[1]:ends[1]], ... as one array."""
    lengths = ends - starts
    total = int(lengths.sum())
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(starts) else starts, lengths)
    return values[np.arange(total) + shift]


class _Memo:
    """Segmentations of the words met, by 64-bit hash; emptied beyond ``MEMO_WORDS``."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.index: dict[int, int] = {}
        self.flat, self.at = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def find(self, model: Unigram, known: np.ndarray, word_of: Callable[[int], bytes]) -> np.ndarray:
        if len(self.index) > MEMO_WORDS:
            self.clear()
        where = np.array([self.index.get(h, -1) for h in known.tolist()], np.int64)
        new = np.flatnonzero(where < 0)
        if len(new):
            flat, lengths = model.many([word_of(i) for i in new.tolist()])
            where[new] = np.arange(len(new)) + len(self.at) - 1
            self.index.update(zip(known[new].tolist(), where[new].tolist()))
            self.flat = np.concatenate([self.flat, flat])
            self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(lengths)])
        return where


def _encoded(
    model: Unigram, batches: Iterator[pa.RecordBatch], memo: _Memo
) -> Iterator[tuple[pa.RecordBatch, Texts, np.ndarray, np.ndarray]]:
    for batch, texts in text_slices(batches, most=1 << 20):
        data, starts, bounds, hashes = chunks(texts)
        known, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        ends, raw = np.append(starts[1:], len(data)), data.tobytes()
        where = memo.find(model, known, lambda i: raw[starts[first[i]] : ends[first[i]]])[back]
        lo, hi = memo.at[where], memo.at[where + 1]
        ids = ragged(memo.flat, lo, hi)
        scan = np.concatenate([[0], np.cumsum(hi - lo)])[bounds]
        yield batch, texts, ids, scan


def _model(df: DataFrame, model_path: str):
    """The compiled model as a broadcast; its size is that of the vocabulary, at most ``MAX_PIECES``."""
    return df.sparkSession.sparkContext.broadcast(Unigram(*load_pieces(model_path)))


def encode(df: DataFrame, model_path: str, text_col: str = "text", out_col: str = "piece_ids") -> DataFrame:
    """``df`` with the piece ids of its texts in ``out_col`` (replaced if it is there already).

    Null and empty texts have no pieces. Rows are encoded one by one; all columns stay.
    """
    model = _model(df, model_path)
    kept = [c for c in df.columns if c != out_col]
    slot = kept.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        renamed = (pa.RecordBatch.from_arrays(b.columns, names=[str(i) if i != slot else "text" for i in range(len(kept))]) for b in batches)
        for batch, _, ids, scan in _encoded(model.value, renamed, kept_in_process(f"words {model_path}", _Memo)):
            pieces = pa.ListArray.from_arrays(pa.array(scan, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pieces], names=[*kept, out_col])

    rows = df.select(*[F.col(f"`{c}`") for c in kept])
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields]).add(out_col, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, model_path: str, ids_col: str = "piece_ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the text of its piece ids in ``out_col``: marks become spaces, the leading one goes.

    Byte pieces become their bytes, malformed UTF-8 the replacement character. Null ids give an empty text.
    """
    model = _model(df, model_path)
    kept = [c for c in df.columns if c != out_col]
    slot = kept.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [model.value.decode(np.array(x or [], np.int64)).decode(errors="replace") for x in batch.column(slot).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*kept, out_col])

    rows = df.select(*[F.col(f"`{c}`") for c in kept])
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields]).add(out_col, "string"))


def encoding_digests(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_pieces, n_byte_pieces, pieces_sha256, decoded_sha256, round_trip) of every row.

    ``pieces_sha256`` is over the ids as little-endian 32-bit numbers, ``round_trip`` whether
    decoding them gives the text again (false only for texts that hold space marks
    themselves). Null and empty texts have no pieces and come back as empty text.
    """
    model = _model(df, model_path)
    names = ["id", "n_pieces", "n_byte_pieces", "pieces_sha256", "decoded_sha256", "round_trip"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        is_byte = np.zeros(len(m.score), bool)
        is_byte[m.by_byte] = True
        for batch, texts, ids, scan in _encoded(m, batches, kept_in_process(f"words {model_path}", _Memo)):
            wide = ids.astype(np.int64)
            lengths = m.out_at[wide + 1] - m.out_at[wide]
            decoded = ragged(m.out, m.out_at[wide], m.out_at[wide + 1])
            ends = np.concatenate([[0], np.cumsum(lengths)])[scan]
            fallback = np.concatenate([[0], np.cumsum(is_byte[wide])])[scan]
            found = defaultdict(list)
            for i in range(len(texts)):
                text = decoded[ends[i] + 1 : ends[i + 1]].tobytes()
                found["pieces"].append(hashlib.sha256(ids[scan[i] : scan[i + 1]].astype("<i4").tobytes()).hexdigest())
                found["decoded"].append(hashlib.sha256(text).hexdigest())
                found["same"].append(text == texts.data[texts.bounds[i] : texts.bounds[i + 1]].tobytes())
            columns = [
                batch.column(0),
                pa.array(np.diff(scan), pa.int64()),
                pa.array(np.diff(fallback), pa.int64()),
                pa.array(found["pieces"], pa.string()),
                pa.array(found["decoded"], pa.string()),
                pa.array(found["same"], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(
        run, f"id {kind}, n_pieces long, n_byte_pieces long, pieces_sha256 string, decoded_sha256 string, round_trip boolean"
    )
    return out.withColumnRenamed("id", id_col)
