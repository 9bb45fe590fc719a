"""Token counts by a finite-state transducer compiled from a BPE vocabulary.

The transducer reads characters. Its state is the longest read suffix that begins a piece,
with the last token and the relative token count at each boundary inside that suffix; a
transition carries the change of the count. That is exact because a sequence of BPE tokens
is the encoding of its text if and only if each adjacent pair is the encoding of its own
text: after one more character, the one suffix piece that fits the last token before it is
the new last token. States are compiled when first reached and kept.

No piece holds a space mark behind another character, so every state goes to one and the
same state at the start of a word: the state map of such a chunk is constant, a pair (end
state, count), and composing maps adds counts. The prefix scan over all chunks of a slice
is therefore a running sum, cut at the texts' bounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Texts, kept_in_process, rows_of, text_slices
from .words import _powers, mixed

MARK = "▁"
MARK_BYTES = MARK.encode()
MEMO_WORDS = 2_000_000
MAX_STATES = 200_000
_BYTE = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 256, dtype=np.uint64)


def load_pieces(path: str) -> tuple[dict[str, tuple[int, float]], dict[int, int]]:
    """Normal pieces as text -> (id, score), and the id of each byte piece, of a sentencepiece model."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, by_byte = {}, {}
    for i in range(sp.get_piece_size()):
        text = sp.id_to_piece(i)
        if sp.is_byte(i):
            by_byte[int(text[3:5], 16)] = i
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            pieces[text] = (i, sp.get_score(i))
    if len(by_byte) != 256 or any(MARK in p.lstrip(MARK) for p in pieces):
        raise ValueError("the model needs byte fallback and pieces whose space marks come first")
    if sp.normalize("ﬁ ①  a") != f"{MARK}ﬁ{MARK}①{MARK}{MARK}a":
        raise ValueError("only models with the identity normaliser and a leading space mark are supported")
    return pieces, by_byte


def chunks(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with a leading space for each text that isn't empty, chunk starts, each text's bounds in them, chunk hashes.

    A chunk starts at a space that follows anything else, and at a text's start. A space mark
    in a text is a space, as in the tokenizer.
    """
    bounds, data = texts.bounds, texts.data
    if len(data) and MARK_BYTES in data.tobytes():
        parts = [s.replace(MARK, " ").encode() for s in (x or "" for x in texts.strings())]
        data = np.frombuffer(b"".join(parts), np.uint8)
        bounds = np.cumsum([0, *map(len, parts)])
    full = np.diff(bounds) > 0
    data = np.insert(data, bounds[:-1][full], 32)
    bounds = bounds + np.concatenate([[0], np.cumsum(full)])
    if not len(data):
        none = np.zeros(0, np.int64)
        return data, none, np.zeros(len(bounds), np.int64), np.zeros(0, np.uint64)
    space = data == 32
    first = space.copy()
    first[1:] &= ~space[:-1]
    first[bounds[:-1][full]] = True
    starts = np.flatnonzero(first)
    lengths = np.diff(np.append(starts, len(data)))
    place = np.arange(len(data), dtype=np.int32) - np.repeat(starts.astype(np.int32), lengths)
    with np.errstate(over="ignore"):
        hashes = mixed(np.add.reduceat(_BYTE[data] * _powers(int(lengths.max()))[place], starts))
    return data, starts, np.searchsorted(starts, bounds), hashes


class Memo:
    """Counts by chunk hash in sorted arrays, ten bytes a chunk; emptied beyond ``MEMO_WORDS``."""

    def __init__(self) -> None:
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted keys, -1 for those not held."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = np.searchsorted(self.keys, keys).clip(max=len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], -1).astype(np.int64)

    def put(self, keys: np.ndarray, counts: np.ndarray) -> None:
        if len(self.keys) > MEMO_WORDS:
            self.__init__()
        at = np.searchsorted(self.keys, keys)
        self.keys, self.counts = np.insert(self.keys, at, keys), np.insert(self.counts, at, counts)


class Transducer:
    """Characters in, changes of the token count out; compiled as states are reached."""

    def __init__(self, pieces: dict[str, tuple[int, float]], max_states: int = MAX_STATES):
        self.rank = {p: score for p, (_, score) in pieces.items()}
        self.canon = {p: p for p in pieces}
        self.prefixes = {p[:i] for p in pieces for i in range(1, len(p) + 1)}
        ranked = sorted((p for p in pieces if len(p) > 1), key=lambda p: -self.rank[p])
        self.order = {p: 0 for p in pieces if len(p) == 1} | {p: i + 1 for i, p in enumerate(ranked)}
        self.splits: dict[str, tuple[str, str] | None] = {}
        self.max_states = max_states
        # a state: the suffix, then (length from boundary to end, last token before it, relative count) thrice
        # for each boundary where a piece may be under way, the end itself first
        self.states: list[tuple] = [("", 0, None, 0)]
        self.ids = {self.states[0]: 0}
        self.step: list[dict[str, int]] = [{}]

    def _merged(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """The encoding by definition: merge the best pair, the leftmost of equals; and the last pair merged."""
        parts, last = list(text), None
        while len(parts) > 1:
            at = max(range(len(parts) - 1), key=lambda i: (self.rank.get(parts[i] + parts[i + 1], -np.inf), -i))
            if parts[at] + parts[at + 1] not in self.rank:
                break
            last = parts[at], parts[at + 1]
            parts[at : at + 2] = ["".join(last)]
        return parts, last

    def _split(self, piece: str) -> tuple[str, str] | None:
        """The two tokens whose merge makes a piece from its own characters; None if that never happens."""
        if piece not in self.splits:
            parts, last = self._merged(piece)
            self.splits[piece] = last if parts == [piece] else None
        return self.splits[piece]

    def _sound(self, piece: str) -> bool:
        return piece in self.rank and (len(piece) == 1 or self._split(piece) is not None)

    def _fits(self, last: str | None, piece: str) -> bool:
        """Whether two adjacent tokens are the encoding of their text.

        Undo merges from the latest on; had the two tokens then at the seam been merged
        before the undone merge, the pair could not have come about.
        """
        if last is None:
            return True
        if (last + piece).startswith(2 * MARK):  # runs of marks may have equal scores
            return self._merged(last + piece)[0] == [last, piece]
        limit = np.inf
        while True:
            whole = self.order.get(last + piece)
            if whole is not None and whole < limit and self._split(last + piece) == (last, piece):
                return False
            if self.order[last] > self.order[piece]:
                limit, last = self.order[last], self._split(last)[1]
            elif len(piece) > 1:
                limit, piece = self.order[piece] + 1, self._split(piece)[0]
            else:
                return True

    def _move(self, state: tuple, char: str) -> tuple[tuple, int]:
        """The state behind one more character, and the change of the count."""
        if char not in self.rank:  # a character without a piece becomes its bytes
            return self.states[0], len(char.encode())
        text, found = state[0] + char, None
        still_open = []
        for i in range(1, len(state), 3):
            n, last, count = state[i] + 1, state[i + 1], state[i + 2]
            piece = text[-n:]
            if found is None and self._sound(piece) and self._fits(last, piece):
                found, change = self.canon[piece], count + 1
            if piece in self.prefixes:
                still_open.append((n, last, count))
        if found is None:
            raise AssertionError(f"no token ends after {text!r}")
        key = [text[-still_open[-1][0] :] if still_open else "", 0, found, 0]
        for n, last, count in still_open:
            key += (n, last, count - change)
        return tuple(key), change

    def count(self, chunk: str) -> int:
        """Tokens of one chunk: its constant state map's count."""
        state, total, step = 0, 0, self.step
        for at, char in enumerate(chunk):
            move = step[state].get(char)
            if move is None:
                return total - 32 * at + self._count_on(state, chunk[at:])
            state = move >> 6
            total += move & 63
        return total - 32 * len(chunk)

    def _count_on(self, at: int | None, chunk: str) -> int:
        """``count`` from a state on, compiling what is met; beyond ``max_states`` new states are not kept."""
        total, state = 0, self.states[at]
        for char in chunk:
            move = self.step[at].get(char) if at is not None else None
            if move is not None:
                at, change = move >> 6, (move & 63) - 32
                state = self.states[at]
            else:
                state, change = self._move(state, char)
                to = self.ids.get(state)
                if to is None and len(self.states) < self.max_states:
                    to = self.ids[state] = len(self.states)
                    self.states.append(state)
                    self.step.append({})
                if at is not None and to is not None:
                    self.step[at][char] = to << 6 | change + 32
                at = to
            total += change
        return total


def token_counts(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) for every row: tokens of the whole text, without begin or end tokens.

    A null or empty text has 0 bytes and 0 tokens. Rows are counted one by one: repeated
    rows and null ids come back as they are. ``df`` may have any other columns.
    ``model_path`` is read where the tasks run, as the tokenizer's library does. A chunk's
    count is kept by a 64-bit hash for about ``MEMO_WORDS`` chunks at a time, and ``MAX_STATES``
    states are kept; what goes beyond them is computed each time, with equal results.
    """
    schema = pa.schema([("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = kept_in_process(f"transducer {model_path}", lambda: Transducer(load_pieces(model_path)[0]))
        memo = kept_in_process(f"token counts {model_path}", Memo)
        for batch, texts in text_slices(batches, most=1 << 20):
            data, starts, bounds, hashes = chunks(texts)
            known, first, back = np.unique(hashes, return_index=True, return_inverse=True)
            counts = memo.get(known)
            ends = np.append(starts[1:], len(data))
            raw, new = data.tobytes(), np.flatnonzero(counts < 0)
            for i, a, b in zip(new.tolist(), starts[first[new]].tolist(), ends[first[new]].tolist()):
                counts[i] = machine.count(raw[a:b].decode().replace(" ", MARK))
            memo.put(known[new], counts[new])
            scan = np.concatenate([[0], np.cumsum(counts[back])])  # composition of constant state maps
            out = rows_of(schema, np.diff(texts.bounds), np.diff(scan[bounds]))
            yield pa.RecordBatch.from_arrays([batch.column(0), *out.columns], names=["id", *schema.names])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return out.withColumnRenamed("id", id_col)
