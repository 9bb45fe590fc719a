"""Alignment of two tokenizers' ids through inverted bitmaps of linked id pairs.

Texts are cut into chunks at spaces behind a printing character. No token of either tokenizer
reaches across such a cut, so a text's tokens are those of its chunks, and each distinct chunk
is encoded once by each tokenizer's library and kept.

Documents are numbered inside containers of at most 65,536. Per id pair and container the index
has a compressed bitmap of the documents that link the pair, and bit planes of how often each
links it beyond once: a sorted list of 16-bit numbers, or a plain bitmap where that is shorter.
Parts are OR-merged; their set bits, weighted by plane, give a pair's documents and links. The
counts then go back to the containers that hold the pair, where postings add them to documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Texts, cut, kept_in_process, rows_of, text_slices
from .words import _BYTE, _powers, mixed

CONTAINER = 1 << 16
CONTAINER_LINKS = 4_000_000  # a container ends with the document that reaches this many links
FLUSH_LINKS = 1_000_000
BUCKETS = 16
DENSE = CONTAINER // 16  # as many 16-bit numbers take what a bitmap takes
MEMO_CHUNKS = 300_000
MEMO_BYTES = 1 << 24  # of chunk texts
MAX_ID = 1 << 18
SLICE = 1 << 20
MARK = "▁"


# ---- the two tokenizers ---------------------------------------------------------


class Vocabulary:
    """The bytes of every id, end to end."""

    def __init__(self, tokens: list[bytes]):
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.size) - self.size

    def spell(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.size[ids]
        total = int(sizes.sum())
        ends = np.cumsum(sizes)
        return self.bytes[np.arange(total) - np.repeat(ends - sizes, sizes) + np.repeat(self.start[ids], sizes)]


class ByteLevel:
    """A byte-level BPE of the tokenizers library; special strings are ordinary text."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.coder = Tokenizer.from_file(path)
        self.coder.encode_special_tokens = True
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in printed}
        byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printed)}
        tokens = [b""] * self.coder.get_vocab_size(with_added_tokens=True)
        for text, i in self.coder.get_vocab(with_added_tokens=True).items():
            known = all(c in byte_of for c in text)
            tokens[i] = bytes(byte_of[c] for c in text) if known else text.encode()
        self.vocabulary = Vocabulary(tokens)

    def encode(self, chunks: list[str]) -> list[list[int]]:
        return [e.ids for e in self.coder.encode_batch_fast(chunks, add_special_tokens=False)]


class Pieces:
    """A sentencepiece model, which puts a space before what it is given."""

    def __init__(self, path: str):
        import sentencepiece

        self.coder = sentencepiece.SentencePieceProcessor(model_file=path)
        texts = [self.coder.id_to_piece(i) for i in range(self.coder.get_piece_size())]
        if any(MARK in t.lstrip(MARK) for t in texts):
            raise ValueError("the model needs pieces whose space marks come first")
        coded = [
            bytes([int(t[3:5], 16)]) if self.coder.is_byte(i) else t.replace(MARK, " ").encode()
            for i, t in enumerate(texts)
        ]
        self.vocabulary = Vocabulary(coded)
        self.space = self.coder.piece_to_id(MARK)

    def encode(self, chunks: list[str]) -> list[list[int]]:
        found = self.coder.encode([c[1:] for c in chunks], num_threads=1)
        return [ids or [self.space] for ids in found]  # a lone space is the mark alone


# ---- chunks ---------------------------------------------------------------------


def chunks(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with a leading space before each text that isn't empty, chunk starts, each text's bounds in them, chunk hashes.

    A chunk starts at a text's start and at a space behind a byte that surely is no white space:
    a printing ASCII character, or the end of a character beyond ASCII that isn't one of the
    white-space ones or close to them.
    """
    full = np.diff(texts.bounds) > 0
    data = np.insert(texts.data, texts.bounds[:-1][full], 32)
    bounds = texts.bounds + np.concatenate([[0], np.cumsum(full)])
    if not len(data):
        none = np.zeros(0, np.int64)
        return data, none, np.zeros(len(bounds), np.int64), np.zeros(0, np.uint64)
    one, two, three = (np.concatenate([np.zeros(k, np.uint8), data[:-k]])[: len(data)] for k in (1, 2, 3))
    wide_space = ((two == 0xC2) & ((one == 0x85) | (one == 0xA0))) | (
        (three >= 0xE1) & (three <= 0xE3) & ((two == 0x9A) | (two == 0x80) | (two == 0x81))
    )
    first = (data == 32) & (((one > 32) & (one < 127)) | ((one >= 128) & ~wide_space))
    first[bounds[:-1][full]] = True
    starts = np.flatnonzero(first)
    lengths = np.diff(np.append(starts, len(data)))
    place = np.arange(len(data), dtype=np.int32) - np.repeat(starts.astype(np.int32), lengths)
    with np.errstate(over="ignore"):
        hashes = mixed(np.add.reduceat(_BYTE_EXACT[data] * _powers(int(lengths.max()))[place], starts))
    return data, starts, np.searchsorted(starts, bounds), hashes


# letters keep their case here, unlike in word hashes
_BYTE_EXACT = mixed(_BYTE + np.arange(256, dtype=np.uint64))


class Aligned:
    """What is known of distinct chunks: token numbers, groups as text, linked pairs.

    Found by a 64-bit hash of the chunk and emptied beyond ``MEMO_CHUNKS`` or ``MEMO_BYTES``.
    """

    def __init__(self, a: ByteLevel, b: Pieces):
        self.a, self.b = a, b
        if max(len(a.vocabulary.size), len(b.vocabulary.size)) > MAX_ID:
            raise ValueError(f"vocabularies may have {MAX_ID} ids")
        self.clear()

    def clear(self) -> None:
        self.keys, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.numbers = np.zeros((0, 4), np.int64)  # tokens of A, of B, groups, whether both spell the chunk
        self.groups: list[bytes] = []
        self.pairs, self.pair_at = np.zeros(0, np.int64), np.zeros(1, np.int64)
        self.held = 0

    def look_up(self, hashes: np.ndarray, texts: list[bytes]) -> np.ndarray:
        """Rows of the distinct chunks ``texts`` with sorted ``hashes``."""
        at = np.searchsorted(self.keys, hashes).clip(max=max(0, len(self.keys) - 1))
        known = self.keys[at] == hashes if len(self.keys) else np.zeros(len(hashes), bool)
        new = np.flatnonzero(~known)
        if len(new):
            if len(self.keys) + len(new) > MEMO_CHUNKS or self.held > MEMO_BYTES:
                self.clear()
                new = np.arange(len(hashes))
            first = len(self.groups)
            self._add([texts[i] for i in new])
            where = np.searchsorted(self.keys, hashes[new])
            self.keys = np.insert(self.keys, where, hashes[new])
            self.rows = np.insert(self.rows, where, first + np.arange(len(new)))
            at = np.searchsorted(self.keys, hashes)
        return self.rows[at]

    def _add(self, raw: list[bytes]) -> None:
        sizes = np.array([len(t) for t in raw], np.int64)
        ends = np.cumsum(sizes)
        whole = np.frombuffer(b"".join(raw), np.uint8)
        self.held += len(whole)
        texts = [t.decode() for t in raw]
        coded = []
        for coder in (self.a, self.b):
            ids = coder.encode(texts)
            count = np.array([len(i) for i in ids], np.int64)
            flat = np.fromiter(chain.from_iterable(ids), np.int64, int(count.sum()))
            coded.append((coder.vocabulary, ids, count, flat))
        alike = np.ones(len(raw), bool)
        for vocabulary, _, count, flat in coded:
            size = vocabulary.size[flat]
            up_to = np.concatenate([[0], np.cumsum(size)])[np.cumsum(count)]
            spelled = np.diff(np.concatenate([[0], up_to]))
            same = spelled == sizes
            if same.all():
                wrong = np.add.reduceat((vocabulary.spell(flat) != whole).astype(np.int64), ends - sizes)
                same &= wrong == 0
            else:  # compare one by one; a chunk that both don't spell has no tokens
                spell = vocabulary.spell(flat).tobytes()
                same &= np.array([spell[u - s : u] == t for u, s, t in zip(up_to, spelled, raw)])
            alike &= same
        where = ends - sizes
        a, b = (_Tokens.of(v, count, flat, where, alike) for v, _, count, flat in coded)
        common = np.intersect1d(a.end, b.end, assume_unique=True)
        linked_a, linked_b = np.isin(a.end, common), np.isin(b.end, common)
        n = np.bincount(a.chunk[linked_a], minlength=len(raw))
        self.groups += _group_texts(a, b, common, n)
        numbers = np.stack([coded[0][2], coded[1][2], n, np.ones(len(raw), np.int64)], axis=1)
        self.numbers = np.concatenate([self.numbers, numbers * alike[:, None]])
        self.pairs = np.concatenate([self.pairs, a.id[linked_a] << 32 | b.id[linked_b]])
        self.pair_at = np.concatenate([self.pair_at, self.pair_at[-1] + np.cumsum(n)])


@dataclass
class _Tokens:
    """Tokens of many chunks: id, chunk, and where each ends in the chunks' joined bytes."""

    id: np.ndarray
    chunk: np.ndarray
    end: np.ndarray

    @staticmethod
    def of(vocabulary: Vocabulary, count: np.ndarray, flat: np.ndarray, where: np.ndarray, keep: np.ndarray) -> _Tokens:
        chunk = np.repeat(np.arange(len(count)), count)
        up_to = np.concatenate([[0], np.cumsum(vocabulary.size[flat])])
        before = up_to[np.cumsum(count) - count]
        end = up_to[1:] - before[chunk] + where[chunk]
        kept = keep[chunk]
        return _Tokens(flat[kept], chunk[kept], end[kept])


def _group_texts(a: _Tokens, b: _Tokens, common: np.ndarray, groups: np.ndarray) -> list[bytes]:
    """`a1,a2|b1;a3|b2,b3` for each chunk; ``groups`` is how many it has."""
    side = np.concatenate([2 * np.searchsorted(common, a.end), 2 * np.searchsorted(common, b.end) + 1])
    order = np.argsort(side, kind="stable")
    ids, side = np.concatenate([a.id, b.id])[order], side[order]
    numbers = kept_in_process("ids as text", lambda: Vocabulary([b"%d," % i for i in range(MAX_ID)]))
    written, ends = numbers.spell(ids), np.cumsum(numbers.size[ids])
    last = np.append(side[1:] != side[:-1], np.ones(min(1, len(side)), bool))
    written[ends[last] - 1] = np.where(side[last] & 1, ord(";"), ord("|"))
    group_end = np.concatenate([[0], ends[last & (side & 1 == 1)]])
    upto = np.concatenate([[0], group_end[np.cumsum(groups)]])
    text = written.tobytes()
    return [text[i : max(i, j - 1)] for i, j in zip(upto[:-1].tolist(), upto[1:].tolist())]


# ---- bitmaps --------------------------------------------------------------------


@dataclass
class Postings:
    """Sorted pairs; per plane the sorted cells (pair's index << 16 | document).

    Plane 0 says which documents link a pair, plane k + 1 holds bit k of how often beyond once.
    """

    pairs: np.ndarray
    planes: list[np.ndarray]

    @staticmethod
    def of(pairs: np.ndarray, docs: np.ndarray) -> Postings:
        distinct, at = np.unique(pairs, return_inverse=True)
        cells, times = np.unique(at.astype(np.int64) << 16 | docs, return_counts=True)
        planes, more = [cells], times - 1
        while more.any():
            planes.append(cells[more & 1 == 1])
            more = more >> 1
        return Postings(distinct, planes)

    def part(self, keep: np.ndarray) -> Postings:
        """The pairs marked in ``keep``."""
        to = np.cumsum(keep) - 1
        planes = []
        for cells in self.planes:
            cells = cells[keep[cells >> 16]]
            planes.append(to[cells >> 16] << 16 | cells & 0xFFFF)
        return Postings(self.pairs[keep], planes)

    @staticmethod
    def merged(parts: list[Postings]) -> Postings:
        """The OR of bitmaps of the same container."""
        if len(parts) == 1:
            return parts[0]
        pairs = np.unique(np.concatenate([p.pairs for p in parts]))
        planes = []
        for k in range(max(len(p.planes) for p in parts)):
            cells = [
                np.searchsorted(pairs, p.pairs)[p.planes[k] >> 16] << 16 | p.planes[k] & 0xFFFF
                for p in parts
                if k < len(p.planes)
            ]
            planes.append(np.unique(np.concatenate(cells)))
        return Postings(pairs, planes)

    def pack(self) -> bytes:
        """Little-endian arrays: sizes, pairs, and per plane set bits by pair, 16-bit lists, bitmaps."""
        out = [np.array([len(self.pairs), len(self.planes)], np.int32).tobytes(), self.pairs.tobytes()]
        for cells in self.planes:
            pair, doc = cells >> 16, (cells & 0xFFFF).astype(np.uint16)
            held = np.bincount(pair, minlength=len(self.pairs)).astype(np.uint32)
            dense = held > DENSE
            out += [held.tobytes(), doc[~dense[pair]].tobytes()]
            ends = np.cumsum(held)
            for i in np.flatnonzero(dense):
                bits = np.zeros(CONTAINER, bool)
                bits[doc[ends[i] - held[i] : ends[i]]] = True
                out.append(np.packbits(bits).tobytes())
        return b"".join(out)

    @staticmethod
    def unpack(blob: bytes) -> Postings:
        n, k = np.frombuffer(blob, np.int32, 2).tolist()
        pairs = np.frombuffer(blob, np.int64, n, 8)
        at, planes = 8 + 8 * n, []
        for _ in range(k):
            held = np.frombuffer(blob, np.uint32, n, at)
            at += 4 * n
            dense = held > DENSE
            lone = np.where(dense, 0, held)
            doc = np.frombuffer(blob, np.uint16, int(lone.sum()), at).astype(np.int64)
            at += 2 * len(doc)
            cells = [np.repeat(np.arange(n), lone) << 16 | doc]
            for i in np.flatnonzero(dense):
                bits = np.frombuffer(blob, np.uint8, CONTAINER // 8, at)
                at += CONTAINER // 8
                cells.append(int(i) << 16 | np.flatnonzero(np.unpackbits(bits)))
            planes.append(np.sort(np.concatenate(cells)) if dense.any() else cells[0])
        return Postings(pairs, planes)

    def set_bits(self) -> np.ndarray:
        """Popcounts: a row per plane, a column per pair."""
        return np.array([np.bincount(cells >> 16, minlength=len(self.pairs)) for cells in self.planes], np.int64)

    def links(self) -> np.ndarray:
        """How often each pair is linked: its documents, and the planes' bits by their weight."""
        bits = self.set_bits()
        return bits[0] + sum(bits[k] << (k - 1) for k in range(1, len(bits)))

    def times(self) -> np.ndarray:
        """How often each cell of plane 0 is linked."""
        out = np.ones(len(self.planes[0]), np.int64)
        for k, cells in enumerate(self.planes[1:]):
            out[np.searchsorted(self.planes[0], cells)] += 1 << k
        return out


# ---- Spark ----------------------------------------------------------------------

_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")
_PACKED = pa.schema([("container", pa.int64()), ("bucket", pa.int32()), ("blob", pa.binary())])
_KEYS = ["container", "bucket"]


def _encode(path_a: str, path_b: str, id_type: pa.DataType):
    """Per document a row with its numbers and its place; per container and bucket rows of packed postings."""
    numbers = [(c, pa.int64()) for c in _NUMBERS]
    schema = pa.schema([("id", id_type), ("doc", pa.int64()), *numbers, ("groups", pa.string()), *_PACKED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        memo = kept_in_process(f"aligned {path_a} {path_b}", lambda: Aligned(ByteLevel(path_a), Pieces(path_b)))
        container, low, in_container = TaskContext.get().partitionId() << 32, 0, 0
        held: list[tuple[np.ndarray, np.ndarray]] = []
        held_links = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, held_links
            if held_links:
                postings = Postings.of(*(np.concatenate(x) for x in zip(*held)))
                bucket = (mixed(postings.pairs.astype(np.uint64)) % np.uint64(BUCKETS)).astype(np.int64)
                for k in np.unique(bucket).tolist():
                    yield _row(schema, container=container, bucket=k, blob=postings.part(bucket == k).pack())
            held, held_links = [], 0

        for batch, texts in text_slices(batches, most=SLICE):
            found = _aligned_texts(memo, texts)
            n_links = found.numbers[:, 3]
            places, at = np.zeros(len(texts), np.int64), 0
            link_at = np.concatenate([[0], np.cumsum(n_links)])
            while at < len(texts):
                # documents up to the container's end, or until enough links are held
                reach = np.cumsum(n_links[at:])
                full = int(np.searchsorted(reach, CONTAINER_LINKS - in_container)) + 1
                some = int(np.searchsorted(reach, FLUSH_LINKS - held_links)) + 1
                n = min(len(texts) - at, CONTAINER - low, full, some)
                numbers = low + np.arange(n)
                places[at : at + n] = container << 16 | numbers
                held.append((found.pairs[link_at[at] : link_at[at + n]], np.repeat(numbers, n_links[at : at + n])))
                more = int(reach[n - 1])
                low, in_container, held_links, at = low + n, in_container + more, held_links + more, at + n
                ended = low == CONTAINER or in_container >= CONTAINER_LINKS
                if ended or held_links >= FLUSH_LINKS:
                    yield from flush()
                if ended:
                    container, low, in_container = container + 1, 0, 0
            yield _row(schema, len(texts), id=batch.column(0), doc=places, groups=found.groups,
                       **dict(zip(_NUMBERS, found.numbers.T)))
        yield from flush()

    return run


def _row(schema: pa.Schema, n: int = 1, **values) -> pa.RecordBatch:
    """Rows with the named columns; the others are null."""
    columns = []
    for f in schema:
        v = values.get(f.name)
        if v is None:
            v = pa.nulls(n, f.type)
        elif not isinstance(v, (pa.Array, np.ndarray, list)):
            v = [v]
        columns.append(v)
    return rows_of(schema, *columns)


@dataclass
class _Found:
    numbers: np.ndarray
    groups: list[str]
    pairs: np.ndarray


def _aligned_texts(memo: Aligned, texts: Texts) -> _Found:
    """Numbers, groups and linked pairs of each text; all empty where a chunk isn't spelled alike."""
    data, starts, bounds, hashes = chunks(texts)
    known, first, back = np.unique(hashes, return_index=True, return_inverse=True)
    ends = np.append(starts[1:], len(data))
    raw = data.tobytes()
    rows = memo.look_up(known, [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())])[back]
    each = memo.numbers[rows]
    sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(each, axis=0)])
    numbers = sums[bounds[1:]] - sums[bounds[:-1]]
    sound = numbers[:, 3] == np.diff(bounds)
    numbers[:, 3] = numbers[:, 2]
    numbers[~sound] = 0
    names = memo.groups
    groups = [
        hashlib.sha256(b";".join([names[r] for r in rows[a:b].tolist()])).hexdigest() if ok and b > a else ""
        for a, b, ok in zip(bounds[:-1].tolist(), bounds[1:].tolist(), sound.tolist())
    ]
    text_of = np.repeat(np.arange(len(texts)), np.diff(bounds))
    used = rows[sound[text_of]]
    size = memo.pair_at[used + 1] - memo.pair_at[used]
    ends = np.cumsum(size)
    flat = np.arange(int(size.sum())) - np.repeat(ends - size, size) + np.repeat(memo.pair_at[used], size)
    return _Found(numbers, groups, memo.pairs[flat])


def _merge(table: pa.Table) -> pa.Table:
    parts = [Postings.unpack(b.as_py()) for b in table.column("blob")]
    first = table.slice(0, 1)
    blob = pa.array([Postings.merged(parts).pack()], pa.binary())
    return pa.table([first.column("container"), first.column("bucket"), blob], schema=_PACKED)


_COUNTED = pa.schema([*list(_PACKED)[:2], ("pair", pa.int64()), ("docs", pa.int64()), ("links", pa.int64())])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents and links of each pair in each container."""
    for batch in batches:
        for container, bucket, blob in zip(*(batch.column(i).to_pylist() for i in range(3))):
            p = Postings.unpack(blob)
            n = len(p.pairs)
            yield rows_of(_COUNTED, np.full(n, container), np.full(n, bucket), p.pairs, p.set_bits()[0], p.links())


_SCORED = pa.schema([("doc", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64())])


def _scored(index: pa.Table, scores: pa.Table) -> pa.Table:
    """What the postings of a container and bucket add to each document: best links, and counts over links."""
    if not index.num_rows:
        return _SCORED.empty_table()
    p = Postings.unpack(index.column("blob")[0].as_py())
    pair = scores.column("pair").to_numpy()
    order = np.argsort(pair)
    at = order[np.searchsorted(pair, p.pairs, sorter=order)]
    links, best = scores.column("links").to_numpy()[at], scores.column("best").to_numpy()[at]
    cells, times = p.planes[0], p.times()
    low, which = np.unique(cells & 0xFFFF, return_inverse=True)
    count_sum, n_best = np.zeros(len(low), np.int64), np.zeros(len(low), np.int64)
    np.add.at(count_sum, which, links[cells >> 16] * times)
    np.add.at(n_best, which, best[cells >> 16] * times)
    container = index.column("container")[0].as_py()
    return pa.table([container << 16 | low, n_best, count_sum], schema=_SCORED)


@dataclass(frozen=True)
class Alignment:
    """Stored results: ``documents``, and ``pairs`` (a, b, docs, links, best) of linked ids."""

    documents: DataFrame
    pairs: DataFrame


def align(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> Alignment:
    """Links between the tokens of a byte-level BPE (A) and a sentencepiece model (B) over all texts.

    A reads a space and the text, B the text, to which it adds the space. Where tokens of both
    end at the same byte they are linked, and what lies between two such ends is a group.

    ``documents`` has per row of ``df``: the id, ``n_a`` and ``n_b`` tokens, ``n_groups``,
    ``n_links``, ``n_best``: its links whose pair no other pair of the same B id outnumbers in the
    corpus, ``count_sum``: the corpus' links of its pairs, added over its links, and
    ``groups_sha256`` over the groups' ids (`a1,a2|b1;a3|b2,b3`). ``pairs`` has per linked pair of
    ids the documents and links that hold it, and whether it is such a ``best`` one.

    A null or empty text, and one that either tokenizer doesn't spell byte by byte (the space mark
    of B as a character does that), has no tokens: zeros and an empty ``groups_sha256``. Rows are
    numbered as they stand, so repeated rows and null ids are documents of their own; texts of any
    length are taken whole, and one of more than ``CONTAINER_LINKS`` links fills a container by
    itself. An empty table gives empty results. Other columns of ``df`` are not read. The files
    are read where the tasks run, as the tokenizers' libraries do.
    """
    spark_id = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    columns = ", ".join(f"{c} long" for c in _NUMBERS)
    packed = "container long, bucket int, blob binary"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        one = next(batches, None)
        if one is None:
            return
        run = _encode(path_a, path_b, one.schema.field(0).type)
        yield from run(b for part in ([one], batches) for b in part)

    coded = cut(rows.mapInArrow(encode, f"id {spark_id}, doc long, {columns}, groups string, {packed}"))
    index = coded.filter("blob is not null").select(*_PACKED.names)
    index = cut(index.groupBy(*_KEYS).applyInArrow(_merge, packed))
    held = cut(index.mapInArrow(_counted, "container long, bucket int, pair long, docs long, links long"))
    a, b = F.shiftright("pair", 32), F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    pairs = held.groupBy("pair").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links"))
    pairs = cut(pairs.select("pair", a.alias("a"), b.alias("b"), "docs", "links"))
    most = pairs.groupBy("b").agg(F.max("links").alias("most"))
    pairs = pairs.join(most, "b").withColumn("best", F.col("links") == F.col("most")).drop("most")
    scores = held.select(*_KEYS, "pair").join(pairs.select("pair", "links", F.col("best").cast("long").alias("best")), "pair")
    added = (
        index.groupBy(*_KEYS)
        .cogroup(scores.groupBy(*_KEYS))
        .applyInArrow(_scored, "doc long, n_best long, count_sum long")
        .groupBy("doc")
        .agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    )
    documents = coded.filter("blob is null").select(F.col("id").alias(id_col), "doc", *_NUMBERS, F.col("groups").alias("groups_sha256"))
    documents = documents.join(added, "doc", "left").fillna(0, ["n_best", "count_sum"])
    documents = documents.select(id_col, *_NUMBERS, "n_best", "count_sum", "groups_sha256")
    return Alignment(documents, pairs.select("a", "b", "docs", "links", "best"))
