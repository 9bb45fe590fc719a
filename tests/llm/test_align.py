"""Token alignment against whole-text encodings, sets and counters."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from hirelens.llm import align, queries

A, B = queries.tokenizer(queries.BYTE_LEVEL), queries.tokenizer()
ODD = [
    "", None, " ", "  ", "a ", " a", "  a  b ", "a\n b\n  c", "a  b", "a　 b  c", "x\u0085 y", "▁", "a▁ b", "ok ▁ok",
    "日本語 🙂🙂 é", "<|endoftext|> <s> </s> <unk> <0x0A>", "\u0000a", "can't we'll 123 45,6", "\t\ttab", "ab" * 300,
    "\x1c x \x7f y", "don't  stop", "a b a b a b a b", "1 1 1 1 1",
]


def spelled(text):
    """Both id lists and their bytes for a text, by the libraries on the whole text."""
    hf = Tokenizer.from_file(A)
    hf.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in printed}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printed)}

    def run(text):
        ids_a = hf.encode(" " + text, add_special_tokens=False).ids
        ids_b = sp.encode(text)
        bytes_a = [bytes(byte_of[c] for c in hf.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in ((i, sp.id_to_piece(i)) for i in ids_b)]
        return ids_a, ids_b, bytes_a, bytes_b

    return [run(t) if t else None for t in text]


def brute(rows):
    texts = [t for _, t in rows]
    counts, found = Counter(), []
    for t, coded in zip(texts, spelled(texts)):
        groups, links, n_a, n_b = [], [], 0, 0
        if coded:
            ids_a, ids_b, bytes_a, bytes_b = coded
            want = (" " + t).encode()
            if b"".join(bytes_a) == want == b"".join(bytes_b):
                n_a, n_b = len(ids_a), len(ids_b)
                ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
                last = 0
                for end in sorted(set(ends_a) & set(ends_b)):
                    inside = lambda ids, ends: [i for i, e in zip(ids, ends) if last < e <= end]
                    groups.append((inside(ids_a, ends_a), inside(ids_b, ends_b)))
                    last = end
                links = [(x, y) for x, e in zip(ids_a, ends_a) for y, f in zip(ids_b, ends_b) if e == f]
        counts.update(links)
        found.append((n_a, n_b, groups, links))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    out = []
    for (i, _), (n_a, n_b, groups, links) in zip(rows, found):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, n_a, n_b, len(groups), len(links), sum(counts[p] == best[p[1]] for p in links),
                    sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if n_a else ""))
    return out, counts, found


def some_rows(n=250):
    rng = random.Random(3)
    made = ["".join(rng.choice("abcdehilnorst  \n.,'é日🙂!0 ") for _ in range(rng.randint(1, 80))) for _ in range(n)]
    rows = list(enumerate(ODD + made + ["the cat sat on the mat"] * 40))
    return rows + [rows[30], (None, "the null id")]


@pytest.mark.parametrize("links, container", [(1_000_000, 4_000_000), (50, 4_000_000), (50, 120)])
def test_documents_equal_brute_force(docs_of, monkeypatch, links, container):
    stored, cut = [], align.cut
    monkeypatch.setattr(align, "FLUSH_LINKS", links)
    monkeypatch.setattr(align, "CONTAINER_LINKS", container)
    monkeypatch.setattr(align, "SLICE", 3 * links)
    monkeypatch.setattr(align, "cut", lambda df: stored.append(cut(df)) or stored[-1])
    rows = some_rows()
    want, counts, found = brute(rows)
    got = align.align(docs_of(rows).repartition(3), A, B)
    assert sorted(map(str, map(tuple, got.documents.collect()))) == sorted(map(str, want))
    docs = Counter(p for *_, links in found for p in set(links))
    pairs = {(r["a"], r["b"]): (r["docs"], r["links"]) for r in got.pairs.collect()}
    assert pairs == {p: (docs[p], n) for p, n in counts.items()}
    parts, whole = (x.filter("blob is not null") for x in stored[:2])
    assert (parts.count() > whole.count()) == (links == 50)
    assert (whole.select("container").distinct().count() > 3) == (container == 120)


def test_a_small_memo_gives_the_same(monkeypatch):
    rows = [t or "" for _, t in some_rows(100)]
    texts = align.Texts(pa.array(rows))
    coders = align.ByteLevel(A), align.Pieces(B)
    whole = align._aligned_texts(align.Aligned(*coders), texts)
    monkeypatch.setattr(align, "MEMO_CHUNKS", 60)
    memo = align.Aligned(*coders)
    parts = [align._aligned_texts(memo, align.Texts(pa.array([t]))) for t in rows]
    assert sum((p.groups for p in parts), []) == whole.groups
    assert np.concatenate([p.numbers for p in parts]).tolist() == whole.numbers.tolist()
    assert np.concatenate([p.pairs for p in parts]).tolist() == whole.pairs.tolist()


def test_an_empty_table(empty_docs):
    got = align.align(empty_docs, A, B)
    assert got.documents.collect() == [] and got.pairs.collect() == []


def test_bitmaps_pack_merge_and_count():
    rng = np.random.default_rng(1)
    pairs = np.concatenate([np.full(30_000, 7 << 32 | 3), rng.integers(0, 50, 20_000) << 32, [5]])
    docs = np.concatenate([rng.integers(0, 9000, 30_000), rng.integers(0, 65_536, 20_000), [65_535]])
    order = rng.permutation(len(pairs))
    pairs, docs = pairs[order], docs[order]
    half = docs < 5000  # a document lies in one part
    parts = [align.Postings.of(pairs[m], docs[m]) for m in (half, ~half)]
    whole = align.Postings.merged([align.Postings.unpack(p.pack()) for p in parts])
    cells = Counter(zip(pairs.tolist(), docs.tolist()))
    assert whole.pairs.tolist() == sorted(set(pairs.tolist()))
    spot = [(int(whole.pairs[c >> 16]), int(c & 0xFFFF)) for c in whole.planes[0]]
    assert dict(zip(spot, whole.times().tolist())) == cells
    assert dict(zip(whole.pairs.tolist(), whole.links().tolist())) == Counter(pairs.tolist())
    assert dict(zip(whole.pairs.tolist(), whole.set_bits()[0].tolist())) == Counter(p for p, _ in cells)
    lists = align.Postings.of(pairs, np.zeros_like(docs))
    assert len(lists.planes) > 10 and lists.links().sum() == len(pairs)
    again = align.Postings.unpack(whole.pack())
    assert all((x == y).all() for x, y in zip(again.planes, whole.planes))
