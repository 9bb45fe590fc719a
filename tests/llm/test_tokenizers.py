"""Token counts against the library; pieces against brute force and round trips."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from hirelens.llm import pieces, queries, token_counts

PATH = queries.tokenizer()
ODD = [
    "", " ", "  a  b", "héllo ▁wörld", "日本語 🙂🙂", "a\tb\nc\r\n", "x" * 700, "   ", "<s> </s> <unk> <0x0A>", "\u0000a", "▁▁▁▁a",
    " " * 70 + "q", "é" * 100, "1234567890" * 20,
]


def texts(n=400):
    rng = random.Random(5)
    made = ["".join(rng.choice("abcdehilnorst ▁  \n.,éß日🙂!") for _ in range(rng.randint(1, 60))) for _ in range(n)]
    return ODD + made + ["word " * 30_000, None]


def test_counts_equal_the_library(docs_of):
    rows = list(enumerate(texts()))
    rows += [rows[3], (None, "null id")]
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    got = token_counts.token_counts(docs_of(rows), PATH).collect()
    want = sorted((str(i), len((t or "").encode()), len(sp.encode(t or ""))) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in got) == want


def test_few_states_give_the_same_counts():
    table = token_counts.load_pieces(PATH)[0]
    wide, narrow = token_counts.Transducer(table), token_counts.Transducer(table, max_states=20)
    for t in texts(100)[:-2]:
        chunk = ("▁" + t.replace(" ", "▁")).rstrip("▁")
        assert wide.count(chunk) == narrow.count(chunk)
    assert len(narrow.states) == 20


def brute(text, table, by_byte):
    """The best segmentation over all character positions, equal scores to the first start."""
    scores = {p: s for p, (_, s) in table.items()}
    unknown = min(scores.values()) - pieces.UNKNOWN_PENALTY
    text = "▁" + text.replace(" ", "▁")
    best = [(0.0, [])] + [(-np.inf, [])] * len(text)
    for start in range(len(text)):
        for end in range(start + 1, min(len(text), start + 48) + 1):
            piece = text[start:end]
            if piece in scores and best[start][0] + scores[piece] > best[end][0]:
                best[end] = best[start][0] + scores[piece], best[start][1] + [table[piece][0]]
        if text[start] not in scores and best[start][0] + unknown > best[start + 1][0]:
            best[start + 1] = best[start][0] + unknown, best[start][1] + [by_byte[b] for b in text[start].encode()]
    return best[-1][1]


def test_pieces_equal_brute_force_and_decode_back(spark, docs_of):
    table, by_byte = token_counts.load_pieces(PATH)
    rows = list(enumerate(texts(150)[:-2]))
    coded = pieces.encode(docs_of(rows), PATH)
    assert {"doc_id", "text", "score", "piece_ids"} <= set(coded.columns)
    both = pieces.decode(coded, PATH).collect()
    assert len(both) == len(rows)
    for r in both:
        assert list(r["piece_ids"]) == (brute(r["text"], table, by_byte) if r["text"] else []), r["text"]
        assert r["decoded"] == r["text"].replace("▁", " ")


def test_digests(docs_of, empty_docs):
    rows = [(1, "a b"), (2, None), (3, ""), (1, "a b"), (None, "▁ x"), (5, "long " * 40_000)]
    got = {(r["doc_id"], r["n_pieces"], r["round_trip"]) for r in pieces.encoding_digests(docs_of(rows), PATH).collect()}
    assert {(2, 0, True), (3, 0, True)} <= got and any(i is None and not same for i, _, same in got)
    out = pieces.encoding_digests(docs_of(rows), PATH)
    assert out.count() == len(rows)
    assert out.filter("doc_id = 2").first()["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
    for empty in (pieces.encoding_digests(empty_docs, PATH), token_counts.token_counts(empty_docs, PATH), pieces.encode(empty_docs, PATH)):
        assert empty.count() == 0


def test_byte_pieces_that_are_no_text(spark):
    _, by_byte = token_counts.load_pieces(PATH)
    rows = spark.createDataFrame([([by_byte[0x20], by_byte[0xFF]],), (None,)], "piece_ids array<int>")
    assert {r["decoded"] for r in pieces.decode(rows, PATH).collect()} == {"�", ""}


@pytest.mark.parametrize("name", ["byte_bpe_50k.json"])
def test_other_files_are_refused(name):
    with pytest.raises(Exception):
        token_counts.load_pieces(queries.tokenizer(name))
