"""Personal data: fixed patterns against plain regexes, the label model on planted votes, added spans."""

import hashlib
import random
import re

import numpy as np
import pytest

from hirelens.llm import private, queries

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    """The base spans by the patterns as written."""
    out = []
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                doubled = [d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits))]
                if not 14 <= len(digits) <= 19 or sum(doubled) % 10:
                    continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), order, m.end()))
    return sorted(out)


def with_luhn(digits):
    return next(digits + str(c) for c in range(10) if private.luhn(digits + str(c)))


ODD = [
    "", None, "@", "a@b", "a@b.c", "a@b.c@d.e.f", "a@@b.c", "x.y+z%@-a-.b..c", "é@b.c ñ.a@b.c", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.256",
    "0001.02.3.0255 00000000000000000300.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1111-", "4111  1111", "+1 (555) 123-4567.", "++49 30 1234567",
    "+1-", "+12", "+1 ()()()", "1", "12 34", "4111111111111111 4111111111111111", "日本+81 3-1234-5678 語", "a@b.c," * 50, "5" * 400, "a" * 3000 + "@",
    "a." * 2000 + "@b", "+1" + " " * 5000, "1." * 4000, "1-" * 3000, "a@b" + ".c" * 2000, "٣.٣.٣.٣ ٣@b.c",
]


def test_base_spans_equal_the_patterns():
    rng = random.Random(2)
    for text in ODD + ["".join(rng.choice("0123456789+.-@ (ab%é\n,") for _ in range(rng.randint(1, 120))) for _ in range(4000)]:
        assert private.base_spans(text or "") == plain(text), text


def test_long_texts_take_linear_time():
    for unit in ("a", "a.", "1", "1.", "1 ", "+1 ", "a@", "a@b.c ", "4111111111111111 ", "(at) "):
        text = unit * (600_000 // len(unit))
        base = private.base_spans(text)
        private.choose([(a, k, b, 0.9) for a, k, b, *_ in private.candidates(text, base)], base)


def documents():
    rng = random.Random(8)
    words = "the report was sent to our team and they will answer soon with more".split()

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    rows, planted, clean = [], set(), set()
    for i in range(600):
        number = f"{rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
        card = with_luhn("4" + "".join(rng.choice("0123456789") for _ in range(14)))
        wrong = card[:-1] + str((int(card[-1]) + rng.randint(1, 9)) % 10)
        kind = i % 6
        inside = [
            f"call me: ({number}, {prose(2)}", f"phone ({number}; thanks", f"card {card} {card}, {prose(1)}", f"order {wrong} of",
            f"mail joe.miller{i}@mail{i % 9}.example.com", "on 2024-05-17 version",
        ][kind]
        rows.append((i, f"{prose(6)} {inside} {prose(4)}"))
        (planted if kind in (0, 1, 2) else clean).add(i)
    return rows, planted, clean


def test_planted_spans_are_added_and_decoys_left(docs_of):
    rows, planted, clean = documents()
    rows += [rows[0], rows[0], (None, rows[1][1]), (9000, None), (9001, "")]
    got = private.find_private(docs_of(rows).repartition(4)).collect()
    assert len(got) == len(rows)
    texts = {i: t for i, t in rows}
    more = {}
    for r in got:
        base, spans = (set(filter(None, r[c].split(","))) for c in ("base", "spans"))
        assert base <= spans and r["base"] == private.written(plain(texts[r["doc_id"]]))
        assert [r[f"n_{k}"] for k in private.KINDS] == [sum(b.startswith(k) for b in base) for k in private.KINDS]
        more[r["doc_id"]] = spans - base
        places = sorted(tuple(map(int, s.split(":")[1:])) for s in spans)
        assert all(x[1] <= y[0] for x, y in zip(places, places[1:]))
    assert sum(bool(more[i]) for i in planted) >= 0.95 * len(planted)
    assert sum(bool(more[i]) for i in clean) == 0
    assert all(len(more[i]) == 2 for i in planted if i % 6 == 2)  # two cards that the fixed pattern joins and drops


def test_reliabilities_are_found_from_votes_alone():
    rng = np.random.default_rng(4)
    n, truth = 40_000, None
    truth = rng.random(n) < 0.3
    right = np.array([0.9, 0.999, 0.8, 0.7, 0.6, 0.75])
    abstains = np.array([0.1, 0.0, 0.2, 0.5, 0.4, 0.1])
    votes = np.where(rng.random((n, 6)) < right, np.where(truth, 2, 1)[:, None], np.where(truth, 1, 2)[:, None])
    votes[rng.random((n, 6)) < abstains] = 0
    codes, counts = np.unique(votes @ 3 ** np.arange(5, -1, -1), return_counts=True)
    model = private.fit_reliability(codes, counts.astype(float))
    assert model.share == pytest.approx(0.3, abs=0.02)
    for j in (0, 2, 3, 4, 5):
        want = right[j] * (1 - abstains[j])
        assert model.chances[1, j, private.YES] == pytest.approx(want, abs=0.03)
        assert model.chances[0, j, private.NO] == pytest.approx(want, abs=0.03)
    assert ((model.posterior(votes @ 3 ** np.arange(5, -1, -1)) > 0.5) == truth).mean() > 0.97


def test_newton_steps_reach_the_minimum():
    rng = np.random.default_rng(0)
    x = np.concatenate([np.ones((50, 1)), rng.integers(0, 2, (50, 4))], axis=1).astype(float)
    y, counts = rng.random(50), rng.integers(1, 9, 50).astype(float)
    w = private.fit_logistic(x, y, counts)

    def loss(w):
        z = x @ w
        return (counts * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * (w[1:] ** 2).sum() + 0.5e-3 * w[0] ** 2

    best = loss(w)
    assert all(loss(w + d) >= best for d in np.concatenate([np.eye(5), -np.eye(5)]) * 1e-3)


def test_empty_tables_and_texts_without_candidates(spark, empty_docs, docs_of):
    assert private.find_private(empty_docs).collect() == []
    got = private.find_private(docs_of([(1, "nothing here"), (2, None)])).collect()
    assert [r["spans"] for r in got] == ["", ""]


def test_the_query_derives_its_digests(spark, tmp_path, docs_of):
    docs_of(documents()[0]).write.parquet(f"{tmp_path}/documents.parquet")
    for r, (i, text) in zip(queries.op11_personal_data(spark, str(tmp_path)).orderBy("doc_id").collect(), documents()[0]):
        assert r["base_sha256"] == hashlib.sha256(private.written(plain(text)).encode()).hexdigest()
