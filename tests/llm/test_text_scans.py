"""Lines, leaks and licences against plain Python."""

import random
from collections import defaultdict

import numpy as np
import pytest

from hirelens.llm import decontaminate, licenses, lines


def plain_lines(rows, min_chars=40, min_docs=5):
    def key(line):
        return line.strip(" \t\n\x0b\f\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))

    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                held[key(line)].add(i)
    out = []
    for i, t in rows:
        parts = (t or "").split("\n")
        left = [x for x in parts if i is None or len(held[key(x)]) < min_docs or max(held[key(x)]) == i]
        out.append((i, len(parts), len(parts) - len(left), "\n".join(left)))
    return sorted(out, key=str)


@pytest.mark.parametrize("batches,fanout", [(1, 2), (6, 4), (9, 2)])
def test_line_dedup(docs_of, empty_docs, batches, fanout):
    rng = random.Random(batches)
    common = [f"line number {i} of the boilerplate Éclair that many hold" for i in range(6)]
    rows = []
    for i in range(60):
        own = [rng.choice(common + ["short", "", f"a line of its own {i} {'x' * 30}"]) for _ in range(rng.randint(0, 9))]
        rows.append((i * 7, "\n".join(f" \t{x.upper() if rng.random() < 0.2 and x.isascii() else x}\r" for x in own)))
    rows += [rows[4], (21, "another text of document 21\n" + common[0]), (None, common[1]), (1000, None), (1001, "")]
    rows += [(2000, "\n".join(common * 3000))]
    got = lines.dedup_lines(docs_of(rows), batches=batches, fanout=fanout)
    assert set(docs_of(rows).columns) - {"n_lines"} <= set(got.columns)
    assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in got.collect()), key=str) == plain_lines(rows)
    assert lines.dedup_lines(empty_docs).count() == 0


def test_runs_are_compacted(spark):
    runs = lines.LineRuns(spark, fanout=2)
    for b in range(5, 0, -1):
        runs.add(spark.createDataFrame([(h, h, b * 10 + h % 3) for h in range(b + 3)], "h1 long, h2 long, id long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    found = {r["h1"]: (r["n_docs"], r["keeper"]) for r in runs.totals().collect()}
    assert found[0] == (5, 50) and found[7] == (1, 51) and found[4] == (4, 51)


def test_leaks(spark, docs_of, empty_docs):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    items = [(k, " ".join(word() for _ in range(rng.randint(8, 60)))) for k in range(30)] + [(90, None), (91, ""), (92, "!!"), (3, "same id, other text")]
    rows, want = [], set()
    for d in range(120):
        k = rng.randrange(30)
        part = items[k][1].split()
        if d % 4 < 3:
            for _ in range(decontaminate.edits(len(part), decontaminate.SIMILARITY) if d % 4 else 0):
                p = rng.randrange(len(part))
                part = [part[:p] + [word()] + part[p + 1 :], part[:p] + [word()] + part[p:], part[:p] + part[p + 1 :]][rng.randrange(3)]
            want.add((d, k))
        else:
            part = part[: len(part) // 2]
        rows.append((d, " ".join([word() for _ in range(40)] + [x.upper() for x in part] + [word() for _ in range(20)])))
    rows += [(500, None), (501, ""), (None, items[0][1]), (502, "\n".join([items[5][1]] * 500)), (0, rows[0][1])]
    want |= {(None, 0), (502, 5)}
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_leaks(docs_of(rows), frame).collect()
    found = {(r["doc_id"], r["item_id"]) for r in got}
    assert found <= want and len(found & want) >= 0.97 * len(want)
    blocks = decontaminate.find_leaks(docs_of(rows), frame, block_words=100).collect()
    assert sorted(map(str, blocks)) == sorted(map(str, got))
    assert decontaminate.find_leaks(empty_docs, frame).count() == 0
    assert decontaminate.find_leaks(docs_of(rows), frame.limit(0)).count() == 0


def test_edit_distance_is_that_of_the_closest_part():
    a = np.array([1, 2, 3, 4], np.uint64)
    for passage, want in (([9, 1, 2, 3, 4, 9], 0), ([1, 2, 9, 4], 1), ([1, 2, 4], 1), ([1, 7, 2, 3, 4], 1), ([], 4), ([8, 8], 4)):
        assert decontaminate.edit_distance(a, np.array(passage, np.uint64)) == want


def test_leaks_of_long_items_equal_brute_force(spark, docs_of):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    sizes = [60, 118, 200, 300, 400, 600, 800, 1000]
    items = [(k, " ".join(word() for _ in range(m))) for k, m in enumerate(sizes)]
    rows = []
    for d in range(80):
        k = d % len(sizes)
        part, e = items[k][1].split(), decontaminate.edits(sizes[k], decontaminate.SIMILARITY)
        kind, reach = d // len(sizes), len(part)
        if kind == 7:  # all edits in one part
            reach = 2 * e
        if kind == 8:  # half an item
            part, e, reach = part[: len(part) // 2], 0, 1
        if kind == 9:  # far beyond the limit
            e = 2 * e
        if kind in (0, 1, 2, 7):  # as many edits as the limit allows
            for p in rng.sample(range(reach), e):
                part[p] = word()
        else:
            for _ in range(e):
                p = rng.randrange(min(reach, len(part)))
                part = [part[:p] + [word()] + part[p + 1 :], part[:p] + [word()] + part[p:], part[:p] + part[p + 1 :]][rng.randrange(3)]
        rows.append((d, " ".join([word() for _ in range(rng.choice([0, 50]))] + part + [word() for _ in range(rng.choice([0, 30]))])))
    rows.append((100, " ".join([items[3][1]] * 3 + [word() for _ in range(9)] + [items[5][1]])))
    code = defaultdict(lambda: len(code) + 1)
    coded = lambda t: np.array([code[w] for w in t.split()], np.uint64)
    whole, texts, want = dict(items), dict(rows), {}
    for d, text in rows:
        for k, item in items:
            distance = decontaminate.edit_distance(coded(item), coded(text))
            if distance <= decontaminate.edits(sizes[k], decontaminate.SIMILARITY):
                want[d, k] = distance
    assert len(want) >= 64 and {(100, 3), (100, 5)} <= set(want)
    got = decontaminate.find_leaks(docs_of(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]): r["edits"] for r in got}.items() <= want.items()
    assert len(got) >= decontaminate.RECALL * len(want)
    for r in got:
        m = sizes[r["item_id"]]
        assert r["similarity"] == pytest.approx(1 - r["edits"] / m)
        assert decontaminate.edit_distance(coded(whole[r["item_id"]]), coded(texts[r["doc_id"]])[r["place"] :]) == r["edits"]


def test_closest_part_and_plan():
    rng = random.Random(4)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randint(lo, 9))] for lo in (1, 0))
        edits, start = decontaminate.closest_part(np.array(a, np.uint64), np.array(b, np.uint64))
        assert edits == decontaminate.edit_distance(np.array(a, np.uint64), np.array(b, np.uint64))
        assert decontaminate.closest_part(np.array(a, np.uint64), np.array(b[start:], np.uint64)) == (edits, 0)
        assert decontaminate.may_be_near(np.array(a, np.uint64), np.array(b, np.uint64), edits)
    assert not decontaminate.may_be_near(np.array([1, 1, 2], np.uint64), np.array([1, 2, 3], np.uint64), 0)
    walks, _ = decontaminate.plan(decontaminate.SIMILARITY)
    assert decontaminate.plan(0.7)[0] > walks  # a wider limit takes more tables


def plain_licence(text, threshold=licenses.THRESHOLD):
    """Every segment against every template, without bounds."""
    import re

    def grams(t):
        w = re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", t.lower())
        return {(w[0],)} if len(w) == 1 else set(zip(w, w[1:]))

    best = {}
    for part in [text, *text.split("\n"), *re.split(r"(?<=[.!?;:])(?=[ \t\r\n])|\n", text)]:
        g = grams(part)
        closest = (0.0, "")
        for name in sorted(licenses.TEMPLATES):
            for n in licenses.TEMPLATES[name]:
                h = grams(n)
                d = 2 * len(g & h) / (len(g) + len(h)) if g else 0
                closest = max(closest, (d, name), key=lambda x: x[0])
        if closest[0] >= threshold:
            best[closest[1]] = max(best.get(closest[1], 0), closest[0])
    return best


def test_licences(docs_of, empty_docs):
    rows = [
        (1, None), (2, ""), (3, "nothing of the kind here"), (4, "first line\nReleased under the MIT License.\nlast"),
        (5, "LICENSED   under the apache License, version 2.0!"), (6, "Text before. This work is licensed under the GNU General Public License, version 3. Text behind."),
        (7, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY 4.0."), (8, "license licensed under the"), (9, "filler words " * 60_000 + "\nReleased under the MIT License."),
        (4, "first line\nReleased under the MIT License.\nlast"), (None, "Released under the MIT License."), (10, "MIT"),
    ]
    got = licenses.scan_licenses(docs_of(rows)).collect()
    assert len(got) == len(rows)
    for (i, t), r in zip(sorted(rows, key=str), sorted(got, key=lambda r: str((r["doc_id"], dict(rows).get(r["doc_id"]))))):
        want = plain_licence(t or "")
        assert r["licenses"] == sorted(want), (i, r)
        if want:
            assert r["dice"] == pytest.approx(max(want.values())) and want[r["license"]] == max(want.values())
        else:
            assert (r["license"], r["dice"], r["n_notices"]) == (None, None, 0)
    assert licenses.scan_licenses(empty_docs).count() == 0


def test_wrapped_licences_inside_documents(docs_of):
    import textwrap

    rng = random.Random(3)
    filler = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) + rng.choice(["", "", ".", "\n"]) for _ in range(n))
    mit, clause = licenses.TEMPLATES["MIT"][-1], licenses.TEMPLATES["BSD-3-Clause"][0]
    inside = [(n, t) for n, many in licenses.TEMPLATES.items() for t in many if "\n" in t]
    assert {"MIT", "Apache-2.0", "GPL-2.0", "GPL-3.0", "MPL-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "CC-BY-4.0"} <= {n for n, _ in inside}
    inside += [("MIT", "\n".join(" ".join(x.split()) for x in mit.split("\n\n"))), ("BSD-3-Clause", clause), ("GPL-3.0", licenses.TEMPLATES["GPL-3.0"][1])]
    rows, want = [], {}
    for k, (name, text) in enumerate(inside):
        part = text if k >= len(inside) - 3 and name == "MIT" else textwrap.fill(" ".join(text.split()), rng.choice([60, 72, 80]))
        words = part.split(" ")
        for _ in range(len(words) // 40):  # a few words differ
            words[rng.randrange(len(words))] = "other"
        part = "\n".join("# " + x for x in " ".join(words).split("\n"))
        rows.append((k, f"{filler(150)}\n{part}\n{filler(rng.choice([0, 90]))}"))
        want[k] = ([name], 1)
    full = {n: max(many, key=len) for n, many in licenses.TEMPLATES.items()}
    rows += [(100, "\n".join([textwrap.fill(mit, 50), filler(20), full["BSD-2-Clause"], textwrap.fill(mit, 70), "Released under the MIT License."]))]
    rows += [(101, "\n".join(full["GPL-2.0"].split("\n")[60:130])), (102, "Licensed under the\nApache License, Version 1.1.")]
    want |= {100: (["BSD-2-Clause", "MIT"], 4), 101: ([], 0), 102: ([], 0)}
    got = {r["doc_id"]: (r["licenses"], r["n_notices"]) for r in licenses.scan_licenses(docs_of(rows)).collect()}
    assert got == want


@pytest.mark.parametrize("long", [60, 4])
def test_licence_windows_equal_all_windows(monkeypatch, long):
    from hirelens.llm.common import Texts

    import pyarrow as pa

    monkeypatch.setattr(licenses, "LONG", long)
    monkeypatch.setattr(licenses, "MAX_CELLS", 200)
    rng, grams = random.Random(long), lambda w: set(zip(w, w[1:]))
    hits = 0
    for _ in range(150):
        word = lambda: rng.choice("abcdefghijklmnop")
        t = [word() for _ in range(rng.randint(4, 14))]
        part = [word() if rng.random() < 0.08 else x for x in t]
        doc = [word() for _ in range(rng.randint(0, 12))] + part + [word() for _ in range(rng.randint(0, 12))]
        notices, h = licenses.Notices({"x": (" ".join(t),)}, 0.8), grams(t)
        least = len(t) if len(h) < long else 2
        most = int((len(t) - 1) * 1.5 + 1e-9) + 1
        spans = [(0, len(doc))] + [(a, b) for a in range(len(doc)) for b in range(a + least, min(a + most, len(doc)) + 1)]
        best = max(2 * len(h & grams(doc[a:b])) / (len(h) + len(grams(doc[a:b]))) for a, b in spans)
        found = list(licenses._places(Texts(pa.array(["\t".join(doc)])), notices))[0]
        assert (max(found)[0] if found else 0) == pytest.approx(best if best >= 0.8 else 0)
        hits += best >= 0.8
    assert 40 < hits < 150
