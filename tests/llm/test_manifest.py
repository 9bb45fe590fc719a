"""The Merkle manifest against a plain recursion."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from hirelens.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, path string, grp int, digest int"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, text):
    doc_id, _, lang, source, n_chars = row
    return H(*map(enc, (doc_id, source, lang, n_chars, text)))


def climb(level):
    """The last digest, and per node its siblings (left, right) upwards."""
    if len(level) == 1:
        return level[0], [[]]
    above, higher = climb([H(*level[i : i + 3]) for i in range(0, len(level), 3)])
    paths = []
    for i in range(len(level)):
        first = i // 3 * 3
        beside = ("".join(level[first:i]), "".join(level[i + 1 : first + 3]))
        paths.append([beside, *higher[i // 3]])
    return above, paths


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append(row)
    keys = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = {}
    for k in keys:
        groups[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[1])))
        trees[k] = climb([leaf_of(r, r[1]) for r in groups[k]])
    root, upper = climb([trees[k][0] for k in keys]) if keys else (None, [])
    out = []
    for k, rest in zip(keys, upper):
        for row, path in zip(groups[k], trees[k][1]):
            text, doc_id = row[1], row[0]
            if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = leaf_of(row, text)
            for left, right in path + rest:
                node = H(left, node, right)
            proof = H(*[x for pair in path + rest for x in pair])
            out.append((doc_id, leaf_of(row, row[1]), trees[k][0], root, proof, node, node == root))
    return out


def rows_of(n, sources):
    texts = ["", None, "one line", "two\nlines", "é\n日本\n", "x" * 5000 + "\n"]
    return [(i, texts[i % 6], [None, "en", ""][i % 3], sources[i % len(sources)], [None, i][i % 2]) for i in range(n)]


CASES = {
    "one": rows_of(1, ["a"]),
    "sources": rows_of(60, ["a", None, "", "é", "b", "Z", "10", "9"]),
    "hot": rows_of(200, ["hot"]) + [(1000 + i, "t\n", "en", f"s{i}", 1) for i in range(40)],
    "repeats": rows_of(30, ["a", None]) * 3 + [(None, "t\n", None, None, None)] * 4 + [(5, "another\n", "en", "a", 1)],
}


def answer(spark, rows):
    docs = spark.createDataFrame([(*r, "leaf", "path", 1, 2) for r in rows], SCHEMA).repartition(5)
    return [tuple(r) for r in merkle.document_proofs(docs).collect()]


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("levels", [1, 2, 6])
def test_proofs_equal_the_recursion(spark, monkeypatch, case, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 3**levels)
    got = answer(spark, CASES[case])
    assert sorted(map(str, got)) == sorted(map(str, brute(CASES[case])))


def test_an_empty_table_has_no_rows(spark, empty_docs):
    assert merkle.document_proofs(empty_docs).collect() == []


def test_versions_share_all_but_the_ancestors(spark):
    rows = rows_of(100, ["a", "b"])
    docs = spark.createDataFrame([(*r, "", "", 0, 0) for r in rows], SCHEMA)
    changed = merkle.merkle_manifest(docs, {"text": F.lit("other")}, F.col("doc_id") < 10)
    nodes = {r["doc_id"]: r for r in changed.collect()}
    plain = {r["doc_id"]: r for r in merkle.merkle_manifest(docs).collect()}
    for i, r in nodes.items():
        assert r["copies"][0] == r["leaf"] or i < 10
        assert len(r["copies"]) == len(r["path"]) + 1 == 6  # 50 leaves, then two subroots
        assert r["path"] == plain[i]["path"] and r["root"] == plain[i]["root"]
        assert (r["copies"][-1] == r["root"]) == (i >= 10)
    assert len({r["copies"][-1] for r in nodes.values()}) == 11  # a root per version, and the original's


def test_no_task_orders_a_whole_source(spark):
    """Leaves of one source lie in many partitions and are still numbered without a gap."""
    nodes = spark.range(5000).selectExpr("'s' as grp", "id", "cast(id as string) as digest").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = merkle.numbered(nodes, ["id"])
        assert placed.filter("pos <> id or n <> 5000").count() == 0 and placed.count() == 5000
        assert "SinglePartition" not in placed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
