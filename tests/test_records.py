"""Splittable CSV with line breaks inside quotes, against Spark's one-task reader."""

import csv
import random

import pytest

from hirelens.schemas import CONTRACT
from hirelens.sources.contract import read_contract_csv
from hirelens.sources.records import csv_records, read_multi_line_csv

SCHEMA = CONTRACT["interviews"]
OPTIONS = {"dateFormat": "yyyy-MM-dd", "escape": '"'}
TEXTS = [
    "plain", "", "two\nlines", 'q "x" y', '"', '""\n"', "a,b\n\nc\n", " lead ", "\n", "é日" * 20, "l\n" * 200,
    ",".join(SCHEMA.names), '","\n","', "back\\slash",
]


def write(path, rows, end="\n"):
    with open(path, "w", newline="") as f:
        out = csv.writer(f, lineterminator=end)
        out.writerow(SCHEMA.names)
        out.writerows(rows)


def rows_of(n, tag="I"):
    rng = random.Random(n)
    return [(f"{tag}{i}", f"A{i}", 1, "V1", "2024-01-09", "true", 1, rng.choice(TEXTS)) for i in range(n)]


@pytest.fixture
def split_bytes(spark):
    """Sets the size of the splits that files are cut into."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def cut(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "0")

    yield cut
    for n, value in before.items():
        spark.conf.set(n, value)


def one_task(spark, path):
    df = spark.read.schema(SCHEMA).csv(path, header=True, enforceSchema=True, mode="FAILFAST", multiLine=True, **OPTIONS)
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("size", [1 << 30, 5000, 300])
def test_any_split_gives_the_rows_of_the_one_task_reader(spark, tmp_path, split_bytes, size):
    folder = tmp_path / "interviews.csv"
    folder.mkdir()
    write(folder / "a.csv", rows_of(700, "a"))
    write(folder / "b.csv", rows_of(300, "b"), "\r\n")
    write(folder / "c.csv", [])
    want = one_task(spark, str(folder))
    split_bytes(size)
    got = read_contract_csv(spark, str(tmp_path), "interviews")
    assert got.schema == SCHEMA and sorted(map(str, got.collect())) == want and len(want) == 1000
    parts = spark.read.text(str(folder), lineSep="\n").rdd.getNumPartitions()
    assert parts > 3


def test_a_record_may_span_many_splits(spark, tmp_path, split_bytes):
    rows = rows_of(3)
    rows.insert(1, ("long", "A", 1, "V", "2024-01-09", "true", 1, 'start "x"\n' + "line, of text\n" * 800 + "end"))
    write(tmp_path / "interviews.csv", rows)
    want = one_task(spark, str(tmp_path / "interviews.csv"))
    split_bytes(500)
    got = read_contract_csv(spark, str(tmp_path), "interviews")
    assert sorted(map(str, got.collect())) == want
    records = csv_records(spark, str(tmp_path / "interviews.csv"))
    assert records.count() == 5 and records.filter("header").count() == 1


def test_the_file_is_read_twice_and_lines_travel_once(spark, tmp_path):
    write(tmp_path / "interviews.csv", rows_of(200))
    df = read_contract_csv(spark, str(tmp_path), "interviews")
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan") == 2 and "ReusedExchange" in final


def test_malformed_records_and_unclosed_quotes_fail(spark, tmp_path):
    good = ",".join(map(str, rows_of(1)[0][:7]))
    for name, text in (("short", "I1,A1\n"), ("date", good.replace("2024-01-09", "soon") + ",x\n"), ("open", f'{good},"never closed\n{good},x\n')):
        path = tmp_path / f"{name}.csv"
        path.write_text("h\n" + text)
        with pytest.raises(Exception, match="MALFORMED|malformed"):
            read_multi_line_csv(spark, str(path), SCHEMA, **OPTIONS).collect()


def test_empty_lines_and_missing_line_ends(spark, tmp_path):
    good = ",".join(map(str, rows_of(1)[0][:7]))
    (tmp_path / "interviews.csv").write_text(f"h\n\n{good},\"a\n\nb\"\n\n  \n{good},last")
    got = read_contract_csv(spark, str(tmp_path), "interviews").collect()
    assert sorted(r["feedback_text"] for r in got) == ["a\n\nb", "last"]
