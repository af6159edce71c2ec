"""Multi-line CSV in splits (S2): the rows of the plain reader, in more than one task a file."""

import random

import pytest
from listinglab.schemas import RAW_REVIEW
from listinglab.sources import records
from listinglab.sources.files import read_reviews

COLUMNS = [f.name for f in RAW_REVIEW.fields]
PARTS = ["a", "b ", '"', ",", "\n", "\r\n", "\n\n", "é", "x" * 50, "'", "word ", "\\", "đẹp"]


@pytest.fixture
def small_splits(spark):
    wanted = {"spark.sql.files.maxPartitionBytes": "2048", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write(path, rows, eol="\n", start="", end=None):
    def field(t):
        return '"' + t.replace('"', '""') + '"' if any(c in t for c in '",\n\r') or len(t) % 3 == 0 else t

    text = start + ",".join(COLUMNS) + eol + eol.join(",".join(map(field, r)) for r in rows) + (eol if end is None else end)
    path.write_bytes(text.encode())


def plain(spark, path):
    return spark.read.schema(RAW_REVIEW).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(str(path))


def same(spark, path):
    got = read_reviews(spark, str(path)).drop("source_path", "source_file").collect()
    want = plain(spark, path).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, want)))
    return len(got)


def random_rows(rng, n, most=30):
    return [["".join(rng.choices(PARTS, k=rng.randint(0, most))) for _ in COLUMNS] for _ in range(n)]


@pytest.mark.parametrize("eol", ["\n", "\r\n"])
def test_rows_of_the_plain_reader(spark, small_splits, tmp_path, eol):
    rng = random.Random(3)
    write(tmp_path / "one.csv", random_rows(rng, 400), eol)
    write(tmp_path / "two.csv", random_rows(rng, 300), eol, end="" if eol == "\n" else eol)
    write(tmp_path / "none.csv", [], eol)
    assert same(spark, tmp_path) == 700


def test_one_file_is_many_tasks(spark, small_splits, tmp_path):
    rng = random.Random(4)
    write(tmp_path / "big.csv", random_rows(rng, 300))
    assert plain(spark, tmp_path).rdd.getNumPartitions() == 1
    lines = records._lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 20
    states = records.split_states(lines).collect()
    assert len(states) > 20 and {r.inside for r in states} == {True, False}
    text = (tmp_path / "big.csv").read_bytes()
    # A split's lines begin behind its first byte, but for the file's first.
    for r in states:
        first = text.index(b"\n", r.start - 1) + 1 if r.start else 0
        assert r.inside == (text[:first].count(b'"') % 2 == 1)


def test_a_record_over_many_splits(spark, small_splits, tmp_path):
    long = "\n".join(f'line {k}, "quoted"' for k in range(2000))
    rows = [["1", "t", long, "i", ""], ["2", "u", "short", "j", "s"], ["3", "v", long + "\n", "k", ""]]
    write(tmp_path / "long.csv", rows)
    assert same(spark, tmp_path) == 3
    assert {len(r["Full Review"]) for r in read_reviews(spark, str(tmp_path)).collect()} == {len(long), 5, len(long) + 1}


def test_marks_empty_lines_and_names(spark, small_splits, tmp_path):
    write(tmp_path / "a.csv", [["1", "x", 'say "hi"\nthere', "", ""]] * 50, start="﻿", end="\n\n\n")
    assert same(spark, tmp_path) == 50
    out = read_reviews(spark, str(tmp_path)).select("source_file", "Rating").distinct().collect()
    assert [tuple(r) for r in out] == [("a.csv", "1")]
    (tmp_path / "a.csv").write_bytes((",".join(COLUMNS) + '\n1,x,"never closed\n2,y,z\n').encode())
    # To the end of the file, but for the last line's end.
    assert [r.Review for r in read_reviews(spark, str(tmp_path)).selectExpr("`Full Review` AS Review").collect()] == ["never closed\n2,y,z"]
