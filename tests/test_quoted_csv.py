"""The splitting reader equals the reader that takes each file in one task."""

import random

import pytest

from fundgraph.sources.quoted_csv import read_quoted_csv
from fundgraph.sources.tables import CSV


def whole_file(spark, path, encoding):
    return spark.read.options(**CSV, multiLine="true", encoding=encoding).csv(path)


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda n: [spark.conf.set("spark.sql.files.maxPartitionBytes", str(n)), spark.conf.set("spark.sql.files.openCostInBytes", "1")]
    for k, v in old.items():
        spark.conf.set(k, v)


def same(spark, path, encoding="UTF-8"):
    want, got = whole_file(spark, path, encoding), read_quoted_csv(spark, path, CSV, encoding)
    assert got.columns == want.columns
    key = lambda r: tuple((x is not None, x) for x in r)
    a, b = sorted(map(tuple, got.collect()), key=key), sorted(map(tuple, want.collect()), key=key)
    assert a == b
    return got, len(a)


def field(rng):
    kind = rng.randrange(8)
    text = "".join(rng.choice(["a", "é", ",", '"', "\n", " ", "xyz", '""', "\n\n"]) for _ in range(rng.randrange(12)))
    if kind < 4:
        return '"' + text.replace('"', '""') + '"'
    return ["", "plain", 'in"ner', " 7 "][kind - 4]


def write(path, rows, end, encoding):
    path.write_bytes((end.join(rows) + end).encode(encoding))


@pytest.mark.parametrize("encoding", ["UTF-8", "ISO-8859-1"])
@pytest.mark.parametrize("size", [40, 300, 5000])
def test_equals_whole_file_reader(spark, tmp_path, small_splits, encoding, size):
    rng = random.Random(size)
    write(tmp_path / "a.csv", ["k,b,c"] + [",".join([str(i), field(rng), field(rng)]) for i in range(400)], "\n", encoding)
    small_splits(size)
    got, n = same(spark, str(tmp_path / "a.csv"), encoding)
    assert n == 400
    assert spark.read.text(str(tmp_path / "a.csv"), lineSep="\n").rdd.getNumPartitions() > (1 if size == 5000 else 10)


def test_field_longer_than_many_splits(spark, tmp_path, small_splits):
    write(tmp_path / "a.csv", ["k,b", '1,"' + "line, of text\n" * 300 + '"', "2,x", '3,"' + '""\n' * 100 + '"'], "\n", "UTF-8")
    small_splits(64)
    assert same(spark, str(tmp_path / "a.csv"))[1] == 3


def test_several_files_header_with_break_carriage_returns(spark, tmp_path, small_splits):
    for i in range(3):
        write(tmp_path / f"{i}.csv", ['"a\r\nkey",b', f'{i},"x\r\ny"', "", f'{i + 10},"he said ""no"""', f"{i + 20},"], "\r\n", "UTF-8")
    small_splits(16)
    got = read_quoted_csv(spark, str(tmp_path), CSV)  # breaks inside quotes stay as written
    want = [r for i in range(3) for r in [(str(i), "x\r\ny"), (str(i + 10), 'he said "no"'), (str(i + 20), None)]]
    assert got.columns == whole_file(spark, str(tmp_path), "UTF-8").columns
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_last_line_without_end_and_header_only(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text('k,b\n1,"p\nq"')
    (tmp_path / "b.csv").write_text("k,b\n")
    small_splits(4)
    assert same(spark, str(tmp_path / "a.csv"))[1] == 1
    assert same(spark, str(tmp_path / "b.csv"))[1] == 0


def test_invalid_bytes_become_replacement_characters(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'k,b\n1,"\xff\n\xc3"\n2,\xe9"x\n3,y\n')
    assert same(spark, str(tmp_path / "a.csv"))[1] == 3
