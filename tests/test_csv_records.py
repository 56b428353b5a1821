"""Quoted line breaks: records from many tasks equal those of a reader that takes each file whole."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from quarry.sources.csv import _read_csv, csv_autodetect, load_csv, read_csv_text
from quarry.sources.csv_records import records, state_after


@pytest.fixture
def small_splits(spark):
    """Blocks of some hundred bytes, so that records span two blocks and more."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _rows(n, seed, sep, newline):
    rng = random.Random(seed)
    pieces = ["a", "b c", '"', '""', sep, newline, newline + newline, "é", "", '"' + newline, sep + '"', "x" * 40]
    return [[str(i)] + ["".join(rng.choice(pieces) for _ in range(rng.choice([0, 1, 2, 5, 30]))) for _ in range(2)] for i in range(n)]


@pytest.mark.parametrize("sep,newline", [(",", "\n"), (";", "\r\n")])
def test_records_equal_whole_reader(spark, tmp_path, small_splits, sep, newline):
    for part in range(3):
        text = io.StringIO()
        out = csv.writer(text, delimiter=sep, lineterminator=newline)
        out.writerow(["id", "first", "second"])
        out.writerows(_rows(80, part, sep, newline))
        (tmp_path / f"{part}.csv").write_bytes(text.getvalue().encode())
    lines = spark.read.text(str(tmp_path))
    assert lines.rdd.getNumPartitions() > 20
    got, surplus = _read_csv(spark, str(tmp_path), sep, "utf-8", True)
    assert got.where(F.col(surplus).isNotNull()).count() == 0
    want = (spark.read.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
            .option("multiLine", True).csv(str(tmp_path)))
    key = lambda r: tuple((v is not None, v or "") for v in r)
    assert sorted(map(tuple, got.drop(surplus).collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    assert want.count() == 240
    # and the texts that were written, by Python's reader
    plain = {r["id"]: (r["first"] or "", r["second"] or "") for r in got.where("id = '7' OR id = '33'").collect()}
    assert all(plain[str(i)] in {tuple(v.replace("\r\n", "\n") for v in _rows(80, part, sep, newline)[i][1:]) for part in range(3)} for i in (7, 33))


def test_bare_quotes_and_empty_lines(spark, tmp_path, small_splits):
    """A quote inside an unquoted field is a character and opens nothing."""
    body = 'a,b\n1,5" pipe\n\n2,"two\n\nlines, ""quoted"""\n3,6" and 7" pipe\n4,"un"closed\n' + "".join(f'{i},"l{i}\nm"\n' for i in range(5, 90))
    (tmp_path / "t.csv").write_text(body)
    got = {r["a"]: r["b"] for r in read_csv_text(spark, str(tmp_path / "t.csv")).collect()}
    assert got["1"] == '5" pipe' and got["2"] == 'two\n\nlines, "quoted"' and got["3"] == '6" and 7" pipe'
    assert got["70"] == "l70\nm" and len(got) == 89
    df, sep, enc = csv_autodetect(spark, str(tmp_path / "t.csv"))
    assert (sep, enc, df.count()) == (",", "utf-8", 89)


def test_latin_surplus_and_nothing_below_the_header(spark, tmp_path, small_splits):
    (tmp_path / "l.csv").write_bytes('año;texto\n1;"niño\nsí"\n2;x\n'.encode("latin-1"))
    df, sep, enc = csv_autodetect(spark, str(tmp_path / "l.csv"))
    assert (sep, enc) == (";", "ISO-8859-1") and {r["texto"] for r in df.collect()} == {"niño\nsí", "x"}
    (tmp_path / "s.csv").write_text('a,b\n1,"x\ny"\n2,3,4\n')
    with pytest.raises(ValueError):
        read_csv_text(spark, str(tmp_path / "s.csv"))
    (tmp_path / "h.csv").write_text('"a\nz",b\n')
    assert records(spark, str(tmp_path / "h.csv"), ",").count() == 0
    (tmp_path / "t.csv").write_text('n,t\n1,"a\nb"\n2,c\n')
    assert dict(load_csv(spark, str(tmp_path / "t.csv")).dtypes) == {"n": "bigint", "t": "string"}


def test_state_after_a_line():
    after = state_after(",")
    for line, outside, inside in ((b'a,"b', 1, 0), (b'x",b', 0, 0), (b'5" pipe', 0, 0), (b'"a",b', 0, 0), (b'a"",b', 0, 1),
                                  (b'","', 0, 1), (b'x","y', 1, 1), (b'a "b" c', 0, 0), (b'",5" ', 0, 0), (b'"' * 100_001, 1, 0)):
        assert (after(0, line), after(1, line)) == (outside, inside), line
    assert state_after(";")(0, b'a;"b') == 1
