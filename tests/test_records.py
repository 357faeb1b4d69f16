"""Records over several lines and splits, against the same rules one line after the other."""

import random
import re

import pytest
from casebook.sources import csv, records
from casebook.sources.csv import RAW_LINE, load_csv
from casebook.sources.specs import DatasetSpec
from pyspark.sql import functions as F

HEADERS = ("A", "B", "C")
SPEC = DatasetSpec("three", "three.csv", HEADERS)


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "64")
    # holds for tables in between, whose files are larger than the texts
    spark.conf.set("spark.sql.files.maxPartitionNum", "80")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")
    spark.conf.unset("spark.sql.files.maxPartitionNum")


def is_record(text, allowed):
    rest = re.sub(r'(?<![^,])"[^"]*"(?=,|\Z)', lambda m: m[0].replace(",", "").replace('"', ""), text.replace('""', ""))
    if '"' in rest or rest.count(",") != 2:
        return False
    fields = rest.split(",")
    return allowed is None or not any("\n" in f for i, f in enumerate(fields) if i not in allowed)


def one_after_the_other(text, allowed, has_header=True):
    """Texts of records over several lines, texts of other rows, and those of them with an open quote."""
    lines = [line.removesuffix("\r") for line in text.removesuffix("\n").split("\n")][has_header:]
    odd = [i for i, line in enumerate(lines) if line.count('"') % 2]
    whole, taken, after = [], set(), -1
    for start, end in zip(odd, odd[1:], strict=False):
        if start > after and is_record("\n".join(lines[start : end + 1]), allowed):
            whole.append("\n".join(lines[start : end + 1]))
            taken |= set(range(start, end + 1))
            after = end
    singles = [line for i, line in enumerate(lines) if i not in taken and line.strip()]
    return whole, singles, [line for line in singles if line.count('"') % 2]


def as_text(headers):
    """A parser that leaves the text whole, in the first column."""
    return lambda text: F.struct(text.alias(headers[0]), *(F.lit(None).cast("string").alias(c) for c in (*headers[1:], RAW_LINE)))


def random_file(generator):
    parts = ["a", ",", "x,y", '"', '""', "\n", '"\n"', ',"', '",', '\n1,"b', 'c",2\n', "\r\n", "1,2,3\n", '\n"x\ny",2,3\n', '\n1,2,"z\nw"\n', '1,"p\nq,\n""r""",3\n', "\n\n"]
    return "A,B,C\n" + "".join(generator.choice(parts) for _ in range(generator.randrange(5, 90)))


@pytest.mark.parametrize(("allowed", "several"), [(None, 4), ([0, 2], 1)])
def test_any_text_in_any_splits(spark, tmp_path, small_splits, allowed, several):
    generator = random.Random(5)
    expected = []
    for i in range(12):
        text = random_file(generator)
        (tmp_path / f"{i:02}.csv").write_bytes(text.encode())
        whole, singles, opened = one_after_the_other(text, allowed)
        expected += [(t, None) for t in whole] + [(t, t if t in opened else None) for t in singles]
    files = [row[0] for row in spark.read.text(str(tmp_path)).select("_metadata.file_path").distinct().collect()]
    breaks = None if allowed is None else [HEADERS[i] for i in allowed]
    found = records.records(spark, str(tmp_path), files, HEADERS, breaks, RAW_LINE, has_header=True, parse=as_text(HEADERS))
    rows = [(r["A"], r[RAW_LINE]) for r in found.collect()]
    assert sum("\n" in t for t, _ in rows) >= several
    assert sorted(rows, key=repr) == sorted(expected, key=repr)


def test_a_record_over_many_splits(spark, tmp_path, small_splits):
    """One file of many blocks: what meets over the blocks is one row for each of them."""
    long = "\n".join(f"line {i}, with a comma" for i in range(200))
    text = "A,B,C\n" + "1,2,3\n" * 30 + f'4,"{long}",5\n' + "6,7,8\n" * 30 + '9,"open,1\n' + "6,7,8\n" * 30
    (tmp_path / "one.csv").write_text(text)
    loaded = load_csv(spark, str(tmp_path / "one.csv"), SPEC)
    assert loaded.profile["kept"] == 92 and loaded.profile["malformed"] == 1
    assert [r.b for r in loaded.rows.filter("a = '4'").collect()] == [long]
    file = spark.read.text(str(tmp_path)).select("_metadata.file_path").first()[0]
    lines = records.told_lines(records.all_lines(spark, str(tmp_path), [file]))
    blocks = records.block_sums(records.segments(records.numbered(lines, True), 3, False), 3, None)
    places = lines.select("file", "block").distinct().count()
    assert places > 50 and blocks.count() == places
    decided = records.decisions(blocks, 3, None)._jdf.queryExecution().optimizedPlan().toString()
    above, below = decided.split("Aggregate [file#", 1)
    assert "[file#" in above and not re.search(r"Window .*\], \[file#\d+\], \[", below)


def test_a_record_of_any_length(spark, tmp_path):
    long = "\n".join(f"{i}, a line of a long text that ends in a comma," for i in range(340_000))
    assert len(long) > 17_000_000
    (tmp_path / "long.csv").write_text(f'A,B,C\n1,x,y\n2,"{long}",z\n3,x,y\n')
    loaded = load_csv(spark, str(tmp_path / "long.csv"), SPEC)
    assert loaded.profile == {"rows_in": 3, "all_null": 0, "missing_required": 0, "kept": 3, "malformed": 0}
    assert {(r.a, r.n) for r in loaded.rows.select("a", F.octet_length("b").alias("n")).collect()} == {("1", 1), ("2", len(long)), ("3", 1)}


def test_carriage_returns(spark, tmp_path):
    """They belong to the end of a line, or to the field they are in."""
    (tmp_path / "cr.csv").write_bytes(b'A,B,C\r\n1,"a\rb",c\r\n2,"d\r\ne\rf",g\r\n3,h,i\r\n')
    loaded = load_csv(spark, str(tmp_path / "cr.csv"), SPEC)
    assert {(r.a, r.b, r.c) for r in loaded.rows.collect()} == {("1", "a\rb", "c"), ("2", "d\ne\rf", "g"), ("3", "h", "i")}


def bytes_read(spark):
    statistics = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
    return sum(s.getBytesRead() for s in statistics if s.getScheme() == "file")


def test_a_clean_file_is_read_once(spark, tmp_path):
    path = tmp_path / "clean.csv"
    path.write_text("A,B,C\n" + "".join(f'{i},"quoted, {i}",text of some length\n' for i in range(100_000)))
    before = bytes_read(spark)
    loaded = load_csv(spark, str(path), SPEC)
    read, size = bytes_read(spark) - before, path.stat().st_size
    assert loaded.profile["kept"] == 100_000 and size <= read < 1.2 * size


@pytest.mark.parametrize("named", [64, 2])
def test_only_open_files_are_read_again(spark, tmp_path, monkeypatch, named):
    """Few files are named to the scan, many told by a join; the others' rows come from the first parse."""
    monkeypatch.setattr(records, "NAMED_FILES", named)
    monkeypatch.setattr(csv, "few_or_table", records.few_or_table)
    for i in range(12):
        (tmp_path / f"clean {i}.csv").write_text("A,B,C\n" + f"{i},y,z\n" * 5)
    for i in range(4):
        (tmp_path / f"open {i}.csv").write_text(f'A,B,C\n{i},"x\ny",z\n7,"unclosed,z\n8,a,b\n')
    loaded = load_csv(spark, str(tmp_path), SPEC)
    assert loaded.profile["kept"] == loaded.profile["rows_in"] == 60 + 12 and loaded.profile["malformed"] == 4
    assert loaded.rows.filter("b = 'x\ny'").count() == 4


def test_a_named_stage_holds_the_records(spark, tmp_path):
    (tmp_path / "open.csv").write_text('A,B,C\n1,"x\ny",z\n')
    stage = str(tmp_path / "stage")
    load_csv(spark, str(tmp_path / "open.csv"), SPEC, stage=stage)
    assert [r.b for r in spark.read.parquet(stage).collect()] == ["x\ny"]


def test_lines_that_hold_the_separator_of_the_line_reader(spark, tmp_path):
    text = f"A,B,C\n1,a{records.NO_SEPARATOR}b,c\n2,{records.NO_QUOTE}d,e\n"
    (tmp_path / "odd.csv").write_text(text, encoding="utf-8")
    rows = {(r.a, r.b, r.c) for r in load_csv(spark, str(tmp_path / "odd.csv"), SPEC).rows.collect()}
    assert rows == {("1", f"a{records.NO_SEPARATOR}b", "c"), ("2", f"{records.NO_QUOTE}d", "e")}
