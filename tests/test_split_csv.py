import random

import pytest

from corpusprep.sources import split_csv, tables

SCHEMA = "id bigint, text string, note string"


@pytest.fixture
def small_splits(spark):
    for name, value in (("spark.sql.files.maxPartitionBytes", "300"), ("spark.sql.files.openCostInBytes", "1")):
        spark.conf.set(name, value)
    yield
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(name)


def rows(df):
    return sorted(map(str, df.collect()))


def write(path, n, seed, end="\n"):
    """A csv file with every kind of field; some are longer than several splits."""
    rnd = random.Random(seed)
    pieces = ["word", " ", ",", '""', "\n", "\n\n", "é🙂", "a,b", "\t", "nan", "x" * 40]
    lines = ["id,text,note"]
    for i in range(n):
        text = "".join(rnd.choices(pieces, k=rnd.choice((0, 1, 3, 12, 150))))
        note = rnd.choice(("plain", "", "NA", '"quoted"', '"two\nlines"', '"q ""x"" q"'))
        lines.append(f'{i},"{text}",{note}')
        if rnd.random() < 0.1:
            lines.append("")
    path.write_bytes((end.join(lines) + end * rnd.randrange(2)).encode())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equal_to_the_reader_of_whole_files(spark, tmp_path, small_splits, seed):
    for k in range(2):
        write(tmp_path / f"{k}.csv", 60, 10 * seed + k)
    split = tables.read_table(spark, str(tmp_path), "csv", SCHEMA, multi_line="split")
    assert rows(split) == rows(tables.read_table(spark, str(tmp_path), "csv", SCHEMA))
    assert split_csv._lines(spark, str(tmp_path)).select("file", "split").distinct().count() > 20


def test_line_ends_of_two_characters(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_bytes(b'id,text,note\r\n1,"a\r\nb",x\r\n2,c,""\r\n')
    found = tables.read_table(spark, str(tmp_path), "csv", SCHEMA, multi_line="split")
    assert [tuple(r) for r in found.orderBy("id").collect()] == [(1, "a\r\nb", "x"), (2, "c", None)] or [
        tuple(r) for r in found.orderBy("id").collect()
    ] == [(1, "a\r\nb", "x"), (2, "c", "")]


def test_an_open_field_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text,note\n1,"a,b\n2,c,d\n')
    with pytest.raises(ValueError, match="not closed"):
        tables.read_table(spark, str(tmp_path), "csv", SCHEMA, multi_line="split")
    with pytest.raises(ValueError, match="schema"):
        tables.read_table(spark, str(tmp_path), "csv", multi_line="split")


def test_header_only(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text,note\n")
    assert tables.read_table(spark, str(tmp_path), "csv", SCHEMA, multi_line="split").count() == 0
