import csv
import random

import pytest
from pyspark.sql import functions as F

from stayscope.session import shared_folder
from stayscope.sources.files import read_csv, write_csv
from stayscope.sources.large_csv import _cut, _lines, quoted_splits, read_large_csv

HEADER = ["id", "body, quoted", "note"]


def written(rows, line_end="\n", seed=0):
    rng = random.Random(seed)
    out = [",".join('"%s"' % h for h in HEADER)]
    for row in rows:
        cells = []
        for cell in row:
            plain = not any(c in cell for c in ',"\n\r') and cell == cell.strip() and rng.random() < 0.5
            cells.append(cell if plain and cell else '"%s"' % cell.replace('"', '""'))
        out.append(",".join(cells))
    return line_end.join(out) + line_end


def some_rows(n, seed):
    rng = random.Random(seed)
    pieces = ["word", "two words", 'say "hi"', '"', '""', "a,b", "line\nbreak", "\n\n", ",", "é😀", '","', '\n"x",1\n', "z" * 300]
    return [(str(i), "".join(rng.choice(pieces) for _ in range(rng.randint(1, 6))), rng.choice(pieces)) for i in range(n)]


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_the_reader_of_one_task_and_the_rows(spark, tmp_path, small_splits, seed):
    rows = some_rows(150, seed)
    # A field that spans many splits, and one at the end.
    rows[40] = ("40", "long\n" * 900 + '"', "x")
    rows[-1] = (rows[-1][0], "last\n" * 300, '"')
    path = tmp_path / "one.csv"
    path.write_text(written(rows, seed=seed), newline="")
    assert list(csv.reader(path.open(newline="")))[1:] == [list(r) for r in rows]
    found = read_large_csv(spark, str(path))
    assert found.columns == HEADER
    assert got(found) == sorted(rows) == got(read_csv(spark, str(path)))
    lines = _lines(spark, str(path))
    inside = quoted_splits(lines)
    assert len(inside) > 3
    tasks = _cut(lines, inside, ("whole",)).groupBy(F.spark_partition_id().alias("task")).count()
    assert tasks.count() > 8


def test_folder_of_files_other_line_ends_and_no_last_line_end(spark, tmp_path, small_splits):
    rows = [some_rows(40, s) for s in (5, 6)]
    rows = [[(f"{s}-{i}", b.replace("\n", " "), n.replace("\n", " ")) for i, b, n in part] for s, part in enumerate(rows)]
    (tmp_path / "d").mkdir()
    (tmp_path / "d/a.csv").write_text(written(rows[0], "\r\n"), newline="")
    (tmp_path / "d/b.csv").write_text(written(rows[1]).removesuffix("\n"), newline="")
    (tmp_path / "d/c.csv").write_text(written([]) + "\n\n", newline="")
    assert got(read_large_csv(spark, str(tmp_path / "d"))) == sorted(rows[0] + rows[1])


def test_short_rows_and_empty_fields_read_as_by_spark(spark, tmp_path):
    path = tmp_path / "short.csv"
    path.write_text('a,b,c\n1,,""\n2\n\n3,"x\ny"\n', newline="")
    assert got(read_large_csv(spark, str(path)).fillna("-")) == got(read_csv(spark, str(path)).fillna("-"))


def test_another_header_is_refused(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d/a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "d/b.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="another header"):
        read_large_csv(spark, str(tmp_path / "d")).collect()


def test_spark_s_own_files(spark, small_splits):
    rows = spark.createDataFrame(some_rows(60, 9), ["id", "body", "note"])
    folder = shared_folder(spark)
    assert write_csv(rows.coalesce(1), folder) == 60
    assert got(read_large_csv(spark, folder)) == got(rows)
