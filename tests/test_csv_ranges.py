"""CSV files with quoted line breaks, read in ranges of bytes by many tasks."""

import csv
import io
import random

import pytest
from conftest import rows_of
from pyspark.sql import types as T

from cartwheel import schemas
from cartwheel.session import scratch_path
from cartwheel.sources import csv_ranges, files
from cartwheel.workload import queries

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("more", T.StringType())])


@pytest.fixture
def small_ranges(spark):
    """Ranges of some hundred bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]

    def use(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")
    yield use
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def written(tmp_path, rows, name="t.csv", end="\n", header="id,text,more"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    (tmp_path / name).write_bytes((header + end + out.getvalue()).encode())
    return str(tmp_path / name)


def random_rows(seed, n):
    r = random.Random(seed)
    parts = ["a", "bc", '"', '""', "\n", "\n\n", ",", " ", "é", "日本", "\t", "x" * 30, '",\n"', "1,2"]
    return [(k, "".join(r.choices(parts, k=r.choice([0, 1, 3, 8, 40]))).strip(" "), r.choice(["", "m", "\n", '"\n"'])) for k in range(n)]


def expected(rows):
    return {k: (t or None, m or None) for k, t, m in rows}


def read(spark, path, **options):
    return {r.id: (r.text, r.more) for r in files.read_csv_table(spark, path, SCHEMA, free_text=True, **options).collect()}


@pytest.mark.parametrize("size", [40, 97, 256, 1000, 5000])
def test_any_text_in_ranges_of_any_size(spark, tmp_path, small_ranges, size):
    rows = random_rows(size, 300)
    path = written(tmp_path, rows)
    whole = read(spark, path)
    small_ranges(size)
    frame = files.read_csv_table(spark, path, SCHEMA, free_text=True)
    assert frame.count() == 300
    assert read(spark, path) == whole == expected(rows)


def test_the_same_rows_in_many_tasks(spark, tmp_path, small_ranges):
    rows = [(k, f"line one\nline {k}, two", "m") for k in range(5000)]
    path = written(tmp_path, rows)
    small_ranges(8000)
    assert spark.read.text(path).rdd.getNumPartitions() > 10
    assert read(spark, path) == expected(rows)


def test_a_field_longer_than_ranges(spark, tmp_path, small_ranges):
    rows = [(0, "start", "m"), (1, "\n".join(["in, side"] * 400), "m"), (2, "\n" * 500, ""), (3, "y" * 3000, "z"), (4, "end", "m")]
    path = written(tmp_path, rows)
    small_ranges(200)
    assert read(spark, path) == expected(rows)


def test_line_ends_of_two_characters(spark, tmp_path, small_ranges):
    rows = [(k, "one\r\ntwo" if k % 3 else "plain", "m") for k in range(200)]
    path = written(tmp_path, rows, end="\r\n")
    small_ranges(150)
    assert read(spark, path) == {k: (t and t.replace("\r\n", "\n"), m) for k, (t, m) in expected(rows).items()}


def test_small_and_large_files_together(spark, tmp_path, small_ranges):
    first, second = random_rows(1, 200), [(k + 1000, t, m) for k, t, m in random_rows(2, 3)]
    written(tmp_path, first, "large.csv")
    written(tmp_path, second, "small.csv")
    written(tmp_path, [], "header.csv")
    (tmp_path / "_SUCCESS").write_text("")
    small_ranges(600)
    assert read(spark, str(tmp_path)) == expected(first + second)
    groups = list(csv_ranges._groups({"a": 5, "b": 5, "c": 20, "d": 1}, 10))
    assert groups == [["a", "b"], ["c"], ["d"]]


def test_bad_records_fail(spark, tmp_path, small_ranges):
    path = written(tmp_path, [(k, "a\nb", "m") for k in range(50)] + [("x", "a", "m")])
    small_ranges(100)
    with pytest.raises(Exception, match="(?i)malformed|CAST|number"):
        read(spark, path)


def test_dates_of_drops_read_in_ranges(spark, tmp_path, small_ranges):
    for day in ("2024-01-01", "2024-01-02"):
        (tmp_path / "sellers" / day).mkdir(parents=True)
        written(tmp_path / "sellers" / day, [(f"s{k}", "0123", "a\nb", day) for k in range(60)],
                header="seller_id,seller_zip_code_prefix,seller_city,seller_state")
    small_ranges(300)
    rows = files.read_drops(spark, str(tmp_path), "sellers", ["2024-01-01", "2024-01-02"], schemas.SELLERS, free_text=True)
    assert {(str(r.load_date), r.seller_state) for r in rows.collect()} == {("2024-01-01",) * 2, ("2024-01-02",) * 2}
    assert rows.count() == 120


def test_written_tables_read_back(spark, frame, small_ranges):
    rows = frame("id long, text string, more string", *[(k, f'q"{k}"\n,"', None) for k in range(500)])
    path = scratch_path(spark, "csv")
    files.write_csv(rows.coalesce(1), path)
    small_ranges(400)
    assert rows_of(files.read_csv_table(spark, path, SCHEMA, free_text=True), "id") == rows_of(rows, "id")


def test_documents_are_written_by_more_tasks_the_more_they_are(spark, small_ranges, monkeypatch):
    folder, tasks = "/root/testdata/sf0.001", []
    query, write = queries.QUERIES["s1_csv_ranges"], files.write_csv
    monkeypatch.setattr(files, "write_csv", lambda df, *more: tasks.append(df.rdd.getNumPartitions()) or write(df, *more))
    one = rows_of(query(spark, folder), "review_id")
    monkeypatch.setattr(queries, "CSV_FILE_BYTES", queries.Inputs(spark, folder).size("documents") // 3)
    small_ranges(20_000)
    assert rows_of(query(spark, folder), "review_id") == one
    assert tasks[0] == 1 and 3 <= tasks[1] <= 4
