from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel import schemas
from cartwheel.session import in_parallel, scratch_path, shared_folder
from cartwheel.sources import audit, catalog, drift, files, landing
from conftest import by_key, rows_of, ts

SMALL = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("n", T.LongType()),
    T.StructField("note", T.StringType()),
])


def write_text(tmp_path, text, name="part.csv"):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_quotes_newlines_nulls(spark, tmp_path):
    path = write_text(tmp_path, 'id,n,note\na,1,"two\nlines"\nb,,"a ""quoted"" word"\nc,3,\n')
    rows = rows_of(files.read_csv_table(spark, path, SMALL, free_text=True), "id")
    assert rows == [
        {"id": "a", "n": 1, "note": "two\nlines"},
        {"id": "b", "n": None, "note": 'a "quoted" word'},
        {"id": "c", "n": 3, "note": None},
    ]


def test_csv_keeps_spaces_round_trip(spark, frame):
    path = scratch_path(spark, "spaces")
    df = frame("id string, n bigint, note string", ("a", 1, "  padded "), ("b", 2, 'say "hi",\nok'))
    files.write_csv(df, path)
    back = files.read_csv_table(spark, path, SMALL, free_text=True)
    assert rows_of(back, "id") == rows_of(df, "id")


def test_csv_required_column_missing_value(spark, tmp_path):
    path = write_text(tmp_path, "id,n,note\na,1,x\n,2,y\n")
    with pytest.raises(Exception, match="required column id is NULL"):
        files.read_csv_table(spark, path, SMALL).collect()


def test_csv_bad_value_fails(spark, tmp_path):
    path = write_text(tmp_path, "id,n,note\na,one,x\n")
    with pytest.raises(Exception):
        files.read_csv_table(spark, path, SMALL).collect()


def test_csv_columns_are_pruned(spark, tmp_path):
    path = write_text(tmp_path, "id,n,note\na,1,x\n")
    plan = files.read_csv_table(spark, path, SMALL).select("n")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<n:bigint>" in plan


def test_jsonl_round_trip_with_nulls_and_letters(spark, frame):
    base = scratch_path(spark, "json")
    df = frame("id string, n bigint, note string", ("a", None, "Ação"), ("b", 2, None))
    path = files.write_jsonl(df, base, "2024-01-02")
    assert path.endswith("/2024-01-02")
    lines = sorted(r.value for r in spark.read.text(path).collect())
    assert lines == ['{"id":"a","n":null,"note":"Ação"}', '{"id":"b","n":2,"note":null}']
    assert rows_of(files.read_jsonl_table(spark, path, SMALL), "id") == rows_of(df, "id")


def test_read_drops_adds_the_date(spark, frame):
    base = scratch_path(spark, "drops")
    for day, n in ((date(2024, 1, 1), 1), (date(2024, 1, 2), 2), (date(2024, 1, 3), 3)):
        landing.land(frame("id string, n bigint, note string", ("a", n, "x")), base, "t", day)
    days = files.dates_between(date(2024, 1, 1), date(2024, 1, 2))
    got = files.read_drops(spark, base, "t", days, SMALL)
    assert {(r.n, r.load_date) for r in got.collect()} == {
        (1, date(2024, 1, 1)), (2, date(2024, 1, 2))}
    assert files.read_drop(spark, base, "t", "2024-01-03", SMALL).first().n == 3


def test_land_is_idempotent(spark, frame):
    base = scratch_path(spark, "land")
    first = frame("id string, n bigint, note string", ("a", 1, "x"))
    second = frame("id string, n bigint, note string", ("a", 2, "x"))
    assert landing.land(first, base, "t", "2024-01-01") == "success"
    assert landing.land(second, base, "t", "2024-01-01") == "skipped"
    assert files.read_drop(spark, base, "t", "2024-01-01", SMALL).first().n == 1
    assert landing.land(second, base, "t", "2024-01-01", force=True) == "success"
    assert files.read_drop(spark, base, "t", "2024-01-01", SMALL).first().n == 2


def test_unfinished_drop_is_landed_again(spark, frame, tmp_path):
    (tmp_path / "t" / "2024-01-01").mkdir(parents=True)
    (tmp_path / "t" / "2024-01-01" / "part-0.csv").write_text("id,n,note\nz,9,z\n")
    df = frame("id string, n bigint, note string", ("a", 1, "x"))
    assert landing.land(df, str(tmp_path), "t", "2024-01-01") == "success"
    assert [r.id for r in files.read_drop(spark, str(tmp_path), "t", "2024-01-01", SMALL)
            .collect()] == ["a"]


def test_source_gate(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        landing.validate_source(spark, str(tmp_path / "none.csv"))
    empty = write_text(tmp_path, "")
    with pytest.raises(ValueError, match="empty"):
        landing.validate_source(spark, empty)
    landing.validate_source(spark, write_text(tmp_path, "id\n1\n", "full.csv"))


def test_load_all_reports_and_raises(spark, frame):
    base, target = scratch_path(spark, "drops"), scratch_path(spark, "raw")
    good = frame("id string, n bigint, note string", ("a", 1, "x"), ("b", 2, "y"))
    landing.land(good, base, "good", "2024-01-01")
    landing.land(good.withColumn("n", F.lit("one")), base, "bad", "2024-01-01")
    wanted = {"missing": SMALL, "bad": SMALL, "good": SMALL}
    status = by_key(landing.load_all(spark, base, target, "2024-01-01", wanted, strict=False),
                    "table")
    assert status["good"]["status"] == "success" and status["good"]["rows"] == 2
    assert status["bad"]["status"] == "error"
    assert "not found" in status["missing"]["reason"]
    assert spark.read.parquet(f"{target}/good").count() == 2
    with pytest.raises(landing.LoadFailed, match="missing, bad") as failure:
        landing.load_all(spark, base, target, "2024-01-01", wanted)
    assert failure.value.status.count() == 3


def test_write_dispositions(spark, frame):
    path = scratch_path(spark, "table")
    df = frame("id string", ("a",), ("b",))
    landing.write_table(df.limit(0), path)
    landing.write_table(df, path, "empty")  # an existing table without rows may be filled
    with pytest.raises(ValueError, match="not empty"):
        landing.write_table(df, path, "empty")
    landing.write_table(df, path, "append")
    assert spark.read.parquet(path).count() == 4
    assert landing.write_counted(df, path) == 2
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError, match="disposition"):
        landing.write_table(df, path, "merge")


def test_empty_batch_keeps_the_table(spark, frame):
    path = scratch_path(spark, "table")
    df = frame("id string", ("a",))
    assert landing.write_if_nonempty(df, path)
    assert not landing.write_if_nonempty(df.limit(0), path)
    assert spark.read.parquet(path).count() == 1


def test_catalog_stores_marts_and_views_staging(spark, frame):
    tables = catalog.Tables(spark, scratch_path(spark, "tables"))
    view = tables.materialize("stg_test", frame("id string", ("a",)), "staging")
    assert "parquet" not in view._jdf.queryExecution().toString()
    stored = tables.materialize("mart_test", view, "marts")
    assert "mart_test" in stored.inputFiles()[0]
    assert tables.table("mart_test", "marts").first().id == "a"


def test_audit_defaults_and_failure(spark, frame):
    path = scratch_path(spark, "audit")
    full = frame(schemas.QUERY_AUDIT, ("u", "q", "SELECT 1", ["a", "b"], 7, ts("2024-01-01")))
    bare = full.select("question", "generated_sql", "tables_referenced", "created_at")
    assert audit.append_audit(full, path) and audit.append_audit(bare, path)
    log = spark.read.parquet(path)
    assert {(r.user_id, r.tokens_used) for r in log.collect()} == {("u", 7), ("anonymous", 0)}
    assert by_key(audit.queries_by_table(log), "table_name")["a"]["query_count"] == 2
    assert by_key(audit.tokens_by_user(log), "user_id")["u"]["tokens_used"] == 7
    broken = full.withColumn("question", F.raise_error(F.lit("no")).cast("string"))
    assert audit.append_audit(broken, path) is False
    assert spark.read.parquet(path).count() == 2


def test_schema_conformance(spark, tmp_path):
    path = write_text(tmp_path, "id,n,extra\na,1,x\n,two,y\nc,,z\n")
    found = by_key(drift.schema_conformance(drift.read_as_text(spark, path), SMALL), "column")
    assert found["id"]["status"] == "bad_values" and found["id"]["bad_rows"] == 1
    assert found["n"]["bad_rows"] == 1
    assert found["note"]["status"] == "missing" and found["note"]["bad_rows"] is None
    assert found["extra"]["status"] == "extra"


def test_shared_folder_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_folder(spark) == configured.rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert spark.sparkContext.applicationId in scratch_path(spark, "x")


def test_in_parallel_keeps_results_and_errors_apart(spark):
    def fail():
        raise ValueError("no")
    got = in_parallel(spark, {"a": lambda: spark.range(3).count(), "b": fail})
    assert list(got) == ["a", "b"] and got["a"] == 3 and isinstance(got["b"], ValueError)
