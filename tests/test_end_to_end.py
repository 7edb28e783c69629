import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks import compare
from checks.duckdb_sql import statements
from plaudit.plans.refresh import Refresh, RefreshFailed, checked, refresh
from plaudit.plans.registry import QUERIES
from plaudit.sources.raw import RAW_NAMES, read_raw, rename_columns, write_csv
from plaudit.sources.testdata import TEST_RULES, raw_reviews
from plaudit.streaming.ingest import ingest_new

from .conftest import SMALL, plan

TITLES = {new: old for old, new in RAW_NAMES.items()}


def deliver(df, path, mode="append"):
    one_line = df.withColumn("summary", F.regexp_replace("summary", "[\\r\\n]+", " "))
    write_csv(one_line.withColumnsRenamed(TITLES), path, mode=mode)


def test_csv_keeps_quotes_blanks_and_text_types(spark, tmp_path):
    data = [('say "hi", ok', " 4 ", "5", 'a""b', "  padded  "), ("x\\y", "1,000", "4.0", "Nan", "plain")]
    df = spark.createDataFrame(data, ", ".join(f"`{n}` string" for n in RAW_NAMES))
    write_csv(df, f"{tmp_path}/csv")
    back = rename_columns(read_raw(spark, f"{tmp_path}/csv"))
    assert sorted(tuple(r) for r in back.collect()) == sorted(data)
    assert all(f.dataType.simpleString() == "string" for f in back.schema)


def test_columns_are_taken_by_header_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Rate,ProductName,Price,Summary,Review\n5,pen,10,fine,ok\n")
    row = rename_columns(read_raw(spark, str(tmp_path))).first()
    assert (row["product_name"], row["rate"], row["summary"]) == ("pen", "5", "fine")


def test_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('ProductName,Price,Rate,Review,Summary\npen,10,5,ok,"two\nlines"\n')
    assert read_raw(spark, str(tmp_path)).count() == 2
    assert read_raw(spark, str(tmp_path), multiline=True).first()["Summary"] == "two\nlines"


def test_ingest_adds_each_file_once(spark, tmp_path):
    src, dst, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "out", "done"))
    raw = raw_reviews(spark, SMALL)
    deliver(raw.filter("rate = '5'"), src)
    ingest_new(spark, src, dst, checkpoint)
    first = spark.read.parquet(dst).count()
    ingest_new(spark, src, dst, checkpoint)
    assert spark.read.parquet(dst).count() == first == raw.filter("rate = '5'").count()
    deliver(raw.filter("rate <> '5'"), src)
    ingest_new(spark, src, dst, checkpoint, files_per_batch=1)
    assert spark.read.parquet(dst).count() == raw.count()


@pytest.fixture(scope="module")
def refreshed(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("run")
    deliver(raw_reviews(spark, SMALL), f"{base}/raw")
    settings = dict(rules=TEST_RULES, min_reviews=1, min_word_uses=20, model={"max_iter": 3})
    first = refresh(spark, Refresh(raw=f"{base}/raw", out=f"{base}/day1", database="shop", **settings))
    second = refresh(spark, Refresh(raw=f"{base}/raw", out=f"{base}/day2", previous=f"{base}/day1", **settings))
    return base, first, second


def test_refresh_builds_every_table(spark, refreshed):
    base, first, _ = refreshed
    counts = {r["table"]: r["rows"] for r in first["load_counts"].collect()}
    assert counts["silver"] == counts["star.fact_reviews"] == 194
    assert all(n > 0 for n in counts.values())
    steps = spark.read.csv(f"{base}/day1/quality_report", header=True, inferSchema=True).orderBy("step").collect()
    assert [r["rows"] for r in steps] == [225, 200, 197, 196, 194]
    assert "refreshed_at" in first["mart.fact_review_aggregate"].columns


def test_refresh_leaves_tables_checks_and_analyses(spark, refreshed):
    base, first, _ = refreshed
    report = {r["rule"]: r["violations"] for r in first["checks"].collect()}
    assert "unique review_key" in report and "orphans of dim_product" in report and set(report.values()) == {0}
    assert spark.table("shop.gold_model_metrics").count() == 4
    assert spark.table("shop.reviews").count() == first["silver"].count()
    answers = [spark.read.parquet(f"{base}/day1/analyses/q{n:02d}") for n in range(1, 11)]
    assert answers[0].count() > 0 and answers[9].count() > 0


def test_a_violation_stops_the_run(spark):
    report = spark.createDataFrame([("rating 1..5", 2), ("other", 0)], "rule string, violations long")
    with pytest.raises(RefreshFailed, match="rating 1..5: 2"):
        checked(report)
    assert checked(report.filter("violations = 0")).count() == 1


def test_second_refresh_changes_nothing(refreshed, rows):
    _, first, second = refreshed
    for name in first:
        if name.startswith(("mart.", "star.")) or name in ("silver", "cube", "products"):
            assert rows(second[name].drop("refreshed_at")) == rows(first[name].drop("refreshed_at")), name


def test_refresh_stops_at_the_first_failure(spark, tmp_path):
    with pytest.raises(Exception):
        refresh(spark, Refresh(raw=f"{tmp_path}/nothing", out=f"{tmp_path}/out"))
    assert not (tmp_path / "out").exists()


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(statements()) <= set(QUERIES) <= set(entry.queries())
    assert len(QUERIES) - len(statements()) == 4


@pytest.mark.parametrize("name", sorted(statements()))
def test_query_equals_duckdb(spark, name):
    df = entry.queries()[name](spark, SMALL)
    result = compare.connect(SMALL).execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert compare.normal(df.collect(), df.columns) == compare.normal(result.fetchall(), columns)


def test_no_query_uses_python_workers_or_cross_joins(spark):
    for name, run in QUERIES.items():
        if name.startswith(("ml_weights", "ml_intercepts", "ml_predictions", "ml_score_parity")):
            continue
        text = plan(run(spark, SMALL))
        for word in ("PythonUDF", "ArrowEval", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in text, (name, word)
