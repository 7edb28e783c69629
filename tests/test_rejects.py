import pytest

from plaudit.plans.refresh import Refresh, RefreshFailed, checked, marked_bronze
from plaudit.sources import rejects as R
from plaudit.streaming.ingest import ingest_new

HEADER = "ProductName,Price,Rate,Review,Summary\n"


def outcome(marked):
    kept = sorted(r["product_name"] or "" for r in R.kept(marked).collect())
    return kept, sorted((r["reason"], r[R.RECORD]) for r in R.rejects(marked).collect())


def test_records_without_the_fields_of_the_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        HEADER + 'pen,10,5,ok,"fine, really"\ncup,3,4,good\nbox,1,2,so,so,more\n\n   \n,,,,\n"a ""b"", c",1,5,ok,"x,y"\n"lid, red",2\nbag,1,5,"one,two\n'
    )
    kept, rejected = outcome(R.read_marked(spark, str(tmp_path)))
    assert kept == ["", 'a "b", c', "pen"]
    reasons = dict((record, reason) for reason, record in rejected)
    assert reasons.pop("cup,3,4,good") == "too few fields"
    assert reasons.pop("box,1,2,so,so,more") == "too many fields"
    assert reasons.pop('"lid, red",2') == "too few fields"
    assert reasons == {'bag,1,5,"one,two': "unclear quotes"}


def test_selecting_few_columns_marks_the_same_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "pen,10,5,ok,fine\ncup,3\n")
    marked = R.read_marked(spark, str(tmp_path))
    assert [r[0] for r in R.kept(marked).select("rate").collect()] == ["5"]
    assert R.kept(marked).count() == R.rejects(marked).count() == 1


def test_another_header_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Rate,ProductName,Price,Summary,Review\n5,pen,10,fine,ok\n")
    with pytest.raises(Exception, match="header"):
        R.read_marked(spark, str(tmp_path)).collect()


def test_files_without_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER)
    (tmp_path / "b.csv").write_text("")
    marked = R.read_marked(spark, str(tmp_path))
    assert outcome(marked) == ([], [])
    assert R.lost_records(R.raw_lines(spark, str(tmp_path)), marked).first()["violations"] == 0


def test_every_ingested_record_is_kept_or_rejected(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.csv").write_text(HEADER + "pen,10,5,ok,fine\ncup,3\n\nbox,1,2,so,so,more\n")
    (raw / "b.csv").write_text(HEADER + "pot,10,5,ok,fine\n")
    job = Refresh(raw=str(raw), out=f"{tmp_path}/out")
    ingest_new(spark, str(raw), f"{raw}-bronze", f"{raw}-ingested")
    marked = marked_bronze(spark, job)
    assert outcome(marked)[0] == ["pen", "pot"] and R.rejects(marked).count() == 2
    files = {r[R.FILE].rsplit("/", 1)[1] for r in R.rejects(marked).collect()}
    assert files == {"a.csv"}
    lines = R.raw_lines(spark, str(raw))
    assert checked(R.lost_records(lines, marked)).count() == 1
    with pytest.raises(RefreshFailed, match="records kept or rejected: 1"):
        checked(R.lost_records(lines, R.rejects(marked).select(R.FILE)))
    (raw / "c.csv").write_text(HEADER + "late,1,1,ok,fine\n")  # not ingested yet
    assert R.lost_records(R.raw_lines(spark, str(raw)), marked).first()["violations"] == 0


def test_bronze_from_before_there_were_marks(spark, tmp_path):
    old = spark.createDataFrame([("pen", "1", "5", "ok", "fine")], ", ".join(f"{c} string" for c in R.BRONZE_COLUMNS))
    old.write.parquet(f"{tmp_path}/raw-bronze")
    marked = marked_bronze(spark, Refresh(raw=f"{tmp_path}/raw", out=f"{tmp_path}/out"))
    assert outcome(marked) == (["pen"], [])
