"""Raw records that do not have the fields of the header: kept apart, with reason and file.

A record with too few or too many fields is rejected, also where its first fields look sound,
since nobody can tell which field is the missing one.  Empty fields are no fault.  Blank lines
are no records.  A quote that never ends is found only if it changes the number of fields.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from plaudit.sources.raw import BRONZE_COLUMNS, CSV_OPTIONS, RAW_SCHEMA, rename_columns
from plaudit.staging import stage

RECORD, FILE = "rejected_record", "source_file"
MARKED_RAW = StructType(RAW_SCHEMA.fields).add(RECORD, StringType())
MARKED_COLUMNS = (*BRONZE_COLUMNS, RECORD, FILE)
# a header other than the expected one fails the run; all fields are always parsed
MARK_OPTIONS = {**CSV_OPTIONS, "enforceSchema": "false", "columnNameOfCorruptRecord": RECORD, "columnPruning": "false"}


def with_marks(raw: DataFrame) -> DataFrame:
    """Bronze names, the whole record where it is rejected (null where it is sound), and its file."""
    return rename_columns(raw).select(*BRONZE_COLUMNS, RECORD, F.col("_metadata.file_path").alias(FILE))


def read_marked(spark: SparkSession, path: str) -> DataFrame:
    """All records of the CSV files, rejected ones marked.  They are parsed once and staged, as
    Spark answers no query that reads nothing but the mark from the raw files."""
    return stage(with_marks(spark.read.schema(MARKED_RAW).options(**MARK_OPTIONS).csv(path)), "marked")


def kept(marked: DataFrame) -> DataFrame:
    return marked.filter(F.col(RECORD).isNull()).select(*BRONZE_COLUMNS)


def rejects(marked: DataFrame) -> DataFrame:
    """Rejected records with their reason."""
    unquoted = F.regexp_replace(RECORD, '"[^"]*"', "")
    fields = F.size(F.split(unquoted, ","))
    wanted = len(BRONZE_COLUMNS)
    reason = F.when(fields < wanted, "too few fields").when(fields > wanted, "too many fields").otherwise("unclear quotes")
    return marked.filter(F.col(RECORD).isNotNull()).select(FILE, reason.alias("reason"), RECORD)


def lost_records(lines: DataFrame, marked: DataFrame) -> DataFrame:
    """The report row (rule, violations): files whose records in ``marked``, kept and rejected ones
    together, are not as many as their lines without header and blank lines.

    ``lines`` holds ``value`` and ``source_file`` of the raw files.  Files that ``marked`` does
    not name (delivered since, or ingested without marks) and files that are gone are left out.
    """
    filled = F.count_if(F.col("value").rlike("[^\\x00-\\x20]"))
    expected = lines.groupBy(FILE).agg(F.greatest(filled - 1, F.lit(0)).alias("_lines"))
    found = marked.filter(F.col(FILE).isNotNull()).groupBy(FILE).agg(F.count(F.lit(1)).alias("_records"))
    differ = F.count_if(F.col("_lines") != F.col("_records"))
    return expected.join(found, FILE).agg(differ.alias("violations")).select(F.lit("records kept or rejected").alias("rule"), "violations")


def raw_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias(FILE))
