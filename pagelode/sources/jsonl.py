"""JSON lines with a fixed schema; unreadable lines are set aside, not dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_SCHEMA = "id int, title string, content string, categories array<string>"
REQUIRED = ("id", "title", "content", "categories")


def _status(line: Column, corrupt: Column, required: list[Column]) -> Column:
    complete = F.lit(True)
    for value in required:
        complete = complete & value.isNotNull()
    return F.when(F.trim(line) == "", "blank").when(corrupt.isNull() & complete, "ok").otherwise("bad")


def parse_lines(lines: DataFrame, line: str = "line", schema: str = PAGE_SCHEMA, required=REQUIRED) -> DataFrame:
    """Add ``record`` and ``status`` (ok, blank, bad) to text lines. A line is good if it is
    one object of the schema with all required fields."""
    parsed = F.from_json(
        F.col(line),
        f"{schema}, _corrupt string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"},
    )
    with_record = lines.withColumn("record", parsed)
    fields = [F.col(f"record.{name}") for name in required]
    return with_record.withColumn("status", _status(F.col(line), F.col("record._corrupt"), fields))


def read_pages(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)`` of JSON-lines files: typed page rows, and the lines that could not be
    read. Blank lines are in neither."""
    lines = parse_lines(spark.read.text(path).withColumnRenamed("value", "line"))
    good = lines.filter("status = 'ok'").select("record.id", "record.title", "record.content", "record.categories")
    return good, lines.filter("status = 'bad'").select("line")
