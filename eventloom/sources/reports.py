"""Test-report files: JUnit XML and per-suite JSON results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _text(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


_OUTCOME = T.StructType(_text("_VALUE", "_message", "_type"))
_CASE = T.StructType(
    [
        *_text("_name", "_classname", "_time"),
        T.StructField("failure", _OUTCOME),
        T.StructField("error", _OUTCOME),
        T.StructField("skipped", _OUTCOME),
    ]
)
_SUITE = T.StructType(
    [
        *_text("_name", "_timestamp", "_tests", "_failures", "_errors", "_skipped", "_time"),
        T.StructField("testcase", T.ArrayType(_CASE)),
    ]
)


def _int(name: str) -> Column:
    return F.coalesce(F.col(name).try_cast("bigint"), F.lit(0).cast("bigint"))


def _seconds(column: Column) -> Column:
    return F.coalesce(column.try_cast("double"), F.lit(0.0))


def _suites(spark: SparkSession, path: str, environment: str) -> DataFrame:
    suites = spark.read.format("xml").option("rowTag", "testsuite").schema(_SUITE).load(path)
    stamp = F.coalesce(F.try_to_timestamp(F.col("_timestamp")), F.current_timestamp())
    return suites.select(
        "*",
        F.coalesce("_name", F.lit("Unknown Suite")).alias("suite_name"),
        stamp.alias("timestamp"),
        F.lit(environment).alias("environment"),
    )


def read_junit_suites(spark: SparkSession, path: str, environment: str = "unknown") -> DataFrame:
    rows = _suites(spark, path, environment).select(
        "suite_name",
        _int("_tests").alias("total_tests"),
        (_int("_failures") + _int("_errors")).alias("failed_tests"),
        _int("_skipped").alias("skipped_tests"),
        _seconds(F.col("_time")).alias("duration"),
        "timestamp",
        "environment",
    )
    passed = F.col("total_tests") - F.col("failed_tests") - F.col("skipped_tests")
    rate = F.when(F.col("total_tests") > 0, passed / F.nullif("total_tests", F.lit(0)) * 100)
    return rows.select(
        "suite_name",
        "total_tests",
        passed.alias("passed_tests"),
        "failed_tests",
        "skipped_tests",
        "duration",
        F.coalesce(rate, F.lit(0.0)).alias("success_rate"),
        "timestamp",
        "environment",
    )


def read_junit_cases(spark: SparkSession, path: str, environment: str = "unknown") -> DataFrame:
    cases = _suites(spark, path, environment).select(
        "suite_name", "timestamp", "environment", F.explode("testcase").alias("c")
    )

    def message(kind: str) -> Column:
        text = F.nullif(F.trim(F.col(f"c.{kind}._VALUE")), F.lit(""))
        return F.coalesce(text, F.col(f"c.{kind}._message"))

    def choose(failure: Column, error: Column, skipped: Column, passed: Column) -> Column:
        return (
            F.when(F.col("c.failure").isNotNull(), failure)
            .when(F.col("c.error").isNotNull(), error)
            .when(F.col("c.skipped").isNotNull(), skipped)
            .otherwise(passed)
        )

    none = F.lit(None).cast("string")
    return cases.select(
        F.col("c._name").alias("test_name"),
        F.col("suite_name").alias("test_suite"),
        choose(F.lit("FAILED"), F.lit("FAILED"), F.lit("SKIPPED"), F.lit("PASSED")).alias("status"),
        _seconds(F.col("c._time")).alias("duration"),
        "timestamp",
        choose(message("failure"), message("error"), message("skipped"), none)
        .alias("error_message"),
        choose(
            F.coalesce("c.failure._type", F.lit("Failure")),
            F.coalesce("c.error._type", F.lit("Error")),
            F.lit("Skipped"),
            none,
        ).alias("error_type"),
        F.coalesce("c._classname", "suite_name").alias("test_file"),
        "environment",
        none.alias("component"),
    )


def read_suite_results(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """``*-results.json`` files, one object each, with the defaults of absent fields.

    For many runs write one object per line into few files and read those with ``lines``.
    """
    schema = T.StructType(
        [*_text("test_suite", "status"), T.StructField("duration_seconds", T.DoubleType())]
    )
    rows = spark.read.schema(schema).option("multiLine", not lines).json(path)
    return rows.select(
        F.coalesce("test_suite", F.lit("unknown")).alias("test_suite"),
        F.coalesce("status", F.lit("UNKNOWN")).alias("status"),
        F.coalesce("duration_seconds", F.lit(0.0)).alias("duration_seconds"),
    )
