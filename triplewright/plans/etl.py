"""The employee report: Parquet in, CSV out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplewright.sources.sinks import write_csv


def employee_steps(employees: DataFrame, steps_per_floor: int) -> DataFrame:
    """(id, name, steps_to_desk) from (id, first_name, second_name, floor)."""
    return employees.select(
        "id",
        F.concat_ws(" ", "first_name", "second_name").alias("name"),
        (F.col("floor") * F.lit(steps_per_floor)).alias("steps_to_desk"),
    )


def run_employee_report(spark: SparkSession, source: str, target: str, steps_per_floor: int) -> None:
    """Read the employees, compute the report, write it."""
    write_csv(employee_steps(spark.read.parquet(source), steps_per_floor), target)
