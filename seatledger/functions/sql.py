"""The pure functions as temporary SQL functions, for use inside spark.sql text."""

from __future__ import annotations

from pyspark.sql import SparkSession

# name -> (parameters, result type, body)
SQL_FUNCTIONS = {
    "tax_amount": (
        "price DECIMAL(18,2), tax_percent DECIMAL(3,2)", "DECIMAL(18,2)",
        "CAST(price * tax_percent * 0.01BD AS DECIMAL(18,2))",
    ),
    "price_after_tax": (
        "price DECIMAL(18,2), tax_percent DECIMAL(3,2)", "DECIMAL(18,2)",
        "CAST(price + CAST(price * tax_percent * 0.01BD AS DECIMAL(18,2)) AS DECIMAL(18,2))",
    ),
    "slot_fits": (
        "start INT, duration INT, slots INT", "BOOLEAN",
        "coalesce(start >= 1 AND duration >= 1 AND start + duration - 1 <= slots, false)",
    ),
}


def register_functions(spark: SparkSession) -> None:
    for name, (parameters, result, body) in SQL_FUNCTIONS.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}"
        )
