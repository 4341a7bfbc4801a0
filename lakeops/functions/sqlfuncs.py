"""SQL scalar functions. Catalyst inlines them, so no row leaves the JVM."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Texts and grade limits that results must match.
SQL_FUNCTIONS = {
    "get_url": ("email STRING", "STRING", "concat('https://www.', split(email, '@')[1])"),
    "site_type": ("email STRING", "STRING", """
        CASE WHEN email LIKE '%.com' THEN 'Commercial business'
             WHEN email LIKE '%.org' THEN 'Non-profits organization'
             WHEN email LIKE '%.edu' THEN 'Educational institution'
             ELSE concat('Unknow extenstion for domain: ', split(email, '@')[1]) END"""),
    "get_letter_grade": ("gpa DOUBLE", "STRING", """
        CASE WHEN gpa >= 3.5 THEN 'A' WHEN gpa >= 2.75 THEN 'B' WHEN gpa >= 2 THEN 'C'
             ELSE 'F' END"""),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    for name, (args, returns, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) "
                  f"RETURNS {returns} RETURN {body}")
    return list(SQL_FUNCTIONS)
