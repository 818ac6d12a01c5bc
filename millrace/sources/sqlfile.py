"""Run a file of statements separated by semicolons."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def statements(text: str) -> list[str]:
    """Statements without comment lines; a statement must not hold a ';' in a literal."""
    lines = (line for line in text.splitlines() if not line.lstrip().startswith("--"))
    return [part.strip() for part in "\n".join(lines).split(";") if part.strip()]


def run_sql_text(spark: SparkSession, text: str, args: dict | None = None) -> list[DataFrame]:
    """One DataFrame per statement; a statement whose object exists already is skipped."""
    results = []
    for statement in statements(text):
        try:
            results.append(spark.sql(statement, args=args) if args else spark.sql(statement))
        except AnalysisException as err:
            if "ALREADY_EXISTS" not in (err.getCondition() or ""):
                raise
    return results


def run_sql_file(spark: SparkSession, path: str, args: dict | None = None) -> list[DataFrame]:
    """Same, for a script in any file system Spark can read."""
    text = "\n".join(row.value for row in spark.read.text(path, wholetext=True).collect())
    return run_sql_text(spark, text, args)
