"""Named SQL scalar functions."""

from pyspark.sql import SparkSession


def create_sql_function(
    spark: SparkSession, name: str, arguments: dict[str, str], returns: str, body: str, temporary: bool = True
) -> None:
    """Create or replace a function with typed arguments; calls are inlined into the plan."""
    typed = ", ".join(f"{argument} {kind}" for argument, kind in arguments.items())
    scope = "temporary " if temporary else ""
    spark.sql(f"create or replace {scope}function {name}({typed}) returns {returns} return {body}")
