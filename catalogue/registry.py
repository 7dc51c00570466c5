"""Registration of queries and their SQL twins."""

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from catalogue.views import Views, with_views
from tidemark.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: str = ""):
    """Register ``build(views) -> DataFrame`` and, with the named views as CTEs, its SQL."""

    def register(build):
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Views(configure(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(views, sql)
        return build

    return register
