"""The queries of the repository over the test tables, each with SQL that checks it."""

from catalogue.registry import ORACLES, QUERIES  # noqa: F401
from catalogue import (  # noqa: F401
    history_queries,
    incremental_queries,
    monitoring_queries,
    quality_queries,
    relational_queries,
    scalar_queries,
    source_queries,
    stream_queries,
)
