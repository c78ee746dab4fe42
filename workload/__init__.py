"""Registered queries over the supplied tables, each with SQL to compare against."""

from workload import (  # noqa: F401
    coverage_queries,
    delay_queries,
    function_queries,
    join_queries,
    source_queries,
)
from workload.registry import QUERIES  # noqa: F401
