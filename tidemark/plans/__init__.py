"""Query catalogue: importing it registers every query."""

from tidemark.plans import (  # noqa: F401
    calendar_queries,
    series_queries,
    stream_queries,
    cleaning_queries,
    merge_queries,
    gate_queries,
    table_queries,
    web_queries,
)
from tidemark.plans.registry import ORACLES, QUERIES  # noqa: F401
