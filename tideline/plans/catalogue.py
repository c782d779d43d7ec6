"""All registered queries."""

from tideline.plans import (  # noqa: F401
    row_queries,
    state_queries,
    stream_queries,
    window_queries,
)
from tideline.plans.registry import ORACLES, QUERIES  # noqa: F401
