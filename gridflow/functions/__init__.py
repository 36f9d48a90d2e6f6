"""Column expressions. All are built-in Spark functions, so they stay in generated code."""

from .measures import (
    average,
    cost_estimate,
    load_direction,
    load_label,
    net_load,
    pct_capped,
    renewable_pct,
)
from .text import detail_json, event_time, label_time, padded_key, try_number

__all__ = [
    "average", "cost_estimate", "detail_json", "event_time", "label_time", "load_direction",
    "load_label", "net_load", "padded_key", "pct_capped", "renewable_pct", "try_number",
]
