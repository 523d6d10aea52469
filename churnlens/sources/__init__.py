from .events import (adapt_events, load_clickstream, load_events_table, preview, read_events,
                     schema_of)
from .sinks import load_pipeline, read_table, save_pipeline, write_table

__all__ = [
    "adapt_events", "load_clickstream", "load_events_table", "preview", "read_events",
    "schema_of", "load_pipeline", "read_table", "save_pipeline", "write_table",
]
