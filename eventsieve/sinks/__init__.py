"""Writers for stage tables, reports and the BI export, and the lookup tables."""

from eventsieve.sinks.lookup import LookupTable, save_lookup_table
from eventsieve.sinks.writers import render_timestamps, verify_outputs, write_measured, write_table

__all__ = ["LookupTable", "render_timestamps", "save_lookup_table", "verify_outputs", "write_measured", "write_table"]
