"""Readers: raw event files, stage tables and the driver-table adapter."""

from eventsieve.sources.driver_tables import model_events, raw_events, raw_events_from_driver
from eventsieve.sources.readers import read_raw_csv, read_raw_events, read_stage_table

__all__ = ["model_events", "raw_events", "raw_events_from_driver", "read_raw_csv", "read_raw_events", "read_stage_table"]
