"""Batch jobs: rebuild all tables, refresh the forecast, audit what was built."""
