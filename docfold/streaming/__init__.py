"""Incremental arrival of landed snapshots."""
