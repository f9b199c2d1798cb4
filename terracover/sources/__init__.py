"""Readers, sinks, the driver-table views and the staging folder."""
