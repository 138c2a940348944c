"""Readers, the binding to the driver's tables, and sinks."""
