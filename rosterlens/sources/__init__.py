"""Readers, projections and sinks."""
