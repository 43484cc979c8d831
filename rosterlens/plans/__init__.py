"""Declarative rules compiled to Columns."""
