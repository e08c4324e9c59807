"""Composite stages of the corpus build (each a DataFrame plan)."""
