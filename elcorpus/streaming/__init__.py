"""Incremental (Structured Streaming) form of the cleaning stage."""

from elcorpus.streaming.incremental import STATE_STORE, CleanWriter, dedupe_titles, start_incremental_clean

__all__ = ["STATE_STORE", "CleanWriter", "dedupe_titles", "start_incremental_clean"]
