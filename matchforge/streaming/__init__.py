"""Incremental loads and scoring over file streams (Structured Streaming)."""
