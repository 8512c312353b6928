"""Structured Streaming entry into the same landing path."""

from strata.streaming.landing import stream_source

__all__ = ["stream_source"]
