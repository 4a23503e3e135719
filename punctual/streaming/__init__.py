"""Structured Streaming: replayed envelopes, rolling metrics, scoring, observation enrichment."""

from . import envelopes, enrichment, rolling, scoring, sinks

__all__ = ["envelopes", "enrichment", "rolling", "scoring", "sinks"]
