"""Column expressions. All of them are built-in Spark expressions; none runs Python per row."""

from . import buckets, numbers, observations, registry, text, times

__all__ = ["buckets", "numbers", "observations", "registry", "text", "times"]
