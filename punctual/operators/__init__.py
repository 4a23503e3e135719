"""DataFrame -> DataFrame building blocks. They take column names and start no Spark job."""

from . import asof, joins, lists, profile, ranking, rolling, shaping, timeframes

__all__ = ["asof", "joins", "lists", "profile", "ranking", "rolling", "shaping", "timeframes"]
