"""Range labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import ColumnLike, as_column

# Bucket bounds and labels as reported.
WIND_MPH = ((5, 15, 25), ("<5 mph", "5-15 mph", "15-25 mph", "25+ mph"))
WIND_KNOTS = ((5, 10, 15), ("<5 kt", "5-10 kt", "10-15 kt", "15+ kt"))
VISIBILITY_MILES = ((1, 3, 5), ("<1 mile", "1-3 miles", "3-5 miles", ">5 miles"))
UNKNOWN = "Unknown"


def bucketize(
    value: ColumnLike, bounds: Sequence[float], labels: Sequence[str], null_label: str | None = None
) -> Column:
    """Label of the half-open range ``[bounds[i-1], bounds[i])`` a value falls in.

    There is one more label than bounds. Without ``null_label`` a NULL gets the top label.
    """
    if len(labels) != len(bounds) + 1:
        raise ValueError("one more label than bounds is needed")
    value = as_column(value)
    # Starting with a condition that is never true keeps the chain uniform.
    chain = F.when(value.isNull() & F.lit(null_label is not None), F.lit(null_label))
    for bound, label in zip(bounds, labels):
        chain = chain.when(value < bound, label)
    return chain.otherwise(labels[-1])
