"""Lists as text, code replacement and result labels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import ColumnLike, as_column


def list_label(
    values: ColumnLike, separator: str = ",", empty_label: str = "None", null_label: str | None = "None"
) -> Column:
    """Joined list. An empty list gives ``empty_label``; NULL gives ``null_label`` or stays NULL."""
    values = as_column(values)
    joined = F.when(F.size(values) == 0, empty_label).otherwise(F.array_join(values, separator))
    if null_label is None:
        return joined
    return F.when(values.isNull(), null_label).otherwise(joined)


def contains_any(text: ColumnLike, *parts: str) -> Column:
    """True when the text holds at least one of the parts."""
    text = as_column(text)
    condition = F.lit(False)
    for part in parts:
        condition = condition | text.contains(part)
    return condition


def word_of_code(code: ColumnLike, words: Mapping[str, str]) -> Column:
    """Word of a code, or the lower-cased code where the table has none."""
    code = as_column(code)
    pairs = [F.lit(item) for pair in words.items() for item in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), F.lower(code))


def delay_status(prediction: ColumnLike) -> Column:
    return F.when(as_column(prediction) == 1, "DELAYED").otherwise("On Time")


def probability_text(probability: ColumnLike, digits: int = 3) -> Column:
    return F.format_number(as_column(probability), digits)
