"""What all jobs share: skipping an empty day, and counting what is written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def written(source: DataFrame, transform: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame], int]) -> int:
    """The number of rows that transform makes of source, as the writer counts them; 0, and nothing is written, if source is empty."""
    return 0 if source.isEmpty() else write(transform(source))
