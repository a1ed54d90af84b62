"""Number of parallel tasks a job asks for."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

def target_partitions(lines: int, per_worker: int, most: int = 8, as_written: bool = False) -> int:
    """Number of parallel tasks for a job: one per ``per_worker`` lines, at most ``most``.

    ``as_written`` rounds down, so that a job of fewer lines gets none.
    """
    return min(most, lines // per_worker if as_written else math.ceil(lines / per_worker))


def target_partitions_column(lines: Column, per_worker: Column | int, most: int = 8) -> Column:
    """Column form of :func:`target_partitions`."""
    per_worker = per_worker if isinstance(per_worker, Column) else F.lit(per_worker)
    return F.least(F.lit(most), F.ceil(lines / per_worker).cast("int"))
