"""Keys: row identity and repeatable random order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kanaat.functions.fixed_values import DEDUP_PREFIX, SEED


def row_id(*columns: Column) -> Column:
    """Same content, same id, in every run and on every executor."""
    return F.md5(F.concat_ws("‖", *columns))


def shuffle_key(identity: Column, seed: int = SEED) -> Column:
    """Hex digest that orders rows at random, equally in every run."""
    return F.md5(F.concat(F.lit(f"{seed}|"), identity.cast("string")))


def prefix_key(date: Column, text: Column, length: int = DEDUP_PREFIX) -> Column:
    return F.md5(F.concat_ws("‖", date, F.substring(text, 1, length)))
