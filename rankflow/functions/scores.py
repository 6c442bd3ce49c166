"""Column functions on scores and metric values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Computed scores are rounded, so that equal scores summed in another order still tie.
# Sums of a few terms below 1 keep 12 places, long sums of larger terms 9.
FUSED_PLACES = 12
LEXICAL_PLACES = 9


def positive_softmax(logits: Column | str, positive: int = 1) -> Column:
    """Softmax probability of the class at index ``positive``."""
    logits = F.col(logits) if isinstance(logits, str) else logits
    top = F.array_max(logits)
    weights = F.transform(logits, lambda x: F.exp(x - top))
    total = F.aggregate(weights, F.lit(0.0), lambda acc, w: acc + w)
    return F.get(weights, F.lit(positive)) / total


def as_percent(results: DataFrame, places: int = 2) -> DataFrame:
    """Every DOUBLE metric column as a percentage."""
    return results.select(
        *[
            F.round(F.col(f"`{f.name}`") * 100, places).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in results.schema.fields
        ]
    )
