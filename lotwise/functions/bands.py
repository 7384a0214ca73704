"""Price bands of an ad."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bounds and names of the price bands.
BANDS = ((1000000, "budget"), (3000000, "middle"), (5000000, "premium"))
TOP, MISSING = "luxury", "no price"


def price_band(price: Column, scale: float = 1.0) -> Column:
    """The band of a price; ``scale`` shrinks the bounds for data in another currency."""
    band = F.when(price.isNull(), MISSING)
    for bound, name in BANDS:
        band = band.when(price < bound * scale, name)
    return band.otherwise(TOP)


def price_band_sql(scale: float = 1.0) -> str:
    """The same rule as the body of a SQL function of ``price``."""
    cases = " ".join(f"WHEN price < {bound * scale} THEN '{name}'" for bound, name in BANDS)
    return f"CASE WHEN price IS NULL THEN '{MISSING}' {cases} ELSE '{TOP}' END"
