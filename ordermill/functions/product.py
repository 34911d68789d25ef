from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# Product code in the middle of a SKU -> category.
CATEGORY_OF_CODE = {
    "BK": "Books",
    "EL": "Electronics",
    "BE": "Beauty",
    "FA": "Fashion",
    "HK": "Home & Kitchen",
    "SP": "Sports",
}

SKU_PARTS = "^SKU-?([A-Z]{2})-?([0-9]{3})$"


def canonical_sku(sku: Column) -> Column:
    """`SKU-XX-NNN` with its dashes restored; any other text only stripped and upper-cased."""
    return F.regexp_replace(F.upper(strip(sku)), SKU_PARTS, "SKU-$1-$2")


def inferred_category(sku: Column) -> Column:
    """Category of a canonical SKU: three dash-separated parts with a known middle one."""
    parts = F.split(sku, "-")
    categories = F.create_map(*[F.lit(word) for word in chain(*CATEGORY_OF_CODE.items())])
    return F.when(F.size(parts) == 3, F.try_element_at(categories, F.get(parts, F.lit(1))))
