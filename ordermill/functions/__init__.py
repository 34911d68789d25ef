"""Column builders: every cleaning rule as a built-in expression, with no Python per row."""

from .money import eur_amount, line_amount
from .product import canonical_sku, inferred_category
from .text import strip
from .time import parse_order_ts, ts_format, utc_date

__all__ = [
    "canonical_sku",
    "eur_amount",
    "inferred_category",
    "line_amount",
    "parse_order_ts",
    "strip",
    "ts_format",
    "utc_date",
]
