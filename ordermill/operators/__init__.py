"""Relational building blocks shared by the plans."""

from .gapfill import fill_gaps, fill_pair_gaps
from .keyed import insert_ignore, keep_first, unknown_keys, upsert
from .ratejoin import with_pair_rate, with_rate

__all__ = ["fill_gaps", "fill_pair_gaps", "insert_ignore", "keep_first", "unknown_keys", "upsert", "with_pair_rate", "with_rate"]
