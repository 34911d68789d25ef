"""Landed files in, stored tables in and out."""

from .catalog import add_column, create_tables, list_tables, point_tables_at
from .fx_documents import decode_fx_documents, read_fx_documents
from .order_pages import decode_pages, read_order_pages, read_packed_pages
from .warehouse import Snapshot, Warehouse, month_of

__all__ = [
    "Snapshot",
    "Warehouse",
    "add_column",
    "create_tables",
    "decode_fx_documents",
    "decode_pages",
    "list_tables",
    "month_of",
    "point_tables_at",
    "read_fx_documents",
    "read_order_pages",
    "read_packed_pages",
]
