"""Where the mart's inputs come from."""

from lineledger.sources.database import database_reader, date_predicates, read_source
from lineledger.sources.extract import extract_name, read_extract, write_extract
from lineledger.sources.tables import Reader, Sources, catalog_reader, conform, load_sources, parquet_reader

__all__ = [
    "Reader",
    "Sources",
    "catalog_reader",
    "conform",
    "database_reader",
    "date_predicates",
    "extract_name",
    "load_sources",
    "parquet_reader",
    "read_extract",
    "read_source",
    "write_extract",
]
