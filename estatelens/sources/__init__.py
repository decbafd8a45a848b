"""Where rows come from and where results go."""

from estatelens.sources.catalog import Catalog, conform, malformed_rows, read_catalog, read_jdbc
from estatelens.sources.files import checksum_manifest
from estatelens.sources.literals import literal_table
from estatelens.sources.rowset import read_rowset, write_rowset
from estatelens.sources.schemas import SCHEMAS

__all__ = [
    "SCHEMAS",
    "Catalog",
    "checksum_manifest",
    "conform",
    "literal_table",
    "malformed_rows",
    "read_catalog",
    "read_jdbc",
    "read_rowset",
    "write_rowset",
]
