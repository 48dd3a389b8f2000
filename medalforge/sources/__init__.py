"""Reading and writing layer tables, landing raw files, test-table mapping."""

from .bronze import STRING, ingest, land
from .catalog import Layers, read_table, write_table
from .fixtures import bronze_customer, load_tables, silver_tables

__all__ = ["STRING", "ingest", "land", "Layers", "read_table", "write_table",
           "bronze_customer", "load_tables", "silver_tables"]
