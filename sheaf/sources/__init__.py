"""Sources: declared schemas, the JSON-lines reader, parquet tables and the role fixtures."""

from sheaf.sources.json import flatten_structs, read_json, read_json_checked, read_table, write_json
from sheaf.sources.schemas import SCHEMAS
from sheaf.sources.tables import TABLES, load

__all__ = ["flatten_structs", "read_json", "read_json_checked", "read_table", "write_json", "SCHEMAS", "TABLES", "load"]
