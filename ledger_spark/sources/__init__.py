"""Reading, writing and staging of tables."""

from .ingest import ingest_json, read_transactions_json, require_keys
from .staging import Staging

__all__ = ["Staging", "ingest_json", "read_transactions_json", "require_keys"]
