from . import files
from .versions import APPEND, LEDGER, REPLACE, VersionedTable

__all__ = ["APPEND", "LEDGER", "REPLACE", "VersionedTable", "files"]
