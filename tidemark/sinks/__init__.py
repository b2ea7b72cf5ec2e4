from .scd_store import read_history, write_feed, write_scd
from .writers import WRITERS, stamp, write_output

__all__ = ["WRITERS", "read_history", "stamp", "write_feed", "write_output", "write_scd"]
