from . import bindings
from .logs import latest_snapshot, read_results, scan_log
from .snapshots import newest_complete, read_newest, write_snapshot

__all__ = ["bindings", "latest_snapshot", "newest_complete", "read_newest", "read_results", "scan_log", "write_snapshot"]
