"""Sources and sinks: Parquet tables on any Hadoop filesystem, the versioned
snapshot store, and adapters that shape the driver's test tables."""

from registrum.sources.parquet import MissingInput, exists, read_table, require
from registrum.sources.store import SnapshotStore

__all__ = ["MissingInput", "SnapshotStore", "exists", "read_table", "require"]
