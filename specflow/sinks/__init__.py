"""Write frames to files, catalog tables and JDBC tables."""

from specflow.sinks.storage import recover
from specflow.sinks.write import Written, write, write_split

__all__ = ["Written", "recover", "write", "write_split"]
