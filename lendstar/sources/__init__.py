"""Sources and sinks: delimited files, parquet, JDBC, versioned publish."""

from lendstar.sources.files import (exists, first_available, read_delimited, read_jdbc,
                                    read_parquet, split_corrupt, write_jdbc,
                                    write_delimited)
from lendstar.sources.versioned import (current_version, publish, read_current,
                                        read_month, write_by_month)

__all__ = [
    "exists", "first_available", "read_delimited", "read_jdbc", "read_parquet", "split_corrupt",
    "write_jdbc", "write_delimited", "current_version", "publish", "read_current", "read_month",
    "write_by_month",
]
