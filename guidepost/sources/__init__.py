"""Where tables come from and go to."""

from guidepost.sources.catalog import (
    CONTROL_TABLES,
    SOURCE_NAMES,
    ControlTable,
    load_catalog,
    open_catalog,
    store_catalog,
    to_source_names,
)
from guidepost.sources.scratch import (
    drop_scratch,
    drop_table,
    new_scratch_path,
    scratch_folder,
    snapshot,
)
from guidepost.sources.tables import (
    JdbcSource,
    ParquetSource,
    QuantileSplit,
    Split,
    read_table,
    sql_server_source,
    write_table,
)
from guidepost.sources.versions import Version, publish, published_versions, read_version

__all__ = [
    "CONTROL_TABLES",
    "SOURCE_NAMES",
    "ControlTable",
    "JdbcSource",
    "ParquetSource",
    "QuantileSplit",
    "Split",
    "Version",
    "drop_scratch",
    "drop_table",
    "load_catalog",
    "new_scratch_path",
    "open_catalog",
    "publish",
    "published_versions",
    "read_table",
    "read_version",
    "scratch_folder",
    "snapshot",
    "sql_server_source",
    "store_catalog",
    "to_source_names",
    "write_table",
]
