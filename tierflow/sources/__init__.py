"""Reading and writing of tables."""

from tierflow.sources.csvfile import load_csv, read_csv
from tierflow.sources.jdbc import import_tables, read_jdbc, remainder_predicates
from tierflow.sources.partitioned import read_partitions, refresh_partitions, write_partitions
from tierflow.sources.paths import (
    delete,
    exists,
    recover,
    replace_folder,
    scratch,
    settled,
    shared_folder,
)
from tierflow.sources.tables import (
    drop_table,
    external_table,
    publish,
    read_raw,
    read_silver,
    read_table,
    rename_table,
    save_table,
    use_database,
    write_raw,
    write_silver,
)
from tierflow.sources.versions import (
    Commit,
    CommitConflict,
    commit,
    commit_tables,
    committed_versions,
    load_commit,
    read_version,
    vacuum,
    write_data,
)

__all__ = [
    "Commit",
    "CommitConflict",
    "commit",
    "commit_tables",
    "committed_versions",
    "delete",
    "drop_table",
    "exists",
    "external_table",
    "import_tables",
    "load_commit",
    "load_csv",
    "publish",
    "read_csv",
    "read_jdbc",
    "read_partitions",
    "read_raw",
    "read_silver",
    "read_table",
    "read_version",
    "recover",
    "refresh_partitions",
    "remainder_predicates",
    "rename_table",
    "replace_folder",
    "save_table",
    "scratch",
    "settled",
    "shared_folder",
    "use_database",
    "vacuum",
    "write_data",
    "write_partitions",
    "write_raw",
    "write_silver",
]
