from candlelake.sinks.tables import (
    add_missing_columns,
    append_missing_dates,
    delete_folders,
    existing_dates,
    load_delta,
    register_external_table,
    replace_partitions,
    with_month,
    write_by_date,
    write_daily_folder,
    write_partitioned,
)

__all__ = [
    "add_missing_columns",
    "append_missing_dates",
    "delete_folders",
    "existing_dates",
    "load_delta",
    "register_external_table",
    "replace_partitions",
    "with_month",
    "write_by_date",
    "write_daily_folder",
    "write_partitioned",
]
