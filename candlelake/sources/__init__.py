from candlelake.sources.files import (
    file_row_counts,
    footer_stats,
    partition_stats,
    read_csv_archive,
    read_daily_folder,
    read_day,
    read_json_lines,
    read_partitioned,
    read_universe,
)
from candlelake.sources.klines import (
    cast_kline_columns,
    decode_kline_arrays,
    decode_kline_messages,
)
from candlelake.sources.ranges import backfill_range, day_range, within_dates
from candlelake.sources.weights import (
    normalise_weights,
    parse_weight_strings,
    weight_string_checks,
    weights_from_string,
)

__all__ = [
    "backfill_range",
    "cast_kline_columns",
    "day_range",
    "decode_kline_arrays",
    "decode_kline_messages",
    "file_row_counts",
    "footer_stats",
    "normalise_weights",
    "parse_weight_strings",
    "partition_stats",
    "read_csv_archive",
    "read_daily_folder",
    "read_day",
    "read_json_lines",
    "read_partitioned",
    "read_universe",
    "weight_string_checks",
    "weights_from_string",
    "within_dates",
]
