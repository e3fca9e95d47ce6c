from tidemark.functions.scalar import (  # noqa: F401
    JAVA_WHITESPACE, bucket_number, col_of, cols_of, day_start, epoch_seconds,
    event_time, java_split, json_item, parse_access_time, render_ts, seconds_to_ts, to_ntz,
    ws_tokens,
)
