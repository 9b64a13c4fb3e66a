from obs_engine.sources import journal
from obs_engine.sources.documents import (
    ARRIVED_AT,
    FOUND,
    read_population,
    read_weather,
    stream_weather,
)
from obs_engine.sources.landing import Landing, landed_files, mark_read, unread
from obs_engine.sources.logs import (
    advance_mark,
    append_marks,
    append_run,
    last_mark,
    latest_status,
    new_run_id,
    next_run_id,
    read_marks,
)
from obs_engine.sources.tables import (
    DAY,
    MONTH,
    YEAR,
    Period,
    Upsert,
    append_once,
    append_rows,
    compact_table,
    overwrite_table,
    periods_of,
    read_table,
    table_exists,
    upsert_table,
)

__all__ = [
    "ARRIVED_AT",
    "DAY",
    "FOUND",
    "Landing",
    "MONTH",
    "YEAR",
    "Period",
    "Upsert",
    "advance_mark",
    "append_marks",
    "append_once",
    "append_rows",
    "append_run",
    "compact_table",
    "journal",
    "landed_files",
    "last_mark",
    "latest_status",
    "mark_read",
    "new_run_id",
    "next_run_id",
    "overwrite_table",
    "periods_of",
    "read_marks",
    "read_population",
    "read_table",
    "read_weather",
    "stream_weather",
    "table_exists",
    "unread",
    "upsert_table",
]
