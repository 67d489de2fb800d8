"""Reading the feed, landing it as tables, and keeping the results."""

from newsatlas.sources.arrays import pieces, records
from newsatlas.sources.history import (
    append_results,
    expire_results,
    history_page,
    live_results,
    read_results,
    stored_results,
    summary,
    summary_totals,
)
from newsatlas.sources.landing import (
    drop_empty_columns,
    parsed,
    read_json,
    read_landing,
    typed,
    unwrap_number_long,
    write_json,
    write_table,
)
from newsatlas.sources.states import StateStore

__all__ = [name for name in dir() if not name.startswith("_")]
