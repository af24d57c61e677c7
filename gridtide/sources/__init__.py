from gridtide.sources.landing import land_csv, land_json
from gridtide.sources.progress import commit_marks, high_water, hours_since, marks
from gridtide.sources.tables import (
    append_table, ensure_schema, fresh_table, insert_new_table, land_table, read_days_of, read_table, replace_from,
    replace_marked, table_exists, upsert_newest, upsert_table,
)

__all__ = [
    "append_table", "commit_marks", "ensure_schema", "fresh_table", "high_water", "hours_since", "insert_new_table", "land_csv",
    "land_json", "land_table", "marks", "read_days_of", "read_table", "replace_from", "replace_marked", "table_exists",
    "upsert_newest", "upsert_table",
]
