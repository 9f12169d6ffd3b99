from .tables import read_table, event_items, with_slots, documents_tokens, distinct_urls
from .files import (read_events_csv, read_query_log_tokens, read_url_list)
from .sinks import write_json, write_tsv

__all__ = [
    "read_table", "event_items", "with_slots", "documents_tokens", "distinct_urls",
    "read_events_csv", "read_query_log_tokens", "read_url_list", "write_json", "write_tsv",
]
