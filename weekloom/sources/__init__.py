from weekloom.sources.page_store import PageStore, fetch_pages, open_page_store, write_page_store  # noqa: F401
from weekloom.sources.json_records import json_elements, read_json_records  # noqa: F401
from weekloom.sources.readers import (  # noqa: F401
    Source, read_api_errors, read_api_payloads, read_entities, read_page_snapshots, read_panel, read_snapshot_index, typed_entities,
)
from weekloom.sources.writers import entity_records, flatten_report, write_entities, write_panel, write_summary  # noqa: F401
