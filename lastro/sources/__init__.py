from lastro.sources.deliveries import append_history, read_csv
from lastro.sources.ledger import load_deliveries, read_ledger
from lastro.sources.scratch import Scratch, new_path, shared_folder, stage
from lastro.sources.tables import drop_table, ensure_schema, scan, write_table
from lastro.sources.versions import Release, snapshot

__all__ = [
    "Release",
    "Scratch",
    "append_history",
    "drop_table",
    "ensure_schema",
    "load_deliveries",
    "new_path",
    "read_csv",
    "read_ledger",
    "scan",
    "shared_folder",
    "snapshot",
    "stage",
    "write_table",
]
