from dumptables.plans.load import (
    LoadOptions,
    LoadReport,
    RejectedRows,
    Staged,
    load_dump,
    load_records,
    stage,
)
from dumptables.plans.verify import verify_tables

__all__ = [
    "LoadOptions",
    "LoadReport",
    "RejectedRows",
    "Staged",
    "load_dump",
    "load_records",
    "stage",
    "verify_tables",
]
