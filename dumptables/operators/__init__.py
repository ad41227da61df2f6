from dumptables.operators.files import dump_files
from dumptables.operators.integrity import (
    duplicate_keys,
    first_places,
    first_writers,
    fk_accepted,
    fk_missing_keys,
    fk_violations,
    insert_absent,
    keep_first,
    look_up,
)
from dumptables.operators.metrics import load_totals, pages_per_file, running_totals
from dumptables.operators.pages import assemble_pages
from dumptables.operators.segments import stage_segments, to_segments
from dumptables.operators.tables import (
    contributor_rows,
    namespace_rows,
    page_rows,
    rejected,
    revision_rows,
    siteinfo_rows,
    valid,
)

__all__ = [
    "assemble_pages",
    "contributor_rows",
    "dump_files",
    "duplicate_keys",
    "first_places",
    "first_writers",
    "fk_accepted",
    "fk_missing_keys",
    "fk_violations",
    "insert_absent",
    "keep_first",
    "load_totals",
    "look_up",
    "namespace_rows",
    "page_rows",
    "pages_per_file",
    "rejected",
    "revision_rows",
    "running_totals",
    "to_segments",
    "siteinfo_rows",
    "stage_segments",
    "valid",
]
