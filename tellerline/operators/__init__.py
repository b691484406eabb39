"""DataFrame -> DataFrame operators; none of them reads or writes a table."""

from tellerline.operators.conform import assert_schema, conform
from tellerline.operators.dedupe import dedupe_earliest, dedupe_latest
from tellerline.operators.intervals import in_intervals, key_intervals
from tellerline.operators.history import changed_current, scd2_apply, scd2_staged
from tellerline.operators.keyfilter import groups_that_may_hold, key_fragments
from tellerline.operators.merge import (
    insert_if_absent,
    matching_rows,
    upsert_if_changed,
    upsert_latest,
)
from tellerline.operators.versions import spliced, version_chain

__all__ = [
    "assert_schema",
    "changed_current",
    "conform",
    "dedupe_earliest",
    "dedupe_latest",
    "groups_that_may_hold",
    "in_intervals",
    "insert_if_absent",
    "key_fragments",
    "key_intervals",
    "matching_rows",
    "scd2_apply",
    "scd2_staged",
    "spliced",
    "upsert_if_changed",
    "upsert_latest",
    "version_chain",
]
