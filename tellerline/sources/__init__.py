"""Staged files, layer tables, publishing and the run log."""

from tellerline.sources.audit import history, record_run
from tellerline.sources.buckets import split_buckets
from tellerline.sources.lease import LeaseHeld, LeaseLost
from tellerline.sources.publish import PublishUnderway, consistent, publish_labelled, recover, settle
from tellerline.sources.staged import read_staged
from tellerline.sources.tables import (
    checkpoint_dir,
    create_layer_tables,
    ensure_layer,
    read_table,
    stream_table,
    table_path,
)

__all__ = [
    "LeaseHeld",
    "LeaseLost",
    "PublishUnderway",
    "checkpoint_dir",
    "consistent",
    "create_layer_tables",
    "ensure_layer",
    "history",
    "publish_labelled",
    "read_staged",
    "read_table",
    "record_run",
    "recover",
    "settle",
    "split_buckets",
    "stream_table",
    "table_path",
]
