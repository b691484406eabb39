"""Leases: who may move a table's files.

A lease is a small file that is made only where there is none. It names its owner, who renews
its time while at work. One that has not been renewed for long was left by a lost driver and may be taken
over; its former owner, should it still live, finds another name in the file and stops.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession

from tellerline.params import JobConfig
from tellerline.schemas import TableSpec
from tellerline.sources import files


class LeaseHeld(RuntimeError):
    """Another writer of the table is at work."""


class LeaseLost(RuntimeError):
    """Another writer has taken the table over."""


def lease_path(config: JobConfig, spec: TableSpec) -> str:
    return f"{config.layer_root(spec.layer)}/_lease/{spec.name}"


def _owner(spark: SparkSession, path: str) -> str | None:
    try:
        return files.read_text(spark, path)
    except Exception:
        if files.exists(spark, path):
            raise
        return None


class Lease:
    """Held from ``with`` on. Waits for a living owner as long as that owner's lease may last unrenewed, then gives up."""

    def __init__(self, spark: SparkSession, config: JobConfig, spec: TableSpec):
        self.spark, self.path, self.seconds = spark, lease_path(config, spec), config.publish_grace_seconds
        self.owner = uuid.uuid4().hex
        self._renewed = 0.0

    def __enter__(self) -> Lease:
        deadline = time.monotonic() + self.seconds
        while not files.create_new(self.spark, self.path, self.owner):
            holder, age = _owner(self.spark, self.path), files.age_seconds(self.spark, self.path)
            if age is not None and age >= self.seconds:
                self._clear(holder)
            elif time.monotonic() >= deadline:
                raise LeaseHeld(f"{self.path} is held by {holder}")
            else:
                time.sleep(min(1.0, max(0.01, self.seconds / 10)))
        self._renewed = time.monotonic()
        return self

    def _clear(self, holder: str | None) -> None:
        """Put an abandoned lease aside. If it is another's by now, it is put back."""
        aside = f"{self.path}.{self.owner}"
        if not files.move_if_there(self.spark, self.path, aside):
            return
        if _owner(self.spark, aside) == holder:
            files.remove_dir(self.spark, aside)
        elif not files.exists(self.spark, self.path):
            files.move_if_there(self.spark, aside, self.path)

    def renew(self) -> None:
        """To be called before every step: raises if the lease is no longer this one's."""
        if _owner(self.spark, self.path) != self.owner:
            raise LeaseLost(f"{self.path} was taken over")
        if time.monotonic() - self._renewed > self.seconds / 4:
            files.freshen(self.spark, self.path)
            self._renewed = time.monotonic()

    def __exit__(self, kind, error, trace) -> None:
        if _owner(self.spark, self.path) == self.owner:
            files.remove_dir(self.spark, self.path)
