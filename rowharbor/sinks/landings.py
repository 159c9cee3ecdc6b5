"""Which landings of a dataset count.

A landing's rows are written to a directory of their own and count from the moment that
a version of ``<root>/_landings`` names it. A reader opens one version and keeps to it.
Versions say what came and what went; every so often one says all, and older ones go.

For every stream the number of its last batch is kept, also after its landings were
compacted into others.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from rowharbor.sinks.versions import Versions

#: Every so many versions one holds all landings.
FULL_EVERY = 64


class Refused(ValueError):
    """A landing that would take the place of one that is not its own."""


@dataclass
class Landings:
    """One version: part of every landing by its id, owner of every landing, and the
    last batch of every stream."""

    version: int = -1
    parts: dict[str, str] = field(default_factory=dict)
    owners: dict[str, str] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)

    def apply(self, change: dict) -> None:
        for land_id in change["gone"]:
            self.parts.pop(land_id, None)
            self.owners.pop(land_id, None)
        for land_id, (part, owner) in change["came"].items():
            self.parts[land_id], self.owners[land_id] = part, owner
        self.batches.update(change["batches"])

    def directory(self, land_id: str) -> str:
        return f"land_id={land_id}/part={self.parts[land_id]}"


def _versions(spark: SparkSession, root: str) -> Versions:
    return Versions(spark, f"{root}/_landings")


def landings(spark: SparkSession, root: str) -> Landings:
    """The newest version of a dataset's landings."""
    versions = _versions(spark, root)
    while True:
        try:
            return _folded(versions)
        except Py4JJavaError as error:  # a fuller version took its place meanwhile
            if "FileNotFoundException" not in error.java_exception.getClass().getName():
                raise


def _folded(versions: Versions) -> Landings:
    found, changes = Landings(), []
    for number in reversed(versions.numbers()):
        change = versions.read(number)
        found.version = max(found.version, number)
        changes.append(change)
        if change["full"]:
            break
    for change in reversed(changes):
        found.apply(change)
    return found


def commit(
    spark: SparkSession,
    root: str,
    came: dict[str, str],
    owner: str = "",
    gone: Iterable[str] = (),
    batch: int | None = None,
) -> Landings:
    """Let the landings ``came`` (part by id) count and those ``gone`` no more, all at
    once. A landing of the same owner is replaced; one of another is not, and what is to
    go must still be there. ``batch`` is the owner's, if it is a stream."""
    versions, gone = _versions(spark, root), list(gone)
    while True:
        now = landings(spark, root)
        if taken := sorted(i for i in came if now.owners.get(i, owner) != owner):
            raise Refused(f"landings of another owner: {taken}")
        if missing := sorted(i for i in gone if i not in now.parts):
            raise Refused(f"landings that are gone already: {missing}")
        change = {
            "came": {i: [part, owner] for i, part in came.items()},
            "gone": gone,
            "batches": {} if batch is None else {owner: batch},
            "full": False,
        }
        number = now.version + 1
        now.apply(change)
        if number % FULL_EVERY == 0:
            everything = {i: [part, now.owners[i]] for i, part in now.parts.items()}
            change = {"came": everything, "gone": [], "batches": now.batches, "full": True}
        if versions.publish(number, change):
            if change["full"]:
                for old in versions.numbers():
                    if old < number - FULL_EVERY:  # readers of the last ones may still look
                        versions.remove(old)
            now.version = number
            return now
