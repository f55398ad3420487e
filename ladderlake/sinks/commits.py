"""Optimistic commits: of merges that overlap in time, one changes the table and the others fail.

A table has a folder of numbered commits. A merge notes the latest number when it starts to
read and claims the next one, by creating its file exclusively, before it points the catalog at
its own files. If another merge has claimed that number since, what this one read may be out of
date, and it fails before it has changed anything. A claim that is not closed yet belongs to a
merge that is still switching, or was lost with its driver; after `LEASE` seconds it no longer
keeps others from starting.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import SparkSession

from ladderlake.sinks.workspace import children, create_new

#: Seconds after which a claim that nobody closed counts as broken off.
LEASE = 3600.0
_CLOSED = ".done"


class ConcurrentMerge(RuntimeError):
    """Another merge changed the table meanwhile, or is changing it now; run this one again."""


@dataclass(frozen=True)
class Commits:
    """The commits of one table."""

    folder: str

    def start(self, spark: SparkSession) -> int:
        """The latest commit, which the merge reads; raises while one is under way."""
        found = children(spark, self.folder)
        latest = _latest(found)
        if latest and _name(latest) + _CLOSED not in found:
            if time.time() - found[_name(latest)] < LEASE:
                raise ConcurrentMerge(f"commit {latest} of {self.folder} is under way")
        return latest

    def claim(self, spark: SparkSession, read: int) -> int:
        """Claim the commit after the one that was read; raises if there is a newer one."""
        mine = read + 1
        if not create_new(spark, f"{self.folder}/{_name(mine)}"):
            raise ConcurrentMerge(f"commit {mine} of {self.folder} was made meanwhile")
        return mine

    def close(self, spark: SparkSession, mine: int) -> None:
        """Let others start: the switch is over, or has failed and can be run again."""
        create_new(spark, f"{self.folder}/{_name(mine)}{_CLOSED}")


def _name(number: int) -> str:
    return f"{number:012d}"


def _latest(names) -> int:
    return max((int(n) for n in names if n.isdigit()), default=0)
