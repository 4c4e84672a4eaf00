"""Builds that go on after a failure and are published in one step.

A *run folder* has one Parquet table for each view and, beside it, a small file with the view's
*fingerprint*, written when the table is complete. The fingerprint covers the view's name, the source files (path, size,
time of change), the study's concepts and rules, the library's version of the build, and the fingerprints of the views it
is made from. A run that finds a table with the fingerprint it would give reads it; all others are
written anew. So a failed run goes on from its last complete views, and a changed source or concept rebuilds what depends on it.

A *root* holds runs and a pointer to the published one. The pointer is replaced by one rename after
all views of a run are complete; a reader resolves it once and then reads one run only.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

from stayframe.operators.scale import in_parallel
from stayframe.sources import files

#: raise when views change their meaning
VERSION = 1
POINTER = "CURRENT"


@dataclass(frozen=True)
class Step:
    """One table of a build: what it is made from, and how."""

    name: str
    needs: tuple[str, ...]
    make: Callable[[dict[str, DataFrame]], DataFrame]


def source_fingerprint(spark: SparkSession, tables: dict[str, DataFrame], settings: str) -> str:
    """Digest of the tables' files and of the settings; tables without files count by their plan."""
    described = {}
    for name, table in sorted(tables.items()):
        paths = list(table.inputFiles()) if table is not None else []
        plan = "" if paths or table is None else table._jdf.queryExecution().analyzed().canonicalized().toString()
        described[name] = [files.listing(spark, paths), plan, None if table is None else table.schema.simpleString()]
    return hashlib.sha256(json.dumps([VERSION, described, settings], default=str).encode()).hexdigest()


@dataclass
class Run:
    """A run folder and what is complete in it."""

    spark: SparkSession
    folder: str
    source: str
    stored: dict[str, DataFrame] = field(default_factory=dict)
    made: list[str] = field(default_factory=list)
    marks: dict[str, str] = field(default_factory=dict)
    lock: Lock = field(default_factory=Lock)

    def _mark(self, name: str) -> str:
        return f"{self.folder}/{name}.fingerprint"

    def fingerprint(self, step: Step) -> str:
        parts = [step.name, self.source, *[f"{n}={self.marks[n]}" for n in step.needs]]
        return hashlib.sha256("\n".join(parts).encode()).hexdigest()

    def step(self, step: Step) -> None:
        """Read the step's table if it is complete as it would be made now; else make and write it."""
        path, wanted = f"{self.folder}/{step.name}", self.fingerprint(step)
        if files.read_text(self.spark, self._mark(step.name)) == wanted:
            found = self.spark.read.parquet(path)
        else:
            files.delete(self.spark, self._mark(step.name))
            made = step.make(self.stored)
            made.write.mode("overwrite").parquet(path)
            files.replace_text(self.spark, self._mark(step.name), wanted)
            found = self.spark.read.schema(made.schema).parquet(path)
            with self.lock:
                self.made.append(step.name)
        with self.lock:
            self.stored[step.name], self.marks[step.name] = found, wanted

    def all(self, steps: list[Step]) -> dict[str, DataFrame]:
        """Run the steps, each as soon as a wave of those before it is done."""
        waiting = list(steps)
        while waiting:
            ready = [s for s in waiting if all(n in self.stored for n in s.needs)]
            if not ready:
                raise ValueError("steps need each other: " + ", ".join(s.name for s in waiting))
            in_parallel([partial(self.step, s) for s in ready])
            waiting = [s for s in waiting if s not in ready]
        return self.stored


def publish(spark: SparkSession, root: str, run: str, names: list[str]) -> None:
    """Make the run (a folder under ``root``) the published one; all its views must be complete."""
    missing = [n for n in names if files.read_text(spark, f"{root}/{run}/{n}.fingerprint") is None]
    if missing:
        raise ValueError("not complete: " + ", ".join(missing))
    files.replace_text(spark, f"{root}/{POINTER}", json.dumps({"run": run, "views": names}))


def published(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Views of the published run, all of one run; the pointer is read once."""
    text = files.read_text(spark, f"{root}/{POINTER}")
    if text is None:
        raise FileNotFoundError(f"nothing is published under {root}")
    pointer = json.loads(text)
    return {name: spark.read.parquet(f"{root}/{pointer['run']}/{name}") for name in pointer["views"]}
