"""Derived tables with dependencies: rebuild what changed, and what depends on it.

A :class:`Source` is a folder of files, an :class:`Asset` a table derived from
sources and other assets.  Every asset has an identity: a hash of its name,
version, parameters and the identities of its inputs; a source's identity comes
from its file listing (relative path, length, modification time), so finding out
what is stale runs no job and reads no data.  An asset is up to date if a complete
table of its identity exists (and is young enough, if a time to live is given);
everything else is built from its inputs' tables and written beside the older ones.
A changed source or parameter therefore rebuilds its descendants and nothing else.

Tables are Parquet folders ``<base>/<asset>/id=<identity>/t=<epoch ms>`` on the
cluster's file system, complete once Spark has put ``_SUCCESS`` there: a build that
dies, or two at the same time, leave no half-written table behind that a reader sees.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from attrition.sources.files import list_files, path_exists, subfolders


@dataclass(frozen=True)
class Source:
    """Input files, read by ``read`` (default: Parquet)."""

    name: str
    path: str
    read: Callable[[SparkSession, str], DataFrame] | None = None


@dataclass(frozen=True)
class Asset:
    """A table built by ``build(inputs, params)``; change ``version`` when the code changes its result."""

    name: str
    inputs: tuple[str, ...]
    build: Callable[[dict[str, DataFrame], dict], DataFrame]
    params: dict = field(default_factory=dict)
    version: str = "1"


@dataclass(frozen=True)
class Outcome:
    """What became of one asset in a run: its identity, its folder, and whether it was built now."""

    name: str
    identity: str
    path: str
    rebuilt: bool


def _hash(value) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True, default=str).encode()).hexdigest()[:16]


def listing_identity(spark: SparkSession, path: str) -> str:
    """Identity of the files under ``path`` from their listing alone."""
    return _hash([(f.name, f.length, f.modified) for f in list_files(spark, path)])


def newest_table(spark: SparkSession, folder: str, ttl_s: float | None = None) -> str | None:
    """The newest complete ``t=<epoch ms>`` table of a folder, if it is not older than ``ttl_s``."""
    stamps = [int(n[2:]) for n in subfolders(spark, folder) if n.startswith("t=") and n[2:].isdigit()]
    for t in sorted(stamps, reverse=True):
        if ttl_s is not None and time.time() - t / 1000 > ttl_s:
            return None
        if path_exists(spark, f"{folder}/t={t}/_SUCCESS"):
            return f"{folder}/t={t}"
    return None


class AssetGraph:
    """Sources and assets by name; an asset's inputs must be defined."""

    def __init__(self, spark: SparkSession, base: str, sources: Iterable[Source], assets: Iterable[Asset]):
        self.spark, self.base = spark, base.rstrip("/")
        self.sources = {s.name: s for s in sources}
        self.assets = {a.name: a for a in assets}
        if len(self.sources.keys() | self.assets.keys()) < len(self.sources) + len(self.assets):
            raise ValueError("a source and an asset have the same name")
        self.order = self._order()

    def _order(self) -> list[str]:
        """Assets after their inputs."""
        out: list[str] = []
        open_: list[str] = []

        def visit(name: str) -> None:
            if name in self.sources or name in out:
                return
            if name not in self.assets:
                raise ValueError(f"unknown input {name!r}")
            if name in open_:
                raise ValueError("assets depend on each other: " + " -> ".join([*open_, name]))
            open_.append(name)
            for i in self.assets[name].inputs:
                visit(i)
            open_.pop()
            out.append(name)

        for name in self.assets:
            visit(name)
        return out

    def with_ancestors(self, names: Iterable[str]) -> set[str]:
        """The named assets and all assets they are derived from."""
        found: set[str] = set()
        todo = list(names)
        while todo:
            name = todo.pop()
            if name in self.assets and name not in found:
                found.add(name)
                todo += self.assets[name].inputs
        return found

    def identities(self) -> dict[str, str]:
        """The identity every table has, or would have, for the files and parameters as they are now."""
        out = {s.name: listing_identity(self.spark, s.path) for s in self.sources.values()}
        for name in self.order:
            a = self.assets[name]
            out[name] = _hash([name, a.version, a.params, [out[i] for i in a.inputs]])
        return out

    def _folder(self, name: str, identity: str) -> str:
        return f"{self.base}/{name}/id={identity}"

    def stale(self, ttl_s: float | None = None) -> list[str]:
        """Assets without an up-to-date table, in the order they would be built."""
        ids = self.identities()
        return [n for n in self.order if newest_table(self.spark, self._folder(n, ids[n]), ttl_s) is None]

    def materialize(self, only: Iterable[str] | None = None, ttl_s: float | None = None) -> list[Outcome]:
        """Bring all assets (or the named ones and what they need) up to date; one outcome for each, in build order.

        An asset that is built makes its descendants' tables out of date only through its identity, so a
        table past its time to live is rebuilt alone.
        """
        ids = self.identities()
        wanted = set(self.order) if only is None else self.with_ancestors(only)
        tables: dict[str, str] = {}
        out = []
        for name in self.order:
            if name not in wanted:
                continue
            folder = self._folder(name, ids[name])
            path = newest_table(self.spark, folder, ttl_s)
            rebuilt = path is None
            if path is None:
                a = self.assets[name]
                path = f"{folder}/t={int(time.time() * 1000)}"
                a.build({i: self._read(i, tables) for i in a.inputs}, a.params).write.mode("error").parquet(path)
            tables[name] = path
            out.append(Outcome(name, ids[name], path, rebuilt))
        return out

    def _read(self, name: str, tables: dict[str, str]) -> DataFrame:
        if name in self.sources:
            s = self.sources[name]
            return s.read(self.spark, s.path) if s.read else self.spark.read.parquet(s.path)
        return self.spark.read.parquet(tables[name])

    def table(self, name: str) -> DataFrame:
        """The up-to-date table of an asset; an error if it has to be built first."""
        path = newest_table(self.spark, self._folder(name, self.identities()[name]))
        if path is None:
            raise FileNotFoundError(f"asset {name!r} is stale: materialize it first")
        return self.spark.read.parquet(path)
