"""Parquet tables whose directories are replaced all at once: new files first, then one small pointer, old files last.

A table's files lie under its path in Hive layout. What counts is the manifest, one text of :class:`Store` that names the
live files of every directory, with the table's schema, each directory's rows and fingerprint, and notes of its writer. A
batch appends files under names that do not exist yet and then writes the next manifest. A run that ends anywhere before
that has changed nothing that a reader sees, and its files are removed by the next run; one that ends after it has done all
but cleaning up. So no moment has a directory that is neither old nor new, and repeating a run loses and doubles nothing.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from typing import Any
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestream.schema import quoted
from lodestream.sources.store import Store

#: The values of a directory's layout columns as text, None for null.
Key = tuple[str | None, ...]
_NULL = "__HIVE_DEFAULT_PARTITION__"
_MANIFEST = "manifest"
#: What :meth:`Published.replace` does, in this order; it tells an observer before each.
STEPS = ("clean", "write", "measure", "point", "remove")


def directory_key(directory: str) -> Key:
    """``a=1/b=__HIVE_DEFAULT_PARTITION__`` as ('1', None); a table without layout columns has the key ()."""
    values = [part.partition("=")[2] for part in directory.split("/") if part]
    return tuple(None if v == _NULL else unquote(v) for v in values)


def row_hash(schema: T.StructType, without: Iterable[str] = ()) -> Column:
    """A 64-bit hash of a row's values by column name. Nulls add nothing and numbers count by value, so a row keeps its hash when its table gets a column or a wider type."""
    parts = []
    for f in sorted((f for f in schema if f.name not in set(without)), key=lambda f: f.name):
        c = F.col(quoted(f.name))
        if isinstance(f.dataType, T.FloatType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("timestamp")
        elif isinstance(f.dataType, T.ArrayType | T.MapType | T.StructType):
            c = F.to_json(F.struct(c))
        parts.append(F.concat(F.lit(f"{f.name}="), c.cast("string")))
    return F.xxhash64(*parts) if parts else F.lit(0).cast("long")


def measured(df: DataFrame, by: list[str], grouped: list[str] | None = None) -> DataFrame:
    """(by, rows, fingerprint) of ``df``, or by ``grouped``; the fingerprint is the sum of row hashes, without the columns ``by``, so those of two sets of rows add up."""
    return df.groupBy(*(grouped or by)).agg(F.count("*").alias("rows"), F.sum(row_hash(df.schema, by).cast("decimal(38,0)")).alias("fingerprint"))


class Published:
    """The table at ``path``, laid out by the columns ``by``. One writer at a time; any number of readers.

    A folder of Parquet files without a manifest is taken as a table whose files are all live.
    """

    def __init__(self, spark: SparkSession, path: str, by: Iterable[str] = ()):
        self._spark, self.path, self.by = spark, path.rstrip("/"), list(by)
        self._at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._store = Store(spark, self.path)
        self._state = self._read()

    def _read(self) -> dict[str, Any] | None:
        text = self._store.read(_MANIFEST)
        if text is not None:
            state = json.loads(text)
            self.by = state["by"]
            return state
        found = self._files()
        if not found:
            return None
        live: dict[str, dict] = {}
        for f in found:
            live.setdefault(f.rpartition("/")[0], {"files": []})["files"].append(f.rpartition("/")[2])
        old = self._store.read("schema")
        schema = json.loads(old) if old else json.loads(self._spark.read.option("mergeSchema", "true").parquet(self.path).schema.json())
        return {"schema": schema, "by": self.by, "live": live, "retired": [], "leaving": [], "notes": {}}

    def _names(self, directory: str) -> list[str]:
        """Names in a directory of the table, hidden ones left out."""
        at = self._at(f"{self.path}/{directory}" if directory else self.path)
        if not self._fs.exists(at):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(at)]
        return [n for n in names if n[0] != "." and (n[0] != "_" or "=" in n)]

    def _files(self, directory: str = "") -> list[str]:
        """Data files below a directory of the table, by their paths relative to it."""
        out, depth = [], directory.count("/") + 1 if directory else 0
        for name in self._names(directory):
            path = f"{directory}/{name}" if directory else name
            if name.endswith(".parquet"):
                out.append(path)
            elif depth < len(self.by) and name.startswith(f"{self.by[depth]}="):
                out += self._files(path)
        return out

    @property
    def exists(self) -> bool:
        return self._state is not None

    @property
    def schema(self) -> T.StructType | None:
        return None if self._state is None else T.StructType.fromJson(self._state["schema"])

    @property
    def notes(self) -> dict[str, Any]:
        """What the writer of the rows noted with them, as JSON values."""
        return {} if self._state is None else self._state["notes"]

    def files(self, keys: set[Key] | None = None) -> list[str]:
        live = {} if self._state is None else self._state["live"]
        return [f"{d}/{f}" if d else f for d, x in live.items() if keys is None or directory_key(d) in keys for f in x["files"]]

    def read(self, keys: set[Key] | None = None) -> DataFrame:
        """The live rows, of all directories or only of those with these keys; the others are not even listed."""
        if self._state is None:
            raise FileNotFoundError(f"no table at {self.path}")
        schema, found = self.schema, self.files(keys)
        if not found:
            return self._spark.createDataFrame([], schema)
        return self._spark.read.schema(schema).option("basePath", self.path).parquet(*(f"{self.path}/{f}" for f in found))

    def stored(self) -> DataFrame:
        """(by, files, rows, fingerprint) of each directory as the manifest has them: no data file is opened."""
        schema = T.StructType([*(T.StructField(c, T.StringType()) for c in self.by), *T.StructType.fromDDL("files long, rows long, fingerprint string")])
        live = {} if self._state is None else self._state["live"]
        out = self._spark.createDataFrame([(*directory_key(d), len(x["files"]), x.get("rows"), x.get("fingerprint")) for d, x in live.items()], schema)
        known = self.schema
        return out.select(*(F.col(c).cast(known[c].dataType if known else "string").alias(c) for c in self.by), "files", "rows", "fingerprint")

    def tallied(self, column: str) -> DataFrame:
        """(column, rows) over all directories as their writer counted them: no data file is opened."""
        live = {} if self._state is None else self._state["live"]
        rows = [(v, n) for x in live.values() for v, n in x.get("tally", ())]
        return self._spark.createDataFrame(rows, T.StructType([T.StructField(column, T.StringType()), T.StructField("rows", T.LongType())])).groupBy(column).agg(F.sum("rows").alias("rows"))

    def unproven(self, keys: set[Key] | None = None) -> DataFrame:
        """Directories whose rows are not what the manifest says, read again now; only those with ``keys`` if given. Empty is well."""
        said = self.stored().filter("rows is not null")
        now = measured(self.read(keys), self.by).select(*self.by, F.col("rows").alias("found_rows"), F.col("fingerprint").cast("string").alias("found"))
        if keys is not None:
            wanted = self._spark.createDataFrame([k for k in keys], T.StructType([T.StructField(f"_k_{c}", T.StringType()) for c in self.by]))
            said = said.join(wanted, [F.col(c).cast("string").eqNullSafe(F.col(f"_k_{c}")) for c in self.by], "left_semi")
        same = [said[c].eqNullSafe(now[c]) for c in self.by] or [F.lit(True)]
        both = said.join(now, same, "left") if self.by else said.crossJoin(now)
        off = F.col("found").isNull() | (F.col("found") != F.col("fingerprint")) | (F.col("found_rows") != F.col("rows"))
        return both.filter(off).select(*(said[c] for c in self.by), "rows", "found_rows")

    def replace(
        self,
        rows: DataFrame,
        touched: set[Key] | None,
        schema: T.StructType | None = None,
        options: dict[str, str] | None = None,
        notes: dict[str, Any] | None = None,
        keep: int = 0,
        on_step: Callable[[str], None] | None = None,
        tally: str | None = None,
    ) -> None:
        """Put ``rows`` in the place of the directories ``touched`` (None: of the whole table), in one step for readers.

        ``rows`` may read this table and must lie in touched directories only; a touched directory without rows is gone
        afterwards. ``schema`` is the table's from now on, by default that of ``rows``. Replaced files stay for the next
        ``keep`` replacements, for readers that began before this one: they are not live, but reads of the bare folder
        would see them. ``on_step`` hears the name of each of STEPS before it begins. ``tally`` names a
        column of few values, whose rows are counted by directory and kept too, see :meth:`tallied`.
        """
        tell = on_step or (lambda step: None)
        whole = T.StructType([f for f in (schema or rows.schema) if f.name not in self.by] + [f for f in (schema or rows.schema) if f.name in self.by])
        if self._state is None:
            # From its first file on the folder is a table of ours: should this run end now, its files count for nothing.
            self._publish({}, whole, [], [], {}, lambda step: None)
        state = self._state
        hit = {d for d in state["live"] if touched is None or directory_key(d) in touched}
        tell("clean")
        # What the last run would have removed, had it come so far.
        self._remove(state["leaving"])
        known = {f"{d}/{f}" if d else f for d, x in state["live"].items() for f in x["files"]} | {f for old in state["retired"] for f in old}
        self._remove([f for f in self._files() if f not in known] if touched is None or not self.by else [f for d in self._below(touched) for f in self._files(d) if f not in known])
        tell("write")
        seen = Observation()
        writer = rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").options(**({"compression": "zstd"} | (options or {})))
        (writer.partitionBy(*self.by) if self.by else writer).parquet(self.path)
        tell("measure")
        fresh: dict[str, dict] = {}
        for f in self._files() if touched is None or not self.by else [f for d in self._below(touched) for f in self._files(d)]:
            if f not in known:
                fresh.setdefault(f.rpartition("/")[0], {"files": []})["files"].append(f.rpartition("/")[2])
        if fresh:
            new = [f"{self.path}/{d}/{f}" if d else f"{self.path}/{f}" for d, x in fresh.items() for f in x["files"]]
            by = [*self.by, *([tally] if tally else [])]
            counted = measured(self._spark.read.schema(whole).option("basePath", self.path).parquet(*new), self.by, by)
            found: dict[Key, list] = {}
            for r in counted.select(*(F.col(c).cast("string") for c in by), "rows", "fingerprint").collect():
                found.setdefault(tuple(r)[: len(self.by)], []).append(r)
            for d, x in fresh.items():
                own = found.get(directory_key(d), [])
                x |= {"rows": sum(r["rows"] for r in own), "fingerprint": str(sum(r["fingerprint"] for r in own))}
                if tally:
                    x["tally"] = [[r[len(self.by)], r["rows"]] for r in own]
        if sum(x["rows"] for x in fresh.values()) != seen.get["n"]:
            raise ValueError("rows outside the touched directories, or files that cannot be read back")
        gone = [f"{d}/{f}" if d else f for d in hit for f in state["live"][d]["files"]]
        retired = [*state["retired"], gone]
        stay, leave = retired[max(0, len(retired) - keep) :], retired[: max(0, len(retired) - keep)]
        leaving = [f for old in leave for f in old]
        self._publish({**{d: x for d, x in state["live"].items() if d not in hit}, **fresh}, whole, stay, leaving, notes, tell)
        tell("remove")
        self._remove(leaving)

    def drop(self, match: Callable[[Key], bool]) -> None:
        """Take the directories whose keys ``match`` out of the table."""
        if self._state is None:
            return
        hit = [d for d in self._state["live"] if match(directory_key(d))]
        gone = [f"{d}/{f}" for d in hit for f in self._state["live"][d]["files"]]
        leaving = [*self._state["leaving"], *gone]
        self._publish({d: x for d, x in self._state["live"].items() if d not in hit}, self.schema, self._state["retired"], leaving, None, lambda step: None)
        self._remove(leaving)

    def note(self, notes: dict[str, Any]) -> None:
        """Change the notes alone."""
        if self._state is not None:
            self._publish(self._state["live"], self.schema, self._state["retired"], self._state["leaving"], notes, lambda step: None)

    def _publish(self, live: dict, schema: T.StructType, retired: list, leaving: list[str], notes: dict[str, Any] | None, tell: Callable[[str], None]) -> None:
        state = {"schema": json.loads(schema.json()), "by": self.by, "live": live, "retired": retired, "leaving": leaving, "notes": self.notes if notes is None else notes}
        tell("point")
        self._store.write(_MANIFEST, json.dumps(state))
        self._state = state
        self._spark.catalog.refreshByPath(self.path)

    def _below(self, touched: set[Key]) -> list[str]:
        """The directories with these keys that lie on the file system, found level by level so that others are not listed."""
        level = [("", ())]
        for depth in range(len(self.by)):
            wanted, below = {k[: depth + 1] for k in touched}, []
            for d, key in level:
                for name in self._names(d):
                    own = (*key, *directory_key(name))
                    if name.startswith(f"{self.by[depth]}=") and own in wanted:
                        below.append((f"{d}/{name}" if d else name, own))
            level = below
        return [d for d, _ in level]

    def _remove(self, files: list[str]) -> None:
        """Delete files, and directories that this leaves empty."""
        for f in files:
            self._fs.delete(self._at(f"{self.path}/{f}"), False)
        live = () if self._state is None else self._state["live"]
        for d in sorted({f.rpartition("/")[0] for f in files} - {"", *live}, reverse=True):
            while d:
                at = self._at(f"{self.path}/{d}")
                if self._fs.exists(at) and len(self._fs.listStatus(at)) == 0:
                    self._fs.delete(at, False)
                d = d.rpartition("/")[0]


def key_values(rows: DataFrame, by: list[str]) -> set[Key]:
    """The directories that ``rows`` fall into: as many as a batch touches."""
    return {tuple(r) for r in rows.select(*(F.col(c).cast("string") for c in by)).distinct().collect()}
