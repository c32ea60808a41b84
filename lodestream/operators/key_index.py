"""Where a fact's keys lie: a small table beside it, laid out by the keys' hash, so that a load looks its batch's keys up without reading the key column of the whole fact.

The index may name partitions that a key has left, never miss one that it is in: it is widened before the fact changes and
made exact afterwards. So a run that ends between leaves an index that costs a little more and loses nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.sources.published import Key, Published, key_values

_BUCKET = "_bucket"


class KeyIndex:
    """The index of the table at ``path``, whose rows are found by ``keys`` in partitions ``by``. ``buckets`` counts when it is first built."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], by: list[str], buckets: int = 64):
        self.keys, self.by = keys, by
        self.table = Published(spark, f"{path.rstrip('/')}.keys", [_BUCKET])
        self.buckets = self.table.notes.get("buckets", buckets)

    @property
    def ready(self) -> bool:
        """Whether it was ever built; a table that was stored without one gets it with :meth:`rebuild`."""
        return bool(self.table.notes)

    def placed(self, rows: DataFrame, *columns: str) -> DataFrame:
        """The keys of ``rows``, with ``columns``, each once, and the bucket that they fall into. Null keys are keys."""
        some = rows.select(*self.keys, *columns).distinct()
        return some.withColumn(_BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def lookup(self, wanted: DataFrame) -> tuple[DataFrame, set[Key]]:
        """(keys and partitions of the wanted keys, the buckets read): no other bucket is opened."""
        asked = self.placed(wanted)
        touched = key_values(asked, [_BUCKET])
        right = asked.select(*(F.col(k).alias(f"_k_{k}") for k in self.keys))
        same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in self.keys]
        return self.table.read(touched).join(right, same, "left_semi").select(*self.keys, *self.by), touched

    def _replace(self, rows: DataFrame, touched: set[Key] | None) -> None:
        self.table.replace(rows.repartition(_BUCKET).sortWithinPartitions(_BUCKET, *self.keys), touched, notes={"buckets": self.buckets})

    def rebuild(self, fact: DataFrame) -> None:
        self._replace(self.placed(fact, *self.by), None)

    def widen(self, rows: DataFrame) -> None:
        """Add the partitions in which ``rows`` will lie; called before the fact changes."""
        new = self.placed(rows, *self.by)
        touched = key_values(new, [_BUCKET])
        if touched:
            self._replace(self.table.read(touched).select(new.columns).unionByName(new).distinct(), touched)

    def settle(self, rows: DataFrame, wanted: DataFrame) -> None:
        """Of the wanted keys only the partitions in which ``rows`` lie; called after the fact has changed."""
        asked = self.placed(wanted)
        touched = key_values(asked, [_BUCKET])
        if touched:
            new, old = self.placed(rows, *self.by), self.table.read(touched)
            right = asked.select(*(F.col(k).alias(f"_k_{k}") for k in self.keys))
            rest = old.join(right, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in self.keys], "left_anti").select(new.columns)
            self._replace(rest.unionByName(new), touched)
