"""Keyed documents: the last row of every key, at a read cost that follows the live keys.

A batch stores its own last row per key.  Every ``snapshot_every`` batches the current documents are
written anew, dealt into buckets by a hash of the key, and the batches they cover are let go; a read takes
the last snapshot and the few batches after it.  Each step is published as a version
(:mod:`tessera.streaming.versions`), so a crash leaves the documents as they were, and a replayed batch
changes nothing.

Last means: greatest batch, then greatest ``order`` (such as the source offset; NULL least), then greatest
hash of the row, so the choice is never arbitrary.  A NULL key is a key of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.rank import top_n_per_group
from tessera.streaming.versions import Versions

BATCH, BUCKET = "__batch", "__bucket"


class KeyedDocuments:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str] = (),
                 buckets: int | None = None, snapshot_every: int = 32) -> None:
        self.spark, self.keys, self.order = spark, list(keys), list(order)
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.versions, self.snapshot_every = Versions(spark, path), snapshot_every

    def _last(self, rows: DataFrame) -> DataFrame:
        plain = [c for c, kind in rows.dtypes if not kind.startswith("map")]
        by = [F.desc(BATCH), *[F.col(c).desc_nulls_last() for c in self.order], F.xxhash64(*plain).desc()]
        return top_n_per_group(rows, self.keys, by, 1)

    def _bucket(self, *keys: Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def add(self, batch: DataFrame, batch_id: int) -> bool:
        """Store a batch; False if it is stored already."""
        number, content = self.versions.current()
        upto, parts = content.get("upto", -1), dict(content.get("batches", {}))
        if batch_id <= upto or str(batch_id) in parts:
            return False
        folder = self.versions.folder(f"batch-{batch_id}")
        self._last(batch.withColumn(BATCH, F.lit(batch_id).cast("long"))).write.parquet(
            self.versions.full(folder))
        parts[str(batch_id)] = folder
        content = {**content, "batches": parts}
        if len(parts) >= self.snapshot_every:
            base = self.versions.folder("snapshot")
            self._dealt(content).write.partitionBy(BUCKET).parquet(self.versions.full(base))
            content = {"snapshot": base, "buckets": self.buckets, "upto": max(map(int, parts)),
                       "batches": {}}
        self.versions.publish(number, content)
        self.versions.prune()
        return True

    def _dealt(self, content: dict) -> DataFrame:
        """All current documents by bucket, with one shuffle and one sort: the snapshot and every batch hold
        a key once, so the greatest batch alone decides."""
        rows = self.spark.read.parquet(*[self.versions.full(f) for f in content["batches"].values()])
        if "snapshot" in content:
            rows = self.spark.read.parquet(self.versions.full(content["snapshot"])).drop(BUCKET).unionByName(rows)
        bucket = self._bucket(*map(F.col, self.keys), buckets=self.buckets)
        rows = rows.withColumn(BUCKET, bucket).repartition(self.buckets, BUCKET)
        return top_n_per_group(rows, [BUCKET, *self.keys], F.desc(BATCH), 1)

    def _read(self, content: dict, wanted: Sequence | None = None) -> DataFrame:
        parts, snapshot, recent = content["batches"], None, None
        hit = F.lit(True)
        for k, v in zip(self.keys, wanted or ()):
            hit = hit & F.col(k).eqNullSafe(F.lit(v))
        if parts:
            recent = self._last(self.spark.read.parquet(
                *[self.versions.full(f) for f in parts.values()]).where(hit))
        if "snapshot" in content:
            snapshot = self.spark.read.parquet(self.versions.full(content["snapshot"]))
            if wanted is not None:
                kinds = dict(snapshot.dtypes)
                values = [F.lit(v).cast(kinds[k]) for k, v in zip(self.keys, wanted)]
                snapshot = snapshot.where(hit & (F.col(BUCKET) == self._bucket(
                    *values, buckets=content["buckets"])))
            snapshot = snapshot.drop(BUCKET)
        if snapshot is None or recent is None:
            return recent if snapshot is None else snapshot
        # A key of a later batch replaces the snapshot's row: no ranking of the snapshot.
        newer = recent.select(*[F.col(k).alias(f"__{k}") for k in self.keys])
        same = F.lit(True)
        for k in self.keys:
            same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
        return snapshot.join(newer, same, "left_anti").unionByName(recent)

    def read(self) -> DataFrame:
        """The current document of every key."""
        return self._current().drop(BATCH)

    def get(self, *key) -> DataFrame:
        """The current document of one key: one bucket of the snapshot and the batches after it."""
        return self._current(key).drop(BATCH)

    def _current(self, wanted: Sequence | None = None) -> DataFrame:
        _, content = self.versions.current()
        if not content:
            raise ValueError(f"nothing is stored yet under {self.versions.path}")
        return self._read(content, wanted)
