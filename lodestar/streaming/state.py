"""Hot state in files: snapshot plus deltas (survey K6, K7).

Every micro-batch writes the keys it changed as a delta of its epoch (a
replayed batch writes over its own delta). When the deltas since the last
snapshot hold ``ratio`` times the snapshot's rows, they are folded into a new
snapshot; only then a commit marker names it. Readers follow the newest
marker: its snapshot and the deltas after it, so a read costs the state and
not its history, and a compaction that is running, or was lost half-way, is
invisible. Rewriting is paid for by the changes: a state of n rows is written
again only after ratio * n changed rows.

What a marker no longer needs goes one generation later, so a reader that has
just looked up the marker before still finds its files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestar.operators.windows import latest_per_key

MARKER = "epoch long, snapshot string, rows long"


class HotState:
    """Latest row per key of a stream of changes, below the shared ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType,
                 keys: Sequence[str], ratio: float = 1.0):
        self.spark, self.path, self.keys, self.ratio = spark, path, list(keys), ratio
        self.schema = StructType(list(schema.fields))
        self.stored = StructType([*schema.fields]).add("_epoch", "long")

    # --- files: any file system that Spark reads

    def _fs(self, name: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, folder: str) -> list[str]:
        fs, p = self._fs(folder)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def _delete(self, name: str) -> None:
        fs, p = self._fs(name)
        fs.delete(p, True)

    # --- markers and reads

    def _markers(self) -> list[tuple[int, object]]:
        """(generation, marker) of all commits, newest first; a folder without
        a row is a commit that is not through."""
        found = sorted((int(n.split("=")[1]) for n in self._names("commits")), reverse=True)
        rows = ((g, self.spark.read.schema(MARKER).parquet(
            f"{self.path}/commits/generation={g}").first()) for g in found)
        return [(g, r) for g, r in rows if r]

    def marker(self):
        """The newest commit marker: the epoch up to which its snapshot
        reaches, its folder and its rows (None before the first)."""
        found = self._markers()
        return found[0][1] if found else None

    def _deltas(self, after: int, upto: int | None = None) -> DataFrame:
        found = sorted(int(n.split("=")[1]) for n in self._names("deltas"))
        some = [e for e in found if e > after and (upto is None or e <= upto)]
        if not some:
            return self.spark.createDataFrame([], self.stored)
        return self.spark.read.schema(self.stored).parquet(
            *[f"{self.path}/deltas/epoch={e}" for e in some])

    def _view(self, marker, upto: int | None = None) -> DataFrame:
        deltas = self._deltas(marker["epoch"] if marker else -1, upto)
        if not marker:
            return latest_per_key(deltas, self.keys, ["_epoch"])
        base = self.spark.read.schema(self.stored).parquet(f"{self.path}/{marker['snapshot']}")
        return latest_per_key(base.unionByName(deltas), self.keys, ["_epoch"])

    def read(self) -> DataFrame:
        """The latest row per key, as of the newest marker and the deltas
        written so far."""
        return self._view(self.marker()).select(*self.schema.names)

    # --- writes

    def apply(self, batch: DataFrame, epoch: int) -> None:
        """``foreachBatch`` writer. Replays are harmless: the delta is written
        over, and one that a snapshot already holds is not read again."""
        batch.select(*self.schema.names).withColumn("_epoch", F.lit(epoch).cast("long")) \
            .write.mode("overwrite").parquet(f"{self.path}/deltas/epoch={epoch}")
        self.compact_if_due(epoch)

    def compact_if_due(self, epoch: int) -> bool:
        marker = self.marker()
        if marker and epoch <= marker["epoch"]:
            return False
        changed = self._deltas(marker["epoch"] if marker else -1, epoch).count()
        if changed < self.ratio * max(1, marker["rows"] if marker else 0):
            return False
        self.commit(self.write_snapshot(epoch), epoch)
        self.vacuum()
        return True

    def write_snapshot(self, epoch: int) -> str:
        """Folds the deltas up to ``epoch`` into a new snapshot; nobody reads
        it before ``commit``. A snapshot that a lost run left is written over."""
        name = f"snapshots/upto={epoch}"
        self._view(self.marker(), epoch).write.mode("overwrite").parquet(f"{self.path}/{name}")
        return name

    def commit(self, snapshot: str, epoch: int) -> None:
        """One marker row, which Spark's commit protocol makes visible whole."""
        found = self._markers()
        rows = self.spark.read.schema(self.stored).parquet(f"{self.path}/{snapshot}").count()
        self.spark.createDataFrame([(epoch, snapshot, rows)], MARKER).coalesce(1).write.mode(
            "overwrite").parquet(
            f"{self.path}/commits/generation={found[0][0] + 1 if found else 0}")

    def vacuum(self) -> None:
        """Deletes what neither the newest marker nor the one before it needs:
        older deltas, snapshots and markers."""
        found = self._markers()
        if len(found) < 2:
            return
        (_, new), (least, old) = found[:2]
        kept = {m["snapshot"].split("/")[1] for m in (new, old)}
        for n in self._names("deltas"):
            if int(n.split("=")[1]) <= old["epoch"]:
                self._delete(f"deltas/{n}")
        for n in self._names("snapshots"):
            if n not in kept and int(n.split("=")[1]) < new["epoch"]:
                self._delete(f"snapshots/{n}")
        for n in self._names("commits"):
            if int(n.split("=")[1]) < least:
                self._delete(f"commits/{n}")
