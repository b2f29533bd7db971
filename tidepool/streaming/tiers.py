"""Part stores in tiers: each micro-batch adds a small run, and runs that time has left behind are merged.

A manifest lists the live runs with the batches and ticks they hold. Once a level
has ``fan`` runs that no window reaches any more, the oldest of them become one
run of the next level: so the live runs grow with the logarithm of the batches,
and a reader of the last window opens that window's runs alone. The newest batch
is never merged, since only it can be replayed; merged runs are removed one batch
later, when nobody reads by the manifest that listed them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.streaming import files

FAN = 32


def due_merge(runs: list[dict], newest: int, fan: int, settled: float) -> list[dict]:
    """The oldest ``fan`` runs of the lowest level that has so many which end before tick ``settled``; none if none has."""
    for level in sorted({r["level"] for r in runs}):
        old = [r for r in runs if r["level"] == level and r["hi"] < settled and r["last"] < newest]
        if len(old) >= fan:
            return sorted(old, key=lambda r: r["first"])[:fan]
    return []


def with_merged(runs: list[dict], merged: list[dict], name: str) -> list[dict]:
    """The runs with some of them replaced by the one they were merged into."""
    one = {"name": name, "level": merged[0]["level"] + 1, "first": min(r["first"] for r in merged), "last": max(r["last"] for r in merged),
           "lo": min(r["lo"] for r in merged), "hi": max(r["hi"] for r in merged)}
    return [r for r in runs if r not in merged] + [one]


class TieredParts:
    """Mergeable rows by micro-batch under ``path``. ``merge`` makes fewer rows of those of several runs;
    runs within ``reach`` ticks of the newest are left as they are."""

    def __init__(self, path: str, merge: Callable[[DataFrame], DataFrame], reach: int, tick: str = "tick", fan: int = FAN):
        self.path, self.merge, self.reach, self.tick, self.fan = path.rstrip("/"), merge, reach, tick, fan

    def _manifest(self, spark: SparkSession) -> dict:
        return files.read_json(spark, f"{self.path}/manifest.json") or {"runs": [], "left": []}

    def append(self, df: DataFrame, batch_id: int) -> None:
        """``df`` as the run of this batch; without rows there is none."""
        spark, name = df.sparkSession, f"run-{batch_id}"
        df.write.mode("overwrite").parquet(f"{self.path}/{name}")
        lo, hi = spark.read.parquet(f"{self.path}/{name}").agg(F.min(self.tick), F.max(self.tick)).first()
        manifest = self._manifest(spark)
        runs, left = [r for r in manifest["runs"] if r["name"] != name], manifest["left"]
        gone = []
        if lo is None:
            gone.append(name)
        else:
            runs.append({"name": name, "level": 0, "first": batch_id, "last": batch_id, "lo": lo, "hi": hi})
        while merged := due_merge(runs, batch_id, self.fan, max(r["hi"] for r in runs) - self.reach):
            to = f"run-{merged[0]['first']}-{merged[-1]['last']}-{merged[0]['level'] + 1}"
            self.merge(self._read(spark, merged)).write.mode("overwrite").parquet(f"{self.path}/{to}")
            runs, gone = with_merged(runs, merged, to), [*gone, *(r["name"] for r in merged)]
        files.write_json(spark, f"{self.path}/manifest.json", {"runs": runs, "left": gone})
        for old in left:  # of the batch before
            if old not in {r["name"] for r in runs} and old not in gone:
                files.delete(spark, f"{self.path}/{old}")

    def _read(self, spark: SparkSession, runs: list[dict]) -> DataFrame:
        return spark.read.parquet(*[f"{self.path}/{r['name']}" for r in runs])

    def runs_since(self, spark: SparkSession, tick: int | None = None) -> list[dict]:
        """The runs that hold ticks after ``tick``."""
        return [r for r in self._manifest(spark)["runs"] if tick is None or r["hi"] > tick]

    def read(self, spark: SparkSession, since: int | None = None) -> DataFrame | None:
        """The rows of those runs; None if there are none."""
        runs = self.runs_since(spark, since)
        return self._read(spark, runs) if runs else None
