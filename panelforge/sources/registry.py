"""Versioned tables: slices that are switched by a manifest, and a log of predictions whose actuals come later.

A table is a folder of `data/<version>/...` and `manifests/<version>`. A version's data is written first, under a
name of its own; the manifest, a small file that names the folder of every live slice, is written last, and whole. Readers
take the newest manifest, so they see a table before or after a change and never between, and data
that a failed writer left behind is in no manifest. One writer at a time; `vacuum` deletes what no manifest of the last
few names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class SliceTable:
    """A table whose slices (values of `keys`) are replaced together or not at all."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def versions(self) -> list[int]:
        fs, p = self._fs(f"{self.path}/manifests")
        return sorted(int(f.getPath().getName()) for f in fs.listStatus(p) if f.getPath().getName().isdigit()) if fs.exists(p) else []

    def manifest(self, version: int | None = None) -> dict:
        """schema, and slices: each slice's values as text (JSON) with its folder. Of the newest version, if none is named."""
        known = self.versions()
        if not known:
            return {"schema": None, "slices": {}}
        fs, p = self._fs(f"{self.path}/manifests/{known[-1] if version is None else version}")
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, manifest: dict) -> int:
        """Writes the manifest aside and renames it: the one step that readers see. Fails where another writer was faster."""
        version = max(self.versions(), default=0) + 1
        fs, aside = self._fs(f"{self.path}/manifests/.{uuid.uuid4().hex}")
        out = fs.create(aside, False)
        out.write(bytearray(json.dumps(manifest), "utf-8"))
        out.close()
        target = self._fs(f"{self.path}/manifests/{version}")[1]
        if fs.exists(target) or not fs.rename(aside, target):
            fs.delete(aside, False)
            raise RuntimeError(f"version {version} was written by another")
        return version

    def stage(self, df: DataFrame) -> dict:
        """Writes df's rows where no reader looks yet; its slices with their folders."""
        folder = f"data/{uuid.uuid4().hex}"
        plain = [F.col(k).alias(f"_slice_{k}") for k in self.keys]
        df.select("*", *plain).write.partitionBy(*[f"_slice_{k}" for k in self.keys]).parquet(f"{self.path}/{folder}")
        found = {}
        for values in self._folders(f"{self.path}/{folder}", len(self.keys)):
            raw = [v.split("=", 1)[1] for v in values]
            found[json.dumps([None if x == "__HIVE_DEFAULT_PARTITION__" else unquote(x) for x in raw])] = "/".join([folder, *values])
        return {"schema": df.schema.jsonValue(), "slices": found}

    def _folders(self, at: str, depth: int) -> Iterable[tuple[str, ...]]:
        fs, p = self._fs(at)
        for f in fs.listStatus(p):
            name = f.getPath().getName()
            if f.isDirectory() and "=" in name:
                yield from ((name, *rest) for rest in self._folders(f"{at}/{name}", depth - 1)) if depth > 1 else [(name,)]

    def switch(self, staged: Mapping, drop: Iterable[Sequence] = ()) -> int:
        """Makes staged slices live in place of those of the same values; `drop` ends slices. All in one step."""
        now = self.manifest()
        text = lambda v: None if v is None else str(v).lower() if isinstance(v, bool) else str(v)
        gone = {json.dumps([text(x) for x in s]) for s in drop}
        live = {s: f for s, f in now["slices"].items() if s not in gone}
        return self._publish({"schema": staged["schema"] or now["schema"], "slices": live | dict(staged["slices"])})

    def replace(self, df: DataFrame, slices: Sequence[Sequence]) -> int:
        """The named slices hold df's rows of them from now on, or end where df has none. Other rows of df are an error."""
        staged = self.stage(df)
        text = lambda v: None if v is None else str(v).lower() if isinstance(v, bool) else str(v)
        named = {json.dumps([text(x) for x in s]) for s in slices}
        if extra := set(staged["slices"]) - named:
            raise ValueError(f"rows of slices that weren't named: {sorted(extra)[:5]}")
        return self.switch(staged, slices)

    def write(self, df: DataFrame) -> int:
        """Replaces the slices that df has rows for and leaves the others."""
        return self.switch(self.stage(df))

    def read(self, version: int | None = None) -> DataFrame:
        m = self.manifest(version)
        if m["schema"] is None:
            raise FileNotFoundError(f"no version of {self.path}")
        schema = StructType.fromJson(m["schema"])
        paths = [f"{self.path}/{f}" for f in m["slices"].values()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def vacuum(self, keep: int = 2) -> None:
        """Deletes manifests but the last `keep`, and data that none of those names."""
        known = self.versions()
        for v in known[:-keep]:
            fs, p = self._fs(f"{self.path}/manifests/{v}")
            fs.delete(p, False)
        used = {f for v in known[-keep:] for f in self.manifest(v)["slices"].values()}
        fs, p = self._fs(f"{self.path}/data")
        for folder in fs.listStatus(p) if fs.exists(p) else []:
            name = folder.getPath().getName()
            for values in self._folders(f"{self.path}/data/{name}", len(self.keys)):
                if "/".join(["data", name, *values]) not in used:
                    fs.delete(self._fs("/".join([f"{self.path}/data/{name}", *values]))[1], True)


def newest(log: DataFrame, key: Sequence[str], at: Sequence[str]) -> DataFrame:
    """The last version of each key, by the columns `at`; equal ones give the greatest row. One shuffle, combined before."""
    rest = [c for c in log.columns if c not in key]
    order = F.struct(*at, *[F.col(c) for c in rest if c not in at])
    return log.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("_row")).select(*key, "_row.*")


class PredictionRegistry:
    """Predictions by (game_id, model), and what came true: both are appended as events and folded on read.

    Events: predictions carry `prediction`, `confidence` and the version of the model; actuals carry `actual`. Each has
    `logged_at` and a batch. An event that comes twice, late or out of order changes nothing or what it should: the newest
    by (logged_at, batch) counts, of predictions and of actuals each. `season` is the slice. `compact` replaces the
    events of the slices named by their fold.
    """

    SCHEMA = "game_id string, model string, season long, kind string, prediction double, confidence double, model_version string, actual double, logged_at timestamp, batch string"

    def __init__(self, spark: SparkSession, path: str):
        self.table = SliceTable(spark, path, ["season", "batch"])

    def _append(self, rows: DataFrame, batch: str) -> int:
        columns = [f.split() for f in self.SCHEMA.split(", ")]
        out = rows.withColumn("batch", F.lit(batch))
        return self.table.write(out.select(*[(F.col(c) if c in out.columns else F.lit(None)).cast(t).alias(c) for c, t in columns]))

    def log_predictions(self, rows: DataFrame, batch: str) -> int:
        """game_id, model, season, prediction, confidence, model_version, logged_at. A batch of the same name is replaced."""
        return self._append(rows.withColumn("kind", F.lit("prediction")), batch)

    def log_actuals(self, rows: DataFrame, batch: str) -> int:
        """game_id, season, actual, logged_at."""
        return self._append(rows.withColumn("kind", F.lit("actual")), batch)

    def read(self) -> DataFrame:
        """A row per (game_id, model): its newest prediction, the newest actual of its game, the error and whether the side was right."""
        return folded(self.table.read())

    def compact(self, seasons: Sequence[int], batch: str) -> int:
        """Makes one batch of each season's newest predictions and actuals. Readers see the same rows before and after."""
        log = self.table.read().filter(F.col("season").isin([int(s) for s in seasons]))
        last = newest(log.filter("kind = 'prediction'"), ["game_id", "model", "season"], ["logged_at", "batch"]).unionByName(newest(log.filter("kind = 'actual'"), ["game_id", "season", "model"], ["logged_at", "batch"]))
        staged = self.table.stage(last.select(*log.columns).withColumn("batch", F.lit(batch)))
        old = [json.loads(s) for s in self.table.manifest()["slices"]]
        return self.table.switch(staged, [s for s in old if s[0] in {str(int(x)) for x in seasons}])


def folded(log: DataFrame) -> DataFrame:
    predicted = newest(log.filter("kind = 'prediction'").drop("actual", "kind"), ["game_id", "model"], ["logged_at", "batch"])
    actual = newest(log.filter("kind = 'actual'").select("game_id", "logged_at", "batch", F.col("actual").alias("actual_value")), ["game_id"], ["logged_at", "batch"])
    out = predicted.join(actual.select("game_id", "actual_value", F.col("logged_at").alias("actual_at")), "game_id", "left")
    return out.withColumns({"prediction_error": F.col("prediction") - F.col("actual_value"), "right_side": F.when(F.col("actual_value").isNotNull(), (F.col("prediction") > 0) == (F.col("actual_value") > 0))})


def performance(rows: DataFrame) -> DataFrame:
    """A row per model and version: predictions, how many are graded, mae, hit rate, first and last logged."""
    return rows.groupBy("model", "model_version").agg(
        F.count("*").alias("n"), F.count("actual_value").alias("graded"), F.avg(F.abs("prediction_error")).alias("mae"), F.avg(F.col("right_side").cast("double")).alias("hit_rate"))
