"""Writing results: a run history, stable current copies, CSV and line-delimited GeoJSON."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regional_balance import schema as S
from regional_balance.functions import geometry as G
from regional_balance.functions import names as N
from regional_balance.operators.score import improvement_list
from regional_balance.plans.scoring import ScoredRegions
from regional_balance.sources.results import POINTER, current_copy

# Stable names of the current results; fixed values.
CURRENT_NAMES = {
    "need_table": "need_score_by_region",
    "need_improvement": "priority_ranking",
    "activity_metrics_by_county": "activity_metrics_by_county",
    "need_spatial": "need_score_map",
}


def run_stamp() -> str:
    """Time to the microsecond: two runs do not share it."""
    return datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")


def write_run(df: DataFrame, root: str, name: str, run_ts: str, vintage: str = S.DEFAULT_VINTAGE) -> str:
    """Put a run into the Parquet history ``root/name``, partitioned by vintage and run.

    Writing the same run again replaces it, so a job that is tried again does not double it.
    """
    path = f"{root}/{name}"
    stamped = df.withColumns({"vintage": F.lit(vintage), "run_ts": F.lit(run_ts)})
    by_run = stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    by_run.partitionBy("vintage", "run_ts").parquet(path)
    return path


class Folder:
    """Moves and small files in the file system that a path belongs to."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self.fs = jvm.org.apache.hadoop.fs
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.path = self.fs.Path(path)
        self.system = self.path.getFileSystem(self.conf)
        self.rename = self.fs.FileContext.getFileContext(self.system.makeQualified(self.path).toUri(), self.conf)
        self.replace = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        self.gateway = spark.sparkContext._gateway

    def put_text(self, name: str, text: str) -> None:
        """Write a small file beside and rename it over the old one, which is atomic."""
        fresh = self.fs.Path(self.path, f".{name}.{uuid.uuid4().hex}")
        out = self.system.create(fresh, True)
        out.write(bytearray(text.encode()))
        out.close()
        options = self.gateway.new_array(self.gateway.jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self.replace
        qualified = [self.system.makeQualified(p) for p in (fresh, self.fs.Path(self.path, name))]
        self.rename.rename(*qualified, options)

    def names(self) -> list[str]:
        return [s.getPath().getName() for s in self.system.listStatus(self.path)] if self.system.exists(self.path) else []

    def delete(self, name: str) -> None:
        self.system.delete(self.fs.Path(self.path, name), True)

    def move_in(self, staged: str) -> None:
        """Put a finished folder in the place of this one."""
        self.system.delete(self.path, True)
        self.system.mkdirs(self.path.getParent())
        self.system.rename(self.fs.Path(staged), self.path)


def staged(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Let ``write`` fill a hidden folder beside ``path`` and move that there when it is complete: until then, and if the job
    fails, the old one stays."""
    parent, _, name = path.rstrip("/").rpartition("/")
    parent = parent or "."
    fresh = f"{parent}/_staged-{name}-{uuid.uuid4().hex}"
    try:
        write(fresh)
    except BaseException:
        Folder(spark, parent).delete(fresh.rsplit("/", 1)[1])
        raise
    Folder(spark, path).move_in(fresh)
    return path


def write_current(df: DataFrame, root: str, name: str, version: str | None = None) -> str:
    """Publish a result's current copy, which ``sources.results.read_current`` reads.

    Each copy is a folder of its own, and ``_current`` names the one that holds. It is replaced by a rename once the copy is
    complete, so readers see the old copy or the new one and a job that fails changes nothing. The copy before stays, for
    readers that have opened it; older ones go.
    """
    spark = df.sparkSession
    path, fresh = f"{root}/current/{name}", f"copy-{version or run_stamp()}-{uuid.uuid4().hex[:8]}"
    before = current_copy(spark, root, name)
    df.write.parquet(f"{path}/{fresh}")
    folder = Folder(spark, path)
    folder.put_text(POINTER, fresh)
    for old in folder.names():
        if old.startswith("copy-") and old not in (fresh, before):
            folder.delete(old)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    return staged(df.sparkSession, path, lambda fresh: df.write.option("header", "true").csv(fresh))


def feature_line(df: DataFrame, geometry: str = "geometry") -> Column:
    """One GeoJSON feature as text; every other column is a property, missing ones are written as null."""
    properties = F.struct(*[N.quoted(c) for c in df.columns if c != geometry])
    return F.concat(
        F.lit('{"type":"Feature","properties":'),
        F.to_json(properties, {"ignoreNullFields": "false"}),
        F.lit(',"geometry":'),
        G.to_geojson(F.col(geometry)),
        F.lit("}"),
    )


def feature_lines(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    return df.select(feature_line(df, geometry).alias("value"))


def write_features(df: DataFrame, path: str, geometry: str = "geometry", srid: int = S.SRID_LONLAT) -> str:
    """Line-delimited features in longitude/latitude, as GeoJSON prescribes."""
    layer = df.withColumn(geometry, G.reproject(F.col(geometry), srid))
    return staged(df.sparkSession, path, lambda fresh: feature_lines(layer, geometry).write.text(fresh))


def write_aligned(frames: dict[str, DataFrame], root: str, unit: str) -> dict[str, str]:
    """Aligned inputs as Parquet, one folder per table and geographic unit."""
    out = {}
    for name, df in frames.items():
        out[name] = f"{root}/{name}/unit={unit}"
        df.write.mode("overwrite").parquet(out[name])
    return out


def export_results(
    results: ScoredRegions,
    root: str,
    threshold: float = S.IMPROVEMENT_THRESHOLD,
    vintage: str = S.DEFAULT_VINTAGE,
    run_ts: str | None = None,
    bundle: bool = True,
) -> dict[str, str]:
    """Write one run: history, ``current`` copies, timestamped CSV and, with ``bundle``, a run folder.

    Each result is computed once, into the history; every copy and the improvement list are made from what was
    written there.
    """
    run_ts = run_ts or run_stamp()
    spark = results.need_table.sparkSession
    paths: dict[str, str] = {}

    def store(name: str, df: DataFrame) -> DataFrame:
        paths[name] = write_run(df, root, name, run_ts, vintage)
        # With the schema given, a history that holds no rows yet reads as an empty table.
        schema = T.StructType([*df.schema.fields, *(T.StructField(c, T.StringType()) for c in ("vintage", "run_ts"))])
        history = spark.read.schema(schema).parquet(paths[name])
        this_run = (F.col("vintage") == vintage) & (F.col("run_ts") == run_ts)
        return history.filter(this_run).drop("vintage", "run_ts")

    def publish(name: str, df: DataFrame) -> None:
        stable = CURRENT_NAMES[name]
        write_current(df, root, stable, run_ts)
        paths[f"{name}.csv"] = write_csv(df, f"{root}/csv/{name}_{vintage}_{run_ts}.csv")
        write_csv(df, f"{root}/csv/{stable}.csv")
        if bundle:
            df.write.mode("overwrite").parquet(f"{root}/exports/run_{run_ts}/{name}")

    table = store("need_table", results.need_table)
    publish("need_table", table)
    publish("need_improvement", store("need_improvement", improvement_list(table, threshold)))
    if results.activity_metrics is not None:
        metrics = store("activity_metrics_by_county", results.activity_metrics)
        if not metrics.isEmpty():
            publish("activity_metrics_by_county", metrics)
    if results.layer is not None:
        layer = store("need_spatial", results.layer)
        name = f"need_spatial_{vintage}_{run_ts}.geojson"
        paths["need_spatial.geojson"] = write_features(layer, f"{root}/geojson/{name}")
        write_features(layer, f"{root}/geojson/{CURRENT_NAMES['need_spatial']}.geojson")
        write_current(layer, root, CURRENT_NAMES["need_spatial"], run_ts)
        if bundle:
            write_features(layer, f"{root}/exports/run_{run_ts}/need_spatial.geojson")
    return paths
