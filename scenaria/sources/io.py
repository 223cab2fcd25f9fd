"""Sources and sinks.

Scenario folders hold one CSV per scenario (``<scenario>.csv``) with a header row; Spark-written
folders (``<scenario>.csv/part-*.csv``) are accepted too.  Each file is read by its own header: files of
equal headers share a scan, typed by the role rule, and the scans are united by name, columns that a
file lacks being null.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scenaria.roles import Roles
from scenaria.session import checkpoint_dir


def schema_from_header(names, time: str = "Time") -> T.StructType:
    """S3: Time -> double; a name containing 'label' -> tinyint (nullable); any other -> float."""
    fields = []
    for n in names:
        if n == time:
            t = T.DoubleType()
        elif "label" in n.lower():
            t = T.ByteType()
        else:
            t = T.FloatType()
        fields.append(T.StructField(n, t, True, {"role": "time" if n == time else
                                                 ("label" if "label" in n.lower() else "feature")}))
    return T.StructType(fields)


def headers_of(spark: SparkSession, path_glob: str) -> dict[tuple[str, ...], list[str]]:
    """Files by their header line: the first line of each file, found by Spark among the lines of its first
    block.  The driver gets one row per file, as it does when Spark lists a folder."""
    lines = (spark.read.text(path_glob).select(F.col("_metadata.file_path").alias("path"), "value",
                                               F.col("_metadata.file_block_start").alias("at"))
             .where("at = 0").withColumn("line", F.monotonically_increasing_id()))
    first = lines.groupBy("path").agg(F.min(F.struct("line", "value")).alias("f")).select("path", "f.value")
    out: dict[tuple[str, ...], list[str]] = {}
    for r in sorted(first.collect(), key=lambda r: r.path):
        out.setdefault(tuple(c.strip().strip('"') for c in r.value.split(",")), []).append(r.path)
    return out


def header_of(spark: SparkSession, path_glob: str) -> list[str]:
    """All column names of a folder's files, in the order in which sorted files bring them."""
    return list(dict.fromkeys(c for h in headers_of(spark, path_glob) for c in h))


def scenario_key(first_dot: bool = False):
    """Key from the file name without '.csv' (or cut at the first dot, the reference's rule);
    for Spark part files the parent folder names the scenario."""
    path = F.col("_metadata.file_path")
    name = F.col("_metadata.file_name")
    parent = F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)
    src = F.when(name.startswith("part-"), parent).otherwise(name)
    return F.substring_index(src, ".", 1) if first_dot else F.regexp_extract(src, r"^(.*)\.csv$", 1)


def read_scenarios(spark: SparkSession, folder: str, time: str = "Time", key: str = "scenario_id",
                   first_dot: bool = False) -> tuple[DataFrame, Roles]:
    """All CSVs of a folder, each by its own header, united by name, with the scenario key.  Column order
    and missing columns differ from file to file as they like."""
    groups = headers_of(spark, f"{folder}/*.csv")  # files, or Spark-written folders of part files
    names = list(dict.fromkeys(c for h in groups for c in h))
    df = None
    for header, paths in groups.items():
        one = (spark.read.schema(schema_from_header(header, time)).option("header", True).option("enforceSchema", False)
               .option("mode", "FAILFAST").csv(paths)).select("*", scenario_key(first_dot).alias(key))
        df = one if df is None else df.unionByName(one, allowMissingColumns=True)
    if df is None:
        raise FileNotFoundError(f"no CSV file with a header below {folder}")
    return df.select(*names, key), Roles.infer(names, key=key, time=time)


def roles_from_metadata(df: DataFrame, key: str = "scenario_id", time: str = "Time") -> Roles:
    """Roles back from ``StructField.metadata`` after a Parquet round trip."""
    feats = [f.name for f in df.schema.fields if f.metadata.get("role") == "feature"]
    labels = [f.name for f in df.schema.fields if f.metadata.get("role") == "label"]
    return Roles(key=key, time=time, features=tuple(feats), labels=tuple(labels))


def write_snapshot(df: DataFrame, path: str, split_col: str = "split") -> None:
    """Parquet, partitioned by split so readers prune to one split."""
    w = df.write.mode("overwrite")
    (w.partitionBy(split_col) if split_col in df.columns else w).parquet(path)


def read_snapshot(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """One split of a snapshot (partition pruning)."""
    df = spark.read.parquet(path)
    return df.where(F.col("split") == split) if split else df


def write_bucketed(df: DataFrame, table: str, path: str, key: str, order, buckets: int) -> None:
    """A table at ``path`` bucketed by ``key`` and sorted inside its buckets by (key, order): joins and windows by the key
    read it without a shuffle.  Rows are dealt to the buckets once before the write, so each is one file.  For a
    key that may be hot, windows are better asked by chunk (see ``keyed``); a bucket holds whole keys."""
    rows = df.repartition(buckets, key)
    rows.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key, *order).option("path", path).saveAsTable(table)


def write_report(df: DataFrame, path: str) -> None:
    """A small report table as one CSV with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_report(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """An earlier report, or None when there is none at the path; any other failure is raised."""
    r = spark.read.option("header", True)
    try:
        return (r.schema(schema) if schema else r.option("inferSchema", True)).csv(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def shared_scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder (never a machine-local path)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
