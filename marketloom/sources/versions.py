"""Tables that are committed together.

A store keeps versions. A version's tables are written to a folder of their own, and then a manifest that names them is put
in place by one rename. Readers see what the newest manifest names: all tables of a version or none. A load that is killed
leaves files that no manifest names; running it again writes new ones.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


class Taken(RuntimeError):
    """Someone else has committed the version that was to be written."""


def refuse_live(path: str, live: str | None = None, word: str = "backtest") -> None:
    """What is replayed must not land among live data: the path has to say so, and may not lie in, or hold, the live one."""
    own = path.rstrip("/") + "/"
    if word not in own.rsplit("/", 2)[1]:
        raise ValueError(f"refusing to write to {path}: the folder's name has to contain '{word}'")
    if live and (own.startswith(live.rstrip("/") + "/") or (live.rstrip("/") + "/").startswith(own)):
        raise ValueError(f"refusing to write to {path}: it overlaps the live data in {live}")


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def newest(spark: SparkSession, path: str) -> int:
    """The number of the newest version, 0 if there is none."""
    files, at = _folder(spark, f"{path}/manifests/*.json")
    return max([int(f.getPath().getName().removesuffix(".json")) for f in files.globStatus(at) or []], default=0)


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict[str, str]:
    """Where the tables of a version (the newest by default) lie; empty if there is none."""
    version = newest(spark, path) if version is None else version
    if not version:
        return {}
    line = spark.read.text(f"{path}/manifests/{version:08d}.json").first()[0]  # a few names
    return {name: f"{path}/{place}" for name, place in json.loads(line)["tables"].items()}


def read(spark: SparkSession, path: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of a version, the newest by default."""
    return {name: spark.read.parquet(place) for name, place in manifest(spark, path, version).items()}


def commit(spark: SparkSession, path: str, tables: dict[str, DataFrame], onto: int | None = None, partition_by: dict[str, list[str]] | None = None) -> int:
    """Writes the next version and returns its number. Tables of version `onto` (the newest by default) that aren't given stay.

    Raises Taken, and changes nothing, if another version was committed meanwhile."""
    onto = newest(spark, path) if onto is None else onto
    version, place = onto + 1, f"data/{uuid.uuid4().hex}"
    for name, table in tables.items():
        table.write.partitionBy(*(partition_by or {}).get(name, [])).parquet(f"{path}/{place}/{name}")
    kept = {name: at.removeprefix(f"{path}/") for name, at in manifest(spark, path, onto).items()} if onto else {}
    line = json.dumps({"version": version, "tables": kept | {name: f"{place}/{name}" for name in tables}})
    draft, target = f"{path}/manifests/.{uuid.uuid4().hex}", f"{path}/manifests/{version:08d}.json"
    files, at = _folder(spark, draft)
    out = files.create(at, False)
    try:
        out.write(bytearray(line.encode()))
    finally:
        out.close()
    hadoop, gateway = spark._jvm.org.apache.hadoop.fs, spark.sparkContext._gateway
    never_over = gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    never_over[0] = getattr(hadoop, "Options$Rename").NONE
    try:
        hadoop.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration()).rename(at, hadoop.Path(target), never_over)
    except Exception as taken:
        if "FileAlreadyExists" not in str(taken):
            raise
        files.delete(at, False)
        raise Taken(f"version {version} of {path} was committed by someone else") from taken
    return version
