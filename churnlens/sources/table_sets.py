"""Several tables published as one commit.

The tables of a version are written below ``<root>/data/<id>``, where no reader looks,
and become visible together by one small file, ``<root>/manifest/<number>.json``, that names
them. Readers follow the newest whole manifest, so after a failure between two writes they
still see the tables of the version before, or none. A manifest is created only if its
number is free: of two writers one fails. A torn manifest (its writer died) has no
closing brace and is passed over. Works on any filesystem that Hadoop mounts; no rename is needed.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from churnlens.session import drop_path
from churnlens.sources.sinks import write_parquet


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def manifests(spark: SparkSession, root: str) -> dict[int, dict[str, str]]:
    """Every whole manifest: number -> {table: path below the root}."""
    root, out = root.rstrip("/"), {}
    for name in _children(spark, f"{root}/manifest"):
        try:
            out[int(name.removesuffix(".json"))] = json.loads(_read_text(spark, f"{root}/manifest/{name}"))["tables"]
        except ValueError:  # torn, or not a manifest
            continue
    return out


def published(spark: SparkSession, root: str, version: int | None = None) -> dict[str, str]:
    """The paths of a version's tables (by default the newest); none when nothing is published."""
    all_of = manifests(spark, root)
    if version is None:
        version = max(all_of, default=0)
    elif version not in all_of:
        raise ValueError(f"{root} has no version {version}")
    return {name: f"{root.rstrip('/')}/{path}" for name, path in all_of.get(version, {}).items()}


def read_published(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    paths = published(spark, root, version)
    if name not in paths:
        raise ValueError(f"{root} has published no table {name!r}")
    return spark.read.parquet(paths[name])


def commit(spark: SparkSession, root: str, tables: dict[str, str]) -> int:
    """Publish tables by their paths below the root; the new version's number."""
    root = root.rstrip("/")
    names = [n.removesuffix(".json") for n in _children(spark, f"{root}/manifest")]
    number = max((int(n) for n in names if n.isdigit()), default=0) + 1
    fs, p = _fs(spark, f"{root}/manifest/{number:08d}.json")
    stream = fs.create(p, False)  # fails if another writer was faster
    try:
        stream.write(bytearray(json.dumps({"tables": tables}).encode()))
    finally:
        stream.close()
    return number


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame], *, keep: dict[str, str] | None = None) -> int:
    """Write tables and publish them together, with earlier ones to ``keep`` (name -> path
    below the root); the new version's number."""
    at = f"data/{uuid.uuid4().hex[:12]}"
    for name, df in tables.items():
        write_parquet(df, f"{root.rstrip('/')}/{at}/{name}")
    return commit(spark, root, {**(keep or {}), **{name: f"{at}/{name}" for name in tables}})


def write_together(spark: SparkSession, tables: dict[str, DataFrame], mode: str = "errorifexists") -> None:
    """Write tables to paths of the caller's choice so that none appears before all are complete:
    each is written beside its place, then all are moved. A failure before the moves leaves no
    table (with ``overwrite`` the old ones); a failed move takes back the moves before it. Where a
    crash between two moves matters, publish a table set instead."""
    if mode not in ("errorifexists", "error", "overwrite"):
        raise ValueError(f"mode is 'errorifexists' or 'overwrite', not {mode!r}")
    paths = {path.rstrip("/"): df for path, df in tables.items()}
    there = [p for p in paths if path_exists(spark, p)]
    if there and mode != "overwrite":
        raise FileExistsError(f"already exists: {', '.join(there)}")
    tag = uuid.uuid4().hex[:12]
    moved: list[tuple[str, str]] = []
    try:
        for path, df in paths.items():
            write_parquet(df, f"{path}.staged-{tag}")
        for path in there:
            _move(spark, path, f"{path}.old-{tag}", moved)
        for path in paths:
            _move(spark, f"{path}.staged-{tag}", path, moved)
    except BaseException:
        for source, target in reversed(moved):
            _move(spark, target, source, [])
        raise
    finally:
        for path in paths:
            drop_path(spark, f"{path}.staged-{tag}")
    for path in there:
        drop_path(spark, f"{path}.old-{tag}")


def _move(spark: SparkSession, source: str, target: str, moved: list[tuple[str, str]]) -> None:
    fs, p = _fs(spark, source)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"could not move {source} to {target}")
    moved.append((source, target))


def vacuum(spark: SparkSession, root: str, versions: int = 1) -> list[str]:
    """Delete the data that none of the newest ``versions`` manifests names (of failed or
    replaced writes); the deleted folders. Not while another writer is at work."""
    root = root.rstrip("/")
    all_of = manifests(spark, root)
    live = {path.split("/")[1] for n in sorted(all_of)[-versions:] for path in all_of[n].values()}
    gone = [f for f in _children(spark, f"{root}/data") if f not in live]
    for folder in gone:
        drop_path(spark, f"{root}/data/{folder}")
    return gone
