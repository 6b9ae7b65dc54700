"""Replacing partitions of a Parquet table so that readers never meet a gap.

New partitions are written beside the table, in ``_beside/<writer>/`` (folders
with an underscore are no data to Spark). The write is decided by one small
file, ``_manifest/<version>.json``, made only if no such version is there yet:
before it, the table is what it was; after it, the new partitions are the
table's. Then each replaced partition's folder changes place with the new one,
and ``<version>.done`` says that all of them have. ``read_current`` reads a
partition from beside the table as long as its folder is still there, and
``recover``, run before each write, finishes what a lost writer left. So a
failure at any point leaves the old or the new rows of all partitions.

The old folders stay in ``_replaced/<version>/`` until the next write, for
readers that have begun.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from stratocast.session import java_path


class Taken(RuntimeError):
    """Another writer has made the file first."""


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there; a store that can't tell is an error."""
    fs, at = java_path(spark, path)
    return fs.exists(at)


def glob(spark: SparkSession, pattern: str) -> list:
    """The paths that match (a listing of folders, no data)."""
    fs, at = java_path(spark, pattern)
    return [s.getPath() for s in fs.globStatus(at) or ()]


def delete(spark: SparkSession, paths: Sequence) -> None:
    for at in paths:
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = java_path(spark, path)
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _rename(spark: SparkSession, source, target) -> None:
    """Rename without overwriting (atomic in HDFS and like stores)."""
    options = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    none = spark._sc._gateway.new_array(options, 0)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(source, target, none)


def put_if_absent(spark: SparkSession, path: str, text: str) -> None:
    """Make the file ``path`` whole and at once, or raise ``Taken`` if it is
    there: a file beside it is renamed without overwriting, or, if it is local,
    gets its name as a link."""
    fs, at = java_path(spark, path)
    fs.mkdirs(at.getParent())
    _, new = java_path(spark, f"{os.path.dirname(path)}/_{uuid.uuid4().hex}")
    out = fs.create(new, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        if fs.getScheme() == "file":
            os.link(new.toUri().getPath(), at.toUri().getPath())
        else:
            _rename(spark, new, at)
    except (FileExistsError, Py4JJavaError) as e:
        if fs.exists(at):
            raise Taken(path) from e
        raise
    finally:
        fs.delete(new, False)


def _versions(spark: SparkSession, table: str) -> list[tuple[int, bool]]:
    """(version, done) of the writes that are still listed, in order."""
    names = {p.getName() for p in glob(spark, f"{table}/_manifest/[0-9]*")}
    numbers = sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))
    return [(n, f"{n:020d}.done" in names) for n in numbers]


def _manifest(spark: SparkSession, table: str, version: int) -> dict:
    return json.loads(read_text(spark, f"{table}/_manifest/{version:020d}.json"))


def move(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder, unless another run of ``_apply`` has done so."""
    fs, at = java_path(spark, source)
    if not fs.exists(at):
        return
    _, to = java_path(spark, target)
    fs.mkdirs(to.getParent())
    try:
        _rename(spark, at, to)
    except Py4JJavaError:
        if not fs.exists(to):
            raise


def _apply(spark: SparkSession, table: str, version: int) -> None:
    """Bring the partitions of a decided write to their places; may be repeated
    from any point, and run twice at once."""
    m = _manifest(spark, table, version)
    for part in m["partitions"]:
        new, old = f"{table}/_beside/{m['writer']}/{part}", f"{table}/_replaced/{version:020d}/{part}"
        if part in m["written"] and not exists(spark, new):
            continue  # in its place already
        # a folder under the old name says that the place is free
        fs, at = java_path(spark, old)
        if not fs.exists(at):
            move(spark, f"{table}/{part}", old)
            fs.mkdirs(at)
        move(spark, new, f"{table}/{part}")
    try:
        put_if_absent(spark, f"{table}/_manifest/{version:020d}.done", "")
    except Taken:
        pass
    delete(spark, glob(spark, f"{table}/_beside/{m['writer']}"))


def recover(spark: SparkSession, table: str) -> None:
    """Finish the writes that are decided and not in place."""
    for version, done in _versions(spark, table):
        if not done:
            _apply(spark, table, version)


def partitions(spark: SparkSession, root: str, depth: int) -> list[str]:
    """The partition folders below ``root``, as relative paths."""
    found = glob(spark, "/".join([root, *["[!_.]*=*"] * depth]))
    return sorted("/".join(p.toUri().getPath().split("/")[-depth:]) for p in found)


def replace_partitions(
    spark: SparkSession, table: str, by: Sequence[str], write: Callable[[str], None], replaced: Sequence[str] = ()
) -> int:
    """Run ``write(folder)``, which writes partitions by the columns ``by``, and
    let these take the place of the table's; partitions in ``replaced`` (relative
    paths) that it doesn't write go. Returns the write's version. Of two writers
    at once, each one's partitions are replaced whole, the later one's last."""
    recover(spark, table)
    writer = uuid.uuid4().hex
    beside = f"{table}/_beside/{writer}"
    write(beside)
    written = partitions(spark, beside, len(by))
    manifest = json.dumps({"writer": writer, "partitions": sorted({*written, *replaced}), "written": written})
    while True:
        recover(spark, table)
        version = 1 + max((v for v, _ in _versions(spark, table)), default=0)
        try:
            put_if_absent(spark, f"{table}/_manifest/{version:020d}.json", manifest)
            break
        except Taken:
            continue
    _apply(spark, table, version)
    _tidy(spark, table, version)
    return version


def _tidy(spark: SparkSession, table: str, version: int) -> None:
    """Drop what earlier, finished writes replaced, and their manifests."""
    for v, done in _versions(spark, table):
        if v < version and done:
            delete(spark, glob(spark, f"{table}/_replaced/{v:020d}"))
            delete(spark, glob(spark, f"{table}/_manifest/{v:020d}.json") + glob(spark, f"{table}/_manifest/{v:020d}.done"))


def read_current(spark: SparkSession, table: str, by: Sequence[str] = ("date",)) -> DataFrame:
    """The table's rows by the decided writes, in their places or beside it."""
    open_ = {}
    for version, done in _versions(spark, table):
        if not done:
            m = _manifest(spark, table, version)
            for part in m["partitions"]:
                open_[part] = f"{table}/_beside/{m['writer']}" if part in m["written"] else None
    if not open_:
        return spark.read.parquet(table)
    places: dict[str, list[str]] = {}
    for part in sorted({*partitions(spark, table, len(by)), *open_}):
        root = open_.get(part, table)
        if root is None:
            continue
        # moved meanwhile: it is in its place
        root = root if exists(spark, f"{root}/{part}") else table
        places.setdefault(root, []).append(f"{root}/{part}")
    if not places:
        raise FileNotFoundError(f"no partitions in {table}")
    parts = [spark.read.option("basePath", root).parquet(*paths) for root, paths in places.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
