"""Spark session, per-upload namespaces, and the shared scratch folder."""

from __future__ import annotations

import os
import re
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SHARED_NAMESPACE = "default"
# how long an upload is kept for a reader
LEASE_SECONDS = 3600
_SESSION_NAME = re.compile(r"[A-Za-z0-9_]{1,64}")


def spark_session(app: str = "basketry", cores: str = "*", **conf: str) -> SparkSession:
    """A session with the settings the results rely on; `conf` adds or replaces some."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        # building a plan is several times faster without call sites per column
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if "spark.master" not in settings and "SPARK_MASTER" not in os.environ:
        builder = builder.master(f"local[{cores}]")
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def namespace(session_id: str | None) -> str:
    """Database name of an upload session; None is the shared one."""
    if session_id is None:
        return SHARED_NAMESPACE
    if not _SESSION_NAME.fullmatch(session_id):
        raise ValueError("session id must be 1 to 64 letters, digits or underscores")
    return f"session_{session_id}"


def create_namespace(spark: SparkSession, session_id: str | None) -> str:
    name = namespace(session_id)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    return name


class UploadConflict(RuntimeError):
    """Another upload became current since this one began."""


def _files(spark: SparkSession, *below: str):
    """File system and path of a folder for what is known of a session's uploads."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    path = jvm.org.apache.hadoop.fs.Path("/".join([root, "_basketry", *below]))
    return path.getFileSystem(conf), path


def _names(spark: SparkSession, *below: str) -> list[str]:
    system, path = _files(spark, *below)
    return sorted(f.getPath().getName() for f in system.listStatus(path)) if system.exists(path) else []


def _create(spark: SparkSession, content: str, *below: str) -> bool:
    """Write a new file in one step; False if there is one of that name."""
    system, path = _files(spark, *below)
    system.mkdirs(path.getParent())
    if system.getScheme() == "file":
        target = path.toUri().getPath()
        draft = f"{target}-{uuid.uuid4().hex}"
        with open(draft, "w", encoding="utf-8") as out:
            out.write(content)
        try:
            os.link(draft, target)
        except FileExistsError:
            return False
        finally:
            os.remove(draft)
        return True
    try:
        out = system.create(path, False)
    except Exception as failed:
        if "AlreadyExists" in str(failed):
            return False
        raise
    out.write(content.encode())
    out.close()
    return True


def _read(spark: SparkSession, *below: str) -> str:
    system, path = _files(spark, *below)
    if not system.exists(path):
        return ""
    stream = system.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _versions(spark: SparkSession, database: str) -> list[tuple[int, str]]:
    """(number, database) of the uploads of a session's database that are kept; the last one is current."""
    numbers = [n for n in _names(spark, database, "versions") if n.isdigit()]
    found = [(int(n), _read(spark, database, "versions", n)) for n in numbers]
    return [(n, version) for n, version in found if version]


def version_number(spark: SparkSession, session_id: str | None) -> int:
    """Number of the session's current upload, 0 without one: what `publish` expects to find."""
    found = _versions(spark, namespace(session_id))
    return found[-1][0] if found else 0


def current_version(spark: SparkSession, database: str) -> str:
    """The database of the current upload of a session's database, else that database itself."""
    found = _versions(spark, database)
    return found[-1][1] if found else database


def _owner(spark: SparkSession, session_id: str | None) -> str:
    """The session's database if it has an upload or tables of its own, else the shared one."""
    name = namespace(session_id)
    return name if _versions(spark, name) or spark.catalog.databaseExists(name) else SHARED_NAMESPACE


def resolve_namespace(spark: SparkSession, session_id: str | None) -> str:
    """The database of the session's current upload if there is one, else the shared one's."""
    return current_version(spark, _owner(spark, session_id))


# end of the leases this driver holds, by application and upload
_leases: dict[tuple[str, str], float] = {}


def lease(spark: SparkSession, session_id: str | None) -> str:
    """Like `resolve_namespace`; the upload is then kept for LEASE_SECONDS, even if a new one comes.

    A lazy result of its tables can be run until then. Each call renews a lease that is half over.
    """
    owner = _owner(spark, session_id)
    while True:
        version = current_version(spark, owner)
        held = (spark.sparkContext.applicationId, version)
        if version == owner or _leases.get(held, 0) > time.time() + LEASE_SECONDS / 2:
            return version
        end = time.time() + LEASE_SECONDS
        _create(spark, "", owner, "leases", version, f"{int(end)}-{uuid.uuid4().hex}")
        # if it is still listed now, whoever wants to drop it sees the lease
        if any(version == kept for _, kept in _versions(spark, owner)):
            _leases[held] = end
            return version


def _is_leased(spark: SparkSession, owner: str, version: str) -> bool:
    return any(int(name.partition("-")[0]) > time.time() for name in _names(spark, owner, "leases", version))


def drop_old_versions(spark: SparkSession, session_id: str | None) -> None:
    """Drop the session's uploads that are neither current nor leased."""
    owner = namespace(session_id)
    for number, version in _versions(spark, owner)[:-1]:
        if _is_leased(spark, owner, version):
            continue
        # no longer listed, so no reader starts a lease; one that has just started keeps it
        entry = (owner, "versions", f"{number:012d}")
        system, path = _files(spark, *entry)
        system.delete(path, False)
        if _is_leased(spark, owner, version):
            _create(spark, version, *entry)
            continue
        drop_version(spark, version)
        system, path = _files(spark, owner, "leases", version)
        system.delete(path, True)


def new_version(spark: SparkSession) -> str:
    """A new database for an upload, not seen by readers before `publish`."""
    version = f"upload_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE `{version}`")
    return version


def drop_version(spark: SparkSession, version: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS `{version}` CASCADE")


def publish(spark: SparkSession, session_id: str | None, version: str, expected: int) -> None:
    """Make a version the session's current upload in one step, if number `expected` still is.

    Else UploadConflict is raised and nothing changes.
    """
    name = create_namespace(spark, session_id)
    taken = version_number(spark, session_id) != expected
    if taken or not _create(spark, version, name, "versions", f"{expected + 1:012d}"):
        raise UploadConflict(f"another upload of {name} became current meanwhile")


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the checkpoint folder of the session.

    Where none is set, a local session has one in its warehouse and a cluster an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return folder


# paths written by materialize, by application, and those of each open temporary_scratch
_written: dict[str, list[str]] = {}
_temporary: ContextVar[tuple[list[str], ...]] = ContextVar("temporary", default=())


def materialize(df: DataFrame, keep: bool = False) -> DataFrame:
    """Write `df` once to the scratch folder and read it back.

    Used where several jobs need the same costly frame: the lineage is cut, the
    copy survives lost executors, and each later job reads only its columns. The
    copies stay until `clear_scratch`, as a lazy result may read them at any time; those
    made inside `temporary_scratch` go with it, or if they are to be kept, with the one around it.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark).rstrip('/')}/basketry-{uuid.uuid4().hex}"
    scopes = [_written.setdefault(spark.sparkContext.applicationId, []), *_temporary.get()]
    scopes[-2 if keep and len(scopes) > 1 else -1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, paths: list[str]) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)


@contextmanager
def temporary_scratch(spark: SparkSession) -> Iterator[None]:
    """Copies that this thread materializes inside are deleted at the end; only kept ones outlive it."""
    paths: list[str] = []
    token = _temporary.set((*_temporary.get(), paths))
    try:
        yield
    finally:
        _temporary.reset(token)
        _delete(spark, paths)


def delete_copy(df: DataFrame) -> None:
    """Delete the copy that `materialize` made of this frame; nothing may read it any more."""
    spark = df.sparkSession
    mine = _written.get(spark.sparkContext.applicationId, [])
    gone = {p for p in mine if any(f"/{p.rpartition('/')[2]}/" in f for f in df.inputFiles())}
    mine[:] = [p for p in mine if p not in gone]
    _delete(spark, sorted(gone))


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; call it when results are written."""
    _delete(spark, _written.pop(spark.sparkContext.applicationId, []))
