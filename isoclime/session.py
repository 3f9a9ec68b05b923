"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

#: Scratch folders and tables of this process, in the order they were named.
_made: list[tuple[str, str]] = []


def session(name: str = "isoclime", **settings: str) -> SparkSession:
    """A session in UTC with ANSI errors and adaptive execution; ``settings`` use __ for dots."""
    builder = SparkSession.builder.appName(name)
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in settings.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, as the session has it.

    Where it is unset, a local master gets a fresh local folder; any other master is an error, as its
    executors could not read what the driver's machine holds.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", "")
        if not named and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return sc.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, remembered for ``release``."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(("folder", path))
    return path


def scratch_table(name: str) -> str:
    """A new table name, remembered for ``release``."""
    name = f"{name}_{uuid.uuid4().hex}"
    _made.append(("table", name))
    return name


def mark() -> int:
    """The state of the scratch list, for ``release``."""
    return len(_made)


def release(spark: SparkSession, since: int = 0, keep_last: bool = False) -> None:
    """Delete scratch folders and tables named after ``since`` (a ``mark``), all but the last with ``keep_last``.

    Data frames that still read them can no longer be computed: call it when their results are written.
    """
    gone = _made[since : len(_made) - 1 if keep_last and len(_made) > since else len(_made)]
    for kind, name in gone:
        if kind == "table":
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        else:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    del _made[since : since + len(gone)]
