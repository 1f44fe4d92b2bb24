"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str = "daybook", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Pin what results depend on; all instants are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs started inside, and the earlier ones after that."""
    before = {name: spark.conf.get(name) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared ``spark.checkpoint.dir``.

    Without that setting a local session, as in tests, gets a folder of its own;
    on a cluster it must be set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="daybook-")
    return f"{base.rstrip('/')}/daybook-{uuid.uuid4().hex}/{name}"


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    hadoop_path, system = _path(spark, path)
    return system.exists(hadoop_path)


def names_below(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders right below a path, sorted; none if there is no such path."""
    hadoop_path, system = _path(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(hadoop_path)) if system.exists(hadoop_path) else []


def mark(spark: SparkSession, path: str) -> None:
    """Put an empty file at a path."""
    hadoop_path, system = _path(spark, path)
    system.create(hadoop_path, True).close()


def remove_path(spark: SparkSession, path: str, root: str) -> None:
    """Remove a path below ``root``, on whatever file system it lies."""
    if not path.startswith(root.rstrip("/") + "/"):
        raise ValueError(f"{path} does not lie below {root}")
    hadoop_path, system = _path(spark, path)
    system.delete(hadoop_path, True)
