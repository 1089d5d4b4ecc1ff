"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(app: str = "hirelens", cores: int | str = "*") -> SparkSession:
    """A session for tests and the bench. Cluster jobs bring their own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


#: Bytes of a method up to which the JVM compiles it.
COMPILED = "8000"


def prefer_compiled(spark: SparkSession) -> None:
    """Have Spark give up a fused stage whose method the JVM would not compile but interpret.

    Its operators then run one by one in code that is cut into small methods. Spark's own bound is the
    largest method a class may hold; wide projections lie between the two and run several times slower.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", COMPILED)


@contextmanager
def configured(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for as long as the block runs."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session that names none gets a
    temporary folder, since driver and executors are then the same machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="hirelens-")
    return _local_roots[app]


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder; never reused, so a retry cannot see old files."""
    return f"{shared_root(spark)}/hirelens/{purpose}-{uuid.uuid4().hex}"
