"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution sizes reducers and splits skewed join partitions from the
# measured shuffle output. Shuffle width itself is left to the deployment.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Without a Python stack trace per column expression, plans build faster.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "candor", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Paths handed out by application, and the folder of a single-machine session that names none.
_handed_out: dict[str, list[str]] = {}
_own_root: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is made only where that setting is absent, as in
    single-machine tests, and goes when the program ends; a cluster has to name
    shared storage. The session's settings stay as they are.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_root:
        _own_root[app] = tempfile.mkdtemp(prefix="candor-")
        atexit.register(shutil.rmtree, _own_root[app], ignore_errors=True)
    return _own_root[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/candor-{label}-{uuid.uuid4().hex}"
    _handed_out.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes on leaving what was stored inside: results still needed are to be written elsewhere by then."""
    paths = _handed_out.setdefault(spark.sparkContext.applicationId, [])
    before = len(paths)
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for path in paths[before:]:
            place = hadoop(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
        del paths[before:]


def stored(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to shared storage and read it back.

    Cuts the lineage in a way that survives lost executors, fixes values that
    must not be evaluated twice, and gives later joins true table sizes.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
