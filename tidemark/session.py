"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


#: Temporary folders of local runs without ``spark.checkpoint.dir``, by application.
_local_roots: dict[str, str] = {}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator here is written for.

    Hours and days are read in the session zone, so it is pinned to UTC. Keyword
    names use ``__`` for the dots of a setting.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared ``spark.checkpoint.dir``, under the id of the application.

    Written tables and stream checkpoints must outlive any executor, so on a
    cluster the setting is required; a local run without it uses a temporary folder.
    ``clear_scratch`` removes them all.
    """
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Removes what this application wrote below ``spark.checkpoint.dir``.

    DataFrames that still read from there cannot be computed any more, so this is for the
    end of a job, or for between its steps once their results are stored elsewhere.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(root, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever file system the path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(place)


def _scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        application = spark.sparkContext.applicationId
        if application not in _local_roots:
            _local_roots[application] = tempfile.mkdtemp(prefix="tidemark-")
        root = _local_roots[application]
    return f"{root.rstrip('/')}/tidemark/{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """``df`` as a table in the scratch folder, so that several passes over it compute it once.

    ``options`` are those of the Parquet writer.
    """
    folder = scratch_dir(df.sparkSession, name)
    df.write.options(**(options or {})).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def run_together(spark: SparkSession, *jobs: Callable[[], object]) -> None:
    """Runs independent Spark actions at the same time, so that small ones share the cluster."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]:
            done.result()
