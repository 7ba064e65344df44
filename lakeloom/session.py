"""Session settings and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are written for.  None of them is needed for right
# results; they decide how well the plans adapt to skew and to size.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timeType.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


# Where each materialized frame lies.
_WRITTEN: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
# What was written while each open Scratch was.
_OPEN: dict[int, list[str]] = {}


def build_session(app_name: str = "lakeloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library's settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    A cluster has to name it.  Only a local master, where driver and executors
    are one process, falls back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="lakeloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path of its own for one written intermediate, never reused."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/lakeloom/{app}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back.

    Cuts the lineage like ``checkpoint()`` and survives lost executors, but
    stays columnar, so later reads prune columns, and it gives the optimizer
    true file sizes to choose joins by.
    """
    path = scratch_path(df.sparkSession, label)
    for paths in _OPEN.values():
        paths.append(path)
    df.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    _WRITTEN[written] = path
    return written


def discard(*frames: DataFrame) -> None:
    """Delete materialized frames.

    Only when all that was made of them is itself written: nothing can be computed from them again.
    """
    for frame in frames:
        delete_path(frame.sparkSession, _WRITTEN.pop(frame))


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder, whatever file system it is on; none is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def replace_path(spark: SparkSession, new: str, path: str) -> None:
    """Put a finished folder in the place of another one, which is readable up to the two renames and restored if they fail."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    place, target = hadoop.Path(new), hadoop.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    old = hadoop.Path(target.getParent(), f"_old-{uuid.uuid4().hex}")
    had = files.exists(target)
    if had and not files.rename(target, old):
        raise RuntimeError(f"cannot move {path} away")
    if not files.rename(place, target):
        if had:
            files.rename(old, target)
        raise RuntimeError(f"cannot move {new} to {path}")
    if had:
        files.delete(old, True)
    spark.catalog.refreshByPath(path)


class Scratch:
    """Owns what is materialized while it is open, and deletes it when it closes.

    ``with Scratch(spark): result.write.parquet(path)`` leaves nothing but the result.  What lasts longer is written
    before or after, or into ``keep``, which stays.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.kept = spark, set()

    def __enter__(self) -> Scratch:
        _OPEN[id(self)] = []
        return self

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        """Materialize ``df`` beyond this scratch."""
        written = materialize(df, label)
        self.kept.add(_WRITTEN[written])
        return written

    def __exit__(self, *_: object) -> None:
        for path in _OPEN.pop(id(self)):
            if path not in self.kept:
                delete_path(self.spark, path)
