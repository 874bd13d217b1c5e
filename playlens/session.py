"""Session defaults and the shared work folder."""

import tempfile
import uuid
from collections import defaultdict
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def session(app="playlens", master=None, **conf):
    """A session with adaptive execution and a UTC clock; ``conf`` wins."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_dir(spark, name):
    """A new folder path below the shared folder of ``spark.checkpoint.dir``.

    Every call gives another path, so a re-run never overwrites data that a
    still-lazy DataFrame reads. A machine-local fallback exists for local masters only.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="playlens-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/playlens/{name}/{uuid.uuid4().hex}"


def _files(spark, path):
    """(file system, path) of a path, which may hold any character."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def delete(spark, path):
    """Delete a folder or file with all below it; none there is fine."""
    files, place = _files(spark, path)
    files.delete(place, True)


def names_in(spark, path):
    """Names of what a folder holds; none if it is not there."""
    files, place = _files(spark, path)
    return {f.getPath().getName() for f in files.listStatus(place)} if files.exists(place) else set()


def observed(observation):
    """The counts of an ``Observation``; zero each where Spark knew that there were no rows."""
    try:
        return observation.get
    except Py4JJavaError as error:
        if "AssertionError" not in str(error.java_exception):  # it has no row then
            raise
        return defaultdict(int)


@contextmanager
def temporary_dir(spark, name):
    """A ``work_dir`` that is deleted when the block ends; read nothing from it later."""
    path = work_dir(spark, name)
    try:
        yield path
    finally:
        delete(spark, path)


def kept(df):
    """A small result run now and kept at a checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()
