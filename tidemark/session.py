"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are designed for.  A session handed in from outside is used
# as it is; these are applied only by ``build_session``.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# applications whose folder below a local warehouse is removed at the end
_emptied: set[str] = set()
_shipped: set[str] = set()


def build_session(
    app_name: str = "tidemark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(RECOMMENDED)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables: below the one that the cluster names in
    ``spark.checkpoint.dir``, else below the warehouse.  Every executor reaches both; a
    machine's own temporary folder is never used."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if configured:
        return f"{configured.rstrip('/')}/{app}"
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch/{app}"
    if app not in _emptied and spark.sparkContext.master.startswith("local"):
        _emptied.add(app)
        atexit.register(shutil.rmtree, folder.removeprefix("file:"), ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Cuts the lineage for results that several later steps read, survives the loss of
    executors, and gives the planner real sizes for its join choices.  ``codec`` packs a table
    that stays for long more tightly than the session's would.
    """
    return materialize_parts([df], label, codec)


def materialize_parts(parts: Sequence[DataFrame], label: str, codec: str | None = None) -> DataFrame:
    """One table from parts of equal columns, written one after the other: the shuffle files of a part are gone
    before the next one makes its own."""
    spark, schema = parts[0].sparkSession, parts[0].schema
    path = scratch_path(spark, label)
    for i, part in enumerate(parts):
        writer = part.write.mode("append" if i else "errorifexists")
        (writer.option("compression", codec) if codec else writer).parquet(path)
        if len(parts) > 1:
            release(spark)
    return spark.read.schema(schema).parquet(path)


def release(spark: SparkSession, *written: DataFrame) -> None:
    """Give disk back in the midst of a long run: tables that ``materialize`` has written and that nothing reads any
    more, and the shuffle files of finished work.  Spark removes those once the driver's memory is cleaned, which by
    itself may come much later than the disk is full.  Tables outside the scratch folder stay."""
    context = spark.sparkContext
    for folder in {file.rsplit("/", 1)[0] for table in written for file in table.inputFiles()}:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(context._jsc.hadoopConfiguration())
        scratch = files.makeQualified(context._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark)))
        if files.makeQualified(path).getParent().equals(scratch):
            files.delete(path, True)
    gc.collect()
    context._jvm.System.gc()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="tidemark-ship-"), "tidemark"),
        "zip",
        root_dir=os.path.dirname(package),
        base_dir=os.path.basename(package),
    )
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
