"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job in the package relies on. AQE re-plans joins from
# runtime sizes (broadcast only what turned out small) and splits skewed
# shuffle partitions; the time zone keeps results engine-independent.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows hold whole documents: a batch is bounded by its bytes, on both sides of the pipe
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # iterative jobs checkpoint every few rounds: copies no longer referenced go
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "parapet",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # local mode runs every task in the driver JVM: give it the heap a
        # small executor fleet would have (clusters size executors themselves)
        settings["spark.driver.memory"] = os.environ.get("PARAPET_DRIVER_MEMORY", "12g")
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ship_package(spark)


def _bound_batches(spark: SparkSession) -> None:
    """Sessions made elsewhere take this package's bound unless they set one."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.sparkContext.getConf().get(key) is None and spark.conf.get(key) == "67108864b":
        spark.conf.set(key, DEFAULT_CONF[key])


def ship_package(spark: SparkSession) -> SparkSession:
    """Send the package's modules to the executors, once per application.

    Python workers import functions by module name; on a cluster, or from
    another working folder, only shipped files are on their path. Spark
    serves the archive itself, so the driver's copy may be machine-local."""
    _bound_batches(spark)
    sc = spark.sparkContext
    if getattr(sc, "_parapet_shipped", False):
        return spark
    here = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="parapet-code-")
    archive = os.path.join(folder, "parapet_code.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(base, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(here)))
    sc.addPyFile(archive)
    sc._parapet_shipped = True
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Taken from ``spark.checkpoint.dir`` (or a directory already set on the
    context). Only a local-mode session without one gets a fresh temporary
    folder; on a cluster a machine-local folder would not survive the loss of
    an executor, so an unset folder is an error there.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        configured = tempfile.mkdtemp(prefix="parapet-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss).

    The input is persisted first: writing a reliable checkpoint is a second
    job over the data, which would otherwise compute it all again."""
    checkpoint_dir(df.sparkSession)
    cached = df.persist()
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()
