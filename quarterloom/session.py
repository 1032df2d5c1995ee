"""Sessions, tables and the shared folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "quarterloom", cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session with the settings the engine is tested with; on a
    cluster the submitter's settings hold."""
    b = SparkSession.builder.appName(app).master(f"local[{cpus}]")
    base = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    }
    for k, v in (base | conf).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """A table that comes in fewer splits than there are cores, such as one
    small file, is dealt out before Python works on it; any larger one stays
    where it lies.  For plain scans: counting splits must not run a query."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


_made: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share.
    Only where it is unset and the session is local (tests, one machine) a
    local one is made; on a cluster it must be set."""
    got = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not got:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        got = "file://" + tempfile.mkdtemp(prefix="quarterloom-")
        spark.conf.set("spark.checkpoint.dir", got)
    return got.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _clean() -> None:
    for spark, path in _made:
        try:
            _delete(spark, path)
        except Exception:  # the session may be gone
            pass


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: read any number of
    times, computed once, safe against the loss of executors.  Removed at the
    end of the enclosing :func:`intermediates`, else when the process ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/quarterloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _made.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def intermediates() -> Iterator[None]:
    """Tables of :func:`written` made within are removed at the end, so the
    results that read them must have been stored by then."""
    before = len(_made)
    try:
        yield
    finally:
        for spark, path in _made[before:]:
            _delete(spark, path)
        del _made[before:]


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    if root.suffix != ".zip" and root.is_dir():
        at = tempfile.mkdtemp(prefix="quarterloom-ship-")
        made = shutil.make_archive(f"{at}/quarterloom_package", "zip", root.parent, root.name)
        spark.sparkContext.addPyFile(made)
        atexit.register(shutil.rmtree, at, ignore_errors=True)
    _shipped.add(app)
