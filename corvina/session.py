"""Session settings and folders."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, shuffle: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName("corvina")
        .config("spark.sql.shuffle.partitions", str(shuffle)).config("spark.driver.memory", memory).config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session, or one set here where it is unset (tests)."""
    got = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not got:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = os.path.join(tempfile.gettempdir(), f"corvina-{os.getpid()}")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        got = "file://" + folder
        spark.conf.set("spark.checkpoint.dir", got)
    return got


def parts(spark: SparkSession) -> int:
    """Partitions for work that is far heavier than its rows are large, and that adaptive execution would put into one task."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), spark.sparkContext.defaultParallelism)


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """`df` written once to the shared folder and read again, so that later uses do not repeat its plan."""
    path = f"{shared_dir(df.sparkSession)}/corvina/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once an application, for where it is not installed on them."""
    import pathlib
    import zipfile

    # batches of whole texts: the default number of rows would hold hundreds of megabytes in a worker
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = pathlib.Path(__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="corvina-")  # the driver sends the file on from here
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        path = os.path.join(folder, "corvina_package.zip")
        with zipfile.ZipFile(path, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        spark.sparkContext.addPyFile(path)
        _SHIPPED.add(app)
    return spark
