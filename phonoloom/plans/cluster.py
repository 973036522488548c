"""What depends on the cluster a session runs on: shared folder, lineage cuts, table access."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Wide enough for a task's rows to stay in memory, small enough for a retry to be cheap.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # small tables keep all cores busy: much of the work here is by row, not by byte
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
}


def local_session(name: str = "phonoloom", cores: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One of the tables below ``root``; timestamps without a zone come out as they are."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only where the setting is absent (tests, a laptop) a temporary folder stands in for it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not hasattr(shared_dir, "own"):
        shared_dir.own = tempfile.mkdtemp(prefix="phonoloom-")
        atexit.register(shutil.rmtree, shared_dir.own, ignore_errors=True)
    return f"file://{shared_dir.own}"


_OWN: set[str] = set()


def own_dir(spark: SparkSession, what: str) -> str:
    """A new name below this application's part of the shared folder. The whole part goes when the application ends,
    whatever file system it is on."""
    root = f"{shared_dir(spark).rstrip('/')}/phonoloom-{spark.sparkContext.applicationId}"
    if root not in _OWN:
        _OWN.add(root)
        folder = spark._jvm.org.apache.hadoop.fs.Path(root)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(folder)
        files.deleteOnExit(folder)
    return f"{root}/{what}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: the lineage ends here, a lost executor costs one read,
    and the planner knows the size."""
    path = own_dir(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """A scan for work that is heavy by row: one that comes in fewer partitions than there are cores is spread over
    them. Larger inputs stay where they lie."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def tokenizer_dir() -> str:
    """Where the public tokenizers' files are; PHONOLOOM_TOKENIZERS overrides it."""
    return os.environ.get("PHONOLOOM_TOKENIZERS", "/opt/tokenizers")
