"""Session helpers.

The library never assumes a machine-local scratch folder: lineage is cut with
``DataFrame.checkpoint()`` into the folder named by ``spark.checkpoint.dir``
(read from the session). A scratch folder is made only where none is configured
and the session runs in one local process, as in tests and local benchmarks.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "codefacts") -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    parts = shuffle_partitions or int(os.environ.get("CODEFACTS_SHUFFLE_PARTITIONS", "8"))
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(parts))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", os.environ.get("CODEFACTS_DRIVER_MEMORY", "16g")))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session. Only a session that runs in
    one local process gets a scratch folder of its own where none is set; on a
    cluster executors do not share one, so that is an error."""
    conf = spark.sparkContext.getConf()
    d = (conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
         or spark.sparkContext.getCheckpointDir())
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="codefacts-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def shuffled(df):
    """``df`` as the side of a join that is shuffled, whatever its size is taken
    for. Catalyst counts 20 bytes for a text and nothing for the rows that a
    generator adds, so tables built from text look small enough to be collected
    by the driver and broadcast."""
    return df.hint("merge")


def cut(df, rebalance=True):
    """Checkpoint ``df`` into the shared checkpoint folder and return the
    checkpointed DataFrame (lineage cut, survives executor loss).

    Loops that union several branches of the previous step would multiply its
    partitions each round; the rows are dealt out anew, into as many partitions
    as their size asks for (adaptive execution decides). ``rebalance=False`` saves
    that shuffle where the last step of ``df`` is a join or an aggregation, and
    keeps the partitions of texts that are read again: dealt out by their
    (compressed) size, they are read in a few tasks."""
    checkpoint_dir(df.sparkSession)
    return (df.hint("rebalance") if rebalance else df).checkpoint(eager=True)


def written(df):
    """``df`` written as Parquet into the shared folder and read again. In a long
    loop a checkpoint carries the constraints of its plan into the next step, and
    the driver spends ever longer on them; a file has none."""
    folder = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/rows-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
