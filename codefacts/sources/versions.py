"""Tables with a current version, SURVEY S9.

Rule records and the spec are read, changed and written in place by the analysed
tool. Here a change is two steps: the rows go to a fresh folder
``<base>/<name>/data/v-<id>``, then one small file ``<base>/<name>/versions/<n>``
that names the folder is moved into place. Readers take the highest number, so
they see a whole version, the old one or the new one; a write that fails before
the move leaves the old one current. The move does not replace a file, so of two
writers that start from one version the second gets a ``VersionConflict``.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


class VersionConflict(RuntimeError):
    """Another writer has published since the rows were read."""


def _folder(spark: SparkSession, path: str):
    """The Hadoop path of ``path`` and its file context."""
    conf = spark._jsc.hadoopConfiguration()
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p = p.getFileSystem(conf).makeQualified(p)
    return p, spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), conf)


def _versions(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}/versions"


def current_version(spark: SparkSession, base: str, name: str) -> tuple[int, str] | None:
    """Number and data folder of the current version; ``None`` before the first."""
    folder, fc = _folder(spark, _versions(base, name))
    if not fc.util().exists(folder):
        return None
    numbers = [int(x) for x in (s.getPath().getName() for s in fc.util().listStatus(folder)) if x.isdigit()]
    if not numbers:
        return None
    n = max(numbers)
    pointer = spark.read.text(f"{_versions(base, name)}/{n:09d}").first()
    return n, f"{base.rstrip('/')}/{name}/data/{pointer.value}"


def read_current(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The rows of the current version. The DataFrame stays on that version also
    when a later one is published."""
    found = current_version(spark, base, name)
    if found is None:
        raise FileNotFoundError(f"no version of {name} has been published under {base}")
    return spark.read.parquet(found[1])


def publish(df: DataFrame, base: str, name: str, after: int | None = None) -> int:
    """Write ``df`` as a new version and make it current; returns its number.

    ``after``: the version that the rows were made from (0: none); by default
    the one that is current when the write begins. ``VersionConflict`` if another
    version is current by the time the rows are written.
    """
    spark = df.sparkSession
    if after is None:
        after = (current_version(spark, base, name) or (0, ""))[0]
    data = f"v-{uuid.uuid4().hex}"
    df.write.parquet(f"{base.rstrip('/')}/{name}/data/{data}")
    folder, fc = _folder(spark, _versions(base, name))
    fc.mkdir(folder, None, True)
    hadoop = spark._jvm.org.apache.hadoop.fs
    draft, target = hadoop.Path(folder, f".{data}"), hadoop.Path(folder, f"{after + 1:09d}")
    out = folder.getFileSystem(spark._jsc.hadoopConfiguration()).create(draft, False)
    out.write(bytearray(data.encode()))
    out.close()
    plain = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        fc.rename(draft, target, plain)
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in e.java_exception.getClass().getName():
            raise
        fc.delete(draft, False)
        raise VersionConflict(f"version {after + 1} of {name} was published by another writer") from e
    return after + 1


def upsert(current: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """``changes`` in the place of the rows of ``current`` with the same ``key``,
    the other rows as they are. Columns that one side lacks are null there. Rows
    with a null key are never replaced."""
    kept = current.join(changes.select(key).distinct(), key, "left_anti")
    return kept.unionByName(changes, allowMissingColumns=True)
