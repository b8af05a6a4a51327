"""Written intermediate tables, for iterations and for plans that would otherwise compute a table many times."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame

#: Shuffle files of a finished write go at once, and not only when the driver happens to collect its garbage.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str, replaces: Iterable[DataFrame] = ()) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read back: cuts the lineage and survives lost executors.

    ``replaces``: tables of earlier calls that nothing reads any more once this one is there; their files are deleted.
    Where the setting is missing, a temporary folder serves a local session; a cluster, whose machines share no local
    folder, is refused.
    """
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    for old in replaces:
        _delete(spark, old._written_to)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def _delete(spark, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
