"""Where jobs put intermediate tables.

Executors write these tables and read them back, so they belong in a folder that
all of them share: the one the session names in ``spark.checkpoint.dir``, else
the warehouse. A local path is taken only by a local session.
"""

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder in which this application's intermediate tables lie."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir")
        if re.match(r"file:|/", shared) and not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set spark.checkpoint.dir: executors do not share {shared}")
    return f"{shared.rstrip('/')}/scratch-{spark.sparkContext.applicationId}"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path for one intermediate table or group of tables."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame, written as a table and read back: computed once however often
    it is used, and not computed anew when an executor is lost."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession, path: str | None = None) -> None:
    """Delete one intermediate folder, or all that this application wrote."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path or scratch_root(spark))
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
