"""Written intermediate tables.

A staged table cuts lineage the way ``DataFrame.checkpoint`` does, but as Parquet: it is
compressed, later passes read only the columns they need, and it survives the loss of any
executor because it lies in the shared folder the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only in local mode with none set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    folder = folder or context.getCheckpointDir()
    if not folder:
        if context.master.startswith("local-cluster") or not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tablewright-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder no other call uses."""
    return f"{_own_folder(spark)}/{label}-{uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tablewright-{spark.sparkContext.applicationId}"


def clear_staged(spark: SparkSession) -> None:
    """Delete what this application staged; frames which still read it must not be used again."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a scan of the written rows.

    Columns are stored by position, so duplicate or unusual names are no obstacle. A frame
    with a type Parquet lacks is checkpointed instead.
    """
    if any(_not_storable(field.dataType) for field in df.schema.fields):
        shared_folder(df.sparkSession)
        return df.checkpoint()
    path = fresh_path(df.sparkSession, label)
    stored = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    stored.write.parquet(path)
    return df.sparkSession.read.schema(stored.schema).parquet(path).toDF(*df.columns)


def _not_storable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_not_storable(field.dataType) for field in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _not_storable(kind.elementType)
    if isinstance(kind, T.MapType):
        return _not_storable(kind.keyType) or _not_storable(kind.valueType)
    return isinstance(kind, (T.NullType, T.CalendarIntervalType))


def rename_all(df: DataFrame, prefix: str) -> DataFrame:
    """Positional rename to ``<prefix>0, <prefix>1, ...``."""
    return df.toDF(*[f"{prefix}{i}" for i in range(len(df.columns))])


def null_safe_match(left: list, right: list):
    """AND of ``<=>`` over two equally long column lists."""
    matched = F.lit(True)
    for a, b in zip(left, right):
        matched = matched & a.eqNullSafe(b)
    return matched
