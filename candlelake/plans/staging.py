"""Stage boundaries: store a frame that later steps read several times."""

from __future__ import annotations

from pyspark.sql import DataFrame

from candlelake.session import work_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The stored table survives the loss of an executor, cuts the lineage, and
    gives later joins exact sizes to choose their strategy from.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
