"""Tables one job writes into the shared folder and the next one reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kanaat.session import shared_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written once below spark.checkpoint.dir and read back: later jobs and lost executors read files
    instead of computing again (checkpoint() would compute it twice)."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, group: str, order: list[Column], spread: Column, pieces: int, into: str) -> DataFrame:
    """Numbers the rows of each group gaplessly from 0 in the column ``into``. A group may hold any share of all
    rows: it is dealt to ``pieces`` parts by ``spread``, each part is ordered by itself and continues where the
    parts before it end. Only (group, part) counts are summed up, so the table that is joined back has at most
    groups x pieces rows."""
    dealt = df.withColumn("_part", F.pmod(F.xxhash64(spread), F.lit(pieces)).cast("int"))
    counts = dealt.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(group).alias("_g"), F.col("_part").alias("_p"),
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = Window.partitionBy(group, "_part").orderBy(*order)
    return (dealt.withColumn("_at", F.row_number().over(place))
            .join(starts, (F.col(group) == F.col("_g")) & (F.col("_part") == F.col("_p")))
            .withColumn(into, (F.col("_start") + F.col("_at") - 1).cast("long"))
            .drop("_part", "_g", "_p", "_start", "_at"))
