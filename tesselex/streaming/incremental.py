"""Chunks of newly arrived documents, each processed once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tesselex.operators.chunks import children


def chunk_stream(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str) -> StreamingQuery:
    """Reads all parquet files that came since the last run, leaves out deliveries seen before (by file and time of
    receipt), writes their chunks. The checkpoint takes the place of a ledger: it keeps file and time of every delivery,
    as any may come at any age.
    """
    new = spark.readStream.schema(schema).parquet(source)
    once = new.dropDuplicates(["arquivo_origem", "recebido_em"])
    return children(once).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def failures_per_day(spark: SparkSession, source: str, schema: StructType, late: str = "7 days") -> DataFrame:
    """Streaming count of failures per day and reason; a day is final once the newest failure is `late` past it."""
    rows = spark.readStream.schema(schema).parquet(source).withWatermark("tentado_em", late)
    return rows.groupBy(
        F.window("tentado_em", "1 day").alias("dia"), "motivo"
    ).agg(F.count("*").alias("falhas")).select(F.col("dia.start").alias("dia"), "motivo", "falhas")
