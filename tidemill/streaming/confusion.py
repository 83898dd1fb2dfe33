"""Running evaluation while predictions arrive."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.evaluate import confusion_counts
from tidemill.plans.scratch import scratch_dir


def stream_table(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet table, folder or single file, read as a stream of files."""
    # A pattern that matches only the path itself: a plain path to one file is
    # refused by the file source as a base folder.
    path = path.rstrip("/")
    pattern = f"{path[:-1]}[{path[-1]}]"
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(pattern)


def stream_confusion(stream: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Running confusion cells; the state has at most K x K rows.  Write it in complete or update mode."""
    return confusion_counts(stream, y_true, y_pred)


def run_to_end(counts: DataFrame, checkpoint: str | None = None) -> DataFrame:
    """Process all available input, then return the final cells as a table.

    Every micro-batch writes the cells to a folder of its own beside the
    checkpoint, so a repeated batch replaces itself; nothing is held by the
    driver.  A restart with the same checkpoint folder goes on where the
    stream stopped.
    """
    spark = counts.sparkSession
    checkpoint = (checkpoint or scratch_dir(spark, "stream")).rstrip("/")
    cells = f"{checkpoint}-cells"
    # An empty first folder: a stream without input has cells to read, too.
    spark.createDataFrame([], counts.schema).write.mode("overwrite").parquet(f"{cells}/batch=-1")
    writer = counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer.foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{cells}/batch={n}")).start().awaitTermination()
    written = spark.read.schema(T.StructType([*counts.schema.fields, T.StructField("batch", T.LongType())])).parquet(cells)
    return written.where(F.col("batch") == written.agg(F.max("batch")).scalar()).drop("batch")
