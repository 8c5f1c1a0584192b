"""Refresh from a landing folder as files arrive.

Each micro-batch finds out which partitions its new files belong to, recomputes those
from everything landed in them, and replaces them; one of which nothing is left goes.
The partitions of a batch change together, after all of them are written. A batch that
is repeated after a failure writes the same partitions again, so the result is the same.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caudal.sources.publish import Publication


def refresh_from_landing(
    spark: SparkSession,
    landing: str,
    schema: T.StructType | str,
    clean: Callable[[DataFrame], DataFrame],
    target: str,
    keys: Sequence[str],
    checkpoint: str,
    files_per_batch: int = 1000,
) -> int:
    """Process what has landed since the last call; returns the number of batches.

    ``landing`` is laid out in folders by ``keys``, which ``schema`` includes, and
    ``clean`` turns landed rows into the stored table, laid out by the same keys.
    """
    batches = []
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")

    def replace_touched(batch: DataFrame, batch_id: int) -> None:
        # A file lies in one partition, so a batch touches at most `files_per_batch` of
        # them. Their folders alone are listed and read.
        touched = batch.select(*[F.col(k).cast("string").alias(k) for k in keys], "_folder").distinct().collect()
        if touched:
            folders = sorted({unquote(t["_folder"]) for t in touched})
            landed = read_folders(batch.sparkSession, landing, schema, folders)
            parts = {tuple(t[k] for k in keys): t for t in touched}
            with Publication(batch.sparkSession) as publication:
                publication.stage_partitions(clean(landed), target, keys, list(parts.values()))
        batches.append(batch_id)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landing).select("*", folder.alias("_folder"))
    query = stream.writeStream.foreachBatch(replace_touched).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(batches)


def read_folders(spark: SparkSession, landing: str, schema: T.StructType | str, folders: Sequence[str]) -> DataFrame:
    """Some partition folders of a landing, keys included. Others are neither listed nor read."""
    return spark.read.schema(schema).option("basePath", landing).parquet(*folders)
