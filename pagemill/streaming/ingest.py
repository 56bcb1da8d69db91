"""Pages that arrive as files, chunked document by document as they come.

A document arrives whole in one file, so no state is carried between batches; a delivery that comes again replaces
the chunks of its documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagemill.operators.chunks import enrich, structural_chunks
from pagemill.sources.sinks import write_documents

_RAW = "source_id string, page string, text string, parser string, _corrupt_record string"


def page_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Pages of JSON-lines files as they are put into ``path``; broken lines are left out."""
    raw = spark.readStream.schema(_RAW).option("maxFilesPerTrigger", files_per_batch).option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    return raw.filter("_corrupt_record is null").select("source_id", F.expr("try_cast(page as int)").alias("page"), F.coalesce("text", F.lit("")).alias("text"), "parser")


def chunk_stream(pages: DataFrame, out: str, checkpoint: str, with_enrichment: bool = True) -> StreamingQuery:
    """Writes the chunks of every batch; ends when all files now present are done."""

    def write(batch: DataFrame, _: int) -> None:
        chunks = structural_chunks(batch)
        write_documents(enrich(chunks) if with_enrichment else chunks, out)

    return pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
