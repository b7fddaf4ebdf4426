"""Monthly flight files landed in a folder -> partitioned Parquet.

A file-source stream remembers in its checkpoint which files it has already
processed, so each run picks up only new drops (the skip-if-exists rule of
the month loop) and a failed run resumes where it stopped. ``availableNow``
processes everything present and stops, which suits a monthly schedule.

The stream carries file names only; a batch reads its files with the batch CSV
reader and writes them as the batch jobs do (``year/month/source_file`` partitions, one
root for both). A batch hence replaces rows of its own files and no others: a month may be
spread over files and batches, a correction file adds to its month, and a repeated batch
writes the same rows again. The months of a batch are recorded in the root's ledger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarmac.session import written
from tarmac.sources.flights import read_flights_csv, write_flights
from tarmac.sources.ledger import recorded

# schema of Spark's binary file source, of which only the path is read
_FILES = "path string, modificationTime timestamp, length long, content binary"


def ingest_monthly_drops(spark: SparkSession, landing_dir: str, out_root: str, checkpoint: str,
                         files_per_batch: int = 64) -> int:
    """Run until every landed file is ingested; returns the number of batches.
    ``checkpoint`` belongs to one landing folder and must outlive the run;
    ``files_per_batch`` sets the size of a batch and no result."""
    names = (spark.readStream.format("binaryFile").schema(_FILES)
             .option("maxFilesPerTrigger", files_per_batch)
             .option("pathGlobFilter", "*.csv*")
             .load(landing_dir).select("path"))
    batches = []

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        files = [r.path for r in batch.collect()]  # at most files_per_batch names
        if files:
            own = batch.sparkSession
            rows = written(read_flights_csv(own, files, literal=True), "drop")
            months = [(r.year, r.month) for r in rows.select("year", "month").where("year is not null and month is not null").distinct().collect()]
            with recorded(own, out_root, months):
                write_flights(rows, out_root)
            batches.append(epoch_id)

    q = (names.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(batches)
