"""Publications arrive over time; each new file revises earlier periods.

``publish`` streams the publication files that have arrived into one Parquet
table (Spark's own file sink, each file once), and ``consolidated`` is the
keep-last aggregation over that table: per key the record of the latest
publication, then of the latest row.  Both folders lie in shared storage; a
restarted driver goes on at its checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelkit.operators.panel import keep_last


def publish(spark: SparkSession, source_dir: str, schema, table_dir: str, checkpoint_dir: str) -> None:
    """Append every publication file that is available now to the table."""
    (spark.readStream.schema(schema).parquet(source_dir)
          .writeStream.format("parquet").option("path", table_dir).option("checkpointLocation", checkpoint_dir)
          .trigger(availableNow=True).start().awaitTermination())


def consolidated(spark: SparkSession, table_dir: str, schema, key: list[str], order_cols=("pub_seq", "row")) -> DataFrame:
    """Per key, the latest of all records published so far."""
    return keep_last(spark.read.schema(schema).parquet(table_dir), key, order_cols)
