"""Incremental crawl frontier with Structured Streaming and keyed state.

Newly stored pages arrive as parquet files.  Each page gives its own URL and
the URLs it links to; state keyed by URL (``applyInPandasWithState``) remembers
whether a URL is a stored page and whether the frontier has it, so a batch
never reads what earlier batches wrote: J5 costs what the batch holds.  A URL
comes out once, in the first batch that links to it, unless that batch or an
earlier one stored it.  The state holds two flags for every URL seen and no
more, in RocksDB (executor disk, snapshots in the checkpoint folder).

A URL that very many pages link to is reduced by Arrow batch before the
shuffle and read in chunks after it.  Batches are written to
``<frontier>/epoch=<id>`` with overwrite, and a replayed batch starts from the
state before it, so it replaces its own output instead of adding to it.

Rows without a URL are left out; a page stored twice is stored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pairloom.operators.pages import page_links
from pairloom.session import checkpoint_dir

PAGE_SCHEMA = "page_id long, url string, html string"
#: Where the state lives; the default of Spark would keep every key in executor memory.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def url_events(pages: DataFrame) -> DataFrame:
    """(url, stored): a page's own URL as stored, the URLs it links to as not; fewer repeats, not none."""

    def distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.drop_duplicates()

    links = page_links(pages).select(F.col("abs_url").alias("url"), F.lit(False).alias("stored"))
    both = pages.select("url", F.lit(True).alias("stored")).unionByName(links)
    return both.where(F.col("url").isNotNull()).mapInPandas(distinct, "url string, stored boolean")


def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """One URL of one batch: state (stored, listed), and the URL if it is new to the frontier."""
    stored, listed = state.get if state.exists else (False, False)
    linked = False
    for pdf in batches:
        stored = stored or bool(pdf["stored"].any())
        linked = linked or not bool(pdf["stored"].all())
    new = linked and not stored and not listed
    state.update((stored, listed or new))
    if new:
        yield pd.DataFrame({"url": [key[0]]})


def start_frontier(spark, pages_dir: str, frontier_path: str, glob: str = "pages*.parquet",
                   checkpoint_path: str | None = None, files_per_trigger: int = 1, state_store: str = STATE_STORE):
    """Start the stream; returns the StreamingQuery (``availableNow``)."""
    checkpoint_path = checkpoint_path or os.path.join(checkpoint_dir(spark), "frontier-stream")
    pages = (spark.readStream.schema(PAGE_SCHEMA).option("pathGlobFilter", glob)
             .option("maxFilesPerTrigger", files_per_trigger).parquet(pages_dir))
    fresh = url_events(pages).groupBy("url").applyInPandasWithState(
        step, "url string", "stored boolean, listed boolean", "append", GroupStateTimeout.NoTimeout)

    def batch(df: DataFrame, epoch_id: int) -> None:
        df.write.mode("overwrite").parquet(os.path.join(frontier_path, f"epoch={epoch_id}"))

    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, state_store)  # a started query keeps the settings of its start
    try:
        return (fresh.writeStream.outputMode("append").foreachBatch(batch).option("checkpointLocation", checkpoint_path)
                .trigger(availableNow=True).start())
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)
