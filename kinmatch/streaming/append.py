"""An extension: new listings as a stream against a static catalog.

Code rarity and the best match of a listing look at all listings, so a stream cannot keep them up row by row. Each micro-batch is matched
with the catalog by the same plan, with the rarity of its codes in the batch, and appended; the best match of each listing is
chosen again by whoever reads the matches.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import matching
from ..operators.standardize import catalog_codes, listing_codes, standard_catalog, standard_listing
from ..shipping import ship


def match_new_listings(listings: DataFrame, catalog_raw: DataFrame, out: str, checkpoint: str, *, available_now: bool = False) -> StreamingQuery:
    """Starts a query that writes each batch's matches to out/batch=N; a batch that is run again overwrites its own folder."""
    ship(catalog_raw.sparkSession)
    catalog = standard_catalog(catalog_raw).persist()  # every batch reads it

    def one(batch: DataFrame, number: int) -> None:
        listing = standard_listing(batch)
        cand = matching.candidates(catalog_codes(catalog), listing_codes(listing))
        found = matching.categorized(matching.scored(matching.validated(matching.paired(cand, catalog, listing))))
        found.write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = listings.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
