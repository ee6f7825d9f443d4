"""Audit of the files a job wrote."""

from __future__ import annotations

import logging
from datetime import datetime

from pyspark.sql import DataFrame

from termflow.operators.listings import (
    freshness_counts,
    latest_key_per_group,
    size_percentiles,
)

log = logging.getLogger(__name__)


def audit_files(
    listing: DataFrame, start: datetime | str | None = None
) -> dict[str, DataFrame]:
    """Freshness counts, size percentiles and latest key per group.

    Raises ValueError when the listing is empty or holds no file modified at
    ``start`` or later; warns about older files. A malformed key fails the
    query on ``latest_keys``; nothing is ever deleted.
    """
    counted = freshness_counts(listing, start)
    counts = counted.first()
    # Counted once: the frame returned holds the row that was found.
    freshness = listing.sparkSession.createDataFrame([counts], counted.schema)
    if counts["num_old_keys"] + counts["num_new_keys"] == 0:
        raise ValueError("no keys found")
    if counts["num_old_keys"] > 0:
        log.warning("%d old keys", counts["num_old_keys"])
    if counts["num_new_keys"] == 0:
        raise ValueError("no new files generated")
    return {
        "freshness": freshness,
        "sizes": size_percentiles(listing),
        "latest_keys": latest_key_per_group(listing, strict=True),
    }
