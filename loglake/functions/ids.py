"""Message identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def message_id(topic: str = "topic", partition: str = "partition", offset: str = "offset") -> Column:
    """Hex SHA-256 of ``topic|partition|offset`` -- unique per message of a log."""
    return F.sha2(
        F.concat_ws("|", F.col(topic), F.col(partition).cast("string"), F.col(offset).cast("string")), 256
    )
