"""Names and types that every part of the package agrees on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StringType, StructField, StructType

KEYS = ("BRAND", "WALL_ID", "WALLGROUP_ID", "CAMPAIGN_ID")

# Everything is read as text: ids must not change type with the files that happen
# to be present, and a malformed time must not fail the read.
EVENT_SCHEMA = StructType(
    [StructField(name, StringType()) for name in (*KEYS, "EVENT_TYPE", "DAY", "ISOTIMESTAMP")]
)

# The event types as they appear in the data.
WALL_IMPRESSION = "wall-impression"
PRODUCT_IMPRESSION = "product-impression"
PRODUCT_CLICK = "product-click"
POST_IMPRESSION = "post-impression"
POST_CLICK = "post-click"


@dataclass(frozen=True)
class Pair:
    """The two event types a rate is made of."""

    impression: str
    click: str

    @property
    def types(self) -> tuple[str, str]:
        return self.impression, self.click


PRODUCT = Pair(PRODUCT_IMPRESSION, PRODUCT_CLICK)
POST = Pair(POST_IMPRESSION, POST_CLICK)

ALL_TYPES = (WALL_IMPRESSION, *PRODUCT.types, *POST.types)

# Events may land an hour before or after the day they belong to. The batch reads
# that many extra landing hours on each side, the streams wait that long.
GRACE_HOURS = 1
LATENESS = "60 minutes"
