"""Segment to channel lookup, an inline literal relation (S3)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class ChannelMap:
    """Maps segments to channels, any number of them; a segment it does not know, or NULL, is
    ``Other``."""

    OTHER = "Other"

    def __init__(self, channel_of: Mapping[str, str]) -> None:
        self.channel_of = dict(channel_of)

    def relation(self, spark: SparkSession) -> DataFrame:
        """``known_segment, channel``, one row per known segment."""
        if not self.channel_of:
            return spark.createDataFrame([], "known_segment string, channel string")
        pairs = enumerate(self.channel_of.items())
        values = {f"{kind}{i}": text for i, pair in pairs for kind, text in zip("sc", pair, strict=True)}
        rows = ", ".join(f"(:s{i}, :c{i})" for i in range(len(self.channel_of)))
        text = f"SELECT * FROM VALUES {rows} AS channel_map(known_segment, channel)"
        return spark.sql(text, args=values)

    def join(self, df: DataFrame, segment: str, into: str = "channel") -> DataFrame:
        """Add the channel of a segment (J1); the map is a literal of the program, broadcast."""
        known = F.broadcast(self.relation(df.sparkSession))
        joined = df.join(known, F.expr(f"{segment} = known_segment"), "left")
        channel = F.coalesce(known["channel"], F.lit(self.OTHER)).alias(into)
        return joined.select(*[df[name] for name in df.columns], channel)


# The shipped four-channel taxonomy.
MARKETING_CHANNELS = ChannelMap(
    {
        "Direct App": "O&O",
        "Direct Web": "O&O",
        "Paid Other O&O": "O&O",
        "EM": "O&O",
        "SEM": "SEM",
        "Paid Other": "SEM",
        "SEO": "SEO",
        "Partnership": "Partnership",
    }
)
