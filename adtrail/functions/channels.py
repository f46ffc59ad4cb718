"""Platform -> revenue channel lookup as a literal map (MAP1)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from adtrail.schemas import PLATFORM_TO_CHANNEL


def channel_for_platform(platform: Column | str = "platform",
                         mapping: dict[str, str] | None = None) -> Column:
    """Channel name for a platform; platforms outside the map give NULL.

    The map is a literal inside the expression, so the lookup runs in
    generated code with no join and no broadcast.
    """
    mapping = PLATFORM_TO_CHANNEL if mapping is None else mapping
    p = F.col(platform) if isinstance(platform, str) else platform
    lit_map = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    return F.try_element_at(lit_map, p)
