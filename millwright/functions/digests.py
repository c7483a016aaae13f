"""Stable row digests that do not depend on partitioning or row order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_ABSENT = "\x00"


def row_digest(columns: Sequence[str], seed: int) -> Column:
    """32 hex digits over the columns with a seed in front; NULL counts as a value.

    One column gives ``md5('<seed>:<text>')``, which any SQL engine can repeat.
    More columns are hashed as they are, which spares turning numbers into text.
    """
    if len(columns) == 1:
        text = F.coalesce(F.col(f"`{columns[0]}`").cast("string"), F.lit(_ABSENT))
        return F.md5(F.concat(F.lit(f"{seed}:"), text))
    # the hash skips NULLs, so their places are hashed as well
    cells = [c for name in columns for c in (F.isnull(f"`{name}`"), F.col(f"`{name}`"))]
    halves = [F.xxhash64(F.lit(part), F.lit(seed), *cells) for part in (1, 2)]
    return F.concat(*[F.lpad(F.hex(half), 16, "0") for half in halves])
