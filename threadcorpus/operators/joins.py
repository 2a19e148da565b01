"""Join helpers: broadcast only behind a size check, a skew-aware shuffle join beyond it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only up to this many rows and this many bytes of content for each of them.
BROADCAST_MAX_ROWS = 2_000_000
ROW_BYTES = 64
# What the shuffle join needs of the session.
SKEW_SETTINGS = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled",
                 "spark.sql.adaptive.forceOptimizeSkewedJoin")


def broadcast_rows(df: DataFrame) -> int:
    """Rows of ``df``, or as many rows of ``ROW_BYTES`` bytes as its content fills if that is more.

    One aggregation; pass a materialized frame.
    """
    content = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    size = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(content), F.lit(0)).alias("bytes")).first()
    return max(size["rows"], -(-size["bytes"] // ROW_BYTES))


def checked_join(big: DataFrame, small: DataFrame, on: Sequence[str] | str, how: str = "inner",
                 max_rows: int = BROADCAST_MAX_ROWS, small_rows: int | None = None) -> DataFrame:
    """Equi-join ``big`` with ``small`` on column names ``on``.

    ``small`` is broadcast when its size by :func:`broadcast_rows` (given, or
    counted here; pass a materialized frame so counting is cheap) is at most
    ``max_rows``, so long values count as several rows. A larger side is joined
    by a shuffle. A hot key is then split by its measured size: AQE cuts an
    oversized partition of ``big`` into pieces of the advisory size, each of
    which reads that partition of ``small`` again, so the number of tasks grows
    with the key and nothing else is copied. The session is told to do so even
    where a later step must shuffle once more.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left", "left_outer", "left_semi", "leftsemi", "left_anti", "leftanti"):
        raise ValueError(f"checked_join keeps the big side whole; unsupported join type {how!r}")
    n = broadcast_rows(small) if small_rows is None else small_rows
    if n <= max_rows:
        return big.join(F.broadcast(small), keys, how)
    for name in SKEW_SETTINGS:
        big.sparkSession.conf.set(name, "true")
    return big.join(small, keys, how)
