"""Keep-latest deduplication on a business key.

``row_number() over (partition by key order by ts desc, tie-break...) = 1``.
Catalyst turns the filter into a ``WindowGroupLimit`` that runs once before
the shuffle (each map task forwards at most one row per key) and once after,
so a key that holds a third of all rows never reaches one task whole: it
arrives as at most one row per input split.

Ties: bronze stamps one ``_ingested_at`` per ingest, so every row of a batch
ties on it. To make the survivor reproducible the remaining columns break
the tie (descending, nulls last) unless the caller names other columns. The
bronze lineage columns (constant within a batch) are left out of that
default, so a plan that does not output them never carries them, e.g. the
long source-file path, through the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardmarts.schemas import LINEAGE_COLUMNS

_RN = "__cardmarts_rn"


def keep_latest(
    df: DataFrame,
    key: str,
    order_by: Sequence[str] = ("_ingested_at",),
    tie_break: Sequence[str] | None = None,
    keep_null_keys: bool = False,
) -> DataFrame:
    """One row per ``key``: the greatest by ``order_by`` then ``tie_break``, all descending.

    Rows whose key is null form one group, so one of them survives; with
    ``keep_null_keys=True`` they all pass through untouched instead.
    """
    if tie_break is None:
        taken = {key, *order_by, *LINEAGE_COLUMNS}
        tie_break = [c for c in df.columns if c not in taken]
    ordering: list[Column] = [F.col(c).desc_nulls_last() for c in (*order_by, *tie_break)]
    w = Window.partitionBy(key).orderBy(*ordering)
    keyed = df
    if keep_null_keys:
        keyed = df.filter(F.col(key).isNotNull())
    out = keyed.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)
    if keep_null_keys:
        out = out.unionByName(df.filter(F.col(key).isNull()))
    return out
