"""Left join of transactions to fraud labels on transaction_id.

Labels are joined as they come: a repeated label repeats the transaction row
(the reference behaviour). The transaction side keeps its partitioning from
the dedup, so only the labels are shuffled, once.

A transaction id that repeats very often would send all its label rows, and
all its output rows, through one task; adaptive execution cannot split that
join, because the transaction side does not come straight from a shuffle. The
caller may therefore name such ids (``hot_ids``, see ``hot_label_ids``). Their
label rows are then spread over ``salts`` join keys and their transaction rows
repeated once per salt; every other row keeps salt 0. Nothing is broadcast and
every key is assigned before the spread. Naming no id plans the plain join.

The ids are named without a pass of their own: ``frequent_ids`` is an aggregate
that is observed while the labels are written to bronze, a mergeable summary of
frequent items. Each task keeps at most ``TRACKED`` ids with counters; a count
is never too low by more than 3.5 / 32,768 of all rows, so every id with more
than one row in ``MAX_HOT_IDS`` is among them, with a count that is never below
the true one. ``hot_label_ids`` finds them in a written table that has no summary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardmarts.functions.cleaning import label_to_boolean
from cardmarts.operators.dedup import keep_latest

KEY = "transaction_id"
HOT_KEY_ROWS = 1_000_000
MAX_HOT_IDS = 5_000
TRACKED = 20_000  # ids with a counter in a task's summary
LABEL_COLUMNS = ("is_fraud", "_bronze_batch_id_fraud_labels")
_SALT, _HIT = "__salt", "__hit"


def fraud_label_columns(labels: DataFrame) -> DataFrame:
    """``(transaction_id, is_fraud, _bronze_batch_id_fraud_labels)`` from bronze labels."""
    return labels.select(
        F.col(KEY),
        label_to_boolean("is_fraud_label").alias("is_fraud"),
        F.col("_batch_id").alias("_bronze_batch_id_fraud_labels"),
    ).filter(F.col(KEY).isNotNull())


def frequent_ids(column: str = KEY) -> Column:
    """The summary of a column's frequent values, as an aggregate; exact while there are at most ``TRACKED`` values."""
    return F.expr(f"approx_top_k({column}, {MAX_HOT_IDS}, {TRACKED})")


def hot_from_summary(summary: Sequence, rows: int, hot_key_rows: int = HOT_KEY_ROWS) -> list[str]:
    """Every id with more than ``hot_key_rows`` rows, and more than one row in ``MAX_HOT_IDS``, of the summary's (item, count)."""
    return sorted(item for item, count in summary if item is not None and count > hot_key_rows and count > rows / MAX_HOT_IDS)


def hot_label_ids(labels: DataFrame, hot_key_rows: int = HOT_KEY_ROWS, seed: int = 1) -> list[str]:
    """Ids with more than ``hot_key_rows`` label rows; runs jobs, so it belongs to a runner.

    A sample that expects a thousand rows of any such id names the candidates
    (those with at least half of that); only their rows are then counted, so
    the near-unique ids are not shuffled. An id also needs one row in
    ``MAX_HOT_IDS`` of all rows, which bounds the list.
    """
    ids = labels.select(KEY).filter(F.col(KEY).isNotNull())
    share = min(1.0, 1000 / hot_key_rows)
    least = share * hot_key_rows / 2
    total, drawn = ids.count(), ids.sample(fraction=share, seed=seed) if share < 1 else ids
    likely = drawn.groupBy(KEY).agg(F.count("*").alias("n")).filter(
        (F.col("n") >= least) & (F.col("n") >= share * total / MAX_HOT_IDS / 2))
    names = [r[0] for r in likely.select(KEY).collect()]
    if not names:
        return []
    exact = ids.filter(F.col(KEY).isin(names)).groupBy(KEY).agg(F.count("*").alias("n"))
    exact = exact.filter((F.col("n") > hot_key_rows) & (F.col("n") > total / MAX_HOT_IDS))
    return sorted(r[0] for r in exact.select(KEY).collect())


def attach_fraud_labels(
    txn: DataFrame,
    labels: DataFrame,
    dedup_labels: bool = False,
    hot_ids: Sequence[str] = (),
    salts: int = 64,
) -> DataFrame:
    """Add ``is_fraud`` and ``_bronze_batch_id_fraud_labels`` by transaction_id; lazy.

    ``txn`` holds one row per transaction_id. A transaction with no label keeps
    a null ``is_fraud`` (unknown, not false). ``dedup_labels=True`` keeps the
    latest label per id instead of all.
    """
    if dedup_labels:
        labels = keep_latest(labels, KEY)
    slim = fraud_label_columns(labels)
    if not hot_ids or dedup_labels:
        return txn.join(slim, KEY, "left")
    hot = F.col(KEY).isin(list(hot_ids))
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    spread = slim.withColumn(_SALT, F.when(hot, salt).otherwise(0)).withColumn(_HIT, F.lit(True))
    every = F.when(F.coalesce(hot, F.lit(False)), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    joined = txn.withColumn(_SALT, F.explode(every)).join(spread, [KEY, _SALT], "left")
    # a hot id has labels; those of its copies that met none are not rows of their own
    return joined.filter(F.col(_HIT).isNotNull() | ~F.coalesce(hot, F.lit(False))).drop(_SALT, _HIT)


def without_labels(txn: DataFrame, labels: DataFrame) -> DataFrame:
    """``txn`` with null label columns: for rows whose id is null, which can match nothing."""
    kinds = fraud_label_columns(labels).schema
    return txn.select("*", *[F.lit(None).cast(kinds[c].dataType).alias(c) for c in LABEL_COLUMNS])
