"""Run the layers for one date: landing -> bronze -> silver -> gold.

Each table is one Spark job that reads the previous layer's *written* tables,
so lineage is cut at every layer and a lost executor costs at most the
current table's stages. A run follows the tables' dependencies: a table is
built as soon as its inputs are written, up to ``workers`` tables at a time,
each in a scheduler pool of its own (with ``spark.scheduler.mode=FAIR`` they share
the executors). A table that fails stops only those that need it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from cardmarts.operators.labels import frequent_ids, hot_from_summary, hot_label_ids
from cardmarts.plans.gold import GOLD_TABLES
from cardmarts.plans.silver import PARTITION_COLUMNS, SILVER_TABLES
from cardmarts.schemas import ENTITIES
from cardmarts.sinks.runlog import log_step, new_run_id, register_log, run_context
from cardmarts.sinks.tables import (
    Written,
    create_catalog_views,
    create_schema,
    current_path,
    new_version,
    publish_table,
    read_stats,
    read_table,
    read_version,
    register_table,
)
from cardmarts.sources.config import active_rows
from cardmarts.sources.landing import read_landing

LAYERS = ("bronze", "silver", "gold")
JOB_NAMES = {"bronze": "bronze_ingest", "silver": "silver_build", "gold": "gold_build"}


@dataclass(frozen=True)
class Lake:
    """Where the layers live; every path is under ``root`` (a shared file system)."""

    root: str
    fmt: str = "parquet"

    def table_root(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    @property
    def log_path(self) -> str:
        return f"{self.root.rstrip('/')}/control/pipeline_logs"

    def read(self, spark: SparkSession, layer: str, table: str) -> DataFrame:
        return read_table(spark, self.table_root(layer, table), self.fmt)


def _check(layer: str, table: str) -> None:
    known = {"bronze": ENTITIES, "silver": SILVER_TABLES, "gold": GOLD_TABLES}[layer]
    if table not in known:
        raise ValueError(f"Unsupported {layer} table: {table}")


def _logged(
    spark: SparkSession, lake: Lake, run_id: str, layer: str, table: str, work: Callable[[], Written],
    log: bool = True,
) -> Written:
    ctx = run_context(spark)
    step = f"build {layer}.{table}"

    def note(status: str, rows: int | None = None, err: str | None = None) -> None:
        if log:
            log_step(spark, lake.log_path, run_id, layer, table, step, status, JOB_NAMES[layer],
                     error_message=err, row_count=rows, context=ctx)

    note("STARTED", 0)
    try:
        out = work()
    except Exception as e:
        note("FAILED", err=str(e))
        raise
    note("SUCCESS", out.rows)
    return out


def ingest_entity(
    spark: SparkSession, lake: Lake, landing_root: str, entity: str, ingestion_date: str,
    source_format: str | None = None, run_id: str | None = None, log: bool = True,
    file_glob: str = "*.json", folder: str | None = None,
) -> Written:
    """Landing files of one entity and date -> a new version of its bronze table."""
    _check("bronze", entity)
    run_id = run_id or new_run_id()
    root = lake.table_root("bronze", entity)

    def work() -> Written:
        df = read_landing(spark, landing_root, entity, ingestion_date, source_format, file_glob=file_glob, folder=folder)
        # ids with very many labels are found in the same pass; the label join spreads them
        measures = {"frequent_ids": frequent_ids()} if entity == "fraud_labels" else None
        return publish_table(spark, df, root, version=_version(ingestion_date, run_id), fmt=lake.fmt, measures=measures)

    return _logged(spark, lake, run_id, "bronze", entity, work, log)


def _reader(spark: SparkSession, lake: Lake, layer: str, inputs: Mapping[str, Written] | None):
    def read(table: str) -> DataFrame:
        if inputs and table in inputs:
            return read_version(spark, lake.table_root(layer, table), inputs[table].path, lake.fmt)
        return lake.read(spark, layer, table)
    return read


def _hot_ids(spark: SparkSession, lake: Lake, labels: DataFrame, inputs: Mapping[str, Written] | None) -> list[str]:
    """Ids with very many labels: from the summary kept with the bronze version, else by a look at the labels."""
    written = (inputs or {}).get("fraud_labels")
    stats = read_stats(spark, written.path if written else current_path(spark, lake.table_root("bronze", "fraud_labels")))
    return hot_from_summary(stats["frequent_ids"], stats["rows"]) if stats else hot_label_ids(labels)


def build_silver_table(
    spark: SparkSession, lake: Lake, table: str, load_date: str, run_id: str | None = None,
    log: bool = True, inputs: Mapping[str, Written] | None = None,
) -> Written:
    """Bronze tables -> a new version of one silver table (the fact partitioned by month).

    ``inputs`` pins bronze versions (as returned by the bronze run); other
    inputs are read at their live copy.
    """
    _check("silver", table)
    run_id = run_id or new_run_id()
    builder, sources = SILVER_TABLES[table]
    parts = PARTITION_COLUMNS.get(table, ())

    read = _reader(spark, lake, "bronze", inputs)

    def work() -> Written:
        frames = [read(i) for i in sources]
        more = {"hot_ids": _hot_ids(spark, lake, frames[1], inputs), "by_month": True} if table == "fact_transactions" else {}
        df = builder(*frames, load_date, **more)
        return publish_table(spark, df, lake.table_root("silver", table),
                             version=_version(load_date, run_id), partition_by=parts, fmt=lake.fmt, rebalance=False)

    return _logged(spark, lake, run_id, "silver", table, work, log)


def build_gold_table(
    spark: SparkSession, lake: Lake, table: str, load_date: str, run_id: str | None = None,
    log: bool = True, inputs: Mapping[str, Written] | None = None,
) -> Written:
    """Silver tables -> a new version of one gold mart (``inputs`` pins silver versions)."""
    _check("gold", table)
    run_id = run_id or new_run_id()
    builder, sources = GOLD_TABLES[table]
    read = _reader(spark, lake, "silver", inputs)

    def work() -> Written:
        df = builder(*[read(i) for i in sources], load_date)
        return publish_table(spark, df, lake.table_root("gold", table),
                             version=_version(load_date, run_id), fmt=lake.fmt)

    return _logged(spark, lake, run_id, "gold", table, work, log)


def _version(date: str, run_id: str) -> str:
    """A fresh version folder name: date, run, and a unique suffix (a retry never reuses one)."""
    return new_version(f"{date}-{run_id.replace('-', '')[:12]}")


def run_layer(
    spark: SparkSession, lake: Lake, layer: str, run_date: str, landing_root: str | None = None,
    tables: Sequence[str] | None = None, run_id: str | None = None, log: bool = True,
    file_glob: str = "*.json", inputs: Mapping[str, Written] | None = None, config_root: str | None = None,
) -> dict[str, Written]:
    """Build every active table of a layer (from its config), or those of ``tables``.

    A bronze entity's config row names its landing folder and source format;
    a format that the entity is not delivered in is rejected. ``config_root``
    is a folder with config files other than the packaged ones.

    ``inputs``: versions of the previous layer to build from (default: live copies).
    """
    if layer not in LAYERS:
        raise ValueError(f"Unsupported layer: {layer}")
    run_id = run_id or new_run_id()
    rows = active_rows(spark, layer, config_root)
    listed = {r[0]: r for r in rows}
    names = list(tables) if tables is not None else list(listed)
    out: dict[str, Written] = {}
    for name in names:
        if layer == "bronze":
            if landing_root is None:
                raise ValueError("bronze needs landing_root")
            row = listed.get(name)
            out[name] = ingest_entity(spark, lake, landing_root, name, run_date,
                                      source_format=row["source_format"] if row else None, run_id=run_id, log=log,
                                      file_glob=file_glob, folder=row["landing_folder"] if row else None)
        elif layer == "silver":
            out[name] = build_silver_table(spark, lake, name, run_date, run_id, log, inputs)
        else:
            out[name] = build_gold_table(spark, lake, name, run_date, run_id, log, inputs)
    return out


class RunFailed(RuntimeError):
    """Some tables were not built. ``written`` has those that were, ``errors`` the failures and ``skipped`` what needed them."""

    def __init__(self, written: dict[str, dict[str, Written]], errors: dict[str, Exception], skipped: list[str]):
        more = f"; not built for want of them: {', '.join(skipped)}" if skipped else ""
        super().__init__("; ".join(f"{name}: {e}" for name, e in errors.items()) + more)
        self.written, self.errors, self.skipped = written, errors, skipped


def run_all(
    spark: SparkSession, lake: Lake, landing_root: str, run_date: str, run_id: str | None = None,
    log: bool = True, file_glob: str = "*.json", config_root: str | None = None, workers: int = 4,
) -> dict[str, dict[str, Written]]:
    """Bronze, silver and gold for one date, in the order of the tables' dependencies.

    Each table is built from exactly the versions that this run has written, so
    the run reads one consistent snapshot even if other jobs publish meanwhile;
    inputs that are not active are read at their live copy. After a failure the
    tables that need the failed one are left out, all others are still built,
    and ``RunFailed`` tells what happened.
    """
    run_id = run_id or new_run_id()
    active = {layer: [row[0] for row in active_rows(spark, layer, config_root)] for layer in LAYERS}
    needs = {"bronze": {}, "silver": SILVER_TABLES, "gold": GOLD_TABLES}
    waiting: dict[tuple[str, str], set[tuple[str, str]]] = {}
    for at, layer in enumerate(LAYERS):
        for name in active[layer]:
            sources = needs[layer][name][1] if name in needs[layer] else ()
            waiting[layer, name] = {(LAYERS[at - 1], x) for x in sources if x in active[LAYERS[at - 1]]}
    out: dict[str, dict[str, Written]] = {layer: {} for layer in LAYERS}
    errors: dict[str, Exception] = {}
    skipped: list[str] = []

    def build(layer: str, name: str) -> Written:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"{layer}.{name}")
        before = dict(out[LAYERS[LAYERS.index(layer) - 1]]) if layer != "bronze" else None
        return run_layer(spark, lake, layer, run_date, landing_root, [name], run_id, log, file_glob, before, config_root)[name]

    running: dict[Future, tuple[str, str]] = {}
    with ThreadPoolExecutor(workers) as pool:
        while waiting or running:
            for node in [n for n, left in waiting.items() if not left]:
                del waiting[node]
                running[pool.submit(inheritable_thread_target(spark)(build), *node)] = node
            done, _ = wait(running, return_when=FIRST_COMPLETED)
            for future in done:
                node = running.pop(future)
                if future.exception() is None:
                    out[node[0]][node[1]] = future.result()
                    for left in waiting.values():
                        left.discard(node)
                    continue
                errors[".".join(node)] = future.exception()
                lost = {node}
                while gone := [n for n, left in waiting.items() if left & lost]:
                    lost |= set(gone)
                    skipped += [".".join(n) for n in gone]
                    for n in gone:
                        del waiting[n]
    written = {layer: {name: out[layer][name] for name in active[layer] if name in out[layer]} for layer in LAYERS}
    if errors:
        raise RunFailed(written, errors, skipped) from next(iter(errors.values()))
    return written


def register_layers(spark: SparkSession, lake: Lake, written: dict[str, dict[str, Written]]) -> list[str]:
    """Register every written table as ``<layer>.<table>`` in the catalog, a persistent view
    ``gold.vw_<table>`` over each gold mart, and the run log once it has rows."""
    names = []
    for layer, tables in written.items():
        create_schema(spark, layer, f"{lake.root.rstrip('/')}/_catalog/{layer}.db")
        for table, w in tables.items():
            register_table(spark, f"{layer}.{table}", w.path, lake.fmt)
            names.append(f"{layer}.{table}")
    names += create_catalog_views(spark, {t: f"gold.{t}" for t in written.get("gold", {})})
    try:
        names.append(register_log(spark, lake.log_path))
    except AnalysisException:  # no step was logged
        pass
    return names
