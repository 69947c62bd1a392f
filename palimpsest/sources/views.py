"""Tables under their names, for ad-hoc SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from palimpsest.resources import RESOURCES
from palimpsest.sources.store import HistoryStore, KeyedStore
from palimpsest.spec import ResourceSpec


def open_store(spark: SparkSession, root: str, spec: ResourceSpec) -> HistoryStore | KeyedStore:
    kind = HistoryStore if spec.versioned else KeyedStore
    return kind.of(spark, root, spec)


def register_views(spark: SparkSession, root: str, prefix: str = "", sensitive: bool = False) -> list[str]:
    """A temporary view with all rows of every resource under `root`, without secrets unless asked for."""
    names = []
    for spec in RESOURCES.values():
        store = open_store(spark, root, spec)
        rows = store.history() if spec.versioned else store.rows()
        if not sensitive:
            rows = rows.drop(*[f.name for f in spec.fields if f.sensitive])
        rows.createOrReplaceTempView(prefix + spec.name)
        names.append(prefix + spec.name)
    return names


def register_functions(spark: SparkSession, root: str, prefix: str = "", sensitive: bool = False) -> list[str]:
    """SQL functions over the versioned tables under `root`: `<name>_at(ts)`, `<name>_now()` and `<name>_all()`.

    `select * from device_at(timestamp '2026-01-10') where network_id = 'n1'` gives what `read(DEVICE, store, ts)` gives; the time and the
    filters reach the scan, whose row groups know the times they hold. The functions see the commits that
    there are when this is called. Secrets are left out unless asked for.
    """
    names = []
    for spec in RESOURCES.values():
        if not spec.versioned:
            continue
        store = open_store(spark, root, spec)
        hidden = [] if sensitive else [f.name for f in spec.fields if f.sensitive]
        for kind, rows, given, where in (
            ("at", store.history(), "ts timestamp", "where active_from <= ts and (active_to > ts or active_to is null)"),
            ("now", store.open_rows(), "", ""),
            ("all", store.history(), "", ""),
        ):
            name = f"{prefix}{spec.name}_{kind}"
            rows.drop(*hidden).createOrReplaceTempView(f"_{name}")
            columns = [f for f in rows.schema if f.name not in hidden]
            returned = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
            listed = ", ".join(f"`{f.name}`" for f in columns)
            spark.sql(f"create or replace temporary function {name}({given}) returns table ({returned}) return select {listed} from _{name} {where}")
            names.append(name)
    return names
