"""One refresh: every landed resource merged into its table, in dependency order."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.operators.convert import normalize
from palimpsest.operators.prefixes import fill_by_prefix
from palimpsest.operators.enrich import fill_by_range, ipv4_number, reuse
from palimpsest.operators.route import route
from palimpsest.plans.usage import refresh_usage, usage_events
from palimpsest.resources import NETWORK, ORGANIZATION, RESOURCES, UPLINK
from palimpsest.sources.landing import read_landing
from palimpsest.sources.store import Commits, HistoryStore, KeyedStore, micros
from palimpsest.spec import ResourceSpec

# How many resources of a refresh are merged at the same time.
CONCURRENT = 4


def refresh_levels(resources: Sequence[str] | None = None) -> list[list[ResourceSpec]]:
    """The chosen resources (all by default) in levels: each after those it depends on."""
    chosen = set(resources or RESOURCES)
    unknown = sorted(chosen - set(RESOURCES))
    if unknown:
        raise ValueError(f"unknown resource(s) {unknown}")
    levels: list[list[ResourceSpec]] = []
    waiting = list(RESOURCES.values())
    placed: set[str] = set()
    while waiting:
        ready = [s for s in waiting if set(s.after) <= placed]
        levels.append([s for s in ready if s.name in chosen])
        placed |= {s.name for s in ready}
        waiting = [s for s in waiting if s not in ready]
    return [level for level in levels if level]


def enrich_uplinks(
    uplinks: DataFrame, known: DataFrame, registry: DataFrame | None = None, prefixes: DataFrame | None = None
) -> DataFrame:
    """Uplinks with their provider: the known one while the public address is unchanged,
    otherwise the registrant of the most specific registered range that holds it.

    `registry` has (start, end, prefix_len, registrant), IPv4 addresses as numbers. `prefixes` has (network, length,
    registrant), addresses of both families as text; it fills what the registry left.
    """
    served = reuse(uplinks, known, UPLINK.keys, "public_ip", "provider").drop("reused")
    filled = served
    if registry is not None:
        ranges = registry.withColumnRenamed("registrant", "provider")
        point = ipv4_number(F.col("public_ip"))
        filled = fill_by_range(filled, ranges, point, "start", "end", "provider", "prefix_len")
    if prefixes is not None:
        held = prefixes.withColumnRenamed("registrant", "provider")
        filled = fill_by_prefix(filled, held, "public_ip", "network", "length", "provider")
    return filled.select(*uplinks.columns)


def refresh(
    spark: SparkSession,
    landing: str,
    tables: str,
    ts: datetime | str,
    resources: Sequence[str] | None = None,
    registry: DataFrame | None = None,
    small_bytes: int | None = None,
    buckets: int | None = None,
) -> dict[str, dict[str, int]]:
    """Merges the snapshots under `landing` into the tables under `tables` as of `ts`.

    Per-network feeds keep only networks with the product type they need. A resource without
    a landing folder is left as it is; tables are kept in `buckets` parts. Nothing happens without organizations. Returns the outcome
    counts per resource. Run again with the same `ts`, say after one resource failed, it does what is missing, and
    returns the stored counts of the rest.
    """
    files = Commits(spark, landing)

    def landed(spec: ResourceSpec) -> DataFrame | None:
        path = f"{landing}/{spec.name}"
        return read_landing(spark, path, spec) if files.exists(path) else None

    organizations = landed(ORGANIZATION)
    if organizations is None or organizations.isEmpty():
        return {}
    raw_networks = landed(NETWORK)
    networks = None if raw_networks is None else normalize(raw_networks, NETWORK)
    options = {} if small_bytes is None else {"small_bytes": small_bytes}
    source = ("refresh", micros(ts))

    def merge(spec: ResourceSpec) -> dict[str, int] | None:
        raw = landed(spec)
        if raw is None or (networks is None and (spec.product_type or not spec.versioned)):
            return None
        if not spec.versioned:
            return refresh_usage(KeyedStore.of(spark, tables, spec), usage_events(raw), networks, ts, source)
        batch = normalize(raw, spec)
        if spec.product_type:
            batch = route(batch, networks, spec.product_type)
        store = HistoryStore.of(spark, tables, spec, buckets)
        if spec is UPLINK:
            batch = enrich_uplinks(batch, store.open_rows(), registry)
        return store.merge(batch, ts, source, **options)

    counts: dict[str, dict[str, int]] = {}
    # Resources of one level write different tables: their jobs share the cluster.
    with ThreadPoolExecutor(max_workers=CONCURRENT) as pool:
        for level in refresh_levels(resources):
            for spec, outcome in zip(level, pool.map(merge, level)):
                if outcome is not None:
                    counts[spec.name] = outcome
    return counts
