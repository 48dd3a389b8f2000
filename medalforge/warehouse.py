"""Materialised layers for a set of source tables, built once per session.

The first query against a source folder writes the raw copies of its six tables
to bronze, cleanses them into silver, builds gold from the stored silver
(dimensions, then the fact) and publishes it, all under the session's shared
folder; later queries read those tables. Writing them, rather than
keeping the views' lineage, means a lost executor costs a re-read of Parquet,
not a re-run of the windows and joins.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from .operators.cleansing import SILVER_SPECS, cleanse
from .operators.gold import build_gold
from .operators.partials import SalesPartials
from .operators.storage import read_by_month, write_by_month
from .session import scratch_path, session_id
from .sources.catalog import Layers
from .sources.fixtures import SILVER_SOURCES, bronze_table, load_tables, silver_tables

_BUILT: dict[tuple, dict[str, DataFrame]] = {}
_LAYERS: dict[tuple, Layers] = {}
_SOURCES: dict[tuple, dict[str, DataFrame]] = {}
_SILVER: dict[tuple, dict[str, DataFrame]] = {}
_PARTIALS: dict[tuple, SalesPartials] = {}
_MONTHLY: dict[tuple, DataFrame] = {}
INCREMENTS = ("1997-01-01", "1999-01-01")  # order dates at which new builds of the partials begin


def _key(spark: SparkSession, sf_dir: str, key_mode: str) -> tuple:
    return (session_id(spark), os.path.abspath(sf_dir), key_mode)


def layers_for(spark: SparkSession, sf_dir: str, key_mode: str = "distributed") -> Layers:
    key = _key(spark, sf_dir, key_mode)
    if key not in _LAYERS:
        _LAYERS[key] = Layers(spark, scratch_path(spark, "warehouse"))
    return _LAYERS[key]


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Handle on one source table; reused so the file listing and footer read happen once."""
    key = _key(spark, sf_dir, "")
    tables = _SOURCES.setdefault(key, {})
    if name not in tables:
        tables[name] = load_tables(spark, sf_dir, (name,))[name]
    return tables[name]


def silver_for(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six stored silver tables, cleansed from stored bronze once per session."""
    key = _key(spark, sf_dir, "")
    if key not in _SILVER:
        layers = layers_for(spark, sf_dir)
        frames = silver_tables({n: source(spark, sf_dir, n) for n in SILVER_SOURCES})
        _each_table(lambda name: layers.write(bronze_table(name, frames[name], SILVER_SPECS[name].critical[0]), "bronze", name))
        _SILVER[key] = silver_step(layers)
    return _SILVER[key]


def _each_table(write: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
    """``write`` every table of ``SILVER_SPECS`` as concurrent Spark jobs: the few tasks of the small tables run beside the sales'."""
    with ThreadPoolExecutor(max_workers=len(SILVER_SPECS)) as pool:
        return dict(zip(SILVER_SPECS, pool.map(write, SILVER_SPECS)))


def silver_step(layers: Layers) -> dict[str, DataFrame]:
    """Cleanse every bronze table of ``SILVER_SPECS`` into silver; return them read back."""
    return _each_table(lambda name: layers.write(cleanse(layers.read("bronze", name), SILVER_SPECS[name]), "silver", name))


def gold_for(spark: SparkSession, sf_dir: str, key_mode: str = "distributed") -> dict[str, DataFrame]:
    key = _key(spark, sf_dir, key_mode)
    if key not in _BUILT:
        _BUILT[key] = build_gold(silver_for(spark, sf_dir), layers_for(spark, sf_dir, key_mode),
                                 key_mode)
    return _BUILT[key]


def partials_for(spark: SparkSession, sf_dir: str) -> SalesPartials:
    """Partial aggregates of the whole dated fact, as three builds leave them: two of them merged, then one more."""
    key = _key(spark, sf_dir, "")
    if key not in _PARTIALS:
        fact = gold_for(spark, sf_dir)["fact_sales"]
        store = SalesPartials(spark, scratch_path(spark, "partials"))
        first, second = (f"DATE '{d}'" for d in INCREMENTS)
        store.add(fact.where(f"order_date < {first}"), "build 1")
        store.add(fact.where(f"order_date >= {first} AND order_date < {second}"), "build 2")
        store.compact()
        store.add(fact.where(f"order_date >= {second}"), "build 3")
        _PARTIALS[key] = store
    return _PARTIALS[key]


def monthly_fact_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact in the layout of ``operators.storage``, with its ``order_month``."""
    key = _key(spark, sf_dir, "")
    if key not in _MONTHLY:
        fact, path = gold_for(spark, sf_dir)["fact_sales"], scratch_path(spark, "fact_by_month")
        write_by_month(fact, path)
        _MONTHLY[key] = read_by_month(spark, path, fact.schema)
    return _MONTHLY[key]


def forget(spark: SparkSession | None = None) -> None:
    """Drop cached handles (tests); the written files stay in the shared folder."""
    for cache in (_BUILT, _LAYERS, _SOURCES, _SILVER, _PARTIALS, _MONTHLY):
        for k in list(cache):
            if spark is None or k[0] == session_id(spark):
                del cache[k]
