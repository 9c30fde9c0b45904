"""Price lookups (the scripts' temporary SQL functions).

Each lookup is an uncorrelated scalar subquery, as in the scripts: Spark runs
it once, inlines the value, and raises ``SCALAR_SUBQUERY_TOO_MANY_ROWS`` when
the price list holds two rows for the same class, region and date.  No join
fans out and nothing data-sized is broadcast.

By default the newest ``application_start_date`` is taken over the whole
price table, so a revision that covers only some classes or another region
makes the other prices NULL (as the scripts do).  ``latest_per_key=True``
takes the newest revision per class and region instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costbook.constants import EDITION_CLASSES, ON_DEMAND_CLASS, STORAGE_PRICE_COLUMNS  # noqa: F401


def _revision_filter(prices: DataFrame, key: Column, latest_per_key: bool) -> Column:
    date = F.col("application_start_date")
    if latest_per_key:
        newest = prices.filter(key).agg(F.max("application_start_date")).scalar()
    else:
        newest = prices.agg(F.max("application_start_date")).scalar()
    return (date == newest) & key


def compute_price(prices: DataFrame, region: str, price_class: str, latest_per_key: bool = False) -> Column:
    """The pay-as-you-go price of one class in one region, as a scalar column."""
    key = (F.col("region") == F.lit(region)) & (F.col("class") == F.lit(price_class))
    rows = prices.filter(_revision_filter(prices, key, latest_per_key))
    return rows.select("pay_as_you_go_pricing").scalar()


def edition_price(prices: DataFrame, edition: Column, region: str, latest_per_key: bool = False) -> Column:
    """``CASE edition WHEN 'STANDARD' THEN price('standard') ... END``, with one lookup.

    The lookup is a map from class to price; two prices of one class raise.
    """
    key = (F.col("region") == F.lit(region)) & F.col("class").isin(list(EDITION_CLASSES.values()))
    if latest_per_key:
        newest = prices.filter(key).groupBy("class").agg(F.max("application_start_date").alias("application_start_date"))
        rows = prices.filter(key).join(newest, ["class", "application_start_date"])
    else:
        rows = prices.filter(_revision_filter(prices, key, False))
    entries = F.collect_list(F.struct("class", "pay_as_you_go_pricing"))
    once = F.when(F.count("class") > F.count_distinct("class"), F.raise_error(F.lit("more than one price of a class")))
    lookup = rows.agg(F.coalesce(once.cast("map<string,double>"), F.map_from_entries(entries)).alias("p")).scalar()
    expr = None
    for name, cls in EDITION_CLASSES.items():
        p = lookup[cls]
        expr = F.when(edition == F.lit(name), p) if expr is None else expr.when(edition == F.lit(name), p)
    return expr


def storage_prices(prices: DataFrame, region: str, latest_per_key: bool = False) -> dict[str, Column]:
    """The four storage prices of the newest revision in ``region``, with one lookup.

    ``latest_per_key=True`` takes the newest revision that names each price.
    """
    key = F.col("region") == F.lit(region)
    if latest_per_key:
        out = {}
        for k, column in STORAGE_PRICE_COLUMNS.items():
            rows = prices.filter(_revision_filter(prices, key & F.col(column).isNotNull(), True))
            out[k] = rows.select(column).scalar()
        return out
    row = prices.filter(_revision_filter(prices, key, False)).select(F.struct(*STORAGE_PRICE_COLUMNS.values())).scalar()
    return {k: row[column] for k, column in STORAGE_PRICE_COLUMNS.items()}


# --- maintaining the price lists ------------------------------------------------------
def _write_prices(rows: DataFrame, schema, path: str) -> None:
    missing = [f.name for f in schema.fields if f.name not in rows.columns]
    if missing:
        raise ValueError(f"price rows lack columns {missing}")
    rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]).write.mode("append").parquet(path)


def append_compute_prices(rows: DataFrame, path: str) -> None:
    """Add a revision to the compute price list at ``path`` (created if absent).

    Rows keep older revisions; lookups use the newest ``application_start_date``.
    """
    from costbook.schemas import PRICE_COMPUTE

    _write_prices(rows, PRICE_COMPUTE, path)


def append_storage_prices(rows: DataFrame, path: str) -> None:
    """Add a revision to the storage price list at ``path`` (created if absent)."""
    from costbook.schemas import PRICE_STORAGE

    _write_prices(rows, PRICE_STORAGE, path)
