"""The step from silver to gold: locations, resolved properties, listings, prices."""

from __future__ import annotations

from brickwork.config import EngineConfig
from brickwork.operators import aggregates, resolve
from brickwork.sources import tables


def resolved(store: tables.Store, cfg: EngineConfig) -> int:
    """Resolves silver's advertisements that are no listings yet against the stored properties; returns how many properties there are.

    The tables are the matcher's whole state, so a batch run and a stream's micro-batches go on from each other.
    """
    current = store.read("silver_listings")
    dim = store.write("locations", resolve.locations(current, store.read("locations")))
    properties, listings, history = resolve.resolve(current, dim, store.read("properties"), store.read("listings"), cfg.match)
    properties, listings, history = tables.checkpoint(properties), tables.checkpoint(listings), tables.checkpoint(history)
    price = aggregates.min_active_price(listings)
    priced = properties.drop("current_price_egp").join(price.withColumnRenamed("property_id", "id"), "id", "left")
    store.write("properties", aggregates.price_outliers(priced, q=cfg.outlier_q))
    store.write("listings", listings)
    if not history.isEmpty():
        store.append("price_history", history)
    return properties.count()
