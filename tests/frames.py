"""Tiny hand-made models for boundary tests (test-only input)."""

import datetime as dt

from skuflow.sources.model import Model
from skuflow.sources.schemas import MODEL_SCHEMAS

D = dt.date


def make_model(spark, **rows):
    """Model from row lists; tables not given are empty."""
    frames = {}
    for name, schema in MODEL_SCHEMAS.items():
        frames[name] = spark.createDataFrame(rows.get(name, []), schema)
    return Model(**frames)


WAREHOUSES = [(1, "North", "N", 1000), (2, "South", "S", 1000)]


def supplier(sid, lead=10):
    return (sid, f"S{sid}", "N", "cat", 0.9, lead)


def product(pid, cat="cat", cost=100, price=200, sid=1, rp=10, ss=5):
    return (pid, f"SKU-{pid}", cat, cost, price, sid, rp, ss, None)
