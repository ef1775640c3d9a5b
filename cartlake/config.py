"""Names, limits and storage settings; everything a job needs to know up front."""

from __future__ import annotations

from dataclasses import dataclass, field

BRONZE, SILVER, GOLD, MONITORING = "bronze", "silver", "gold", "monitoring"
LAYERS = (BRONZE, SILVER, GOLD)

SILVER_MODELS = (
    "stg_customers",
    "stg_order_items",
    "stg_order_payments",
    "stg_order_reviews",
    "stg_order_status_history",
)
GOLD_MODELS = (
    "dim_categories",
    "dim_customers",
    "dim_geography",
    "dim_order_attributes",
    "dim_products",
    "dim_reviews",
    "dim_sellers",
    "fct_orders",
)

# The bronze copy model is stored under another name.
STORED_AS = {"raw_events_copy": "raw_events_view"}


def layer_of(model: str) -> str:
    """Layer a model belongs to, from its name."""
    if model.startswith("stg_"):
        return SILVER
    if model.startswith(("dim_", "fct_")):
        return GOLD
    if model.startswith("raw_"):
        return BRONZE
    return MONITORING


@dataclass(frozen=True)
class MonitorLimits:
    """Fixed values of the monitor: minutes, per cent and days."""

    fresh_min: int = 60
    critical_min: int = 120
    anomaly_pct: float = 30.0
    history_days: int = 7
    snapshot_minutes: int = 15


@dataclass(frozen=True)
class Storage:
    """Where tables live: a catalog (databases per layer) or a folder tree."""

    root: str | None = None
    catalog: str | None = None
    fmt: str = "parquet"
    write_options: dict = field(default_factory=dict)

    def table_name(self, layer: str, model: str) -> str:
        name = STORED_AS.get(model, model)
        parts = [self.catalog, layer, name] if self.catalog else [layer, name]
        return ".".join(parts)

    def path(self, layer: str, model: str) -> str:
        if self.root is None:
            raise ValueError("this storage keeps catalog tables, not paths")
        return f"{self.root.rstrip('/')}/{layer}/{STORED_AS.get(model, model)}"
