"""The layer registry: a small dimension table and named plan builders.

A custom layer is one more ``Layer`` with a builder; toggles and day overrides are
settings, not code.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Layer:
    """``kind`` is static, temporal or composite. ``builder`` makes the layer's DataFrame from a context."""

    key: str
    stem: str
    kind: str
    bands: int
    resolution_m: float
    n_days: int = 0
    buffered: bool = False
    core: bool = True
    builder: Callable[..., DataFrame] | str | None = None

    @property
    def band_count(self) -> int:
        return self.n_days if self.kind == "temporal" else self.bands


# The core layers.
CORE = (
    Layer("S1", "S1_VV_VH", "composite", 2, 10.0),
    Layer("S2_indices", "S2_NDVI_NDBI", "composite", 2, 10.0),
    Layer("MERIT", "MERIT_Hydro", "static", 4, 90.0),
    Layer("Soil", "Soil", "static", 2, 250.0),
    Layer("ESA_PW", "ESA_PW", "static", 1, 10.0),
    Layer("Precipitation", "Precipitation", "temporal", 1, 11000.0, 30, True),
    Layer("SoilMoisture", "SoilMoisture", "temporal", 1, 9500.0, 30, True),
)


class Registry:
    """Core layers, then custom ones in order of registration."""

    def __init__(self, toggles: dict[str, bool] | None = None, days: dict[str, int] | None = None) -> None:
        self.toggles, self.days, self.custom = dict(toggles or {}), dict(days or {}), []
        self.builders: dict[str, Callable[..., DataFrame]] = {}

    def register(self, layer: Layer) -> Layer:
        if any(x.key == layer.key for x in self.all()):
            raise ValueError(f"layer {layer.key} is registered already")
        self.custom.append(replace(layer, core=False))
        return self.custom[-1]

    def builder(self, name: str) -> Callable:
        """Decorator: a composite builder that layers name."""

        def keep(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
            self.builders[name] = f
            return f

        return keep

    def resolve(self, layer: Layer) -> Callable[..., DataFrame]:
        b = self.builders[layer.builder] if isinstance(layer.builder, str) else layer.builder
        if b is None:
            raise LookupError(f"layer {layer.key} has no builder")
        return b

    def all(self) -> list[Layer]:
        return [replace(x, n_days=self.days.get(x.key, x.n_days)) if x.kind == "temporal" else x for x in (*CORE, *self.custom)]

    def enabled(self) -> list[Layer]:
        return [x for x in self.all() if self.toggles.get(x.key, True)]

    def by_key(self, key: str) -> Layer | None:
        return next((x for x in self.all() if x.key == key), None)

    def frame(self, spark: SparkSession) -> DataFrame:
        """The enabled layers as a dimension table; ``ord`` is the reporting order."""
        rows = [(k, x.key, x.stem, x.kind, x.band_count, float(x.resolution_m), x.n_days, x.buffered, x.core) for k, x in enumerate(self.enabled())]
        return spark.createDataFrame(rows, "ord int, key string, stem string, kind string, bands int, resolution_m double, n_days int, buffered boolean, core boolean")

    def build(self, key: str, *args, **kwargs) -> DataFrame:
        layer = self.by_key(key)
        if layer is None:
            raise LookupError(f"no layer {key}")
        extra = (layer.n_days,) if layer.kind == "temporal" else ()
        return self.resolve(layer)(*args, *extra, **kwargs)
