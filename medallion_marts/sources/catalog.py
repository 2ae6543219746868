"""Where tables come from. Given frames here; stored tables are in `tables`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..operators.latest import latest_state


def table_spec(name: str) -> schemas.Table:
    if name in schemas.ENTITIES:
        return schemas.ENTITIES[name]
    if name == "property_audit_last":
        return schemas.LAST_AUDIT
    if name in schemas.DIMENSIONS:
        return schemas.DIMENSION
    if name in schemas.MARTS:
        return schemas.Table(schemas.MARTS[name], version=None)
    raise KeyError(name)


class Catalog:
    """Tables by name. `versions` has all stored rows, `latest` one for each key.

    Days, months and fiscal years are those of `zone`; without one, of the session.
    """

    def __init__(self, spark: SparkSession, zone: str | None = None):
        self.spark = spark
        self.zone = zone

    def versions(self, name: str) -> DataFrame:
        raise NotImplementedError

    def mart(self, name: str) -> DataFrame:
        """A mart as stored, or worked out from the tables."""
        from ..plans.marts import MARTS

        return MARTS[name](self)

    def change_metrics(self) -> DataFrame | None:
        """What changed between audit snapshots, if it is stored for all of them."""
        return None

    def latest(self, name: str) -> DataFrame:
        spec, df = table_spec(name), self.versions(name)
        ties = [c for c in df.columns if c == "_ingested_at" or c.startswith("_tie")]
        return latest_state(df, spec.keys, spec.version, ties)


class FrameCatalog(Catalog):
    """Given frames, or functions that make them."""

    def __init__(self, spark: SparkSession, frames: dict[str, DataFrame | Callable[[], DataFrame]], zone: str | None = None):
        super().__init__(spark, zone)
        self.frames = frames

    def versions(self, name: str) -> DataFrame:
        frame = self.frames[name]
        return frame() if callable(frame) else frame
