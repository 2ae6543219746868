"""Full refresh of stored marts, in the order in which they read one another."""

from __future__ import annotations

from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.fiscal import day_of
from ..sources.catalog import Catalog, table_spec
from ..sources.tables import TableCatalog
from .marts import MARTS
from .views import VIEWS, view_sql

#: Marts that are worked out at once.
AT_ONCE = 4


class _Recorder(Catalog):
    """Empty tables; notes which ones are read."""

    def __init__(self, spark: SparkSession):
        super().__init__(spark)
        self.entities: set[str] = set()
        self.marts: set[str] = set()

    def versions(self, name: str) -> DataFrame:
        self.entities.add(name)
        return self.spark.createDataFrame([], table_spec(name).schema)

    def mart(self, name: str) -> DataFrame:
        self.marts.add(name)
        return self.spark.createDataFrame([], schemas.mart_schema(name))


def reads(spark: SparkSession, mart: str) -> tuple[set[str], set[str]]:
    """The entities and the marts that a mart reads, found by building its plan over empty tables."""
    recorder = _Recorder(spark)
    MARTS[mart](recorder)
    return recorder.entities, recorder.marts


def refresh_mart(catalog: TableCatalog, name: str) -> None:
    """Replaces a mart as a whole, stamped with the day."""
    catalog.replace_mart(name, MARTS[name](catalog).select(day_of(F.current_timestamp(), catalog.zone).alias("data_refresh_date"), "*"))


def refresh_all(catalog: TableCatalog, names: list[str] | None = None, at_once: int = AT_ONCE) -> list[str]:
    """Refreshes marts, each after those that it reads and `at_once` at a time; gives them in the order of the library.

    Entities are stored in their newest state, clustered by what joins use, so no mart works it out
    again: a refresh has no shuffle for it. If a mart fails, those that read it are not refreshed, the
    others under way end, and the error is raised.
    """
    wanted = [n for n in MARTS if names is None or n in names]
    if names is not None and (unknown := set(names) - set(wanted)):
        raise KeyError(f"no such marts: {sorted(unknown)}")
    waiting = {n: reads(catalog.spark, n)[1] & set(wanted) for n in wanted}
    done: set[str] = set()
    running: dict = {}
    with ThreadPoolExecutor(at_once) as pool:
        while waiting or running:
            for name in [n for n, before in waiting.items() if before <= done]:
                running[pool.submit(refresh_mart, catalog, name)] = name
                del waiting[name]
            for finished in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(finished)
                finished.result()
                done.add(name)
    return wanted


def create_views(catalog: TableCatalog, min_fy_start: int | None = None) -> dict[str, DataFrame]:
    """Registers the dashboards' views in the database, named v_..., over the marts by name."""
    frames = {}
    for name in VIEWS:
        catalog.spark.sql(f"CREATE OR REPLACE VIEW {catalog.name(f'v_{name}')} AS {view_sql(name, lambda mart: catalog.name(f'mart_{mart}'), min_fy_start)}")
        frames[name] = catalog.spark.table(catalog.name(f"v_{name}"))
    return frames
