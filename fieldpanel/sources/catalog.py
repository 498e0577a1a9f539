"""Named datasets: name -> path, format and declared schema."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T

from fieldpanel.sources.readers import read_table

# The raw tables and the columns the preprocessing plan reads.
RAW_SCHEMAS: dict[str, str] = {
    "rainfall": "Area string, Year int, average_rain_fall_mm_per_year string",
    "pesticides": "Area string, Year int, Value double",
    "yield": "Area string, Year int, Item string, Value double, Unit string",
    "temp": "country string, year int, avg_temp double",
}


@dataclass(frozen=True)
class Dataset:
    path: str
    format: str = "csv"
    schema: T.StructType | str | None = None
    options: Mapping[str, object] = field(default_factory=dict)


class DatasetCatalog:
    """A set of datasets that can be loaded by name."""

    def __init__(self, datasets: Mapping[str, Dataset]):
        self.datasets = dict(datasets)

    @classmethod
    def under(cls, root: str, folder: str = "raw", declared: bool = False) -> DatasetCatalog:
        """The standard project: five CSV files in ``root``'s raw folder.

        With ``declared``, files that hold exactly the expected columns are read
        without an inference pass; a header that differs is an error. Otherwise
        the types are inferred.
        """
        root = root.rstrip("/")
        names = ("yield_df", "yield", "temp", "rainfall", "pesticides")
        schemas = RAW_SCHEMAS if declared else {}
        return cls(
            {
                n: Dataset(
                    f"{root}/{folder}/{n}.csv",
                    schema=schemas.get(n),
                    options={"enforceSchema": False} if n in schemas else {},
                )
                for n in names
            }
        )

    @staticmethod
    def folders(root: str) -> dict[str, str]:
        """The project's folders by role."""
        root = root.rstrip("/")
        return {role: f"{root}/{role}/" for role in ("raw", "processed", "results", "scripts")}

    def names(self) -> list[str]:
        return list(self.datasets)

    def load(self, spark: SparkSession, name: str) -> DataFrame:
        if name not in self.datasets:
            raise KeyError(f"unknown dataset {name!r}; available: {', '.join(self.names())}")
        entry = self.datasets[name]
        return read_table(spark, entry.path, entry.format, entry.schema, **entry.options)

    def load_all(self, spark: SparkSession) -> tuple[dict[str, DataFrame], dict[str, str]]:
        """Every readable dataset, and the reason for each unreadable one."""
        loaded: dict[str, DataFrame] = {}
        failed: dict[str, str] = {}
        for name in self.names():
            try:
                loaded[name] = self.load(spark, name)
            except AnalysisException as error:
                failed[name] = str(error)
        return loaded, failed
