"""Panel analytics on Spark: place x year x product tables, from raw files to scored models."""

from fieldpanel.session import get_spark
from fieldpanel.sources.catalog import DatasetCatalog

__all__ = ["DatasetCatalog", "get_spark"]
