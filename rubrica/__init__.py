"""Net-of-children analytics over public-budget execution extracts, on Spark DataFrames."""

from .plans.enrich import enrich
from .plans.legacy import legacy_long
from .plans.net import net_extract, process_extracts
from .plans.publish import publish
from .schema import METRICS, PRODUCTION, Rules
from .sources.dimensions import Dimensions, load_dimensions, unit_codes
from .sources.extracts import read_extracts, type_extract
from .sources.sinks import write_csv, write_parquet

__all__ = [
    "METRICS", "PRODUCTION", "Dimensions", "Rules", "enrich", "legacy_long", "load_dimensions",
    "net_extract", "process_extracts", "publish", "read_extracts", "type_extract", "unit_codes",
    "write_csv", "write_parquet",
]
