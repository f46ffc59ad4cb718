"""Sources: raw channel exports, the final table, and the driver-table
bindings used for tests and benchmarks."""

from adtrail.sources.analytics import load_analytics, parse_quality
from adtrail.sources.bindings import ingested_sources, raw_sources
from adtrail.sources.files import (blank_frame, essential_sources_present, ingest_all,
                                   read_csv_source, read_json_source, read_source)
from adtrail.sources.scan import SourceScan, scan_source

__all__ = [
    "load_analytics", "parse_quality", "ingested_sources", "raw_sources", "blank_frame",
    "essential_sources_present", "ingest_all", "read_csv_source", "read_json_source",
    "read_source", "SourceScan", "scan_source",
]
