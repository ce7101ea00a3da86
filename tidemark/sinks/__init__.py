"""Writers: partitioned Parquet, catalog tables and CSV exports."""

from tidemark.sinks.catalog import write_catalog_table
from tidemark.sinks.compaction import compact_partitions, compaction_plan
from tidemark.sinks.manifest import append_manifest, present_files, read_manifest, written_files
from tidemark.sinks.partitions import WriteReport, check_partition_keys, write_partitions
from tidemark.sinks.results import write_result
from tidemark.sinks.settings import destination_settings, destination_spec, effective_settings
from tidemark.sinks.text import export_csv

__all__ = [
    "WriteReport",
    "append_manifest",
    "check_partition_keys",
    "compact_partitions",
    "compaction_plan",
    "destination_settings",
    "destination_spec",
    "effective_settings",
    "export_csv",
    "present_files",
    "read_manifest",
    "write_catalog_table",
    "write_partitions",
    "write_result",
    "written_files",
]
