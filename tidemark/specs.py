"""What a layer job reads, runs and writes. Plain driver-side records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

# Read and write grouping size, Parquet block size, codec.
GROUP_SIZE_BYTES = 134217728
BLOCK_SIZE_BYTES = 134217728
COMPRESSION = "snappy"

SOURCE_KINDS = ("catalogo", "csv", "parquet")
DEST_KINDS = ("catalogo", "csv")


@dataclass(frozen=True)
class SourceSpec:
    """One input relation.

    ``kind`` is ``catalogo`` (catalog table, or a Parquet path when ``path`` is given),
    ``parquet`` (path only) or ``csv``. ``predicate`` may hold ``{NAME}`` placeholders;
    they are bound as literals, never spliced as text.
    """

    view: str
    kind: str = "catalogo"
    database: str | None = None
    table: str | None = None
    path: str | None = None
    schema: object | None = None
    use_catalog_schema: bool = True
    predicate: str | None = None
    duplicate_fields: Sequence[str] | None = None
    duplicate_order: Sequence[str] = ()
    versioned_by: str | None = None
    header: bool = True
    delimiter: str = ","
    quote: str = '"'
    escape: str = "\\"
    infer_schema: bool = False
    encoding: str = "UTF-8"

    @property
    def name(self) -> str:
        """Key used in override texts and override tables."""
        return self.table or self.view


@dataclass(frozen=True)
class DestSpec:
    """One output. ``catalogo`` writes partitioned Parquet, ``csv`` a text export."""

    base_path: str
    table: str
    kind: str = "catalogo"
    database: str | None = None
    partition_keys: Sequence[str] = ()
    compression: str = COMPRESSION
    block_size_bytes: int = BLOCK_SIZE_BYTES
    max_records_per_file: int = 0
    header: bool = True
    file_name: str | None = None
    single: bool = False

    @property
    def path(self) -> str:
        return f"{self.base_path.rstrip('/')}/{self.table}"


@dataclass(frozen=True)
class RowId:
    """A row number for the result: repeatable if ``order`` is given and total, then counted
    inside ``keys``; otherwise only unique."""

    column: str = "chave_processamento_registro"
    keys: Sequence[str] = ()
    order: Sequence[str] = ()


@dataclass(frozen=True)
class LayerSpec:
    """Sources, SQL steps, stamped columns and destination of one job.

    ``read_settings`` (``group_files``, ``group_size_bytes``) hold for this job only.
    """

    domain: str
    sources: Sequence[SourceSpec]
    steps: Sequence[str]
    destination: DestSpec
    post_columns: Mapping[str, str] | None = None
    read_settings: Mapping[str, object] | None = None
    row_id: RowId | None = None
