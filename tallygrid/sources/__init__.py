"""Where survey tables come from and where results go."""

from tallygrid.sources.base import SurveySource
from tallygrid.sources.operational import (
    OperationalSource,
    catalog_reader,
    jdbc_reader,
    parquet_reader,
)
from tallygrid.sources.retail import RetailSource
from tallygrid.sources.sinks import (
    SchemaDrift,
    export_csv,
    prune_partitions,
    read_table,
    replace_partitions,
    write_table,
)
from tallygrid.sources.text import decode_column, read_tsv

__all__ = [
    "OperationalSource",
    "RetailSource",
    "SchemaDrift",
    "SurveySource",
    "catalog_reader",
    "decode_column",
    "export_csv",
    "jdbc_reader",
    "parquet_reader",
    "prune_partitions",
    "read_table",
    "read_tsv",
    "replace_partitions",
    "write_table",
]
