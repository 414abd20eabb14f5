from tastecore.sources.inventory import directory_usage, file_inventory, file_line_counts
from tastecore.sources.readers import (
    labelled,
    literal_rows,
    parse_fixed_width,
    read_features,
    read_fixed_width,
    read_header_csv,
    read_parts,
    read_tsv,
)
from tastecore.sources.schemas import (
    FEATURE_SETS,
    GENRE_SCHEMA,
    ID_ALIASES,
    MISMATCH_FIELDS,
    TRIPLET_SCHEMA,
    feature_catalog,
    schema_from_attributes,
)
from tastecore.sources.writers import preview_json, write_delimited, write_gzip_csv, write_parquet

__all__ = [
    "FEATURE_SETS",
    "GENRE_SCHEMA",
    "ID_ALIASES",
    "MISMATCH_FIELDS",
    "TRIPLET_SCHEMA",
    "directory_usage",
    "feature_catalog",
    "file_inventory",
    "file_line_counts",
    "labelled",
    "literal_rows",
    "parse_fixed_width",
    "preview_json",
    "read_features",
    "read_fixed_width",
    "read_header_csv",
    "read_parts",
    "read_tsv",
    "schema_from_attributes",
    "write_delimited",
    "write_gzip_csv",
    "write_parquet",
]
