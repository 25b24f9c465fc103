"""Table preparation at scale: lazy functions over Spark DataFrames."""

from tableprep.errors import EmptyInputError, ReadError, SchemaError, SqlError, TablePrepError, WriteError
from tableprep.operators.colnames import (
    reserved_word_columns, reserved_word_names, safe_column_names, strip_common_prefix, stripped_prefix,
)
from tableprep.operators.generate import estimate_pi, generate_bulk, pi_of_points, random_block, random_points
from tableprep.operators.imposed import (
    ImposedRules, KeyOffset, imposed_union, imposed_union_paths, lookup_schema, select_columns_ci,
)
from tableprep.operators.masking import mask_columns, mask_sensitive
from tableprep.operators.overlay import layered_overlay, overlay_tables
from tableprep.operators.profile import (
    char_class_totals, char_histogram, character_counts, hyphen_position, row_count, value_counts,
)
from tableprep.operators.reconcile import (
    drift_report, observe, resolve_types, resolved_union, resolved_union_paths, source_tag,
)
from tableprep.operators.rowid import dense_row_id, reproducible_id, surrogate_id
from tableprep.operators.sizing import compact, compaction_plan, recommend_partitions
from tableprep.operators.views import preview, schema_report, show_string, view_from_parquet
from tableprep.plans.sqljobs import sql_file_job, sql_query
from tableprep.sinks.range_named import rename_parts, write_range_named
from tableprep.sinks.writers import (
    partitioned_sink, save_prefixed_table, write_csv, write_gzip_intermediate, write_orc, write_parquet, write_text,
    write_text_blob,
)
from tableprep.sources.listing import (
    directory_entries, discover_tables, file_catalog, file_catalog_recursive, list_databases,
)
from tableprep.sources.readers import (
    read_csv, read_header_csv, read_lines, read_orc, read_parquet, read_parquet_instances, read_text,
)
from tableprep.streaming.incremental import incremental_load, incremental_stream

__all__ = [
    "EmptyInputError", "ImposedRules", "KeyOffset", "ReadError", "SchemaError", "SqlError", "TablePrepError",
    "WriteError", "char_class_totals", "char_histogram", "character_counts", "compact", "compaction_plan",
    "dense_row_id", "directory_entries", "discover_tables", "drift_report", "estimate_pi", "file_catalog",
    "file_catalog_recursive", "generate_bulk", "hyphen_position", "imposed_union", "imposed_union_paths",
    "incremental_load", "incremental_stream", "layered_overlay", "list_databases", "lookup_schema", "mask_columns", "mask_sensitive",
    "observe", "overlay_tables", "partitioned_sink", "pi_of_points", "preview", "random_block", "random_points",
    "read_csv", "read_header_csv", "read_lines", "read_orc", "read_parquet", "read_parquet_instances", "read_text",
    "recommend_partitions", "rename_parts", "reproducible_id", "reserved_word_columns", "reserved_word_names", "resolve_types",
    "resolved_union", "resolved_union_paths", "row_count", "safe_column_names", "save_prefixed_table",
    "schema_report", "select_columns_ci", "show_string", "source_tag", "sql_file_job", "sql_query",
    "strip_common_prefix", "stripped_prefix", "surrogate_id", "value_counts", "view_from_parquet", "write_csv",
    "write_gzip_intermediate", "write_orc", "write_parquet", "write_range_named", "write_text", "write_text_blob",
]
