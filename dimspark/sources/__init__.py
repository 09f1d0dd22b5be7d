from dimspark.sources.layout import by_cost, month_key, write_analyzed, write_bucketed, write_monthly
from dimspark.sources.loads import append_load, load_names, read_loads
from dimspark.sources.parts import read_parts, replace_parts, whole, write_parts
from dimspark.sources.schemas import SOURCE_SCHEMAS, source_schema
from dimspark.sources.shared import collected, freed_shuffles, remove_stored, scratch, shared_folder, store
from dimspark.sources.tables import (
    as_view,
    layer_path,
    read_seed,
    read_source,
    read_table,
    register_views,
    write_table,
)

__all__ = [
    "SOURCE_SCHEMAS",
    "append_load",
    "as_view",
    "by_cost",
    "collected",
    "freed_shuffles",
    "layer_path",
    "load_names",
    "month_key",
    "read_loads",
    "read_parts",
    "read_seed",
    "read_source",
    "read_table",
    "register_views",
    "remove_stored",
    "replace_parts",
    "scratch",
    "shared_folder",
    "source_schema",
    "store",
    "whole",
    "write_analyzed",
    "write_bucketed",
    "write_monthly",
    "write_parts",
    "write_table",
]
