from dimspark.operators.cutoff import cutoff_window, load_by_cutoff, stored_cutoff, update_cutoff, with_lineage
from dimspark.operators.incremental import (
    incremental_filter,
    incremental_scd2,
    load_scd2,
    merge_table,
    merge_upsert,
    watermark,
)
from dimspark.operators.lookup import Lookup, lookup_key, lookup_keys
from dimspark.operators.quality import Rules, checked_write, null_violations, orphan_keys
from dimspark.operators.stored import (
    overwrite_attributes,
    read_dimension,
    rebuild_dimension,
    splice_dimension,
    stable_dimension,
)
from dimspark.operators.temporal import point_in_time_join, scd1_latest
from dimspark.operators.versions import dense_key, scd2_close, version_dimension

__all__ = [
    "Lookup",
    "Rules",
    "checked_write",
    "cutoff_window",
    "dense_key",
    "incremental_filter",
    "incremental_scd2",
    "load_by_cutoff",
    "load_scd2",
    "lookup_key",
    "lookup_keys",
    "merge_table",
    "merge_upsert",
    "null_violations",
    "orphan_keys",
    "overwrite_attributes",
    "point_in_time_join",
    "read_dimension",
    "rebuild_dimension",
    "scd1_latest",
    "scd2_close",
    "splice_dimension",
    "stable_dimension",
    "stored_cutoff",
    "update_cutoff",
    "version_dimension",
    "watermark",
    "with_lineage",
]
