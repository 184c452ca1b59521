"""siltlake: land loosely typed operational tables in a data lake with Spark.

Every public function takes and returns DataFrames (or Columns) and is lazy;
nothing moves data rows through the driver.
"""

from siltlake.spec import (  # noqa: F401
    Check, ColumnSpec, ForeignKey, KeyPart, PartitionSpec, TableSpec, spark_type, spec_from_columns, struct_type,
)
from siltlake.sources.catalog import enum_members, select_tables, table_columns  # noqa: F401
from siltlake.sources.snapshot import read_changes, read_snapshot  # noqa: F401
from siltlake.sources.sinks import (  # noqa: F401
    csv_lines, export_csv, publish_schema, publish_staged, published_tables, read_published, swap_tables, sweep_schema,
    union_members, write_jdbc,
)
from siltlake.operators.normalize import (  # noqa: F401
    add_columns, add_generated, apply_zerofill, assign_auto_increment, assign_ids, fill_defaults, loosen, normalize,
    visible_columns, with_collation,
)
from siltlake.operators.quality import (  # noqa: F401
    check_violations, domain_violations, domain_violations_join, fk_violations, length_violations,
    not_null_violations, primary_key_violations, quality_report, range_violations, rule_holds, split_clean,
    unique_violations,
)
from siltlake.operators.relational import (  # noqa: F401
    apply_parent_changes, cascade_self_delete, compare_all, compare_any, compare_some,
)
from siltlake.operators.layout import (  # noqa: F401
    apply_partitioning, clustered, partition_hash, partition_key, partition_list, partition_range, subpartition,
    write_clustered, write_partitioned,
)
from siltlake.operators.changes import (  # noqa: F401
    applied_set, apply_changes, change_log_audit, compact_tombstones, dedup_changes, evolve, flatten_changes, gaps,
    interval_text, latest_state, missing_set, route_tables, row_diff,
)
from siltlake.operators.profile import profile, type_census  # noqa: F401
from siltlake.operators.synth import synth_changes, synth_table  # noqa: F401
from siltlake.operators.synth_typed import synth_typed  # noqa: F401
from siltlake.streaming.apply import VersionedTable, apply_stream, vacuum_plan  # noqa: F401

__version__ = "0.1.0"
