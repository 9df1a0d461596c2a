from halyard.sources.models import load_model, save_model
from halyard.sources.ranges import read_account_range, with_range_bucket, write_by_range
from halyard.sources.tables import (
    SchemaError,
    conform,
    ensure_database,
    ensure_table,
    load_table,
    materialise,
    read_csv,
    read_report_csv,
    read_report_json,
    register_views,
    scan_view,
    write_csv,
    write_metrics_json,
)
from halyard.sources.workspace import ensure_checkpoint_dir, workspace_path

__all__ = [
    "SchemaError",
    "conform",
    "ensure_checkpoint_dir",
    "ensure_database",
    "ensure_table",
    "load_model",
    "load_table",
    "materialise",
    "read_account_range",
    "read_csv",
    "read_report_csv",
    "read_report_json",
    "register_views",
    "save_model",
    "scan_view",
    "with_range_bucket",
    "workspace_path",
    "write_by_range",
    "write_csv",
    "write_metrics_json",
]
