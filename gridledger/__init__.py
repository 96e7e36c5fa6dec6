"""Track and analyse large evaluation campaigns as Spark DataFrames."""

from gridledger.functions.documents import with_metrics
from gridledger.functions.models import gpu_cost, runtime_minutes, with_requirement
from gridledger.functions.names import expected_name, with_parsed_name
from gridledger.operators.catalog import (
    benchmark_catalog,
    default_mapping,
    model_catalog,
    pair_grid,
    with_dataset_config,
)
from gridledger.operators.scoring import evaluate
from gridledger.plans.planning import load_pending_groups
from gridledger.plans.tracking import (
    export_ledger,
    import_ledger,
    init_tracking,
    parse_results,
    read_report,
    update_tracking,
    update_tracking_incrementally,
)
from gridledger.sources.ledger import read_ledger, read_ledger_csv, stored_status_counts
from gridledger.sources.mapping import read_dataset_mapping, read_model_catalog
from gridledger.sources.results import list_results, listing_of, read_documents

__version__ = "0.1.0"

__all__ = [
    "benchmark_catalog",
    "default_mapping",
    "evaluate",
    "expected_name",
    "export_ledger",
    "gpu_cost",
    "import_ledger",
    "init_tracking",
    "list_results",
    "listing_of",
    "load_pending_groups",
    "model_catalog",
    "pair_grid",
    "parse_results",
    "read_dataset_mapping",
    "read_documents",
    "read_ledger",
    "read_ledger_csv",
    "read_model_catalog",
    "read_report",
    "runtime_minutes",
    "stored_status_counts",
    "update_tracking",
    "update_tracking_incrementally",
    "with_dataset_config",
    "with_metrics",
    "with_parsed_name",
    "with_requirement",
]
