"""Layer jobs: SOR load, SOT rule, SOT consolidation, SPEC publication."""

from tidemark.plans.layers import (
    consolidate_sot,
    load_sor,
    publish_spec,
    resolve_source_locks,
    run_layer,
    run_rule,
)
from tidemark.plans.records import (
    append_status,
    ledger_state,
    load_and_record,
    open_runs,
    publish_and_record,
    run_rules_and_record,
    settled_runs,
    sweep_runs,
)

__all__ = [
    "append_status",
    "consolidate_sot",
    "ledger_state",
    "load_and_record",
    "load_sor",
    "open_runs",
    "publish_and_record",
    "publish_spec",
    "resolve_source_locks",
    "run_layer",
    "run_rule",
    "run_rules_and_record",
    "settled_runs",
    "sweep_runs",
]
