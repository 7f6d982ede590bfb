from connlens.sources.lines import (
    narrow_interactions,
    parse_fields,
    parse_interactions,
    parse_outcome,
    pick_fields,
    read_lines,
    render_lines,
    split_rejects,
)
from connlens.sources.publishing import expire, publish, published
from connlens.sources.storage import (
    clear_scratch,
    cut_lineage,
    new_scratch_path,
    read_table,
    shared_folder,
    write_result,
)
from connlens.sources.tables import (
    cache_table,
    kept,
    kept_evenly,
    preview,
    range_source,
    register_view,
    schema_report,
    spread,
    spread_by_rows,
    spread_if_few,
)

__all__ = [
    "cache_table",
    "clear_scratch",
    "cut_lineage",
    "expire",
    "kept",
    "kept_evenly",
    "narrow_interactions",
    "new_scratch_path",
    "parse_fields",
    "parse_interactions",
    "parse_outcome",
    "pick_fields",
    "preview",
    "publish",
    "published",
    "range_source",
    "read_lines",
    "read_table",
    "register_view",
    "render_lines",
    "schema_report",
    "shared_folder",
    "split_rejects",
    "spread",
    "spread_by_rows",
    "spread_if_few",
    "write_result",
]
