"""DataFrame transformations."""

from linkrank.operators.graph import (
    LinkGraph,
    adjacency,
    build_graph,
    duplicate_titles,
    graph_counters,
    graph_from_adjacency,
    graph_summary,
    missing_structure,
    preview_graph,
    require_unique_titles,
    store_graph,
    type_histogram,
)
from linkrank.operators.pages import (
    classify_pages,
    html_edges,
    page_edges,
    parse_counters,
    parse_pages,
    raw_links,
)
from linkrank.operators.ranking import (
    contributions,
    iteration_counters,
    log_mass_sum,
    mass_per_target,
    missing_mass,
    rank_mass_total,
    rank_tables,
    receive_mass,
)
from linkrank.operators.topk import topk_pages, topk_report

__all__ = [
    "LinkGraph",
    "adjacency",
    "build_graph",
    "classify_pages",
    "contributions",
    "duplicate_titles",
    "graph_counters",
    "graph_from_adjacency",
    "graph_summary",
    "html_edges",
    "iteration_counters",
    "log_mass_sum",
    "mass_per_target",
    "missing_mass",
    "missing_structure",
    "page_edges",
    "parse_counters",
    "parse_pages",
    "preview_graph",
    "rank_mass_total",
    "rank_tables",
    "raw_links",
    "receive_mass",
    "require_unique_titles",
    "store_graph",
    "topk_pages",
    "topk_report",
    "type_histogram",
]
