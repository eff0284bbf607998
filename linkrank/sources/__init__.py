"""Readers and writers."""

from linkrank.sources.adjacency_text import read_adjacency_text, write_adjacency_text
from linkrank.sources.dump import read_tagged_records
from linkrank.sources.reports import read_counters, read_topk_text, write_counters, write_topk_text
from linkrank.sources.snapshots import iteration_path, last_iteration, read_graph, read_ranks, write_graph

__all__ = [
    "iteration_path",
    "last_iteration",
    "read_adjacency_text",
    "read_counters",
    "read_graph",
    "read_ranks",
    "read_tagged_records",
    "read_topk_text",
    "write_adjacency_text",
    "write_counters",
    "write_graph",
    "write_topk_text",
]
