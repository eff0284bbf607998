"""Whole computations."""

from linkrank.plans.dump import dump_to_topk, parse_dump
from linkrank.plans.pagerank import pagerank_basic, pagerank_log

__all__ = ["dump_to_topk", "pagerank_basic", "pagerank_log", "parse_dump"]
