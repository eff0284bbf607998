"""Column expressions; everything runs inside the JVM."""

from linkrank.functions.logmath import log_add, safe_ln
from linkrank.functions.text import normalize_title, page_links, unescape_entities

__all__ = ["log_add", "normalize_title", "page_links", "safe_ln", "unescape_entities"]
