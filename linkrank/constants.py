"""Values that define what a page, an article, a link and a rank are."""

# --- fixed values -----------------------------------------------------------
# Tags around one page record; both can be replaced when reading.
PAGE_START = "<page>"
PAGE_END = "</page>"

# Marks that cut a field out of a record, and the title as a pattern for other markup.
NAMESPACE_START = "<ns>"
NAMESPACE_END = "</ns>"
TITLE_START = "<title>"
TITLE_END = "</title>"
TITLE_PATTERN = r"(?s)<title>(.*?)</title>"
BODY_TAG = "<text"
BODY_START = ">"
BODY_END = "</text>"
ARTICLE_NAMESPACE = "0"

# Characters that do not count around a namespace: U+0000 to U+0020.
BLANKS = "".join(map(chr, range(0x21)))

# Marks of pages that are left out of the graph.
REDIRECT_PATTERN = r"(?i)#REDIRECT\s*\[\[(.*?)\]\]"
DISAMBIGUATION_PATTERN = r"(?i)\{\{disambig\w*\}\}"
STUB_PAGE = "Wikipedia:Stub"
STUB_TEMPLATE = "-stub}}"

# Links inside wiki text and inside HTML.
WIKI_LINK_PATTERN = r"(?s)\[\[(.*?)\]\]"
LINK_START = "[["
LINK_END = "]]"
HTML_LINK_PATTERN = r'<a href="([^"]*)"'
SPECIAL_LINK_MARK = ":"
LABEL_MARK = "|"
SECTION_MARK = "#"

# Fates of a page, in the order in which they are tested.
NOT_ARTICLE = "NOT_ARTICLE"
NO_TITLE = "NO_TITLE"
EMPTY_TITLE = "EMPTY_TITLE"
NO_TEXT = "NO_TEXT"
EMPTY_TEXT = "EMPTY_TEXT"
REDIRECT = "REDIRECT"
DISAMBIGUATION = "DISAMBIGUATION"
STUB = "STUB"
ARTICLE = "ARTICLE"

# Further counters of the parse, and the counters of an iteration.
TOTAL_PAGES = "TOTAL_PAGES"
NO_LINKS = "NO_LINKS"
NODES = "NODES"
EDGES = "EDGES"
VERTICES = "VERTICES"
MASS_MESSAGES_SENT = "MASS_MESSAGES_SENT"
MASS_MESSAGES_RCVD = "MASS_MESSAGES_RCVD"
MISSING_STRUCTURE = "MISSING_STRUCTURE"

# States of a stored page. INVALID is never stored.
INITIALIZED = "INITIALIZED"
STRUCTURE = "STRUCTURE"
MASS = "MASS"
COMPLETED = "COMPLETED"
PAGE_TYPES = (INITIALIZED, STRUCTURE, MASS, COMPLETED)

# Random-jump factor and default length of the top list.
ALPHA = 0.15
TOP_K = 100
# ----------------------------------------------------------------------------
