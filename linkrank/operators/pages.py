"""From raw page records to classified pages and links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank import constants as C
from linkrank.functions.text import link_spans, normalize_title, page_links, wiki_link_spans

_COUNTED_OUTCOMES = (
    C.NOT_ARTICLE,
    C.NO_TITLE,
    C.EMPTY_TITLE,
    C.NO_TEXT,
    C.EMPTY_TEXT,
    C.REDIRECT,
    C.DISAMBIGUATION,
    C.STUB,
)


def _cut(df: DataFrame, name: str, text: str, start: str, end: str) -> DataFrame:
    """Add ``name``: what stands in ``text`` from the first ``start`` to the next ``end``.

    NULL where a mark is missing. The positions are columns of their own, so each search
    runs once; for fields at the head of a long record it also ends there, where a
    pattern would decode the whole record.
    """
    opened, closed, source = F.col("_opened"), F.col("_closed"), F.col(text)
    first = opened + F.lit(len(start))
    return (
        df.withColumn("_opened", F.instr(source, F.lit(start)))
        .withColumn("_closed", F.when(opened > 0, F.position(F.lit(end), source, first)))
        .withColumn(name, F.when(closed > 0, F.substr(source, first, closed - first)))
        .drop("_opened", "_closed")
    )


def with_namespace(records: DataFrame, record: str = "rec") -> DataFrame:
    """Add ``namespace``, without blanks around it; NULL where a tag is missing."""
    trimmed = F.btrim(F.col("namespace"), F.lit(C.BLANKS))
    cut = _cut(records, "namespace", record, C.NAMESPACE_START, C.NAMESPACE_END)
    return cut.withColumn("namespace", trimmed)


def with_title(records: DataFrame, record: str = "rec") -> DataFrame:
    """Add ``raw_title``; NULL where a tag is missing."""
    return _cut(records, "raw_title", record, C.TITLE_START, C.TITLE_END)


def _after(text: Column, mark: str) -> Column:
    """What follows the first ``mark``; NULL if there is none."""
    start = F.instr(text, F.lit(mark)) + F.lit(len(mark))
    return F.when(F.contains(text, F.lit(mark)), F.substr(text, start))


def _before(text: Column, mark: str) -> Column:
    """What precedes the first ``mark``; NULL if there is none."""
    return F.when(F.contains(text, F.lit(mark)), F.substring_index(text, mark, 1))


def with_body(records: DataFrame, record: str = "rec") -> DataFrame:
    """Add ``body``, the raw text of the page; NULL where a tag is missing.

    Bodies are most of a dump. Plain searches cut them out many times faster than a
    pattern, one step each so that none is computed twice.
    """
    return (
        records.withColumn("body", _after(F.col(record), C.BODY_TAG))
        .withColumn("body", _after(F.col("body"), C.BODY_START))
        .withColumn("body", _before(F.col("body"), C.BODY_END))
    )


def is_article(record: Column, namespace: Column) -> Column:
    """No namespace at all, or the article namespace."""
    is_main = F.coalesce(namespace == C.ARTICLE_NAMESPACE, F.lit(False))
    return is_main | ~F.contains(record, F.lit(C.NAMESPACE_START))


def is_redirect(body: Column) -> Column:
    return F.rlike(body, F.lit(C.REDIRECT_PATTERN))


def is_disambiguation(body: Column) -> Column:
    return F.rlike(body, F.lit(C.DISAMBIGUATION_PATTERN))


def is_stub(record: Column, body: Column) -> Column:
    return F.contains(record, F.lit(C.STUB_PAGE)) | F.contains(body, F.lit(C.STUB_TEMPLATE))


def classify_pages(records: DataFrame, record: str = "rec") -> DataFrame:
    """``raw_title, body, outcome``: one fate per page, the first rule that applies.

    Fields are empty where there are none.
    """
    rec, title, body = F.col(record), F.col("raw_title"), F.col("body")
    fields = with_body(with_title(with_namespace(records.select(rec), record), record), record)
    outcome = (
        F.when(~is_article(rec, F.col("namespace")), C.NOT_ARTICLE)
        .when(title.isNull(), C.NO_TITLE)
        .when(title == "", C.EMPTY_TITLE)
        .when(body.isNull(), C.NO_TEXT)
        .when(body == "", C.EMPTY_TEXT)
        .when(is_redirect(body), C.REDIRECT)
        .when(is_disambiguation(body), C.DISAMBIGUATION)
        .when(is_stub(rec, body), C.STUB)
        .otherwise(C.ARTICLE)
    )
    return fields.select(
        F.coalesce(title, F.lit("")).alias("raw_title"),
        F.coalesce(body, F.lit("")).alias("body"),
        outcome.alias("outcome"),
    )


def parse_pages(records: DataFrame, record: str = "rec") -> DataFrame:
    """``title, outcome, links``: what the graph and the counters need of a dump.

    Small next to the dump, so a pipeline stores it and reads the dump once.
    """
    links = F.when(F.col("outcome") == C.ARTICLE, page_links(F.col("body")))
    return classify_pages(records, record).select(
        normalize_title(F.col("raw_title")).alias("title"),
        "outcome",
        F.coalesce(links, F.array().cast("array<string>")).alias("links"),
    )


def _one_row_each(pages: DataFrame, source: str, links: Column, name: str) -> DataFrame:
    # The outer form keeps Catalyst from copying the whole expression behind `links`
    # into a filter below the generator, where it would run a second time.
    exploded = pages.select(source, F.explode_outer(links).alias(name))
    return exploded.where(F.col(name).isNotNull())


def raw_links(classified: DataFrame) -> DataFrame:
    """``raw_title, link``: every link span of every article, unfiltered."""
    spans = F.when(F.col("outcome") == C.ARTICLE, wiki_link_spans(F.col("body")))
    return _one_row_each(classified, "raw_title", spans, "link")


def page_edges(parsed: DataFrame) -> DataFrame:
    """``src, dst``: the raw edges of parsed pages, repeats kept."""
    return _one_row_each(parsed, "title", F.col("links"), "dst").withColumnRenamed("title", "src")


def html_edges(pages: DataFrame, html: str = "html", *, title_pattern: str = C.TITLE_PATTERN,
               link_pattern: str = C.HTML_LINK_PATTERN) -> DataFrame:
    """``src, dst`` of other markup: the patterns say where title and links stand."""
    text = F.col(html)
    fields = pages.select(
        normalize_title(F.regexp_extract(text, title_pattern, 1)).alias("src"),
        F.transform(link_spans(text, link_pattern), normalize_title).alias("links"),
    )
    return _one_row_each(fields, "src", F.col("links"), "dst").where("src <> '' AND dst <> ''")


def parse_counters(parsed: DataFrame) -> DataFrame:
    """``metric, value``: pages seen, pages per fate, and articles without a link."""
    is_linkless = (F.col("outcome") == C.ARTICLE) & (F.size("links") == 0)
    counts = parsed.agg(
        F.count("*").alias(C.TOTAL_PAGES),
        *[F.count_if(F.col("outcome") == name).alias(name) for name in _COUNTED_OUTCOMES],
        F.count_if(is_linkless).alias(C.NO_LINKS),
    )
    return counts.unpivot([], counts.columns, "metric", "value")
