"""Graphs and dumps that Spark derives from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank import LinkGraph, build_graph, store_graph
from linkrank.session import scratch_folder, stored

# One wiki page record per row of `part`: the expression reads the same in both engines.
# It reaches every fate of a page and the main link rules, and repeats titles.
WIKI_RECORD = """concat(
  '<page><title>',
  CASE WHEN p_partkey % 29 = 7 THEN '' ELSE concat('Part &amp; ', cast(cast(floor(p_partkey * 0.9) AS bigint) AS string), '</title>') END,
  CASE WHEN p_partkey % 29 = 7 AND p_partkey % 2 = 0 THEN '</title>' ELSE '' END,
  CASE WHEN p_partkey % 5 = 0 THEN '' WHEN p_partkey % 11 = 1 THEN '<ns>10</ns>' WHEN p_partkey % 37 = 2 THEN '<ns>0' ELSE concat('<ns>', chr(10), '0 </ns>') END,
  '<revision>',
  CASE WHEN p_partkey % 31 = 3 THEN '<text/>' ELSE concat('<text xml:space="preserve">',
    CASE p_partkey % 13
      WHEN 0 THEN concat('#redirect  [[Part &amp; ', cast(p_partkey + 1 AS string), ']]')
      WHEN 1 THEN 'x {{Disambiguation}} [[Part &amp; 1]]'
      WHEN 2 THEN '[[Part &amp; 2]] {{geo-stub}}'
      WHEN 3 THEN ''
      WHEN 4 THEN concat(p_name, ' [[#s|h]] [[File:x.png]] [[]] [[a|b:c]] [[open')
      WHEN 5 THEN 'see Wikipedia:Stub [[Part &amp; 3]]'
      ELSE concat(p_name,
        ' [[Part &amp; ', cast(cast(floor(p_partkey * 0.5) AS bigint) AS string), '|', p_brand, ']]',
        ' [[Part &amp; ', cast(p_partkey + 3 AS string), '#sec|y]]',
        ' [[Part &amp; ', cast((p_partkey * 7) % 211 AS string), ']]',
        ' [[Part &amp; ', cast((p_partkey * 7) % 211 AS string), ']]',
        ' [[', p_type, chr(10), '&quot;', cast(p_size AS string), '&quot;]] [[Caf&#233; x]] [[a [[b]] c]]')
    END, '</text>') END,
  '</revision></page>')"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wiki_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``p_partkey, rec``."""
    return table(spark, sf_dir, "part").selectExpr("p_partkey", f"{WIKI_RECORD} AS rec")


def wiki_dump(spark: SparkSession, sf_dir: str, compression: str = "none") -> str:
    """The records as dump files, with text around them and a record that was cut off.

    Each file begins with the end of a record that another file began.
    """
    lines = wiki_records(spark, sf_dir).select(
        F.concat(F.lit("cut</revision></page>\n<mediawiki>\n <siteinfo/> "), "rec", F.lit("\n ")).alias("value")
    )
    cut_off = lines.sparkSession.createDataFrame([("<page><title>cut off</title>",)], lines.schema)
    path = scratch_folder(spark, "dump")
    lines.unionAll(cut_off).write.option("compression", compression).text(path)
    return path


def succession_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``src, dst, returned``: from the part on one line of an order to the part on the next line, by number.

    ``returned`` tells whether the first of the two lines was.
    """
    lines = table(spark, sf_dir, "lineitem")
    first = lines.select(
        "l_orderkey",
        (F.col("l_linenumber") + 1).alias("l_linenumber"),
        F.col("l_partkey").alias("src"),
        (F.col("l_returnflag") == "R").alias("returned"),
    )
    second = lines.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("dst"))
    return first.join(second, ["l_orderkey", "l_linenumber"]).select("src", "dst", "returned")


def titles(pairs: DataFrame) -> DataFrame:
    """``src, dst``: the numbers of parts as titles."""
    return pairs.select(F.col("src").cast("string").alias("src"), F.col("dst").cast("string").alias("dst"))


def succession_raw(spark: SparkSession, sf_dir: str, closed: bool = False) -> DataFrame:
    """``src, dst``: from the part on one line of an order to the part on the next line.

    Unless ``closed``, only returned lines lead on, so some targets are no source.
    """
    pairs = succession_pairs(spark, sf_dir)
    return titles(pairs if closed else pairs.where("returned"))


def succession_graph(spark: SparkSession, sf_dir: str, closed: bool = False) -> LinkGraph:
    return store_graph(build_graph(succession_raw(spark, sf_dir, closed)))


def succession_graphs(spark: SparkSession, sf_dir: str) -> dict[str, LinkGraph]:
    """The ``open`` and the ``closed`` graph of the lines, from one join and one deduplication.

    The links of the open one are those of the closed one that some returned line made; they
    have a folder of their own. Parts are stored as numbers and read as titles.
    """
    path = scratch_folder(spark, "graphs")
    links = succession_pairs(spark, sf_dir).groupBy("src", "dst").agg(
        F.coalesce(F.max("returned"), F.lit(False)).alias("returned")
    )
    links.write.partitionBy("returned").parquet(f"{path}/edges")
    edges = spark.read.schema(links.schema).parquet(f"{path}/edges")
    degrees = edges.groupBy("src").agg(F.count_if("returned").alias("open"), F.count("*").alias("closed"))
    nodes = stored(degrees.select(F.col("src").cast("string").alias("title"), "open", "closed"), f"{path}/nodes")

    def graph(name: str, links: DataFrame) -> LinkGraph:
        sources = nodes.where(F.col(name) > 0).select("title", F.col(name).alias("out_degree"))
        return LinkGraph(sources, titles(links), is_stored=True)

    return {"open": graph("open", edges.where("returned")), "closed": graph("closed", edges)}
