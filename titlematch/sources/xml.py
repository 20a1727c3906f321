"""XML sources: one row per record element.

Two readers:

``read_xml_rows``
    Spark's built-in ``xml`` source.  Handles any XML (attributes on the row
    tag, CDATA, comments) but, on Spark 4.1, a single large file is read by a
    single task.

``read_xml_records``
    A splittable scan for record-per-element dumps: the text source cuts the
    file at the opening row tag (``lineSep``), so every split of every file
    is read in parallel, and ``from_xml`` parses each record.  Needs
    uncompressed input.  An input it cannot cut (the opening tag inside a
    record's comment, CDATA or nested element) fails; ``read_xml_lexed`` takes it.

Column pruning: pass a schema without unused children (``links``) and the
parser skips them instead of building nested rows that are dropped later.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titlematch.sources.xml_lex import read_xml_lexed

_LINK = T.StructType(
    [
        T.StructField("_linktype", T.StringType()),
        T.StructField("anchor", T.StringType()),
        T.StructField("link", T.StringType()),
    ]
)

# Full article record: <doc><title/><url/><abstract/><links><sublink linktype=...>...
ARTICLE_SCHEMA = T.StructType(
    [
        T.StructField("abstract", T.StringType()),
        T.StructField("links", T.StructType([T.StructField("sublink", T.ArrayType(_LINK))])),
        T.StructField("title", T.StringType()),
        T.StructField("url", T.StringType()),
    ]
)

# What the match uses; ``links`` is never parsed.
ARTICLE_SCHEMA_PRUNED = T.StructType(
    [
        T.StructField("abstract", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("url", T.StringType()),
    ]
)


def read_xml_rows(
    spark: SparkSession,
    path: str | list[str],
    row_tag: str,
    schema: T.StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """Built-in XML reader; attributes become ``_name`` fields."""
    reader = spark.read.format("xml").option("rowTag", row_tag).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def xml_records(chunks: DataFrame, row_tag: str, column: str = "value") -> DataFrame:
    """One ``record`` string per chunk that is a row.

    A chunk is what follows one ``<row_tag`` up to the next.  After optional
    attributes it is a row: self-closing, or up to its last closing tag (white
    space before ``>`` allowed).  Each row is cut by one regular expression, so
    no character positions are involved.  A chunk that does not go on like a tag
    (the head of the file, a longer tag name) is no row, and neither is one
    without a closing tag that ends inside a comment or CDATA section begun
    before it.  Every other chunk without a closing tag, and a row with the end
    of a comment after it (it may be commented out), fails the query: a record
    is never dropped or blanked.
    """
    tag = re.escape(row_tag)
    attributes = r"""(?:\s+[^\s=<>/"']+\s*=\s*(?:"[^"]*"|'[^']*'))*\s*"""
    c = F.col(column)
    opens, alone = c.rlike(f"^{attributes}/?>"), c.rlike(f"^{attributes}/>")
    cut = F.when(alone, F.regexp_extract(c, f"^({attributes}/>)", 1)).when(
        opens, F.regexp_extract(c, rf"(?s)^(.*</{tag}\s*>)", 1)
    )
    cuts = chunks.select(c, cut.alias("__cut"), alone.alias("__alone"))

    def ends(text: Column, mark: str, begin: str) -> Column:
        return (F.instr(text, mark) > 0) & ((F.instr(text, begin) == 0) | (F.instr(text, mark) < F.instr(text, begin)))

    def fail(problem: str) -> Column:
        return F.raise_error(F.concat(F.lit(f"<{row_tag}> {problem}, use the lexed reader: "), F.substring(c, 1, 200)))

    # what stands between the row and the next opening tag
    after = F.when(F.col("__alone"), F.regexp_extract(c, f"(?s)^{attributes}/>(.*)$", 1)).otherwise(
        F.element_at(F.split(c, rf"</{tag}\s*>"), -1)
    )
    commented = (F.instr(c, "-->") > 0) & ends(after, "-->", "<!--")
    quoted = ends(c, "-->", "<!--") | ends(c, "]]>", "<![CDATA[")
    # no filter stands before this: the optimiser may move one behind an error
    record = (
        F.when(F.col("__cut").isNull(), F.lit(None).cast("string"))
        .when((F.col("__cut") != "") & commented, fail("record that may be commented out"))
        .when(F.col("__cut") != "", F.concat(F.lit(f"<{row_tag}"), F.col("__cut")))
        .when(~quoted, fail("record without a closing tag"))
    )
    return cuts.select(record.alias("record")).filter(F.col("record").isNotNull())


def read_xml_records(
    spark: SparkSession,
    path: str | list[str],
    row_tag: str,
    schema: T.StructType | str,
    **options: str,
) -> DataFrame:
    """Splittable record-per-element XML scan (see module doc).

    Output columns are the top-level fields of ``schema``.  A record that is
    not well-formed fails the query; ``mode="PERMISSIVE"`` gives it as NULLs.
    """
    chunks = spark.read.option("lineSep", f"<{row_tag}").text(path)
    records = xml_records(chunks, row_tag)
    parsed = records.select(F.from_xml("record", schema, {"mode": "FAILFAST"} | options).alias("r"))
    return parsed.select("r.*")


def infer_xml_schema(
    spark: SparkSession,
    path: str | list[str],
    row_tag: str,
    sample_rows: int = 100,
) -> T.StructType:
    """Infer a record schema from the first ``sample_rows`` records.

    A leading sample is the feature: a field that no sampled record has is not
    in the schema, and a read with it leaves that field out everywhere.

    Only the sample reaches the driver (``limit`` then collect), it is
    wrapped in one root element and typed with ``schema_of_xml``; repeated
    children across records merge into arrays.  Inference from a few records
    can type a list as a struct when each sampled record has one child -
    prefer a fixed schema for production reads.
    """
    if sample_rows <= 0:
        raise ValueError("sample_rows must be positive")
    chunks = spark.read.option("lineSep", f"<{row_tag}").text(path)
    sample = (
        xml_records(chunks, row_tag)
        .limit(sample_rows)
        .collect()
    )
    if not sample:
        raise ValueError(f"no <{row_tag}> record found in {path}")
    doc = "<__sample>" + "".join(r.record for r in sample) + "</__sample>"
    ddl = spark.range(1).select(F.schema_of_xml(F.lit(doc)).alias("s")).first().s
    root = T.DataType.fromDDL(ddl)
    rows = root[row_tag].dataType
    return rows.elementType if isinstance(rows, T.ArrayType) else rows


def read_articles(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = ARTICLE_SCHEMA_PRUNED,
    splittable: bool = True,
    row_tag: str = "doc",
    sample_rows: int | None = None,
    lexed: bool = False,
) -> DataFrame:
    """Raw article dump, one row per ``<doc>``.

    ``lexed`` cuts the splits by lexing them all (see ``xml_lex``), for dumps with
    the row tag in comments, CDATA sections or nested elements.

    ``sample_rows`` infers the schema from that many leading records instead
    of using ``schema``; fields that only later records have are then left out.
    """
    if sample_rows is not None:
        schema = infer_xml_schema(spark, path, row_tag, sample_rows)
    if splittable:
        if schema is None:
            raise ValueError("the splittable reader needs a schema")
        if lexed:
            return read_xml_lexed(spark, path, row_tag, schema)
        return read_xml_records(spark, path, row_tag, schema)
    return read_xml_rows(spark, path, row_tag, schema)
