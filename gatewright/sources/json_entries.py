"""One large JSON document cut into the entries of its sections, by many tasks.

A document such as ``{"section": {"key": value, ..}, ..}`` is one value to a JSON
reader, and so one task's work. Here it is read as text that ends at every comma,
which Spark splits into byte ranges like any text. What a comma means depends on
all that stands before it: on whether it lies in a string, and how deep in the
document. Both are running sums over the fragments, of quotes and of brackets
outside strings, and the sums of the byte ranges are combined by prefix
(:func:`gatewright.functions.chunks.ordered_scan`). Fragments between two commas
that part entries are then put together again, each entry for itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewright.functions.chunks import ordered_scan

STRING = r'"(?:[^"\\]++|\\.)*+"'
KEY = rf"\s*{STRING}\s*:\s*"
FIRST_KEY = r'(?s)^\ufeff?\s*\{?\s*"((?:[^"\\]++|\\.)*+)"\s*:'


class BrokenDocument(ValueError):
    """A document that ends inside a string or before its last bracket."""


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _deeper(text: Column) -> Column:
    return _count(text, "{[") - _count(text, "}]")


def fragments(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``file, block, row, text``: the documents cut at every comma, one document per file."""
    return spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("text"),
    )


def placed(parts: DataFrame) -> DataFrame:
    """Add ``inside`` (the fragment begins within a string), ``depth`` (of brackets open before it) and ``deeper`` (what it adds)."""
    order, chunk = ["block", "row"], F.col("block")
    pieces = F.split(F.regexp_replace("text", r"(?s)\\.", ""), '"')
    part = lambda odd: F.array_join(F.filter(pieces, lambda _, k: k % 2 == odd), "")
    counted = parts.withColumns({"quotes": F.size(pieces) - 1, "outside": _deeper(part(0)), "within": _deeper(part(1))})
    quoted = ordered_scan(counted, ["file"], order, chunk, sum_upto={"quotes_upto": F.col("quotes")})
    inside = (F.col("quotes_upto") - F.col("quotes")) % 2 == 1
    known = quoted.withColumn("inside", inside).withColumn("deeper", F.when(F.col("inside"), F.col("within")).otherwise(F.col("outside")))
    deep = ordered_scan(known, ["file"], order, chunk, sum_upto={"depth_upto": F.col("deeper")})
    return deep.withColumn("depth", F.col("depth_upto") - F.col("deeper")).drop("quotes", "outside", "within", "depth_upto")


def document_entries(spark: SparkSession, path: str | Sequence[str], listed: Sequence[str] = ()) -> DataFrame:
    """``file, section, entry``: the text of every object that is a value of a section, or an item of a value of a ``listed`` section.

    What follows an entry's last bracket may be left on its text; JSON readers
    stop there. Values that are no objects are left out.
    """
    order, chunk = ["block", "row"], F.col("block")
    parts = placed(fragments(spark, path))
    begins = F.when(~F.col("inside") & (F.col("depth") <= 1), F.nullif(F.regexp_extract("text", FIRST_KEY, 1), F.lit("")))
    named = ordered_scan(parts, ["file"], order, chunk, last_upto={"section": begins})
    item = F.col("section").isin(list(listed)) if listed else F.lit(False)
    cut = ~F.col("inside") & ((F.col("depth") <= 2) | (item & (F.col("depth") == 3)))
    marked = ordered_scan(named, ["file"], order, chunk, last_upto={"start": F.when(cut, F.struct("block", "row"))})
    whole = marked.groupBy("file", "section", "start").agg(
        F.array_sort(F.collect_list(F.struct("block", "row", "text"))).alias("of"), F.max(F.when(cut, F.col("depth"))).alias("depth")
    )
    text = F.array_join(F.transform("of", lambda f: f["text"]), ",")
    opening = r"\[?\s*" if listed else ""
    heads = {0: rf"\ufeff?\s*\{{{KEY}\{{{KEY}", 1: rf"{KEY}\{{{KEY}", 2: KEY}
    found = F.regexp_extract(text, r"(?s)^\s*(\{.*)$", 1)
    for depth, head in heads.items():
        found = F.when(F.col("depth") == depth, F.regexp_extract(text, rf"(?s)^{head}{opening}(\{{.*)$", 1)).otherwise(found)
    return whole.select("file", "section", found.alias("entry")).filter("entry <> ''")


def broken_documents(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``file`` of every document that is no object, or whose quotes or brackets do not match."""
    ends = placed(fragments(spark, path))
    quotes = F.size(F.split(F.regexp_replace("text", r"(?s)\\.", ""), '"')) - 1
    at = F.struct("block", "row")
    totals = ends.groupBy("file").agg(
        F.sum("deeper").alias("open"), F.sum(quotes).alias("quotes"), F.min(F.when(~F.col("inside"), F.col("depth"))).alias("least"),
        F.min_by("text", at).alias("first"), F.max_by("text", at).alias("last"),
    )
    whole = F.col("first").rlike("^\ufeff?\\s*\\{") & F.col("last").rlike(r"\}\s*$") & F.expr("open = 0 AND quotes % 2 = 0 AND least >= 0")
    return totals.filter(~whole).select("file")
