"""Evidence from positioned text lines: headings, sections, claims, tables and canonical text.

A lines table has artifact_id, page_number, line_no, text and a box l, t, r, b (b < t).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.functions import text as tx

HEADING_RATIO = 1.5
ROW_TOLERANCE = 4.0


def filled(lines: DataFrame) -> DataFrame:
    """``lines`` with their text stripped, without blank ones, which count nowhere."""
    return lines.withColumn("text", tx.stripped(F.col("text"))).where(F.col("text") != "")


def location(left: Column, top: Column, right: Column, bottom: Column) -> Column:
    return F.format_string("x0=%.2f,y0=%.2f,x1=%.2f,y1=%.2f", *(c.cast("double") for c in (left, top, right, bottom)))


def headings(lines: DataFrame, height: str = "height") -> DataFrame:
    """The filled lines with ``is_heading``: at least 1.5 times as high as the page's median line."""
    # one shuffle by artifact serves the pages' medians and the sections
    median = F.median(height).over(Window.partitionBy("artifact_id", "page_number"))
    flag = F.col(height) >= HEADING_RATIO * median
    return filled(lines).repartition("artifact_id").withColumn("is_heading", F.coalesce(flag, F.lit(False)))


def sections(lines: DataFrame) -> DataFrame:
    """``lines`` with ``section``: the last heading up to the line itself, across pages."""
    order = Window.partitionBy("artifact_id").orderBy("page_number", "line_no").rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("section", F.last(F.when(F.col("is_heading"), F.col("text")), ignorenulls=True).over(order))


def text_evidence(lines: DataFrame) -> DataFrame:
    """One row a line: claim, value, role, section and canonical text, and the location of lines with
    a box; blank lines give none."""
    rows = sections(headings(lines))
    boxed = set("ltrb") <= set(lines.columns)
    role = F.when(F.col("is_heading"), "heading").otherwise("text")
    return rows.select(
        "artifact_id",
        "page_number",
        "line_no",
        tx.claim(F.col("text")).alias("claim"),
        tx.value(F.col("text")).alias("value"),
        F.col("text").alias("supporting_context"),
        F.lit("text").alias("evidence_type"),
        role.alias("role"),
        "section",
        (location(*map(F.col, "ltrb")) if boxed else F.lit(None).cast("string")).alias("location"),
        tx.canonical(F.lit("text"), role, F.col("section"), F.col("text")).alias("canonical_text"),
        F.lit(tx.SERIALIZER_VERSION).alias("canonical_serializer_version"),
    )


_CELL = "struct<centre:double,line_no:int,l:double,t:double,r:double,b:double,text:string>"


def table_rows(cells: Column, tolerance: float = ROW_TOLERANCE) -> Column:
    """Rows of cells (an array of structs with centre, line_no, l), from the top: a cell belongs to the
    last row if it is within the tolerance of that row's first cell, and else begins one. Cells of a
    row go from left to right."""
    from_top = F.array_sort(cells, lambda x, y: F.when(x["centre"] != y["centre"], F.signum(y["centre"] - x["centre"])).otherwise(x["line_no"] - y["line_no"]).cast("int"))

    def place(rows: Column, cell: Column) -> Column:
        last = F.element_at(rows, -1)
        near = (F.size(rows) > 0) & (F.abs(F.get(last, F.lit(0))["centre"] - cell["centre"]) <= tolerance)
        grown = F.concat(F.slice(rows, 1, F.size(rows) - 1), F.array(F.concat(last, F.array(cell))))
        return F.when(F.coalesce(near, F.lit(False)), grown).otherwise(F.concat(rows, F.array(F.array(cell))))

    rows = F.aggregate(from_top, F.array().cast(f"array<array<{_CELL}>>"), place)
    from_left = lambda x, y: F.when(x["l"] != y["l"], F.signum(x["l"] - y["l"])).otherwise(x["line_no"] - y["line_no"]).cast("int")
    return F.transform(rows, lambda row: F.array_sort(row, from_left))


def tables(lines: DataFrame) -> DataFrame:
    """``artifact_id, page_number, headers, rows, location, section, evidence_type, claim, value,
    supporting_context``: the table of a page, if at least two rows of several cells are equally wide;
    the first is the header. The location's y0 is the top.

    The rows are a fold over the page's cells in one expression; pages are small. The section is that
    of the page's last line.
    """
    rows = sections(headings(lines))
    cell = F.struct(((F.col("t") + F.col("b")) / 2).cast("double").alias("centre"), F.col("line_no").cast("int").alias("line_no"), *(F.col(c).cast("double").alias(c) for c in "ltrb"), "text")
    pages = rows.groupBy("artifact_id", "page_number").agg(table_rows(F.collect_list(cell)).alias("found"), F.max_by("section", "line_no").alias("section"))
    wide = pages.withColumn("wide", F.filter("found", lambda row: F.size(row) >= 2))
    even = (F.size("wide") >= 2) & (F.size(F.array_distinct(F.transform("wide", F.size))) == 1)
    every, texts = F.flatten("wide"), F.transform("wide", lambda row: row["text"])
    side = lambda pick, c: pick(F.transform(every, lambda x: x[c]))
    place = location(side(F.array_min, "l"), side(F.array_max, "t"), side(F.array_max, "r"), side(F.array_min, "b"))
    found = wide.where(even).select("artifact_id", "page_number", F.get(texts, F.lit(0)).alias("headers"), F.slice(texts, 2, F.size(texts)).alias("rows"), place.alias("location"), "section")
    header = F.array_join("headers", " | ")
    context = F.array_join(F.concat(F.array(header), F.transform("rows", lambda row: F.array_join(row, " | "))), "\n")
    return found.select("*", F.lit("table").alias("evidence_type"), F.lit("Table").alias("claim"), header.alias("value"), context.alias("supporting_context"))


def page_sections(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """``artifact_id, page_number, section``: the section at the end of each of ``pages``."""
    own = sections(headings(lines)).groupBy("artifact_id", "page_number").agg(F.max_by("section", "line_no").alias("section"))
    every = pages.select("artifact_id", "page_number").union(own.select("artifact_id", "page_number")).distinct().join(own, ["artifact_id", "page_number"], "left")
    order = Window.partitionBy("artifact_id").orderBy("page_number").rowsBetween(Window.unboundedPreceding, 0)
    return every.withColumn("section", F.last("section", ignorenulls=True).over(order))


def visuals(bitmaps: DataFrame, lines: DataFrame) -> DataFrame:
    """One evidence row a bitmap (artifact_id, page_number, bitmap_no, l, t, r, b), in the section at its
    page's end."""
    context = F.concat(F.lit("Embedded image on page "), F.col("page_number"))
    return bitmaps.join(page_sections(lines, bitmaps), ["artifact_id", "page_number"], "left").select(
        "artifact_id",
        "page_number",
        "bitmap_no",
        F.lit("visual").alias("evidence_type"),
        F.lit("bitmap").alias("kind"),
        F.lit("Embedded image").alias("claim"),
        F.lit("bitmap").alias("value"),
        context.alias("supporting_context"),
        location(*map(F.col, "ltrb")).alias("location"),
        "section",
    )


def extraction_metadata(evidence: DataFrame, found_tables: DataFrame | None = None, found_visuals: DataFrame | None = None) -> DataFrame:
    """Counts of each artifact's evidence; headings are text too. ``page_count`` is of pages with text."""
    out = evidence.groupBy("artifact_id").agg(
        F.count_distinct("page_number").alias("page_count"),
        F.count(F.lit(1)).alias("text_count"),
        F.count_if(F.col("role") == "heading").alias("heading_count"),
    )
    for name, rows in (("table_count", found_tables), ("visual_count", found_visuals)):
        if rows is not None:
            out = out.join(rows.groupBy("artifact_id").agg(F.count(F.lit(1)).alias(name)), "artifact_id", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return out


