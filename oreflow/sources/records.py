"""Records of delimited text whose quoted values may hold line ends, found without one reader for a file.

Whether a line begins inside a quoted value depends on all lines before it. Each line is therefore read both
ways: from outside (does it leave a quote open, after how many commas) and from inside (does it close the
value, and how many commas follow). A record of several lines runs from a line that leaves a quote open to the
next line that closes one. Where that line is, and how many commas lie between, are prefix sums over the
lines of a block and then over the blocks of a file, so every task works on its own part of the file.

Such a record counts only if it has as many fields as the header and its quotes stand next to commas or at the
ends of lines. Otherwise the quote at its begin is a stray one: the line is a record by itself and so are those
behind it. A line that ends one such record never begins another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oreflow.errors import IngestionError
from oreflow.session import stored_once

# A value in quotes, doubled quotes in it, and what follows it up to the next comma.
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_QUOTED = rf'(^|,)"{_INSIDE}"[^,]*'
_OPEN = r'(^|,)"'
_LINE = ("path", "block", "at")


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """value, name, path, block, at: lines with where they stand. ``at`` rises along a block (a split of a file)."""
    found = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    return found.withColumn("at", F.monotonically_increasing_id())


def _scanned(text: Column) -> tuple[Column, Column]:
    """Read from outside: commas between fields up to a quote that stays open, and whether one does."""
    rest = F.regexp_replace(text, _QUOTED, "$1")
    before = F.regexp_replace(rest, _OPEN + r"[\s\S]*\z", "$1")
    return F.length(before) - F.length(F.replace(before, F.lit(","), F.lit(""))), rest.rlike(_OPEN)


def leaves_open(text: Column) -> Column:
    """Does the line, read from outside, end inside a quoted value?"""
    return text.contains('"') & _scanned(text)[1]


def any_leaves_open(lines: DataFrame) -> bool:
    """Does any line leave a quote open? Also checks that all files begin with the same line. One pass over the text."""
    begin = lines.where("block = 0").first()
    if begin is None:
        return False
    # Numbers only, so that lines are counted in place; the least of texts would have all of them sorted.
    header, at = begin["value"].removeprefix("\ufeff"), F.when(F.col("block") == 0, F.col("at"))
    same = F.col("value").isin(header, f"\ufeff{header}")
    found = lines.groupBy("path", "name").agg(F.min(at).alias("first"), F.min(F.when(same, at)).alias("header"), F.max(leaves_open(F.col("value"))).alias("open")).collect()  # a row for each file
    names = {r.first == r.header: r.name for r in sorted(found, key=lambda r: r.name, reverse=True)}
    if len(names) > 1:
        raise IngestionError(f"files differ in their header: {sorted(names.values())}")
    return any(r.open for r in found)


def spans(lines: DataFrame, fields: int) -> DataFrame:
    """path, start, end (each a struct of block and at): first and last line of each record of several lines."""
    value = F.col("value")
    from_inside = F.concat(F.lit("x"), F.regexp_replace(value, rf'^{_INSIDE}"', ""))
    rows = lines.where(value.contains('"')).select(
        *_LINE,
        _scanned(value)[0].alias("commas"),
        _scanned(value)[1].alias("open"),
        F.when(~value.rlike(rf'^{_INSIDE}"'), "goes on").when(value.rlike(rf'^{_INSIDE}"(,|\z)'), "closes").otherwise("broken").alias("kind"),
        _scanned(from_inside)[0].alias("more"),
        _scanned(from_inside)[1].alias("again"),
    )
    rows = rows.where(F.col("open") | (F.col("kind") != "goes on")).withColumn("more", F.when(F.col("kind") == "closes", F.col("more")).otherwise(0))
    block = Window.partitionBy("path", "block")
    rows = rows.withColumn("sum", F.sum("more").over(block.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)))
    ends = (F.col("kind") == "closes") & ~F.col("again")
    stop = lambda total: F.struct("block", "at", ends.alias("ends"), total.alias("sum"))
    rows = rows.withColumn("stop", F.when(ends | (F.col("kind") == "broken"), stop(F.col("sum"))))
    rows = rows.withColumn("next", F.last("stop", True).over(block.orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, -1)))

    # One row for each block: what came before it in the file, and the first stop in a later one.
    file = Window.partitionBy("path")
    blocks = rows.groupBy("path", "block").agg(F.sum("more").alias("own"), F.min("stop").alias("first"))
    before = F.sum("own").over(file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.withColumn("before", F.coalesce(before, F.lit(0)))
    whole = lambda s: F.when(s.isNotNull(), s.withField("sum", s["sum"] + F.col("before")))
    blocks = blocks.withColumn("first", whole(F.col("first")))
    blocks = blocks.withColumn("later", F.last("first", True).over(file.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)))

    opened = rows.where("open").join(blocks.select("path", "block", "before", "later"), ["path", "block"])
    opened = opened.withColumn("stop", F.coalesce(whole(F.col("next")), F.col("later")))
    between = F.col("stop.sum") - F.col("sum") - F.col("before")
    good = F.col("stop.ends") & (F.col("commas") + between == fields - 1)
    found = opened.where(good).select("path", F.struct("block", "at").alias("start"), F.struct("stop.block", "stop.at").alias("end"))
    found = found.join(found.select("path", F.col("end").alias("start")).distinct(), ["path", "start"], "left_anti")
    return found.groupBy("path", "end").agg(F.min("start").alias("start"))


def records(lines: DataFrame, fields: int) -> DataFrame:
    """value, name, path, block, at: each record as text, with the place of its first line, without the header and blank lines.

    ``lines`` must be stored: other tasks, or the same on another number of cores, would cut and number the files
    differently. Lines of a record are joined by ``\\n``. Only blocks that a record of several lines touches are shuffled.
    """
    files = lines.where("block = 0").groupBy("path", "name").agg(F.min("at").alias("at")).collect()  # a row for each file
    # Files go by number, as each line that moves carries its file.
    numbers = lines.sparkSession.createDataFrame([(r.path, r.name, k, r.at) for k, r in enumerate(files)], "path string, name string, file int, first long")
    known = F.broadcast(numbers)
    lines = lines.join(known.select("path", F.col("file").alias("number"), "first"), "path").where((F.col("block") != 0) | (F.col("at") != F.col("first")))
    lines, told = lines.select("value", F.col("number").alias("path"), "block", "at"), F.trim("value") != ""
    # What is read several times is stored, or each reader would shuffle for itself.
    found = stored_once(spans(lines, fields), "record-spans")
    mark = F.struct("start", "end").alias("mark")
    begins = found.select("path", F.col("start.block").alias("block"), F.col("start.at").alias("at"), mark)
    # A record that goes on in a later block is told at the head of that block; at most one does.
    blocks = F.broadcast(lines.select("path", "block").distinct())
    wide = found.where(F.col("start.block") < F.col("end.block"))
    inside = (F.col("block") > F.col("start.block")) & (F.col("block") <= F.col("end.block"))
    begins = begins.unionByName(blocks.join(wide, "path").where(inside).select("path", "block", F.lit(-1).cast("long").alias("at"), mark))
    touched = F.broadcast(begins.select("path", "block").distinct())  # a row for each block, however many lines it has

    rows = lines.join(touched, ["path", "block"]).unionByName(begins, allowMissingColumns=True)
    order = Window.partitionBy("path", "block").orderBy("at", F.col("mark").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    rows = stored_once(rows.withColumn("last", F.last("mark", True).over(order)).where("mark IS NULL").drop("mark"), "record-lines")
    covered = F.coalesce(F.struct("block", "at") <= F.col("last.end"), F.lit(False))
    parts = F.sort_array(F.collect_list(F.struct("block", "at", "value")))
    joined = rows.where(covered).groupBy("path", F.col("last.start").alias("start")).agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value"))
    several = joined.select("value", "path", "start.block", "start.at")
    single = rows.where(~covered & told).select(several.columns)
    rest = lines.join(touched, ["path", "block"], "left_anti").where(told).select(several.columns)
    records = rest.unionByName(single).unionByName(several).withColumnRenamed("path", "file")
    return records.join(F.broadcast(numbers), "file").select("value", "name", "path", "block", "at")
