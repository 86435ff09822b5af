"""Records of JSON files that hold one record a line, an array a line, or arrays over many lines.

A file is never read whole. Lines come from the splittable text reader, each with its split and its place there. Strings
never cross lines, so a line's braces can be counted by itself; sums over the lines of a split, and over the splits of
a file, give every line the depth at which it begins. A record starts at each piece of text at the file's outer depth: no earlier, or
no later, piece lies further out. So a record that lacks closing braces raises the level for what follows and
takes nothing else along, and neither does one with too many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: A string, or the open end of one that its line cuts short.
STRING = r'"(?:\\.|[^"\\])*+(?:"|$)'
#: A part of a line up to and with a comma before an object; strings are passed over.
PIECE = r'(?:"(?:\\.|[^"\\])*+(?:"|$)|[^",]|,(?!\s*\{))++,?|,'
#: What may stand between records.
BETWEEN = r"^[\s,\[]+|[\s,\]]+$"


def _braces(text: Column, one: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(one), F.lit("")))


def _change(text: Column) -> Column:
    """Opening minus closing braces outside strings."""
    bare = F.regexp_replace(text, STRING, "")
    return (_braces(bare, "{") - _braces(bare, "}")).cast("long")


def json_lines(spark: SparkSession, root: str) -> DataFrame:
    """(path, split, place, value) of the lines that are not blank; ``place`` grows along a split."""
    lines = spark.read.option("recursiveFileLookup", True).text(root).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("place"), "value")
    return lines.where(F.btrim("value", F.lit(" \t\r\n\ufeff")) != "")


def _alone(value: Column) -> Column:
    """Whether a line holds whole records only: an object or an array, all braces and brackets closed."""
    bare = F.trim(F.regexp_replace(value, STRING, ""))
    closed = (bare.startswith("{") & bare.endswith("}")) | (bare.startswith("[") & bare.endswith("]"))
    return closed & (_braces(bare, "{") == _braces(bare, "}")) & (_braces(bare, "[") == _braces(bare, "]"))


def _outer(pieces: DataFrame) -> DataFrame:
    """``pieces`` (path, split, place, part, piece, change) with ``outer``: whether each begins at the file's outer depth.

    Everything is computed inside a split first; of each split only its sums meet those of the file's other splits.
    """
    inside = Window.partitionBy("path", "split").orderBy("place", "part")
    so_far, ahead = inside.rowsBetween(Window.unboundedPreceding, -1), inside.rowsBetween(0, Window.unboundedFollowing)
    local = pieces.withColumn("before", F.coalesce(F.sum("change").over(so_far), F.lit(0)))
    local = local.withColumns({
        "low_before": F.min("before").over(so_far), "low_after": F.min(F.col("before") + F.col("change")).over(ahead)})
    sums = local.groupBy("path", "split").agg(
        F.sum("change").alias("total"), F.min("before").alias("low"), F.min(F.col("before") + F.col("change")).alias("end_low"))
    file = Window.partitionBy("path").orderBy("split")
    earlier, later = file.rowsBetween(Window.unboundedPreceding, -1), file.rowsBetween(1, Window.unboundedFollowing)
    based = sums.withColumn("base", F.coalesce(F.sum("total").over(earlier), F.lit(0))).withColumns({
        "low_earlier": F.min(F.col("base") + F.col("low")).over(earlier), "low_later": F.min(F.col("base") + F.col("end_low")).over(later)})
    full = local.join(based.select(F.col("path").alias("p"), F.col("split").alias("s"), "base", "low_earlier", "low_later"),
                      (F.col("path") == F.col("p")) & (F.col("split") == F.col("s")))
    depth = F.col("base") + F.col("before")
    first = depth <= F.least(depth, F.col("base") + F.col("low_before"), "low_earlier")
    last = depth <= F.least(depth, F.col("base") + F.col("low_after"), "low_later")
    return full.withColumn("outer", first | last).drop("p", "s", "base", "low_earlier", "low_later", "low_before", "low_after", "before")


def _numbered(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``record``: how many outer pieces with any content the file has up to each one."""
    starts = F.when(F.col("outer") & (F.regexp_replace("piece", BETWEEN, "") != ""), 1).otherwise(0).cast("long")
    marked = pieces.withColumn("starts", starts)
    earlier = Window.partitionBy("p").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    sums = marked.groupBy(F.col("path").alias("p"), F.col("split").alias("s")).agg(F.sum("starts").alias("n"))
    base = sums.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    inside = Window.partitionBy("path", "split").orderBy("place", "part").rowsBetween(Window.unboundedPreceding, 0)
    joined = marked.withColumn("own", F.sum("starts").over(inside)).join(base, (F.col("path") == F.col("p")) & (F.col("split") == F.col("s")))
    return joined.withColumn("record", F.col("base") + F.col("own"))


def record_texts(spark: SparkSession, root: str) -> DataFrame:
    """(path, text) of all records below ``root``; a text is one object, several with commas between, or something broken.

    Lines of files whose every line stands alone are passed on as they are; only other files' lines are exchanged.
    """
    lines = json_lines(spark, root)
    open_files = lines.where(~_alone(F.col("value"))).select(F.col("path").alias("open_path")).distinct()
    opened = F.col("path") == F.col("open_path")
    single = lines.join(open_files, opened, "left_anti").select("path", F.col("value").alias("text"))
    parts = F.posexplode(F.filter(F.regexp_extract_all("value", F.lit(PIECE), F.lit(0)), lambda x: x != ""))
    pieces = lines.join(open_files, opened, "left_semi").select("path", "split", "place", parts.alias("part", "piece"))
    numbered = _numbered(_outer(pieces.withColumn("change", _change(F.col("piece")))))
    lists = numbered.groupBy("path", "record").agg(F.sort_array(F.collect_list(F.struct("split", "place", "part", "piece"))).alias("pieces"))
    joined = lists.select("path", F.array_join(F.transform("pieces", lambda x: x["piece"]), "\n").alias("text"))
    return single.unionByName(joined).select("path", F.regexp_replace("text", BETWEEN, "").alias("text")).where("text != ''")
