"""S1 for large files: one JSON array read by many tasks.

A JSON array cannot be cut just anywhere: whether a bracket counts depends on
all quotes before it. The scan is split nevertheless:

1. Spark's text reader, told that lines end with ``}``, deals the file out by
   byte ranges. The pieces between closing braces are never cut inside an
   escape (``\\}`` is no JSON escape), so each piece has an effect of its own:
   whether it flips the quote state, and how it changes the depth when it
   begins outside or inside a string.
2. Pieces are chained in chunks of ``CHUNK``; a chunk's effect for both
   states is a row of numbers. Prefix sums over these rows give the state
   at the beginning of each chunk, joined back to its pieces.
3. An object that closes at depth 1 ends a unit: that object and the elements
   that are no objects before it. Units within a chunk are put together there;
   of each chunk only the first and last one meet those of its neighbours.
4. Spark's JSON parser reads each unit, so elements have the text that
   ``landing.explode_documents`` gives, and what it refuses makes the document
   one that is no array.

The text is shuffled once, by chunk; everything else that moves is a row a
chunk. Chained pieces and parsed elements are used twice each; where
``spark.checkpoint.dir`` is set they are kept there (so jobs run while the
result is built), else they are computed twice. One unit is one row, so objects are limited by a row's size, and a
document without any closing brace is a single piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierflow.sinks.tables import staging_root

#: Pieces that are chained in one window.
CHUNK = 4096
#: Files up to this number have their verdicts sent to every task (a path and two numbers each).
FEW_FILES = 10_000
# Fixed value: JSON's white space.
_WHITE = " \t\n\r"
_PLACE = ["path", "block", "chunk"]


def _kept(df: DataFrame) -> DataFrame:
    """Computed once, for it is used twice, where the session names a folder for that."""
    return df.checkpoint() if staging_root(df.sparkSession) else df


def _count(text: Column, sign: str) -> Column:
    """How often a sign of one byte stands in a text."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(sign), F.lit("")))


def _depth(text: Column) -> Column:
    """Opening minus closing brackets."""
    return _count(text, "[") + _count(text, "{") - _count(text, "]") - _count(text, "}")


def _pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The text between closing braces with its place and its effects."""
    rows = spark.read.text(paths, lineSep="}").select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("text"),
        F.monotonically_increasing_id().alias("at"),
    )
    plain = F.when(F.contains("text", F.lit("\\")), F.regexp_replace("text", r"(?s)\\.", "")).otherwise(F.col("text"))
    # what a piece has outside strings if it begins outside one is inside them if it begins in one
    bare = F.regexp_replace("plain", r'"[^"]*+(?:"|\z)', "")
    flips = _count(F.col("plain"), '"') % 2
    rows = rows.withColumn("plain", plain).withColumn("bare", bare).withColumn("flips", flips).withColumn("outside", _depth(F.col("bare"))).withColumn("inside", _depth(F.col("plain")) - F.col("outside")).drop("plain", "bare")
    # the brace after a piece closes something where the piece ends outside a string
    return rows.select(
        "path", "size", "block", F.expr(f"at div {CHUNK}").alias("chunk"), "at", "text", F.col("flips").cast("long").alias("flips"),
        (F.col("outside") - F.when(F.col("flips") == 0, 1).otherwise(0)).cast("long").alias("outside"),
        (F.col("inside") - F.when(F.col("flips") == 1, 1).otherwise(0)).cast("long").alias("inside"),
    )


def _chained(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pieces with running effects in their chunk, and the state before each chunk."""
    run = Window.partitionBy(*_PLACE).orderBy("at")
    odd = F.col("odd") % 2 == 0
    rows = pieces.withColumn("bytes", (F.octet_length("text") + 1).cast("long")).withColumn("odd", F.sum("flips").over(run) - F.col("flips"))
    rows = rows.withColumn("if_out", F.sum(F.when(odd, F.col("outside")).otherwise(F.col("inside"))).over(run))
    rows = rows.withColumn("if_in", F.sum(F.when(odd, F.col("inside")).otherwise(F.col("outside"))).over(run))
    rows = _kept(rows.withColumn("reach", F.sum("bytes").over(run)))
    chunks = rows.groupBy(*_PLACE).agg(
        (F.sum("flips") % 2).alias("flips"), F.max_by("if_out", "at").alias("if_out"), F.max_by("if_in", "at").alias("if_in"), F.sum("bytes").alias("bytes")
    )
    before = Window.partitionBy("path").orderBy("block", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    sofar = lambda value: F.coalesce(F.sum(value).over(before), F.lit(0).cast("long"))
    starts = chunks.withColumn("quoted", sofar(F.col("flips")) % 2)
    starts = starts.withColumn("depth", sofar(F.when(F.col("quoted") == 0, F.col("if_out")).otherwise(F.col("if_in"))))
    return rows, starts.select(*_PLACE, "quoted", "depth", sofar(F.col("bytes")).alias("offset"), "bytes")


def _units(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """(path, text, first, ended): the units of each document; the last is not ended."""
    rows = rows.join(starts.drop("bytes"), _PLACE)
    depth = F.col("depth") + F.when(F.col("quoted") == 0, F.col("if_out")).otherwise(F.col("if_in"))
    outside = (F.col("quoted") + F.col("odd") + F.col("flips")) % 2 == 0
    closed = F.col("offset") + F.col("reach") <= F.col("size")  # all but the file's last piece have a brace after them
    ends = (closed & outside & (depth == 1)).cast("int")
    rows = rows.select(*_PLACE, "at", F.concat("text", F.when(closed, "}").otherwise("")).alias("text"), ends.alias("ends"))
    run = Window.partitionBy(*_PLACE).orderBy("at")
    rows = rows.withColumn("unit", F.sum("ends").over(run) - F.col("ends"))

    def joined(*order: str) -> Column:
        parts = F.array_sort(F.collect_list(F.struct(*order, "text")))
        return F.array_join(F.transform(parts, lambda x: x["text"]), "").alias("text")

    units = rows.groupBy(*_PLACE, "unit").agg(joined("at"), F.max("ends").alias("ended"))
    whole = (F.col("unit") > 0) & (F.col("ended") == 1)
    parts = units.filter(~whole)
    parts = parts.withColumn("nth", F.sum("ended").over(Window.partitionBy("path").orderBy("block", "chunk", "unit")) - F.col("ended"))
    across = parts.groupBy("path", "nth").agg(joined("block", "chunk", "unit"), F.max("ended").alias("ended"))
    flag = lambda first, ended: (first.alias("first"), ended.alias("ended"))
    return units.filter(whole).select("path", "text", *flag(F.lit(False), F.lit(True))).unionByName(across.select("path", "text", *flag(F.col("nth") == 0, F.col("ended") == 1)))


def _elements(units: DataFrame) -> DataFrame:
    """(path, ended, found): the elements of each unit, NULL where it is none."""
    text = F.ltrim("text", F.lit(_WHITE))
    tail = F.rtrim(text, F.lit(_WHITE))
    begins = F.substring(text, 1, 1) == F.when(F.col("first"), "[").otherwise(",")
    body = F.expr("substring(body, 2)")
    last = F.expr("substring(body, 2, length(body) - 2)")
    rows = units.withColumn("begins", begins).withColumn("body", F.when(F.col("ended"), text).otherwise(tail))
    closes = F.col("ended") | (F.col("body").endswith("]") & (F.length("body") > 1))
    # nothing may stand between the brackets of an empty array, or between the last object and the closing one
    nothing = ~F.col("ended") & F.when(F.col("first"), F.regexp_replace("body", r"[ \t\n\r]", "") == "[]").otherwise(F.col("body") == "]")
    rows = rows.select("path", "ended", nothing.alias("nothing"), F.when(F.col("begins") & closes, F.when(F.col("ended"), body).otherwise(last)).alias("inner"))
    mark = F.xxhash64("inner").cast("string")
    wrapped = F.concat(F.lit('{"document":['), F.col("inner"), F.lit('],"mark":["'), mark, F.lit('"]}'))
    parsed = rows.select("path", "ended", "nothing", mark.alias("mark"), F.from_json(wrapped, "map<string,array<string>>").alias("read"))
    good = (F.size("read") == 2) & (F.col("read")["mark"][0] == F.col("mark")) & (F.size(F.col("read")["document"]) > 0)
    empty = F.array().cast("array<string>")
    return parsed.select("path", "ended", F.when(F.col("nothing"), empty).when(good, F.col("read")["document"]).alias("found"))


def read_large_arrays(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw records of JSON-array files of any size → ``path, doc_is_array, doc_size, raw_json``.

    The rows of ``landing.read_json_documents(spark, path, "array")``: one an
    element, one with a NULL record for an empty array or a document that is
    not one array and nothing else.
    """
    paths = [path] if isinstance(path, str) else list(path)
    rows, starts = _chained(_pieces(spark, paths))
    elements = _kept(_elements(_units(rows, starts)))
    files = spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
    read = starts.groupBy("path").agg(F.sum("bytes").alias("bytes"))
    units = elements.groupBy("path").agg(F.count_if(F.col("found").isNull()).alias("bad"), F.count_if(~F.col("ended")).alias("last"), F.sum(F.size("found")).alias("records"))
    # a file that ends with a brace has no piece after it
    good = (F.col("bad") == 0) & (F.col("last") == 1) & (F.col("bytes") == F.col("size") + 1)
    docs = files.join(read, "path", "left").join(units, "path", "left").select("path", F.coalesce(good, F.lit(False)).alias("doc_is_array"), F.col("records").cast("int").alias("records"))
    docs = docs.select("path", "doc_is_array", F.when(F.col("doc_is_array"), F.col("records")).otherwise(-1).alias("doc_size"))
    none = docs.filter("doc_size <= 0").select("*", F.lit(None).cast("string").alias("raw_json"))
    some = docs.filter("doc_size > 0")
    if len(spark.read.text(paths).inputFiles()) <= FEW_FILES:
        some = F.broadcast(some)
    records = elements.select("path", F.explode("found").alias("element")).join(some, "path")
    return records.select("path", "doc_is_array", "doc_size", F.coalesce("element", F.lit("null")).alias("raw_json")).unionByName(none)
