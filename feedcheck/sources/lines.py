"""Lines of feed files, cut into pieces of bounded size that can be numbered.

A line source is two frames. ``rows`` has ``file_key, chunk, chunk_len, seq, line``:
a chunk is one input split (or one bucket of an order column) and ``seq`` grows with
the line order inside it. ``chunks`` has one row per chunk with its first ``seq`` and
its line count. Line numbers follow by adding up chunk counts, so a file of any size
is numbered without ever passing through one task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.delimited import open_quote
from ..functions.dialect import Dialect
from ..session import materialise, pin_splits

CHUNK = ["file_key", "chunk", "chunk_len"]


@dataclass(frozen=True)
class LineSource:
    rows: DataFrame
    chunks: DataFrame
    partitioned: bool = False  # rows already lie together by chunk
    physical: Callable[[], LineSource] | None = None  # the same files with every line, blank ones and comments too
    landed: DataFrame | None = None  # file_key of all files that were listed, read or empty

    def received(self) -> LineSource:
        """All lines as they were received."""
        return self.physical() if self.physical else self


def _is_record(d: Dialect | None):
    """Blank and comment lines are no records."""
    keep = F.col("line") != F.lit("")
    if d is not None and d.comment:
        keep = keep & ~F.col("line").startswith(d.comment)
    return keep


def _count_chunks(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*CHUNK).agg(F.min("seq").alias("base"), F.count(F.lit(1)).alias("n_lines"))


def number_splits(raw: DataFrame, d: Dialect | None = None) -> LineSource:
    """Line source of a frame ``file_key, chunk, chunk_len, line`` in scan order.

    The blank and comment filter stands before the row ids, in both passes alike.
    """
    rows = raw.filter(_is_record(d)).withColumn("seq", F.monotonically_increasing_id())
    return LineSource(rows, materialise(_count_chunks(rows), "chunks"), physical=lambda: _every_line(raw))


def _every_line(raw: DataFrame) -> LineSource:
    rows = raw.withColumn("seq", F.monotonically_increasing_id())
    return LineSource(rows, materialise(_count_chunks(rows), "chunks"))


def scan_lines(spark: SparkSession, paths, d: Dialect | None = None, multiline: bool = False) -> LineSource:
    """Lines of text files. Large plain files are read in splits; ``file_key`` is the path.

    With ``multiline`` a quoted value may hold line breaks (see ``stitch_lines``).
    """
    pin_splits(spark)
    reader = spark.read.option("recursiveFileLookup", "true")
    if multiline:
        reader = reader.option("lineSep", "\n")
    if d is not None and d.encoding.upper() != "UTF-8":
        reader = reader.option("encoding", d.encoding).option("lineSep", "\n")
    text = reader.text(paths)
    raw = text.select(
        F.col("_metadata.file_path").alias("file_key"),
        F.col("_metadata.file_block_start").alias("chunk"),
        F.col("_metadata.file_block_length").alias("chunk_len"),
        F.col("value").alias("line"),
    )
    source = stitch_lines(raw, d) if multiline else number_splits(raw, d)
    return replace(source, landed=materialise(_listed(text), "landed"))


def _listed(df: DataFrame) -> DataFrame:
    """``file_key`` of all files that a frame reads, empty ones too, from the list by which Spark plans the
    scan. Scans skip empty files, so their names cannot come from one."""
    spark = df.sparkSession
    listed = spark.createDataFrame([(name,) for name in df.inputFiles()], "path string")
    return listed.select(scanned_key(spark, F.col("path")).alias("file_key"))


def scanned_key(spark: SparkSession, path: Column) -> Column:
    """A path as scans report it: with its file system, the default one where none is named, one slash
    after a scheme without host, and blanks as ``%20``."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    default = spark._jvm.org.apache.hadoop.fs.FileSystem.get(conf).getUri().toString().rstrip("/")
    whole = F.when(path.rlike(r"\A[A-Za-z][A-Za-z0-9+.-]*:/"), path).otherwise(F.concat(F.lit(default), path))
    whole = F.regexp_replace(whole, r"\A([A-Za-z][A-Za-z0-9+.-]*:)/(?://+)?(?!/)", r"$1/")
    return F.replace(whole, F.lit(" "), F.lit("%20"))


def stitch_lines(raw: DataFrame, d: Dialect) -> LineSource:
    """Line source of logical records, where a quoted value may run over several lines.

    Seen from its start, a line either sets whether a quote is open at its end, flips it,
    or leaves it. Such steps combine in any grouping, so every split is worked out alone
    and only one step per split is carried along the file. Lines of a record that is
    spread over several lines are gathered by record; all others stay where they are. A
    quote that is never closed does not gather the rest of its file: its first line is
    malformed, and every later line stays a line of its own.
    """
    own = Window.partitionBy(*CHUNK).orderBy("pos")
    until = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = own.rowsBetween(Window.unboundedPreceding, -1)
    from_outside, from_inside = open_quote(F.col("line"), d)
    rows = raw.withColumn("pos", F.monotonically_increasing_id()).withColumns({"o": from_outside, "i": from_inside})
    rows = rows.withColumns({"sets": F.col("o") == F.col("i"), "flips": (F.col("o") & ~F.col("i")).cast("int")})
    rows = rows.withColumn("n_flips", F.sum("flips").over(until))
    mark = F.when(F.col("sets"), F.struct(F.col("o").cast("int").alias("v"), F.col("n_flips").alias("at")))
    rows = rows.withColumns({"mark": F.last(mark, ignorenulls=True).over(until), "last_mark": F.last(mark, ignorenulls=True).over(earlier)})
    rows = rows.withColumn("flips_before", F.col("n_flips") - F.col("flips"))

    # One step per split, then whether a quote is open where the split starts.
    end = F.max_by(F.struct("mark", "n_flips"), "pos")
    steps = rows.groupBy(*CHUNK).agg(end.alias("end")).select(*CHUNK, "end.*")
    steps = materialise(steps, "quote-steps")
    along = Window.partitionBy("file_key").orderBy("chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = steps.withColumn("flips_to", F.sum(F.when(F.col("mark").isNull(), F.col("n_flips")).otherwise(0)).over(along))
    value = F.pmod(F.col("mark.v") + F.col("n_flips") - F.col("mark.at"), F.lit(2))
    held = F.last(F.when(F.col("mark").isNotNull(), F.struct(value.alias("v"), F.col("flips_to").alias("at"))), ignorenulls=True).over(along)
    state = F.pmod(F.coalesce(held["v"], F.lit(0)) + F.col("flips_to") - F.coalesce(held["at"], F.lit(0)), F.lit(2))
    steps = steps.withColumn("open_after", state)
    whole = Window.partitionBy("file_key")
    starts = steps.select(
        *CHUNK,
        F.coalesce(F.lag("open_after").over(whole.orderBy("chunk")), F.lit(0)).alias("open_at_start"),
        F.max_by("open_after", "chunk").over(whole).alias("open_at_end"),
    )

    rows = rows.join(starts, CHUNK)
    state_in = F.when(F.col("last_mark").isNotNull(), F.pmod(F.col("last_mark.v") + F.col("flips_before") - F.col("last_mark.at"), F.lit(2)))
    state_in = F.coalesce(state_in, F.pmod(F.col("open_at_start") + F.col("flips_before"), F.lit(2)))
    rows = rows.withColumn("inside", state_in == 1)
    rows = rows.withColumn("opens", F.when(F.col("inside"), F.col("i")).otherwise(F.col("o")))
    # The record a line belongs to, named by the place of its first line.
    rows = rows.select("file_key", "chunk", "chunk_len", "pos", "line", "inside", "opens", "open_at_end")
    first = F.when(~F.col("inside"), F.struct("chunk", "chunk_len", "pos"))
    rows = rows.withColumn("own_first", F.last(first, ignorenulls=True).over(until))
    tails = rows.groupBy(*CHUNK).agg(F.max("own_first").alias("last_first"))
    tails = materialise(tails, "quote-tails")
    before = Window.partitionBy("file_key").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    tails = tails.select(*CHUNK, F.last("last_first", ignorenulls=True).over(before).alias("carried"), F.max("last_first").over(whole).alias("final"))
    rows = rows.join(tails, CHUNK).withColumn("first", F.coalesce("own_first", "carried"))
    unclosed = (F.col("open_at_end") == 1) & (F.col("first") == F.col("final"))
    single = unclosed | (~F.col("inside") & ~F.col("opens"))
    singles = rows.filter(single).select("file_key", F.struct("chunk", "chunk_len", "pos").alias("first"), "line")
    spread = rows.filter(~single).groupBy("file_key", "first").agg(F.collect_list(F.struct("chunk", "pos", "line")).alias("parts"))
    spread = spread.select("file_key", "first", F.array_join(F.transform(F.array_sort("parts"), lambda x: x["line"]), "\n").alias("line"))
    records = singles.unionByName(spread).withColumn("line", F.regexp_replace("line", "\\r\\z", ""))
    records = records.select("file_key", "first.*", "line").filter(_is_record(d))
    rank = Window.partitionBy(*CHUNK).orderBy("pos")
    out = records.withColumn("seq", F.row_number().over(rank).cast("bigint")).drop("pos")
    chunks = records.groupBy(*CHUNK).agg(F.lit(1).cast("bigint").alias("base"), F.count(F.lit(1)).alias("n_lines"))
    return LineSource(out, materialise(chunks, "chunks"), partitioned=True, physical=lambda: _every_line(raw))


def ordered_lines(
    df: DataFrame, file_key: str, order: str, line: str, width: int = 1_000_000, keep: list[str] = (), d: Dialect | None = None, blanks: bool = True
) -> LineSource:
    """Line source of a table that has a whole-number order column, unique per file.

    Buckets of ``width`` order values hold at most ``width`` lines each, whatever the
    file holds, so the window below sorts bounded groups. Their counts are written out,
    as several steps read them.
    """
    base = df.select(
        F.col(file_key).alias("file_key"),
        (F.col(order) - F.pmod(F.col(order), F.lit(width))).cast("bigint").alias("chunk"),
        F.lit(width).cast("bigint").alias("chunk_len"),
        F.col(order).cast("bigint").alias("__order"),
        F.col(line).alias("line"),
        *keep,
    )
    physical = None
    if blanks or (d is not None and d.comment):
        base = base.filter(_is_record(d))
        physical = lambda: ordered_lines(df, file_key, order, line, width, keep, blanks=False)
    chunks = base.groupBy(*CHUNK).agg(F.lit(1).cast("bigint").alias("base"), F.count(F.lit(1)).alias("n_lines"))
    w = Window.partitionBy(*CHUNK).orderBy("__order")
    rows = base.withColumn("seq", F.row_number().over(w).cast("bigint")).drop("__order")
    return LineSource(rows, materialise(chunks, "chunks"), partitioned=True, physical=physical)
