"""CSV snapshot source: header required, all values text, quoted newlines allowed, one file read by many tasks.

Files are read as lines, which Spark splits by byte ranges. Whether a newline ends a record depends on the quotes before
it in the whole file, so it takes two steps: each range counts its lines and lists those with an odd number of
quotes, where a quoted text begins or ends; sums over the ranges before then tell every line's number, and every second
odd line of a file closes what the one before it opened. The lines in between are put together to one record; a line
outside is a record by itself and never leaves its task. Records are parsed by ``from_csv``, columns taken by each file's own header.

``ingest_seq`` is the file's rank among the inputs (by path) in the high bits and the number of the record's first line in
the low bits, so it orders records as a reader of whole files would. Both come from the table of ranges, which is joined
and not made a literal.

Scale: shuffled are the lines of multi-line records and, for each range (``spark.sql.files.maxPartitionBytes``), one row.
A file that is compressed whole can't be split and is one range.

Quotes inside quoted texts are doubled, as the source writes them. An empty field reads as NULL, quoted or
not; lines of blanks only are skipped. A file whose quotes don't close is an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.operators.changes import FILE_SHIFT
from ledgerline.operators.joins import bounded_broadcast
from ledgerline.schemas import INGEST_SEQ
from ledgerline.session import checkpoint_dir

MANY_LAYOUTS = 100
LINES_BROADCAST = 2_000_000  # line numbers of multi-line records joined by broadcast; beyond, by shuffle
OPTIONS = {"quote": '"', "escape": '"'}


class SourceError(ValueError):
    pass


def _one_slash(path: Column) -> Column:
    """``file:///a`` and ``file:/a`` name one file; Spark uses both forms."""
    return F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``line, file, range, at``: every line, and its place: ``at`` counts up inside a range."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("value").alias("line"), _one_slash(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("range"), F.monotonically_increasing_id().alias("at"),
    )


def ranges(lines: DataFrame) -> DataFrame:
    """One row a byte range, written once: its file's ``rank``, its ``first_at`` and ``first`` line's number, its ``odd``
    lines (with an odd number of quotes, in order), how many of these the file has before, and its first line with text."""
    quotes = F.length("line") - F.length(F.translate("line", '"', ""))
    spoken = F.when(F.trim(F.translate("line", "\ufeff\r", "")) != "", F.struct("at", "line"))
    own = lines.groupBy("file", "range").agg(
        F.count(F.lit(1)).alias("n"), F.min("at").alias("first_at"), F.min(spoken).alias("head"),
        F.array_sort(F.collect_list(F.when(F.pmod(quotes, F.lit(2)) == 1, F.col("at")))).alias("odd"),  # of one range
    )
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    own = own.select(
        "*", F.coalesce(F.sum("n").over(before), zero).alias("first"),
        F.coalesce(F.sum(F.size("odd")).over(before), zero).alias("odd_before"),
    )
    files = own.groupBy("file").agg(F.count(F.lit(1)).alias("ranges"))
    files = files.select(F.col("file").alias("_f"), (F.row_number().over(Window.orderBy("file")) - 1).cast("long").alias("rank"))
    checkpoint_dir(lines.sparkSession)
    return own.join(files, F.col("file") == F.col("_f")).drop("_f", "n").checkpoint(eager=True)


def headers(found: DataFrame) -> DataFrame:
    """``rank, names, header``: the names in each file's first line with text, and that line's number."""
    spoken = found.filter(F.col("head").isNotNull()).select(
        "file", "rank", F.col("head.line").alias("line"), (F.col("first") + F.col("head.at") - F.col("first_at")).alias("header")
    )
    first = spoken.groupBy("file", "rank").agg(F.min_by("line", "header").alias("line"), F.min("header").alias("header"))
    line = F.regexp_replace(F.regexp_replace("line", "^\ufeff", ""), "\r$", "")
    # names are cut at commas outside quotes, then lose theirs
    names = F.split(line, ',(?=(?:[^"]*"[^"]*")*[^"]*$)')
    return first.select("file", "rank", "header", F.transform(names, lambda x: F.regexp_replace(x, '^"|"$', "")).alias("names"))


def _spans(found: DataFrame) -> DataFrame:
    """``rank, begin, number``: the lines of each record of several lines. Odd lines open and close quoted texts in turn."""
    odd = found.select("file", "rank", "first", "first_at", "odd_before", F.posexplode("odd").alias("i", "at"))
    turn = F.col("i") + F.col("odd_before")
    odd = odd.select("file", "rank", F.floor(turn / 2).alias("nth"), (F.col("first") + F.col("at") - F.col("first_at")).alias("number"))
    spans = odd.groupBy("file", "rank", "nth").agg(
        F.min("number").alias("begin"), F.max("number").alias("end"), F.count(F.lit(1)).alias("n")
    )
    unclosed = F.raise_error(F.concat(F.lit("a quoted text has no end in "), "file")).cast("long")
    end = F.when(F.col("n") == 2, F.col("end")).otherwise(unclosed)
    return spans.select(F.col("rank").alias("_rank"), "begin", F.explode(F.sequence("begin", end)).alias("_number"))


def records(lines: DataFrame, found: DataFrame, n_ranges: int) -> DataFrame:
    """``record, rank, number``: the text of every record and the number of its first line."""
    side = found.select(F.col("file").alias("_file"), F.col("range").alias("_range"), "rank", "first", "first_at")
    side = bounded_broadcast(side, known_rows=n_ranges)
    on = (F.col("file") == F.col("_file")) & (F.col("range") == F.col("_range"))
    lost = F.raise_error(F.concat(F.lit("the input was cut otherwise when read again: "), "file")).cast("long")
    number = F.coalesce(F.col("first") + F.col("at") - F.col("first_at"), lost)
    placed = lines.join(side, on, "left").select("line", "rank", number.alias("number"))
    spans = _spans(found)
    n_lines = spans.count()
    if not n_lines:
        return placed.select(F.col("line").alias("record"), "rank", "number")
    inside = bounded_broadcast(spans, LINES_BROADCAST, n_lines)
    on = (F.col("rank") == F.col("_rank")) & (F.col("number") == F.col("_number"))
    single = placed.join(inside, on, "left_anti").select(F.col("line").alias("record"), "rank", "number")
    several = placed.join(inside, on).groupBy("rank", "begin").agg(
        F.array_sort(F.collect_list(F.struct("number", "line"))).alias("own")  # the lines of one record
    )
    text = F.array_join(F.transform("own", lambda x: x["line"]), "\n")
    return single.unionByName(several.select(text.alias("record"), "rank", F.col("begin").alias("number")))


def _checked_names(found: DataFrame, path, columns: Sequence[str] | None) -> list[str]:
    """The columns to read, once every file's header is known to have them."""
    layouts = [r["names"] for r in found.select("names").distinct().take(MANY_LAYOUTS)]
    if not layouts:
        raise SourceError(f"CSV source has no header: {path}")
    wanted = list(columns) if columns is not None else layouts[0]
    for names in layouts:
        missing, extra = [c for c in wanted if c not in names], [c for c in names if c not in wanted]
        if missing:
            raise SourceError(f"CSV source {path} lacks columns {missing}; header is {names}")
        if extra:
            raise SourceError(f"CSV source {path} has unknown columns {extra}")
    if len(layouts) == MANY_LAYOUTS:
        raise SourceError(f"CSV source {path} has {MANY_LAYOUTS} and more different headers")
    return wanted


def read_source(spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Read a snapshot (file, folder or list of CSV files) as text columns plus ``ingest_seq``."""
    lines = _lines(spark, path)
    found = ranges(lines)
    heads = headers(found)
    wanted = _checked_names(heads, path, columns)
    n_ranges = found.count()  # as many as files, or more
    heads = bounded_broadcast(heads.select(F.col("rank").alias("_rank"), "names", "header"), known_rows=n_ranges)
    rows = records(lines, found, n_ranges).join(heads, F.col("rank") == F.col("_rank"))
    # a line's end may be "\r\n"; lines of blanks only are no records
    text = F.when(F.endswith("record", F.lit("\r")), F.substring("record", F.lit(1), F.length("record") - 1)).otherwise(F.col("record"))
    rows = rows.select("names", "rank", "number", "header", text.alias("record"))
    fields = ", ".join(f"_{i} STRING" for i in range(len(wanted)))
    parsed = F.from_csv("record", fields, OPTIONS)
    values = F.array(*[parsed[f"_{i}"] for i in range(len(wanted))]).alias("values")
    rows = rows.select(values, "names", "rank", "number", ((F.col("number") > F.col("header")) & (F.trim("record") != "")).alias("is_row"))
    seq = F.shiftleft("rank", FILE_SHIFT).bitwiseOR(F.col("number")).alias(INGEST_SEQ)
    by_name = [F.get("values", F.array_position("names", F.lit(c)).cast("int") - 1).alias(c) for c in wanted]
    # by a generator, so that no later filter on a column (a date that must be readable) is tried on a header line first
    none = F.array().cast(rows.select(F.array(F.struct(*by_name, seq)).alias("x")).schema["x"].dataType)
    return rows.select(F.inline(F.when(F.col("is_row"), F.array(F.struct(*by_name, seq))).otherwise(none)))
