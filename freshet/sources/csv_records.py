"""CSV files as numbered records, read in parallel even where fields hold newlines.

A file is read as lines and the lines are written once to a scratch table along
with the input block they came from. All numbering is done on that table, so it
does not depend on how a later scan happens to be split or on which executors
are alive. Blocks are cut further into chunks of at most a million lines. Chunk
totals, one narrow row each, carry counts from one chunk to the next; the lines
of a file never meet in one task, even if its format cannot be split.
"""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.session import path_exists, scratch_dir

# Broadcast chunk totals up to this many rows (about 100 MB); join by shuffle beyond.
BROADCAST_CHUNKS = 500_000
CHUNK_BITS = 20
LINES_BYTES = 8 << 20  # of a row group of lines

FILE, ORDINAL = "__file", "__ordinal"
CHUNK = [FILE, "block", "part"]


class MissingInputs(FileNotFoundError):
    """Names every absent input at once."""

    def __init__(self, paths: list[str]):
        self.paths = paths
        super().__init__("missing inputs: " + ", ".join(paths))


def require_inputs(spark: SparkSession, paths: list[str]) -> None:
    """Check all paths before any work starts."""
    if missing := [path for path in paths if not path_exists(spark, path)]:
        raise MissingInputs(missing)


def leaves_quote_open(line: Column) -> Column:
    """Whether a line that starts outside quotes ends inside a quoted field.

    Doubled quotes cancel out; a quote only opens a field at the field's start.
    """
    single = F.replace(line, F.lit('""'), F.lit(""))
    unclosed = F.regexp_replace(single, '(^|,)"[^"]*"', "$1").rlike('(^|,)"')
    return F.contains(line, F.lit('"')) & unclosed


def text_after_quote(record: Column) -> Column:
    """Whether a quoted field goes on after its closing quote, as in ``"x"y``.

    Goes from quote to quote. A quote opens a field if only a comma or nothing stands
    before it; inside, it closes the field unless another quote follows at once.
    """
    between = F.split(record, '"', -1)
    start = F.struct(F.lit(0).alias("state"), F.lit(False).alias("bad"))
    outside, inside, closed = F.lit(0), F.lit(1), F.lit(2)

    def step(seen: Column, k: Column) -> Column:
        before = F.get(between, k)
        state = seen["state"]
        doubled = (state == closed) & (before == "")
        opens = F.endswith(before, F.lit(",")) | ((k == 0) & (before == ""))
        stray = (state == closed) & (before != "") & ~F.startswith(before, F.lit(","))
        after = F.when(state == inside, closed).when(doubled | opens, inside).otherwise(outside)
        return F.struct(after.alias("state"), (seen["bad"] | stray).alias("bad"))

    quotes = F.sequence(F.lit(0), F.size(between) - 2)
    end = F.aggregate(quotes, start, step)
    rest = F.get(between, F.size(between) - 1)
    open_end = (end["state"] == closed) & (rest != "") & ~F.startswith(rest, F.lit(","))
    return end["bad"] | open_end


def _without_return(column: str) -> Column:
    shorter = F.expr(f"left({column}, length({column}) - 1)")
    return F.when(F.endswith(column, F.lit("\r")), shorter).otherwise(F.col(column))


def _stage_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines in a scratch table; ``n`` counts the lines of a block without gaps.

    A lone carriage return ends a line too; ``sep`` is the sign that did. A return before
    a newline stays at the line's end. A line without quotes is kept as its ``fields``, which
    have no such return, any other as its text only; ``value`` is either's text.
    """
    plain = ~F.contains("value", F.lit('"'))
    blank = F.col("value").isin("", "\r")
    returns = F.instr("value", "\r").between(1, F.length("value") - 1)
    pieces = F.when(returns, F.split("value", r"\r(?!\z)")).otherwise(F.array("value"))
    lines = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias(FILE),
            F.col("_metadata.file_block_start").alias("block"),
            F.size(pieces).alias("pieces"),
            F.posexplode(pieces).alias("piece", "value"),
        )
        .select(
            F.when(~plain, F.col("value")).alias("value"),
            F.when(plain, F.split(_without_return("value"), ",", -1)).alias("fields"),
            F.when(plain, F.endswith("value", F.lit("\r"))).alias("returns"),
            F.when(F.col("piece") < F.col("pieces") - 1, F.lit("\r")).otherwise(F.lit("\n")).alias("sep"),
            FILE,
            "block",
            F.monotonically_increasing_id().alias("n"),
            leaves_quote_open(F.col("value")).alias("opens"),
            blank.alias("blank"),
        )
    )
    staged = scratch_dir(spark, "csv-lines")
    # In small row groups, so that a reader may take small splits.
    lines.write.option("compression", "zstd").option("parquet.block.size", LINES_BYTES).parquet(staged)
    table = spark.read.schema(lines.schema).parquet(staged)
    text = F.concat(F.array_join("fields", ","), F.when(F.col("returns"), "\r").otherwise(""))
    return table.withColumns(
        {"part": F.shiftright("n", CHUNK_BITS), "value": F.coalesce("value", text)}
    )


def _join_chunks(lines: DataFrame, chunks: DataFrame, count: int) -> DataFrame:
    return lines.join(F.broadcast(chunks) if count <= BROADCAST_CHUNKS else chunks, CHUNK)


def _totals(lines: DataFrame) -> DataFrame:
    return lines.groupBy(*CHUNK).agg(
        F.count("*").alias("rows"),
        F.min("n").alias("first"),
        F.count_if("opens").alias("opens"),
        F.count_if("blank").alias("blanks"),
        F.count_if(F.col("fields").isNull()).alias("quoted"),
    )


def _one_line_records(
    lines: DataFrame, totals: DataFrame, chunk_count: int, blanks: bool
) -> DataFrame:
    """Every line is a record, but for blank ones.

    Only the lines of chunks that have blank ones are counted anew, in a window of their
    chunk; all others keep the number they were written with.
    """
    before = Window.partitionBy(FILE).orderBy("block", "part")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    filled = F.col("rows") - F.col("blanks")
    chunks = totals.select(
        *CHUNK, "first", "blanks", F.coalesce(F.sum(filled).over(before), F.lit(0)).alias("prefix")
    )
    placed = _join_chunks(lines, chunks, chunk_count)
    nth = F.col("n") - F.col("first")

    def records(rows: DataFrame, nth: Column) -> DataFrame:
        return rows.select(
            _without_return("value").alias("record"),
            "fields",
            FILE,
            (F.col("prefix") + nth - 1).alias(ORDINAL),
        )

    if not blanks:
        return records(placed, nth)
    rank = F.row_number().over(Window.partitionBy(*CHUNK).orderBy("n"))
    mixed = placed.where("blanks > 0 and not blank").withColumn("rank", rank - 1)
    return records(placed.where("blanks = 0"), nth).unionByName(records(mixed, F.col("rank")))


def _spanning_records(lines: DataFrame, chunk_count: int) -> DataFrame:
    """Records that may run over several lines and chunks.

    Each line maps the quote state before it (0 outside, 1 inside) to the state
    after it. Within a chunk the maps are chained by windows for both possible
    states at the chunk's start; chunk totals then settle which one holds.
    """
    after_0 = F.col("opens").cast("int")
    after_1 = leaves_quote_open(F.concat(F.lit('"'), "value")).cast("int")
    in_chunk = Window.partitionBy(*CHUNK).orderBy("n")
    so_far = in_chunk.rowsBetween(Window.unboundedPreceding, 0)

    def none(column: str) -> Column:
        return F.coalesce(column, F.lit(0))

    chained = (
        # Chunk keys are never NULL; saying so lets both uses below share one shuffle.
        lines.where(" and ".join(f"{key} is not null" for key in CHUNK))
        .select(*CHUNK, "n", "value", "sep", "blank", after_0.alias("a0"), after_1.alias("a1"))
        # A line either fixes the state (a0 = a1), keeps it or flips it.
        .withColumn("fixes", F.col("a0") == F.col("a1"))
        .withColumn("flips", F.sum(F.when(~F.col("fixes"), F.col("a0")).otherwise(0)).over(so_far))
        .withColumn("fix", F.when(F.col("fixes"), F.struct(F.col("a0").alias("state"), "flips")))
        .withColumn("fixed", F.last("fix", ignorenulls=True).over(so_far))
        .withColumn("known", F.col("fixed").isNotNull())
        .withColumn("shift", (F.col("flips") - none("fixed.flips") + none("fixed.state")) % 2)
        .withColumn("was_known", F.lag("known", 1, False).over(in_chunk))
        .withColumn("was_shift", F.lag("shift", 1, 0).over(in_chunk))
    )

    def outside(known: str, shift: str, start: Column) -> Column:
        state = F.when(F.col(known), F.col(shift)).otherwise((F.col(shift) + start) % 2)
        return state == 0

    def begun(start: int) -> Column:
        begins = outside("was_known", "was_shift", F.lit(start)) & ~F.col("blank")
        return F.sum(begins.cast("int")).over(so_far)

    counted = chained.withColumn("begun_0", begun(0)).withColumn("begun_1", begun(1))

    by_chunk = Window.partitionBy(FILE).orderBy("block", "part")
    until = by_chunk.rowsBetween(Window.unboundedPreceding, 0)
    before = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    enters = F.col("enters")
    never = F.raise_error(F.concat(F.lit("a quote is never closed in "), FILE)).cast("bigint")
    whole_file = by_chunk.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    chunks = (
        counted.groupBy(*CHUNK)
        .agg(
            F.max_by(F.struct("known", "shift", "begun_0", "begun_1"), "n").alias("end"),
        )
        .select(*CHUNK, "end.*")
        .withColumn("flips", F.sum(F.when(F.col("known"), 0).otherwise(F.col("shift"))).over(until))
        .withColumn("fix", F.when(F.col("known"), F.struct("shift", "flips")))
        .withColumn("fixed", F.last("fix", ignorenulls=True).over(until))
        .withColumn("leaves", (F.col("flips") - none("fixed.flips") + none("fixed.shift")) % 2)
        .withColumn("enters", F.lag("leaves", 1, 0).over(by_chunk))
        .withColumn("rows", F.when(enters == 1, F.col("begun_1")).otherwise(F.col("begun_0")))
        .withColumn("prefix", F.coalesce(F.sum("rows").over(before), F.lit(0)))
        # A file that ends inside quotes is refused here, before its lines are gathered.
        .withColumn("ends", F.last("leaves").over(whole_file))
        .select(
            *CHUNK,
            "enters",
            F.when(F.col("ends") == 1, never).otherwise(F.col("prefix")).alias("prefix"),
        )
    )

    begun_here = F.when(enters == 1, F.col("begun_1")).otherwise(F.col("begun_0"))
    numbered = _join_chunks(counted, chunks, chunk_count).select(
        FILE,
        "block",
        "n",
        "value",
        "sep",
        "blank",
        (F.col("prefix") + begun_here - 2).alias(ORDINAL),
        outside("was_known", "was_shift", enters).alias("begins"),
        outside("known", "shift", enters).alias("closes"),
    )
    def ended(part: Column) -> Column:
        return F.concat(part["value"], part["sep"])

    whole = numbered.where("begins and closes and not blank").select("value", FILE, ORDINAL)
    parts = (
        numbered.where("not (begins and closes)")
        .groupBy(FILE, ORDINAL)
        .agg(F.array_sort(F.collect_list(F.struct("block", "n", "value", "sep"))).alias("parts"))
        .select(F.array_join(F.transform("parts", ended), "").alias("value"), FILE, ORDINAL)
        .withColumn("value", F.expr("left(value, length(value) - 1)"))
    )
    return whole.unionByName(parts).select(
        _without_return("value").alias("record"), FILE, ORDINAL
    )


def _header(lines: DataFrame) -> list[str]:
    """Field names; every file must have the same ones. Reads first blocks only."""
    # Numbers alone are aggregated: all lines of a packed file are in its first block.
    first = lines.where("block = 0 and not blank").groupBy(FILE).agg(F.min("n").alias("n"))
    firsts = lines.join(F.broadcast(first), [FILE, "n"]).select("value", "opens").distinct().take(2)
    if len(firsts) > 1:
        raise ValueError("files differ in their headers")
    if firsts and firsts[0].opens:
        raise ValueError("a header may not run over several lines")
    names = next(csv.reader([f.value.rstrip("\r") for f in firsts]), [])
    spellings: dict[str, set[str]] = {}
    for name in names:
        spellings.setdefault(name.lower(), set()).add(name)
    if alike := [sorted(s) for s in spellings.values() if len(s) > 1]:
        raise ValueError(f"header names differ in case only: {alike}")
    return names


def _split_records(records: DataFrame, names: list[str]) -> DataFrame:
    schema = ", ".join([*(f"c{i} string" for i in range(len(names))), "corrupt string"])
    options = {
        "escape": '"',
        "nullValue": "\u0000",
        "multiLine": "true",
        "columnNameOfCorruptRecord": "corrupt",
    }
    quoted = F.contains("record", F.lit('"'))
    refused = F.raise_error(
        F.concat(F.lit("text after a closing quote in "), FILE, F.lit(", row "), ORDINAL)
    ).cast("string")
    record = F.when(text_after_quote(F.col("record")), refused).otherwise(F.col("record"))
    split = records.where(f"{ORDINAL} >= 0").select(
        FILE,
        ORDINAL,
        F.when(quoted, F.from_csv(record, F.lit(schema), options)).alias("row"),
        F.when(~quoted, F.split("record", ",", -1)).alias("fields"),
    )
    # Rows of another width than the header come back as corrupt; count their fields.
    bare = F.regexp_replace(
        F.replace("row.corrupt", F.lit('""'), F.lit("")), '(^|,)"[^"]*"', "$1"
    )
    width = F.when(F.col("row.corrupt").isNull(), len(names)).otherwise(
        1 + F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit("")))
    )
    columns = {
        name: F.when(F.col("row").isNull(), F.get("fields", F.lit(i)))
        .when(F.col("width") > i, F.coalesce(f"row.c{i}", F.lit("")))
        .alias(name)
        for i, name in enumerate(names)
        if name
    }
    return split.select("*", F.when(F.col("row").isNotNull(), width).alias("width")).select(
        *columns.values(), FILE, ORDINAL
    )


def _plain_rows(records: DataFrame, names: list[str]) -> DataFrame:
    """Rows of a file without quotes, whose lines were split when they were staged."""
    columns = {name: F.get("fields", F.lit(i)).alias(name) for i, name in enumerate(names) if name}
    return records.where(f"{ORDINAL} >= 0").select(*columns.values(), FILE, ORDINAL)


def read_csv(
    spark: SparkSession, path: str, quoted_newlines: bool = True, read_again: bool = False
) -> DataFrame:
    """All rows of a CSV file or folder as text columns named by the header.

    ``__file`` and ``__ordinal`` number the rows of each file from 0 in file
    order; blank lines do not count. Empty fields are empty strings, fields
    missing at a row's end are NULL, fields beyond the header are left out, and
    a repeated header name takes its last column. ``quoted_newlines=False``
    declares that every line is a record. Refused are files that end inside quotes,
    rows with text after a closing quote, and header names that differ in case only.
    ``read_again`` declares that rows are read more than once: they are split once even so.
    """
    lines = _stage_lines(spark, path)
    totals = _totals(lines)
    sums = (F.sum(name).alias(name) for name in ("opens", "blanks", "quoted"))
    scan = totals.agg(F.count("*").alias("chunks"), *sums).first()
    if quoted_newlines and scan.opens:
        records = _spanning_records(lines, scan.chunks)
    else:
        records = _one_line_records(lines, totals, scan.chunks, bool(scan.blanks))
    if not scan.quoted:
        return _plain_rows(records, _header(lines))
    rows = _split_records(records, _header(lines))
    if not read_again:
        return rows
    staged = scratch_dir(spark, "csv-rows")
    rows.write.option("compression", "zstd").parquet(staged)
    return spark.read.schema(rows.schema).parquet(staged)
