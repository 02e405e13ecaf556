"""Delimited files of unknown encoding, separator and header spelling.

The scan is splittable: files are read as text blocks, so one huge file is
spread over as many tasks as it has blocks. It has two steps.

1. A census of every (file, block): rows, first row id, whether the bytes are valid
   UTF-8, whether a quoted field may cross a line end. It is pre-aggregated in
   each task and written as a small table with one row per block. The first line
   of each file is read apart, by tasks that open the file and read no further.
2. The parse, which joins that table for encoding, separator, column positions
   and the number of the block's first line. Record numbers come from the
   position inside the block plus that offset, so no row is shuffled for them.

Only files in which a quoted field really crosses a line end go through
``_stitched_records``, which resolves the open/closed quote state of every line
with windows bounded by one block, and across blocks with one row per block. What
it finds does not depend on where blocks begin. Fields may have any length; only a
record of more than ``LONGEST_RECORD`` characters, as a stray quote makes of the
rest of a huge file, makes its file unreadable.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..errors import StructureError
from ..fixed_values import HEADER_SYNONYMS, SEPARATORS, VISIT_COLUMNS
from ..functions.once import filter_computed
from ..functions.text import WHITESPACE, canonical_header, strip
from .heads import can_open, first_lines, listed
from .scratch import write_through

#: Characters of the longest record over several lines; one record is held by one task.
LONGEST_RECORD = 1 << 26
_ASCII_BLANKS = " \t\n\r\x0b\x0c"
_LINE_BREAKS = "[\r\n\x0b\x0c\x1c-\x1e\x85  ]"
# fixed values: bytes 0x80-0x9F in Windows-1252; the five unassigned ones are absent
_HIGH_BYTES = [b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
_LATIN1_HIGH = "".join(chr(b) for b in _HIGH_BYTES)
_CP1252_HIGH = bytes(_HIGH_BYTES).decode("cp1252")
_UNASSIGNED = "[\u0081\u008d\u008f\u0090\u009d]"

UTF8, WINDOWS = "utf-8", "cp1252"
_FILE_COLUMNS = ("path", "encoding", "separator", "header", "error")


@dataclass(frozen=True)
class DelimitedScan:
    """``files``: path, encoding, separator, header, error (null when readable).
    ``records``: path, record_number (header = 1), one string column per
    canonical column (null when the record is too short)."""

    files: DataFrame
    records: DataFrame

    def require_readable(self, shown: int = 20) -> "DelimitedScan":
        broken = self.files.where("error is not null")
        first = broken.orderBy("path").limit(shown).collect()
        if first:
            more = broken.count() - len(first) if len(first) == shown else 0
            named = "; ".join(f"{r.path}: {r.error}" for r in first)
            raise StructureError(named + (f"; and {more} more files" if more else ""))
        return self


# --------------------------------------------------------------- expressions
def windows_text(raw: Column) -> Column:
    """Windows-1252 bytes to text: Latin-1 plus the 27 characters that differ."""
    return F.translate(F.decode(raw, "ISO-8859-1"), _LATIN1_HIGH, _CP1252_HIGH)


def choose_separator(line: Column) -> Column:
    """Most frequent candidate; the earlier candidate wins a tie; null when none occurs."""
    counts = [F.length(line) - F.length(F.replace(line, F.lit(s), F.lit(""))) for s in SEPARATORS]
    most = F.greatest(*counts)
    choice = F.when(most == 0, F.lit(None).cast("string"))
    for separator, count in zip(SEPARATORS, counts):
        choice = choice.when(count == most, F.lit(separator))
    return choice


def _occurrences(text: Column, part: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, part, F.lit("")))) / F.length(part)


def _between_ends(text: Column) -> Column:
    return F.substring(text, F.lit(2), F.length(text) - 2)


def _plainly_quoted(record: Column, separator: Column) -> Column:
    """Is every field quoted, without quotes inside? Decided by counting marks.

    Between the first and the last quote all others must stand around a separator.
    """
    inner = _between_ends(record)
    joint = F.concat(F.lit('"'), separator, F.lit('"'))
    framed = record.startswith('"') & record.endswith('"') & (F.length(record) > 1)
    return framed & (_occurrences(inner, F.lit('"')) == _occurrences(inner, joint) * 2)


def _ends_inside_quotes(line: Column, separator: Column, starts_inside: bool = False) -> Column:
    """Does a quoted field stay open at the end of this line?

    Doubled quotes never change the state, so they are removed first. Complete
    fields are then consumed from the left; only an open quoted field remains.
    Lines of one field and plainly quoted lines are decided without that.
    """
    single = F.replace(line, F.lit('""'), F.lit(""))
    text = F.concat(F.lit('"'), single) if starts_inside else single
    field = F.concat(
        F.lit("(?s)["), separator, F.lit(']+(?:"[^"]*"[^'), separator, F.lit(']*|[^"'), separator,
        F.lit("][^"), separator, F.lit("]*)?(?=["), separator, F.lit("]|$)"),
    )
    rest = F.regexp_replace(F.concat(separator, text), field, F.lit(""))
    one_field = F.when(text.startswith('"'), F.locate('"', text, 2) == 0).otherwise(False)
    decided = F.when(~line.contains(separator), one_field)
    if not starts_inside:
        decided = decided.when(_plainly_quoted(F.rtrim(line, F.lit("\r")), separator), False)
    return decided.otherwise(rest != "")


def split_fields(record: Column, separator: Column) -> Column:
    """Field values of one record; quotes are only interpreted where one occurs."""
    quoted = F.lit('"[^"]*+(?:""[^"]*+)*+"?')
    field = F.concat(
        F.lit("(?s)["), separator, F.lit("]((?:"), quoted, F.lit(")?+[^"), separator, F.lit("]*+)")
    )
    pieces = F.regexp_extract_all(F.concat(separator, record), field, F.lit(1))

    def unquote(piece: Column) -> Column:
        shape = r'(?s)^"([^"]*+(?:""[^"]*+)*+)"?(.*)$'
        inner, tail = F.regexp_extract(piece, shape, 1), F.regexp_extract(piece, shape, 2)
        clean = piece.endswith('"') & (_occurrences(piece, F.lit('"')) == 2)
        return (
            F.when(~piece.startswith('"'), piece)
            .when(clean, _between_ends(piece))
            .otherwise(F.concat(F.replace(inner, F.lit('""'), F.lit('"')), tail))
        )

    joint = F.concat(F.lit('"['), separator, F.lit(']"'))
    return (
        F.when(~record.contains('"'), F.split(record, F.concat(F.lit("\\"), separator), -1))
        .when(_plainly_quoted(record, separator), F.split(_between_ends(record), joint, -1))
        .otherwise(F.transform(pieces, unquote))
    )


def pick(values: Column, positions: Column) -> Column:
    """Value at the last of the given positions that the record still reaches."""
    reached = F.filter(positions, lambda p: p < F.size(values))
    return F.coalesce(
        F.get(values, F.element_at(positions, -1)),
        F.when(F.size(positions) > 1, F.get(values, F.try_element_at(reached, F.lit(-1)))),
    )


# ---------------------------------------------------------------------- scan
def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Physical lines with raw bytes preserved and their place in the file."""
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("raw"),
    )


def _census(lines: DataFrame) -> DataFrame:
    """One row per (file, block), all columns of fixed width but the path."""
    raw, valid = F.col("raw"), F.is_valid_utf8("raw")
    # text functions need valid text; Latin-1 keeps all marks of other encodings in place
    text = F.when(valid, raw).otherwise(F.decode(raw.cast("binary"), "ISO-8859-1"))
    not_ascii = ~valid | (F.octet_length(raw) != F.length(raw))
    quoted = raw.contains('"')
    flags = [
        valid.alias("utf8"),
        F.when(not_ascii, F.decode(raw.cast("binary"), "ISO-8859-1").rlike(_UNASSIGNED))
        .otherwise(False).alias("unassigned"),
        (F.btrim(text, F.lit(_ASCII_BLANKS)) != "").alias("filled"),
        (raw.contains("\r") & ~quoted & F.rtrim(text, F.lit("\r")).contains("\r")).alias("loose_return"),
        # one expression for all separators, only run on lines with quotes: generated
        # code for four would be too long to be compiled
        F.when(
            quoted,
            F.transform(F.array(*(F.lit(s) for s in SEPARATORS)), lambda s: _ends_inside_quotes(text, s)),
        ).alias("open"),
    ]
    names = ["unassigned", "filled", "loose_return"]
    return (
        lines.select("path", "block", "seq", *flags)
        .groupBy("path", "block")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("seq").alias("first_seq"),
            F.bool_and("utf8").alias("utf8"),
            *(F.bool_or(n).alias(n) for n in names),
            *(
                F.bool_or(F.coalesce(F.get("open", F.lit(i)), F.lit(False))).alias(f"open_{i}")
                for i in range(len(SEPARATORS))
            ),
        )
    )


def _heads(lines: DataFrame, census: DataFrame) -> DataFrame:
    """First line of every file, by the row id the census found, where Python cannot open the files.

    A second reading is cheaper than keeping text in the census: with fixed-width
    buffers only, the census is hash-aggregated in generated code.
    """
    first = census.where("block = 0").select("path", F.col("first_seq").alias("seq"))
    found = lines.where("block = 0").join(first, ["path", "seq"])
    return found.select("path", F.col("raw").cast("binary").alias("head"))


def _file_table(census: DataFrame, heads: DataFrame, listing: DataFrame) -> DataFrame:
    """One row per listed file: encoding, separator, first line, first error found."""
    found = census.groupBy("path").agg(
        F.bool_and("utf8").alias("utf8"),
        *(F.bool_or(n).alias(n) for n in census.columns if n in ("unassigned", "filled", "loose_return")),
        *(F.bool_or(f"open_{i}").alias(f"open_{i}") for i in range(len(SEPARATORS))),
    ).join(heads, "path")
    as_utf8 = F.regexp_replace(F.col("head").cast("string"), "^﻿", "")
    head = F.rtrim(F.when(F.col("utf8"), as_utf8).otherwise(windows_text(F.col("head"))), F.lit("\r"))
    known = (
        listing.join(found, "path", "left")
        .withColumn("encoding", F.when(F.col("utf8"), UTF8).otherwise(WINDOWS))
        .withColumn("head", F.when(F.col("utf8").isNotNull(), head))
        .withColumn("separator", choose_separator(F.split(F.col("head"), _LINE_BREAKS, 2)[0]))
    )
    crosses = F.lit(False)
    for i, s in enumerate(SEPARATORS):
        crosses = F.when(F.col("separator") == s, F.col(f"open_{i}")).otherwise(crosses)
    error = (
        F.when(~F.coalesce("filled", F.lit(False)), "the file is empty")
        .when(~F.col("utf8") & F.col("unassigned"), "the bytes are neither UTF-8 nor Windows-1252")
        .when(F.col("separator").isNull(), "no separator found in the first line")
        .when(F.col("loose_return"), "carriage return inside an unquoted field")
    )
    error = error.alias("error")
    crosses = (crosses & error.isNull()).alias("crosses")
    return known.select("path", "encoding", "separator", "head", crosses, error)


def _decoded(raw: Column) -> Column:
    text = F.when(F.col("encoding") == UTF8, raw).otherwise(windows_text(raw.cast("binary")))
    first = (F.col("block") == 0) & (F.col("seq") == F.col("first_seq"))
    return F.when(first, F.regexp_replace(text, "^﻿", "")).otherwise(text)


def _state_after(window, opens: Column, stays: Column) -> list[Column]:
    """Quote state after each line, relative to the state before the window.

    A line either fixes the state or flips it (or does neither). The state after
    a line is the last fixed value flipped by the flips since, or the incoming
    state flipped by all of them: ``fixed`` (null when none) and ``flips``.
    """
    flips = F.sum(F.when(opens & ~stays, 1).otherwise(0)).over(window)
    last = F.last(F.when(opens == stays, F.struct(opens.alias("v"), F.col("flips").alias("at"))), True)
    return [flips, last.over(window)]


def _resolve(fixed: Column, flips: Column, incoming: Column) -> Column:
    odd_since = F.pmod(flips - fixed["at"], F.lit(2)) == 1
    odd_all = F.pmod(flips, F.lit(2)) == 1
    return F.when(fixed.isNotNull(), fixed["v"] != odd_since).otherwise(incoming != odd_all)


def _stitched_records(lines: DataFrame, longest: int) -> tuple[DataFrame, DataFrame]:
    """Records of files whose quoted fields cross line ends: (records, errors).

    ``lines`` carries path, block, seq, line_number, separator, text. Windows run
    over one block, whose size Spark bounds; across blocks only one row each.
    """
    in_block = Window.partitionBy("path", "block").orderBy("seq")
    running = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    quoted = F.col("text").contains('"')
    flagged = lines.withColumns(
        {
            "opens": F.when(quoted, _ends_inside_quotes(F.col("text"), F.col("separator"))).otherwise(False),
            "stays": F.when(quoted, _ends_inside_quotes(F.col("text"), F.col("separator"), True)).otherwise(True),
        }
    )
    flips, fixed = _state_after(running, F.col("opens"), F.col("stays"))
    flagged = write_through(
        flagged.withColumn("flips", flips).withColumn("fixed", fixed).withColumn("last_seq", F.col("seq")),
        "quote-states",
    )

    across = Window.partitionBy("path").orderBy("block")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    ends = flagged.groupBy("path", "block").agg(
        F.max_by("flips", "seq").alias("block_flips"), F.max_by("fixed", "seq").alias("block_fixed")
    )
    # the state a block hands on: its own fixed value, or its flips of what came in
    ends = ends.withColumn(
        "hands_on",
        F.when(
            F.col("block_fixed").isNotNull(), _resolve(F.col("block_fixed"), F.col("block_flips"), F.lit(False))
        ),
    )
    ends = ends.withColumn(
        "free_flips", F.sum(F.when(F.col("hands_on").isNull(), F.col("block_flips")).otherwise(0)).over(
            across.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
    ).withColumn(
        "anchor",
        F.last(
            F.when(F.col("hands_on").isNotNull(), F.struct(F.col("hands_on").alias("v"), F.col("free_flips").alias("at"))),
            True,
        ).over(before),
    ).withColumn("flips_before", F.coalesce(F.lag("free_flips").over(across), F.lit(0)))
    ends = ends.select(
        "path", "block", _resolve(F.col("anchor"), F.col("flips_before"), F.lit(False)).alias("block_inside")
    )

    state = _resolve(F.col("fixed"), F.col("flips"), F.col("block_inside"))
    lines = (
        flagged.join(ends, ["path", "block"])
        .withColumn("ends_inside", state)
        .withColumn("inside", F.coalesce(F.lag("ends_inside").over(in_block), F.col("block_inside")))
        .withColumn("started", F.sum(F.when(~F.col("inside"), 1).otherwise(0)).over(running))
        .select("path", "block", "line_number", "text", "inside", "ends_inside", "started")
    )
    lines = write_through(lines, "quoted-lines")
    offsets = lines.groupBy("path", "block").agg(F.max("started").alias("n")).select(
        "path", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("records_before")
    )
    lines = lines.join(offsets, ["path", "block"]).withColumn(
        "record_number", F.col("records_before") + F.col("started")
    )

    # lengths are added up per record before any record is gathered, whatever the blocks
    over_lines = lines.where(F.col("inside") | F.col("ends_inside"))
    too_long = write_through(
        over_lines.groupBy("path", "record_number")
        .agg((F.sum(F.length("text") + 1) - 1).alias("chars"))
        .where(F.col("chars") > longest)
        .groupBy("path")
        .agg(F.min("record_number").alias("first"))
        .select("path", F.format_string(f"record %d is longer than {longest} characters", "first").alias("late_error")),
        "too-long",
    )
    whole = lines.where(~F.col("inside") & ~F.col("ends_inside")).join(too_long, "path", "left_anti")
    joined = (
        over_lines.join(too_long, "path", "left_anti")
        .groupBy("path", "record_number")
        .agg(F.array_sort(F.collect_list(F.struct("line_number", "text"))).alias("parts"))
        .select("path", "record_number", F.array_join(F.col("parts.text"), "\n").alias("text"))
    )
    return whole.select("path", "record_number", "text").unionByName(joined), too_long


def _with_header(files: DataFrame, columns: tuple[str, ...], synonyms: dict[str, str]) -> DataFrame:
    """Canonical header names and, when a required column is absent, the error."""
    header = F.transform(
        split_fields(F.col("head"), F.col("separator")), lambda h: canonical_header(h, synonyms)
    )
    missing = F.array_except(F.array(*(F.lit(c) for c in columns)), F.col("header"))
    message = F.concat(
        F.lit("missing required columns "), F.array_join(missing, ", "), F.lit("; header: "), F.col("head")
    )
    return files.withColumn("header", F.when(F.col("error").isNull(), header)).withColumn(
        "error", F.coalesce("error", F.when(F.size(missing) > 0, message))
    )


def _positions(columns: tuple[str, ...]) -> list[Column]:
    """Where each canonical column sits in the header; a repeated one has several places."""

    def places_of(column: str) -> Column:
        index = F.sequence(F.lit(0), F.size("header") - 1)
        return F.filter(index, lambda i: F.get(F.col("header"), i) == column)

    return [places_of(c).alias(f"at_{c}") for c in columns]


def _fields(records: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Records (path, record_number, text, separator, at_*) to named columns."""
    text, separator = F.rtrim("text", F.lit("\r")), F.col("separator")
    values = split_fields(text, separator)
    # only marks and blanks left: blank, unless a quoted mark is a value of its own
    bare = F.btrim(F.replace(text, separator, F.lit("")), F.lit(WHITESPACE + '"')) == ""
    blank = bare & (~text.contains('"') | (strip(F.array_join(values, "")) == ""))
    return (
        filter_computed(records, (F.col("record_number") > 1) & ~blank)
        .withColumn("values", values)
        .select("path", "record_number", *(pick(F.col("values"), F.col(f"at_{c}")).alias(c) for c in columns))
    )


def scan_delimited(
    spark: SparkSession,
    paths: str | list[str],
    columns: tuple[str, ...] = VISIT_COLUMNS,
    synonyms: dict[str, str] | None = None,
    longest_record: int = LONGEST_RECORD,
) -> DelimitedScan:
    """Scan files into canonical string columns, numbering records per file.

    Both passes must cut files alike, which ``build_session`` sees to; where they do
    not, reading the records fails and says so.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    synonyms = HEADER_SYNONYMS if synonyms is None else synonyms
    lines = _lines(spark, paths)
    # empty files have no rows, so they are only visible in the listing
    listing = write_through(listed(spark, paths), "listing")
    census = write_through(_census(lines), "census")
    found = first_lines(listing) if can_open(listing) else _heads(lines, census)
    known = _file_table(census, found, listing)
    files = _with_header(write_through(known, "files"), columns, synonyms)
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # a crossing header is only known after stitching, so its own error is ignored here
    usable = F.coalesce("crosses", F.lit(False)) | F.col("error").isNull()
    layout = files.select("path", "encoding", "separator", "crosses", usable.alias("usable"), *_positions(columns))
    blocks = write_through(
        census.select(
            "path", "block", "rows", "first_seq",
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        ).join(layout, "path"),
        "blocks",
    )
    # every line must find its block; one that does not means that the files, or the way
    # they are cut, changed since the census, and must not be dropped silently
    index = F.col("seq") - F.col("first_seq")
    numbered = (
        lines.join(blocks, ["path", "block"], "left")
        .where(F.coalesce("usable", F.lit(True)))
        .withColumns(
            {
                "line_number": F.when((index >= 0) & (index < F.col("rows")), F.col("rows_before") + index + 1)
                .otherwise(F.raise_error(F.lit("files or read settings changed between the passes"))),
                "text": _decoded(F.col("raw")),
                "crosses": F.coalesce("crosses", F.lit(False)),
            }
        )
    )
    records = _fields(
        numbered.where(~F.col("crosses")).withColumnRenamed("line_number", "record_number"), columns
    )
    if blocks.where("crosses").isEmpty():
        return DelimitedScan(files.select(*_FILE_COLUMNS), records)

    stitched, late = _stitched_records(
        numbered.where("crosses").select("path", "block", "seq", "line_number", "separator", "text"), longest_record
    )
    stitched = write_through(stitched, "stitched")
    heads = stitched.where("record_number = 1").select("path", F.rtrim("text", F.lit("\r")).alias("head"))
    crossing = (
        files.where("crosses").drop("head", "header", "error")
        .join(heads, "path", "left").join(late, "path", "left")
        .withColumnRenamed("late_error", "error")
    )
    crossing = _with_header(crossing, columns, synonyms)
    files = files.where("not crosses").select(*_FILE_COLUMNS).unionByName(crossing.select(*_FILE_COLUMNS))
    layout = crossing.where("error is null").select("path", "separator", *_positions(columns))
    records = records.unionByName(_fields(stitched.join(layout, "path"), columns))
    return DelimitedScan(files, records)
