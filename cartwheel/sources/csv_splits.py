"""CSV files with quoted line breaks, read by many tasks a file.

A reader that starts in the middle of a file can't know whether a line break stands inside quotes, so ``multiLine`` reads give each
file to one task. Here files are read as lines (split at any byte offset), and where records begin is worked out afterwards:

1. the quotes of a line say in which state (inside quotes or not) it ends, for either state it may begin in: always outside, always
   inside, as begun, or the opposite. States are folded over the pieces between quotes, without Python;
2. inside a run (65,536 lines of a split at most) the last line that forgets its beginning and the parity of the swaps since give the
   state of every line as a function of the run's own beginning; one row a run, in file order, then fixes the beginnings;
3. a line that begins and ends outside is a record. Only lines of longer records are grouped, by the line their record began at, in
   their run first.

A quote opens a field only at its start; a doubled quote inside is text. A file whose quote never closes has one record from there to its
end, as in every reader, and that record is one row. Fields of a record are parsed by ``from_csv`` with the options of ``read_csv_table``;
a carriage return before a line feed stays in quoted text (Spark's whole-file reader drops it where records end in both).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Position of a record: its file, the byte offset of the split it begins in, its place there (ascending).
FILE_ORDER = ("_file", "_block", "_line")

RUN_BITS = 16  # lines of a split are worked on in runs of 2 ** RUN_BITS at most
TASK_BYTES = 16 << 20  # text of a task once lines are dealt to runs
_POSITIONS = (1 << 33) - 1  # place in the task, of a monotonically increasing id

_OUTSIDE, _INSIDE, _CLOSED, _START = 0, 1, 2, 3


def _end_state(line: Column, begin: int) -> Column:
    """1 if ``line`` ends inside quotes when it begins in state ``begin``. The line is cut at its quotes; each cut moves the state."""
    pieces = F.split(line, '"')
    before = F.slice(pieces, F.lit(1), F.size(pieces) - 1)  # the text in front of each quote

    def step(state: Column, text: Column) -> Column:
        opens = text.endswith(",") | ((text == "") & state.isin(_CLOSED, _START))
        return F.when(state == _INSIDE, _CLOSED).when(opens, _INSIDE).otherwise(_OUTSIDE)

    return (F.aggregate(before, F.lit(begin), step) == _INSIDE).cast("int")


def _files(spark: SparkSession, path: str) -> DataFrame:
    """``_file, _f, _bytes``: a row for each file below ``path``, out of the listing; no content is read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return listed.select(F.col("_metadata.file_path").alias("_file"), F.xxhash64("_metadata.file_path").alias("_f"), F.col("length").alias("_bytes"))


def file_lines(spark: SparkSession, path: str) -> DataFrame:
    """``_file, _block, _line, value``: the lines of all files below ``path`` (UTF-8, cut at line feeds). ``_line`` ascends in a split."""
    raw = spark.read.options(lineSep="\n", recursiveFileLookup="true").text(path)
    return raw.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                      F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITIONS)).alias("_line"), "value")


def file_records(spark: SparkSession, path: str) -> DataFrame:
    """``_file, _block, _line, record, is_first``: one row a record, line breaks inside quotes kept; ``is_first`` marks the first record of
    each file that is not empty. Empty lines outside quotes are records of no text."""
    files = _files(spark, path)
    size = files.agg(F.sum("_bytes")).first()[0] or 0
    # sorts and window buffers hold a run or a task's share, not a split, and lines carry a hash of the path, not the path
    run_of = ["_f", "_block", "_part"]
    lines = file_lines(spark, path).withColumn("_f", F.xxhash64("_file")).withColumn("_part", F.shiftright("_line", RUN_BITS)).drop("_file")
    quoted = F.instr("value", '"') > 0
    lines = lines.withColumn("_t0", F.when(quoted, _end_state(F.col("value"), _START)).otherwise(0)) \
        .withColumn("_t1", F.when(quoted, _end_state(F.col("value"), _INSIDE)).otherwise(1)) \
        .repartition(size // TASK_BYTES + 1, *run_of)
    w = Window.partitionBy(*run_of).orderBy("_line")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = lines.withColumn("_swaps", F.sum((F.col("_t0") > F.col("_t1")).cast("int")).over(run))
    fixed = F.when(F.col("_t0") == F.col("_t1"), F.struct(F.col("_t0").alias("state"), F.col("_swaps").alias("swaps")))
    lines = lines.withColumn("_fixed", F.last(fixed, ignorenulls=True).over(run))
    # the state after the line: ``_known`` says whether it is ``_after`` itself or the run's beginning moved by ``_after``
    lines = (lines.withColumn("_known", F.col("_fixed").isNotNull())
             .withColumn("_after", F.when(F.col("_known"), (F.col("_fixed.state") + F.col("_swaps") - F.col("_fixed.swaps")) % 2)
                         .otherwise(F.col("_swaps") % 2))
             .withColumn("_known_before", F.lag("_known", 1, False).over(w)).withColumn("_before", F.lag("_after", 1, 0).over(w)))

    # one row a run: how it ends, where its last record begins for either beginning, its first line with text
    opens = lambda s: F.max(F.when(_state("_known_before", "_before", F.lit(s)) == 0, F.col("_line")))
    runs = lines.groupBy(*run_of).agg(
        F.max_by(F.struct("_known", "_after"), "_line").alias("_end"), opens(0).alias("_open0"), opens(1).alias("_open1"),
        F.min(F.when(F.trim(F.col("value")) != "", F.col("_line"))).alias("_text"))
    by_file = Window.partitionBy("_f").orderBy("_block", "_part")
    run = by_file.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = runs.withColumn("_odd", F.when(~F.col("_end._known"), F.col("_end._after")).otherwise(0)) \
        .withColumn("_swaps", F.sum("_odd").over(run))
    known = F.when(F.col("_end._known"), F.struct(F.col("_end._after").alias("state"), F.col("_swaps").alias("swaps")))
    runs = runs.withColumn("_fixed", F.last(known, ignorenulls=True).over(run))
    ends = (F.coalesce(F.col("_fixed.state"), F.lit(0)) + F.col("_swaps") - F.coalesce(F.col("_fixed.swaps"), F.lit(0))) % 2
    runs = runs.withColumn("_ends", ends).withColumn("_in", F.lag("_ends", 1, 0).over(by_file))
    opened = F.when(F.col("_in") == 0, F.col("_open0")).otherwise(F.col("_open1"))
    runs = runs.withColumn("_opened", F.when(opened.isNotNull(), F.struct(F.col("_block").alias("block"), opened.alias("line"))))
    runs = runs.withColumn("_carried", F.last("_opened", ignorenulls=True).over(
        by_file.rowsBetween(Window.unboundedPreceding, -1)))
    head = F.min(F.when(F.col("_text").isNotNull(), F.struct("_block", F.col("_text")))).over(Window.partitionBy("_f"))
    runs = runs.withColumn("_head", head).select(*run_of, "_in", "_carried", "_head")

    lines = lines.join(runs, run_of) \
        .withColumn("_begin", _state("_known_before", "_before", F.col("_in"))) \
        .withColumn("_finish", _state("_known", "_after", F.col("_in")))
    here = F.last(F.when(F.col("_begin") == 0, F.col("_line")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    is_first = F.coalesce((F.col("_block") == F.col("_head._block")) & (F.col("_line") == F.col("_head._text")), F.lit(False))
    lines = lines.withColumn("_here", here).withColumn("is_first", is_first)
    single = (F.col("_begin") == 0) & (F.col("_finish") == 0)
    one = lines.where(single).select("_f", "_block", "_line", F.col("value").alias("record"), "is_first")
    # a run's lines of a record are put together where they are; only records that go on in another run are shuffled
    texts = lambda c: F.array_join(F.transform(F.sort_array(c), lambda x: x["value"]), "\n")
    parts = lines.where(~single).groupBy(*run_of, "_here").agg(
        texts(F.collect_list(F.struct("_line", "value"))).alias("value"), F.max_by("_finish", "_line").alias("_finish"),
        F.first("_carried").alias("_carried"), F.max("is_first").alias("is_first"))
    whole = F.col("_here").isNotNull() & (F.col("_finish") == 0)
    inside = parts.where(whole).select("_f", "_block", F.col("_here").alias("_line"), F.col("value").alias("record"), "is_first")
    begun = F.when(F.col("_here").isNotNull(), F.struct(F.col("_block").alias("block"), F.col("_here").alias("line"))).otherwise(F.col("_carried"))
    long = parts.where(~whole).withColumn("_rec", begun).groupBy("_f", F.col("_rec.block").alias("_b"), F.col("_rec.line").alias("_l")).agg(
        texts(F.collect_list(F.struct("_block", "_part", "value"))).alias("record"), F.max("is_first").alias("is_first")) \
        .select("_f", F.col("_b").alias("_block"), F.col("_l").alias("_line"), "record", "is_first")
    out = one.unionByName(inside).unionByName(long).join(F.broadcast(files.select("_f", "_file")), "_f")  # a row a file, as the driver lists them
    return out.select("_file", "_block", "_line", F.regexp_replace("record", "\r$", "").alias("record"), "is_first")


def _state(known: str, value: str, begin: Column) -> Column:
    return F.when(F.col(known), F.col(value)).otherwise((F.col(value) + begin) % 2)


def parse_records(records: DataFrame, header: list[str], names: list[str], options: dict[str, str], on_ragged: str,
                  positions: bool = False) -> DataFrame:
    """The fields of ``file_records`` as text columns ``names``, without the header record of each file, which must read ``header``.

    ``on_ragged``: a record with another number of fields fails the read (``fail``) or is kept with its text in ``_corrupt_record``
    (``keep``). ``positions`` adds FILE_ORDER. Empty records are left out."""
    if on_ragged not in ("fail", "keep"):
        raise ValueError(f"unknown on_ragged {on_ragged!r}")
    fields = [T.StructField(f"c{i}", T.StringType()) for i in range(len(names))] + [T.StructField("_bad", T.StringType())]
    opts = {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    for k in ("header", "recursiveFileLookup"):
        opts.pop(k, None)
    schema = ", ".join(f"{f.name} STRING" for f in fields)
    rows = records.where(F.col("record") != "").withColumn("_f", F.from_csv("record", schema, opts))
    same = F.col("_f._bad").isNull()
    for i, name in enumerate(header):
        same = same & (F.coalesce(F.col(f"_f.c{i}"), F.lit("")) == F.lit(name))
    checks = [(F.col("is_first") & ~same, "the files have different headers")]
    if on_ragged == "fail":
        checks.append((F.col("_f._bad").isNotNull(), "a record's number of fields differs from the header"))
    # Tests are filters, so they hold whatever columns are read. The row id keeps them where they stand: a filter on given values only
    # would be moved below the join that tells whole records from pieces (and would parse each record once more).
    here = F.monotonically_increasing_id() >= 0
    for wrong, message in checks:
        rows = rows.where(F.when(here & wrong, F.raise_error(F.concat_ws(": ", F.col("_file"), F.lit(message))).cast("boolean"))
                          .otherwise(F.lit(True)))
    cols = [F.col(f"_f.c{i}").alias(n) for i, n in enumerate(names)]
    if on_ragged == "keep":
        cols.append(F.col("_f._bad").alias("_corrupt_record"))
    if positions:
        cols += [F.col(c) for c in FILE_ORDER]
    return rows.where(~F.col("is_first")).select(*cols)
