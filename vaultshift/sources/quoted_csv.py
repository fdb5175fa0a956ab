"""Records of CSV files whose quoted cells hold line breaks, read by many tasks a file.

Files are read as lines, so that any number of tasks share one file. Whether a line begins inside a quoted
cell depends on all lines before it, but only through one bit, and what a line does to that bit is a
function of two cases: the bit after it if it was off before, and if it was on. Functions of consecutive
lines compose, so:

1. ``split_table``: every split composes its lines into one row (two bits, and the number of records that
   begin in it in either case). A running window over those rows, one a split, gives the bit at each start.
2. ``whole_records``: with that bit every split joins its lines to records, which leave where they are.
3. ``cut_records``: records cut by split borders are put together from their pieces: the lines before the first
   record that begins in a split and those of the last one if it stays open. Only splits with an open
   border take part.

No row is shuffled but the split table and the pieces. A cell is quoted only where the quote is its first
character, as in RFC 4180 readers; a quote inside a bare cell is a character like any other. Line ends inside
a cell are read as ``\\n``. Blank lines between records are no records.

``header_records`` reads the first record of every file in tasks that stop after their first lines, and groups
them: the driver sees distinct headers only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FILE, START, POS, RECORD = "_split_file", "_split_start", "_split_pos", "_record"
#: Most splits of one scan: those with an open border, at worst all of them, are broadcast (about 100 bytes each).
MAX_SPLITS = 2_000_000
MAX_HEADERS = 1000
BOM = "\ufeff"

_BARE = r"(?:\"[^\"]*+(?:\"\"[^\"]*+)*+\"[^,]*+|[^\",][^,]*+)?+"  # a cell that is closed on its line
_OPENS = re.compile(rf"(?:{_BARE},)*+\"[^\"]*+(?:\"\"[^\"]*+)*+\Z")
_CLOSES = re.compile(r"[^\"]*+(?:\"\"[^\"]*+)*+\"[^,]*+")


def opens(line: str) -> bool:
    """Whether a line that begins outside a quoted cell ends inside one."""
    return _OPENS.match(line) is not None


def stays_open(line: str) -> bool:
    """Whether a line that begins inside a quoted cell ends inside one."""
    closing = _CLOSES.match(line)
    return closing is None or (closing.end() < len(line) and opens(line[closing.end() + 1 :]))


def lines_of(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """(file, start of the split, line)."""
    raw = spark.read.text(path)
    value = F.col("value") if encoding.upper() == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    return raw.select(F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(START), value.alias("line"))


class _Lines:
    """The lines of one split inside an Arrow batch and what they do to the quote bit."""

    def __init__(self, line: pa.Array, at_file_start: bool):
        if at_file_start and len(line) and line[0].as_py().startswith(BOM):
            line = pa.concat_arrays([pa.array([line[0].as_py().removeprefix(BOM)], pa.string()), line[1:]])
        self.line, n = line, len(line)
        self.filled = pc.binary_length(line).to_numpy(zero_copy_only=False) > 0
        quoted = np.flatnonzero(pc.count_substring(line, '"').to_numpy(zero_copy_only=False))
        self.quoted = quoted
        texts = line.take(pa.array(quoted)).to_pylist()
        self.off = [opens(t) for t in texts]
        self.on = [stays_open(t) for t in texts]
        self.n = n

    def walk(self, bit: bool) -> tuple[np.ndarray, np.ndarray, bool]:
        """The bit before and after each line, and after the last."""
        before, last, first = np.empty(self.n, bool), 0, bit
        for k, off, on in zip(self.quoted.tolist(), self.off, self.on, strict=True):
            before[last : k + 1] = first
            first, last = (on if first else off), k + 1
        before[last:] = first
        return before, np.append(before[1:], first), first


def _segments(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """(file, start, lo, hi) of the runs of rows of one split."""
    if not batch.num_rows:
        return
    files, starts = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
    code = files.indices.to_numpy()
    edge = np.flatnonzero((code[1:] != code[:-1]) | (starts[1:] != starts[:-1])) + 1
    for lo, hi in zip([0, *edge], [*edge, batch.num_rows], strict=True):
        yield files.dictionary[int(code[lo])].as_py(), int(starts[lo]), int(lo), int(hi)


def split_table(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """One row a split: file, start, open_in and open_out (the quote bit at its ends), n (records that begin
    in it, the header included) and header (of the file)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def row(h):
            return pa.RecordBatch.from_pylist([h], schema=out)

        out = pa.schema([(FILE, pa.string()), (START, pa.int64()), ("off", pa.bool_()), ("on", pa.bool_()), ("n_off", pa.int64()),
                         ("n_on", pa.int64()), ("header", pa.string()), ("more", pa.bool_())])
        for b in batches:
            for file, start, lo, hi in _segments(b):
                fresh = held is None or (held[FILE], held[START]) != (file, start)
                if fresh:
                    if held is not None:
                        yield row(held)
                    held = {FILE: file, START: start, "off": False, "on": True, "n_off": 0, "n_on": 0, "header": None, "more": start == 0}
                part = _Lines(b.column(2).slice(lo, hi - lo), fresh and start == 0)
                for name, count in (("off", "n_off"), ("on", "n_on")):
                    before, after, last = part.walk(held[name])
                    held[count] += int((~before & part.filled).sum())
                    if name == "off" and held["more"]:
                        _header(held, part.line, before, after, part.filled)
                    held[name] = last
        if held is not None:
            yield row(held)

    rows = lines_of(spark, path, encoding).mapInArrow(
        run, f"{FILE} string, {START} long, off boolean, on boolean, n_off long, n_on long, header string, more boolean")
    by_file = Window.partitionBy(FILE).orderBy(START)
    earlier = by_file.rowsBetween(Window.unboundedPreceding, -1)
    flips = F.col("off") & ~F.col("on")
    # the bit before a split: what the last split that sets it left, turned over by every flip since then
    rows = rows.withColumn("_flips", F.sum(flips.cast("long")).over(by_file))
    setter = F.last(F.when(F.col("off") == F.col("on"), F.struct("off", "_flips")), ignorenulls=True).over(earlier)
    rows = rows.withColumns({"_set": setter, "_before": F.coalesce(F.lag("_flips").over(by_file), F.lit(0))})
    turned = F.coalesce(F.col("_set.off").cast("long"), F.lit(0)) + F.col("_before") - F.coalesce("_set._flips", F.lit(0))
    rows = rows.withColumn("open_in", turned % 2 == 1)
    header = F.first("header", ignorenulls=True).over(Window.partitionBy(FILE).orderBy(START).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return rows.select(FILE, START, "open_in", F.when(F.col("open_in"), F.col("on")).otherwise(F.col("off")).alias("open_out"),
                       F.when(F.col("open_in"), F.col("n_on")).otherwise(F.col("n_off")).alias("n"), header.alias("header"))


def _header(held: dict, line: pa.Array, before: np.ndarray, after: np.ndarray, filled: np.ndarray) -> None:
    """Adds lines to the file's first record until it is closed."""
    for k in range(len(line)):
        if held["header"] is None and not filled[k]:
            continue
        text = line[k].as_py()
        held["header"] = text if held["header"] is None else held["header"] + "\n" + text
        if not after[k]:
            held["more"] = False
            return


def header_records(spark: SparkSession, path: str, encoding: str = "UTF-8") -> tuple[list[tuple[str, int]], int]:
    """The distinct first records of the files, most frequent first, with their numbers of files; and the
    number of splits. Every split is a task of its own here and ends with its first batch of lines, unless
    the header goes on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = None, 0
        for b in batches:
            for file, start, lo, hi in _segments(b):
                if held is None or held[FILE] != file or held["start"] != start:
                    if held is not None:
                        yield done(held)
                    held = {FILE: file, "start": start, "header": None, "more": start == 0, "bit": False}
                    seen += 1
                for x in range(lo, hi, 64):
                    if not held["more"]:
                        break
                    part = _Lines(b.column(2).slice(x, min(64, hi - x)), held["header"] is None)
                    before, after, held["bit"] = part.walk(held["bit"])
                    _header(held, part.line, before, after, part.filled)
            if held is not None and not held["more"]:
                break
        if held is not None:
            yield done(held)

    def done(h):
        return pa.RecordBatch.from_arrays([pa.array([h["header"]], pa.string()), pa.array([h["start"] == 0]), pa.array([h["more"] and h["header"] is not None])],
                                          names=["header", "first", "cut"])

    conf, key = spark.conf, "spark.sql.files.openCostInBytes"
    cost = conf.get(key)
    conf.set(key, conf.get("spark.sql.files.maxPartitionBytes"))  # no two files in one task
    try:
        found = lines_of(spark, path, encoding).mapInArrow(run, "header string, first boolean, cut boolean")
        found = found.groupBy("header", "first").agg(F.count("*").alias("n"), F.max("cut").alias("cut"))
        rows = found.orderBy(F.desc("n"), "header").limit(MAX_HEADERS + 2).collect()
    finally:
        conf.set(key, cost)
    headers = [(r.header, r.n) for r in rows if r.first and r.header is not None]
    if any(r.cut for r in rows):
        raise ValueError(f"{path}: a file's header does not end within its first split")
    if len(headers) > MAX_HEADERS:
        raise ValueError(f"{path}: more than {MAX_HEADERS} different headers")
    return headers, sum(r.n for r in rows)


def _assembled(batches: Iterator[pa.RecordBatch], pieces: bool) -> Iterator[pa.RecordBatch]:
    """Joins the lines of each split to records: whole ones (file, start, pos, record), or the pieces at its
    borders (file, start, pos, part: 0 of a record from before, 1 of one that goes on; record, closed)."""
    held = None

    def batch(rows):
        cols = list(zip(*rows, strict=True))
        names = [FILE, START, POS, "part", RECORD, "closed"] if pieces else [FILE, START, POS, RECORD]
        types = [pa.string(), pa.int64(), pa.int64(), *([pa.int32()] if pieces else []), pa.string(), *([pa.bool_()] if pieces else [])]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    def close(h):
        """What a split leaves open at its end."""
        if pieces and h["bit"]:
            part = 0 if h["head"] else 1
            yield batch([(h["file"], h["start"], h["pos"] if part else -1, part, "\n".join(h["lines"]), False)])

    for b in batches:
        for file, start, lo, hi in _segments(b):
            if held is None or (held["file"], held["start"]) != (file, start):
                if held is not None:
                    yield from close(held)
                open_in = b.column(3)[lo].as_py()
                held = {"file": file, "start": start, "bit": open_in, "head": open_in, "lines": [], "pos": 0, "new": True}
            part = _Lines(b.column(2).slice(lo, hi - lo), held["new"] and start == 0)
            held["new"] = False
            before, _, last = part.walk(held["bit"])
            begins = ~before & part.filled
            used = np.flatnonzero(before | begins)
            number = np.cumsum(begins)[used]  # 0: the record that was open
            carried = part.line.take(pa.array(used[number == 0])).to_pylist()
            held["lines"] += carried
            n = int(begins.sum())
            if (n or not last) and held["bit"]:  # the open record ends here
                if held["head"]:
                    if pieces:
                        yield batch([(file, start, -1, 0, "\n".join(held["lines"]), True)])
                else:
                    if not pieces:
                        yield batch([(file, start, held["pos"], "\n".join(held["lines"]))])
                    held["pos"] += 1
                held["head"], held["lines"] = False, []
            if n:
                own = used[number > 0]
                size = np.bincount(number[number > 0], minlength=n + 1)[1:]
                whole = n - int(last)
                edge = np.concatenate([[0], np.cumsum(size)])
                if whole and not pieces:
                    texts = part.line.take(pa.array(own[: edge[whole]]))
                    if edge[whole] > whole:
                        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(edge[: whole + 1], pa.int32()), texts), "\n")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([file] * whole, pa.string()), pa.array(np.full(whole, start)), pa.array(held["pos"] + np.arange(whole)), texts],
                        names=[FILE, START, POS, RECORD])
                held["pos"] += whole
                if last:
                    held["lines"] = part.line.take(pa.array(own[edge[whole] :])).to_pylist()
            held["bit"] = last
    if held is not None:
        yield from close(held)


def records(spark: SparkSession, path: str, encoding: str = "UTF-8", n_splits: int = 0) -> tuple[DataFrame, DataFrame]:
    """All records but the headers, (file, start, pos, record) each, and the split table. A record belongs to
    the split it begins in and is the pos-th record there (from 0; a file's header is one)."""
    if n_splits > MAX_SPLITS:
        raise ValueError(f"{path}: {n_splits} splits in one scan; raise spark.sql.files.maxPartitionBytes or scan in parts")
    splits = split_table(spark, path, encoding)
    # the lines of a split must stay together and in order, so the table comes to them
    border = splits.where("open_in or open_out").select(FILE, START, "open_in", F.lit(True).alias("_border"))
    bits = lines_of(spark, path, encoding).join(F.broadcast(border), [FILE, START], "left")
    bits = bits.select(FILE, START, "line", F.coalesce("open_in", F.lit(False)).alias("open_in"), "_border")
    whole = bits.select(FILE, START, "line", "open_in").mapInArrow(
        lambda it: _assembled(it, False), f"{FILE} string, {START} long, {POS} long, {RECORD} string")
    cut = bits.where("_border").select(FILE, START, "line", "open_in").mapInArrow(
        lambda it: _assembled(it, True), f"{FILE} string, {START} long, {POS} long, part int, {RECORD} string, closed boolean")
    number = F.sum("part").over(Window.partitionBy(FILE).orderBy(START, "part"))
    begin = F.max(F.when(F.col("part") == 1, F.struct(START, POS)))
    pieces = F.array_sort(F.collect_list(F.struct(START, "part", RECORD)))
    joined = cut.withColumn("_no", number).groupBy(FILE, "_no").agg(begin.alias("b"), pieces.alias("p"), F.max("closed").alias("closed"))
    text = F.concat_ws("\n", F.transform("p", lambda x: x[RECORD]))
    text = F.when(F.col("closed"), text).otherwise(F.raise_error(F.concat(F.lit("CSV: a quote stays open in: "), F.substring(text, 1, 1000))).cast("string"))
    joined = joined.select(FILE, F.col(f"b.{START}").alias(START), F.col(f"b.{POS}").alias(POS), text.alias(RECORD))
    every = whole.unionByName(joined)
    return every.where((F.col(START) > 0) | (F.col(POS) > 0)), splits


def record_numbers(splits: DataFrame) -> DataFrame:
    """(file, start, _off): a record's 1-based number over all files, in order of their names, is ``_off`` plus its
    place in the split. One row a split."""
    own = F.col("n") - F.when((F.col(START) == 0) & (F.col("n") > 0), 1).otherwise(0)  # without the header
    before = Window.orderBy(FILE, START).rowsBetween(Window.unboundedPreceding, -1)
    off = F.coalesce(F.sum(own).over(before), F.lit(0)) + F.when(F.col(START) == 0, 0).otherwise(1)
    return splits.select(FILE, START, off.alias("_off"))


def count_records(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """One row, ``n``: the records of all files without their headers, counted without parsing a cell."""
    splits = split_table(spark, path, encoding)
    headers = F.count_if((F.col(START) == 0) & (F.col("n") > 0))
    return splits.agg((F.coalesce(F.sum("n"), F.lit(0)) - headers).cast("long").alias("n"))
