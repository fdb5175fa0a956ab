"""CSV scans and report sinks.

Everything is read as text: no schema inference, so postal codes keep their leading zeros and long
ids are never turned into floats. No scan loses or moves a cell without a sign:

* Columns are taken by name. Files of one scan may order their columns differently; files with the
  same header are read together and the groups are united by name.
* A row with more cells than the header stops the run when it is read; a shorter one is padded.
* Quoted line breaks are read by default (``multi_line=True``), by as many tasks a file as it has splits
  (``quoted_csv``). ``multi_line=False`` reads large clean exports in one JVM pass, and stops at any line that
  leaves a quote open.
* The headers of all files are read by tasks and grouped; the driver opens no file.
"""

from __future__ import annotations

import csv
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultshift import constants as K
from vaultshift.functions import text as T
from vaultshift.plans.lines import with_line_numbers
from vaultshift.sources import quoted_csv as Q

ROW_ID = "_temp_row_id"
CORRUPT = "_corrupt_record"
_CELLS = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
          "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def _checked(rows: DataFrame, n: int, what: str, whole: bool) -> DataFrame:
    """Stops at a record with more cells than the header (delimiters outside quoted cells) and, where records
    are not known to be ``whole``, at an open quote."""
    rec = F.col(CORRUPT)
    bare = F.regexp_replace(rec, '(^|,)"[^"]*+(?:""[^"]*+)*+"', "$1")
    long_row = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) >= n
    bad = F.when(long_row, F.concat(F.lit(f"{what}: more cells than the header's {n}: "), rec))
    if not whole:
        quotes = F.length(rec) - F.length(F.replace(rec, F.lit('"'), F.lit("")))
        bad = F.when(quotes % 2 == 1, F.concat(F.lit(f"{what}: a quote stays open in: "), rec)).otherwise(bad)
    # a filter is never pruned, whatever columns the query goes on with; it names a cell as well because
    # the reader refuses queries over the record alone
    fine = F.length(F.coalesce(T.col_of(rows.columns[0]), F.lit(""))) >= 0
    return rows.where(F.when(bad.isNotNull(), F.raise_error(bad).cast("boolean")).otherwise(fine)).drop(CORRUPT)


LINE = "line"


def _headers(spark: SparkSession, path: str, encoding: str) -> tuple[dict[str, tuple[str, ...]], int]:
    """The distinct header records of a path's files with their column names, and the number of splits."""
    try:
        found, splits = Q.header_records(spark, path, encoding)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from e
        raise
    headers = {text: tuple(next(csv.reader([text]), [])) for text, _ in found}
    first = next(iter(headers.values()), ())
    for text, names in headers.items():
        if len(set(names)) < len(names):
            raise ValueError(f"{path}: the header repeats a column name: {text[:1000]}")
        if set(names) != set(first):
            raise ValueError(f"{path}: columns differ between files: {sorted(set(names) ^ set(first))}")
    return headers, splits


def _scan(spark: SparkSession, path: str, multi_line: bool, encoding: str = "UTF-8", numbered: bool = False) -> DataFrame:
    """All cells as text, columns in the order of the most frequent header; with ``numbered`` also the 1-based
    ``line`` of each record over all files in order of their names (headers not counted)."""
    headers, n_splits = _headers(spark, path, encoding)
    if not headers:
        raise ValueError(f"{path}: no file has a header")
    first = next(iter(headers.values()))
    if not multi_line and len(headers) == 1:
        rows = _split_lines(spark, path, first, encoding, numbered)
        return _checked(rows, len(first), "CSV", False)
    rows, splits = Q.records(spark, path, encoding, n_splits)
    if numbered:
        rows = rows.join(F.broadcast(Q.record_numbers(splits)), [Q.FILE, Q.START]).withColumn(LINE, F.col("_off") + F.col(Q.POS))
    extra = [F.col(LINE).cast("long").alias(LINE)] if numbered else []
    if len(headers) == 1:
        cells = F.from_csv(Q.RECORD, _ddl(first), _CELLS)
        return _checked(rows.select(cells.alias("c"), *extra).select("c.*", *extra), len(first), "CSV", True)
    # cells by place, then by name: where column c stands in the file's header
    places = [f"c{k}" for k in range(len(first))]
    files = F.broadcast(splits.where(F.col(Q.START) == 0).select(Q.FILE, F.col("header").alias("_header")))  # one row a file
    rows = rows.join(files, Q.FILE).select(F.from_csv(Q.RECORD, _ddl(places), _CELLS).alias("c"), "_header", *extra)
    rows = _checked(rows.select("c.*", "_header", *extra), len(first), "CSV", True)
    order = F.create_map(*[F.lit(x) for text, names in headers.items() for x in (text, [names.index(c) + 1 for c in first])])
    rows = rows.select(F.array(*places).alias("_cells"), order[F.col("_header")].alias("_at"), *extra)
    return rows.select(*[F.element_at("_cells", F.col("_at")[k]).alias(c) for k, c in enumerate(first)], *extra)


def _split_lines(spark: SparkSession, path: str, header: tuple[str, ...], encoding: str, numbered: bool) -> DataFrame:
    """Lines of splittable text, each parsed by itself; a line with an odd number of quotes stops the run."""
    lines = Q.lines_of(spark, path, encoding)
    value = F.regexp_replace("line", "^\ufeff", "")
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))
    whole = F.when(quotes % 2 == 1, F.raise_error(F.concat(F.lit("CSV: a quoted line break needs multi_line=True: "), value)).cast("string")).otherwise(value)
    # a header line is where a file (not a split) begins
    names = F.lit(",".join(header))
    rows = lines.select(whole.alias(Q.RECORD), Q.FILE, Q.START).where(
        (F.col(Q.RECORD) != "") & ~((F.col(Q.START) == 0) & (_bare(F.col(Q.RECORD)) == _bare(names))))
    if numbered:
        rows = with_line_numbers(rows, Q.FILE, Q.START, LINE)
    extra = [LINE] if numbered else []
    return rows.select(F.from_csv(Q.RECORD, _ddl(header), _CELLS).alias("c"), *extra).select("c.*", *extra)


def _bare(c: Column) -> Column:
    return F.replace(c, F.lit('"'), F.lit(""))


def _ddl(names) -> str:
    return ", ".join(f"`{c.replace('`', '``')}` string" for c in (*names, CORRUPT))


def scan_subscribers(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A1 + A4: the subscriber export; ``_`` is null, blank cells stay ``''``; every row gets a
    unique ``_temp_row_id``. The ids follow the scan's file splits: write the rows once (as
    ``Migration.materialize`` does) before using the ids across jobs of a cluster that resizes."""
    raw = _scan(spark, path, multi_line)
    cols = [T.subscriber_null_normalise(c).alias(c) for c in raw.columns]
    return raw.select(F.monotonically_increasing_id().alias(ROW_ID), *cols)


def scan_mapping(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A2: the vault mapping, decoded as latin-1; the standard NA tokens are null."""
    raw = _scan(spark, path, multi_line, encoding="ISO-8859-1")
    return raw.select(*[T.mapping_null_normalise(c).alias(c) for c in raw.columns])


def scan_audit(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A3: a file for the postal audit; it must carry the country and postal columns. Every row has its
    1-based ``line`` (header not counted)."""
    raw = _scan(spark, path, multi_line, numbered=True)
    need = {"address_country_code", "address_postal_code"}
    if not need <= set(raw.columns):
        raise ValueError("Required columns not found")
    return raw.select(*[T.subscriber_null_normalise(c).alias(c) for c in raw.columns if c != LINE], LINE)


def record_count(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """The number of records (``n``), counted without parsing: one narrow pass over the lines."""
    return Q.count_records(spark, path, encoding)


def write_csv(df: DataFrame, path: str, clean: bool = True, null_value: str = "",
              encoding: str = "UTF-8") -> None:
    """One report directory of CSV part files with a header. ``clean`` applies the report
    cleaning (null → '', ``nan`` → '', one ``.0`` suffix removed) to every column; blank cells are bare then, as the
    reference writes them, and quoted where they are the whole line."""
    if clean:
        # booleans are written the way the reference's report files spell them
        types = dict(df.dtypes)
        cols = [F.when(F.col(f"`{c}`"), "True").when(~F.col(f"`{c}`"), "False") if types[c] == "boolean"
                else F.col(f"`{c}`") for c in df.columns]
        out = df.select(*[T.clean_for_csv(e).alias(c) for e, c in zip(cols, df.columns)])
    else:
        out = df
    (out.write.mode("overwrite").option("header", True)
     .option("quote", '"').option("escape", '"')
     .option("nullValue", null_value).option("emptyValue", "" if clean and len(df.columns) > 1 else '""')
     .option("encoding", encoding)
     .option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def _file_part(name: str) -> str:
    """A seller's name as part of a file name: letters, digits, ``-`` and ``_`` stay, inner spaces
    become ``_``, everything else goes."""
    return re.sub(r"[^\w\- ]", "", name).rstrip().replace(" ", "_")


def output_base_name(seller_name: str, provider: str, is_sandbox: bool, subscriber_path: str = "") -> str:
    """``{seller}_{provider}[_sandbox]``; without a seller the subscriber file's stem is used."""
    stem = _file_part(seller_name) if seller_name else re.sub(r"\.[^./]*$", "", subscriber_path.rstrip("/").split("/")[-1])
    return f"{stem}_{provider.lower()}" + ("_sandbox" if is_sandbox else "")


def rule_report_name(seller_name: str, report: str, is_sandbox: bool, epoch: int) -> str:
    """Name of a rule report: ``{seller}_{report}_{sandbox|production}_{epoch}``."""
    return "_".join((_file_part(seller_name), report, "sandbox" if is_sandbox else "production", str(epoch)))


def report_manifest(spark: SparkSession, root: str) -> DataFrame:
    """One row per report directory under ``root``: name, total bytes of its CSV parts, files, rows.
    Files are listed by Spark's binary-file source with the content column pruned; rows are counted without
    parsing."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
             .option("recursiveFileLookup", True).load(root).select("path", "length"))
    name = lambda c: F.regexp_extract(F.col(c), r"/([^/]+)/[^/]+\.csv$", 1).alias("name")
    sizes = files.groupBy(name("path")).agg(F.sum("length").cast("long").alias("size"), F.count(F.lit(1)).cast("long").alias("files"))
    splits = Q.split_table(spark, f"{root.rstrip('/')}/*")
    rows = splits.groupBy(name(Q.FILE)).agg((F.sum("n") - F.count_if((F.col(Q.START) == 0) & (F.col("n") > 0))).cast("long").alias("rows"))
    return sizes.join(rows, "name", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
