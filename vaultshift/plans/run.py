"""A whole migration run: materialise once, count once, write every non-empty report, return the
summary.

Only the metric table (one row per metric name, a number fixed by the code), the one-row summary
and the validation table (at most 16 rows) reach the driver; every report is written by the
executors as a directory of CSV part files. Counts are observed while the copies are written; reports are written
in rounds, one for each kind of rows they are taken from, and published by renames. A round's shuffled lines go
when it ends. The copies live below the output folder while the run lasts; each is deleted once no later round reads it.
"""

from __future__ import annotations

import csv
import io
import time
import uuid
from functools import partial, reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultshift import constants as K
from vaultshift.functions import text as T
from vaultshift.operators.rules import JOINED, SUBSCRIBER
from vaultshift.plans.actions import DEFAULT_PARALLEL_ACTIONS, run_all
from vaultshift.plans.pipeline import ROW_ID, Migration
from vaultshift.plans.summary import validation_summary, verdict, with_errors
from vaultshift.session import shuffles_released
from vaultshift.sources import csv_io as IO

#: Subscriber reports: report name -> (flags of the failing rows, validation step).
SUBSCRIBER_REPORTS = {
    K.REPORT_COUNTRY_FORMAT: (("_f_country",), K.STEP_COUNTRY_FORMAT),
    K.REPORT_PRICE_ID: (("_f_price", "_f_quantity"), K.STEP_PRICE_ID),
    K.REPORT_UNSUPPORTED: (("_f_unsupported",), K.STEP_UNSUPPORTED),
    K.REPORT_DATE_FORMAT: (("_f_date_format",), K.STEP_DATE_FORMAT),
    K.REPORT_DATE_PERIOD: (("_f_date_period",), K.STEP_DATE_PERIOD),
    K.REPORT_CARD_TOKEN_LENGTH: (("_f_card_token",), K.STEP_CARD_TOKEN),
}
#: Joined-row reports: report name -> (flag, validation step).
JOINED_REPORTS = {
    K.REPORT_MISSING_POSTAL: ("_f_missing", K.STEP_MISSING_POSTAL),
    K.REPORT_CA_POSTAL: ("_f_ca", K.STEP_CA_POSTAL),
    K.REPORT_US_POSTAL: ("_f_us", K.STEP_US_POSTAL),
}
#: Output files: report name -> (frame of the run, count in the run summary).
OUTPUTS = {
    K.REPORT_FINAL_IMPORT: ("final_import", "success_count"),
    K.REPORT_NO_TOKEN: ("no_token", "no_tokens_count"),
    K.REPORT_DUP_TOKENS: ("duplicate_tokens", "duplicate_tokens_count"),
    K.REPORT_DUP_SUBSCRIPTIONS: ("duplicate_subscription_ids", "duplicate_external_subscription_ids_count"),
    K.REPORT_DUP_EMAILS: ("duplicate_emails", "duplicate_emails_count"),
    K.REPORT_DUP_CARD_IDS: ("duplicate_card_ids", "duplicate_card_ids_count"),
}


def subscriber_reports(m: Migration) -> dict[str, tuple[tuple[str, ...], str]]:
    return SUBSCRIBER_REPORTS | {r.code: ((r.flag,), r.step) for r in m.user_rules(SUBSCRIBER)}


def joined_reports(m: Migration) -> dict[str, tuple[str, str]]:
    return JOINED_REPORTS | {r.code: (r.flag, r.step) for r in m.user_rules(JOINED)}


def subscriber_report(m: Migration, report: str) -> DataFrame:
    """Failing subscriber rows of a rule: every column of the export and the row id."""
    failing = F.lit(False)
    for flag in subscriber_reports(m)[report][0]:
        failing = failing | F.col(flag)
    return m.prepared_subscribers.where(failing).select(*[T.col_of(c) for c in m.file_columns], ROW_ID)


def joined_report(m: Migration, report: str) -> DataFrame:
    """Failing joined rows of a postal rule. Rows without a postal code are reported as they were
    joined, before the layout: the export's columns (original email, filled postal code), the vault's
    postal code and the row id. The other two are in the import layout."""
    if report == K.REPORT_MISSING_POSTAL:
        zip_name = K.STRIPE_MAPPING_ZIP if m.options.provider == "stripe" else K.BLUESNAP_MAPPING_ZIP
        cols = [F.col("_postal_filled").alias(c) if c == "address_postal_code" else T.col_of(c) for c in m.file_columns]
        return m.joined_all.where(F.col("_f_missing")).select(*cols, F.col("_m_zip").alias(zip_name), ROW_ID)
    return m.layout(m.completed.where(F.col(joined_reports(m)[report][0])))


def delete(spark, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


#: Rows of one report file.
FILE_ROWS = 1_000_000
_CSV = {"quote": '"', "escape": '"', "nullValue": "", "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
#: The copies of a materialised run that reports are read from.
COPIES = ("prepared_subscribers", "prepared_mapping", "joined")


def _line(cells: list[tuple[str, Column]]) -> Column:
    """One CSV line of cleaned cells, as the reports spell them."""
    return F.to_csv(F.struct(*[T.clean_for_csv(c.cast("string")).alias(f"c{k}") for k, (_, c) in enumerate(cells)]), _CSV)


def _header(names: list[str]) -> str:
    out = io.StringIO()
    csv.writer(out, lineterminator="").writerow(names)
    return out.getvalue()


def _spelled(name: str) -> Column:
    return F.when(F.col(name), "True").when(~F.col(name), "False")


def report_rounds(m: Migration, reports: list[str]) -> list[tuple[set[str], dict[str, str], DataFrame]]:
    """The wanted reports in rounds: the copies a round reads, the header of each of its reports, and (report, id, line)
    of all their rows. Subscriber rows and joined rows are a round each and read once, however many reports they go to;
    the two duplicate-group reports are the semi-joins they are. The rounds that read the most copies come first."""
    row_id = (ROW_ID, F.col(ROW_ID))
    export = [(c, T.col_of(c)) for c in m.file_columns] + [row_id]
    final = list(zip(m.layout_columns, m._layout_exprs("final"), strict=True))
    helpers = final + [("is_duplicate_token", _spelled("is_duplicate_token")), row_id]
    rounds = []

    def rows_of(copy: str, df: DataFrame, wanted: dict[str, tuple[Column, str]], layouts: dict[str, list]) -> None:
        """``wanted``: report -> (condition, layout); a layout's line is made once a row, where some report needs it."""
        wanted = {r: w for r, w in wanted.items() if r in reports}
        if not wanted:
            return
        used = {name for _, name in wanted.values()}
        line = {f"_line_{n}": F.when(reduce(or_, [c for c, x in wanted.values() if x == n]), _line(layouts[n])) for n in used}
        entry = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(r).alias("report"), F.col(f"_line_{n}").alias("line"))) for r, (c, n) in wanted.items()]))
        uid = F.xxhash64(ROW_ID, "_m_uid") if "_m_uid" in df.columns else F.xxhash64(ROW_ID)
        lines = df.withColumns(line).select(uid.alias("id"), F.explode(entry).alias("e")).select("e.report", "id", "e.line")
        rounds.append(({copy}, {r: _header([n for n, _ in layouts[layout]]) for r, (_, layout) in wanted.items()}, lines))

    for report in (K.REPORT_DUP_EMAILS, K.REPORT_DUP_SUBSCRIPTIONS):
        if report in reports:
            df = getattr(m, OUTPUTS[report][0])
            cells = [(c, _spelled(c) if c == "is_duplicate_token" else T.col_of(c)) for c in df.columns]
            lines = df.select(F.lit(report).alias("report"), F.xxhash64(ROW_ID, "card_token").alias("id"), _line(cells).alias("line"))
            rounds.append((set(COPIES), {report: _header(df.columns)}, lines))

    email = m._sub_col("customer_email").isNotNull()
    joined = {K.REPORT_FINAL_IMPORT: (email & ~F.col("_row_failed"), "final"), K.REPORT_NO_TOKEN: (email & F.col("_f_no_token"), "helpers"),
              K.REPORT_DUP_TOKENS: (email & F.col("is_duplicate_token"), "tokens"), K.REPORT_DUP_CARD_IDS: (email & F.col("_dup_card_id"), "helpers")}
    joined |= {r: (email & F.col(flag), "helpers") for r, (flag, _) in joined_reports(m).items()}
    joined[K.REPORT_MISSING_POSTAL] = (F.col("_f_missing"), "missing")
    zip_name = K.STRIPE_MAPPING_ZIP if m.options.provider == "stripe" else K.BLUESNAP_MAPPING_ZIP
    missing = [(c, F.col("_postal_filled") if c == "address_postal_code" else e) for c, e in export[:-1]] + [(zip_name, F.col("_m_zip")), row_id]
    rows_of("joined", m.joined_all, joined, {"final": final, "helpers": helpers, "tokens": final + [row_id], "missing": missing})

    failing = {r: (reduce(or_, [F.col(f) for f in flags]), "export") for r, (flags, _) in subscriber_reports(m).items()}
    rows_of("prepared_subscribers", m.prepared_subscribers, failing, {"export": export})
    return rounds


def write_reports(m: Migration, counts: dict[str, int], names: dict[str, str], out_dir: str, work: str, file_rows: int = FILE_ROWS,
                  threads: int = DEFAULT_PARALLEL_ACTIONS, key_order: bool = False) -> list[dict]:
    """All reports (report -> rows, more than none) in rounds of one job each, then published: the lines are dealt to
    files of about ``file_rows``, written below ``work``, and each report's files become ``out_dir/name/part-N.csv``, whole
    or not at all. Rounds run one after another: on disk are the copies still to be read, the reports so far and one
    round's shuffled lines. With ``key_order`` the final import is a job of its own: its files are ranges of the card
    key, in order. Returns the manifest: name, size, rows, url of each."""
    spark = m.subscribers.sparkSession
    files = {r: max(1, -(-n // file_rows)) for r, n in counts.items()}
    ordered = {K.REPORT_FINAL_IMPORT} & set(counts) if key_order else set()

    def write_round(headers: dict[str, str], lines: DataFrame) -> None:
        of = F.create_map(*[F.lit(x) for r in headers for x in (r, files[r])])
        lines = lines.select("report", F.pmod("id", of[F.col("report")]).cast("int").alias("file"), F.lit(1).alias("k"), F.col("line").alias("value"))
        heads = spark.createDataFrame([(r, k, 0, head) for r, head in headers.items() for k in range(files[r])], "report string, file int, k int, value string")
        every = lines.unionByName(heads).repartition("report", "file").sortWithinPartitions("report", "file", "k")
        every.drop("k").write.mode("append").partitionBy("report", "file").text(f"{work}/reports")  # a folder of this run

    for r in ordered:
        IO.write_csv(m.final_import_in_order(files[r]), f"{work}/ordered/{r}")
    rounds = report_rounds(m, [r for r in files if r not in ordered])
    for k, (_, headers, lines) in enumerate(rounds):
        for copy in set(COPIES).difference(*[copies for copies, _, _ in rounds[k:]]):
            delete(spark, f"{work}/{copy}")
        write_round(headers, lines)
    jvm = spark.sparkContext._jvm
    path = lambda x: jvm.org.apache.hadoop.fs.Path(x)
    fs = path(work).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def publish(report: str) -> dict:
        made = path(f"{work}/reports/_{report}")
        fs.mkdirs(made)
        parts = lambda folder: sorted((f for f in fs.listStatus(path(folder)) if f.getPath().getName().startswith("part-")),
                                      key=lambda f: f.getPath().getName())
        if report in ordered:
            found = parts(f"{work}/ordered/{report}")
        else:
            found = [f for k in range(files[report]) for f in parts(f"{work}/reports/report={report}/file={k}")]
        size = 0
        for k, f in enumerate(found):
            size += f.getLen()
            fs.rename(f.getPath(), path(f"{work}/reports/_{report}/part-{k:05d}.csv"))
        target = path(f"{out_dir}/{names[report]}")
        fs.delete(target, True)
        fs.rename(made, target)
        return {"name": names[report], "size": size, "rows": counts[report], "url": target.toString()}

    return run_all([partial(publish, r) for r in files], threads)


def run_to_directory(m: Migration, out_dir: str, subscriber_path: str = "", parallel_sinks: int = DEFAULT_PARALLEL_ACTIONS,
                     epoch: int | None = None, file_rows: int = FILE_ROWS, key_order: bool = False) -> dict:
    """``epoch``: seconds in the names of rule reports (default: now), so that runs do not overwrite each other's.
    ``key_order``: the final import's files are sorted ranges of the card key."""
    o = m.options
    out_dir = out_dir.rstrip("/")
    spark = m.subscribers.sparkSession
    work = f"{out_dir}/_work-{uuid.uuid4().hex}"
    epoch = int(time.time()) if epoch is None else epoch
    with shuffles_released(spark):
        try:
            m.materialize(work)
            m.fetch_metrics()
            summary = m.run_summary.collect()[0].asDict()
            steps = with_errors(m, [r.asDict() for r in validation_summary(m).collect()])
            by_step = {s["step"]: s for s in steps}
            base = IO.output_base_name(o.seller_name, o.provider, o.is_sandbox, subscriber_path)
            counts, names = {}, {}  # in report order; empty ones are not written
            for report, (_, count) in OUTPUTS.items():
                if summary[count]:
                    counts[report], names[report] = summary[count], f"{base}_{report}"
            for report, (_, step) in (subscriber_reports(m) | joined_reports(m)).items():
                found = by_step.get(step, {})
                if found.get("incorrect_count"):
                    corrected = report == K.REPORT_US_POSTAL and (found.get("autocorrected_count") or 0) > 0
                    counts[report] = found["incorrect_count"]
                    names[report] = IO.rule_report_name(o.seller_name, report + ("_after_autocorrect" if corrected else ""), o.is_sandbox, epoch)
                    found["download_file"] = names[report]
            manifest = write_reports(m, counts, names, out_dir, work, file_rows, parallel_sinks, key_order) if counts else []
        finally:
            delete(spark, work)
    return {"summary": summary, "validation_results": steps, "reports": [f["name"] for f in manifest], "output_files": manifest} | verdict(steps)
