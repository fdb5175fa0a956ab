"""The migration as one lazy Spark plan.

    subscribers ─ [strip fractional seconds] ─ normalise quantities ─ subscriber rules (flags)
    vault mapping ─ provider shaping (canonical columns, null keys dropped)
    skew-safe LEFT JOIN on the card key, with per-key statistics of both sides
    ─ duplicate-key flag, holder/token resolution, postal rules with optional fill and pad
    ─ drop null emails ─ layout ─ removal by subscriber row ─ reports and summaries

Design points for large inputs:

* The wide rows shuffle once per side (the join). Duplicate-key flags (F1, F2) and the removal of
  every joined row of a failed subscriber row (D4) are computed from per-key statistics gathered
  by the join itself, not by regrouping joined rows: a subscriber row fails when its own rules
  fail, when its key has no token on some mapping row, or when some mapping row of its key would
  give it a failing postal code (``any`` over the key, precomputed per country class).
* Rules never filter; each is a pair of boolean columns, so every count of the summary comes from
  one aggregate per grain (subscriber rows, joined rows).
* Duplicate emails and subscription ids only feed reports and counts; their group sizes over joined rows
  are sums of each subscriber row's fan-out, taken from narrow columns before the wide join
  (``vaultshift.operators.skew``). A query joins the wide rows once at most, and none for these counts.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import cached_property, partial, reduce
from typing import ClassVar

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from vaultshift import constants as K
from vaultshift.functions import text as T
from vaultshift.operators import mapping as M
from vaultshift.operators import postal as P
from vaultshift.operators import rules as R
from vaultshift.operators.ordering import key_ordered
from vaultshift.operators.skew import DEFAULT_HOT_ROWS, fan_out, rows_in_groups, rows_in_groups_counts, skew_left_join

ROW_ID = "_temp_row_id"


@dataclass(frozen=True)
class MigrationOptions:
    provider: str = "stripe"
    vault_provider: str = "tokenex"
    is_sandbox: bool = False
    seller_name: str = ""
    autocorrect_us_zip: bool = False
    use_mapping_zip_codes: bool = False
    anonymise_email: bool = False
    strip_iso_date_fractional_suffix: bool = False
    as_of: str | None = None                  # 'YYYY-MM-DDTHH:MM:SSZ'; None = query time
    card_token_check: bool = False            # the opt-in 13-digit token rule
    anon_email_domain: str = K.ANON_EMAIL_DEFAULT_DOMAIN
    anon_seed: str = "vaultshift"
    hot_rows: int = DEFAULT_HOT_ROWS

    def __post_init__(self):
        if self.provider not in K.PROVIDERS:
            raise ValueError(f"unknown provider {self.provider!r}; expected one of {K.PROVIDERS}")

    @property
    def anonymising(self) -> bool:
        return self.is_sandbox and self.anonymise_email

    @property
    def environment(self) -> str:
        return "Sandbox" if self.is_sandbox else "Production"

    @property
    def vault_literal(self) -> str:
        v = self.vault_provider
        return K.VAULT_LOWERCASE_NAME if v.lower() == K.VAULT_LOWERCASE_NAME else v

    def with_(self, **kw) -> "MigrationOptions":
        return replace(self, **kw)


def _count_if(c: Column) -> Column:
    return F.count(F.when(c, F.lit(1))).cast("long")


def _any(c: Column) -> Column:
    return F.max(F.coalesce(c, F.lit(False)))


def _numbered_pairs(columns, kinds: tuple[str, str]) -> list[str]:
    """Columns of two numbered kinds by ascending number, the first kind before the second."""
    found = [(n, k, c) for c in columns for k, kind in enumerate(kinds) if (n := K.numbered_index(kind, c)) is not None]
    return [c for *_, c in sorted(found)]


def ordered_custom_columns(columns) -> list[str]:
    """Custom-data key/value columns by ascending N, key before value."""
    return _numbered_pairs(columns, ("custom_key", "custom_value"))


def ordered_price_columns(columns) -> list[str]:
    """Price id/quantity columns by ascending N, price before quantity."""
    return _numbered_pairs(columns, ("price_id", "quantity"))


def column_check(columns) -> dict:
    """B1/B2: required columns that are absent, and the optional numbered columns present."""
    import re
    columns = [c for c in columns if c != ROW_ID]
    missing = [c for c in K.REQUIRED_SUBSCRIBER_COLUMNS if c not in columns]
    optional = [c for p in K.OPTIONAL_COLUMN_PATTERNS for c in columns
                if re.match(p, c) and c not in K.REQUIRED_SUBSCRIBER_COLUMNS]
    return {"valid": not missing, "missing_columns": missing, "optional_columns": optional,
            "total_columns": len(columns)}


@dataclass
class Migration:
    """One migration run over a subscriber export and a vault mapping (both DataFrames).

    ``subscribers`` must carry a unique, stable ``_temp_row_id`` (the CSV scan adds it) and string
    columns; ``mapping`` is the vault file as scanned. Every property is a lazy DataFrame.
    """

    subscribers: DataFrame
    mapping: DataFrame
    options: MigrationOptions = field(default_factory=MigrationOptions)
    rules: tuple[R.UserRule, ...] = ()
    _fetched = False
    _materialized = False
    _observed: ClassVar[dict[str, int]] = {}

    def __post_init__(self):
        codes = [r.code for r in self.rules]
        if len(set(codes)) < len(codes):
            raise ValueError(f"rule codes repeat: {codes}")

    def user_rules(self, stage: str) -> list[R.UserRule]:
        return [r for r in self.rules if r.stage == stage]

    # ---- subscriber grain ---------------------------------------------------------------------
    @cached_property
    def file_columns(self) -> list[str]:
        return [c for c in self.subscribers.columns if c != ROW_ID]

    @cached_property
    def prepared_subscribers(self) -> DataFrame:
        """Subscriber rows after the optional date fix and quantity normalisation, with rule flags."""
        df = self.subscribers
        cols = self.file_columns
        if self.options.strip_iso_date_fractional_suffix:
            dates = [c for c in K.DATE_COLUMNS_WITH_FRACTION_FIX if c in cols]
            df = T.with_stripped(df, dates)
            df = df.withColumns({c: T.strip_fractional_seconds(c, T.stripped(c)) for c in dates})
            df = df.drop(*[T.stripped_name(c) for c in dates])
        quantities = [c for c in cols if K.numbered_index("quantity", c) is not None]
        if "price_id_1" in cols and quantities:
            df = T.with_stripped(df, quantities)
            df = df.withColumns({c: T.normalize_quantity(c, T.stripped(c)) for c in quantities})
            df = df.drop(*[T.stripped_name(c) for c in quantities])
        # stage the stripped rule inputs once; every rule below reads those helper columns
        rule_inputs = [c for c in cols if c in ("address_country_code", "started_at", "paused_at",
                                                "current_period_started_at", "current_period_ends_at")
                       or K.numbered_index("price_id", c) is not None or c in quantities]
        df = T.with_stripped(df, rule_inputs)
        rules = R.subscriber_rules(set(cols), R.as_of_column(self.options.as_of), self.options.card_token_check,
                                   lambda c: T.stripped(c) if c in rule_inputs else T.py_strip(c))
        names = ["_f_country", "_f_price", "_f_quantity", "_f_unsupported", "_f_date_format", "_f_date_period"]
        flags = {n: r.fails for n, r in zip(names, rules)}
        flags["_p_date_period"] = rules[5].population
        if self.options.card_token_check:
            flags["_f_card_token"] = rules[6].fails
            flags["_p_card_token"] = rules[6].population
        df = df.withColumns(flags).drop(*[T.stripped_name(c) for c in rule_inputs])
        mine = self.user_rules(R.SUBSCRIBER)
        if mine:
            df = df.withColumns({n: c for r in mine for n, c in r.flags.items()})
        removing = [n for n in flags if n.startswith("_f_")] + [r.flag for r in mine if r.removes]
        s_failed = reduce(lambda a, b: a | b, [F.col(n) for n in removing])
        # the period rule removes nothing when no row parses (the reference reports an error instead)
        return df.withColumn("_s_failed", s_failed)

    # ---- join grain ---------------------------------------------------------------------------
    @cached_property
    def prepared_mapping(self) -> DataFrame:
        m = M.prepare(self.mapping, self.options.provider)
        o = self.options
        # per mapping row: would this zip leave a missing-postal row of each country class failing?
        # (only the fill makes the outcome depend on the mapping row)
        if not o.use_mapping_zip_codes:
            return m.withColumns({n: F.lit(False) for n in ("_m_fail_us", "_m_fail_ca", "_m_fail_other")})
        for name, country in (("_m_fail_us", "US"), ("_m_fail_ca", "CA"), ("_m_fail_other", "GB")):
            m = P.add_postal_columns(m, F.lit(country), F.lit(""), F.col("_m_zip"), True,
                                     o.autocorrect_us_zip, prefix=name)
            m = m.withColumnRenamed(name + "_postal_fails", name).drop(*[name + k for k in P.OUTCOMES[:-1]])
        return m

    def _keyed(self, df: DataFrame) -> DataFrame:
        """Rows with the join key; Stripe drops null keys (C12), Bluesnap keys are text."""
        tok = self._sub_col("card_token")
        if self.options.provider == "bluesnap":
            return df.withColumn("_key", F.coalesce(tok, F.lit("nan")))
        return df.withColumn("_key", tok).where(F.col("_key").isNotNull())

    @cached_property
    def keyed_subscribers(self) -> DataFrame:
        return self._keyed(self.prepared_subscribers)

    @cached_property
    def subscriber_keys(self) -> DataFrame:
        """Key, email and subscription id of the keyed rows; no rule touches these, so they come from the source."""
        df = self._keyed(self.prepared_subscribers if self._materialized else self.subscribers)
        return df.select("_key", self._sub_col("customer_email").alias("_email"), self._sub_col("subscription_external_id").alias("sid"))

    @cached_property
    def mapping_keys(self) -> DataFrame:
        return (self.prepared_mapping if self._materialized else M.prepare(self.mapping, self.options.provider)).select("_key")

    @cached_property
    def joined_all(self) -> DataFrame:
        """Joined rows before the null-email filter, with every per-row rule outcome."""
        o = self.options
        j = skew_left_join(
            self.keyed_subscribers.withColumn("_email", self._sub_col("customer_email")), self.prepared_mapping, "_key", ROW_ID, "_m_uid",
            left_aggs=[("_ln_email", F.count("_email"))],
            right_aggs=[
                ("_rn_first", F.min("_m_uid")),
                ("_rn_null_token", _any(F.col("_m_token").isNull())),
                ("_rn_fail_us", _any(F.col("_m_fail_us"))),
                ("_rn_fail_ca", _any(F.col("_m_fail_ca"))),
                ("_rn_fail_other", _any(F.col("_m_fail_other"))),
            ],
            hot_rows=o.hot_rows,
            fetch=self._materialized, left_keys=self.subscriber_keys, right_keys=self.mapping_keys,
        ).drop("_email")
        country = self._sub_col("address_country_code")
        postal = self._sub_col("address_postal_code")
        fan = F.greatest(F.col("_rn"), F.lit(1))
        if o.provider == "stripe":
            holder = F.coalesce(F.col("_m_holder"), self._sub_col("customer_full_name"))
        else:
            holder = F.col("_m_holder")
        j = P.add_postal_columns(j, country, postal, F.col("_m_zip"), o.use_mapping_zip_codes,
                                 o.autocorrect_us_zip)
        # removal: any failure over all joined rows of the subscriber row, from per-key statistics
        if o.use_mapping_zip_codes:
            j = P.add_postal_columns(j, country, postal, F.lit(None).cast("string"), False,
                                     o.autocorrect_us_zip, prefix="_own")
            j = j.drop(*["_own" + k for k in P.OUTCOMES[:-1]])
            class_any = (F.when(country == "US", F.col("_rn_fail_us"))
                         .when(country == "CA", F.col("_rn_fail_ca"))
                         .otherwise(F.col("_rn_fail_other")))
            postal_any = F.when(F.col("_f_missing_before"), F.coalesce(class_any, F.lit(True))) \
                .otherwise(F.col("_own_postal_fails"))
        else:
            postal_any = F.col("_postal_fails")
        no_token_any = (F.col("_rn") == 0) | F.coalesce(F.col("_rn_null_token"), F.lit(False))
        j = j.withColumns({
            "is_duplicate_token": (F.col("_ln") * fan) > 1,
            "_dup_card_id": (F.col("_ln_email") * fan) > 1,
            "_holder": holder,
            "_token": F.col("_m_token"),
            "_c_available": F.col("_f_missing") & ~T.is_empty_after_strip(F.col("_m_zip")),
            "_f_no_token": F.col("_m_token").isNull(),
            "_row_failed": F.col("_s_failed") | no_token_any | postal_any,
            # one joined row of each subscriber row: outcomes of whole subscriber rows are counted on it
            "_first": F.col("_m_uid").isNull() | (F.col("_m_uid") == F.col("_rn_first")),
        })
        mine = self.user_rules(R.JOINED)
        if not mine:
            return j
        j = j.withColumns({n: c for r in mine for n, c in r.flags.items()})
        removing = [F.col(r.flag) for r in mine if r.removes]
        if not removing:
            return j
        # a rule over any columns of both sides has no per-key form: ids of failing rows, then joined back
        failing = j.where(reduce(lambda a, b: a | b, removing)).select(ROW_ID).distinct().withColumn("_u_failed", F.lit(True))
        j = j.join(failing, ROW_ID, "left")
        return j.withColumn("_row_failed", F.col("_row_failed") | F.col("_u_failed").isNotNull()).drop("_u_failed")

    def materialize(self, path: str | None = None) -> "Migration":
        """Write the flagged subscriber rows, the shaped mapping and the flagged joined rows once
        (Parquet in the shared checkpoint folder, or under ``path``) and serve every later step
        from those copies.

        The subscriber rules then run once instead of once per consumer (join statistics, cold and
        hot branches, counts, rule reports), one computation feeds many sinks, lineage is cut (a
        lost executor re-reads files instead of re-running the join), and filters on flag columns
        become plain predicates pushed into the Parquet scan.
        """
        import uuid

        from vaultshift.plans.actions import run_all
        from vaultshift.session import checkpoint_dir

        spark = self.subscribers.sparkSession
        if path is None:
            path = f"{checkpoint_dir(spark).rstrip('/')}/vaultshift-run-{uuid.uuid4().hex}"
        inputs = ("prepared_subscribers", "prepared_mapping")
        # the two prepared inputs are independent jobs: submit them together
        # every count of a grain is observed by the write of its rows: no pass over the copies for counts
        seen = {"prepared_subscribers": Observation(), "joined": Observation()}
        frames = {n: getattr(self, n) for n in inputs}
        frames["prepared_subscribers"] = frames["prepared_subscribers"].observe(seen["prepared_subscribers"], *self._subscriber_aggs())
        writers = {n: self._copy_writer(df) for n, df in frames.items()}
        run_all([partial(writers[n].parquet, f"{path}/{n}") for n in inputs])
        for name in inputs:
            self.__dict__[name] = spark.read.parquet(f"{path}/{name}")
        self._materialized = True
        for name in ("keyed_subscribers", "subscriber_keys", "mapping_keys", "joined_all", "completed", "group_fan"):
            self.__dict__.pop(name, None)
        self._copy_writer(self.joined_all.observe(seen["joined"], *self._joined_aggs())).parquet(f"{path}/joined")
        self._observed = {k: v for o in seen.values() for k, v in o.get.items()}
        self.__dict__["joined_all"] = spark.read.parquet(f"{path}/joined")
        self.__dict__.pop("completed", None)
        return self

    @staticmethod
    def _copy_writer(df: DataFrame):
        # zstd: about a third smaller than the default snappy on these text-heavy rows and no slower
        # to write, so less I/O on the shared folder for the write and for every re-read
        return df.write.mode("overwrite").option("compression", "zstd")

    def _sub_col(self, name: str) -> Column:
        return T.col_of(name) if name in self.file_columns else F.lit(None).cast("string")

    @cached_property
    def completed(self) -> DataFrame:
        """Joined rows that carry an email (C11): the rows every report and count is about."""
        return self.joined_all.where(self._sub_col("customer_email").isNotNull())

    # ---- layout -------------------------------------------------------------------------------
    @cached_property
    def layout_columns(self) -> list[str]:
        head = K.STRIPE_LAYOUT_HEAD if self.options.provider == "stripe" else K.BLUESNAP_LAYOUT_HEAD
        return list(head) + ordered_custom_columns(self.file_columns) + \
            ordered_price_columns(self.file_columns) + ["vault_provider"]

    def _layout_exprs(self, stage: str) -> list[Column]:
        """Projection to the provider layout. ``stage='final'`` applies the vault literal, the
        upper-cased ``enable_checkout``, the US pad and anonymised emails; ``stage='emails'`` is the
        earlier state the duplicate-email report is taken from."""
        o = self.options
        final = stage == "final"
        from_mapping = {
            "card_expiry_month": F.col("_m_exp_month"),
            "card_expiry_year": F.col("_m_exp_year"),
            "card_holder_name": F.col("_holder"),
            "card_token": F.col("_token"),
            "network_transaction_id": F.col("_m_ntx"),
        }
        if o.provider == "stripe":
            from_mapping["card_id"] = F.col("_key")
            from_mapping.update({name: F.col(internal) for name, internal in M.STRIPE_EXTRAS.items()})
        exprs = []
        for c in self.layout_columns:
            if c in from_mapping:
                e = from_mapping[c]
            elif c == "vault_provider":
                e = F.lit(o.vault_literal) if final else F.lit(None).cast("string")
            elif c == "address_postal_code":
                e = F.col("_postal_final") if final else F.col("_postal_filled")
            elif c == "enable_checkout" and final:
                e = F.upper(self._sub_col(c))
            elif c == "customer_email" and final and o.anonymising:
                e = self._anonymised_email()
            else:
                e = self._sub_col(c)
            exprs.append(e.cast("string").alias(c))
        return exprs

    def _anonymised_email(self) -> Column:
        """``blackhole+<token>@<domain>``, five characters of [0-9a-z] (more for row ids beyond 36**5). The
        token is a keyed permutation of the row id: no two subscriber rows share one, and recomputation
        after a lost executor gives it again."""
        o = self.options
        return F.concat(F.lit(K.ANON_EMAIL_PREFIX), T.permuted_token(F.col(ROW_ID), o.anon_seed), F.lit("@" + o.anon_email_domain))

    def layout(self, df: DataFrame | None = None, stage: str = "final", helpers=True) -> DataFrame:
        """Rows projected to the import layout, plus ``is_duplicate_token`` and ``_temp_row_id``."""
        df = self.completed if df is None else df
        extra = [F.col("is_duplicate_token"), F.col(ROW_ID)] if helpers else []
        return df.select(*self._layout_exprs(stage), *extra)

    # ---- outputs ------------------------------------------------------------------------------
    @cached_property
    def final_import(self) -> DataFrame:
        """C13 + D4: rows of subscriber rows that failed nothing (all have a token)."""
        return self.layout(self.completed.where(~F.col("_row_failed")), helpers=False)

    def final_import_in_order(self, files: int, helpers: bool = False) -> DataFrame:
        """H2: the final import in order of the card key, then of the rows, as ``files`` sorted ranges; with ``helpers``
        the key and the row id come first."""
        ties = [F.col(ROW_ID).alias("_tie_row"), F.col("_m_uid").alias("_tie_vault")]
        own = [F.col("_key").alias("card_key"), F.col(ROW_ID)] if helpers else []
        names = [c for c, keep in (("card_key", helpers), (ROW_ID, helpers)) if keep] + self.layout_columns
        rows = self.completed.where(~F.col("_row_failed")).select(*own, *self._layout_exprs("final"), F.col("_key").alias("_order_key"), *ties)
        return key_ordered(rows, ["_order_key"], ["_tie_row", "_tie_vault"], files).select(*[F.col(f"`{c}`") for c in names])

    @cached_property
    def no_token(self) -> DataFrame:
        return self.layout(self.completed.where(F.col("_f_no_token")))

    @cached_property
    def duplicate_tokens(self) -> DataFrame:
        return self.layout(self.completed.where(F.col("is_duplicate_token"))).drop("is_duplicate_token")

    @cached_property
    def duplicate_card_ids(self) -> DataFrame:
        if self.options.provider != "stripe":
            return self.layout(self.completed.where(F.lit(False)))
        return self.layout(self.completed.where(F.col("_dup_card_id")))

    @cached_property
    def group_fan(self) -> DataFrame:
        """(sid, _email, _rows): the joined rows with an email that each pair of values has."""
        return fan_out(self.subscriber_keys.where("_email is not null"), self.mapping_keys, "_key", ["sid", "_email"])

    def _in_groups(self, rows: DataFrame, column: str, fan: str) -> DataFrame:
        return rows_in_groups(rows, column, self.group_fan.select(F.col(fan).alias(column), "_rows"))

    @cached_property
    def duplicate_subscription_ids(self) -> DataFrame:
        return self._in_groups(self.layout(), "subscription_external_id", "sid")

    @cached_property
    def duplicate_emails(self) -> DataFrame:
        """F4, taken before anonymisation; empty when emails are anonymised."""
        rows = self.layout(stage="emails")
        return rows.where(F.lit(False)) if self.options.anonymising else self._in_groups(rows, "customer_email", "_email")

    @cached_property
    def duplicate_emails_surviving(self) -> DataFrame:
        """Duplicate-email rows that are still in the run after removal."""
        if self.options.anonymising:
            return self.layout(self.completed.where(F.lit(False)))
        rows = self.completed.where(~F.col("_row_failed"))
        return self._in_groups(rows.select(*self._layout_exprs("emails"), "is_duplicate_token", ROW_ID), "customer_email", "_email")

    # ---- counts -------------------------------------------------------------------------------
    def _subscriber_aggs(self) -> list[Column]:
        aggs = [
            F.count(F.lit(1)).cast("long").alias("n_subscribers"),
            _count_if(F.col("_f_country")).alias("country_format"),
            _count_if(F.col("_f_price") | F.col("_f_quantity")).alias("price_id"),
            _count_if(F.col("_f_price")).alias("price_id_prefix"),
            _count_if(F.col("_f_quantity")).alias("quantity"),
            _count_if(F.col("_f_unsupported")).alias("unsupported_country"),
            _count_if(F.col("_f_date_format")).alias("date_format"),
            _count_if(F.col("_p_date_period")).alias("date_period_population"),
            _count_if(F.col("_f_date_period")).alias("date_period"),
            _count_if(F.col("_s_failed")).alias("subscriber_rows_failed"),
        ]
        aggs += [_count_if(F.col(n)).alias(n) for r in self.user_rules(R.SUBSCRIBER) for n in r.flags]
        if self.options.card_token_check:
            aggs += [_count_if(F.col("_f_card_token")).alias("card_token"), _count_if(F.col("_p_card_token")).alias("card_token_population")]
        key_col = "card_token" if "card_token" in self.file_columns else None
        if self.options.provider == "stripe" and key_col:
            aggs.append(_count_if(T.col_of(key_col).isNull()).alias("dropped_null_key"))
        else:
            aggs.append(_count_if(F.lit(False)).alias("dropped_null_key"))
        return aggs

    @cached_property
    def subscriber_counts(self) -> DataFrame:
        """E1, subscriber grain: one aggregate over all subscriber rows."""
        return self.prepared_subscribers.agg(*self._subscriber_aggs())

    @cached_property
    def joined_counts(self) -> DataFrame:
        """E1/E2/E4, joined grain: one aggregate over joined rows (post-email items are filtered
        inside the aggregate)."""
        return self.joined_all.agg(*self._joined_aggs())

    def _joined_aggs(self) -> list[Column]:
        has_email = self._sub_col("customer_email").isNotNull()

        def ce(c):
            return _count_if(has_email & c)

        return [
            F.count(F.lit(1)).cast("long").alias("joined_rows"),
            _count_if(F.col("_p_missing")).alias("missing_postal_population"),
            _count_if(F.col("_f_missing_before")).alias("missing_postal_before"),
            _count_if(F.col("_c_fillable")).alias("fillable_from_mapping"),
            _count_if(F.col("_c_available")).alias("available_from_mapping"),
            _count_if(F.col("_c_filled")).alias("pulled_from_mapping"),
            _count_if(F.col("_f_missing")).alias("missing_postal"),
            _count_if(~has_email).alias("dropped_null_email"),
            ce(F.lit(True)).alias("rows_with_email"),
            ce(F.col("_ca_rows")).alias("ca_rows"),
            ce(F.col("_p_ca")).alias("ca_population"),
            ce(F.col("_f_ca")).alias("ca_postal"),
            ce(F.col("_us_rows")).alias("us_rows"),
            ce(F.col("_c_autocorrectable_before")).alias("us_autocorrectable_before"),
            ce(F.col("_c_autocorrected")).alias("us_autocorrected"),
            ce(F.col("_p_us")).alias("us_population"),
            ce(F.col("_c_autocorrectable")).alias("us_autocorrectable"),
            ce(F.col("_f_us")).alias("us_postal"),
            ce(F.col("_f_no_token")).alias("no_token"),
            ce(F.col("is_duplicate_token")).alias("duplicate_tokens"),
            ce(F.col("_dup_card_id") & F.lit(self.options.provider == "stripe")).alias("duplicate_card_ids"),
            ce(F.col("_row_failed")).alias("removed"),
            ce(~F.col("_row_failed")).alias("success"),
            ce(F.col("_row_failed") & F.col("_first")).alias("failed_subscriber_rows"),
            *[ce(F.col(n)).alias(n) for r in self.user_rules(R.JOINED) for n in r.flags],
        ]

    @cached_property
    def duplicate_counts(self) -> DataFrame:
        """F3/F4 counts: rows sharing a subscription id / an email, without the wide join."""
        counts = rows_in_groups_counts(self.group_fan, {"duplicate_subscription_ids": "sid", "duplicate_emails": "_email"})
        return counts.withColumn("duplicate_emails", F.lit(0).cast("long")) if self.options.anonymising else counts

    def _long(self, df: DataFrame, names: list[str]) -> DataFrame:
        stack = ", ".join(f"'{n}', cast(`{n}` AS bigint)" for n in names)
        return df.selectExpr(f"stack({len(names)}, {stack}) AS (metric, value)")

    def metric_rows(self, names: list[str] | None = None) -> DataFrame:
        """The named counts (default: all) as (metric, value) rows; one aggregate per grain that has
        one of them, and none for the others."""
        parts = [(df, [c for c in df.columns if names is None or c in names])
                 for df in (self.subscriber_counts, self.joined_counts, self.duplicate_counts)]
        return reduce(DataFrame.unionByName, [self._long(df, cols) for df, cols in parts if cols])

    @cached_property
    def metrics(self) -> DataFrame:
        """Every count of the run as (metric, value) rows; small, one aggregate per grain."""
        return self.metric_rows()

    def fetch_metrics(self) -> "Migration":
        """Count once per run and serve every later summary from that table (one row per metric name, a number fixed
        by the code, never by the data). After ``materialize`` all but the duplicate counts are there already."""
        long = self._long(self.duplicate_counts, self.duplicate_counts.columns) if self._observed else self.metric_rows()
        self._fetched = True
        rows = [tuple(r) for r in long.collect()] + list(self._observed.items())
        self.__dict__["metrics"] = long.sparkSession.createDataFrame(rows, "metric string, value long")
        return self

    def wide_metrics(self, names: list[str]) -> DataFrame:
        """The chosen metrics pivoted into one row (no cross join: a grouped pivot of the long form)."""
        long = self.metrics if self._fetched else self.metric_rows(names)
        return (long.where(F.col("metric").isin(*names))
                .groupBy().pivot("metric", names).agg(F.first("value")))

    @cached_property
    def run_summary(self) -> DataFrame:
        """The run summary; ``total_processed`` is the number of rows left after removal."""
        names = ["n_subscribers", "dropped_null_key", "dropped_null_email", "rows_with_email", "success",
                 "no_token", "duplicate_tokens", "duplicate_card_ids", "duplicate_subscription_ids",
                 "duplicate_emails", "removed", "failed_subscriber_rows"]
        w = self.wide_metrics(names)
        return w.select(
            F.lit(self.options.environment).alias("environment"),
            F.col("n_subscribers").alias("total_input"),
            "dropped_null_key", "dropped_null_email",
            F.col("rows_with_email").alias("joined_rows"),
            F.col("success").alias("success_count"),
            F.col("no_token").alias("no_tokens_count"),
            F.col("duplicate_tokens").alias("duplicate_tokens_count"),
            (F.col("duplicate_card_ids") if self.options.provider == "stripe" else F.lit(None).cast("long"))
            .alias("duplicate_card_ids_count"),
            F.col("duplicate_subscription_ids").alias("duplicate_external_subscription_ids_count"),
            F.col("duplicate_emails").alias("duplicate_emails_count"),
            F.col("success").alias("total_processed"),
            F.col("removed").alias("removed_rows"),
            F.col("failed_subscriber_rows"),
        )
