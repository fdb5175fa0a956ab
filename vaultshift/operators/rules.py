"""Validation rules as boolean column expressions.

A rule is ``Rule(step, population, fails)``: two boolean columns over the rows it is evaluated on.
Rules never filter; they only flag. Removal happens once, at the end, by subscriber row.

Subscriber rules (evaluated once per subscriber row, before the join):
    C1 country format, C2 unsupported country, C3/C4 price ids and quantities,
    C5 date format, C6 date period, C14 card-token length (opt-in).
Joined-row rules (evaluated per joined row): C7 missing postal, C8 CA postal, C9 US postal,
    C10 no token; see ``vaultshift.operators.postal``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from vaultshift import constants as K
from vaultshift.functions import text as T


#: Gives the stripped value of an input column: the expression itself, or a column staged before.
Strip = Callable[[str], Column]


@dataclass(frozen=True)
class Rule:
    step: str
    population: Column
    fails: Column


SUBSCRIBER, JOINED = "subscriber", "joined"


@dataclass(frozen=True)
class UserRule:
    """A rule added by the caller, as plain columns. Flags, counts, the step, the report and the removal of failing
    subscriber rows follow from it.

    ``stage`` "subscriber": over the export's rows, with its columns. "joined": over joined rows, with the export's
    columns, the vault's as ``_m_token``, ``_m_holder``, ``_m_exp_month``, ``_m_exp_year``, ``_m_ntx`` and ``_m_zip``, and the
    repaired postal code as ``_postal_final``. A null outcome is no failure. ``population``: the rows the step counts
    (default: all). ``removes=False``: the rule reports and fails its step but removes nothing."""

    code: str
    stage: str
    fails: Column
    population: Column | None = None
    removes: bool = True

    def __post_init__(self):
        if self.stage not in (SUBSCRIBER, JOINED):
            raise ValueError(f"rule {self.code!r}: stage must be {SUBSCRIBER!r} or {JOINED!r}")
        if not self.code.isidentifier():
            raise ValueError(f"rule code {self.code!r} must be an identifier")

    @property
    def step(self) -> str:
        return f"{self.code}_validation"

    @property
    def flag(self) -> str:
        return f"_u_{self.code}"

    @property
    def flags(self) -> dict[str, Column]:
        """The failing rows and the population, never null."""
        fails = F.coalesce(self.fails, F.lit(False))
        population = F.lit(True) if self.population is None else F.coalesce(self.population, F.lit(False))
        return {self.flag: fails & population, f"{self.flag}_of": population}


def country_format(columns: set[str], strip: Strip = T.py_strip) -> Rule:
    """The country code must be two letters after strip (any case, any script)."""
    c = "address_country_code"
    if c not in columns:
        return Rule(K.STEP_COUNTRY_FORMAT, F.lit(True), F.lit(False))
    ok = ~T.is_blank(c, strip(c)) & T.full_match(strip(c), r"^\p{L}{2}$")
    return Rule(K.STEP_COUNTRY_FORMAT, F.lit(True), ~ok)


def unsupported_country(columns: set[str]) -> Rule:
    """The raw code (exact case, untrimmed) is one the target platform cannot bill."""
    c = "address_country_code"
    if c not in columns:
        return Rule(K.STEP_UNSUPPORTED, F.lit(True), F.lit(False))
    return Rule(K.STEP_UNSUPPORTED, F.lit(True), F.coalesce(T.col_of(c).isin(*K.UNSUPPORTED_COUNTRIES), F.lit(False)))


def _line_indices(columns: set[str]) -> list[int]:
    idx = set()
    for c in columns:
        for kind in ("price_id", "quantity"):
            n = K.numbered_index(kind, c)
            if n is not None:
                idx.add(n)
    return sorted(idx)


def price_ids(columns: set[str], strip: Strip = T.py_strip) -> Rule:
    """``price_id_1`` non-blank and starting ``pri_``; other filled price ids start ``pri_``."""
    if "price_id_1" not in columns:
        return Rule(K.STEP_PRICE_ID, F.lit(True), F.lit(False))
    first = T.norm_cell("price_id_1", strip("price_id_1"))
    fails = (first == "") | ~first.startswith("pri_")
    for c in sorted(columns):
        if c != "price_id_1" and K.numbered_index("price_id", c) is not None:
            v = T.norm_cell(c, strip(c))
            fails = fails | ~((v == "") | v.startswith("pri_"))
    return Rule(K.STEP_PRICE_ID, F.lit(True), fails)


def quantities(columns: set[str], strip: Strip = T.py_strip) -> Rule:
    """C4: a filled ``price_id_N`` needs ``quantity_N`` of plain digits (after normalisation)."""
    if "price_id_1" not in columns:
        return Rule(K.STEP_PRICE_ID, F.lit(True), F.lit(False))
    fails = F.lit(False)
    for i in _line_indices(columns):
        p, q = f"price_id_{i}", f"quantity_{i}"
        if p not in columns:
            continue
        filled = T.norm_cell(p, strip(p)) != ""
        if q not in columns:
            fails = fails | filled
        else:
            fails = fails | (filled & ~T.full_match(T.norm_cell(q, strip(q)), "^[0-9]+$"))
    return Rule(K.STEP_PRICE_ID, F.lit(True), fails)


def date_format(columns: set[str], strip: Strip = T.py_strip) -> Rule:
    """Period start/end have the exact ``YYYY-MM-DDTHH:MM:SSZ`` shape (not trimmed);
    ``started_at``/``paused_at`` have it when filled (trimmed)."""
    req = ("current_period_started_at", "current_period_ends_at")
    if any(c not in columns for c in req):
        return Rule(K.STEP_DATE_FORMAT, F.lit(False), F.lit(False))
    fails = F.lit(False)
    for c in req:
        fails = fails | ~(~T.is_blank(c, strip(c)) & T.full_match(T.col_of(c), K.ISO_Z_PATTERN))
    for c in ("started_at", "paused_at"):
        if c in columns:
            fails = fails | (~T.is_blank(c, strip(c)) & ~T.full_match(strip(c), K.ISO_Z_PATTERN))
    return Rule(K.STEP_DATE_FORMAT, F.lit(True), fails)


def parse_iso_z(c: str) -> Column:
    """Timestamp of a cell with the exact date shape; null for anything else (never raises)."""
    col = T.col_of(c)
    return F.when(
        T.full_match(col, K.ISO_Z_PATTERN),
        F.try_to_timestamp(col, F.lit(K.ISO_Z_SPARK_FORMAT)),
    )


def date_period(columns: set[str], as_of: Column) -> Rule:
    """Among rows where both period dates parse, start after ``as_of`` or end before it."""
    req = ("current_period_started_at", "current_period_ends_at")
    if any(c not in columns for c in req):
        return Rule(K.STEP_DATE_PERIOD, F.lit(False), F.lit(False))
    start, end = parse_iso_z(req[0]), parse_iso_z(req[1])
    population = start.isNotNull() & end.isNotNull()
    fails = population & ((start > as_of) | (end < as_of))
    return Rule(K.STEP_DATE_PERIOD, population, fails)


def card_token_length(columns: set[str]) -> Rule:
    """C14 (opt-in): a filled ``card_token`` must be exactly 13 digits."""
    if "card_token" not in columns:
        return Rule(K.STEP_CARD_TOKEN, F.lit(False), F.lit(False))
    c = T.col_of("card_token")
    population = c.isNotNull() & (c != "")
    return Rule(K.STEP_CARD_TOKEN, population, population & ~T.full_match(c, "^[0-9]{13}$"))


def subscriber_rules(columns: set[str], as_of: Column, card_token_check: bool = False, strip: Strip = T.py_strip) -> list[Rule]:
    """Subscriber-grain rules in the order the run reports them."""
    rules = [
        country_format(columns, strip),
        price_ids(columns, strip),
        quantities(columns, strip),
        unsupported_country(columns),
        date_format(columns, strip),
        date_period(columns, as_of),
    ]
    if card_token_check:
        rules.append(card_token_length(columns))
    return rules


def as_of_column(as_of: str | None) -> Column:
    """Fixed clock (``YYYY-MM-DDTHH:MM:SSZ``) or the query's current timestamp."""
    if as_of is None:
        return F.current_timestamp()
    return F.to_timestamp(F.lit(as_of), K.ISO_Z_SPARK_FORMAT)
