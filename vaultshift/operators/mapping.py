"""Vault-mapping shaping (B5, B14-B17) into one canonical set of columns.

Both providers become ``_key`` (join key), ``_m_uid`` (stable row id for salting), ``_m_token``,
``_m_holder``, ``_m_exp_month``, ``_m_exp_year``, ``_m_ntx``, ``_m_zip`` plus, for Stripe, the card
address extras carried into the import layout. Rows with a null key are dropped here: they can only
produce mapping-only joined rows, which the run discards (they carry no email).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultshift import constants as K
from vaultshift.functions import text as T

# Internal names of the Stripe card extras, keyed by their layout names.
STRIPE_EXTRAS = {name: "_m_x_" + name.replace(".", "_") for name in K.STRIPE_MAPPING_PASSTHROUGH}

CANONICAL = ("_key", "_m_uid", "_m_token", "_m_holder", "_m_exp_month", "_m_exp_year", "_m_ntx", "_m_zip")


def _get(df: DataFrame, name: str) -> Column:
    if name in df.columns:
        return T.mapping_null_normalise(T.col_of(name).cast("string"))
    return F.lit(None).cast("string")


def stripe(df: DataFrame) -> DataFrame:
    """Stripe layout: ``card.id`` is the key, ``card.number`` the token, ``card.name`` the holder."""
    r = {v: k for k, v in K.STRIPE_MAPPING_RENAMES.items()}
    out = df.select(
        _get(df, r["card_id"]).alias("_key"),
        F.monotonically_increasing_id().alias("_m_uid"),
        _get(df, r["card_token"]).alias("_m_token"),
        _get(df, r["card_holder_name"]).alias("_m_holder"),
        _get(df, r["card_expiry_month"]).alias("_m_exp_month"),
        _get(df, r["card_expiry_year"]).alias("_m_exp_year"),
        _get(df, r["network_transaction_id"]).alias("_m_ntx"),
        _get(df, K.STRIPE_MAPPING_ZIP).alias("_m_zip"),
        *[_get(df, name).alias(internal) for name, internal in STRIPE_EXTRAS.items()],
    )
    return out.where(F.col("_key").isNotNull())


def bluesnap(df: DataFrame) -> DataFrame:
    """Bluesnap layout: key = account id + last four characters of the card number; the holder is
    ``strip(first) + ' ' + strip(last)`` (null when either is null); the token is the full number."""
    acct, card = _get(df, K.BLUESNAP_ACCOUNT), _get(df, K.BLUESNAP_CARD_NUMBER)
    first, last = _get(df, K.BLUESNAP_FIRST_NAME), _get(df, K.BLUESNAP_LAST_NAME)
    r = {v: k for k, v in K.BLUESNAP_MAPPING_RENAMES.items()}
    out = df.select(
        F.concat(acct, F.right(card, F.lit(4))).alias("_key"),
        F.monotonically_increasing_id().alias("_m_uid"),
        card.alias("_m_token"),
        F.concat(T.py_strip(first), F.lit(" "), T.py_strip(last)).alias("_m_holder"),
        _get(df, r["card_expiry_month"]).alias("_m_exp_month"),
        _get(df, r["card_expiry_year"]).alias("_m_exp_year"),
        _get(df, r["network_transaction_id"]).alias("_m_ntx"),
        _get(df, K.BLUESNAP_MAPPING_ZIP).alias("_m_zip"),
    )
    return out.where(F.col("_key").isNotNull())


def prepare(df: DataFrame, provider: str) -> DataFrame:
    if provider == "stripe":
        return stripe(df)
    if provider == "bluesnap":
        return bluesnap(df)
    raise ValueError(f"unknown provider {provider!r}; expected one of {K.PROVIDERS}")
