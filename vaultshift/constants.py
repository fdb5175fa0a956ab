"""Fixed values of the migration format.

Everything in this module is a value that must stay equal to the documented import format for the
results to be right: column names, code sets, layouts and patterns. They are stated once, in natural
order, and the rest of the package refers to them by name.
"""

from __future__ import annotations

import re

# ---------------------------------------------------------------------------------------------
# FIXED VALUES — subscriber export header (36 required names, in file order)
# ---------------------------------------------------------------------------------------------
REQUIRED_SUBSCRIBER_COLUMNS = (
    "customer_email",
    "customer_full_name",
    "customer_external_id",
    "business_tax_identifier",
    "business_name",
    "business_company_number",
    "business_external_id",
    "address_country_code",
    "address_street_line1",
    "address_street_line2",
    "address_city",
    "address_region",
    "address_postal_code",
    "address_external_id",
    "status",
    "currency_code",
    "started_at",
    "paused_at",
    "collection_mode",
    "enable_checkout",
    "purchase_order_number",
    "additional_information",
    "payment_terms_frequency",
    "payment_terms_interval",
    "current_period_started_at",
    "current_period_ends_at",
    "trial_period_frequency",
    "trial_period_interval",
    "subscription_external_id",
    "card_token",
    "discount_id",
    "discount_remaining_cycles",
    "subscription_custom_data_key_1",
    "subscription_custom_data_value_1",
    "price_id_1",
    "quantity_1",
)

# FIXED VALUES — optional numbered columns (prefix match, as the format's checker does)
OPTIONAL_COLUMN_PATTERNS = (
    r"subscription_custom_data_key_\d+",
    r"subscription_custom_data_value_\d+",
    r"price_id_\d+",
    r"quantity_\d+",
)

# FIXED VALUES — countries the target platform cannot bill (exact, case-sensitive codes)
UNSUPPORTED_COUNTRIES = (
    "AF", "AQ", "BY", "MM", "CF", "CU", "CD", "HT", "IR", "IQ", "LY", "ML",
    "AN", "NI", "KP", "RU", "SO", "SS", "SD", "SY", "VE", "YE", "ZW",
)

# FIXED VALUES — countries where a postal code is required (exact, case-sensitive codes)
POSTAL_REQUIRED_COUNTRIES = ("AU", "CA", "FR", "DE", "IN", "IT", "NL", "ES", "GB", "US")

# FIXED VALUES — Canadian postal code letters: first letter of the FSA, and every other letter
CA_POSTAL_FIRST_LETTERS = "ABCEGHJKLMNPRSTVXY"
CA_POSTAL_OTHER_LETTERS = "ABCEGHJKLMNPRSTVWXYZ"
CA_POSTAL_PATTERN = (
    f"^[{CA_POSTAL_FIRST_LETTERS}][0-9][{CA_POSTAL_OTHER_LETTERS}] ?"
    f"[0-9][{CA_POSTAL_OTHER_LETTERS}][0-9]$"
)

# FIXED VALUES — timestamp shape accepted for subscription dates: YYYY-MM-DDTHH:MM:SSZ
ISO_Z_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z$"
ISO_Z_FRACTIONAL_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}[.][0-9]+Z$"
ISO_Z_SPARK_FORMAT = "yyyy-MM-dd'T'HH:mm:ssX"
DATE_COLUMNS_WITH_FRACTION_FIX = (
    "started_at",
    "paused_at",
    "current_period_started_at",
    "current_period_ends_at",
)

# FIXED VALUES — text tokens treated as blank by the rules (compared after strip + lower)
BLANK_TOKENS = ("nan", "none", "nat", "")

# FIXED VALUES — tokens read as null in the vault mapping file (the common CSV NA list)
MAPPING_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# FIXED VALUES — null marker of the subscriber export
SUBSCRIBER_NULL_TOKEN = "_"

# FIXED VALUES — anonymised email shape (sandbox only); the domain is a run option
ANON_EMAIL_PREFIX = "blackhole+"
ANON_EMAIL_DEFAULT_DOMAIN = "example.com"
ANON_EMAIL_TOKEN_LEN = 5
ANON_EMAIL_ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789"

# FIXED VALUES — vault name that is always written in lower case
VAULT_LOWERCASE_NAME = "tokenex"

# FIXED VALUES — Stripe vault mapping header and the names it takes before the join
STRIPE_MAPPING_RENAMES = {
    "card.id": "card_id",
    "card.transaction_ids": "network_transaction_id",
    "card.number": "card_token",
    "card.name": "card_holder_name",
    "card.exp_month": "card_expiry_month",
    "card.exp_year": "card_expiry_year",
}
STRIPE_MAPPING_PASSTHROUGH = (
    "description",
    "name",
    "card.address_city",
    "card.address_country",
    "card.address_line1",
    "card.address_line2",
    "card.address_state",
    "card.address_zip",
)
STRIPE_MAPPING_ZIP = "card.address_zip"

# FIXED VALUES — Bluesnap vault mapping header
BLUESNAP_ACCOUNT = "BlueSnap Account Id"
BLUESNAP_CARD_NUMBER = "Credit Card Number"
BLUESNAP_FIRST_NAME = "First Name"
BLUESNAP_LAST_NAME = "Last Name"
BLUESNAP_MAPPING_RENAMES = {
    "Expiration Month": "card_expiry_month",
    "Expiration Year": "card_expiry_year",
    "Network Transaction Id": "network_transaction_id",
}
BLUESNAP_MAPPING_ZIP = "Zip Code"

# FIXED VALUES — Stripe import layout (fixed head; numbered columns and vault_provider follow)
STRIPE_LAYOUT_HEAD = (
    "description",
    "name",
    "card.address_city",
    "card.address_country",
    "card.address_line1",
    "card.address_line2",
    "card.address_state",
    "card.address_zip",
    "card_expiry_month",
    "card_expiry_year",
    "card_id",
    "card_holder_name",
    "card_token",
    "network_transaction_id",
    "customer_email",
    "customer_full_name",
    "customer_external_id",
    "business_tax_identifier",
    "business_name",
    "business_company_number",
    "business_external_id",
    "address_country_code",
    "address_street_line1",
    "address_street_line2",
    "address_city",
    "address_region",
    "address_postal_code",
    "address_external_id",
    "status",
    "currency_code",
    "started_at",
    "paused_at",
    "collection_mode",
    "enable_checkout",
    "purchase_order_number",
    "additional_information",
    "payment_terms_frequency",
    "payment_terms_interval",
    "current_period_started_at",
    "current_period_ends_at",
    "trial_period_frequency",
    "trial_period_interval",
    "subscription_external_id",
    "discount_id",
    "discount_remaining_cycles",
)

# FIXED VALUES — Bluesnap import layout (fixed head; numbered columns and vault_provider follow)
BLUESNAP_LAYOUT_HEAD = (
    "card_token",
    "card_holder_name",
    "card_expiry_month",
    "card_expiry_year",
    "network_transaction_id",
    "customer_email",
    "customer_full_name",
    "customer_external_id",
    "business_tax_identifier",
    "business_name",
    "business_company_number",
    "business_external_id",
    "address_country_code",
    "address_street_line1",
    "address_street_line2",
    "address_city",
    "address_region",
    "address_postal_code",
    "address_external_id",
    "status",
    "currency_code",
    "started_at",
    "paused_at",
    "collection_mode",
    "enable_checkout",
    "purchase_order_number",
    "additional_information",
    "payment_terms_frequency",
    "payment_terms_interval",
    "current_period_started_at",
    "current_period_ends_at",
    "trial_period_frequency",
    "trial_period_interval",
    "subscription_external_id",
    "discount_id",
    "discount_remaining_cycles",
)

# FIXED VALUES — step names of the validation summary, in the order the run reports them
STEP_COLUMNS = "column_validation"
STEP_COUNTRY_FORMAT = "address_country_code_validation"
STEP_PRICE_ID = "price_id_validation"
STEP_UNSUPPORTED = "unsupported_countries_validation"
STEP_DATE_FORMAT = "date_format_validation"
STEP_DATE_PERIOD = "date_validation"
STEP_CARD_TOKEN = "card_token_validation"
STEP_MISSING_POSTAL = "missing_zip_code_validation"
STEP_CA_POSTAL = "ca_zip_code_validation"
STEP_US_POSTAL = "us_zip_code_validation"
STEP_DUP_TOKENS = "duplicate_tokens"
STEP_DUP_SUBSCRIPTIONS = "duplicate_external_subscription_ids"
STEP_DUP_EMAILS = "duplicate_emails"
STEP_DUP_CARD_IDS = "duplicate_card_ids"
STEP_NO_TOKEN = "no_token_found"
STEP_SUCCESS = "successfully_mapped_records"

# FIXED VALUES — report file stems
REPORT_FINAL_IMPORT = "final_import"
REPORT_NO_TOKEN = "no_token_found"
REPORT_DUP_TOKENS = "duplicate_tokens"
REPORT_DUP_SUBSCRIPTIONS = "duplicate_external_subscription_ids"
REPORT_DUP_EMAILS = "duplicate_emails"
REPORT_DUP_CARD_IDS = "duplicate_card_ids"
REPORT_COUNTRY_FORMAT = "invalid_address_country_codes"
REPORT_PRICE_ID = "invalid_price_ids"
REPORT_UNSUPPORTED = "unsupported_countries"
REPORT_DATE_FORMAT = "invalid_date_formats"
REPORT_DATE_PERIOD = "invalid_date_periods"
REPORT_MISSING_POSTAL = "missing_zip_codes"
REPORT_CA_POSTAL = "invalid_ca_zip_codes"
REPORT_US_POSTAL = "invalid_us_zip_codes"
REPORT_CARD_TOKEN_LENGTH = "incorrect_card_tokens"

PROVIDERS = ("stripe", "bluesnap")

_NUMBERED = {
    "price_id": re.compile(r"^price_id_(\d+)$"),
    "quantity": re.compile(r"^quantity_(\d+)$"),
    "custom_key": re.compile(r"^subscription_custom_data_key_(\d+)$"),
    "custom_value": re.compile(r"^subscription_custom_data_value_(\d+)$"),
}


def numbered_index(kind: str, name: str) -> int | None:
    """Index N of a numbered column such as ``price_id_N``; None when ``name`` is not one."""
    m = _NUMBERED[kind].match(name)
    return int(m.group(1)) if m else None

# FIXED VALUES: texts of the run's messages, by step: (count they speak of, SQL expression of the text).
MESSAGES = {
    STEP_DUP_TOKENS: ("duplicate_tokens", "concat('Found ', CAST(duplicate_tokens AS STRING), "
                        "' records with duplicate card tokens.')"),
    STEP_DUP_SUBSCRIPTIONS: ("duplicate_subscription_ids", "concat('Found ', CAST(duplicate_subscription_ids AS STRING), "
                               "' records with duplicate external subscription IDs.')"),
    STEP_DUP_EMAILS: ("duplicate_emails", "concat('Found ', CAST(duplicate_emails AS STRING), "
                        "' records with duplicate customer emails.')"),
    STEP_DUP_CARD_IDS: ("duplicate_card_ids", "concat('Found ', CAST(duplicate_card_ids AS STRING), "
                          "' records with duplicate card IDs.')"),
    STEP_NO_TOKEN: ("no_token", "CASE WHEN no_token > 0 THEN concat('Found ', CAST(no_token AS STRING), "
                      "' records with no matching token in mapping file.') "
                      "ELSE 'All records have matching tokens in mapping file.' END"),
    STEP_SUCCESS: ("success", "concat('Successfully mapped ', CAST(success AS STRING), ' records ready for import.')"),
}
