from tierlake.functions.columns import (
    NULL_TOKENS,
    UNKNOWN,
    age_in_years,
    amounts_balance,
    as_utc,
    canonical_number,
    clean_text,
    content_hash,
    date_key,
    decimal_or_null,
    in_domain_or,
    is_set,
    keyed_pseudonym,
    known_text,
    measure,
    money,
    non_negative,
    null_like,
    only_when,
    parse_date,
    parse_timestamp,
    pseudonym,
    ratio,
    row_hash,
    to_flag,
    value_shape,
    zero_filled,
)

__all__ = [
    "NULL_TOKENS",
    "UNKNOWN",
    "age_in_years",
    "amounts_balance",
    "as_utc",
    "canonical_number",
    "clean_text",
    "content_hash",
    "date_key",
    "decimal_or_null",
    "in_domain_or",
    "is_set",
    "keyed_pseudonym",
    "known_text",
    "measure",
    "money",
    "non_negative",
    "null_like",
    "only_when",
    "parse_date",
    "parse_timestamp",
    "pseudonym",
    "ratio",
    "row_hash",
    "to_flag",
    "value_shape",
    "zero_filled",
]
