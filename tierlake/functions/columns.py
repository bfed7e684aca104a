"""Column expressions for cleaning, casting and deriving values.

Everything here is a built-in Spark expression: it stays inside whole-stage code generation,
never raises on dirty input under ANSI mode, and depends on no clock (run times are arguments).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for "missing" (case-sensitive), and the label for unknown values.
NULL_TOKENS = ("nan", "None", "NaT", "null", "NULL")
UNKNOWN = "DESCONOCIDO"

_ISO_DATE_PREFIX = r"^\d{4}-\d{2}-\d{2}"
_WHOLE_WITH_ZERO_FRACTION = r"^\d+\.0+$"
_SCIENTIFIC = r"^\d+(\.\d+)?[eE]\+?\d+$"


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _trimmed(value: str | Column) -> Column:
    return F.trim(_col(value).cast("string"))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


_MISSING = ", ".join(f"'{token}'" for token in ("", *NULL_TOKENS))


def null_like(value: str | Column) -> Column:
    """True for NULL, blank text and the missing-value tokens. Never NULL itself."""
    if isinstance(value, str):
        # One parsed expression instead of a dozen calls into the JVM: these two functions make
        # up most of an entity's plan.
        c = _quoted(value)
        return F.expr(f"{c} IS NULL OR trim(CAST({c} AS STRING)) IN ({_MISSING})")
    text = _trimmed(value)
    return text.isNull() | text.isin("", *NULL_TOKENS)


def clean_text(value: str | Column) -> Column:
    """Trimmed text, or NULL when the value is null-like."""
    if isinstance(value, str):
        text = f"trim(CAST({_quoted(value)} AS STRING))"
        return F.expr(f"CASE WHEN {text} NOT IN ({_MISSING}) THEN {text} END")
    return F.when(~null_like(value), _trimmed(value))


def known_text(value: str | Column, unknown: str = UNKNOWN) -> Column:
    """Trimmed text, with a label in place of missing values."""
    return F.coalesce(clean_text(value), F.lit(unknown))


def parse_timestamp(value: str | Column) -> Column:
    """Timestamp from text, or NULL.

    Spark reads a bare time as *today* and a bare year as January 1st, so text must start with a
    full ISO date to count.
    """
    text = clean_text(value)
    return F.when(text.rlike(_ISO_DATE_PREFIX), F.try_to_timestamp(text))


def parse_date(value: str | Column) -> Column:
    return F.to_date(parse_timestamp(value))


def as_utc(value: str | Column, zone: str | Column | None = None) -> Column:
    """Naive UTC time of a zoned timestamp.

    With ``zone`` the value is local wall-clock time there; without it, the value is text with
    its own offset (or none, meaning UTC).
    """
    stamp = parse_timestamp(value)
    return stamp if zone is None else F.to_utc_timestamp(stamp, zone)


def decimal_or_null(value: str | Column, precision: int, scale: int) -> Column:
    return _col(value).try_cast(f"decimal({precision},{scale})")


def money(value: str | Column) -> Column:
    return decimal_or_null(value, 18, 2)


def measure(value: str | Column) -> Column:
    """Four-decimal measurement; null-like or unparseable text gives NULL."""
    return decimal_or_null(clean_text(value), 18, 4)


def canonical_number(value: str | Column) -> Column:
    """Plain digits for whole numbers written as ``123.0`` or ``1.23E5``; other text unchanged."""
    text = clean_text(value)
    whole = text.try_cast("decimal(38,0)")
    # Compared at one type: mixing scales would let Spark round the fraction away first.
    exact = text.try_cast("decimal(38,12)")
    widened = text.rlike(_WHOLE_WITH_ZERO_FRACTION) | text.rlike(_SCIENTIFIC)
    integral = exact == whole.try_cast("decimal(38,12)")
    return F.when(widened & integral, whole.cast("string")).otherwise(text)


def row_hash(columns: Iterable[str]) -> Column:
    """SHA-256 hex of the columns' texts joined by ``|``, NULL counted as empty text."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat_ws("|", *parts), 256)


def content_hash(columns: Iterable[str]) -> Column:
    """Hash for change detection: no two different rows of values share their hashed text.

    JSON keeps NULL, empty text and separators inside values apart, which ``row_hash`` (a column
    with a prescribed value) does not.
    """
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in columns])), 256)


def pseudonym(value: str | Column, salt: str | None = None) -> Column:
    """SHA-256 hex standing in for a direct identifier. NULL stays NULL."""
    text = _col(value).cast("string")
    return F.sha2(text if salt is None else F.concat(F.lit(salt), text), 256)


def keyed_pseudonym(value: str | Column, key: bytes) -> Column:
    """HMAC-SHA-256 hex standing in for a direct identifier. NULL stays NULL.

    Short numbers can be found from a plain or prefixed hash by trying them all; without the key
    they cannot be found from this. The padded key is a literal of the plan, so plans and event
    logs of such a session should be kept like the key itself.
    """
    if not key:
        raise ValueError("a pseudonym needs a key")
    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = (bytes(b ^ pad for b in block) for pad in (0x36, 0x5C))
    digest = F.sha2(F.concat(F.lit(inner), F.encode(_col(value).cast("string"), "UTF-8")), 256)
    return F.sha2(F.concat(F.lit(outer), F.unhex(digest)), 256)


def age_in_years(born: str | Column, as_of: date | Column) -> Column:
    reference = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return F.floor(F.datediff(reference, _col(born)) / F.lit(365.25)).cast("int")


def only_when(condition: Column, value: str | Column) -> Column:
    """The value where the condition holds, otherwise NULL."""
    return F.when(condition, _col(value))


def is_set(value: str | Column) -> Column:
    return _col(value).isNotNull()


def in_domain_or(value: str | Column, domain: Iterable[str], other: str) -> Column:
    """Values outside the domain become ``other``; NULL stays NULL."""
    c = _col(value)
    return F.when(c.isNull() | c.isin(*domain), c).otherwise(F.lit(other))


def amounts_balance(gross: str | Column, discount: str | Column, net: str | Column) -> Column:
    """Does gross - discount equal net at two decimals? NULL when an amount is missing."""
    return F.round(_col(gross) - _col(discount), 2) == F.round(_col(net), 2)


def non_negative(*amounts: str | Column) -> Column:
    verdict = F.lit(True)
    for amount in amounts:
        verdict = verdict & (_col(amount) >= 0)
    return verdict


def date_key(day: str | Column) -> Column:
    """Integer ``yyyyMMdd``, by arithmetic rather than by formatting and parsing text."""
    d = _col(day)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def to_flag(condition: str | Column) -> Column:
    """0/1 measure of a boolean."""
    return _col(condition).cast("int")


def ratio(numerator: str | Column, denominator: str | Column, digits: int) -> Column:
    """Rounded quotient; NULL when the denominator is zero."""
    return F.round(_col(numerator) / F.nullif(_col(denominator), F.lit(0)), digits)


def zero_filled(value: str | Column) -> Column:
    return F.coalesce(_col(value), F.lit(0))


def value_shape(value: str | Column) -> Column:
    """Class of a text's form, for profiling columns that mix types."""
    text = clean_text(value)
    return (
        F.when(text.isNull(), "missing")
        .when(text.rlike(r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?$"), "date")
        .when(text.rlike(r"^\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?$"), "time")
        .when(text.rlike(r"^[+-]?\d+$"), "integer")
        .when(text.rlike(r"^[+-]?(\d+\.\d*|\.\d+)([eE][+-]?\d+)?$"), "decimal")
        .otherwise("text")
    )
