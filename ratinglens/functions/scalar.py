"""Scalar building blocks: key construction and parsing, number and date
conversion, JSON encoding of rating reports, counter decoding.

Keys are built with ``concat`` (NULL in any part gives a NULL key), never
``concat_ws`` which would silently skip a NULL part.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ratinglens.schemas import SUBMISSION, SUBMISSION_FIELDS

# Key part separator and the speed-layer update log text.
SEP = "_"
UPDATE_MESSAGE_PREFIX = "Updated speed layer for player"


def _s(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")


def history_key(fide_id="fide_id", year="year", month="month") -> Column:
    """Row key of the monthly history view, in the order it is built:
    ``fide_id_year_month``."""
    return F.concat(_s(fide_id), F.lit(SEP), _s(year), F.lit(SEP), _s(month))


def player_year_key(fide_id="fide_id", year="year") -> Column:
    return F.concat(_s(fide_id), F.lit(SEP), _s(year))


def fed_year_key(federation="federation", year="year") -> Column:
    return F.concat(_s(federation), F.lit(SEP), _s(year))


def name_key(first="first_name", last="last_name", fide_id="fide_id") -> Column:
    """Row key of the name-search view: ``first_last_fideid``."""
    return F.concat(_s(first), F.lit(SEP), _s(last), F.lit(SEP), _s(fide_id))


def parse_player_month(key: str) -> tuple[str, int, int] | None:
    """Parse a user-typed ``ID_month_year`` lookup string (a parameter, not
    data) into typed key parts, so the lookup filter reaches the scan; None
    if it is not such a key."""
    parts = key.strip().split(SEP)
    if len(parts) != 3:
        return None
    try:
        return parts[0], int(parts[1]), int(parts[2])
    except ValueError:
        return None


def player_month_parts(key) -> tuple[Column, Column, Column]:
    """Column form of :func:`parse_player_month` for bulk lookups:
    ``ID_month_year`` → (fide_id, year, month); malformed parts give NULL."""
    key = F.col(key) if isinstance(key, str) else key
    parts = F.split(key, SEP)
    fide_id = F.get(parts, 0)
    month = F.get(parts, 1).try_cast("bigint")
    year = F.get(parts, 2).try_cast("bigint")
    ok = F.size(parts) == 3
    return (
        F.when(ok, fide_id),
        F.when(ok, year),
        F.when(ok, month),
    )


def strip_prefix(c, prefix: str, strict: bool = False) -> Column:
    """Remove a required prefix; NULL when absent (or an error if strict)."""
    c = F.col(c) if isinstance(c, str) else c
    stripped = F.substring(c, len(prefix) + 1, 1 << 30)
    missing = F.raise_error(F.lit(f"missing prefix {prefix}")) if strict else F.lit(None)
    return F.when(c.startswith(prefix), stripped).otherwise(missing)


def drop_first(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.substring(c, 2, 1 << 30)


def pad_month(month="month") -> Column:
    return F.lpad(_s(month), 2, "0")


def to_number(c) -> Column:
    """Text → BIGINT; text that is not a number gives NULL (never an error)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(c).try_cast("bigint")


def first_of_month(year="year", month="month") -> Column:
    """First of the month; NULL for a month or year that does not exist."""
    y = F.col(year) if isinstance(year, str) else year
    m = F.col(month) if isinstance(month, str) else month
    return F.when(m.between(1, 12) & y.between(1, 9999), F.make_date(y.cast("int"), m.cast("int"), F.lit(1)))


def first_of_year(year="year") -> Column:
    """First of January; NULL for a year outside 1–9999 (never an error)."""
    y = F.col(year) if isinstance(year, str) else year
    return F.when(y.between(1, 9999), F.make_date(y.cast("int"), F.lit(1), F.lit(1)))


def be_long(c) -> Column:
    """8-byte big-endian binary counter → BIGINT (two's complement)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.conv(F.hex(c), 16, -10).cast("bigint")


def be_bytes(c) -> Column:
    """BIGINT → 8-byte big-endian binary (a counter cell)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.unhex(F.lpad(F.hex(c.cast("bigint")), 16, "0"))


def report_json(*cols: str) -> Column:
    """Encode a rating report (all fields as strings) as one JSON text."""
    names = list(cols) or SUBMISSION_FIELDS
    return F.to_json(F.struct(*[_s(n).alias(n) for n in names]))


def parse_reports(value="value") -> Column:
    """JSON text → report struct. Malformed text yields a struct whose fields
    are all NULL; unknown fields are ignored."""
    v = F.col(value) if isinstance(value, str) else value
    return F.from_json(v, SUBMISSION, {"mode": "PERMISSIVE"})


# Why a message is rejected.
BAD_JSON, UNKNOWN_FIELD, NO_ID = "bad_json", "unknown_field", "no_id"


def reject_reason(value="value", strict: bool = False) -> Column:
    """Why a message carries no report; NULL if it carries one.

    ``bad_json``: no text, or text that is not one JSON object, or whose fields
    do not parse (the corrupt-record column of the parser); ``unknown_field``
    (only if ``strict``): a field that a report does not have; ``no_id``: no
    ``fide_id``."""
    v = F.col(value) if isinstance(value, str) else value
    checked = StructType([*SUBMISSION.fields, StructField("_corrupt", StringType())])
    parsed = F.from_json(v, checked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    fields = F.json_object_keys(v)
    bad = fields.isNull() | parsed["_corrupt"].isNotNull()
    unknown = F.size(F.array_except(fields, F.array(*map(F.lit, SUBMISSION_FIELDS)))) > 0
    reason = F.when(bad, BAD_JSON)
    if strict:
        reason = reason.when(unknown, UNKNOWN_FIELD)
    return reason.when(parsed["fide_id"].isNull(), NO_ID)


def update_message(fide_id="fide_id") -> Column:
    return F.concat(F.lit(UPDATE_MESSAGE_PREFIX), _s(fide_id))
