"""Column expressions for post text and keys (no shuffle, all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour.
# URL removal pattern applied after line breaks are flattened.
URL_PATTERN = r"\(?http[^ ]+\)?"
# Python 3 Unicode ``\w``: letters, numbers (incl. No/Nl such as ² ½) and "_".
WORD_PATTERN = r"([\p{L}\p{N}_]+)"
# Posts at or under this many characters (after sanitizing) get no label.
MIN_LABEL_CHARS = 10
DELETED_BODY = "[deleted]"
# Community share threshold exp(-sqrt(total) / 4) + 0.015.
THRESHOLD_SCALE = 4.0
THRESHOLD_FLOOR = 0.015
# Thread score cut-off.
THREAD_SCORE_CUTOFF = 0.1
# Thread key prefix of submissions ("t3_" + submission id).
THREAD_PREFIX = "t3_"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sanitize(c) -> Column:
    """Delete carriage returns, turn line feeds into blanks, delete URLs."""
    c = F.replace(F.replace(_col(c), F.lit("\r"), F.lit("")), F.lit("\n"), F.lit(" "))
    # The pattern tries every character; most texts hold no URL.
    return F.when(c.contains("http"), F.regexp_replace(c, URL_PATTERN, "")).otherwise(c)


def is_too_short(c, n: int = MIN_LABEL_CHARS) -> Column:
    """True when a sanitized text is too short (or deleted) to be labelled."""
    c = _col(c)
    return (F.length(c) <= n) | (c == F.lit(DELETED_BODY))


def words(c) -> Column:
    """All word tokens of a text, duplicates kept, in text order."""
    return F.regexp_extract_all(_col(c), F.lit(WORD_PATTERN), 1)


def blank_length(c) -> Column:
    """Number of pieces when splitting on single blanks (``''`` gives 1)."""
    return F.size(F.split(_col(c), " "))


def thread_key(kind, post_id, link_id) -> Column:
    """Thread key of a post: ``t3_<id>`` for submissions, ``link_id`` otherwise."""
    return F.when(_col(kind) == F.lit("submission"),
                  F.concat(F.lit(THREAD_PREFIX), _col(post_id))).otherwise(_col(link_id))


def bare_id(c) -> Column:
    """Strip the type prefix of a full id (``t3_abc`` -> ``abc``)."""
    return F.substring_index(_col(c), "_", -1)


def epoch_date(c) -> Column:
    """UTC calendar date of epoch seconds, independent of the session zone."""
    return F.date_from_unix_date(F.floor(_col(c).cast("bigint") / F.lit(86400)).cast("int"))


def epoch_month(c) -> Column:
    """``yyyy-MM`` batch key of epoch seconds (UTC)."""
    return F.date_format(epoch_date(c), "yyyy-MM")


def epoch_timestamp(c) -> Column:
    """Epoch seconds (int or numeric string) as a timestamp."""
    return F.timestamp_seconds(_col(c).cast("bigint"))


def share_threshold(total, scale: float = THRESHOLD_SCALE,
                    floor: float = THRESHOLD_FLOOR) -> Column:
    """Size-dependent minimum share: ``exp(-sqrt(total) / scale) + floor``."""
    return F.exp(-F.sqrt(_col(total).cast("double")) / F.lit(scale)) + F.lit(floor)


def fill_na(c, value: str = "NA") -> Column:
    """Metadata rendering: missing values become ``NA``."""
    return F.coalesce(_col(c).cast("string"), F.lit(value))


# Characters that would end a field or line of a table without quotes, and what stands for them.
FIELD_ESCAPES = (("\t", r"\t"), ("\n", r"\n"), ("\r", r"\r"), ("\0", r"\0"))


def escape_field(c) -> Column:
    """A value in which no tab, line end or NUL is left; :func:`unescape_field` restores it."""
    c = F.replace(_col(c), F.lit("\\"), F.lit("\\\\"))
    for raw, escaped in FIELD_ESCAPES:
        c = F.replace(c, F.lit(raw), F.lit(escaped))
    return c


def unescape_field(c) -> Column:
    """The value that :func:`escape_field` was given. Other backslashes stay as they are."""
    c = _col(c)
    # A doubled backslash is set aside as NUL, which no escaped value holds, so that it begins no escape.
    out = F.replace(c, F.lit("\\\\"), F.lit("\0"))
    for raw, escaped in FIELD_ESCAPES[:-1]:
        out = F.replace(out, F.lit(escaped), F.lit(raw))
    pieces = F.transform(F.split(out, "\0"), lambda p: F.replace(p, F.lit(r"\0"), F.lit("\0")))
    return F.when(c.contains("\\"), F.array_join(pieces, "\\")).otherwise(c)


def py_bool_text(c) -> Column:
    """Render a nullable boolean the way the TSV sinks expect (True/False/None)."""
    c = _col(c)
    return F.when(c.isNull(), F.lit("None")).when(c, F.lit("True")).otherwise(F.lit("False"))
