"""Reading and writing one access-log line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a log line, and how its time is written.
LOG_PATTERN = r'^(\S+) \S+ \[([^\]]+)\] "(\S+) (\S+) HTTP/\d\.\d" (\d{3})'
TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"
TIME_FORMAT_WITHOUT_ZONE = "dd/MMM/yyyy:HH:mm:ss"

# The pattern widened to cover the whole of any line. Lines that do not match
# take the second branch, where every group is empty.
_WHOLE_LINE = f"(?s)(?:{LOG_PATTERN}.*|^.*)"
# ip, method, url and status hold no blanks, so a blank separates them safely;
# the bracketed time may hold some and therefore comes last.
_FIELDS = "$1 $3 $4 $5 $2"

# Text between the second and third double quote, starting with a number >= 400:
# three digits from 4 up, or more than three, after any zeros; a plus sign and
# single underscores between digits are allowed, as in any Python number.
_BLANK = r"[\s\x1c-\x1f\x85\p{Z}]"
_QUOTED_ERROR_STATUS = (
    rf'^[^"]*"[^"]*"{_BLANK}*'
    r"\+?(?:0_?)*(?:[4-9](?:_?\d){2}|[1-9](?:_?\d){3,})"
    rf'(?={_BLANK}|"|\z)'
)


def log_fields(line: Column) -> Column:
    """``[ip, method, url, status, time]`` as text, all ``''`` if the line does not match.

    One regex run per line instead of one per field.
    """
    return F.split(F.regexp_replace(line, F.lit(_WHOLE_LINE), F.lit(_FIELDS)), " ", 5)


def log_time(text: Column) -> Column:
    """Timestamp of a log time text; null if it is not a date."""
    return F.try_to_timestamp(text, F.lit(TIME_FORMAT))


def status_code(text: Column) -> Column:
    return text.try_cast("int")


def quoted_status_is_error(line: Column) -> Column:
    """Lenient error test: the first token after the second double quote is a whole
    number of at least 400. Anything else, whatever is wrong with it, is no error."""
    return F.coalesce(line.rlike(_QUOTED_ERROR_STATUS), F.lit(False))


def log_time_text(moment: Column) -> Column:
    """Log time text of a timestamp, in UTC."""
    return F.concat(F.date_format(moment, TIME_FORMAT_WITHOUT_ZONE), F.lit(" +0000"))


def log_line(
    ip: Column,
    time_text: Column,
    method: Column,
    url: Column,
    status: Column,
    size: Column | None = None,
    protocol: Column | None = None,
) -> Column:
    """Render a line; ``size`` is left off in the short form."""
    parts = [
        ip, F.lit(" - ["), time_text, F.lit('] "'), method, F.lit(" "), url, F.lit(" "),
        F.lit("HTTP/1.1") if protocol is None else protocol,
        F.lit('" '), status.cast("string"),
    ]
    if size is not None:
        parts += [F.lit(" "), size.cast("string")]
    return F.concat(*parts)
