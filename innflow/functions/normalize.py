"""Normalisation expressions (all JVM-side, no UDF).

Each function takes a raw text column, named by a column name (or any
Spark SQL expression text), and returns a typed Column; bad input gives
NULL, never an error, so a batch is never aborted by one row.

The expressions are written as Spark SQL text and turned into a Column with
one ``F.expr`` call: a parse chain of twenty formats is then one call to the
JVM instead of hundreds of small object constructions.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from innflow.functions import vocab

# number gate: optional sign, digits with optional fraction (or a bare
# fraction), optional exponent.  Spark's own cast alone also takes '1d', 'inf'.
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_INTEGER = r"^[+-]?\d+$"


def lit_sql(s: str) -> str:
    """A Spark SQL string literal for ``s`` (quotes, backslashes and non-printables escaped)."""
    out = []
    for ch in s:
        if ch in ("'", "\\"):
            out.append("\\" + ch)
        elif ch.isprintable() and ord(ch) < 0x80:
            out.append(ch)
        else:
            out.append(f"\\u{ord(ch):04x}")
    return "'" + "".join(out) + "'"


def _ref(c: str) -> str:
    """SQL text for a column given by name (plain identifiers are back-quoted)."""
    return f"`{c}`" if c.replace("_", "").isalnum() else c


_WS = lit_sql(vocab.WHITESPACE)


def strip_sql(c: str) -> str:
    """Strip leading/trailing whitespace (the same character set as Python's str.strip).

    Fast path: text whose first and last characters are printable ASCII other than a space has nothing to strip.
    """
    s = f"CAST({c} AS STRING)"
    return (f"(CASE WHEN ascii({s}) BETWEEN 33 AND 126 AND ascii(substring({s}, -1, 1)) BETWEEN 33 AND 126 THEN {s} "
            f"ELSE btrim({s}, {_WS}) END)")


def _text(c: str, stripped: bool) -> str:
    return _ref(c) if stripped else strip_sql(_ref(c))


def strip_text(c: str) -> Column:
    return F.expr(strip_sql(_ref(c)))


def clean_sql(c: str, stripped: bool = False) -> str:
    s = _text(c, stripped)
    missing = ", ".join(lit_sql(m) for m in vocab.MISSING_TEXT)
    return f"(CASE WHEN {s} IN ({missing}) THEN NULL ELSE {s} END)"


def clean_str(c: str, stripped: bool = False) -> Column:
    """Strip; empty text and the text 'nan' become NULL."""
    return F.expr(clean_sql(c, stripped))


def number_sql(c: str, stripped: bool = False) -> str:
    s = _text(c, stripped)
    return f"(CASE WHEN {s} RLIKE {lit_sql(_NUMBER)} THEN try_cast({s} AS DOUBLE) END)"


def number_text(c: str, stripped: bool = False) -> Column:
    """Text that passes the number gate as a double (NaN and infinities possible), else NULL."""
    return F.expr(number_sql(c, stripped))


def _whole_sql(s: str) -> str:
    """The integer that number text ``s`` with a point or exponent denotes, decided by its digits (no rounding); NULL if it is none or no bigint.

    A function over one-element arrays binds text and mantissa once.  Such text is rare, and written out for several columns this
    makes a generated method too long for the JVM to compile, which slows every row.
    """
    return f"zip_with(array({s}), array(regexp_replace({s}, '^[+-]|[eE].*$', '')), (t, m) -> {_whole_of('t', 'm')})[0]"


def _whole_of(s: str, mantissa: str) -> str:
    digits = f"replace({mantissa}, '.', '')"
    # digits before the point, after the exponent has moved it; an exponent beyond an int decides by its sign alone
    exponent = f"regexp_extract({s}, '[eE](.*)$', 1)"
    moved = f"if({exponent} = '', 0, coalesce(try_cast({exponent} AS INT), if({exponent} LIKE '-%', -1000000000, 1000000000)))"
    point = f"(length(substring_index({mantissa}, '.', 1)) + cast({moved} AS BIGINT))"
    whole = (f"if({point} <= 0, '0', if({point} <= length({digits}), left({digits}, cast({point} AS INT)), "
             f"rpad({digits}, cast(least({point}, length({digits}) + 20L) AS INT), '0')))")
    rest = f"if({point} <= 0, {digits}, substring({digits}, cast(least({point}, length({digits}) + 0L) + 1 AS INT)))"
    sign = f"if({s} LIKE '-%', '-', '')"
    return (f"(CASE WHEN rtrim('0', {digits}) = '' THEN 0L WHEN rtrim('0', {rest}) = '' AND {point} <= length({digits}) + 20 "
            f"THEN try_cast({sign} || {whole} AS BIGINT) END)")


def to_long(c: str, stripped: bool = False, number: str | None = None) -> Column:
    """Text -> bigint.  '7', ' 7 ', '+7', '007', '7.0', '7e0', '70e-1' -> 7; '1.5', '0.99999999999999999999', 'inf', '1,000' -> NULL.

    Text with a fraction or exponent is decided by its digits, so no rounding can make a key of it
    and 9007199254740993.0 keeps its last digit.

    ``number`` may name a column holding ``number_text(c)`` computed in an earlier projection.
    """
    s = _text(c, stripped)
    gate = f"{_ref(number)} IS NOT NULL" if number else f"{s} RLIKE {lit_sql(_NUMBER)}"
    return F.expr(
        f"(CASE WHEN {s} RLIKE {lit_sql(_INTEGER)} THEN try_cast({s} AS BIGINT) "
        f"WHEN {gate} THEN {_whole_sql(s)} END)"
    )


def to_double(c: str, stripped: bool = False, number: str | None = None) -> Column:
    """Text -> finite double, NULL for anything else (NaN and infinities included)."""
    d = _ref(number) if number else number_sql(_text(c, stripped), stripped=True)
    return F.expr(f"(CASE WHEN NOT isnan({d}) AND abs({d}) < double('inf') THEN {d} END)")


def to_decimal(c: str, type_name: str = vocab.AMOUNT_TYPE, stripped: bool = False) -> Column:
    """Text -> decimal, rounded half-up from the decimal text itself (not via a double).

    NULL when the text is not a number or does not fit the type.
    """
    s = _text(c, stripped)
    return F.expr(f"(CASE WHEN {s} RLIKE {lit_sql(_NUMBER)} THEN try_cast({s} AS {type_name}) END)")


def std_status(c: str, aliases: Mapping[str, str], stripped: bool = False) -> Column:
    """Strip + lower, then exact alias lookup; anything else -> 'unknown'."""
    pairs = ", ".join(f"{lit_sql(k)}, {lit_sql(v)}" for k, v in aliases.items())
    key = f"lower({_text(c, stripped)})"
    return F.expr(f"coalesce(try_element_at(map({pairs}), {key}), {lit_sql(vocab.UNKNOWN_STATUS)})")


# --- dates and timestamps --------------------------------------------------------
# All listed formats of a column are one regular expression: an alternative per date pattern with the time patterns
# that may follow it, spelling out valid months and days, in an order that makes the first alternative that matches
# the first format that can parse the text.  One replacement rewrites the text to `yyyy-M-d time|am/pm|offset`, one cast parses it.

_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october",
           "november", "december")
_MONTH_NAME = r"\b(" + "|".join(f"{m[:3]}(?:{m[3:]})?" if m[3:] else m for m in _MONTHS) + r")\b"
_CLOCK12 = r"(?:0?[1-9]|1[0-2]):\d{1,2}"
_CLOCK24 = r"\d{1,2}:\d{1,2}"
# pattern text -> (what it captures: Year, Month, Day, Time, AM/PM, Offset), its regular expression
_FORMAT_PARTS = (
    ("yyyyMMdd", "YMD", r"(\d{4})(0[1-9]|1[0-2])(0[1-9]|[12]\d|3[01])"), ("yyyy", "Y", r"(\d{4})"),
    ("MMMM", "M", r"#(\d{1,2})"), ("MMM", "M", r"#(\d{1,2})"), ("M", "M", r"(0?[1-9]|1[0-2])"),
    ("d", "D", r"(0?[1-9]|[12]\d|3[01])"), ("H:m:s.S", "T", rf"({_CLOCK24}:\d{{1,2}}\.\d{{1,9}})"),
    ("H:m:s", "T", rf"({_CLOCK24}:\d{{1,2}})"), ("H:m", "T", rf"({_CLOCK24})"),
    ("h:m:s a", "TA", rf"({_CLOCK12}:\d{{1,2}}) ([ap]m)"), ("h:m a", "TA", rf"({_CLOCK12}) ([ap]m)"),
    ("XXX", "O", r"(z|[+-]\d{2}:?\d{2})"), ("'T'", "", "t"),
)


def _format_regex(fmt: str) -> tuple[str, str]:
    """The regular expression of one pattern, and what its groups capture, in order."""
    out, groups, i = [], "", 0
    while i < len(fmt):
        for token, captured, rx in _FORMAT_PARTS:
            if fmt.startswith(token, i):
                out.append(rx)
                groups += captured
                i += len(token)
                break
        else:
            out.append(" +" if fmt[i] == " " else re.escape(fmt[i]))
            i += 1
    return "".join(out), groups


def _by_date_pattern(formats: Iterable[str]) -> list[tuple[str, list[str]]]:
    """The formats as (date pattern, time patterns that may follow it), so that a text meets each date pattern about once.

    Two formats can read one text only if they differ in nothing but the order of day and month: a format joins an earlier entry of its
    date pattern unless an entry in between has its time pattern and the other order, which must be tried first.
    """
    entries: list[tuple[str, str, list[str]]] = []
    for fmt in formats:
        date, time = re.fullmatch(r"(.*?)((?: |'T')[Hh].*)?", fmt.replace("MMMM", "MMM")).groups(default="")
        shape = re.sub(r"(?<![Md])[Md](?![Md])", "N", date)
        for other_shape, other, times in reversed(entries):
            if other_shape == shape and other == date:
                if time not in times:
                    times.append(time)
                break
            if other_shape == shape and time in times:
                entries.append((shape, date, [time]))
                break
        else:
            entries.append((shape, date, [time]))
    return [(date, times) for _, date, times in entries]


def formats_regex(formats: Iterable[str]) -> tuple[str, str]:
    """One anchored expression of all patterns, and the replacement that rewrites a match (groups of other patterns are empty)."""
    parts, groups = [], ""
    for date, times in _by_date_pattern(formats):
        rx, captured = _format_regex(date)
        tails = [_format_regex(t) for t in times if t]
        if tails:
            rx += "(?:" + "|".join(t for t, _ in tails) + ")" + ("?" if "" in times else "")
        parts.append(rx)
        groups += captured + "".join(g for _, g in tails)
    refs = {k: "".join(f"${n}" for n, g in enumerate(groups, start=1) if g == k) for k in "YMDTAO"}
    return ("^(?:" + "|".join(parts) + ")$",
            "@{Y}-{M}-{D} {T}|{A}|{O}".format(**refs))


def _month_numbers_sql(low: str) -> str:
    """Lower-case text with an English month name, short or full, replaced by `#` and its number.

    Text without letters is told by its upper case; the rest is a function of its own, as in ``_whole_sql``.
    """
    name = f"substring(regexp_extract(m, {lit_sql(_MONTH_NAME)}, 1), 1, 3)"
    short = "".join(m[:3] for m in _MONTHS)
    number = f"CAST((locate({name}, '{short}') + 2) / 3 AS INT)"
    numbered = f"transform(array({low}), m -> regexp_replace(m, {lit_sql(_MONTH_NAME)}, concat('#', {number})))[0]"
    return f"(CASE WHEN {low} <> upper({low}) AND {low} RLIKE '[a-z]{{3}}' THEN {numbered} ELSE {low} END)"


def rewritten_sql(c: str, formats: Iterable[str], stripped: bool = False) -> str:
    """`@date time|am or pm|offset` of the first format that matches, NULL or a text without `@` in front where none does."""
    rx, rewrite = formats_regex(formats)
    s = _text(c, stripped)
    # a text that only looks rewritten matches no format
    return f"(CASE WHEN substring({s}, 1, 1) <> '@' THEN regexp_replace({_month_numbers_sql(f'lower({s})')}, {lit_sql(rx)}, {lit_sql(rewrite)}) END)"


def _rewritten_time_sql(z: str) -> str:
    """The timestamp that a rewritten text denotes; half days and offsets other than Z, which are rare, are taken apart in a function of their own."""
    when = f"try_cast(substring({z}, 2, instr({z}, '|') - 2) AS TIMESTAMP_NTZ)"
    half = "split_part(y, '|', 2)"
    hours = f"(CASE WHEN {half} = 'pm' AND hour(t) < 12 THEN 12 WHEN {half} = 'am' AND hour(t) = 12 THEN -12 ELSE 0 END)"
    offset = "replace(split_part(y, '|', 3), ':', '')"
    minutes = (f"(CASE WHEN length({offset}) = 5 THEN CAST(concat(left({offset}, 1), '1') AS INT) * "
               f"(CAST(substring({offset}, 2, 2) AS INT) * 60 + CAST(substring({offset}, 4, 2) AS INT)) ELSE 0 END)")
    # zip_with over one-element arrays binds both values once, where plain text would repeat their expressions
    shifted = f"zip_with(array({z}), array({when}), (y, t) -> timestampadd(MINUTE, 60 * {hours} - {minutes}, t))[0]"
    return f"(CASE WHEN {z} LIKE '@%||' OR {z} LIKE '@%||z' THEN {when} WHEN {z} LIKE '@%' THEN {shifted} END)"


def parse_with_formats(c: str, formats: Iterable[str], stripped: bool = False, rewritten: str | None = None) -> Column:
    """First format that parses wins; result is timestamp without zone (an explicit offset is taken off, giving UTC).

    The cast reads wall-clock fields, so the session time zone plays no part.  ``rewritten`` may name a column
    holding ``rewritten_date(c)`` or ``rewritten_timestamp(c)`` computed in an earlier projection.
    """
    if rewritten:
        return F.expr(_rewritten_time_sql(_ref(rewritten)))
    return F.expr(f"transform(array({rewritten_sql(c, formats, stripped)}), z -> {_rewritten_time_sql('z')})[0]")


def _formats(listed: tuple[str, ...], last_resort: tuple[str, ...], fallback: bool = True) -> tuple[str, ...]:
    return listed + (last_resort if fallback else ())


def rewritten_date(c: str, stripped: bool = False) -> Column:
    return F.expr(rewritten_sql(c, _formats(vocab.DATE_FORMATS, vocab.DATE_FALLBACK_FORMATS), stripped))


def rewritten_timestamp(c: str, stripped: bool = False) -> Column:
    return F.expr(rewritten_sql(c, _formats(vocab.TIMESTAMP_FORMATS, vocab.TIMESTAMP_FALLBACK_FORMATS), stripped))


def parse_date(c: str, fallback: bool = True, stripped: bool = False, rewritten: str | None = None) -> Column:
    """Date column text -> timestamp (cast to date after the rules that compare it)."""
    return parse_with_formats(c, _formats(vocab.DATE_FORMATS, vocab.DATE_FALLBACK_FORMATS, fallback), stripped, rewritten)


def parse_timestamp(c: str, fallback: bool = True, stripped: bool = False, rewritten: str | None = None) -> Column:
    """Timestamp column text -> timestamp without zone."""
    return parse_with_formats(c, _formats(vocab.TIMESTAMP_FORMATS, vocab.TIMESTAMP_FALLBACK_FORMATS, fallback), stripped, rewritten)


def booking_status(c: str, stripped: bool = False) -> Column:
    return std_status(c, vocab.BOOKING_STATUS_ALIASES, stripped)


def payment_status(c: str, stripped: bool = False) -> Column:
    return std_status(c, vocab.PAYMENT_STATUS_ALIASES, stripped)


def normalize_header(columns: Iterable[str]) -> list[str]:
    """Header names: strip + lower; two raw names landing on one name is an error."""
    out = [c.strip().lower() for c in columns]
    if len(set(out)) != len(out):
        raise ValueError(f"column names collide after normalisation: {list(columns)}")
    return out
