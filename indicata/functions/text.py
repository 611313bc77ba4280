"""Text rendering functions.

Bronze tables are all strings, and the strings must be the ones the original
single-process loaders wrote (Python ``str`` of the parsed value).  Spark prints
doubles the Java way (``2.273344207E7``); ``float_text`` re-renders them the
Python way (``22733442.07``) with column expressions only.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python switches to exponent notation outside [1e-4, 1e16).
_PLAIN_LOW = 1e-4
_PLAIN_HIGH = 1e16


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def float_text(c) -> Column:
    """``str(float)`` as Python prints it, for a double column.

    Plain range: the decimal digits of the double (same shortest digits Spark
    uses for the cast) with trailing zeros removed and at least one fractional
    digit.  Outside it: mantissa + ``e`` + sign + two-digit exponent.
    """
    d = _col(c).cast("double")
    java = d.cast("string")
    plain = F.regexp_replace(
        F.regexp_replace(d.try_cast("decimal(38,21)").cast("string"), "0+$", ""),
        r"\.$", ".0")
    # Python prints the shortest digit string that reads back as the same
    # double; Java's own rendering is not always the shortest, so the first
    # ``%.{p}e`` rendering (p = 0..16) that round-trips is taken.  One
    # higher-order expression keeps the generated code small.
    candidates = F.transform(
        F.sequence(F.lit(0), F.lit(16)),
        lambda p: F.printf(F.concat(F.lit("%."), p.cast("string"), F.lit("e")), d))
    sci = F.element_at(F.filter(candidates, lambda s: s.cast("double") == d), 1)
    return (
        F.when(d.isNull(), F.lit(None).cast("string"))
        .when(F.isnan(d), F.lit("nan"))
        .when(d == float("inf"), F.lit("inf"))
        .when(d == float("-inf"), F.lit("-inf"))
        .when(d == 0, java)  # "0.0" / "-0.0"
        .when((F.abs(d) >= _PLAIN_LOW) & (F.abs(d) < _PLAIN_HIGH), plain)
        .otherwise(sci)
    )


def json_number_text(raw) -> Column:
    """Text of a JSON number token read as a string.

    Python's ``json`` keeps integer tokens as ``int`` (printed as written) and
    turns every other token into a ``float`` (printed by ``float_text``).  The
    text is decided per value, never per column.
    """
    r = F.trim(_col(raw))
    # up to 15 significant digits read back as they are written, and from 0.0001 on Python prints them so
    as_written = r.rlike(r"^-?(?:0|[1-9][0-9]{0,10})\.(?:0|[0-9]{0,3}[1-9])$")
    is_int = r.rlike(r"^-?[0-9]+$")
    # up to 38 digits through a decimal (drops leading zeros, -0 -> 0);
    # longer integer tokens keep their digits with leading zeros removed
    as_int = F.coalesce(r.try_cast("decimal(38,0)").cast("string"),
                        F.regexp_replace(r, r"^(-?)0+(?=[0-9])", "$1"))
    return (F.when(r.isNull(), F.lit(None).cast("string"))
            .when(as_written, r)
            .when(is_int, as_int)
            # a text value ("n/d") stays as it is
            .otherwise(F.coalesce(float_text(r.try_cast("double")), _col(raw))))


def cell_text_legacy(value, ctype=None) -> Column:
    """Legacy-workbook cell text: integral numbers lose ``.0``; rest as text.

    ``value`` is the cell's raw text; ``ctype`` (``n`` number, ``d`` date
    serial, ``b`` boolean, ``e`` error code, ``s`` text).  Numbers, date
    serials, booleans and error codes all arrive as numbers in that format.
    """
    v = _col(value)
    numeric = v.try_cast("double")
    # every double from 2**53 on is integral (floor would overflow there)
    large = F.abs(numeric) >= 2.0 ** 53
    integral = F.when(large, F.abs(numeric) < 1e38).otherwise(numeric == F.floor(F.when(~large, numeric)))
    number_text = (F.when(integral, numeric.try_cast("decimal(38,0)").cast("string"))
                   .otherwise(float_text(numeric)))
    if ctype is None:
        return F.when(numeric.isNull(), F.coalesce(v, F.lit(""))).otherwise(number_text)
    t = _col(ctype)
    return (F.when(v.isNull(), F.lit(""))
            .when(t == "b", F.when(v.isin("1", "true", "TRUE", "True"), F.lit("1")).otherwise(F.lit("0")))
            .when(t.isin("n", "d", "d1904", "e") & numeric.isNotNull(), number_text)
            .otherwise(v))


def cell_text_xlsx(value, ctype) -> Column:
    """XLSX cell text as the cached-value reader prints it.

    ``''`` for an empty cell; numbers keep their kind (``5`` stays ``5``,
    ``5.0`` stays ``5.0``); booleans ``True``/``False``; date cells
    ``YYYY-MM-DD HH:MM:SS`` (raw is the day serial, epoch 1899-12-30), a
    serial below 1 is a time only, ``HH:MM:SS``; durations (``t``) print as
    ``[N day[s], ]H:MM:SS``; strings and error values as written.
    """
    v, t = _col(value), _col(ctype)
    is_int = v.rlike(r"^\s*-?[0-9]+\s*$")
    number = (F.when(is_int, F.trim(v).cast("decimal(38,0)").cast("string"))
              .otherwise(float_text(v.try_cast("double"))))
    serial = v.try_cast("double")
    # 1900 system: day 1 is 1900-01-01 and the calendar counts a 29 Feb 1900
    # that never existed, so serials below 60 sit one day later than the
    # plain 1899-12-30 epoch gives.  1904 system: day 0 is 1904-01-01.
    days = (F.when(t == "d1904", serial + F.lit(1462))
            .when((serial > 0) & (serial < 60), serial + F.lit(1))
            .otherwise(serial))
    micros = F.round(days * F.lit(86400 * 1_000_000)).cast("bigint")
    stamp = F.timestamp_micros(micros + F.lit(-2209161600 * 1_000_000))
    date_text = F.when(F.date_format(stamp, "SSSSSS") == "000000",
                       F.date_format(stamp, "yyyy-MM-dd HH:mm:ss")).otherwise(
        F.date_format(stamp, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    date_text = F.when((t == "d") & (serial >= 0) & (serial < 1),
                       F.element_at(F.split(date_text, " "), 2)).otherwise(date_text)
    secs = F.round(serial * F.lit(86400)).cast("bigint")
    whole = F.floor(secs / 86400).cast("bigint")
    rest = secs - whole * 86400
    day_text = F.when(whole == 0, F.lit("")).otherwise(F.concat(
        whole.cast("string"), F.when(F.abs(whole) == 1, F.lit(" day, ")).otherwise(F.lit(" days, "))))
    duration = F.concat(day_text, F.floor(rest / 3600).cast("string"), F.lit(":"),
                        F.lpad(F.floor(rest % 3600 / 60).cast("string"), 2, "0"), F.lit(":"),
                        F.lpad((rest % 60).cast("string"), 2, "0"))
    return (F.when(v.isNull() | (v == ""), F.lit(""))
            .when(t == "b", F.when(v.isin("1", "true", "TRUE"), F.lit("True")).otherwise(F.lit("False")))
            .when(t.isin("d", "d1904"), date_text)
            .when(t == "t", duration)
            .when(t == "n", number)
            .otherwise(v))


def iso_utc(ts) -> Column:
    """``datetime.isoformat()`` of a UTC instant: ``…T…[.ffffff]+00:00``."""
    t = _col(ts)
    return F.when(F.date_format(t, "SSSSSS") == "000000",
                  F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
                  ).otherwise(
        F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")))


def file_name(path) -> Column:
    """Last path element (``/a/b/c.csv`` -> ``c.csv``)."""
    return F.element_at(F.split(_col(path), "/"), -1)


def file_stem(name) -> Column:
    """File name without its last suffix (``01401400.XLS`` -> ``01401400``)."""
    return F.regexp_replace(file_name(name), r"(?<=.)\.[^.]*$", "")


def url_last_segment(url) -> Column:
    """Last segment of a URL's path (query and fragment ignored)."""
    path = F.try_parse_url(_col(url), F.lit("PATH"))
    return F.element_at(F.split(path, "/"), -1)


def url_template(base: str, **params) -> Column:
    """``base?k1=v1&k2=v2`` with every value a column or literal, in call order."""
    parts = []
    for i, (key, value) in enumerate(params.items()):
        v = value if isinstance(value, Column) else F.lit(value)
        parts += [F.lit(("?" if i == 0 else "&") + f"{key}="), v.cast("string")]
    return F.concat(F.lit(base), *parts)


# Articles that a place name is written with or without, and letters that stand for two.
ARTICLES = ("a", "as", "el", "els", "l", "la", "las", "les", "lo", "los", "o", "os")
TWO_LETTERS = {"ß": "ss", "æ": "ae", "œ": "oe"}


def _bare_letters() -> dict[str, str]:
    """Lower-case Latin letters with marks, and the letter without: those that decompose, and the stroked ones."""
    found = {"ø": "o", "ł": "l", "đ": "d", "ħ": "h", "ı": "i", "ŧ": "t"}
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        base = "".join(x for x in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(x))
        if len(base) == 1 and base.isascii() and base.islower():
            found[chr(code)] = base
    return found


def fold_name(name) -> Column:
    """A name as it compares: letters lower-case and without marks (composed
    or not), words parted by anything else, articles left out wherever they
    stand (``Coruña (A)``, ``A CORUNA``; a name of articles alone stays).
    NULL stays NULL."""
    bare = _bare_letters()
    text = F.translate(F.lower(_col(name)), "".join(bare), "".join(bare.values()))
    for letter, two in TWO_LETTERS.items():
        text = F.replace(text, F.lit(letter), F.lit(two))
    text = F.regexp_replace(text, r"\p{M}+", "")
    words = F.filter(F.split(text, r"[^\p{L}\p{N}]+"), lambda x: x != "")
    named = F.filter(words, lambda x: ~x.isin(*ARTICLES))
    return F.array_join(F.when(F.size(named) > 0, named).otherwise(words), " ")


def empty_to_null(c) -> Column:
    """``''`` -> NULL (staging load rule)."""
    return F.nullif(_col(c), F.lit(""))


def null_to_empty(c) -> Column:
    """NULL -> ``''`` (Bronze keeps empty text, never NULL)."""
    return F.coalesce(_col(c), F.lit(""))
