"""Scalar cleaning rules as column expressions.

Every rule takes a text column and returns a column; none of them needs Python
code at run time. Java regular expressions are ASCII by default, so classes
that must see Cyrillic or no-break spaces carry ``(?U)`` or ``(?iu)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from certweave.schema import BOOL_FIELDS, CODE_FIELDS, DATE_FIELDS, ID_NUMBER_FIELDS

# Characters that count as white space at the ends of a text.
WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Texts that stand for "no value", and the two lists of truth words.
EMPTY_MARKERS = ["", "-", "—", "–", "н/д", "нд", "нет данных", "null", "none"]
TRUE_WORDS = ["1", "true", "да", "y", "yes"]
FALSE_WORDS = ["0", "false", "нет", "n", "no"]

EXOTIC_SPACES = "[\\u00A0\\u202F\\u2007\\u200B\\uFEFF]"
CONTROLS = "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f-\\x9f]"
SPACE_RUN = "(?U)\\s+"
# a text that cleaning leaves as it is, markers aside: single spaces inside, no other white space, no control
TIDY = "^[^\\x00-\\x20\\x7f-\\xa0\\u1680\\u2000-\\u200b\\u2028\\u2029\\u202f\\u205f\\u3000\\ufeff]++(?: [^\\x00-\\x20\\x7f-\\xa0\\u1680\\u2000-\\u200b\\u2028\\u2029\\u202f\\u205f\\u3000\\ufeff]++)*+\\z"
DIGITS = "^[0-9]+\\z"
ISO_DAY = "^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}\\z"
DOTTED_CODE = "^[0-9]{2}\\.[0-9]{2}\\.[0-9]{2}$"
SIX_DIGITS = "^([0-9]{2})([0-9]{2})([0-9]{2})$"


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(WHITE_SPACE))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(WHITE_SPACE))


def nonblank(c: Column) -> Column:
    """Stripped text, or null when nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def drop_space_and_hyphen(c: Column) -> Column:
    return F.translate(c, WHITE_SPACE + "-", "")


def is_blank(c: Column) -> Column:
    """True for null and for white space only; never null. One end tells."""
    return F.coalesce(F.ltrim(c, F.lit(WHITE_SPACE)) == "", F.lit(True))


def collapse(c: Column) -> Column:
    return strip(F.regexp_replace(c, SPACE_RUN, " "))


def clean_text(c: Column) -> Column:
    """Most texts are tidy: one look at them replaces the rules, and a long one is no marker."""
    longest = max(map(len, EMPTY_MARKERS))
    as_is = F.when((F.length(c) > longest) | ~F.lower(c).isin(EMPTY_MARKERS), c)
    return F.when(c.rlike(TIDY), as_is).otherwise(_cleaned(c))


def _cleaned(c: Column) -> Column:
    x = F.regexp_replace(c, EXOTIC_SPACES, " ")
    x = F.regexp_replace(x, CONTROLS, "")
    x = F.trim(F.regexp_replace(x, SPACE_RUN, " "))
    return F.when(~F.lower(x).isin(EMPTY_MARKERS), x)


def json_safe(c: Column) -> Column:
    return F.regexp_replace(c, CONTROLS, "")


def cast_bool(c: Column) -> Column:
    word = F.lower(strip(c))
    return F.when(word.isin(TRUE_WORDS), F.lit(True)).when(word.isin(FALSE_WORDS), F.lit(False))


def is_bad_bool(c: Column) -> Column:
    return c.isNotNull() & cast_bool(c).isNull()


def strip_timezone(c: Column) -> Column:
    """Drop an offset. A bare ``+HHMM`` or ``-HH`` only counts next to a time of day."""
    x = strip(F.regexp_replace(c, "(?i)(?:Z|[+\\-]\\d{2}:\\d{2}(?::\\d{2})?)$", ""))
    return F.when(x.contains(":"), rstrip(F.regexp_replace(x, "[+\\-](?:\\d{4}|\\d{2})$", ""))).otherwise(x)


def _date_text(c: Column) -> Column:
    x = F.regexp_replace(nonblank(c), "(\\d{2}:\\d{2}(?::\\d{2})?)\\.\\d+", "$1")
    return strip(strip_timezone(x))


def _iso_or_null(x: Column) -> Column:
    """ISO text of the day when ``x`` has one of the accepted layouts, otherwise null.

    Two anchored patterns cover the six layouts (year first with an optional time
    of day, day first with one of three separators); the cast rejects days that
    the calendar does not have.
    """
    clock = "(?:(?:[Tt]|\\s+)(?:2[0-3]|[01]?\\d):[0-5]?\\d:(?:6[01]|[0-5]?\\d))?"
    year_first = f"^(\\d{{4}})-(\\d{{1,2}})-(\\d{{1,2}}){clock}$"
    day_first = "^(\\d{1,2})([./-])(\\d{1,2})\\2(\\d{4})$"

    def day(pattern: str, y: int, m: int, d: int) -> Column:
        part = lambda g: F.regexp_extract(x, pattern, g)
        text = F.concat(part(y), F.lit("-"), F.lpad(part(m), 2, "0"), F.lit("-"), F.lpad(part(d), 2, "0"))
        return F.when(x.rlike(pattern) & (part(y) != "0000"), text.try_cast("date"))

    return F.coalesce(day(year_first, 1, 2, 3), day(day_first, 4, 3, 1)).cast("string")


def _is_iso_day(c: Column) -> Column:
    """A day in the layout that ``parse_date`` returns, which needs none of its rules."""
    return c.rlike(ISO_DAY) & c.try_cast("date").isNotNull()


def parse_date(c: Column) -> Column:
    """ISO date text; a text that is no date is handed back stripped."""
    x = _date_text(c)
    return F.when(_is_iso_day(c), c).otherwise(F.coalesce(_iso_or_null(x), x))


def is_bad_date(c: Column) -> Column:
    x = _date_text(c)
    return F.when(_is_iso_day(c), F.lit(False)).otherwise(x.isNotNull() & _iso_or_null(x).isNull())


def digits_only(c: Column) -> Column:
    """The digits of an identifier written with spaces or hyphens; anything else is null."""
    x = drop_space_and_hyphen(c)
    return F.when(c.rlike(DIGITS), c).otherwise(F.when(x.rlike("^[0-9]+$"), x))


def cast_id_number(c: Column) -> Column:
    return digits_only(c)


def is_bad_id_number(c: Column) -> Column:
    left = drop_space_and_hyphen(c)
    return F.coalesce(left != "", F.lit(False)) & digits_only(c).isNull()


def triplet_code(c: Column) -> Column:
    compact = drop_space_and_hyphen(c)
    return F.when(~c.rlike(DOTTED_CODE) & compact.rlike(SIX_DIGITS),
                  F.regexp_replace(compact, SIX_DIGITS, "$1.$2.$3")).otherwise(c)


def programm_code_key(c: Column) -> Column:
    x = triplet_code(nonblank(c))
    return F.when(x.rlike(DOTTED_CODE), x)


def typed_scalar(tag: str, x: Column) -> Column:
    """The rule that belongs to a field name, for a text that is clean already."""
    if tag == "Qualification":
        return F.nullif(x, F.lit("0"))
    if tag in CODE_FIELDS:
        return triplet_code(x)
    if tag in BOOL_FIELDS:
        return cast_bool(x)
    if tag in DATE_FIELDS:
        return parse_date(x)
    if tag in ID_NUMBER_FIELDS:
        return cast_id_number(x)
    return x


def normalize_scalar(tag: str, c: Column) -> Column:
    return typed_scalar(tag, clean_text(c))


def uid_token(c: Column) -> Column:
    return F.lower(nonblank(c))


def classify_placeholder(c: Column) -> Column:
    return (
        F.when(c.rlike("^0+$"), "only_zeros")
        .when(c.isin("-", "—", "–"), "dash_only")
        .when(F.lower(c).isin("н/д", "нд", "нет данных", "null", "none"), "empty_marker")
    )


def null_label(c: Column) -> Column:
    return F.coalesce(nonblank(c), F.lit("<null>"))


def meta_label_text(c: Column) -> Column:
    return F.when(c.isNull(), "<null>").when(strip(c) == "", "<empty>").otherwise(strip(c))


def meta_label_bool(c: Column) -> Column:
    return F.when(c.isNull(), "<null>").when(c, "1").otherwise("0")


def meta_label_number(c: Column) -> Column:
    whole = c == F.floor(c)
    return F.when(c.isNull(), "<null>").when(whole, c.cast("bigint").cast("string")).otherwise(c.cast("string"))


def canonical_qualification(c: Column) -> Column:
    """Trailing space and one closing full stop removed."""
    return rstrip(F.regexp_replace(rstrip(c), "\\.$", ""))
