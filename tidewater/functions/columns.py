"""Pure column expressions (no actions, no Python UDFs).

Everything here compiles to Catalyst expressions, so it stays inside
whole-stage codegen wherever it is used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- dates ------------------------------------------------------------------

def month_end(c) -> Column:
    """Month label used everywhere: the month's last day (a DATE)."""
    return F.last_day(col_of(c))


def days_before(as_of: str, days: int) -> Column:
    """``as_of - days`` as a DATE literal expression (as_of is explicit)."""
    return F.date_sub(F.to_date(F.lit(as_of)), int(days))


def to_date_lenient(c, fmt: str | None = None) -> Column:
    """Text to DATE; unparsable text gives NULL instead of raising (ANSI)."""
    c = col_of(c)
    return F.try_to_timestamp(c, F.lit(fmt)).cast("date") if fmt else F.try_to_timestamp(c).cast("date")


def quarter_of(c) -> Column:
    return F.quarter(col_of(c)).cast("long")


def year_of(c) -> Column:
    return F.year(col_of(c)).cast("long")


# -- arithmetic ---------------------------------------------------------------

def guarded_pct(num, den) -> Column:
    """``num / den * 100`` as double, 0 when the denominator is not positive.

    Spark 4 runs ANSI, where ``x / 0`` raises; CASE evaluates the division
    only on rows where the guard holds.
    """
    num, den = col_of(num), col_of(den)
    return F.when(den > 0, num.cast("double") / den.cast("double") * 100.0).otherwise(F.lit(0.0))


def guarded_div(num, den) -> Column:
    num, den = col_of(num), col_of(den)
    return F.when(den != 0, num.cast("double") / den.cast("double"))


def round_half_even(c, digits: int = 1) -> Column:
    """numpy ``round``: scale, round half to even on the scaled double, unscale.

    ``F.round`` rounds half up (12.25 -> 12.3); numpy gives 12.2.
    """
    scale = float(10 ** digits)
    return F.rint(col_of(c).cast("double") * scale) / scale


def nan_to_null(c) -> Column:
    """NaN read as NULL: pandas skips NaN in sums and means, Spark would
    propagate it (sum NaN) and count it."""
    return F.nanvl(col_of(c), F.lit(None).cast("double"))


def money(c, precision: int = 12, scale: int = 2) -> Column:
    """Money as a decimal so that sums do not depend on row order."""
    return col_of(c).cast(f"decimal({precision},{scale})")


# -- text / money ---------------------------------------------------------------

# The characters the reference removes or maps before float().
MONEY_DROP_ASCII_SPACE = " "
MONEY_CURRENCY_SIGN = "₽"
MONEY_DECIMAL_COMMA = ","

# Python's float() grammar after stripping: digits with single inner
# underscores, optional point, optional exponent; or nan / inf / infinity.
_DIGITS = r"[0-9](?:_?[0-9])*"
_PY_FLOAT = (
    r"^[+-]?(?:(?:(?:" + _DIGITS + r")?\." + _DIGITS + r"|" + _DIGITS + r"\.?)"
    r"(?:[eE][+-]?" + _DIGITS + r")?|(?i:nan|inf|infinity))$"
)
# The characters Python's str.isspace() accepts, i.e. what
# str.strip() and float() strip.
PY_SPACE_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                  + "".join(chr(c) for c in range(0x2000, 0x200B))
                  + "\u2028\u2029\u202f\u205f\u3000")
PY_SPACE = "[" + "".join(f"\\u{ord(c):04x}" for c in PY_SPACE_CHARS) + "]"


def strip_py_space(c) -> Column:
    """``str.strip()``: trims exactly Python's whitespace set (no regex)."""
    return F.btrim(col_of(c), F.lit(PY_SPACE_CHARS))


def parse_money(c, compat: bool = False) -> Column:
    """Money text to double; absent or unparsable gives 0.

    The reference drops ASCII spaces and the rouble sign, maps ',' to '.',
    then calls float(). ``compat=True`` keeps its behaviour on interior
    no-break spaces (the value becomes 0); the default removes every
    Unicode space first, so ``1 234,50`` with a no-break space parses.
    Only the final grammar test is a regular expression.
    """
    s = F.coalesce(col_of(c), F.lit(""))
    if compat:
        s = F.replace(s, F.lit(MONEY_DROP_ASCII_SPACE), F.lit(""))
    else:
        s = F.translate(s, PY_SPACE_CHARS, "")
    s = F.replace(s, F.lit(MONEY_CURRENCY_SIGN), F.lit(""))
    s = F.replace(s, F.lit(MONEY_DECIMAL_COMMA), F.lit("."))
    if compat:
        s = strip_py_space(s)  # float() strips surrounding whitespace itself
    parsed = F.when(s.rlike(_PY_FLOAT), F.replace(s, F.lit("_"), F.lit("")).try_cast("double"))
    return F.coalesce(parsed, F.lit(0.0))


def money_parse_ok(c, compat: bool = False) -> Column:
    """True when the text is present and parses (for parse-rate checks)."""
    s = col_of(c)
    t = F.replace(s, F.lit(" "), F.lit("")) if compat else F.translate(s, PY_SPACE_CHARS, "")
    t = F.replace(F.replace(t, F.lit(MONEY_CURRENCY_SIGN), F.lit("")), F.lit(","), F.lit("."))
    t = strip_py_space(t)
    return s.isNotNull() & t.rlike(_PY_FLOAT)


# HTML entities decoded by the text extractor.
HTML_ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
]


def html_text(c) -> Column:
    """Text of an HTML fragment: each text node trimmed, joined with no
    separator, entities decoded (what ``get_text(strip=True)`` gives).

    The regular expressions run only on fragments that hold markup; plain
    text takes the literal-replace path."""
    s = col_of(c)
    s = F.replace(s, F.lit("&nbsp;"), F.lit("\u00a0"))
    s = F.when(s.contains("<!--"), F.regexp_replace(s, r"(?s)<!--.*?-->", "")).otherwise(s)
    s = F.when(s.contains("<"), F.regexp_replace(s, rf"{PY_SPACE}*<[^>]*>{PY_SPACE}*", "")).otherwise(s)
    s = strip_py_space(s)
    for ent, ch in HTML_ENTITIES:
        s = F.replace(s, F.lit(ent), F.lit(ch))
    return F.replace(s, F.lit("&amp;"), F.lit("&"))


def strip_scripts(c) -> Column:
    """Remove script/style bodies and comments, whose text may hold tags
    (one alternation, run only on pages that have any of them)."""
    s = col_of(c)
    low = F.lower(s)
    has = low.contains("<script") | low.contains("<style") | s.contains("<!--")
    return F.when(has, F.regexp_replace(
        s, r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->", "")).otherwise(s)


def class_block_regex(tag: str, css_class: str) -> str:
    """Regex capturing the inner HTML of ``<tag class="... css_class ...">``.

    Matches flat elements (no nested element of the same tag inside)."""
    return (rf"""(?is)<{tag}\b[^>]*\bclass\s*=\s*["'](?:[^"']*\s)?{css_class}(?:\s[^"']*)?["'][^>]*>"""
            rf"(.*?)</{tag}\s*>")


def first_element(html, tag: str, css_class: str) -> Column:
    """The first whole ``tag.css_class`` element, or '' when there is none."""
    return F.regexp_extract(col_of(html), class_block_regex(tag, css_class), 0)


def first_field(html, tag: str, css_class: str) -> Column:
    """Trimmed text of the first ``tag.css_class`` element, else ''.

    No match extracts '', whose text is '' as well, so no presence test is
    needed."""
    return html_text(F.regexp_extract(col_of(html), class_block_regex(tag, css_class), 1))


# -- formats ---------------------------------------------------------------

def thousands(c) -> Column:
    """``f"{x:,.0f}"``."""
    return F.format_number(col_of(c).cast("double"), 0)


def one_decimal(c) -> Column:
    """``f"{x:.1f}"`` without grouping (format_number rounds half-even on the
    exact value, as Python does; format_string would round half up)."""
    return F.replace(F.format_number(col_of(c).cast("double"), 1), F.lit(","), F.lit(""))
