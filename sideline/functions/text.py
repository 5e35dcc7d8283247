"""Text column expressions (all JVM-side, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: ColumnOrName) -> Column:
    """Remove leading and trailing whitespace of any kind (tabs, newlines, Unicode spaces).

    Spark's ``trim`` removes only the ASCII space, so a Unicode-aware regex is used.
    """
    return F.regexp_replace(_c(c), r"(?U)^\s+|\s+$", "")


def squeeze_ws(c: ColumnOrName) -> Column:
    """Collapse every whitespace run to one space."""
    return F.regexp_replace(_c(c), r"\s+", " ")


# A run of cased letters, or a run of anything else. Title casing upper-cases the
# first character of each cased run and lower-cases the rest; other runs pass through.
_CASED = r"\p{Lu}\p{Ll}\p{Lt}"
_CASED_OR_NOT = rf"([{_CASED}]+|[^{_CASED}]+)"
# Case-ignorable characters (Unicode Case_Ignorable): marks, format, modifier
# letters/symbols and the word-internal punctuation below.
_CASE_IGNORABLE = (r"\p{Mn}\p{Me}\p{Cf}\p{Lm}\p{Sk}'.:\u00B7\u0387\u05F4\u2018\u2019\u2024"
                   r"\u2027\uFE13\uFE52\uFE55\uFF07\uFF0E\uFF1A")
# A capital sigma inside a word that no cased letter follows (case-ignorables
# skipped) lower-cases to the final form; elsewhere to the plain small sigma.
_FINAL_SIGMA = rf"(?<=[{_CASED}])\u03A3(?![{_CASE_IGNORABLE}]*[{_CASED}])"


def title_case(c: ColumnOrName) -> Column:
    """Python ``str.title()`` semantics: a letter after any non-letter starts a word.

    ``initcap`` alone only starts words after spaces ("3pt" stays "3pt", where
    title case gives "3Pt"), so the text is split into cased/uncased runs first.
    Capital sigmas are resolved against the whole text before the split.
    """
    sigma = F.translate(F.regexp_replace(_c(c), _FINAL_SIGMA, "\u03C2"), "\u03A3", "\u03C3")
    runs = F.regexp_extract_all(sigma, F.lit(_CASED_OR_NOT), 1)
    return F.array_join(F.transform(runs, lambda r: F.initcap(r)), "")


def title_text(c: ColumnOrName, null_text: str | None = None) -> Column:
    """Strip then title-case. ``null_text`` renders NULL as that text first
    (e.g. ``'nan'`` reproduces a pandas ``astype(str)`` on missing values)."""
    col = _c(c)
    if null_text is not None:
        col = F.coalesce(col, F.lit(null_text))
    return title_case(strip_ws(col))


def text_of(*cols: ColumnOrName) -> Column:
    """Lower-cased space-join of several text columns; NULL parts are skipped."""
    return F.lower(F.concat_ws(" ", *[_c(c) for c in cols]))


def strip_point_zero(c: ColumnOrName) -> Column:
    """'2018.0' -> '2018' (a number that was rendered as text)."""
    return F.regexp_replace(_c(c), r"\.0$", "")


def initial_last(c: ColumnOrName) -> Column:
    """'First Middle Last' -> 'F. Last' using single-space tokens.

    The first character of the first token, a period, a space and the last token.
    NULL stays NULL; an empty first token (empty text, leading space) gives NULL.
    """
    parts = F.split(_c(c), " ", -1)
    first = F.element_at(parts, 1)
    last = F.element_at(parts, -1)
    return F.when(F.length(first) > 0,
                  F.concat(F.substring(first, 1, 1), F.lit(". "), last))


def last_token(c: ColumnOrName) -> Column:
    """Last whitespace-separated token; blank text gives ''."""
    return F.element_at(F.split(strip_ws(c), r"(?U)\s+", -1), -1)


def to_number_or_null(c: ColumnOrName) -> Column:
    """Parse a number; unparsable text becomes NULL."""
    return _c(c).try_cast("double")
