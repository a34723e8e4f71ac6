"""String and array Column functions (JVM-side, codegen-friendly).

All take and return :class:`pyspark.sql.Column`; none call Python per row.
Whitespace is the explicit class ``[\\t\\n\\x0B\\f\\r ]`` so Spark and SQL engines agree.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import ACRONYMS, GENERIC_BAN, STOPWORDS

WS = r"[\t\n\x0B\f\r ]"
_SEP_PIECE = rf"^({WS}+|&|/|-)$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lits(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def py_strip(c) -> Column:
    """Python ``str.strip()`` for the ASCII whitespace class."""
    return F.regexp_replace(_col(c), rf"^{WS}+|{WS}+$", "")


def blank_if_null(c) -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def strip_scheme(c) -> Column:
    """M1: remove every ``http://`` / ``https://`` (the path stays)."""
    return F.regexp_replace(_col(c), "https?://", "")


def to_list(c) -> Column:
    """M2: a list literal (``['a', 'b']``) or a ``; , | tab`` separated string -> array of trimmed,
    non-blank strings."""
    s = py_strip(blank_if_null(c))
    parsed = F.from_json(s, "array<string>", {"allowSingleQuotes": "true"})
    parsed_items = F.transform(parsed, lambda t: py_strip(F.coalesce(t, F.lit("None"))))
    split_items = F.transform(F.split(s, r"[;,|]|\t"), lambda t: py_strip(t))
    return (F.when(s == "", F.array().cast("array<string>"))
             .when(s.startswith("[") & parsed.isNotNull(), F.filter(parsed_items, lambda t: t != ""))
             .otherwise(F.filter(split_items, lambda t: t != "")))


def uniq(arr) -> Column:
    """U4: ordered de-duplicate, trimmed, blanks dropped."""
    return F.array_distinct(F.filter(F.transform(_col(arr), lambda t: py_strip(t)), lambda t: t != ""))


def title_case_keep_acronyms(c) -> Column:
    """M3: capitalise each word (rest lower-cased), known acronyms upper-cased; separators are
    whitespace runs, ``&``, ``/`` and ``-``."""
    s = py_strip(c)
    pieces = F.regexp_extract_all(s, F.lit(rf"({WS}+|&|/|-|[^\t\n\x0B\f\r &/-]+)"), 1)
    acr = _lits(ACRONYMS)
    out = F.transform(pieces, lambda w: F.when(w.rlike(_SEP_PIECE), w)
                      .when(F.array_contains(acr, F.upper(w)), F.upper(w))
                      .otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30)))))
    return py_strip(F.array_join(out, ""))


def py_title(c) -> Column:
    """Python ``str.title()`` for ASCII text: a letter is upper-cased when it starts the string
    or follows a non-letter, otherwise lower-cased."""
    s = _col(c)
    chars = F.split(s, "")
    out = F.transform(chars, lambda ch, i: F.when(
        (i == 0) | ~F.element_at(chars, i).rlike("[A-Za-z]"), F.upper(ch)).otherwise(F.lower(ch)))
    return F.when(s == "", s).otherwise(F.array_join(out, ""))


_BAN_RX = r"(?i)\b(" + "|".join(GENERIC_BAN) + r")\b"


def sanitize_label(c) -> Column:
    """M4: keep ``A-Za-z0-9 -&()/`` and spaces, squeeze spaces, collapse repeated words,
    remove the generic words, squeeze again, trim stray dashes."""
    s = F.regexp_replace(py_strip(c), r"[^A-Za-z0-9\-&() /]+", "")
    s = F.trim(F.regexp_replace(s, " +", " "))
    s = F.regexp_replace(s, r"(?i)\b(\w+)\b(?:\s+\1\b)+", "$1")
    s = F.trim(F.regexp_replace(s, _BAN_RX, ""))
    s = F.regexp_replace(s, " {2,}", " ")
    return F.regexp_replace(s, r"^-+ *| *-+$", "")


def tokens(c) -> Column:
    """M5: lower-case, split on runs of anything but ``a-z0-9-/&`` (no replacing, character by character, before),
    drop blanks and stopwords."""
    stop = _lits(STOPWORDS)
    return F.filter(F.split(F.lower(_col(c)), r"[^a-z0-9\-/&]+"), lambda t: (t != "") & ~F.array_contains(stop, t))


def ngrams(toks, n: int) -> Column:
    """M6: word n-grams of a token array, in position order. 2- and 3-grams zip shifted copies
    of the array (no per-gram slice allocation)."""
    t = _col(toks)
    empty = F.array().cast("array<string>")
    if n == 1:
        return t
    if n in (2, 3):
        m = F.size(t) - (n - 1)
        shifted = [F.slice(t, i + 1, F.greatest(m, F.lit(1))) for i in range(n)]
        g = F.zip_with(shifted[0], shifted[1], lambda a, b: F.concat(a, F.lit(" "), b))
        if n == 3:
            g = F.zip_with(g, shifted[2], lambda a, b: F.concat(a, F.lit(" "), b))
        return F.when(F.size(t) >= n, g).otherwise(empty)
    return F.when(F.size(t) >= n, F.transform(F.sequence(F.lit(1), F.size(t) - n + 1),
                                              lambda i: F.array_join(F.slice(t, i, n), " "))
                  ).otherwise(empty)


def drop_banned_grams(grams) -> Column:
    """M7: keep grams none of whose words is a generic word."""
    ban = _lits(GENERIC_BAN)
    return F.filter(_col(grams), lambda g: ~F.arrays_overlap(F.split(g, " "), ban))


def normalize_alnum(c) -> Column:
    """lower-case, runs of non ``a-z0-9`` -> one space, trimmed (used to compare sector names)."""
    return py_strip(F.regexp_replace(F.lower(_col(c)), "[^a-z0-9]+", " "))


def first_match(blob, rules, default) -> Column:
    """Ordered rule table ``[(regex, value), ...]``: value of the first regex found in ``blob``."""
    b = _col(blob)
    out = None
    for pat, val in rules:
        cond = b.rlike(pat)
        out = F.when(cond, F.lit(val)) if out is None else out.when(cond, F.lit(val))
    dflt = default if isinstance(default, Column) else F.lit(default)
    return dflt if out is None else out.otherwise(dflt)


def half_even_ratio(num, den, scale: int) -> Column:
    """round_half_even(scale * num / den) for non-negative integer columns, exact."""
    n = _col(num).cast("long") * F.lit(scale)
    d = _col(den).cast("long")
    q = F.floor(n / d).cast("long")
    r2 = (n - q * d) * 2
    return (F.when(r2 > d, q + 1).when(r2 < d, q)
             .otherwise(F.when(q % 2 == 0, q).otherwise(q + 1)))


def fmt_ratio2(num, den) -> Column:
    """``f"{num/den:.2f}"`` with integer half-even rounding."""
    h = half_even_ratio(num, den, 100)
    return F.concat((h / 100).cast("long").cast("string"), F.lit("."),
                    F.lpad((h % 100).cast("string"), 2, "0"))


def fmt_percent0(num, den) -> Column:
    """``f"{num/den:.0%}"`` with integer half-even rounding."""
    return F.concat(half_even_ratio(num, den, 100).cast("string"), F.lit("%"))
