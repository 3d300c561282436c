"""Scalar text / key / path column functions.  Ids: F1-F13, F23 (X2, X3 rewritten as
column expressions: every per-row lambda of the reference is one of these).

All are built-in Spark expressions (JVM side, code-generated); no Python UDF.
Regex notes: Python's ``\\w`` is Unicode while Java's is ASCII, so word characters are
written ``[\\p{L}\\p{N}_]``; Python's ``strip()`` is ``btrim`` over its white space.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def concat_sep(cols: Sequence, sep: str = " ") -> Column:
    """join with a separator; any null part makes the result null (unlike
    ``concat_ws``, which skips nulls)."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(_c(c).cast("string"))
    return F.concat(*parts)


def extract(col, pattern: str, group: int = 1) -> Column:
    """regex capture group; no match -> null (Spark alone returns '')."""
    return F.nullif(F.regexp_extract(_c(col), pattern, group), F.lit(""))


# The characters Python's str.strip() removes.
SPACES = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
          "\u2028\u2029\u202f\u205f\u3000")


def strip(col) -> Column:
    """Python ``str.strip()``: leading / trailing white space removed, Unicode spaces included."""
    return F.btrim(_c(col), F.lit(SPACES))


def _rules(col: Column, rules: Sequence[tuple[str, str]]) -> Column:
    out = col
    for pattern, repl in rules:
        out = F.regexp_replace(out, pattern, repl)
    return out


# The cleaning rules of the three text profiles, in the reference's order.
QUERY_RULES = [("@" + WORD + "+", ""), ("http" + WORD + "+", ""), (r"\\\(", " "), (r"\\\)", " "),
               ("[ ]{1,}", " "), (r"\.+", "."), (",+", ",")]
PROMPT_RULES = [("http" + WORD + "+", ""), (r"\.+", "."), (",+", ","), (r"\\\(", " "), (r"\\\)", " "),
                ("[ ]{1,}", " ")]
SECOND_RULES = [("@" + WORD + "+", ""), ("http" + WORD + "+", ""), (r"\\\(", " "), (r"\\\)", " "),
                ("[ ]{1,}", " "), (r"\.+", ".")]


def clean_query(col) -> Column:
    """lower case; drop ``@word`` and ``http`` + word characters; LaTeX ``\\(`` / ``\\)``
    to spaces; collapse spaces, dots, commas; strip."""
    return strip(_rules(F.lower(_c(col)), QUERY_RULES))


def clean_prompt(col) -> Column:
    """the prompt profile: no lower-casing or ``@`` rule; dots and commas first."""
    return strip(_rules(_c(col), PROMPT_RULES))


def clean_second(col) -> Column:
    """the second-retrieval profile: F3 without the comma rule."""
    return strip(_rules(F.lower(_c(col)), SECOND_RULES))


def tag_spans(col, tag: str = "response", sep: str = ",") -> Column:
    """every ``<tag>...</tag>`` span (``.`` stops at a newline), joined by ``sep``,
    stripped."""
    return strip(F.array_join(F.regexp_extract_all(_c(col), F.lit(f"<{tag}>([^\n]*?)</{tag}>"), 1), sep))


def split_chain(col, after: str, before: str, last_after: str) -> Column:
    """the text between the first and second ``after`` marker, cut before
    ``before``, newlines stripped at both ends, then the part after the last
    ``last_after``, stripped.  All markers are literal (``substring_index``); without an
    ``after`` marker there is no such text: null."""
    x = F.substring_index(F.substring_index(_c(col), after, 2), after, -1)
    x = F.substring_index(x, before, 1)
    x = F.regexp_replace(x, r"^\n+|\n+$", "")
    return F.when(F.contains(_c(col), F.lit(after)), strip(F.substring_index(x, last_after, -1)))


def fill_template(template: str, **slots) -> Column:
    """F8: fill ``{name}`` slots of a template from columns (null slot -> null)."""
    import re
    pieces, pos = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            pieces.append(F.lit(template[pos:m.start()]))
        pieces.append(_c(slots[m.group(1)]).cast("string"))
        pos = m.end()
    if pos < len(template):
        pieces.append(F.lit(template[pos:]))
    return F.concat(*pieces)


def numbered_list(arr) -> Column:
    """``1. a\\n2. b\\n`` from an array (every line ends with a newline)."""
    return F.array_join(F.transform(_c(arr), lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x,
                                                                   F.lit("\n"))), "")


def normalise_reply(reply, items) -> Column:
    """normalise a model reply against the numbered ``items`` it was shown.

    The leading token is ``^word.?``.  If it has a dot, every occurrence of the token is
    removed and the rest stripped; if the token is the whole text it is a serial number:
    the numbered item (1-based), falling back to item 1; otherwise the text is kept
    (also when no token matches)."""
    text = strip(_c(reply))
    token = F.regexp_extract(text, "^" + WORD + r"+\.?", 0)
    serial = token.try_cast("int")
    pick = F.when((serial >= 1) & (serial <= F.size(_c(items))), F.element_at(_c(items), serial)) \
        .otherwise(F.element_at(_c(items), 1))
    return (F.when((F.length(token) > 0) & token.contains("."), strip(F.replace(text, token, F.lit(""))))
            .when(F.length(token) == F.length(text), pick)
            .otherwise(text))


def key_join(*parts, sep: str = "_") -> Column:
    """key from parts, e.g. ``QuestionId_Answer``."""
    return concat_sep(parts, sep)


def key_part(col, i: int = 0, sep: str = "_") -> Column:
    """i-th part (0-based) of a key (``split('_')[0]``); literal separator."""
    if i == 0:
        return F.substring_index(_c(col), sep, 1)
    return F.element_at(F.split(_c(col), _re_escape(sep)), i + 1)


def row_id(study, condition, level) -> Column:
    """``<study>_<condition lower, spaces to _>_<level lower, / to _>``."""
    return F.concat(_c(study).cast("string"), F.lit("_"), F.replace(F.lower(_c(condition)), F.lit(" "), F.lit("_")),
                    F.lit("_"), F.replace(F.lower(_c(level)), F.lit("/"), F.lit("_")))


def image_path(root: str, study, series, instance, ext: str = ".dcm") -> Column:
    """``<root>/train_images/<study>/<series>/<instance>.dcm``."""
    return F.concat(F.lit(f"{root}/train_images/"), _c(study).cast("string"), F.lit("/"),
                    _c(series).cast("string"), F.lit("/"), _c(instance).cast("string"), F.lit(ext))


def ids_to_array(col, sep: str = " ") -> Column:
    """space-separated ids -> array<bigint> (empty string -> empty array)."""
    return F.transform(F.filter(F.split(_c(col), _re_escape(sep)), lambda s: F.length(s) > 0),
                       lambda s: s.cast("bigint"))


def array_to_ids(col, sep: str = " ") -> Column:
    """array of ids -> space-separated string."""
    return F.array_join(F.transform(_c(col), lambda x: x.cast("string")), sep)


def path_stem_id(col) -> Column:
    """last path part without extension, as a long."""
    return F.regexp_extract(_c(col), r"([^/]+?)(\.[^./]*)?$", 1).try_cast("bigint")


def path_part(col, from_end: int) -> Column:
    """path component counted from the end (1 = file name, 2 = its folder, ...)."""
    return F.element_at(F.split(_c(col), "/"), -from_end)


def zero_pad(col, width: int = 3) -> Column:
    """ordinal as fixed-width zero-padded text (``%03d``)."""
    return F.format_string(f"%0{width}d", _c(col))


def _re_escape(s: str) -> str:
    import re
    return re.escape(s)
