"""Small string helpers shared by the record, answer and label builders.

All are native Catalyst expressions (no Python UDF), so they stay inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() removes every character for which str.isspace() holds;
# Spark's trim() removes only U+0020.  Java's Unicode \s plus the four ASCII
# separators U+001C..U+001F covers the same set.
_USPACE = r"[\s\x{1c}-\x{1f}]"
_STRIP_RE = rf"(?U)^{_USPACE}+|{_USPACE}+$"


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ustrip(c: Column | str) -> Column:
    """Python ``str.strip()`` semantics (Unicode whitespace on both ends)."""
    return F.regexp_replace(col_of(c), _STRIP_RE, "")


def regex_quote(literal: str) -> str:
    """Java-regex literal quoting (the analogue of ``re.escape``)."""
    return "\\Q" + literal.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def truthy_json(v: Column) -> Column:
    """Python truthiness of a JSON value given as variant (missing/null -> False): a
    string is true unless empty, whatever it spells."""
    as_text = F.try_variant_get(v, "$", "string")
    spelled = F.schema_of_variant(v) == F.lit("STRING")
    empty = F.when(spelled, as_text == F.lit("")).otherwise(as_text.isin("false", "{}", "[]") | (as_text.try_cast("double") == 0.0))
    return F.coalesce(as_text.isNotNull() & ~F.coalesce(empty, F.lit(False)), F.lit(False))


def html_escape(c: Column | str) -> Column:
    """``html.escape(s, quote=True)``: & < > " ' replaced in that order."""
    out = col_of(c)
    # The five HTML entities html.escape produces.
    for ch, ent in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(ch), F.lit(ent))
    return out


def shorten(c: Column | str, width: int = 40, keep: int = 38) -> Column:
    """Display form used by the per-reason report: ``s[:38] + '..'`` when longer than 40."""
    c = col_of(c)
    return F.when(F.length(c) > width, F.concat(F.substring(c, 1, keep), F.lit(".."))).otherwise(c)
