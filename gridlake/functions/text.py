"""Text cleaning for headlines and URLs.

Tag stripping, whitespace collapsing and host extraction are JVM regular
expressions. HTML entity decoding needs the full HTML5 entity table, so it is
an Arrow-batched pandas UDF (feeds are cleaned where they are parsed instead).
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from gridlake.functions.time import col

# --- Fixed values: patterns ----------------------------------------------------
TAG_PATTERN = r"<[^>]+>"
# ``(?U)`` makes ``\s`` Unicode-aware (NBSP and friends); Python also counts the
# information separators U+001C..U+001F as whitespace.
SPACE_PATTERN = r"(?U)[\s\x1c-\x1f]+"
XML_ILLEGAL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\uFFFE\uFFFF]"
HOST_PATTERN = r"^[^:/?#]+://([^/?#]*)"
# -----------------------------------------------------------------------------


def _unescape_fn():
    # A nested function is shipped to the Python workers by value, so they do
    # not need this package installed.
    def unescape(texts: pd.Series) -> pd.Series:
        """``html.unescape`` over an Arrow batch; NULL stays NULL."""
        return texts.map(lambda t: html.unescape(t) if isinstance(t, str) and "&" in t else t)

    return unescape


html_unescape = F.pandas_udf(_unescape_fn(), StringType())


def clean_text(text: Column | str) -> Column:
    """Strip tags, decode entities, collapse whitespace, trim; NULL -> ''."""
    stripped = F.regexp_replace(F.coalesce(col(text), F.lit("")), TAG_PATTERN, "")
    return F.trim(F.regexp_replace(html_unescape(stripped), SPACE_PATTERN, " "))


def url_host(url: Column | str) -> Column:
    """Network location of a URL (host, with port or user info if present);
    the URL itself when it has none."""
    host = F.regexp_extract(col(url), HOST_PATTERN, 1)
    return F.when(host == "", col(url)).otherwise(host)


def xml_escape(text: Column | str) -> Column:
    """Text as XML content: markup escaped, characters that XML 1.0 forbids dropped."""
    out = F.regexp_replace(col(text), XML_ILLEGAL, "")
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(sign), F.lit(name))
    return out


def split_list(text: Column | str, sep: str = ",") -> Column:
    """``"a, b,,c"`` -> ``["a", "b", "c"]``: split, trim, drop empties."""
    return F.filter(F.transform(F.split(col(text), sep), lambda x: F.trim(x)), lambda x: x != "")
