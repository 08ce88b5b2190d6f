"""What built-in functions can't say: entity decoding, percent decoding.  Arrow-batched."""

from __future__ import annotations

import html
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .text import asset_key, without_tags


@F.pandas_udf(StringType())
def _unescape(text: pd.Series) -> pd.Series:
    return text.map(html.unescape, na_action="ignore")


@F.pandas_udf(StringType())
def _unquote(text: pd.Series) -> pd.Series:
    return text.map(unquote, na_action="ignore")


def plain_text(text: Column) -> Column:
    """Visible text of an HTML fragment: entities first, then tags, then white space."""
    return without_tags(_unescape(text))


def link_key(link: Column) -> Column:
    """A link as a key, with percent signs decoded."""
    # what decoding may bring in must be normalised as well, but not cut at # or ? again
    decoded = _unquote(asset_key(link))
    return F.regexp_replace(F.replace(decoded, F.lit("\\"), F.lit("/")), r"\A(?:\./)+", "")
