"""URLs: resolving, canonical form and detail signals."""

from __future__ import annotations

from urllib.parse import quote, urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticelake.functions.rules import DETAIL_KEY, DETAIL_PARAM, DETAIL_PATH, LIST_QUERY_KEYS


@F.pandas_udf(T.StringType())
def absolute_url(href: pd.Series, base: pd.Series) -> pd.Series:
    """Resolve against a base, percent-encoded; what is no web address becomes empty."""

    def one(h: str | None, b: str | None) -> str:
        try:
            url = urljoin(b or "", (h or "").strip())
            return quote(url, safe="%/:?#[]@!$&'()*+,;=~-._") if urlsplit(url).scheme else ""
        except ValueError:
            return ""

    return pd.Series([one(h, b) for h, b in zip(href, base, strict=True)])


def query_keys(url: Column) -> Column:
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    return F.filter(F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, r"^([^=]*)", 1)), lambda x: x != "")


def canonical_url(url: Column) -> Column:
    """Without fragment, list parameters and a last slash, parameters in order of key; routing keys stay beside an identity."""
    whole = F.regexp_replace(url, r"#.*$", "")
    path, query = F.regexp_extract(whole, r"^([^?]*)", 1), F.regexp_extract(whole, r"^[^?]*\?(.*)$", 1)
    key = lambda x: F.regexp_extract(x, r"^([^=]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda x: x != "")
    identity = F.exists(pairs, lambda x: key(x).rlike(DETAIL_PARAM))
    keeps = lambda x: ~key(x).isin(LIST_QUERY_KEYS) | key(x).rlike(DETAIL_PARAM) | (identity & key(x).rlike(r"(?i)^(?:menuNo|mId)$"))
    ordered = F.array_sort(F.transform(F.filter(pairs, keeps), lambda x, i: F.struct(F.lower(key(x)).alias("k"), i.alias("i"), x.alias("x"))))
    kept = F.array_join(F.transform(ordered, lambda x: x["x"]), "&")
    return F.regexp_replace(F.concat(path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")), "/$", "")


def has_detail_signal(url: Column) -> Column:
    path = F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://[^/?#]*([^?#]*)", 1)
    return path.rlike(DETAIL_PATH) | F.exists(query_keys(url), lambda k: k.rlike(DETAIL_KEY))


def is_url(url: Column) -> Column:
    return url.rlike(r"^[a-zA-Z][\w+.-]*://[^\s/?#]+")
