"""URL normalisation and checks as native column expressions (one linear chain, no Python)."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsflow.constants import AUTHORITY_SCHEMES, PARAM_SCHEMES

SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*:"


def _any_of(schemes):
    return "(?i:" + "|".join(re.escape(s) for s in schemes) + "):"


# Leading control characters and blanks, and tab / CR / LF anywhere.
_JUNK = r"\A[\x00-\x20]+|[\t\r\n]"
_FRAGMENT = r"(?s)#.*"
_EMPTY_QUERY = r"\A([^?]*+)\?\z"
# A ";" closing the last path segment. A host without a path has no segment to close, and schemes
# that do not know parameters keep the character.
_EMPTY_PARAMS = (
    rf"(?s)\A(?:(?={_any_of(PARAM_SCHEMES)})|(?!{SCHEME}))"
    rf"(?!(?:{SCHEME})?//[^/?]*(?:\?|\z))"
    r"((?:[^?]*/)?[^/?;]*);(?=\?|\z)"
)
# "//" with no host: kept or added for schemes that own hosts, dropped for all others.
_NO_HOST = r"(?=/(?!/)|\?|\z)"
_ADD_SLASHES = rf"\A({_any_of(AUTHORITY_SCHEMES)}){_NO_HOST}"
_DROP_SLASHES = rf"\A(?!{_any_of(AUTHORITY_SCHEMES)})({SCHEME})?//{_NO_HOST}"
_PREFIX = rf"\A(?:{SCHEME})?(?://[^/?#]*)?"


def normalize_url(url: Column) -> Column:
    """Lower-case scheme and authority, drop the fragment, keep path case and the query."""
    u = F.regexp_replace(url, _JUNK, "")
    u = F.regexp_replace(u, _FRAGMENT, "")
    u = F.regexp_replace(u, _EMPTY_QUERY, "$1")
    u = F.regexp_replace(u, _EMPTY_PARAMS, "$1")
    u = F.regexp_replace(u, _ADD_SLASHES, "$1//")
    u = F.regexp_replace(u, _DROP_SLASHES, "$1")
    prefix = F.regexp_extract(u, _PREFIX, 0)
    return F.concat(F.lower(prefix), F.substring(u, F.length(prefix) + 1, F.length(u)))


def canonical_key(url: Column) -> Column:
    """Hex SHA-256 of the normalised URL."""
    return F.sha2(normalize_url(url), 256)


def is_http_url(url: Column) -> Column:
    """Starts with http:// or https://, case-sensitive; null is not a URL."""
    return F.coalesce(url.startswith("http://") | url.startswith("https://"), F.lit(False))


def is_well_formed_url(url: Column) -> Column:
    """Both a scheme and a host are there."""
    return F.coalesce(
        F.regexp_replace(url, _JUNK, "").rlike(rf"\A{SCHEME}//[^/?#]"), F.lit(False)
    )
