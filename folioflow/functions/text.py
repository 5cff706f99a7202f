"""Text functions as column expressions: tokens, previews, paths, dates, labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that a retrieval query and a topic query leave out.
RETRIEVAL_STOPWORDS = ("a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the", "this", "to", "was", "were", "with")
TOPIC_STOPWORDS = ("a", "an", "and", "are", "for", "from", "in", "of", "on", "or", "the", "to", "with")
TOKEN = r"[a-z0-9]+(?:'[a-z0-9]+)?"


def _meaningful(tokens: Column, stopwords: Sequence[str]) -> Column:
    kept = F.filter(tokens, lambda t: (F.length(t) >= 2) & ~t.isin(*stopwords))
    return F.when(F.size(kept) > 0, kept).otherwise(tokens)


def retrieval_tokens(text: Column) -> Column:
    """Lower-case words and numbers without stopwords and single characters; a text of nothing else keeps them. Empty for null."""
    return _meaningful(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({TOKEN})")), RETRIEVAL_STOPWORDS)


def section_weighted_tokens(text: Column, section_path: Column, multiplier: int = 2) -> Column:
    """The text's tokens and, ``multiplier`` times, those of its section path."""
    section = retrieval_tokens(F.array_join(section_path, " "))
    own = F.when(F.size(F.coalesce(section_path, F.array().cast("array<string>"))) > 0, section).otherwise(F.array().cast("array<string>"))
    return F.concat(retrieval_tokens(text), F.flatten(F.array_repeat(own, multiplier)))


def query_terms(query: str, stopwords: Sequence[str] = RETRIEVAL_STOPWORDS) -> list[str]:
    """The distinct terms of a query text in order of appearance, by the same rule as ``retrieval_tokens``."""
    import re

    tokens = re.findall(TOKEN, query.lower())
    kept = [t for t in tokens if len(t) >= 2 and t not in stopwords]
    return list(dict.fromkeys(kept or tokens))


def value_text(column: Column, is_array: bool) -> Column:
    """A string as it is, an array joined by blanks without its nulls, empty for null."""
    return F.coalesce(F.array_join(column, " ") if is_array else column, F.lit(""))


def preview(text: Column, limit: int, ellipsis: str = "") -> Column:
    """White space collapsed and cut to ``limit`` characters, with an ellipsis where something was cut."""
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))
    cut = F.concat(F.rtrim(F.substring(flat, 1, limit)), F.lit(ellipsis)) if ellipsis else F.substring(flat, 1, limit)
    return F.when(F.length(flat) > limit, cut).otherwise(flat)


def markdown_cell(text: Column) -> Column:
    return F.trim(F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" ")))


def collapsed(text: Column) -> Column:
    """White space runs as one blank, trimmed; empty for null."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))


def without_version(arxiv_id: Column) -> Column:
    return F.regexp_replace(F.trim(arxiv_id), r"v\d+$", "")


# What a venue text calls an acceptance, in order of precedence.
ACCEPT_TYPES = (("notable top 25%", "Notable Top 25%"), ("notable top 5%", "Notable Top 5%"), ("spotlight", "Spotlight"), ("oral", "Oral"), ("poster", "Poster"))


def accept_type(venue: Column) -> Column:
    """The kind of acceptance that a venue text names, else its last word capitalised; empty for null and blank."""
    text = F.trim(F.coalesce(venue, F.lit("")))
    last = F.lower(F.element_at(F.split(text, r"\s+"), -1))
    out = F.concat(F.upper(F.substring(last, 1, 1)), F.substr(last, F.lit(2)))
    for pattern, name in reversed(ACCEPT_TYPES):
        out = F.when(F.lower(text).contains(pattern), name).otherwise(out)
    return out


def absolute_url(path: Column, base: str) -> Column:
    clean = F.trim(F.coalesce(path, F.lit("")))
    return F.when(clean == "", "").when(clean.rlike("^(?i)https?://"), clean).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), F.ltrim(F.regexp_replace(clean, "^/+", ""))))


def hostname(url: Column) -> Column:
    """The host in lower case; null where there is none."""
    return F.lower(F.nullif(F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def domain_policy(host: Column, policies: Sequence[tuple[str, str]], default: str) -> Column:
    """The value of the first domain that equals the host or that it is a subdomain of."""
    out = F.lit(default)
    for domain, value in reversed(policies):
        out = F.when((host == domain) | host.endswith("." + domain), value).otherwise(out)
    return out


def asset_path(key: Column, kind: str, extension: str) -> Column:
    """``kind/aa/bb/key.extension`` from the key's first characters."""
    return F.concat_ws("/", F.lit(kind), F.substring(key, 1, 2), F.substring(key, 3, 2), F.concat(key, F.lit("." + extension.lstrip("."))))


def safe_path_component(value: Column) -> Column:
    """Everything but ASCII letters, digits, dot, underscore and hyphen as one hyphen; null where nothing is left."""
    return F.nullif(F.btrim(F.regexp_replace(value, r"[^A-Za-z0-9._-]+", "-"), F.lit(".-_")), F.lit(""))


def safe_name(value: Column) -> Column:
    return F.translate(F.trim(value), "/\\: -", "_____")


def human_bytes(size: Column) -> Column:
    """Bytes with two decimals in the first unit that keeps the number under 1024."""
    value, units = size.cast("double"), ("B", "KiB", "MiB", "GiB", "TiB", "PiB")
    out = F.format_string("%.2f " + units[-1], value / 1024.0 ** (len(units) - 1))
    for power, unit in reversed(list(enumerate(units[:-1]))):
        out = F.when(value < 1024.0 ** (power + 1), F.format_string("%.2f " + unit, value / 1024.0**power)).otherwise(out)
    return out


def local_iso(timestamp: Column, zone: str = "Asia/Shanghai", offset: str = "+08:00") -> Column:
    """A UTC timestamp as ISO text of a zone, to the second."""
    return F.concat(F.date_format(F.from_utc_timestamp(timestamp, zone), "yyyy-MM-dd'T'HH:mm:ss"), F.lit(offset))


def day_text(timestamp: Column) -> Column:
    return F.coalesce(F.date_format(timestamp, "yyyy-MM-dd"), F.lit(""))


def uppercase_share(text: Column) -> Column:
    letters = F.regexp_count(text, F.lit(r"\p{L}"))
    return F.when(letters > 0, F.regexp_count(text, F.lit(r"\p{Lu}")) / letters).otherwise(F.lit(0.0))


def page_range(first: Column, last: Column, fallback: Column) -> Column:
    a, b = F.nullif(F.trim(first), F.lit("")), F.nullif(F.trim(last), F.lit(""))
    return F.coalesce(F.when(a.isNotNull() & b.isNotNull(), F.concat(a, F.lit("-"), b)), a, F.trim(fallback), F.lit(""))


def split_names(names: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(names, F.lit("")), ","), lambda n: F.trim(n)), lambda n: n != "")


def is_empty(column: Column, kind: str) -> Column:
    """Null, the empty string, the empty array or map; zero and false aren't empty."""
    if kind == "string":
        return column.isNull() | (column == "")
    return column.isNull() | (F.size(column) == 0) if kind.startswith(("array", "map")) else column.isNull()
