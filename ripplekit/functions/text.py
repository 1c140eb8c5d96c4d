"""String, URL and token expressions; all built from JVM-side functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The mention, hashtag and short-link patterns of the data formats.
MENTION_PATTERN = r"//@([^:：。./@\-，,【\[ ]*)"
HASHTAG_PATTERN = r"#([^\s\[\]]+)"
SHORT_URL_PATTERN = r"(http://(sinaurl\.cn|t\.cn)/(\w+))"
URL_PATTERN = r"^http://([a-zA-Z0-9\-.]+)/(.*)$"


def mentions(text: Column) -> Column:
    """Names of the repost chain ``//@name``, in text order."""
    return F.regexp_extract_all(text, F.lit(MENTION_PATTERN), F.lit(1))


def hashtags(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(HASHTAG_PATTERN), F.lit(1))


def _group(text: Column, pattern: str, idx: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, idx), F.lit(""))


def first_short_url(text: Column) -> Column:
    """First short link in full (empty when there is none)."""
    return F.regexp_extract(text, SHORT_URL_PATTERN, 1)


def short_url_parts(full: Column) -> dict[str, Column]:
    """Base and hash of a short link; the link is split, not matched again."""
    return {
        "base": F.nullif(F.split_part(full, F.lit("/"), F.lit(3)), F.lit("")),
        "hash": F.nullif(F.split_part(full, F.lit("/"), F.lit(4)), F.lit("")),
    }


def short_url(text: Column) -> Column:
    """First short link as ``struct<full, base, hash>`` (null fields when absent)."""
    full = first_short_url(text)
    return F.struct(
        F.nullif(full, F.lit("")).alias("full"),
        *[part.alias(name) for name, part in short_url_parts(full).items()],
    )


def url_parts(url: Column) -> Column:
    """``struct<base, path>`` of an ``http://`` URL."""
    return F.struct(
        _group(url, URL_PATTERN, 1).alias("base"), _group(url, URL_PATTERN, 2).alias("path")
    )


def last_components(name: Column, n: int = 1) -> Column:
    """Last ``n`` of the ``', '``-separated parts of a place name, joined by commas."""
    parts = F.split(name, ", ")
    return F.concat_ws(",", F.slice(parts, F.greatest(F.size(parts) - (n - 1), F.lit(1)), F.lit(n)))


def parse_pg_array(text: Column, element: str = "string") -> Column:
    """``{a,b}`` text to an array; quoted items may hold commas."""
    if element == "string":
        items = F.regexp_extract_all(
            F.regexp_replace(text, r"^\{|\}$", ""), F.lit(r'("(?:[^"])*"|[^,]+)'), F.lit(1)
        )
        return F.transform(items, lambda x: F.regexp_replace(x, r'^"|"$', ""))
    return F.from_json(F.translate(text, "{}", "[]"), f"array<{element}>")


def format_pg_array(items: Column) -> Column:
    quoted = F.transform(
        items,
        lambda x: F.when(x.contains(","), F.concat(F.lit('"'), x, F.lit('"'))).otherwise(x),
    )
    return F.concat(F.lit("{"), F.concat_ws(",", quoted), F.lit("}"))


def csv_quote(text: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))


def page_range(spec: Column) -> Column:
    """``"3-7"`` or ``"3"`` to ``struct<first, last>``; null when not a range."""
    pattern = r"^(\d+)-?(\d*)"
    first = F.regexp_extract(spec, pattern, 1).try_cast("int")
    last = F.regexp_extract(spec, pattern, 2).try_cast("int")
    return F.struct(first.alias("first"), F.coalesce(last, first).alias("last"))


def _han_grams(run: Column) -> Column:
    return F.when(F.length(run) < 2, F.array(run)).otherwise(
        F.transform(F.sequence(F.lit(1), F.length(run) - 1), lambda i: F.substr(run, i, F.lit(2)))
    )


def tokens(text: Column) -> Column:
    """Lower-cased words; runs of Han characters become overlapping bigrams.

    Only rows that hold Han characters pay for setting the runs apart.
    """
    lowered = F.lower(text)
    separators = r"[^\p{L}\p{N}\p{M}]+"
    spaced = F.regexp_replace(lowered, r"(\p{IsHan}+)", " $1 ")
    with_grams = F.flatten(
        F.transform(
            F.split(spaced, separators),
            lambda w: F.when(w.rlike(r"^\p{IsHan}"), _han_grams(w)).otherwise(F.array(w)),
        )
    )
    has_han = (F.octet_length(text) != F.length(text)) & text.rlike(r"\p{IsHan}")
    words = F.when(has_han, with_grams).otherwise(F.split(lowered, separators))
    return F.array_remove(words, "")


def term_counts(token_array: Column) -> Column:
    """``array<struct<term, tf>>`` of one row's tokens.

    Sorting the row's own array and measuring run lengths counts terms inside
    the row, so building postings needs no shuffle.  Each intermediate array
    is bound by a one-element ``transform`` so that it is computed once per row.
    """

    def runs(sorted_tokens: Column, starts: Column) -> Column:
        end = F.size(sorted_tokens) + 1
        return F.transform(
            starts,
            lambda start, k: F.struct(
                F.get(sorted_tokens, start - 1).alias("term"),
                (F.coalesce(F.get(starts, k + 1), end) - start).alias("tf"),
            ),
        )

    def count_sorted(sorted_tokens: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(1), F.size(sorted_tokens)),
            lambda i: ~F.get(sorted_tokens, i - 1).eqNullSafe(F.get(sorted_tokens, i - 2)),
        )
        return F.get(F.transform(F.array(starts), lambda s: runs(sorted_tokens, s)), 0)

    counted = F.transform(F.filter(F.array(F.sort_array(token_array)), lambda a: F.size(a) > 0), count_sorted)
    return F.get(counted, 0)
