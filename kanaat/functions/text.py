"""Text expressions. Character classes are spelled out, because the \\w, \\s and \\d shorthands of
the regex engines disagree on non-ASCII text; these classes give the same answer everywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kanaat.functions.fixed_values import MIN_WORDS

SPACE = r"\p{IsWhite_Space}\x1C-\x1F"
DROPPED = rf"\p{{Nd}}+|[^\p{{L}}\p{{N}}_{SPACE}]+"
TOKEN = r"[\p{L}\p{N}_]{2,}"


def collapse_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, f"[{SPACE}]+", " "))


def clean_text(text: Column) -> Column:
    """Lower case without digits and punctuation, single spaces; null becomes empty."""
    return F.coalesce(collapse_spaces(F.regexp_replace(F.lower(text), DROPPED, "")), F.lit(""))


def strip_space(text: Column) -> Column:
    return F.regexp_replace(text, f"^[{SPACE}]+|[{SPACE}]+$", "")


def not_blank(text: Column) -> Column:
    return F.coalesce(text.rlike(f"[^{SPACE}]"), F.lit(False))


def has_content(text: Column) -> Column:
    """True when cleaning leaves something: a letter, an underscore or a number that is no digit. Tells
    so at the first such character, without cleaning the text."""
    return F.coalesce(text.rlike(r"[\p{L}\p{Nl}\p{No}_]"), F.lit(False))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[^{SPACE}]+"))


def has_words(text: Column, at_least: int = MIN_WORDS) -> Column:
    """True when the text holds that many words; the match ends at the last word needed."""
    pattern = rf"(?:[^{SPACE}]++[{SPACE}]++){{{at_least - 1}}}[^{SPACE}]"
    return F.coalesce(text.rlike(pattern), F.lit(False))


def shorten(text: Column, length: int) -> Column:
    return F.when(F.length(text) > length, F.concat(F.left(text, F.lit(length)), F.lit("..."))).otherwise(text)


def flatten_lines(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\n"), F.lit(" ")), F.lit("\r"), F.lit(""))


def safe_name(text: Column) -> Column:
    """Every character that is neither letter nor number becomes an underscore."""
    return F.regexp_replace(text, r"[^\p{L}\p{N}]", "_")


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def without(words: Column, stop_words: list[str]) -> Column:
    """Drop stop words and keep repeats of the others."""
    return F.filter(words, lambda w: ~w.isin(stop_words)) if stop_words else words


def unigrams_and_bigrams(words: Column) -> Column:
    count = F.size(words)
    pairs = F.zip_with(
        F.slice(words, F.lit(1), F.greatest(count - 1, F.lit(0))),
        F.slice(words, F.lit(2), F.greatest(count - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return F.concat(words, pairs)


def url_without_query(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def topic_name(url: Column) -> Column:
    """Last path segment up to the first double hyphen."""
    return F.substring_index(F.substring_index(url_without_query(url), "/", -1), "--", 1)


def page_url(base: Column, parameter: str, number: Column) -> Column:
    return F.concat(base, F.lit(f"?{parameter}="), number.cast("string"))


def site_root(url: Column) -> Column:
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)


def _without_dots(link: Column) -> Column:
    """Resolve . and .. in the path of an absolute link."""
    root = site_root(link)
    rest = F.substring(link, F.length(root) + 1, F.length(link))
    path, tail = F.regexp_extract(rest, r"^[^?#]*", 0), F.regexp_extract(rest, r"[?#].*$", 0)
    kept = F.aggregate(
        F.split(path, "/"),
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1))))
        .when(part == ".", done)
        .otherwise(F.concat(done, F.array(part))),
    )
    end = F.when(path.rlike(r"/\.\.?$"), F.lit("/")).otherwise(F.lit(""))
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(root, F.array_join(kept, "/"), end, tail)).otherwise(link)


def absolute_link(base: Column, href: Column) -> Column:
    """Resolve a link against its page: absolute, scheme-relative, root-relative, query only, fragment
    only and relative to the page's folder."""
    root = site_root(base)
    bare = F.regexp_replace(base, r"[?#].*$", "")
    folder = F.concat(root, F.regexp_replace(F.substring(bare, F.length(root) + 1, F.length(bare)), r"[^/]*$", ""))
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, r"^([^:]+:)", 1), href))
        .when(href.startswith("/"), _without_dots(F.concat(root, href)))
        .when(href.startswith("?"), F.concat(bare, href))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, r"#.*$", ""), href))
        .otherwise(_without_dots(F.concat(folder, href)))
    )
