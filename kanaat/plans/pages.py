"""Links, texts and page runs from fetched pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from kanaat.functions import text as T
from kanaat.functions.fixed_values import DATE_NOT_FOUND
from kanaat.operators import extract, sequences
from kanaat.plans.registry import SPACE, query
from kanaat.sources.tables import spread, table

# Part of an address, in the role of the market name.
MARKET = "re"
HREFS = """hrefs AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"', 1)) AS href,
  generate_subscripts(regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"', 1), 1) AS pos FROM pages)"""
LINKS = f"""{HREFS}, links AS (SELECT page_id, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || href AS link,
  min(pos) AS pos FROM hrefs WHERE contains(href, '{MARKET}') GROUP BY ALL)"""


def _pages(spark, folder):
    return spread(table(spark, folder, "pages"))


@query(
    "page_links",
    f"""WITH {LINKS} SELECT page_id, link, (row_number() OVER (PARTITION BY page_id ORDER BY pos))::INTEGER AS position FROM links""",
)
def page_links(spark, folder):
    return extract.plain_links(_pages(spark, folder), "page_id", "url", "html", MARKET)


@query(
    "selected_links",
    f"""WITH {LINKS} SELECT page_id, link, (row_number() OVER (PARTITION BY page_id ORDER BY pos))::INTEGER AS position FROM links""",
)
def selected_links(spark, folder):
    chosen = [".complaint-card a", 'nav li a[href*="{market}"]']
    return extract.page_links(_pages(spark, folder), "page_id", "url", "html", MARKET, chosen)


ARTICLE = rf"""articles AS (SELECT page_id, regexp_replace(regexp_replace(regexp_extract(html, '<article>(.*?)</article>', 1, 's'),
  '<[^>]*>', '', 'g'), '[{SPACE}]+', ' ', 'g') AS raw FROM pages WHERE contains(html, '<article>')),
texts AS (SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(raw, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
  '&#39;', ''''), '&nbsp;', ' '), '&amp;?', '&', 'g')) AS text FROM articles)"""


@query(
    "complaints",
    f"""WITH {ARTICLE} SELECT page_id, text, '{DATE_NOT_FOUND}' AS date_text FROM texts WHERE text <> ''""",
)
def complaints(spark, folder):
    return extract.complaints(
        _pages(spark, folder), ["page_id"], "html", ["div.complaint-description", "article"], ["div.time"]
    )


ITEMS = r"""items AS (SELECT page_id, unnest(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1)) AS word,
  generate_subscripts(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1), 1) AS position FROM pages)"""


@query(
    "review_cards",
    f"""WITH {ITEMS} SELECT page_id, position::INTEGER AS position, word AS date_text, word AS text FROM items WHERE trim(word) <> ''""",
)
def review_cards(spark, folder):
    return extract.reviews(_pages(spark, folder), ["page_id"], "html", "nav li", ["div.none", "a"], ["a[href]"])


@query(
    "forum_entries",
    f"""WITH {ITEMS} SELECT page_id, position::INTEGER AS position, word AS content, '{DATE_NOT_FOUND}' AS date_text,
  word AS full_content FROM items WHERE trim(word) <> ''""",
)
def forum_entries(spark, folder):
    return extract.entries(_pages(spark, folder), ["page_id"], "html", "nav li", ["a"])


@query(
    "rejected_pages",
    """SELECT page_id, url, 'Sayfa ' || page_id || ' yüklenemedi: ' || url AS line FROM pages WHERE NOT starts_with(url, 'https://')""",
)
def rejected_pages(spark, folder):
    return extract.good_and_rejected(
        table(spark, folder, "pages"), F.startswith("url", F.lit("https://")), "page_id", "url"
    )[1]


@query(
    "complete_records",
    r"""WITH r AS (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS text,
  regexp_extract(url, 'page=(\d+)', 1) AS date_text FROM pages) SELECT * FROM r WHERE trim(text) <> '' AND trim(date_text) <> ''""",
)
def complete_records(spark, folder):
    records = table(spark, folder, "pages").select(
        "page_id",
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("text"),
        F.regexp_extract("url", r"page=(\d+)", 1).alias("date_text"),
    )
    return extract.complete(records, "text", "date_text")


NUMBER = r"regexp_extract(split_part(split_part(url, '?', 1), '#', 1), '([0-9]+)$', 1)"


def _page_number():
    return F.regexp_extract(F.regexp_replace("url", r"[?#].*$", ""), "([0-9]+)$", 1)


@query(
    "first_pages",
    f"SELECT page_id, url, try_cast({NUMBER} AS INTEGER) AS page FROM pages WHERE try_cast({NUMBER} AS INTEGER) BETWEEN 1 AND 500",
)
def first_pages(spark, folder):
    numbered = table(spark, folder, "pages").select("page_id", "url", _page_number().try_cast("int").alias("page"))
    return extract.first_pages(numbered, "page", 500)


@query(
    "first_non_empty",
    rf"""SELECT page_id, coalesce(nullif(trim(regexp_extract(url, 'ref=(\w*)', 1)), ''), nullif(trim(regexp_extract(url, '#(\w+)', 1)), ''),
  '{DATE_NOT_FOUND}') AS mark FROM pages""",
)
def first_non_empty(spark, folder):
    mark = extract.first_present(F.regexp_extract("url", r"ref=(\w*)", 1), F.regexp_extract("url", r"#(\w+)", 1))
    return table(spark, folder, "pages").select("page_id", F.coalesce(mark, F.lit(DATE_NOT_FOUND)).alias("mark"))


@query(
    "url_parts",
    """SELECT page_id, split_part(url, '?', 1) AS base, split_part(list_last(string_split(split_part(url, '?', 1), '/')), '--', 1) AS topic,
  split_part(url, '?', 1) || '?p=' || page_id AS page_url, regexp_extract(url, '^[a-z]+://[^/?#]*') || '/x/y' AS linked FROM pages""",
)
def url_parts(spark, folder):
    base = T.url_without_query(F.col("url"))
    return table(spark, folder, "pages").select(
        "page_id",
        base.alias("base"),
        T.topic_name(F.col("url")).alias("topic"),
        T.page_url(base, "p", F.col("page_id")).alias("page_url"),
        T.absolute_link(F.col("url"), F.lit("/x/y")).alias("linked"),
    )


@query(
    "pages_until_failure",
    """WITH p AS (SELECT page_id, split_part(split_part(url, '//', 2), '/', 2) AS topic, contains(html, '&lt;') OR length(html) > 6000 AS failed FROM pages)
SELECT page_id, topic FROM p QUALIFY max(failed::INTEGER) OVER (PARTITION BY topic ORDER BY page_id ROWS UNBOUNDED PRECEDING) = 0""",
)
def pages_until_failure(spark, folder):
    pages = table(spark, folder, "pages").select(
        "page_id",
        F.split_part(F.split_part("url", F.lit("//"), F.lit(2)), F.lit("/"), F.lit(2)).alias("topic"),
        (F.contains("html", F.lit("&lt;")) | (F.length("html") > 6000)).alias("bad"),
    )
    return sequences.until_first_failure(pages, "topic", "page_id", F.col("bad")).select("page_id", "topic")


@query(
    "numbered_links",
    f"""WITH {HREFS} SELECT page_id, pos::BIGINT AS position, row_number() OVER (ORDER BY page_id, pos) AS number, href AS item FROM hrefs""",
)
def numbered_links(spark, folder):
    hrefs = F.regexp_extract_all("html", F.lit('<a\\s[^>]*?href="([^"]*)"'), F.lit(1))
    return sequences.numbered_items(_pages(spark, folder).select("page_id", "html"), "page_id", hrefs)


@query(
    "seen_links_removed",
    f"""WITH {HREFS}, seen AS (SELECT DISTINCT '/' || split_part(text, ' ', 1) AS href FROM documents)
SELECT href, count(*)::BIGINT AS n FROM hrefs WHERE href NOT IN (SELECT href FROM seen WHERE href IS NOT NULL) GROUP BY href""",
)
def seen_links_removed(spark, folder):
    hrefs = F.regexp_extract_all("html", F.lit('<a\\s[^>]*?href="([^"]*)"'), F.lit(1))
    found = _pages(spark, folder).select(F.explode(hrefs).alias("href")).groupBy("href").agg(F.count(F.lit(1)).alias("n"))
    seen = table(spark, folder, "documents").select(
        F.concat(F.lit("/"), F.split_part("text", F.lit(" "), F.lit(1))).alias("href")
    ).distinct()
    return found.join(seen, "href", "left_anti")
