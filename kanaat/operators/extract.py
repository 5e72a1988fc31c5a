"""From fetched pages to links, complaints, reviews and entries.

Pages are read inside tasks by ``mapInPandas``, one page at a time; what follows is column work."""

from __future__ import annotations

from functools import partial
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kanaat.functions import fixed_values as V
from kanaat.functions import text as T
from kanaat.operators.html import Page


def present(text: Column) -> Column:
    """The stripped text, null when nothing is left."""
    return F.nullif(T.strip_space(text), F.lit(""))


def first_present(*texts: Column) -> Column:
    return F.coalesce(*[present(t) for t in texts])


def complete(df: DataFrame, *columns: str) -> DataFrame:
    """Drop records with an empty text or date."""
    for c in columns:
        df = df.where(present(F.col(c)).isNotNull())
    return df


def good_and_rejected(pages: DataFrame, good: Column, page: str, url: str) -> tuple[DataFrame, DataFrame]:
    """Usable pages, and one line per page that failed."""
    ok = F.coalesce(good, F.lit(False))
    line = F.concat(F.lit("Sayfa "), F.col(page).cast("string"), F.lit(" yüklenemedi: "), F.col(url))
    return pages.where(ok), pages.where(~ok).select(page, url, line.alias("line"))


def first_pages(pages: DataFrame, page: str, most: int) -> DataFrame:
    return pages.where(F.col(page).between(1, most))


def plain_links(pages: DataFrame, page: str, url: str, html: str, market: str) -> DataFrame:
    """Links whose address contains the market name, by pattern alone: position in the page, made
    absolute, each target once per page at its first position."""
    hrefs = F.regexp_extract_all(html, F.lit('<a\\s[^>]*?href="([^"]*)"'), F.lit(1))
    links = pages.select(page, url, F.posexplode(hrefs).alias("_pos", "href")).where(F.contains("href", F.lit(market)))
    return _numbered(links.withColumn("link", T.absolute_link(F.col(url), F.col("href"))), page)


def _numbered(links: DataFrame, page: str) -> DataFrame:
    """Distinct links of a page numbered in page order. Links of one page fit one row, so the page is
    gathered before it is numbered; pages never share a task on account of the market."""
    firsts = links.groupBy(page, "link").agg(F.min("_pos").alias("_pos"))
    ordered = firsts.groupBy(page).agg(F.array_sort(F.collect_list(F.struct("_pos", "link"))).alias("_links"))
    return ordered.select(page, F.posexplode("_links").alias("_i", "_l")).select(
        page, (F.col("_i") + 1).alias("position"), F.col("_l.link").alias("link")
    )


def _read_links(html: str, selectors: list[str], market: str, frames):
    for pdf in frames:
        rows = []
        for i, text in enumerate(pdf[html]):
            read, found = Page(text), []
            for selector in selectors:
                hrefs = [e.get("href") for e in read.select(selector)]
                found = [h for h in hrefs if h and market in h]
                if found:
                    break
            rows += [(i, n, h) for n, h in enumerate(found)]
        if not rows:
            continue
        picked = pdf.drop(columns=[html]).iloc[[r[0] for r in rows]]
        yield picked.assign(_pos=[r[1] for r in rows], href=[r[2] for r in rows])


def page_links(
    pages: DataFrame, page: str, url: str, html: str, market: str, selectors: list[str] | None = None
) -> DataFrame:
    """Links by selector; the next selector counts only where the ones before gave nothing."""
    chosen = [s.format(market=market) for s in selectors or V.COMPLAINT_LINK_SELECTORS]
    kinds = dict(pages.dtypes)
    found = pages.select(page, url, html).mapInPandas(
        partial(_read_links, html, chosen, market), f"{page} {kinds[page]}, {url} string, _pos int, href string"
    )
    return _numbered(found.withColumn("link", T.absolute_link(F.col(url), F.col("href"))), page)


def _first_text(read: Page, selectors: list[str], within=None) -> str | None:
    for selector in selectors:
        for element in islice(read.matches(selector, within), 1):
            text = read.text(element)
            if text:
                return text
    return None


def _read_one(html: str, text_selectors, date_selectors, frames):
    for pdf in frames:
        read = [Page(t) for t in pdf[html]]
        yield pdf.drop(columns=[html]).assign(
            _text=[_first_text(p, text_selectors) for p in read], _date=[_first_text(p, date_selectors) for p in read]
        )


def _read_cards(html: str, card, text_selectors, date_selectors, frames):
    for pdf in frames:
        rows, owner = [], []
        for i, page in enumerate(pdf[html]):
            read = Page(page)
            for n, element in enumerate(read.select(card)):
                owner.append(i)
                rows.append((n, _first_text(read, text_selectors, element), _first_text(read, date_selectors, element)))
        if not rows:
            continue
        yield pdf.drop(columns=[html]).iloc[owner].assign(
            _pos=[r[0] for r in rows],
            _text=pd.Series([r[1] for r in rows], dtype=object).to_numpy(),
            _date=pd.Series([r[2] for r in rows], dtype=object).to_numpy(),
        )


def _schema(df: DataFrame, columns: list[str], extra: str) -> str:
    kinds = dict(df.dtypes)
    return ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", " + extra


def complaints(
    pages: DataFrame,
    keys: list[str],
    html: str,
    text_selectors: list[str] | None = None,
    date_selectors: list[str] | None = None,
) -> DataFrame:
    """One complaint per page: text of the first selector that has any, spaces collapsed; date or the
    stand-in text. Pages without text drop out."""
    read = partial(
        _read_one, html, text_selectors or V.COMPLAINT_TEXT_SELECTORS, date_selectors or [V.COMPLAINT_DATE_SELECTOR]
    )
    found = pages.select(*keys, html).mapInPandas(read, _schema(pages, keys, "_text string, _date string"))
    return found.where(F.col("_text").isNotNull()).select(
        *keys,
        T.collapse_spaces(F.col("_text")).alias("text"),
        F.coalesce("_date", F.lit(V.DATE_NOT_FOUND)).alias("date_text"),
    )


def _cards(pages, keys, html, card, text_selectors, date_selectors) -> DataFrame:
    read = partial(_read_cards, html, card, text_selectors, date_selectors)
    return pages.select(*keys, html).mapInPandas(read, _schema(pages, keys, "_pos int, _text string, _date string"))


def reviews(
    pages: DataFrame,
    keys: list[str],
    html: str,
    card: str = V.REVIEW_CARD_SELECTOR,
    text_selectors: list[str] | None = None,
    date_selectors: list[str] | None = None,
) -> DataFrame:
    """Review cards with text and date; cards lacking either drop out."""
    found = _cards(
        pages, keys, html, card, text_selectors or V.REVIEW_TEXT_SELECTORS, date_selectors or V.REVIEW_DATE_SELECTORS
    )
    return found.where(F.col("_text").isNotNull() & F.col("_date").isNotNull()).select(
        *keys, (F.col("_pos") + 1).alias("position"), F.col("_date").alias("date_text"), F.col("_text").alias("text")
    )


def entries(
    pages: DataFrame,
    keys: list[str],
    html: str,
    entry: str = V.ENTRY_SELECTOR,
    text_selectors: list[str] | None = None,
    date_selectors: list[str] | None = None,
) -> DataFrame:
    """Forum entries: text shortened for storage and put on one line, date or the stand-in text."""
    found = _cards(
        pages, keys, html, entry, text_selectors or [V.ENTRY_TEXT_SELECTOR], date_selectors or V.ENTRY_DATE_SELECTORS
    )
    return found.where(F.col("_text").isNotNull()).select(
        *keys,
        (F.col("_pos") + 1).alias("position"),
        T.flatten_lines(T.shorten(F.col("_text"), V.STORED_LENGTH)).alias("content"),
        F.coalesce("_date", F.lit(V.DATE_NOT_FOUND)).alias("date_text"),
        F.col("_text").alias("full_content"),
    )
