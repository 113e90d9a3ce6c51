"""Links to snapshot files: found in stored pages, reduced to the newest date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certweave.functions import text as X

# The patterns of an anchor, its target, a URL's parts and a dated file name.
ANCHOR = "(?is)<a\\s[^>]*?href\\s*=\\s*(?:\"[^\"]*\"|'[^']*'|[^\\s>\"']+)"
TARGET = "(?is)href\\s*=\\s*(?:\"([^\"]*)\"|'([^']*)'|([^\\s>\"']+))$"
URL_PARTS = "^([A-Za-z][A-Za-z0-9+.\\-]*:)?(//[^/?#]*)?([^?#]*)(\\?[^#]*)?(#.*)?$"
DATED_NAME = "(?i)data-(\\d{8})-"


def _numeric_references(text: Column) -> Column:
    """``&#39;`` and ``&#x27;`` as characters; numbers that are no character stay."""
    def put(acc: Column, written: Column, code: Column) -> Column:
        character = (code >= 1) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(character, code)), 8, "0")), "UTF-32")
        return F.when(character, F.replace(acc, written, char)).otherwise(acc)

    def each(acc: Column, pattern: str, lead: str, base: int) -> Column:
        found = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))
        return F.aggregate(found, acc, lambda a, r: put(a, F.concat(F.lit(lead), r, F.lit(";")), F.conv(r, base, 10).cast("bigint")))

    plain = each(each(text, "&#([0-9]{1,7});", "&#", 10), "&#x([0-9A-Fa-f]{1,6});", "&#x", 16)
    return F.when(text.contains("&#"), plain).otherwise(text)


def page_hrefs(html: Column) -> Column:
    """Targets of all anchors in page order, with the common character references resolved."""
    def target(tag: Column) -> Column:
        text = F.concat(*[F.regexp_extract(tag, TARGET, g) for g in (1, 2, 3)])
        text = _numeric_references(text)
        for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
            text = F.replace(text, F.lit(entity), F.lit(char))
        return X.strip(text)

    return F.transform(F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(0)), target)


def _without_dots(path: Column) -> Column:
    """``.`` and ``..`` steps of an absolute path worked out."""
    parts = F.split(path, "/")
    step = lambda acc, p: (
        F.when(p == ".", acc).when(p == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1)))).otherwise(F.concat(acc, F.array(p))))
    kept = F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), F.array(F.lit("")), step)
    # a path that ends in a dot step names a folder
    return F.concat(F.array_join(kept, "/"), F.when(path.rlike("/\\.{1,2}$"), "/").otherwise(""))


def absolute_url(base: Column, href: Column) -> Column:
    """``href`` resolved against ``base`` taken as a folder."""
    part = lambda u, g: F.regexp_extract(u, URL_PARTS, g)
    folder = F.concat(base, F.lit("/"))
    scheme, host = part(folder, 1), part(folder, 2)
    directory = F.regexp_replace(part(folder, 3), "[^/]*$", "")
    path, query, fragment = part(href, 3), part(href, 4), part(href, 5)
    rest = F.concat(query, fragment)
    whole_path = F.when(path.startswith("/"), path).otherwise(F.concat(F.when(directory == "", "/").otherwise(directory), path))
    return (
        F.when(part(href, 1) != "", href)
        .when(part(href, 2) != "", F.concat(scheme, href))
        .when(path != "", F.concat(scheme, host, F.when(whole_path.contains("/."), _without_dots(whole_path)).otherwise(whole_path), rest))
        .when(query != "", F.concat(scheme, host, part(folder, 3), rest))
        .otherwise(F.concat(scheme, host, part(folder, 3), part(folder, 4), fragment))
    )


def extract_links(pages: DataFrame, *, key: str = "page_id", base: str = "url", html: str = "html", suffix: str = ".xml") -> DataFrame:
    """(key, pos, link): the page's links with the suffix, absolute, each once, in order. Works inside the row."""
    hrefs = page_hrefs(F.col(html))
    if suffix:
        ending = lambda u: F.lower(u).endswith(suffix) | F.lower(u).contains(suffix + "?")
        hrefs = F.filter(hrefs, ending)
    links = F.array_distinct(F.transform(hrefs, lambda u: absolute_url(F.col(base), u)))
    return pages.select(key, F.posexplode(links).alias("pos", "link"))


def snapshot_date(url: Column) -> Column:
    """``YYYYMMDD`` of a name with ``data-YYYYMMDD-`` in the last step of its path, or null."""
    path = F.regexp_extract(url, URL_PARTS, 3)
    name = F.regexp_extract(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "([^/]*)/*$", 1)
    return F.nullif(F.regexp_extract(name, DATED_NAME, 1), F.lit(""))


def latest_snapshot(urls: DataFrame, column: str = "url") -> DataFrame:
    """Rows of the newest date, all ties kept; every row when no name has a date.

    The newest date is a scalar subquery: one small aggregate, no global window.
    """
    dated = urls.withColumn("snapshot_date", snapshot_date(F.col(column)))
    newest = dated.agg(F.max("snapshot_date").alias("d")).scalar()
    return dated.where(newest.isNull() | (F.col("snapshot_date") == newest))
