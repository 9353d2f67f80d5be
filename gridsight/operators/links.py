"""Links of a page: a scanner of its tags in Arrow batches, addresses resolved natively."""

import re
from html import unescape

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# what holds no links, and the start of an anchor
_START = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template)(?=[\s/>]).*?(?:</\1\s*>|\Z)|<a(?=[\s/>])", re.I | re.S)
# one attribute: its name, and its value in either kind of quotes or without
_ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)))?""")
_PDF = r"\.pdf$"


def links_of(page: str) -> list[str]:
    """The first ``href`` of every anchor in page order, character references decoded."""
    found, at = [], 0
    while m := _START.search(page, at):
        at = m.end()
        if m[0][:2].lower() != "<a":
            continue
        href = None
        while (a := _ATTRIBUTE.match(page, at)) and a.end() > at:
            at = a.end()
            if href is None and a[1].lower() == "href":
                href = next((v for v in a.groups()[1:] if v is not None), "")
        if href:
            found.append(unescape(href).strip())
    return found


@F.pandas_udf(T.ArrayType(T.StringType()))
def _links(pages: pd.Series) -> pd.Series:
    return pages.map(links_of)


def links(html: Column, pattern: str | None = None) -> Column:
    """Targets of all ``a[href]`` in page order, optionally those a pattern finds.

    Attributes may hold any character between quotes; comments and scripts hold no links.
    """
    targets = F.coalesce(_links(F.coalesce(html, F.lit(""))), F.array().cast("array<string>"))
    if pattern is None:
        return targets
    return F.filter(targets, lambda t: t.rlike("(?i)" + pattern))


def pdf_links(html: Column) -> Column:
    return links(html, _PDF)


def _without_dots(path: Column, squeeze: bool) -> Column:
    """Resolve ``.`` and ``..`` in a path that starts with a slash; a dot segment at the end leaves
    its slash, and ``squeeze`` takes empty segments out."""
    parts = F.split(F.regexp_replace(path, r"(?<=/)\.\.?$", "$0/"), "/", -1)
    if squeeze:
        parts = F.filter(parts, lambda p, i: (p != "") | (i == 0) | (i == F.size(parts) - 1))
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, p: F.when(p == ".", acc)
        .when(p == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc))
        .otherwise(F.array_append(acc, p)),
    )
    return F.array_join(kept, "/")


def absolute(link: Column, base: Column) -> Column:
    """Target made absolute against the address of its page.

    Query and fragment are split off first, so dots in them are no path segments.
    """
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    bare = F.regexp_replace(base, r"#.*$", "")
    no_query = F.regexp_replace(base, r"[?#].*$", "")
    folder = F.regexp_replace(F.substring(no_query, F.char_length(root) + 1, F.char_length(no_query)), r"[^/]*$", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    path, rest = F.regexp_extract(link, r"(?s)^([^?#]*)", 1), F.regexp_extract(link, r"(?s)^[^?#]*(.*)$", 1)
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, _without_dots(path, squeeze=False), rest))
        .when(link == "", base)
        .when(link.startswith("#"), F.concat(bare, link))
        .when(link.startswith("?"), F.concat(no_query, link))
        .otherwise(F.concat(root, _without_dots(F.concat(folder, path), squeeze=True), rest))
    )


def first_links(html: Column, base: Column, n: int = 3) -> Column:
    """First ``n`` report links of a page, absolute."""
    return F.transform(F.slice(pdf_links(html), 1, n), lambda t: F.when(t.startswith("http"), t).otherwise(absolute(t, base)))
