"""Drops lines that too many pages of the same host share.

Site-relative frequency: pages of a host that contain a line, divided by all pages of the
host. Only digests of lines cross the network for counting. The lines of each host that are to
be dropped are few and meet its pages where these are read, if the list of hosts is small
enough to broadcast.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctua.llm.rows import column, new_folder, packed, prepare_workers, unpacked, written

class _Next:
    """Places of marks in a text, asked for from left to right; each stretch is searched once."""

    def __init__(self, text: bytes):
        self.text, self.at = text, {}

    def __call__(self, mark: bytes, start: int) -> int:
        """First place from ``start`` on; -1 if there is none any more."""
        at = self.at.get(mark, 0)
        if mark not in self.at or 0 <= at < start:
            at = self.at[mark] = self.text.find(mark, start)
        return at


def visible_text(html: str) -> str:
    """Text of a page with a line feed wherever a tag stood; blank lines removed.

    Comments, and script and style elements with what they hold, are tags as a whole if they
    end; what begins like a tag and does not end is text. The time is linear in the page.
    """
    raw = html.encode("utf-8", "surrogatepass")
    low, out, at = raw.lower(), [], 0
    following = _Next(low)
    while (begin := raw.find(b"<", at)) >= 0:
        end = -1
        if raw.startswith(b"<!--", begin):
            closing = following(b"-->", begin + 4)
            end = closing + 3 if closing >= 0 else -1
        elif name := next((n for n in (b"<script", b"<style") if low.startswith(n, begin)), None):
            inside = begin + len(name)
            if not (low[inside : inside + 1].isalnum() or low[inside : inside + 1] == b"_"):
                closings = [(i, len(m)) for m in (b"</script>", b"</style>") if (i := following(m, inside)) >= 0]
                end = sum(min(closings, default=(-1, 0)))
        if end < 0:
            end = following(b">", begin + 1) + 1
            if end == 0:
                break  # nothing closes any more
        out.append(raw[at:begin])
        at = end
    lines = b"\n".join([*out, raw[at:]]).split(b"\n")
    if len(lines) > 1:
        inner = [x for line in lines[1:-1] if (x := line.strip(b" \t\r"))]
        lines = [lines[0].rstrip(b" \t\r"), *inner, lines[-1].lstrip(b" \t\r")]
    return b"\n".join(lines).decode("utf-8", "surrogatepass")


def html_lines(html: Column) -> Column:
    """``visible_text`` of a column; null stays null."""
    prepare_workers(SparkSession.getActiveSession())
    return F.pandas_udf(_visible, "string")(html)


def _visible(pages: pd.Series) -> pd.Series:
    return pages.map(visible_text, na_action="ignore")


def drop_site_lines(
    df: DataFrame,
    host: str = "host",
    text: str = "text",
    ratio: float = 0.3,
    least_pages: int = 3,
) -> DataFrame:
    """Rows of ``df`` with ``kept_text``, ``n_lines``, ``n_dropped`` and ``host_pages``.

    A line is dropped from all pages of a host if at least ``least_pages`` of its pages and
    a share of them above ``ratio`` contain it. Lines are compared without blanks
    at their ends; blank lines stay and are not counted. A page counts once however often
    it repeats a line, and every row is a page, repeated rows included.

    Texts of any length are split where they are read; a null text has no lines and stays null; rows with a null host form one site; an empty
    table stays empty. Columns of ``df`` with the new names are replaced.
    """
    site = F.coalesce(column(host), F.lit(""))
    rows = packed(df, site=site, lines=F.split(column(text), "\n"))
    # Written, so that Spark knows the size of each small side: it broadcasts it if it is
    # below the session's threshold, and else can split a host that fills a third of the rows.
    folder = new_folder(df, "line-dedup")
    per_host = rows.groupBy("site").agg(F.count("*").alias("host_pages"))
    per_host = written(per_host, folder, "hosts")
    per_line = (
        rows.select("site", F.explode(F.array_distinct(_digests("lines"))).alias("digest"))
        .filter(F.col("digest").isNotNull())
        .groupBy("site", "digest")
        .agg(F.count("*").alias("pages"))
        .filter(F.col("pages") >= least_pages)
    )
    # Each of these lines fills more than the share ``ratio`` of the pages, so a host has at most
    # (lines per page) / ratio of them: a small array, whatever the size of the host.
    common = (
        per_line.join(per_host, "site")
        .filter(F.col("pages") > ratio * F.col("host_pages"))
        .groupBy("site")
        .agg(F.collect_set("digest").alias("common"))
    )
    sites = written(per_host.join(common, "site", "left"), folder, "sites")
    judged = (
        rows.join(sites, "site", "left")
        .withColumn("common", F.coalesce("common", F.array().cast("array<binary>")))
        .withColumn(
            "kept",
            F.filter("lines", lambda x: ~F.array_contains("common", F.coalesce(_digest(x), F.unhex(F.lit(""))))),
        )
    )
    return unpacked(
        judged.withColumns({
            "kept_text": F.array_join("kept", "\n"),
            "n_lines": _count("lines"),
            "n_dropped": _count("lines") - _count("kept"),
        }),
        "kept_text", "n_lines", "n_dropped", "host_pages",
    )


def _digest(line: Column) -> Column:
    """Null for a blank line."""
    bare = F.btrim(line, F.lit(" \t\r"))
    return F.when(bare != "", F.unhex(F.md5(F.encode(bare, "UTF-8"))))


def _digests(lines: str) -> Column:
    return F.transform(lines, _digest)


def _count(lines: str) -> Column:
    full = F.filter(lines, lambda x: F.btrim(x, F.lit(" \t\r")) != "")
    return F.coalesce(F.size(full), F.lit(0)).cast("long")
