"""Line dedup by site-relative frequency.

For each host, a line's frequency is the number of its pages that contain the line over the number of its pages.
Lines beyond a ratio are boilerplate of that host and are dropped from its pages.

The lines of a page are counted once each, by a 64-bit hash, with a partial aggregate before the shuffle, so a host
with a third of all pages is spread by its lines. The boilerplate of one host fits a row: shares of lines add up to
the average number of different lines on a page, so at most that number over the ratio can exceed the ratio. Pages
meet their host's row by a join on the host (a hot host is split by the skew join), and lines are filtered in place.

Defined cases: a null text stays null and has no lines; a null host is a host of its own; repeated rows are pages of
their own; lines without a word are never dropped; a text all of whose lines go becomes empty; hosts with fewer than
``least_pages`` pages, and lines on fewer, lose nothing. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swapbook.llm.text import SPACES, without

RATIO = 0.1
LEAST_PAGES = 5

#: Elements of a page that are not text, elements that end a line, any other tag.
UNSEEN = "(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->"
BREAKS = "</?(?:p|div|li|ul|ol|h[1-6]|br|nav|article|section|header|footer|table|tr|title|head|body|html)(?:[ /][^<>]*)?>"
TAGS = "<[^<>]*>"


def host(url: Column) -> Column:
    """Lower-cased host of a URL without user and port; null if there is none."""
    found = F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(found != "", F.lower(found))


def page_text(html: Column) -> Column:
    """The text of a page, one line per block."""
    seen = F.regexp_replace(html, UNSEEN, "\n")
    return F.regexp_replace(F.regexp_replace(seen, BREAKS, "\n"), TAGS, "")


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _with_word(line: Column) -> Column:
    return without(line, SPACES) != ""


def boilerplate(pages: DataFrame, host_col: str, text: str, ratio: float, least_pages: int) -> DataFrame:
    """(_host, _lines): hashes of the lines each host repeats on too many of its pages."""
    named = pages.select(F.coalesce(F.concat(F.lit("="), F.col(host_col)), F.lit("")).alias("_host"), F.col(text).alias("_t"))
    hashes = F.array_distinct(F.transform(F.filter(_lines(F.col("_t")), _with_word), lambda x: F.xxhash64(x)))
    counted = named.select("_host", F.explode(hashes).alias("_line")).groupBy("_host", "_line").agg(F.count(F.lit(1)).alias("_n"))
    # pages are counted without a look at their texts
    totals = named.groupBy("_host").agg(F.count(F.lit(1)).alias("_pages")).filter(F.col("_pages") >= least_pages)
    often = counted.filter(F.col("_n") >= least_pages)
    over = often.join(totals, "_host").filter(F.col("_n") > F.col("_pages") * F.lit(ratio))
    return over.groupBy("_host").agg(F.sort_array(F.collect_list("_line")).alias("_over"))


def drop_boilerplate(pages: DataFrame, host_col: str = "host", text: str = "text", ratio: float = RATIO,
                     least_pages: int = LEAST_PAGES, counts: bool = False) -> DataFrame:
    """``pages`` with its text cleaned; with ``counts`` also ``n_lines`` and ``n_dropped``."""
    over = boilerplate(pages, host_col, text, ratio, least_pages)
    own = pages.select(F.struct(*pages.columns).alias("_page"))
    named = own.withColumn("_host", F.coalesce(F.concat(F.lit("="), F.col(f"_page.{host_col}")), F.lit("")))
    met = named.join(over, "_host", "left").withColumn("_all", _lines(F.col(f"_page.{text}")))
    left = F.filter("_all", lambda x: ~_with_word(x) | ~F.array_contains("_over", F.xxhash64(x)))
    met = met.withColumn("_left", F.when(F.col("_over").isNull(), F.col("_all")).otherwise(left))
    columns = [F.col(f"_page.{c}") if c != text else F.array_join("_left", "\n").alias(text) for c in pages.columns]
    if counts:
        size = F.coalesce(F.size("_all"), F.lit(0)).cast("long")
        columns += [
            F.when(F.col("_all").isNull(), F.lit(0)).otherwise(size).cast("long").alias("n_lines"),
            F.when(F.col("_all").isNull(), F.lit(0)).otherwise(F.size("_all") - F.size("_left")).cast("long").alias("n_dropped"),
        ]
    return met.select(*columns)
