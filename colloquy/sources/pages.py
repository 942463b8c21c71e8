"""Text of published pages."""

from __future__ import annotations

import html
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements that are passed over, and those that start or end a line.
SKIPPED = ("script", "style", "nav", "header", "footer")
LINE_BEFORE, LINE_AFTER = ("p", "br", "div", "h1", "h2", "h3", "h4", "li"), ("p", "div")
# Elements without an end.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")


class _Page(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.skip = [], False

    def handle_starttag(self, tag, attrs):
        if tag in SKIPPED:
            self.skip = True
        elif tag in LINE_BEFORE:
            self.parts.append("\n")

    def handle_endtag(self, tag):
        if tag in SKIPPED:
            self.skip = False
        elif tag in LINE_AFTER:
            self.parts.append("\n")

    def handle_data(self, data):
        if not self.skip:
            self.parts.append(data)


def page_text(raw: str | None) -> str:
    """Plain text of a page: one line a block, at most one blank line between."""
    page = _Page()
    page.feed(raw or "")
    page.close()
    return re.sub(r"\n{3,}", "\n\n", html.unescape("".join(page.parts))).strip()


class _Interview(HTMLParser):
    """Paragraphs of an article body with the share of their text that is bold."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.bold, self.inside, self.out, self.text, self.heavy = 0, 0, False, [], "", 0

    def handle_starttag(self, tag, attrs):
        if tag == "section" and (self.depth or ("name", "articleBody") in attrs):
            self.depth += 1
        if self.depth and tag == "p":
            self.end()
            self.inside = True
        if tag in ("b", "strong"):
            self.bold += 1

    def handle_endtag(self, tag):
        if tag == "section" and self.depth:
            self.end()
            self.depth -= 1
        elif tag == "p":
            self.end()
        elif tag in ("b", "strong"):
            self.bold = max(0, self.bold - 1)

    def handle_data(self, data):
        if self.inside:
            self.text += data
            self.heavy += len(data) if self.bold else 0

    def end(self):
        if self.inside and (t := self.text.strip()):
            self.out.append({"text": t, "bold": self.heavy > 0.8 * len(self.text)})
        self.inside, self.text, self.heavy = False, "", 0


def interview(raw: str | None) -> list[dict]:
    page = _Interview()
    page.feed(raw or "")
    page.close()
    page.end()
    return page.out


def with_text(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """Add each page's plain text."""

    def work(batches):
        for b in batches:
            yield b.append_column(out, pa.array([page_text(x) for x in b.column(html_col).to_pylist()], pa.string()))

    return pages.mapInArrow(work, T.StructType([*pages.schema.fields, T.StructField(out, T.StringType())]))


def with_paragraphs(pages: DataFrame, html_col: str = "html", out: str = "paragraphs") -> DataFrame:
    """Add an interview's paragraphs, each with whether over 80 % of it is bold."""
    kind = pa.list_(pa.struct([("text", pa.string()), ("bold", pa.bool_())]))

    def work(batches):
        for b in batches:
            yield b.append_column(out, pa.array([interview(x) for x in b.column(html_col).to_pylist()], kind))

    return pages.mapInArrow(work, T.StructType([*pages.schema.fields, T.StructField(out, T._parse_datatype_string("array<struct<text string, bold boolean>>"))]))


def untagged(x: Column) -> Column:
    """Without tags, the common character references decoded, trimmed."""
    t = F.regexp_replace(x, "<[^>]+>", "")
    for ref, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        t = F.replace(t, F.lit(ref), F.lit(char))
    return F.trim(t)


def segment_text(raw: Column) -> Column:
    """`Name (time)` and text of each marked segment; empty if there are none."""
    all_of = lambda c: F.regexp_extract_all(raw, F.lit(rf'(?s)<(?:span|div)[^>]*class="{c}"[^>]*>(.*?)</(?:span|div)>'), F.lit(1))
    rows = F.arrays_zip(all_of("ts-name").alias("n"), all_of("ts-timestamp").alias("t"), all_of("ts-text").alias("x"))
    return F.array_join(F.transform(rows, lambda r: F.concat(untagged(r["n"]), F.lit(" ("), F.regexp_replace(untagged(r["t"]), r"[()]", ""), F.lit(")\n"), untagged(r["x"]), F.lit("\n"))), "\n")


def assigned(rows: DataFrame, key: str, host: str, guest: str) -> DataFrame:
    """Add `speaker` to paragraphs (key, ord, text, bold): the host until a name starts a paragraph, then by name, bold text the host's and the rest the guest's."""
    from pyspark.sql import Window

    w = Window.partitionBy(key).orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    by_host, by_guest = F.col("text").startswith(host + ":"), F.col("text").startswith(guest + ":")
    started = F.max(by_host | by_guest).over(w)
    return rows.withColumn("speaker", F.when(by_host, host).when(by_guest, guest).when(~started | F.col("bold"), host).otherwise(guest))


def without_end(rows: DataFrame, key: str, starts: list[str]) -> DataFrame:
    """Paragraphs before the first that starts with one of the phrases."""
    from functools import reduce

    from pyspark.sql import Window

    flag = reduce(lambda a, b: a | b, [F.col("text").startswith(s) for s in starts])
    w = Window.partitionBy(key).orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("_end", F.max(flag).over(w)).where("not _end").drop("_end")


def labelled(rows: DataFrame, key: str) -> DataFrame:
    """(key, text): paragraphs with the speaker's name where the speaker changes, unless it is there."""
    from pyspark.sql import Window

    new = ~F.lag("speaker").over(Window.partitionBy(key).orderBy("ord")).eqNullSafe(F.col("speaker"))
    named = F.when(new & ~F.startswith("text", F.concat("speaker", F.lit(":"))), F.concat("speaker", F.lit(": "), "text")).otherwise(F.col("text"))
    got = rows.select(key, "ord", named.alias("line"))
    return got.groupBy(key).agg(F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "line"))), lambda x: x["line"]), "\n\n"), F.lit("\n")).alias("text"))


# Page furniture of printed interviews, removed in this order. (?m) lines, (?s) across lines.
FURNITURE = [
    r"\f",
    r"[0-9]+/[0-9]+/[0-9]+, [0-9]+:[0-9]+ [AP]M\s+Opinion \|[^\n]+- The New York Times\n",
    r"https://www\.nytimes\.com/[^\s]+\s+[0-9]+/[0-9]+\n",
    r"(?m)^\s*https://www\.nytimes\.com/[^\s]+\s*\n",
    r"https://www\.nytimes\.com/\S+\s*",
    r"More to read for free\.[^\n]*\n",
    r"(?m)^[ ]{20,}[^\n]*$",
    r"(?m)^[^\n]*[0-9]+ MIN READ[^\n]*$",
    r"(?m)^\s*OPINION\s*$",
]
# The first and the last line of an offer, with what lies between.
LETTER, LETTER_END = r"\s*Sign up for the [^\n]+ newsletter[^\n]*\n", r"[^\n]*Get it sent to your inbox\.\n"
TAILS = [
    r"(?m)^\s*(?:THE EZRA KLEIN SHOW|By Ezra Klein|Produced by [\p{L}\p{N}_]+ [\p{L}\p{N}_]+)\s*\n",
    r"(?m)^\s*[A-Z][a-z]+\.?\s+[0-9]{1,2},\s+[0-9]{4}\s*\n",
    r"(?m)^\s*How Fast Will A\.I\. Agents Rip Through the Economy\?\s*\n",
    r"(?s)This episode of .The Ezra Klein Show. was produced by.*",
    r"(?s)You can listen to this conversation by following.*?from our guests here\.\s*\n",
    r"(?s)The Times is committed to publishing.*",
    r"(?s)Follow the New York Times Opinion.*",
    r"(?s)Ezra Klein joined Opinion in 2021.*",
]


def without_offers(t: Column) -> Column:
    """From each first line of an offer to the next last line, a line feed. By cutting at both, as a pattern that runs over
    any number of lines would need a stack as deep."""
    parts = F.split(t, rf"(?<!\s)(?={LETTER})")  # each but the first starts with the white space before a first line
    starts = lambda x: F.regexp_like(x, F.lit(rf"^{LETTER}"))
    start = F.struct(F.lit("").alias("out"), F.lit("").alias("open"))

    def add(s: Column, x: Column) -> Column:
        inside = s["open"] != ""
        held = F.when(inside, F.concat(s["open"], x)).when(starts(x), x)
        rest = F.regexp_replace(held, rf"^{LETTER}", "")
        ends = F.regexp_instr(rest, F.lit(LETTER_END))
        after = F.regexp_replace(F.substring(rest, ends, F.length(rest)), rf"^{LETTER_END}", "")
        closed = F.struct(F.concat(s["out"], F.lit("\n"), after).alias("out"), F.lit("").alias("open"))
        return F.when(held.isNull(), F.struct(F.concat(s["out"], x).alias("out"), F.lit("").alias("open"))).when(ends > 0, closed).otherwise(F.struct(s["out"].alias("out"), held.alias("open")))

    return F.aggregate(parts, start, add, lambda s: F.concat(s["out"], s["open"]))


def print_text(raw: Column) -> Column:
    """A printed interview as plain paragraphs, without page furniture, with straight quotes."""
    from colloquy.functions.text import plain_quotes
    from colloquy.operators.chunks import unwrapped

    t = raw
    for p in FURNITURE:
        t = F.regexp_replace(t, p, "")
    t = without_offers(t)
    for p in TAILS:
        t = F.regexp_replace(t, p, "")
    t = F.regexp_replace(plain_quotes(t), r"\n{3,}", "\n\n")
    t = F.regexp_replace(unwrapped(t), r"\n{3,}", "\n\n")
    return F.concat(F.regexp_replace(t, r"^\s+|\s+$", ""), F.lit("\n"))
