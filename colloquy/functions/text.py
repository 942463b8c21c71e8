"""Text as columns: splitting, normalising, times, casing, cleaning."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from colloquy.functions.fixed import COMMON_WORDS, NOT_WORD, SPACE


def words(text: Column) -> Column:
    """The words of a text; none for empty or null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def normalized(ws: Column) -> Column:
    """Lower case without punctuation; what is left empty becomes _, so that the number of words stays."""
    return F.transform(ws, lambda w: F.coalesce(F.nullif(F.lower(F.regexp_replace(w, NOT_WORD, "")), F.lit("")), F.lit("_")))


class Normalised(dict):
    """`normalized` of single words in Python, by word. Words seen are kept, up to 200,000 at once."""

    def __missing__(self, w: str) -> str:
        if len(self) >= 200_000:
            self.clear()
        kept = w if w.isascii() and w.isalnum() else "".join(c for c in w if c == "_" or unicodedata.category(c)[0] in "LN")
        self[w] = found = kept.lower() or "_"
        return found


def joined(ws: Column, by: str = " ") -> Column:
    return F.array_join(ws, by)


def all_common(ws: Column) -> Column:
    """Whether every word is a common one; true for no words."""
    return F.size(F.array_except(F.transform(ws, F.lower), F.array(*[F.lit(w) for w in COMMON_WORDS]))) == 0


def hms(seconds: Column) -> Column:
    """H:MM:SS of whole seconds."""
    s = F.floor(seconds).cast("long")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    return F.concat(F.floor(s / 3600).cast("string"), F.lit(":"), two(F.floor(s % 3600 / 60).cast("long")), F.lit(":"), two(s % 60))


def seconds_of(stamp: Column) -> Column:
    """Seconds of H:MM:SS or M:SS; null if it is neither."""
    p = F.transform(F.split(stamp, ":"), lambda x: x.try_cast("double"))
    return F.when(F.size(p) == 3, p[0] * 3600 + p[1] * 60 + p[2]).when(F.size(p) == 2, p[0] * 60 + p[1])


def cased(token: Column, case: Column) -> Column:
    """UC: first letter up, the rest kept; LC: all lower; CA: all upper; otherwise as it is."""
    first = F.concat(F.upper(F.substring(token, 1, 1)), F.substring(token, F.lit(2), F.length(token)))
    return F.when(case == "UC", first).when(case == "LC", F.lower(token)).when(case == "CA", F.upper(token)).otherwise(token)


def speaker_id(name: Column) -> Column:
    return F.regexp_replace(name, "[^a-zA-Z0-9_]", "_")


def slug(title: Column) -> Column:
    """Word characters, spaces and hyphens only; 50 at most; hyphens for white space; lower case."""
    plain = F.regexp_replace(title, r"[^\p{L}\p{N}_\s-]", "")
    return F.lower(F.regexp_replace(F.trim(F.substring(plain, 1, 50)), r"\s+", "-"))


def plain_quotes(text: Column) -> Column:
    """Straight quotes for curly ones."""
    return F.translate(text, "‘’“”", "''\"\"")


def clean_choice(text: Column) -> Column:
    """A chosen reading without what a model wrote around it."""
    t = F.regexp_replace(text, r"(?i)\s*\|\s*Model\s+[A-Z]\s*:.*$", "")
    t = F.regexp_replace(t, r"(?i)^Model\s+[A-Z]\s*:\s*", "")
    t = F.trim(F.regexp_replace(t, r"(?i)^(?:Current|Alternative adds|Alternative|Decision|Choice|Reading)\s*:\s*", ""))
    quoted = (F.length(t) >= 2) & t.startswith('"') & t.endswith('"')
    return F.trim(F.when(quoted, F.substring(t, F.lit(2), F.length(t) - 2)).otherwise(t))


def clean_answer(text: Column) -> Column:
    """Lines of a model's answer without rules and headings."""
    kept = F.filter(F.split(text, "\n"), lambda x: ~F.trim(x).rlike(r"^(?:-{3,}|\*{3,}|={3,})$|^#{1,6}\s"))
    return F.trim(F.array_join(kept, "\n"))


def without_headers(text: Column) -> Column:
    """Text without lines `**Name** (H:MM:SS)`."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: ~F.trim(x).rlike(r"^\*\*[^*]+\*\*(?:\s*\([0-9:]+\))?$")), "\n")


def is_url(x: Column) -> Column:
    return x.startswith("http://") | x.startswith("https://")


def is_html(raw: Column) -> Column:
    """<html in the first 500 characters or <body in the first 1,000."""
    return F.lower(F.substring(raw, 1, 500)).contains("<html") | F.lower(F.substring(raw, 1, 1000)).contains("<body")


def shown_reading(text: Column) -> Column:
    return F.when(text != "", F.concat(F.lit('"'), text, F.lit('"'))).otherwise(F.lit("(omit)"))
