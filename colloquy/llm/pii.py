"""Format-preserving pseudonyms for personal data and secrets, with DataFrame functions only.

One regular expression finds candidates; each is validated (Luhn, modulo 97, calendar, octets, issued areas) and, if
valid, permuted by a keyed Feistel network within its format: digits stay digits, letters stay letters of their case,
check digits are computed anew, dates stay dates, addresses stay addresses. The permutation depends on key, kind and
value only, so equal values stay linked across documents and different ones stay different.

| kind | validated by | what is permuted |
|-|-|-|
| email | form | name, and domain but its last label |
| phone | form with country code (+ or 00), or national: area in brackets, 3-3-4, or a trunk 0 and 9 to 12 digits in groups | digits after the country code or trunk 0, alike however they are grouped |
| card | 13 to 19 digits, plain or grouped, Luhn | all digits but the last, which is the new check digit |
| ip | four octets up to 255 | the 32 bits |
| ssn | areas, groups and serials that can be issued | the number among all such numbers |
| iban | modulo 97 | account part; new check digits |
| date | calendar, 1800 to 2199, year first or last, days and months of one or two digits | the day among those 146,097; among those above 12 where the day is written before the month with / or - |
| secret | a key word (quoted or not), = or :, and 16 characters or more, dots within | characters within hexadecimal digits or their classes |

Candidates that fail validation are left as they are, and so are plain runs of digits that could be a national number
without any sign of it. Dates whose day or month lacks its zero get a date without such zeros, that of the same date
written with them. A walk along the permutation that has met no date of its form after 64 steps (once in 10**20) leaves
the date as it is. Defined results: null text stays null with nothing found; empty text stays empty; equal rows get
equal texts; columns of any names stay as they are; an empty table gives an empty one. Loops in patterns are bounded or
possessive and long texts are worked on as arrays, so that no text overflows a stack. Texts are worked on alone: no
shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.shared import unused

#: The key of the registered query and of tests; it is public, so data that matter need one of their own.
PUBLIC_KEY = "pseudonyms"
ROUNDS, MOST_STEPS = 8, 64

# Forms of the kinds.
_SECRET = r"(?i:(?<![a-z0-9])(?:token|secret(?:[_-]?key)?|password|passwd|api[_-]?key|access[_-]?key|private[_-]?key)\\?[\"']?[ ]{0,3}[=:][ ]{0,3}\\?[\"']?)(?=[A-Za-z0-9_+/.-]{15,}?[A-Za-z0-9_+/-])[A-Za-z0-9_+/-]++(?:\.++[A-Za-z0-9_+/-]++)*+"
_EMAIL = r"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@(?:[A-Za-z0-9-]{1,63}+\.){1,127}[A-Za-z]{2,63}+"
_PHONE = r"(?:\+[0-9]{1,3}[ .-]?|(?<![0-9A-Za-z])(?<![0-9][.,/+-])00[1-9][0-9]{0,2}[ .-])(?=(?:[ .()-]{0,3}[0-9]){5})(?:\(0\)[ .-]?)?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])"
_DATE = r"(?<![0-9./-])(?:(?:18|19|20|21)[0-9]{2}(?:-[01]?[0-9]-|/[01]?[0-9]/|\.[01]?[0-9]\.)[0-3]?[0-9]|[0-3]?[0-9](?:\.[01]?[0-9]\.|/[0-3]?[0-9]/|-[0-3]?[0-9]-)(?:18|19|20|21)[0-9]{2})(?![0-9])"
_IP = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])"
_SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?!-?[0-9])"
_CARD = r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?![0-9A-Za-z])"
_IBAN = r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![0-9A-Za-z])"
_AREA = r"(?:1[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}|(?:1[ .-])?(?:[0-9]{3}-[0-9]{3}-[0-9]{4}|[0-9]{3}\.[0-9]{3}\.[0-9]{4}|[2-9][0-9]{2} [2-9][0-9]{2}[ -][0-9]{4})"
_TRUNK = r"0[1-9](?:[ .-][0-9]{2}){4}|(?=(?:[0-9(][ ()/-]{0,2}){9,13}(?![0-9]))(?:\(0[1-9][0-9]{0,3}\)[ ]?|0[1-9][0-9]{0,3}[ /-])[0-9]{3,8}(?:[ -][0-9]{3,4}){0,2}"
_NATIONAL = rf"(?<![0-9A-Za-z])(?<![0-9][.,/+-])(?:{_AREA}|{_TRUNK})(?![0-9A-Za-z]|[.,-][0-9])"
CANDIDATE = "|".join([_SECRET, _EMAIL, _PHONE, _DATE, _IP, _SSN, _CARD, _IBAN, _NATIONAL])
# Country calling codes of one and two digits; all others have three.
_COUNTRY = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}"
KINDS = ("email", "phone", "card", "ip", "ssn", "iban", "date", "secret")
_LOWER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
_ALPHANUMERIC = (_DIGITS, _LOWER, _LOWER.upper())
_HEX = ("0123456789abcdef",)


def let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def digest(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts]), 512)


def place(alphabet: str, c: Column) -> Column:
    """1, 2, ... by the character's place in the alphabet; 0 if it isn't there."""
    return F.call_function("instr", F.lit(alphabet), c)


def number(hexes: Column) -> Column:
    return F.conv(hexes, 16, 10).cast("long")


def shifted(text: Column, stream: Column, alphabets) -> Column:
    """Each character moved within its alphabet by its byte of the digest; others stay."""

    def one(c: Column, i: Column) -> Column:
        by = number(F.substring(stream, (i % 64) * 2 + 1, F.lit(2))) + F.floor(i / 64) * 7
        out = c
        for a in alphabets:
            at = place(a, c)
            out = F.when(at > 0, F.substring(F.lit(a), ((at - 1 + by) % len(a) + 1).cast("int"), F.lit(1))).otherwise(out)
        return out

    # an array of characters, so that long texts cost no more a character than short ones
    return F.when(F.length(text) == 0, F.lit("")).otherwise(F.array_join(F.transform(F.split(text, ""), one), ""))


def permuted(text: Column, key: str, alphabets=_ALPHANUMERIC) -> Column:
    """A keyed permutation of all texts of one length and pattern: a Feistel network over the two halves."""
    half = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(F.substring(text, F.lit(1), half).alias("a"), F.substring(text, half + 1, F.length(text)).alias("b"))

    def turn(x: Column, r: Column) -> Column:
        moved = let(digest(key, r, x["b"]), lambda s: shifted(x["a"], s, alphabets))
        return F.struct(x["b"].alias("a"), moved.alias("b"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda x: F.concat(x["a"], x["b"]))


def permuted_number(value: Column, m: int, n: int, key: str) -> Column:
    """A keyed permutation of 0 .. m * n - 1: an unbalanced Feistel network over residues modulo m and n."""
    start = F.struct(F.floor(value / n).cast("long").alias("a"), (value % n).cast("long").alias("b"))

    def turn(x: Column, r: Column) -> Column:
        a = (x["a"] + number(F.substring(digest(key, r, F.lit("a"), x["b"]), 1, 14))) % m
        b = lambda a: (x["b"] + number(F.substring(digest(key, r, F.lit("b"), a), 1, 14))) % n
        return let(a, lambda a: F.struct(a.alias("a"), b(a).alias("b")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS // 2)), start, turn, lambda x: x["a"] * n + x["b"])


def refilled(form: Column, chars: Column, pattern: str) -> Column:
    """`form` with its characters of a class replaced, one after another, by those of `chars`."""
    count = lambda i: F.length(F.regexp_replace(F.substring(form, F.lit(1), i), f"[^{pattern}]", ""))
    one = lambda i: let(F.substring(form, i, F.lit(1)), lambda c: F.when(c.rlike(f"[{pattern}]"), F.substring(chars, count(i), F.lit(1))).otherwise(c))
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(form)), one), "")


def luhn_sum(digits: Column, double_last: int) -> Column:
    """The Luhn sum; double_last is 1 if the last digit is doubled."""
    n = F.length(digits)

    def add(s: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        return s + F.when((n - i + double_last) % 2 == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    # the digit at distance 0 from the right is doubled only if double_last
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def luhn_valid(digits: Column) -> Column:
    return luhn_sum(digits, 0) % 10 == 0


def iban_rest(moved: Column) -> Column:
    """A text of digits and capital letters as a number modulo 97."""

    def add(s: Column, i: Column) -> Column:
        at = place(_DIGITS + _LOWER.upper(), F.substring(moved, i, F.lit(1))) - 1
        return (s * F.when(at > 9, 100).otherwise(10) + at) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add)


def pseudonym(m: Column, key: str) -> Column:
    """struct(kind, what stands for m); kind is null if m isn't valid."""

    def as_is(kind: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), value.alias("value"))

    digits = F.regexp_replace(m, "[^0-9]", "")
    none = F.struct(F.lit(None).cast("string").alias("kind"), m.alias("value"))

    before = F.regexp_extract(m, r"^[^=:]*[=:][ ]{0,3}\\?[\"']?", 0)
    secret = F.substring(m, F.length(before) + 1, F.length(m))
    hidden = F.when(secret.rlike("^[0-9a-f]+$"), permuted(secret, key + ":hex", _HEX)).when(secret.rlike("^[0-9A-F]+$"), permuted(secret, key + ":HEX", (_HEX[0].upper(),))).otherwise(permuted(secret, key + ":secret"))

    host = F.regexp_extract(m, r"@(.*)\.[A-Za-z]+$", 1)
    email = F.concat(permuted(F.substring_index(m, "@", 1), key + ":name"), F.lit("@"), permuted(host, key + ":host"), F.lit("."), F.substring_index(m, ".", -1))

    # the same number has the same digits behind its country code or trunk 0, however it is written
    country = F.regexp_extract(m, rf"^(?:(?:\+|00)(?:{_COUNTRY})(?:[ .-]?\(0\))?|1(?=[ .(-])[ .-]?|\(?0)", 0)
    rest = F.substring(m, F.length(country) + 1, F.length(m))
    phone = F.concat(country, refilled(rest, permuted(F.regexp_replace(rest, "[^0-9]", ""), key + ":phone", (_DIGITS,)), "0-9"))

    payload = permuted(F.substring(digits, F.lit(1), F.length(digits) - 1), key + ":card", (_DIGITS,))
    card = let(payload, lambda p: F.concat(p, ((10 - luhn_sum(p, 1) % 10) % 10).cast("string")))

    octets = F.transform(F.split(m, r"\."), lambda x: x.try_cast("int"))
    good_ip = F.forall(octets, lambda x: x <= 255) & ~m.rlike(r"(^|\.)0[0-9]")
    as_long = F.aggregate(octets, F.lit(0).cast("long"), lambda s, x: s * 256 + x)
    ip = let(permuted_number(as_long, 65536, 65536, key + ":ip"), lambda n: F.concat_ws(".", *[(F.shiftright(n, s) % 256).cast("string") for s in (24, 16, 8, 0)]))

    area, group, serial = (F.substring(digits, a, n).try_cast("int") for a, n in ((1, 3), (4, 2), (6, 4)))
    good_ssn = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    index = (area - 1 - F.when(area > 666, 1).otherwise(0)) * 989901 + (group - 1) * 9999 + serial - 1
    new_area = lambda n: F.floor(n / 989901) + 1 + F.when(n >= 989901 * 665, 1).otherwise(0)
    ssn = let(permuted_number(index.cast("long"), 898, 989901, key + ":ssn"), lambda n: F.concat_ws("-", F.lpad(new_area(n).cast("string"), 3, "0"), F.lpad((F.floor(n % 989901 / 9999) + 1).cast("string"), 2, "0"), F.lpad((n % 989901 % 9999 + 1).cast("string"), 4, "0")))

    flat = F.regexp_replace(m, " ", "")
    account, land = F.substring(flat, F.lit(5), F.length(flat)), F.substring(flat, 1, 2)
    good_iban = iban_rest(F.concat(account, F.substring(flat, 1, 4))) == 1
    new_iban = let(permuted(account, key + ":iban"), lambda a: F.concat(land, F.lpad((98 - iban_rest(F.concat(a, land, F.lit("00")))).cast("string"), 2, "0"), a))
    iban = let(new_iban, lambda x: refilled(m, x, "0-9A-Z"))

    sep, dashed = F.regexp_extract(m, "[./-]", 0), F.translate(m, "./", "--")
    short = dashed.rlike("(^|-)[0-9](-|$)")
    of = lambda form: F.to_date(F.try_to_timestamp(dashed, F.lit(form)))
    year_first = m.rlike("^[0-9]{4}")
    american = F.when(~year_first & (sep != "."), of("M-d-yyyy"))
    day = F.when(year_first, of("yyyy-M-d")).otherwise(F.coalesce(american, of("d-M-yyyy")))
    # what is written with a day above 12 first goes to such dates only, or two dates could be written alike
    late = ~year_first & american.isNull() & (sep != ".")
    since = F.lit("1800-01-01").cast("date")
    start = F.struct(F.datediff(day, since).cast("long").alias("n"), F.lit(False).alias("done"))

    def walk(s: Column, _: Column) -> Column:
        ends = lambda n: ~late | (F.dayofmonth(F.date_add(since, n.cast("int"))) > 12)
        return F.when(s["done"], s).otherwise(let(permuted_number(s["n"], 189, 773, key + ":date"), lambda n: F.struct(n.alias("n"), ends(n).alias("done"))))

    new_day = F.date_add(since, F.aggregate(F.sequence(F.lit(1), F.lit(MOST_STEPS)), start, walk, lambda s: F.when(s["done"], s["n"]).otherwise(F.datediff(day, since))).cast("int"))

    def dated(d: Column) -> Column:
        two = lambda x: F.when(short, x.cast("string")).otherwise(F.lpad(x.cast("string"), 2, "0"))
        y, mo, da = F.year(d).cast("string"), two(F.month(d)), two(F.dayofmonth(d))
        return F.when(year_first, F.concat_ws("-", y, mo, da)).when(american.isNotNull(), F.concat_ws("-", mo, da, y)).otherwise(F.concat_ws("-", da, mo, y))

    date = F.replace(let(new_day, dated), F.lit("-"), sep)

    return (
        F.when(m.rlike(r"^[A-Za-z _\\\"'-]+[=:]"), as_is("secret", F.concat(before, hidden)))
        .when(m.contains("@"), as_is("email", email))
        .when(m.rlike(r"^\+|^00[1-9][0-9]{0,2}[ .-]"), as_is("phone", phone))
        .when(m.rlike(r"^[0-9]{4}([./-])[0-9]{1,2}\1[0-9]{1,2}$|^[0-9]{1,2}([./-])[0-9]{1,2}\2[0-9]{4}$"), F.when(day.isNotNull(), as_is("date", date)).otherwise(none))
        .when(m.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), F.when(good_ip, as_is("ip", ip)).otherwise(none))
        .when(m.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), F.when(good_ssn, as_is("ssn", ssn)).otherwise(none))
        .when(m.rlike(f"^(?:{_AREA})$|^(?:{_TRUNK})$"), as_is("phone", phone))
        .when(m.rlike("^[0-9]"), F.when(luhn_valid(digits), as_is("card", let(card, lambda c: refilled(m, c, "0-9")))).otherwise(none))
        .otherwise(F.when(good_iban, as_is("iban", iban)).otherwise(none))
    )


def number_of(found: str, kind: str) -> Column:
    return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long")


def pseudonymised(docs: DataFrame, key: str, text: str = "text", counts: bool = False) -> DataFrame:
    """Replace `text`; on request add n_<kind> for each kind, in place of columns of that name."""
    t, at = F.col(text), unused(docs, "found")
    empty = "array<struct<kind:string,value:string>>"
    found = F.when(t.rlike(CANDIDATE), F.transform(F.regexp_extract_all(t, F.lit(CANDIDATE), F.lit(0)), lambda m: pseudonym(m, key))).otherwise(F.array().cast(empty))
    docs = docs.withColumn(at, found)
    gaps = F.split(t, CANDIDATE)
    woven = F.array_join(F.zip_with(gaps, F.transform(F.col(at), lambda x: x["value"]), lambda g, v: F.concat(g, F.coalesce(v, F.lit("")))), "")
    docs = docs.withColumn(text, F.when(F.size(at) > 0, woven).otherwise(t))
    if counts:
        docs = docs.withColumns({f"n_{k}": number_of(at, k) for k in KINDS})
    return docs.drop(at)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pseudonymised(docs, PUBLIC_KEY, counts=True)
