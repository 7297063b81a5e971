"""Personal data replaced by pseudonyms of the same format.

Numbers and dates are found by one pattern and checked (card check digit, octets, number
plan, calendar); each valid value is permuted within the values of its format by a keyed
Feistel network, so equal values get equal pseudonyms in all documents, different values
different ones, and the result is valid again. Radices need not be powers of ten: a round adds
a keyed hash of one half to the other modulo its radix. Mail addresses are permuted letter by
letter in the same way, letters staying letters and digits digits; their domain stays.

Everything happens inside the row, in built-in functions: no shuffle, nothing broadcast.
Nulls: a NULL text stays NULL. Empty texts and tables, repeated rows and other columns pass
unchanged; where the input has a ``pii_counts`` of its own, the counts are called ``pii_counts_``.
Long texts are gone through once, in time that grows with their length. Of overlapping values
the one that begins first counts, of two at one place the first in the order of ``ANY``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brimline.llm.common import bind, fresh

ROUNDS = 8
KINDS = ("email", "ip", "card", "phone", "ssn", "date")

# Runs of single characters only, each tried from its first one: linear, and without recursion,
# whatever the text. A local part has 64 characters at most.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-][A-Za-z0-9.-]*\.[A-Za-z]{2,}"
IP = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)"
CARD = r"(?<![\d])\d(?:[ -]?\d){12,18}(?!\d)"
PHONE = r"\+1[ -]?\(?\d{3}\)?[ -]?\d{3}[ -]?\d{4}(?!\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d]|-\d)"
DATE = r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{2}[./]\d{2}[./]\d{4})(?![\d]|[./-]\d)"
ANY = "|".join((EMAIL, PHONE, SSN, DATE, IP, CARD))

#: Dates from 1800 to 2199: one whole cycle of the calendar, 146,097 = 189 x 773 days.
FIRST_DAY, DAYS_LEFT, DAYS_RIGHT = "1800-01-01", 189, 773


def number(digits: Column) -> Column:
    return digits.cast("long")


def keyed(key: str, name: str, round_: Column, value: Column) -> Column:
    """A hash of the key and a value, as a number of 60 bits."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(name), round_.cast("string"), value.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, a: Column | int, b: Column | int, key: str, name: str) -> Column:
    """``left`` in [0, a) and ``right`` in [0, b) permuted: a struct ``l, r``."""
    a, b = (F.lit(x).cast("long") if isinstance(x, int) else x for x in (a, b))

    def step(s: Column, k: Column) -> Column:
        odd = k % 2 == 1
        return F.struct(
            F.when(odd, F.pmod(s["l"] + F.pmod(keyed(key, name, k, s["r"]), a), a)).otherwise(s["l"]).alias("l"),
            F.when(odd, s["r"]).otherwise(F.pmod(s["r"] + F.pmod(keyed(key, name, k, s["l"]), b), b)).alias("r"),
        )

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def digits_of(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def padded(c: Column, n: Column | int) -> Column:
    """A number with leading zeros; ``n`` may differ by row."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.concat(F.repeat(F.lit("0"), n - F.length(c.cast("string"))), c.cast("string"))


def poured(digits: Column, form: Column) -> Column:
    """New digits in place of the old ones; all other characters stay."""
    return bind(
        F.split(form, ""),
        lambda cs: F.array_join(
            F.transform(
                cs,
                lambda c, i: F.when(
                    c.rlike(r"^\d$"),
                    F.substring(digits, F.size(F.filter(F.slice(cs, F.lit(1), i + 1), lambda x: x.rlike(r"^\d$"))), F.lit(1)),
                ).otherwise(c),
            ),
            "",
        ),
    )


def luhn_sum(digits: Column, doubled_from_end: int) -> Column:
    """Sum of the digits, every second one doubled, from the last (1) or the one before (0)."""
    return F.aggregate(
        F.transform(
            F.split(F.reverse(digits), ""),
            lambda c, i: bind(
                c.cast("int") * F.when(i % 2 == 1 - doubled_from_end, F.lit(2)).otherwise(F.lit(1)),
                lambda v: F.when(v > 9, v - 9).otherwise(v),
            ),
        ),
        F.lit(0), lambda a, x: a + x,
    )


def card_in(hit: Column) -> Column:
    """Where a valid card stands in a run of digits: start and length of the longest part that
    begins and ends at a separator and has 13 to 19 digits with a valid check digit."""
    valid = lambda x: bind(digits_of(x), lambda d: F.length(d).between(13, 19) & (luhn_sum(d, 0) % 10 == 0))
    at = lambda i: F.substring(hit, i, F.lit(1)).rlike(r"\d")
    places = F.sequence(F.lit(1), F.length(hit))
    starts = F.filter(places, lambda i: at(i) & ((i == 1) | ~at(i - 1)))
    ends = F.filter(places, lambda i: at(i) & ((i == F.length(hit)) | ~at(i + 1)))
    # the longest first, of equal ones the leftmost
    parts = F.flatten(F.transform(starts, lambda a: F.transform(F.filter(ends, lambda b: b >= a + 12), lambda b: F.struct((a - b - 1).alias("n"), a.alias("a")))))
    some = F.filter(F.array_sort(parts), lambda x: valid(F.substring(hit, x["a"], -x["n"])))
    whole = F.struct((-F.length(hit)).alias("n"), F.lit(1).alias("a"))
    return F.when(valid(hit), whole).otherwise(F.get(some, F.lit(0)))


def card(hit: Column, key: str) -> Column:
    """13 to 19 digits with a valid check digit, alone or with other digits beside them behind a
    separator (an expiry date, a count), which stay; NULL otherwise."""
    return bind(card_in(hit), lambda x: F.concat(
        F.substring(hit, F.lit(1), x["a"] - 1), _whole_card(F.substring(hit, x["a"], -x["n"]), key),
        F.substring(hit, x["a"] - x["n"], F.length(hit)),
    ))


def _whole_card(hit: Column, key: str) -> Column:

    def permuted(d: Column) -> Column:
        half = ((F.length(d) - 1) / 2).cast("int")
        rest = F.length(d) - 1 - half
        power = lambda n: number(F.concat(F.lit("1"), F.repeat(F.lit("0"), n)))
        body = bind(
            feistel(
                number(F.substring(d, F.lit(1), half)), number(F.substring(d, half + 1, rest)),
                power(half), power(rest), key, "card",
            ),
            lambda s: F.concat(padded(s["l"], half), padded(s["r"], rest)),
        )
        with_check = lambda x: F.concat(x, F.pmod(10 - F.pmod(luhn_sum(x, 1), F.lit(10)), F.lit(10)).cast("string"))
        return F.when(luhn_sum(d, 0) % 10 == 0, poured(bind(body, with_check), hit))

    return bind(digits_of(hit), permuted)


def ip(hit: Column, key: str) -> Column:
    def permuted(o: Column) -> Column:
        at = lambda k: F.get(o, F.lit(k))
        new = bind(
            feistel(at(0) * 256 + at(1), at(2) * 256 + at(3), 65536, 65536, key, "ip"),
            lambda s: F.concat_ws(
                ".", (s["l"] / 256).cast("int"), (s["l"] % 256).cast("int"), (s["r"] / 256).cast("int"), (s["r"] % 256).cast("int")
            ),
        )
        return F.when(F.forall(o, lambda x: x < 256), new)

    return bind(F.transform(F.split(hit, r"\."), number), permuted)


def phone(hit: Column, key: str) -> Column:
    """Country code 1 and ten digits; area and exchange each begin with 0 or 1, or with 2 to 9
    as in assigned numbers, before and after."""

    def permuted(d: Column) -> Column:
        part = lambda a, n: number(F.substring(d, a, n))
        area, exchange = part(2, 3), part(5, 1)
        assigned = area >= 200
        open_ = exchange >= 2
        areas, area0 = F.when(assigned, F.lit(800)).otherwise(F.lit(200)), F.when(assigned, F.lit(200)).otherwise(F.lit(0))
        firsts, first0 = F.when(open_, F.lit(8)).otherwise(F.lit(2)), F.when(open_, F.lit(2)).otherwise(F.lit(0))
        new = bind(
            feistel((area - area0) * firsts + exchange - first0, part(6, 6), (areas * firsts).cast("long"), 1_000_000, key, "phone"),
            lambda s: F.concat(
                F.lit("1"), padded((F.floor(s["l"] / firsts) + area0).cast("long"), 3),
                (s["l"] % firsts + first0).cast("string"), padded(s["r"], 6),
            ),
        )
        return poured(new, hit)

    return bind(digits_of(hit), permuted)


def ssn(hit: Column, key: str) -> Column:
    """Area 001 to 899 without 666, group 01 to 99, serial 0001 to 9999."""

    def permuted(d: Column) -> Column:
        part = lambda a, n: number(F.substring(d, a, n))
        area, group, serial = part(1, 3), part(4, 2), part(6, 4)
        left = F.when(area > 666, area - 2).otherwise(area - 1)
        new = bind(
            feistel(left, (group - 1) * 9999 + serial - 1, 898, 99 * 9999, key, "ssn"),
            lambda s: F.concat(
                padded(F.when(s["l"] >= 665, s["l"] + 2).otherwise(s["l"] + 1), 3),
                padded((F.floor(s["r"] / 9999) + 1).cast("long"), 2), padded(s["r"] % 9999 + 1, 4),
            ),
        )
        valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
        return F.when(valid, poured(new, hit))

    return bind(digits_of(hit), permuted)


def date(hit: Column, key: str) -> Column:
    """A calendar day from 1800 to 2199, year first or day first."""
    iso = hit.contains("-")

    def permuted(d: Column) -> Column:
        y = F.when(iso, F.substring(d, 1, 4)).otherwise(F.substring(d, 5, 4))
        m = F.when(iso, F.substring(d, 5, 2)).otherwise(F.substring(d, 3, 2))
        day = F.when(iso, F.substring(d, 7, 2)).otherwise(F.substring(d, 1, 2))
        when = F.try_to_timestamp(F.concat_ws("-", y, m, day), F.lit("yyyy-MM-dd")).cast("date")
        first = F.lit(FIRST_DAY).cast("date")
        size = DAYS_LEFT * DAYS_RIGHT

        def renumbered(n: Column) -> Column:
            new = bind(
                feistel(F.floor(n / DAYS_RIGHT), n % DAYS_RIGHT, DAYS_LEFT, DAYS_RIGHT, key, "date"),
                lambda s: F.date_add(first, (s["l"] * DAYS_RIGHT + s["r"]).cast("int")),
            )
            text = lambda x: F.when(iso, F.date_format(x, "yyyyMMdd")).otherwise(F.date_format(x, "ddMMyyyy"))
            return F.when((n >= 0) & (n < size), poured(bind(new, text), hit))

        return bind(F.datediff(when, first), renumbered)

    return bind(digits_of(hit), permuted)


def _turned(s: Column, digest: Column) -> Column:
    """Each letter or digit moved within its class by a byte of the digest."""

    def one(c: Column, i: Column) -> Column:
        by = F.conv(F.substring(digest, (i % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        in_class = lambda first, n: F.char(F.pmod(F.ascii(c) - first + by, F.lit(n)) + first)
        return (
            F.when(c.rlike("^[a-z]$"), in_class(97, 26)).when(c.rlike("^[A-Z]$"), in_class(65, 26))
            .when(c.rlike("^[0-9]$"), in_class(48, 10)).otherwise(c)
        )

    return F.when(F.length(s) == 0, s).otherwise(F.array_join(F.transform(F.split(s, ""), one), ""))


def email(hit: Column, key: str) -> Column:
    local, domain = F.substring_index(hit, "@", 1), F.substring_index(hit, "@", -1)
    valid = F.substring_index(domain, "..", 1).rlike(r"\.[A-Za-z]{2}")
    half = F.floor(F.length(local) / 2).cast("int")

    def step(s: Column, k: Column) -> Column:
        digest = lambda x: F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), k.cast("string"), x), 256)
        odd = k % 2 == 1
        return F.struct(
            F.when(odd, _turned(s["l"], digest(s["r"]))).otherwise(s["l"]).alias("l"),
            F.when(odd, s["r"]).otherwise(_turned(s["r"], digest(s["l"]))).alias("r"),
        )

    start = F.struct(F.substring(local, F.lit(1), half).alias("l"), F.substring(local, half + 1, F.length(local)).alias("r"))
    new = F.aggregate(F.sequence(F.lit(1), F.lit(4)), start, step)
    return F.when(valid, bind(new, lambda s: F.concat(s["l"], s["r"], F.lit("@"), domain)))


def kind_of(hit: Column) -> Column:
    """The format a match has, by its place in ``KINDS``."""
    whole = lambda p: hit.rlike(f"^(?:{p})$")
    return (
        F.when(hit.contains("@"), 0).when(whole(PHONE), 3).when(whole(SSN), 4).when(whole(DATE), 5)
        .when(whole(IP), 1).otherwise(2)
    )


def pseudonym(hit: Column, kind: Column, key: str) -> Column:
    """NULL where the value is not valid in its format."""
    return (
        F.when(kind == 0, email(hit, key)).when(kind == 1, ip(hit, key)).when(kind == 2, card(hit, key))
        .when(kind == 3, phone(hit, key)).when(kind == 4, ssn(hit, key)).otherwise(date(hit, key))
    )


def replace(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """All columns, ``text`` with pseudonyms, and ``pii_counts``: one number per kind replaced."""
    t = F.col(f"`{text}`")
    hits, new, counted = fresh(docs, "_pii_hits"), fresh(docs, "_pii_new"), fresh(docs, "pii_counts")
    out = docs.withColumn(hits, F.regexp_extract_all(t, F.lit(ANY), F.lit(0)))
    out = out.withColumn(
        new,
        F.transform(
            hits,
            lambda h: bind(
                kind_of(h), lambda k: F.struct(k.alias("kind"), h.alias("old"), pseudonym(h, k, key).alias("new"))
            ),
        ),
    )
    between = F.split(t, ANY, -1)
    joined = bind(
        between,
        lambda parts: F.array_join(
            F.transform(
                parts,
                lambda p, i: F.concat(p, F.coalesce(F.get(new, i)["new"], F.get(new, i)["old"], F.lit(""))),
            ),
            "",
        ),
    )
    counts = F.array(*[
        F.size(F.filter(new, lambda x: (x["kind"] == i) & x["new"].isNotNull())) for i in range(len(KINDS))
    ])
    return (
        out.withColumn(text, F.when(F.size(hits) > 0, joined).otherwise(t))
        .withColumn(counted, F.when(t.isNull(), F.array(*[F.lit(0)] * len(KINDS))).otherwise(counts))
        .drop(hits, new)
    )
