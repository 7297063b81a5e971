import datetime
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from brimline.llm import pseudonyms as ps
from tests.llm.conftest import PRIVATE

KEY = "k"


def keyed(name, k, value):
    return int(hashlib.sha256(f"{KEY}|{name}|{k}|{value}".encode()).hexdigest()[:15], 16)


def feistel(left, right, a, b, name):
    for k in range(1, ps.ROUNDS + 1):
        if k % 2:
            left = (left + keyed(name, k, right)) % a
        else:
            right = (right + keyed(name, k, left)) % b
    return left, right


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def pour(new, form):
    it = iter(new)
    return re.sub(r"[0-9]", lambda _: next(it), form)


def card(hit):
    d = re.sub(r"\D", "", hit)
    if not luhn(d):
        return hit
    half = (len(d) - 1) // 2
    rest = len(d) - 1 - half
    a, b = feistel(int(d[:half]), int(d[half:half + rest]), 10**half, 10**rest, "card")
    body = f"{a:0{half}d}{b:0{rest}d}"
    return pour(body + next(c for c in "0123456789" if luhn(body + c)), hit)


def ip(hit):
    o = list(map(int, hit.split(".")))
    if max(o) > 255:
        return hit
    a, b = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, "ip")
    return ".".join(map(str, (*divmod(a, 256), *divmod(b, 256))))


def phone(hit):
    d = re.sub(r"\D", "", hit)
    area, first = int(d[1:4]), int(d[4])
    areas, area0 = (800, 200) if area >= 200 else (200, 0)
    firsts, first0 = (8, 2) if first >= 2 else (2, 0)
    a, b = feistel((area - area0) * firsts + first - first0, int(d[5:]), areas * firsts, 10**6, "phone")
    return pour(f"1{a // firsts + area0:03d}{a % firsts + first0}{b:06d}", hit)


def date(hit):
    iso = "-" in hit
    d = re.sub(r"\D", "", hit)
    y, m, day = (d[:4], d[4:6], d[6:]) if iso else (d[4:], d[2:4], d[:2])
    try:
        n = (datetime.date(int(y), int(m), int(day)) - datetime.date(1800, 1, 1)).days
    except ValueError:
        return hit
    if not 0 <= n < 146097:
        return hit
    a, b = feistel(n // 773, n % 773, 189, 773, "date")
    new = datetime.date(1800, 1, 1) + datetime.timedelta(a * 773 + b)
    return pour(new.strftime("%Y%m%d" if iso else "%d%m%Y"), hit)


@pytest.mark.parametrize(("name", "values", "other"), [
    ("card", ["4111 1111 1111 1111", "4111111111111111", "4111111111111112", "5500-0000-0000-0004"], card),
    ("ip", ["10.0.0.255", "300.1.1.1", "0.0.0.0", "255.255.255.255"], ip),
    ("phone", ["+1 (269) 555-3296", "+12695553296", "+1 269-555-3297", "+1 (139) 055-2766"], phone),
    ("date", ["1999-02-28", "29.02.2000", "31/02/2001", "2001-02-30", "28/02/1999", "1800-01-01", "31.12.2199", "1700-01-01"], date),
])
def test_numbers_equal_a_plain_feistel(spark, name, values, other):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.select("v", getattr(ps, name)(F.col("v"), KEY).alias("p")).collect()
    assert {r.v: r.p or r.v for r in got} == {v: other(v) for v in values}


def test_permutation_has_no_collision(spark):
    df = spark.range(20_000).select(ps.feistel(F.col("id") % 189, F.floor(F.col("id") / 189), 189, 773, KEY, "t").alias("s"))
    assert df.distinct().count() == 20_000
    mails = spark.range(2600).select(F.concat(F.char((F.col("id") % 26 + 97).cast("int")), (F.col("id") / 26).cast("int").cast("string"), F.lit("@x.org")).alias("m"))
    assert mails.select(ps.email(F.col("m"), KEY).alias("p")).filter(F.col("p").rlike(r"^[a-z]\d+@x\.org$")).distinct().count() == 2600


def test_private_text(spark, edge_docs, no_docs):
    got = ps.replace(edge_docs, KEY)
    assert got.columns == [*edge_docs.columns, "pii_counts"]
    same = edge_docs.select("doc_id", "text").exceptAll(got.select("doc_id", "text")).collect()
    assert [r.text for r in same] == [PRIVATE]
    new = next(r for r in got.collect() if r.text and r.text.startswith("Mail "))
    assert list(new.pii_counts) == [2, 1, 2, 1, 1, 2]
    for stays in ("300.1.1.1", "1.2.3.4.5", "4111111111111112", "000-12-1234", "31/02/2001", "2001-02-30"):
        assert stays in new.text
    for gone in ("jo.doe9", "10.0.0.255", "4111 1111 1111 1111", "4111111111111111", "555-3296", "078-05-1120", "1999-02-28", "29.02.2000"):
        assert gone not in new.text
    a, b = re.findall(r"card ([\d ]{19}), (\d{16})", new.text)[0]
    assert a.replace(" ", "") == b and luhn(b)
    assert ps.replace(no_docs, KEY).count() == 0


def test_values_of_documents_are_gone_and_linked(spark, documents):
    before = {r.doc_id: r.text for r in documents.collect()}
    after = {r.doc_id: r.text for r in ps.replace(documents, KEY).collect()}
    links = {}
    for i, t in before.items():
        for hit in re.findall(r"(?<!\d)4\d{15}(?!\d)", t):
            if luhn(hit):
                assert hit not in after[i]
                links.setdefault(hit, set()).add(card(hit) in after[i])
        for hit in re.findall(r"[a-z.0-9]+@mail\d\.example\.com|\+1 \(\d{3}\) \d{3}-\d{4}", t):
            assert hit not in after[i]
    assert all(v == {True} for v in links.values())


def email(hit):
    local, domain = hit.split("@")
    left, right = local[:len(local) // 2], local[len(local) // 2:]

    def turned(s, k, other):
        digest = hashlib.sha256(f"{KEY}|email|{k}|{other}".encode()).digest()
        out = ""
        for i, c in enumerate(s):
            for first, n in (("a", 26), ("A", 26), ("0", 10)):
                if first <= c < chr(ord(first) + n):
                    c = chr((ord(c) - ord(first) + digest[i % 32]) % n + ord(first))
                    break
            out += c
        return out

    for k in range(1, 5):
        if k % 2:
            left = turned(left, k, right)
        else:
            right = turned(right, k, left)
    return f"{left}{right}@{domain}"


def ssn(hit):
    area, group, serial = map(int, hit.split("-"))
    if area in (0, 666) or area > 899 or not group or not serial:
        return hit
    a, b = feistel(area - 2 if area > 666 else area - 1, (group - 1) * 9999 + serial - 1, 898, 99 * 9999, "ssn")
    return f"{a + 2 if a >= 665 else a + 1:03d}-{b // 9999 + 1:02d}-{b % 9999 + 1:04d}"


def new_texts(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r.text for r in ps.replace(df, KEY).orderBy("i").collect()]


def test_mail_and_social_security_numbers_equal_plain_versions(spark):
    mails = ["a@x.org", "Jo.Doe+1_x%y@Mail.example.co", "Zz-9@a-b.de", "x" * 64 + "@x.io"]
    numbers = ["078-05-1120", "001-01-0001", "899-99-9999", "666-12-1234", "667-12-1234", "900-12-1234", "123-00-1234", "123-45-0000"]
    assert new_texts(spark, mails) == [email(x) for x in mails]
    assert new_texts(spark, numbers) == [ssn(x) for x in numbers]
    odd = ["a@x", "a@.x.org", "a@x.1", "@x.org", "y" * 65 + "@x.org", "a@10.x"]
    assert new_texts(spark, odd) == odd
    cut = {"a@x.org1": email("a@x.org") + "1", "a@x.org.": email("a@x.org") + ".", "(a@x.org)b@y.de": f"({email('a@x.org')}){email('b@y.de')}",
           "a@x.org..y": email("a@x.org") + "..y", "foo@10.0.0.1": "foo@" + ip("10.0.0.1"), "a@b@x.org": "a@" + email("b@x.org")}
    assert new_texts(spark, cut) == list(cut.values())


def test_cards_with_other_digits_beside_them(spark):
    c, d = "4111 1111 1111 1111", "4111-1111-1111-1111"
    cases = {
        f"{c} 123": f"{card(c)} 123", f"{d} 12/27": f"{card(d)} 12/27", f"12 {c}": f"12 {card(c)}", f"1 {c} 22": f"1 {card(c)} 22",
        "4111111111111111 737": card("4111111111111111") + " 737", "4111 1111 1111 1112 123": "4111 1111 1111 1112 123",
        f"{c}, {d}": f"{card(c)}, {card(d)}", "1234 5678 9012 34": "1234 5678 9012 34" if not luhn("12345678901234") else card("1234 5678 9012 34"),
    }
    assert new_texts(spark, cases) == list(cases.values())


def test_crafted_texts_take_linear_time(spark):
    import time

    labels = "x@" + "a." * 20_000 + "1"
    word, digits = "w" * 5_000_000, "1 " * 500_000
    many = "a@" * 200_000 + " " + "b@x." * 200_000
    start = time.time()
    assert new_texts(spark, [labels, word, digits, many]) == [labels, word, digits, many]
    assert time.time() - start < 60


def test_clashing_columns_stay(spark):
    df = spark.createDataFrame([("a@x.org", "keep", 7, "new")], "text string, _pii_hits string, pii_counts int, _pii_new string")
    out = ps.replace(df, KEY)
    assert out.columns == [*df.columns, "pii_counts_"]
    r = out.first()
    assert (r._pii_hits, r.pii_counts, r._pii_new, list(r.pii_counts_)) == ("keep", 7, "new", [1, 0, 0, 0, 0, 0])
