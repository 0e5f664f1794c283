import datetime
import hashlib
import random
import re
import string
import struct
import time

import pytest
import xxhash
from pyspark.sql import functions as F

from vistaloom.llm import pii, queries


def run(spark, texts, key="k"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = pii.pseudonymised(df, key, found="found").orderBy("doc_id").collect()
    return [(r.text, [(f.kind, f.value, f.pseudonym) for f in r.found]) for r in rows]


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def card(rng):
    body = "4" + "".join(rng.choices("0123456789", k=14))
    return next(body + c for c in "0123456789" if luhn(body + c))


def test_kinds_stay_valid_and_linked(spark):
    rng = random.Random(3)
    c = card(rng)
    spaced = " ".join(c[i : i + 4] for i in range(0, 16, 4))
    values = ["Bob.Smith42@mail8.example.com", "bob.smith42@mail8.example.com", c, spaced, "GB82 WEST 1234 5698 7654 32", "GB82WEST12345698765432", "DE89370400440532013000", "123-45-6789", "70.123.182.155", "+1 (269) 555-3296", "(269) 555-3296", "269-555-3296", "+12695553296", "+49 30 1234567", "1987-03-12", "12.03.1987", "03/12/1987", "1987/03/12", "31/12/1999"]
    out = run(spark, [f"See {v} now, {v}." for v in values])
    new = {}
    for v, (text, found) in zip(values, out):
        assert len(found) == 2 and found[0] == found[1] and found[0][1] == v, (v, found)
        p = found[0][2]
        assert p != v and text == f"See {p} now, {p}."
        shape = lambda s: re.sub("[0-9]", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", s)))
        assert shape(p) == shape(v) or v == "70.123.182.155"
        new[v] = p
    only = lambda s: re.sub("[^0-9A-Z]", "", s.upper())
    assert new[values[0]].lower() == new[values[1]].lower() and new[values[0]].endswith("@mail8.example.com")
    assert only(new[c]) == only(new[spaced]) and luhn(new[c]) and new[c][0] == "4"
    assert only(new["GB82 WEST 1234 5698 7654 32"]) == new["GB82WEST12345698765432"]
    for v in ("GB82WEST12345698765432", "DE89370400440532013000"):
        s = new[v][4:] + new[v][:4]
        assert int("".join(str(int(x, 36)) for x in s)) % 97 == 1 and new[v][:2] == v[:2]
    assert only(new["+1 (269) 555-3296"])[1:] == only(new["(269) 555-3296"]) == only(new["269-555-3296"]) == only(new["+12695553296"])[1:]
    iso = datetime.date.fromisoformat(new["1987-03-12"])
    assert [new[x] for x in ("12.03.1987", "03/12/1987", "1987/03/12")] == [iso.strftime(f) for f in ("%d.%m.%Y", "%m/%d/%Y", "%Y/%m/%d")]
    assert all(int(x) < 256 for x in new["70.123.182.155"].split("."))
    again = run(spark, [f"See {values[0]}"])
    assert again[0][1][0][2] == new[values[0]] and run(spark, [f"See {values[0]}"], "other")[0][1][0][2] != new[values[0]]


@pytest.mark.parametrize("text", ["4041894974608796", "GB82WEST12345698765433", "666-12-3456", "000-12-3456", "300.1.1.1", "1.2.3.4.5", "2023-02-30", "2023-13-01", "version 3.14", "12345", "a@b", "no 0000000000000000 card", "", None, "x1-2-3", "11:30", "Apache 2.0"])
def test_what_is_not_valid_stays(spark, text):
    assert run(spark, [text]) == [(text, [])]


def test_permutations_are_one_to_one(spark):
    pairs = spark.range(189 * 773).select(pii.permuted_pair((F.col("id") / 773).cast("long"), F.col("id") % 773, 189, 773, "k", "date").alias("p"))
    assert pairs.distinct().count() == 189 * 773
    codes = spark.range(10 * 26 * 10).select(F.concat((F.col("id") % 10).cast("string"), F.char(F.lit(97) + (F.col("id") / 10).cast("int") % 26), (F.col("id") / 260).cast("int").cast("string")).alias("s"))
    assert codes.select(pii.permuted_chars(F.col("s"), "k", "t").alias("p")).distinct().count() == 2600
    leads = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("s")).select("s", pii.permuted_chars(F.col("s"), "k", "t", leading=(0,)).alias("p")).collect()
    assert len({r.p for r in leads}) == 1000 and all((r.s[0] in "01") == (r.p[0] in "01") for r in leads)


def test_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = queries.queries()["op2_pii"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in out) == sorted(docs)
    mail, phone, ip = re.compile(r"\S+\.\d+@\S+"), re.compile(r"\+1 \(\d{3}\) \d{3}-\d{4}"), re.compile(r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\d.])")
    n = 0
    for r in out:
        old = docs[r.doc_id]
        private = mail.findall(old) + phone.findall(old) + ip.findall(old) + [x for x in re.findall(r"\b\d{16}\b", old) if luhn(x)]
        n += len(private)
        assert r.n_replaced == len(private) and (r.text == old) == (not private)
        assert not any(p in r.text for p in private) and (len(r.text) == len(old) or ip.findall(old))
    assert n > 0


def test_odd_rows(odd, none):
    assert sorted(map(str, pii.pseudonymised(odd, "k").collect())) == sorted(map(str, odd.collect()))
    assert pii.pseudonymised(none, "k").count() == 0 and pii.pseudonymised(none, "k").columns == odd.columns


@pytest.mark.parametrize(
    "text, value",
    [
        ("4111 1111 1111 1111 12/25", "4111 1111 1111 1111"), ("4111 1111 1111 1111 123", "4111 1111 1111 1111"), ("no 12345 4111 1111 1111 1111.", "4111 1111 1111 1111"),
        ("12345 555-123-4567", "555-123-4567"), ("ES91 2100 0418 4502 0005 1332 THE", "ES91 2100 0418 4502 0005 1332"), ("GB82 WEST 1234 5698 7654 32 AND", "GB82 WEST 1234 5698 7654 32"),
    ],
)
def test_neighbours_of_a_value_do_not_hide_it(spark, text, value):
    (new, found), = run(spark, [text])
    assert [f[1] for f in found] == [value] and found[0][2] != value
    assert new == text.replace(value, found[0][2])


# The same permutations in plain Python.


def _hash(data, seed=42):
    return xxhash.xxh64_intdigest(data, seed)


def _signed(h):
    return h - 2**64 if h >= 2**63 else h


def _prf(key, kind, t, other):
    return _hash(hashlib.sha256(f"{key}|{kind}|{t}|{other}".encode()).hexdigest().encode())


def _pair(l, r, a, b, key, kind):  # noqa: E741
    for t in range(pii.ROUNDS):
        if t % 2 == 0:
            l = (l + _signed(_prf(key, kind, t, r)) % a) % a  # noqa: E741
        else:
            r = (r + _signed(_prf(key, kind, t, l)) % b) % b
    return l, r


def _digits(values, radix, key, kind, tweak):
    for t in range(pii.ROUNDS):
        bits = _prf(key, kind, t, tweak + "|" + ",".join(str(v) for i, v in enumerate(values) if i % 2 != t % 2))
        values = [(v + _signed(_hash(struct.pack("<i", i), _hash(struct.pack("<Q", bits)))) % radix[i]) % radix[i] if i % 2 == t % 2 else v for i, v in enumerate(values)]
    return values


def _chars(s, key, kind, tweak, leading=()):
    low = [97 if c in string.ascii_lowercase else 65 if c in string.ascii_uppercase else 50 if i in leading and c in "23456789" else 48 if c in string.digits else None for i, c in enumerate(s)]
    size = [26 if c in string.ascii_letters else 1 if c not in string.digits else 10 if i not in leading else 8 if c in "23456789" else 2 for i, c in enumerate(s)]
    moved = _digits([0 if at is None else ord(c) - at for c, at in zip(s, low)], size, key, kind, tweak)
    return "".join(c if at is None else chr(m + at) for c, at, m in zip(s, low, moved))


def _put(original, new, moved):
    new = iter(new)
    return "".join(next(new) if c in moved else c for c in original)


def _rest(s):
    return int("".join(str(int(c, 36)) for c in s)) % 97


def plain(m, key):
    """Pseudonym of one valid value."""
    only = "".join(c for c in m if c in string.digits)
    if "@" in m:
        local, domain = m.split("@")
        marks = re.match("[._%+-]*", local)[0]
        return marks + _chars(local[len(marks) :], key, "email", domain.lower()) + "@" + domain
    if m[0] in string.ascii_uppercase:
        s = m.replace(" ", "")
        body = _chars(s[4:], key, "iban", s[:2])
        return _put(m, f"{s[:2]}{98 - _rest(body + s[:2] + '00'):02d}{body}", string.ascii_uppercase + string.digits)
    if re.fullmatch(r"\d+(\.\d+){3}", m):
        a, b, c, d = map(int, m.split("."))
        p = _pair(a * 256 + b, c * 256 + d, 65536, 65536, key, "ipv4")
        return ".".join(str(x) for h in p for x in divmod(h, 256))
    for form in ("%Y-%m-%d", "%Y/%m/%d", "%d.%m.%Y", "%d-%m-%Y", "%m/%d/%Y", "%d/%m/%Y"):
        try:
            n = (datetime.datetime.strptime(m, form).date() - datetime.date(1800, 1, 1)).days
        except ValueError:
            continue
        p = _pair(n // 773, n % 773, 189, 773, key, "date")
        return (datetime.date(1800, 1, 1) + datetime.timedelta(p[0] * 773 + p[1])).strftime(form)
    if re.fullmatch(r"\d{3}-\d\d-\d{4}", m):
        area, group, serial = map(int, m.split("-"))
        areas = [x for x in range(1, 900) if x != 666]
        p = _pair(areas.index(area) * 99 + group - 1, serial - 1, 898 * 99, 9999, key, "ssn")
        return f"{areas[p[0] // 99]:03d}-{p[0] % 99 + 1:02d}-{p[1] + 1:04d}"
    if m[0] == "+" and not m.startswith("+1"):
        code = re.match(r"\+(\d{2,3})", m)[1]
        return _put(m, code + _chars(only[len(code) :], key, "phone", code), string.digits)
    if m[0] in "+(" or len(only) == 10:
        return _put(m, only[:-10] + _chars(only[-10:], key, "phone", "1", (0, 3)), string.digits)
    body = only[0] + _chars(only[1:-1], key, "card", only[0])
    return _put(m, next(body + c for c in string.digits if luhn(body + c)), string.digits)


def test_equals_plain_python(spark):
    rng = random.Random(9)
    num = lambda n: "".join(rng.choices(string.digits, k=n))
    values = []
    for _ in range(25):
        c = card(rng)
        bban = "".join(rng.choices(string.ascii_uppercase, k=4)) + num(14)
        iban = f"GB{98 - _rest(bban + 'GB00'):02d}{bban}"
        local = "".join(rng.choices(string.ascii_letters + string.digits + "._%+-", k=rng.randint(1, 30))).strip("._%+-") or "q"
        day = datetime.date(1800, 1, 1) + datetime.timedelta(rng.randrange(146097))
        values += [c, "-".join(c[i : i + 4] for i in range(0, 16, 4)), iban, " ".join(iban[i : i + 4] for i in range(0, 22, 4)), f"{local}@ab-{num(2)}.Example.com"]
        values += [f"{rng.randint(1, 665):03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}", f"{rng.randint(667, 899)}-01-0001", ".".join(str(rng.randrange(256)) for _ in range(4))]
        values += [f"+1 ({rng.randint(200, 999)}) {rng.randint(200, 999)}-{num(4)}", f"{rng.randint(200, 999)}-{rng.randint(200, 999)}-{num(4)}", f"+49 30 {num(7)}", f"+353 {num(2)} {num(6)}"]
        values += [day.isoformat(), day.strftime("%d.%m.%Y"), day.strftime("%m/%d/%Y"), f"{rng.randint(13, 28)}/05/1990"]
    for v, (text, found) in zip(values, run(spark, [f"(see {v}, and {v})" for v in values], "secret")):
        assert [f[1] for f in found] == [v, v], v
        assert text == f"(see {plain(v, 'secret')}, and {plain(v, 'secret')})", v


def test_long_runs(spark):
    texts = ["x@" + "ab." * 100_000 + "com 1", "a" * 1_000_000 + " 1", "a" * 100_000 + "@x.com", "a." * 100_000 + " 1", "1 " * 50_000, "a@" * 50_000, "4111 1111 1111 1111 12/25 " * 2000, "bob@b.com " * 2000, "x@" + "1." * 100_000 + "1"]
    began = time.time()
    out = run(spark, texts)
    assert time.time() - began < 60
    assert [len(found) for _, found in out] == [1, 0, 1, 0, 0, 0, 2000, 2000, 0]
    for text, (new, found) in zip(texts, out):
        assert len(new) == len(text) and (new != text) == bool(found)
        if found:
            assert new == text.replace(found[0][1], plain(found[0][1], "k"))


@pytest.mark.parametrize("text, value", [("..foo@x.com", "..foo@x.com"), ("+1 555-123-4567.joe@x.com", ".joe@x.com"), ("a@b.com1 c", "a@b.com"), ("a@b.c1.com.1", "a@b.c1.com"), ("a@b-c.de-f.org-", "a@b-c.de-f.org"), ("x@a.com.1.1.1", "x@a.com"), ("q@a_b.com", None), ("a@b.c", None), ("...@x.com", None)])
def test_where_an_address_ends(spark, text, value):
    assert [f[1] for f in run(spark, [text])[0][1] if f[0] == "email"] == ([value] if value else [])


def test_a_column_called_found_gives_way(spark):
    df = spark.createDataFrame([(1, "a@b.com", "x", 2, 3)], "doc_id long, text string, found string, __found int, __PATTERN int")
    out = pii.pseudonymised(df, "k", found="found")
    assert out.columns == df.columns and out.first().found[0].value == "a@b.com" and out.first()["__found"] == 2 and out.first()["__PATTERN"] == 3
    assert pii.pseudonymised(df, "k").first().found == "x"


def test_the_secret_is_the_session_s(spark):
    key = pii.secret(spark)
    assert len(key) == 64 and pii.secret(spark) == key
    spark.conf.set(pii.SECRET, "mine")
    assert pii.secret(spark) == "mine"
    spark.conf.unset(pii.SECRET)
    assert pii.secret(spark) not in (key, "mine")
