"""Format-preserving pseudonyms for personal numbers, dates and e-mail names, in DataFrame operations.

Candidates are found by pattern, validated (Luhn, mod 97, octets, calendar, number plans) and put
through a keyed Feistel permutation of their own format: a valid number becomes another valid
number of that kind, and equal values get equal pseudonyms in every document, however they are
punctuated. Candidates that fail validation, and all other text, stay as they are.

Kinds and domains:
  e-mail   letters and digits of the local part, each within its class; the domain stays
  card     13 to 19 digits, Luhn: all but first and check digit; the check digit is worked out anew
  IBAN     15 to 34 characters, mod 97: all after the check digits; these are worked out anew
  SSN      area x group x serial numbers that may be issued
  IPv4     the 2**32 addresses
  phone    digits after the country code; in +1 numbers area and exchange keep their leading class
  date     the 146,097 days of 1800-2199 as 189 x 773; yyyy-mm-dd, yyyy/mm/dd, dd.mm.yyyy,
           dd-mm-yyyy, and mm/dd/yyyy (dd/mm/yyyy where only that is a date)
"""

import secrets
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound, fresh

ROUNDS = 10
#: Where a session keeps the secret of the permutations.
SECRET = "spark.vistaloom.pii.key"


def secret(spark: SparkSession) -> str:
    """The session's secret. Where none is set, one is drawn that holds for this session only: values
    are then linked within it, and nobody can map them back later."""
    key = spark.conf.get(SECRET, None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set(SECRET, key)
    return key


#: Every part of an e-mail pattern is possessive and begins where its run of characters does (or the match
#: before ended), so a text is passed once and nothing stacks up, however long its runs are.
_LOCAL = "A-Za-z0-9._%+-"
_LABEL = "[A-Za-z0-9]++(?:-++[A-Za-z0-9]++)*+"
_NAMED, _OTHER = rf"\.(?=[A-Za-z]{{2}}){_LABEL}", rf"\.(?![A-Za-z]{{2}}){_LABEL}"
EMAIL = (
    rf"(?:(?<![{_LOCAL}])|\G)[._%+-]*+[A-Za-z0-9][{_LOCAL}]*+@{_LABEL}"
    rf"(?:(?:{_OTHER})*+{_NAMED}(?=(?:{_OTHER})*+\.[A-Za-z]{{2}}))*+(?:{_OTHER})*+\.[A-Za-z]{{2,}}+"
)
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
IPV4 = r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])"
DATE = r"(?<![0-9A-Za-z./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}-[0-9]{2}-[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9/-]|\.[0-9])"
SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
NANP = r"(?<![0-9A-Za-z+])(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])|(?<![0-9A-Za-z+])\+1[0-9]{10}(?![0-9A-Za-z])"
PHONE = r"(?<![0-9A-Za-z+])\+(?!1[ .(-])[0-9]{2,3}(?:[ .-]?\([0-9]{1,4}\))?(?:[ .-][0-9]{2,8}){1,5}(?![0-9A-Za-z])"
CARD = r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])"
CANDIDATE = "|".join((EMAIL, IBAN, IPV4, DATE, SSN, NANP, PHONE, CARD))
#: Ends that a card or IBAN may have, from the longest: its match may go on into what stands behind it.
CARD_ENDS = [f"[0-9](?:[ -]?[0-9]){{{n - 1}}}" for n in range(19, 12, -1)]
IBAN_ENDS = ["[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}"] + [f"[A-Z]{{2}}[0-9]{{2}}(?: [A-Z0-9]{{4}}){{{k}}}{tail}" for k in range(7, 1, -1) for tail in (" [A-Z0-9]{1,3}", "")]


def _prf(key: str, kind: str, turn: Column, other: Column) -> Column:
    """64 keyed bits of a round and the half that stays."""
    return F.xxhash64(F.sha2(F.concat(F.lit(f"{key}|{kind}|"), turn.cast("string"), F.lit("|"), other).cast("binary"), 256))


def permuted_pair(l: Column, r: Column, a: int, b: int, key: str, kind: str) -> Column:  # noqa: E741
    """Feistel permutation of Z_a x Z_b: struct<l, r> of longs."""

    def turn(s: Column, t: Column) -> Column:
        left = F.pmod(s["l"] + F.pmod(_prf(key, kind, t, s["r"].cast("string")), F.lit(a)), F.lit(a))
        right = F.pmod(s["r"] + F.pmod(_prf(key, kind, t, s["l"].cast("string")), F.lit(b)), F.lit(b))
        even = t % 2 == 0
        return F.struct(F.when(even, left).otherwise(s["l"]).cast("long").alias("l"), F.when(even, s["r"]).otherwise(right).cast("long").alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.struct(l.cast("long").alias("l"), r.cast("long").alias("r")), turn)


def permuted_digits(values: Column, radix: Column, key: str, kind: str, tweak: Column | None = None) -> Column:
    """Feistel permutation of mixed-radix digits: array<bigint> values, values[i] in [0, radix[i]).

    The halves are the even and the odd places; in a turn each place of one half moves by keyed bits
    of the other half.
    """
    tweak = F.lit("") if tweak is None else tweak

    def go(b: Column) -> Column:
        def turn(s: Column, t: Column) -> Column:
            other = F.concat(b["tweak"], F.lit("|"), F.array_join(F.filter(s, lambda _, i: i % 2 != t % 2).cast("array<string>"), ","))
            return bound(
                _prf(key, kind, t, other),
                lambda bits: F.transform(s, lambda v, i: F.when(i % 2 == t % 2, F.pmod(v + F.pmod(F.xxhash64(bits, i), F.get(b["radix"], i)), F.get(b["radix"], i))).otherwise(v)),
            )

        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), b["values"], turn)

    return bound(F.struct(values.cast("array<bigint>").alias("values"), radix.alias("radix"), tweak.alias("tweak")), go)


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _only(s: Column, drop: str) -> Column:
    return F.regexp_replace(s, drop, "")


def _is(c: Column, cls: str) -> Column:
    return c.rlike(f"^[{cls}]$")


def permuted_chars(s: Column, key: str, kind: str, leading: tuple[int, ...] = (), tweak: Column | None = None) -> Column:
    """Permutes the ASCII letters and digits of a string, each within its class; others stay.

    Case counts for the result only, so values that differ in case stay linked. Digits at the places
    in `leading` stay among 0-1 or among 2-9.
    """
    lead = lambda i: i.isin(*leading) if leading else F.lit(False)

    def low(c: Column, i: Column) -> Column:
        return F.when(_is(c, "a-z"), 97).when(_is(c, "A-Z"), 65).when(lead(i) & _is(c, "2-9"), 50).when(_is(c, "0-9"), 48)

    def size(c: Column, i: Column) -> Column:
        return F.when(_is(c, "a-zA-Z"), 26).when(lead(i) & _is(c, "2-9"), 8).when(lead(i) & _is(c, "01"), 2).when(_is(c, "0-9"), 10)

    def go(cs: Column) -> Column:
        every = F.transform(cs, lambda c, i: F.struct(c.alias("c"), low(c, i).alias("low"), F.coalesce(size(c, i), F.lit(1)).cast("long").alias("radix")))

        def placed(free: Column) -> Column:
            # Characters that stay are digits of radix 1.
            moved = permuted_digits(F.transform(free, lambda x: F.coalesce(F.ascii(x["c"]) - x["low"], F.lit(0))), F.transform(free, lambda x: x["radix"]), key, kind, tweak)
            return bound(moved, lambda new: F.array_join(F.transform(free, lambda x, i: F.when(x["low"].isNull(), x["c"]).otherwise(F.char(F.get(new, i) + x["low"]))), ""))

        return bound(every, placed)

    return bound(_chars(s), go)


def _reformat(original: Column, new: Column, moved: str = "0-9") -> Column:
    """The characters of `new` in the places of original's characters of a class."""

    def go(cs: Column) -> Column:
        at = F.filter(F.transform(cs, lambda c, i: F.when(_is(c, moved), i).otherwise(F.lit(-1))), lambda i: i >= 0)
        return bound(F.struct(at.alias("at"), _chars(new).alias("new")), lambda m: F.array_join(F.transform(cs, lambda c, i: F.when(_is(c, moved), F.get(m["new"], F.array_position(m["at"], i).cast("int") - 1)).otherwise(c)), ""))

    return bound(_chars(original), go)


def luhn_total(digits: Column) -> Column:
    """Luhn sum of a digit string, its last digit being the check digit."""
    each = F.transform(F.reverse(_chars(digits)), lambda c, i: F.when(i % 2 == 0, c.cast("int")).when(c.cast("int") >= 5, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2))
    return F.aggregate(each, F.lit(0), lambda s, v: s + v)


def mod97(s: Column) -> Column:
    """Remainder of upper-case letters (A is 10) and digits read as one number."""
    digits = F.array_join(F.transform(_chars(s), lambda c: F.when(_is(c, "A-Z"), (F.ascii(c) - 55).cast("string")).otherwise(c)), "")
    return F.aggregate(_chars(digits), F.lit(0), lambda a, c: (a * 10 + c.cast("int")) % 97)


def _email(m: Column, key: str) -> Column:
    at = F.substring_index(m, "@", -1)
    local = F.substring_index(m, "@", 1)
    marks = F.regexp_extract(local, "^[._%+-]*+", 0)
    return F.concat(marks, permuted_chars(F.substring(local, F.length(marks) + 1, F.length(local)), key, "email", tweak=F.lower(at)), F.lit("@"), at)


def _is_card(d: Column) -> Column:
    return (luhn_total(d) % 10 == 0) & ~d.rlike("^(.)\\1*$")


def _is_iban(s: Column) -> Column:
    return F.length(s).between(15, 34) & (mod97(F.concat(F.substring(s, F.lit(5), F.length(s)), F.left(s, F.lit(4)))) == 1)


def _card(m: Column, key: str) -> Column:
    def go(d: Column) -> Column:
        body = F.concat(F.left(d, F.lit(1)), permuted_chars(F.substring(d, F.lit(2), F.length(d) - 2), key, "card", tweak=F.left(d, F.lit(1))))
        check = bound(body, lambda b: F.concat(b, ((10 - luhn_total(F.concat(b, F.lit("0"))) % 10) % 10).cast("string")))
        return F.when(_is_card(d), _reformat(m, check))

    return bound(_only(m, "[^0-9]"), go)


def _iban(m: Column, key: str) -> Column:
    def go(s: Column) -> Column:
        land = F.left(s, F.lit(2))
        new = bound(permuted_chars(F.substring(s, F.lit(5), F.length(s)), key, "iban", tweak=land), lambda b: F.concat(land, F.lpad((98 - mod97(F.concat(b, land, F.lit("00")))).cast("string"), 2, "0"), b))
        return F.when(_is_iban(s), _reformat(m, new, "0-9A-Z"))

    return bound(_only(m, " "), go)


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.split_part(m, F.lit("-"), F.lit(i)).cast("int") for i in (1, 2, 3))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    nth = F.when(area > 666, area - 2).otherwise(area - 1)  # 898 areas
    new = lambda p: bound((p["l"] / 99).cast("int"), lambda a: F.format_string("%03d-%02d-%04d", F.when(a >= 665, a + 2).otherwise(a + 1), (p["l"] % 99 + 1).cast("int"), (p["r"] + 1).cast("int")))
    return F.when(valid, bound(permuted_pair(nth * 99 + group - 1, serial - 1, 898 * 99, 9999, key, "ssn"), new))


def _ipv4(m: Column, key: str) -> Column:
    octet = [F.split_part(m, F.lit("."), F.lit(i)).cast("int") for i in (1, 2, 3, 4)]
    valid = F.greatest(*octet) <= 255
    new = lambda p: F.concat_ws(".", *[((p[h] / d).cast("int") % 256).cast("string") for h in ("l", "r") for d in (256, 1)])
    return F.when(valid, bound(permuted_pair(octet[0] * 256 + octet[1], octet[2] * 256 + octet[3], 65536, 65536, key, "ipv4"), new))


def _phone(m: Column, key: str) -> Column:
    def nanp(d: Column) -> Column:
        national = permuted_chars(F.right(d, F.lit(10)), key, "phone", leading=(0, 3), tweak=F.lit("1"))
        return _reformat(m, F.when(F.length(d) == 11, F.concat(F.lit("1"), national)).otherwise(national))

    def other(d: Column) -> Column:
        code = F.regexp_extract(m, r"^\+([0-9]{2,3})", 1)
        return F.when(F.length(d).between(8, 15), _reformat(m, F.concat(code, permuted_chars(F.substring(d, F.length(code) + 1, F.length(d)), key, "phone", tweak=code))))

    return bound(_only(m, "[^0-9]"), lambda d: F.when(m.rlike(f"^(?:{NANP})$"), nanp(d)).otherwise(other(d)))


#: Days from 1800-01-01 to 2199-12-31: 146,097 = 189 * 773.
CYCLE = (189, 773)


def _date(m: Column, key: str) -> Column:
    first = F.lit("1800-01-01").cast("date")

    def shown(form: str) -> Column:
        day = F.datediff(F.try_to_date(m, form), first)
        new = lambda n: bound(permuted_pair((n / CYCLE[1]).cast("long"), n % CYCLE[1], *CYCLE, key, "date"), lambda p: F.date_format(F.date_add(first, (p["l"] * CYCLE[1] + p["r"]).cast("int")), form))
        return bound(day, lambda n: F.when((n >= 0) & (n < CYCLE[0] * CYCLE[1]), new(n)))

    return (
        F.when(m.rlike("^....-"), shown("yyyy-MM-dd"))
        .when(m.rlike("^..../"), shown("yyyy/MM/dd"))
        .when(m.rlike(r"^..\."), shown("dd.MM.yyyy"))
        .when(m.rlike("^..-"), shown("dd-MM-yyyy"))
        .when(F.try_to_date(m, "MM/dd/yyyy").isNotNull(), shown("MM/dd/yyyy"))
        .otherwise(shown("dd/MM/yyyy"))
    )


def kind_of(m: Column) -> Column:
    """Which pattern a candidate is of (not yet whether it is valid)."""
    return (
        F.when(m.contains("@"), "email")
        .when(m.rlike("^[A-Z]"), "iban")
        .when(m.rlike(r"^[0-9]+(\.[0-9]+){3}$"), "ipv4")
        .when(m.rlike(f"^(?:{DATE})$"), "date")
        .when(m.rlike(f"^(?:{SSN})$"), "ssn")
        .when(m.startswith("+") | m.rlike(f"^(?:{NANP})$"), "phone")
        .otherwise("card")
    )


def pseudonym(m: Column, key: str) -> Column:
    """A candidate's pseudonym; null if it is not valid."""
    made: dict[str, Callable[[Column, str], Column]] = {"email": _email, "iban": _iban, "ipv4": _ipv4, "date": _date, "ssn": _ssn, "phone": _phone}

    def go(kind: Column) -> Column:
        out = F.when(kind == "card", _card(m, key))
        for name, f in made.items():
            out = out.when(kind == name, f(m, key))
        return out

    return bound(kind_of(m), go)


def _valid(text: Column, pattern: str, ends: list[str], valid: Callable[[Column], Column]) -> Column:
    """Regular expression of the valid values of a pattern in a text, at any start and with any end,
    longer ones first; null if there are none."""
    at = [F.regexp_extract_all(text, F.lit(f"(?<![0-9A-Za-z])(?=({e})(?![0-9A-Za-z]))"), F.lit(1)) for e in ends]
    values = F.filter(F.array_distinct(F.concat(*at)), valid)
    return F.when(text.rlike(pattern), bound(values, lambda v: F.when(F.size(v) > 0, F.concat(F.lit("(?<![0-9A-Za-z])(?:"), F.array_join(v, "|"), F.lit(")(?![0-9A-Za-z])")))))


def candidates(text: Column) -> Column:
    """CANDIDATE with the text's own valid cards and IBANs in place of their patterns, so that one that
    is not valid keeps no other value from being found."""
    card = _valid(text, CARD, CARD_ENDS, lambda m: _is_card(_only(m, "[^0-9]")))
    iban = _valid(text, IBAN, IBAN_ENDS, lambda m: _is_iban(_only(m, " ")))
    return F.concat_ws("|", F.lit(EMAIL), iban, F.lit("|".join((IPV4, DATE, SSN, NANP, PHONE))), card)


def pseudonymised(docs: DataFrame, key: str, text_col: str = "text", found: str | None = None) -> DataFrame:
    """docs with text_col pseudonymised; rows and other columns stay, null stays null.

    key is the secret of the permutations. found: a column to add, array<struct<kind, value,
    pseudonym>> of what was replaced, in order (empty if nothing was); a column of docs of that name
    gives way to it. Empty texts stay empty and whole texts are read, in time proportional to their
    length whatever they hold. Equal texts become equal texts, repeated rows stay repeated, and an
    empty table stays empty.
    """
    text = F.col(f"`{text_col}`")
    name, pattern = fresh(docs, "__found"), fresh(docs, "__pattern")
    each = F.transform(F.regexp_extract_all(text, F.col(pattern), F.lit(0)), lambda m: F.struct(kind_of(m).alias("kind"), m.alias("value"), pseudonym(m, key).alias("pseudonym")))
    out = docs.withColumn(pattern, F.when(text.rlike("[0-9@]"), candidates(text))).withColumn(name, F.when(text.rlike("[0-9@]"), each))
    hits = F.col(name)
    joined = bound(F.split(text, F.col(pattern), -1), lambda parts: F.concat(F.array_join(F.transform(hits, lambda h, i: F.concat(F.get(parts, i), F.coalesce(h["pseudonym"], h["value"]))), ""), F.element_at(parts, -1)))
    out = out.withColumn(text_col, F.when(F.size(hits) > 0, joined).otherwise(text))
    if found:
        out = out.withColumn(found, F.coalesce(F.filter(hits, lambda h: h["pseudonym"].isNotNull()), F.filter(F.array(F.struct(F.lit("").alias("kind"), F.lit("").alias("value"), F.lit("").alias("pseudonym"))), lambda _: F.lit(False))))
    return out.drop(name, pattern)


def with_length(new: DataFrame, old: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """new with its code points counted again, where it has such a column; columns as in old."""
    if chars_col not in old.columns:
        return new.select(*old.columns)
    n = F.when(F.col(chars_col).isNotNull(), F.char_length(text_col).cast(old.schema[chars_col].dataType))
    return new.withColumn(chars_col, n).select(*old.columns)
