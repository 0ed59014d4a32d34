"""Pseudonyms that keep their format: numbers, dates and addresses in texts are permuted under a key.

All is built-in expressions. One pattern finds candidates in a text, and each kind validates its own: a
date must exist, an IPv4 address have four bytes, an IBAN its check digits, a social security number an issued form.
What passes is permuted by a Feistel network over just its own domain, so the result is a valid value of the
same kind, equal values get equal pseudonyms in every document, and different values different ones:

* dates: a day of the 400 years 1700 to 2099, which are 189 x 773 days;
* IPv4 addresses: 2**16 x 2**16; social security numbers: 88902 x 9999;
* account numbers of 13 to 19 digits: all digits but the first and the check digit, which is computed anew so that
  a number that passes the Luhn test passes it again, and one that doesn't fails by the same amount;
* IBANs: digits and letters of the account within their class, with new check digits;
* telephone numbers: all digits but the first after a plus sign, however they are grouped;
* local parts of mail addresses and quoted hexadecimal secrets: each character within its class.

A round adds a keyed hash (SHA-2) of one half to the other, modulo its range. Separators stay where they are.

Defined cases: a null text stays null, a text without candidates stays as it is, a candidate that fails its
validation too. Dates outside of the 400 years stay. Equal rows get equal texts. Letters outside of Latin-1 in a mail address
stay. Extra columns are the caller's and untouched. A text of any length is read whole.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendlake.llm.common import let

ROUNDS = 8

#: Alphabets of the character classes; a character moves within its own.
TEXT_CLASSES = (
    "0123456789",
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ",
    "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞß",
)
HEX_CLASSES = ("0123456789abcdef",)

MAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}"
#: The length of the account numbers of each country in the IBAN registry.
IBAN_LENGTHS = {
    15: "NO",
    16: "BE",
    18: "DK FK FO FI GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST",
    26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}


def _iban() -> str:
    """Numbers of known countries end at their length, so that no word or number behind them is taken in."""
    known = [
        f"(?:{'|'.join(names.split())})[0-9]{{2}}(?: ?[A-Z0-9]){{{length - 4}}}(?![0-9A-Za-z])"
        for length, names in IBAN_LENGTHS.items()
    ]
    return rf"(?<![0-9A-Za-z])(?:{'|'.join(known)}|[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?(?![0-9A-Za-z]))"


IBAN = _iban()
ISO_DATE = r"(?<![0-9A-Za-z.-])[0-9]{4}(?:-[0-9]{2}-[0-9]{2}|/[0-9]{2}/[0-9]{2})(?![0-9A-Za-z-])"
DAY_FIRST = r"(?<![0-9A-Za-z./])[0-9]{1,2}(?:/[0-9]{1,2}/|\.[0-9]{1,2}\.)[0-9]{4}(?![0-9A-Za-z])"
IPV4 = r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])"
SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
PHONE = (
    r"(?:(?<![0-9A-Za-z+])\+[0-9](?:[ ().-]{0,2}[0-9]){6,14}|(?<![0-9A-Za-z])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}"
    r"|(?<![0-9A-Za-z.-])[0-9]{3}([.-])[0-9]{3}\1[0-9]{4})(?![0-9A-Za-z])"
)
#: Four groups of four digits are a number by themselves, unless a fifth group of three makes nineteen.
ACCOUNT = (
    r"(?<![0-9A-Za-z])(?:[0-9]{4}(?:[ -][0-9]{4}){3}(?![0-9A-Za-z]|[ -][0-9]{3}(?![0-9A-Za-z]))"
    r"|[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z]))"
)
SECRET = r"(?<=[\"'=:])[0-9a-fA-F]{32,128}(?![0-9A-Za-z])"
#: In order of precedence.
KINDS = {
    "mail": MAIL,
    "iban": IBAN,
    "iso_date": ISO_DATE,
    "day_first": DAY_FIRST,
    "ipv4": IPV4,
    "ssn": SSN,
    "phone": PHONE,
    "account": ACCOUNT,
    "secret": SECRET,
}
ANY = "|".join(KINDS.values())

FIRST_DAY = "1700-01-01"
DAYS = (189, 773)


def keyed(key: str, kind: str, round_: Column, value: Column) -> Column:
    """SHA-512 of a round's input, hexadecimal, hashed twice with the key in front."""
    message = F.concat_ws("|", F.lit(kind), round_.cast("string"), value.cast("string"))
    return F.sha2(F.concat(F.lit(key), F.sha2(F.concat(F.lit(key), message), 512)), 512)


def feistel_numbers(key: str, kind: str, a: Column, b: Column, sizes: tuple[int, int]) -> Column:
    """Struct a, b: a permutation of pairs of numbers below ``sizes``."""

    def step(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        fixed = F.when(even, s["b"]).otherwise(s["a"])

        def moved(k: Column) -> Column:
            return F.struct(
                F.when(even, (s["a"] + k) % sizes[0]).otherwise(s["a"]).alias("a"),
                F.when(even, s["b"]).otherwise((s["b"] + k) % sizes[1]).alias("b"),
            )

        return let(F.conv(F.substring(keyed(key, kind, i, fixed), 1, 15), 16, 10).cast("long"), moved)

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.array(*map(F.lit, range(ROUNDS))), start, step)


def feistel_text(key: str, kind: str, text: Column, classes: tuple[str, ...] = TEXT_CLASSES) -> Column:
    """A permutation of the texts that have the same characters' classes at the same places."""

    def shifted(c: Column, by: Column) -> Column:
        out = None
        for alphabet in classes:
            at = F.position(c, F.lit(alphabet))
            new = F.substr(F.lit(alphabet), F.pmod(at - 1 + by, F.lit(len(alphabet))).cast("int") + 1, F.lit(1))
            out = F.when(at > 0, new) if out is None else out.when(at > 0, new)
        return out.otherwise(c)

    def shift_all(half: Column, stream: Column) -> Column:
        chars = F.transform(
            F.sequence(F.lit(1), F.length(half)),
            lambda j: shifted(
                F.substr(half, j, F.lit(1)),
                F.conv(F.substr(stream, F.pmod((j - 1) * 3, F.lit(126)) + 1, F.lit(3)), 16, 10).cast("int"),
            ),
        )
        return F.when(F.length(half) > 0, F.array_join(chars, "")).otherwise(half)

    def step(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        fixed = F.when(even, s["b"]).otherwise(s["a"])

        def moved(stream: Column) -> Column:
            return F.struct(
                F.when(even, shift_all(s["a"], stream)).otherwise(s["a"]).alias("a"),
                F.when(even, s["b"]).otherwise(shift_all(s["b"], stream)).alias("b"),
            )

        return let(keyed(key, kind, i, fixed), moved)

    def halves(t: Column) -> Column:
        half = F.floor(F.length(t) / 2).cast("int")
        return F.struct(F.substr(t, F.lit(1), half).alias("a"), F.substr(t, half + 1, F.length(t)).alias("b"))

    def whole(s: Column) -> Column:
        return F.concat(s["a"], s["b"])

    return F.aggregate(F.array(*map(F.lit, range(ROUNDS))), halves(text), step, whole)


def put_back(shape: Column, characters: Column) -> Column:
    """``shape`` with its ASCII letters and digits replaced in turn by ``characters``."""

    def add(s: Column, c: Column) -> Column:
        fits = c.rlike("[0-9A-Za-z]")
        return F.struct(
            F.concat(s["out"], F.when(fits, F.substr(characters, s["at"], F.lit(1))).otherwise(c)).alias("out"),
            F.when(fits, s["at"] + 1).otherwise(s["at"]).alias("at"),
        )

    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    return F.aggregate(F.split(shape, ""), start, add, lambda s: s["out"])


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn_digit(payload: Column) -> Column:
    """The digit that completes ``payload`` to a number that passes the Luhn test."""

    def add(s: Column, c: Column) -> Column:
        doubled = c.cast("int") * F.when(s["twice"], 2).otherwise(1)
        return F.struct(
            (s["sum"] + F.when(doubled > 9, doubled - 9).otherwise(doubled)).alias("sum"), (~s["twice"]).alias("twice")
        )

    start = F.struct(F.lit(0).alias("sum"), F.lit(True).alias("twice"))
    return F.aggregate(F.split(F.reverse(payload), ""), start, add, lambda s: F.pmod(-s["sum"], F.lit(10)))


def account(key: str, value: Column) -> Column:
    def of_digits(d: Column) -> Column:
        payload = F.substr(d, F.lit(1), F.length(d) - 1)

        def checked(new: Column) -> Column:
            off = F.substr(d, F.length(d), F.lit(1)).cast("int") - luhn_digit(payload)
            return put_back(value, F.concat(new, F.pmod(luhn_digit(new) + off, F.lit(10)).cast("string")))

        inner = F.substr(payload, F.lit(2), F.length(payload))
        return let(F.concat(F.substr(d, F.lit(1), F.lit(1)), feistel_text(key, "account", inner)), checked)

    return let(digits_of(value), of_digits)


def phone(key: str, value: Column) -> Column:
    def of_digits(d: Column) -> Column:
        kept = F.when(value.startswith("+"), 1).otherwise(0)
        rest = F.substr(d, kept + 1, F.length(d))
        return put_back(value, F.concat(F.substr(d, F.lit(1), kept), feistel_text(key, "phone", rest)))

    return let(digits_of(value), of_digits)


def mod97(text: Column) -> Column:
    """The remainder of a text of digits and capitals, which stand for 10 to 35."""

    def add(r: Column, c: Column) -> Column:
        number = F.when(c.rlike("[0-9]"), c.try_cast("int")).otherwise(F.ascii(c) - 55)
        return (r * F.when(number > 9, 100).otherwise(10) + number) % 97

    return F.aggregate(F.split(text, ""), F.lit(0), add)


def iban(key: str, value: Column) -> Column:
    def of_compact(c: Column) -> Column:
        country, own = F.substr(c, F.lit(1), F.lit(2)), F.substr(c, F.lit(5), F.length(c))
        valid = (mod97(F.concat(own, F.substr(c, F.lit(1), F.lit(4)))) == 1) & F.length(c).between(15, 34)

        def checked(new: Column) -> Column:
            check = F.lpad((98 - mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
            return put_back(value, F.concat(country, check, new))

        return F.when(valid, let(feistel_text(key, "iban", own), checked)).otherwise(value)

    return let(F.regexp_replace(value, " ", ""), of_compact)


def ssn(key: str, value: Column) -> Column:
    part = F.split(value, "-")
    area, group, serial = (F.get(part, i).cast("int") for i in range(3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    index = area - 1 - F.when(area > 666, 1).otherwise(0)

    def written(s: Column) -> Column:
        at = F.floor(s["a"] / 99)
        new_area = at + 1 + F.when(at >= 665, 1).otherwise(0)
        return F.format_string("%03d-%02d-%04d", new_area.cast("long"), s["a"] % 99 + 1, s["b"] + 1)

    moved = feistel_numbers(key, "ssn", index * 99 + group - 1, serial - 1, (88902, 9999))
    return F.when(valid, let(moved, written)).otherwise(value)


def ipv4(key: str, value: Column) -> Column:
    part = F.split(value, r"\.")
    byte = [F.get(part, i).cast("int") for i in range(4)]
    valid = F.greatest(*byte) <= 255

    def written(s: Column) -> Column:
        return F.concat_ws(".", *(F.floor(s[h] / 256).cast("string") if high else (s[h] % 256).cast("string") for h in "ab" for high in (1, 0)))

    moved = feistel_numbers(key, "ipv4", byte[0] * 256 + byte[1], byte[2] * 256 + byte[3], (65536, 65536))
    return F.when(valid, let(moved, written)).otherwise(value)


def day_moved(key: str, day: Column) -> Column:
    """The day's pseudonym; null for no day and for one outside of the 400 years."""
    index = F.date_diff(day, F.lit(FIRST_DAY).cast("date"))
    moved = feistel_numbers(key, "date", F.floor(index / DAYS[1]), index % DAYS[1], DAYS)
    back = let(moved, lambda s: F.date_add(F.lit(FIRST_DAY).cast("date"), (s["a"] * DAYS[1] + s["b"]).cast("int")))
    return F.when(index.between(0, DAYS[0] * DAYS[1] - 1), back)


def calendar_date(key: str, value: Column, year_first: bool) -> Column:
    """Year, month, day; or day, month, year, and with slashes month, day, year if only that exists."""

    def of_mark(mark: Column) -> Column:
        part = F.split(value, F.concat(F.lit("["), mark, F.lit("]")))
        one, two, three = (F.get(part, i) for i in range(3))

        def day(y: Column, m: Column, d: Column) -> Column:
            return day_moved(key, F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")).try_cast("date"))

        if year_first:
            return let(
                day(one, two, three),
                lambda new: F.when(
                    new.isNotNull(), F.concat(*(F.date_format(new, "yyyy"), mark, F.date_format(new, "MM"), mark, F.date_format(new, "dd")))
                ),
            )

        short = (F.length(one) == 1) | (F.length(two) == 1)

        def written(new: Column, order: tuple[Column, Column]) -> Column:
            fields = [F.when(short, f(new).cast("string")).otherwise(F.lpad(f(new).cast("string"), 2, "0")) for f in order]
            return F.when(new.isNotNull(), F.concat(fields[0], mark, fields[1], mark, F.date_format(new, "yyyy")))

        usual = let(day(three, two, one), lambda new: written(new, (F.dayofmonth, F.month)))
        other = let(day(three, one, two), lambda new: written(new, (F.month, F.dayofmonth)))
        return F.coalesce(usual, F.when(mark == "/", other))

    mark = F.regexp_extract(value, "[./-]", 0)
    return F.coalesce(let(mark, of_mark), value)


def pseudonym(key: str, value: Column) -> Column:
    """The pseudonym of one candidate, or the candidate if no kind accepts it."""
    makers = {
        "mail": lambda v: F.concat(
            feistel_text(key, "mail", F.substring_index(v, "@", 1)), F.lit("@"), F.substring_index(v, "@", -1)
        ),
        "iban": lambda v: iban(key, v),
        "iso_date": lambda v: calendar_date(key, v, True),
        "day_first": lambda v: calendar_date(key, v, False),
        "ipv4": lambda v: ipv4(key, v),
        "ssn": lambda v: ssn(key, v),
        "phone": lambda v: phone(key, v),
        "account": lambda v: account(key, v),
        "secret": lambda v: feistel_text(key, "secret", F.lower(v), HEX_CLASSES),
    }
    # Alone, a candidate has lost what surrounds it; look-arounds hold at both ends, but the one that asks for a mark.
    out = None
    for kind, pattern in KINDS.items():
        alone = value.rlike("^(?:" + pattern.replace(r"(?<=[\"'=:])", "") + ")$")
        out = F.when(alone, makers[kind](value)) if out is None else out.when(alone, makers[kind](value))
    return out.otherwise(value)


def pseudonymize(text: Column, key: str) -> Column:
    """``text`` with all values that validate replaced by their pseudonyms."""

    def join(parts: Column) -> Column:
        found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
        new = F.concat(F.transform(found, lambda v: pseudonym(key, v)), F.array(F.lit("")))
        return F.array_join(F.zip_with(parts, new, lambda p, n: F.concat(p, n)), "")

    replaced = let(F.split(text, ANY, -1), join)
    return F.when(text.rlike("[0-9@]|[0-9a-fA-F]{32}"), replaced).otherwise(text)
