"""Format-preserving pseudonyms for personal data, by a keyed Feistel network over the digits and letters of a value.

Values are found by pattern and validated; each is permuted within its own format, so the pseudonym of a valid card
number is a valid card number, of a date a date, of an address an address of the same shape. The permutation depends
on the key, the kind and the format alone: equal values get equal pseudonyms wherever they occur, and the holder of the
key can restore them. DataFrame functions only; no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import let

ROUNDS = 8
#: Dates are permuted within 270 times 270 days from this one: 1900-01-01 to 2099-08-05.
FIRST_DAY, SIDE = "1900-01-01", 270

OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
HEX4 = "[0-9A-Fa-f]{1,4}"
#: Calling codes as E.164 deals them out.
COUNTRY = r"\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9]\d\d)"
#: Countries by the length of their IBANs.
IBANS = {
    15: "NO", 16: "BE", 18: "DK|FO|FI|GL|NL", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|XK", 21: "CH|HR|LI|LV", 22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA",
    23: "AE|GI|IL|IQ|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "LY|PT", 26: "IS|TR", 27: "FR|GR|IT|MC|MR|SM",
    28: "AL|AZ|BY|CY|DO|GT|HU|LB|PL|SV", 29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU", 31: "MT|SC",
}


def _account(n: int) -> str:
    """Pattern of an IBAN after its country: check digits and ``n`` signs, in groups of four or in none."""
    rest = f" [A-Z0-9]{{{n % 4}}}" if n % 4 else ""
    return rf"\d\d(?:[A-Z0-9]{{{n}}}|(?: [A-Z0-9]{{4}}){{{n // 4}}}{rest})"


#: Patterns by kind, in the order in which they are tried at a place.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "secret": r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![A-Za-z0-9])",
    "iban": rf"(?<![A-Za-z0-9])(?:{'|'.join(f'(?:{c}){_account(n - 4)}' for n, c in IBANS.items())})(?![A-Za-z0-9])",
    "ipv6": rf"(?<![\w:.])(?:(?:{HEX4}:){{7}}{HEX4}|{HEX4}(?::{HEX4}){{0,5}}::(?:{HEX4}(?::{HEX4}){{0,5}})?|::{HEX4}(?::{HEX4}){{0,6}})(?![\w:]|\.\d)",
    "ipv4": rf"(?<![\w.]){OCTET}\.{OCTET}\.{OCTET}\.{OCTET}(?!\.?\w)",
    "date": r"(?<![\w./-])(?:(?:19|20)\d\d-\d\d-\d\d|\d\d/\d\d/(?:19|20)\d\d|\d\d\.\d\d\.(?:19|20)\d\d)(?:(?=T\d\d)|(?![./-]?\w))",
    "ssn": r"(?<![\w.-])\d{3}-\d\d-\d{4}(?![.-]?\w)",
    "phone": r"(?:(?<![\w+(])(?:\+1[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[.-])\d{3}[ .-]\d{4}(?!\w)"
    rf"|(?<![\w+])(?=\+(?:[ .()-]{{0,3}}\d){{8}}){COUNTRY}(?:\d{{4,14}}|[ .-]?(?:\(\d{{1,5}}\)|\d{{1,8}})(?:[ .-]{{1,2}}\d{{1,8}}){{1,5}})(?!\w)"
    r"|(?<![\w+])(?<!\d )\d{3} \d{3} \d{4}(?! ?\w?\d))",
    "card": r"(?<!\w)(?<!\d[.-])(?:\d{13,19}|\d{4}(?: \d{4}){3}|\d{4}(?:-\d{4}){3}|\d{4}(?:\.\d{4}){3}|\d{4} \d{6} \d{5}|\d{4}-\d{6}-\d{5}|\d{4}\.\d{6}\.\d{5})(?!\w)",
}
ANY = "|".join(PATTERNS.values())
#: Spellings of dates: pattern of the match, and the format that reads and writes it.
DATE_FORMATS = ((r"^\d{4}-", "yyyy-MM-dd"), (r"^\d\d/", "MM/dd/yyyy"), (r"^\d\d\.", "dd.MM.yyyy"))


def permute(values: Column, radixes: Column, secret: str, tweak: Column, inverse: bool = False) -> Column:
    """``values``, each below its radix, permuted among all such arrays; ``inverse`` undoes it.

    An alternating Feistel network: in turn, each half is shifted, place by place modulo its radix, by digits of a keyed
    hash of the other half. Any radixes do, a radix of 1 keeps its place.
    """
    sign = -1 if inverse else 1

    def halves(v: Column, r: Column) -> Column:
        middle = F.floor(F.size(v) / 2).cast("int")
        left = lambda a: F.slice(a, F.lit(1), middle)
        right = lambda a: F.slice(a, middle + 1, F.size(a) - middle)
        return F.struct(left(v).alias("a"), left(r).alias("ra"), right(v).alias("b"), right(r).alias("rb"))

    def turn(state: Column, number: Column) -> Column:
        # Odd rounds shift the right half, even ones the left; an inverse runs them backwards.
        number = (ROUNDS + 1 - number) if inverse else number
        odd = number % 2 == 1
        pick = lambda x, y: F.when(odd, state[x]).otherwise(state[y])
        digest = F.sha2(F.concat_ws("|", F.lit(secret), tweak, number.cast("string"), F.array_join(pick("a", "b").cast("array<string>"), ",")), 512)
        # 16 bits of the digest for each place; a half longer than 32 places uses them again.
        shift = lambda d, i: F.conv(F.substring(d, 4 * (i % 32) + 1, F.lit(4)), 16, 10).cast("int")
        moved = let(digest, lambda d: F.transform(pick("b", "a"), lambda v, i: F.pmod(v + sign * shift(d, i), F.get(pick("rb", "ra"), i))))
        return let(
            moved,
            lambda m: F.struct(
                F.when(odd, state["a"]).otherwise(m).alias("a"), state["ra"].alias("ra"),
                F.when(odd, m).otherwise(state["b"]).alias("b"), state["rb"].alias("rb"),
            ),
        )

    start = let(F.struct(values.alias("v"), radixes.alias("r")), lambda x: halves(x["v"], x["r"]))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda s: F.concat(s["a"], s["b"]))


def permute_text(text: Column, free: Column, secret: str, kind: str, inverse: bool, letters: int = 26) -> Column:
    """``text`` with digits permuted among digits and letters among letters of the same case, where ``free``, an array of
    booleans by place, allows it. ``letters`` says how many letters from a on are in use."""
    base = lambda c: F.when(c.between("0", "9"), ord("0")).when(c.between("a", "z"), ord("a")).otherwise(ord("A"))
    radix = lambda c: F.when(c.between("0", "9"), 10).when(c.between("a", "z") | c.between("A", "Z"), letters).otherwise(1)
    place = lambda c, f: F.struct(c.alias("c"), F.when(f, radix(c)).otherwise(1).alias("r"))
    value = lambda x: F.when(x["r"] > 1, F.ascii(x["c"]) - base(x["c"])).otherwise(0)
    back = lambda x, v: F.when(x["r"] > 1, F.char(base(x["c"]) + v)).otherwise(x["c"])

    def moved(shape: Column) -> Column:
        tweak = F.concat(F.lit(kind + ":"), F.array_join(shape["r"].cast("array<string>"), ","))
        values = permute(F.transform(shape, value), shape["r"], secret, tweak, inverse)
        return F.array_join(F.zip_with(shape, values, back), "")

    chars = F.filter(F.split(text, ""), lambda c: c != "")
    return let(F.zip_with(chars, free, place), moved)


def places(text: Column, where) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(text)), where)


def luhn(digits: Column) -> Column:
    """Luhn sum of a string of digits."""
    backwards = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "").cast("array<int>")
    parts = F.transform(backwards, lambda x, i: F.when(i % 2 == 0, x).when(x > 4, 2 * x - 9).otherwise(2 * x))
    return F.aggregate(parts, F.lit(0), lambda a, x: a + x)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _card(value: Column, secret: str, inverse: bool) -> Column:
    moved = permute_text(value, places(value, lambda i: i < F.length(value)), secret, "card", inverse)
    check = lambda body: (10 - luhn(F.concat(digits_of(body), F.lit("0"))) % 10) % 10
    return let(F.substring(moved, F.lit(1), F.length(value) - 1), lambda body: F.concat(body, check(body).cast("string")))


def _phone(value: Column, secret: str, inverse: bool) -> Column:
    """All digits but the country's."""
    own = F.length(F.regexp_extract(value, "^" + COUNTRY, 0))
    return permute_text(value, places(value, lambda i: i > own), secret, "phone", inverse)


def _email(value: Column, secret: str, inverse: bool) -> Column:
    """The name before the at sign; the domain stays."""
    name = F.substring_index(value, "@", 1)
    return F.concat(permute_text(name, places(name, lambda i: F.lit(True)), secret, "email", inverse), F.lit("@"), F.substring_index(value, "@", -1))


def _secret(value: Column, secret: str, inverse: bool) -> Column:
    return permute_text(value, places(value, lambda i: F.lit(True)), secret, "secret", inverse, letters=6)


def _ipv4(value: Column, secret: str, inverse: bool) -> Column:
    octets = F.split(value, r"\.").cast("array<int>")
    return F.array_join(permute(octets, F.array_repeat(F.lit(256), 4), secret, F.lit("ipv4"), inverse).cast("array<string>"), ".")


def _ipv6(value: Column, secret: str, inverse: bool) -> Column:
    """Digits among digits and letters among letters, so that groups keep their lengths."""
    return permute_text(value, places(value, lambda i: F.lit(True)), secret, "ipv6", inverse, letters=6)


def _ssn(value: Column, secret: str, inverse: bool) -> Column:
    return permute_text(value, places(value, lambda i: F.lit(True)), secret, "ssn", inverse)


def iban_check(value: Column) -> Column:
    """The two check digits that an IBAN with these country and account has."""
    plain = F.regexp_replace(value, " ", "")
    chars = F.filter(F.split(F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 2), F.lit("00")), ""), lambda c: c != "")
    step = lambda a, c: F.when(c.between("0", "9"), (a * 10 + F.ascii(c) - ord("0")) % 97).otherwise((a * 100 + F.ascii(c) - ord("A") + 10) % 97)
    return F.lpad((98 - F.aggregate(chars, F.lit(0), step)).cast("string"), 2, "0")


def _iban(value: Column, secret: str, inverse: bool) -> Column:
    """The account; the country stays and the check digits follow."""
    country = F.substring(value, 1, 2)
    moved = permute_text(value, places(value, lambda i: i > 4), secret, "iban", inverse)
    return let(moved, lambda m: F.concat(country, iban_check(m), F.substring(m, F.lit(5), F.length(m))))


def _day(value: Column) -> Column:
    """Days from the first one; null for what the calendar does not know."""
    dates = [F.when(value.rlike(shape), F.try_to_timestamp(value, F.lit(form))) for shape, form in DATE_FORMATS]
    return F.date_diff(F.coalesce(*dates).cast("date"), F.lit(FIRST_DAY).cast("date"))


def _date(value: Column, secret: str, inverse: bool) -> Column:
    def written(moved: Column) -> Column:
        date = F.date_add(F.lit(FIRST_DAY).cast("date"), F.get(moved, F.lit(0)) * SIDE + F.get(moved, F.lit(1)))
        out = F.lit(None).cast("string")
        for shape, form in DATE_FORMATS:
            out = F.when(value.rlike(shape), F.date_format(date, form)).otherwise(out)
        return out

    values = let(_day(value), lambda day: F.array(F.floor(day / SIDE).cast("int"), day % SIDE))
    return let(permute(values, F.array(F.lit(SIDE), F.lit(SIDE)), secret, F.lit("date"), inverse), written)


def kind_of(value: Column) -> Column:
    """Kind of a match, null if it is not valid: a card number and an IBAN need their check digits, an IPv6 address a digit, a date its day in the calendar and
    within the permuted days, a secret both letters and digits."""
    whole = lambda kind: value.rlike("^(?:" + PATTERNS[kind] + ")$")
    valid = {
        "secret": value.rlike("[0-9]") & value.rlike("[A-Fa-f]"),
        "iban": F.substring(value, 3, 2) == iban_check(value),
        "ipv6": value.rlike("[0-9]"),
        "card": luhn(digits_of(value)) % 10 == 0,
        "date": _day(value).between(0, SIDE * SIDE - 1),
    }
    out = F.lit(None).cast("string")
    for kind in reversed(PATTERNS):
        out = F.when(whole(kind), F.when(valid[kind], kind) if kind in valid else F.lit(kind)).otherwise(out)
    return out


CHANGES = {"email": _email, "secret": _secret, "iban": _iban, "ipv6": _ipv6, "ipv4": _ipv4, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}


def pseudonym(value: Column, kind: Column, secret: str, inverse: bool = False) -> Column:
    out = value
    for name, change in CHANGES.items():
        out = F.when(kind == name, change(value, secret, inverse)).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, secret: str, text: str = "text", inverse: bool = False) -> DataFrame:
    """Adds ``pii`` to ``docs``, an array of ``(kind, value, pseudonym)`` in order of text, and puts the pseudonyms into
    ``text``; with ``inverse`` the values are those of pseudonymised text, and what is put back are the originals.

    Matches that are not valid stay as they are and are not listed. A null text stays null with an empty list; an empty one
    stays empty. Texts are read whole. A column ``pii`` of ``docs`` is replaced; all others, and the rows, are kept.
    """
    # Every kind has a digit or an at sign; texts with neither, as most are, skip the long pattern.
    matches = F.when(F.col(text).rlike("[0-9@]"), F.regexp_extract_all(F.col(text), F.lit(ANY), F.lit(0)))
    found = docs.withColumn("pii", F.coalesce(matches, F.array().cast("array<string>")))
    known = F.transform("pii", lambda v: F.struct(kind_of(v).alias("kind"), v.alias("value")))
    # Most texts hold nothing; for them neither the pattern runs again nor anything else.
    changed = F.transform(
        known,
        lambda p: F.struct(p["kind"].alias("kind"), p["value"].alias("value"), F.coalesce(pseudonym(p["value"], p["kind"], secret, inverse), p["value"]).alias("pseudonym")),
    )
    empty = F.array().cast("array<struct<kind:string,value:string,pseudonym:string>>")
    found = found.withColumn("pii", F.when(F.size("pii") > 0, changed).otherwise(empty))
    pieces = F.split(F.col(text), ANY, -1)
    joined = F.array_join(F.transform(pieces, lambda p, i: F.concat(p, F.coalesce(F.get(F.col("pii.pseudonym"), i), F.lit("")))), "")
    found = found.withColumn(text, F.when(F.size("pii") > 0, joined).otherwise(F.col(text)))
    return found.withColumn("pii", F.filter("pii", lambda p: p["kind"].isNotNull()))
