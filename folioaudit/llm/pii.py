"""Format-preserving Feistel pseudonyms for personal data (operator 9).

Values are found by pattern and validated: check digits, octet and calendar
ranges. A keyed Feistel network permutes each within its format: digits stay
digits, letters stay letters, separators and length stay, check digits are made
to fit, dates stay dates. The same value always gets the same pseudonym, in
every document, and different values of one written form get different ones.
An address's octets may change their number of digits.

DataFrame functions only; every document is worked on in its own row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
KINDS = ("email", "iban", "ip", "date", "ssn", "phone", "card")

# Lengths are those of RFC 5321: 64 characters before the sign, labels of 63, 127
# labels. Bounded and possessive: a pattern that may go back without a bound
# takes quadratic time on a long run, or the stack of the thread.
EMAIL = "(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}+(?:\\.[A-Za-z0-9-]{1,63}+){0,125}\\.[A-Za-z]{2,63}"
IBAN = "(?<![A-Za-z0-9])[A-Z]{2}\\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
IP = "(?<![\\w.])\\d{1,3}(?:\\.\\d{1,3}){3}(?!\\.?\\w)"
DATE = "(?<![\\w/-])(?:\\d{4}-\\d{2}-\\d{2}|\\d{1,2}/\\d{1,2}/\\d{4})(?![\\w/-])"
SSN = "(?<![\\w-])\\d{3}-\\d{2}-\\d{4}(?![\\w-])"
# With a country code or an area code in brackets, or in groups of 3, 3 and 4.
PHONE = (
    "(?<![\\w+])(?:\\+\\d{1,3}[ .-]?(?:\\(\\d{1,4}\\)[ .-]?)?\\d{2,4}(?:[ .-]?\\d{2,4}){1,4}|"
    "\\(\\d{3}\\) ?\\d{3}[ .-]\\d{4}|\\d{3}[ .-]\\d{3}[ .-]\\d{4})(?!\\w)"
)
CARD = "(?<![\\w+-])\\d(?:[ -]?\\d){12,18}(?![\\w-])"
PATTERNS = {"email": EMAIL, "iban": IBAN, "ip": IP, "date": DATE, "ssn": SSN, "phone": PHONE, "card": CARD}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())

# The Gregorian calendar repeats after this many days: 189 times 773.
CYCLE_FIRST, CYCLE_DAYS, CYCLE_A, CYCLE_B = "1800-01-01", 146_097, 189, 773


def _round_number(key: str, tweak: Column, round_: Column, half: Column, modulus: int) -> Column:
    digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, round_.cast("string"), half.cast("string")), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), F.lit(modulus))


def feistel_number(value: Column, a: int, b: int, key: str, tweak: Column) -> Column:
    """A keyed permutation of the numbers below ``a * b``."""

    def step(s: Column, k: Column) -> Column:
        low = F.pmod(s["low"] + _round_number(key, tweak, k, s["high"], b), F.lit(b))
        high = F.pmod(s["high"] + _round_number(key, tweak, k, s["low"], a), F.lit(a))
        even = k % 2 == 0
        return F.struct(F.when(even, s["high"]).otherwise(high).alias("high"), F.when(even, low).otherwise(s["low"]).alias("low"))

    start = F.struct(F.floor(value / b).cast("bigint").alias("high"), F.pmod(value, F.lit(b)).cast("bigint").alias("low"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: s["high"] * b + s["low"])


def _shift(text: Column, digest: Column) -> Column:
    """Move letters and digits along their alphabet, by one digest byte each."""

    def moved(char: Column, at: Column) -> Column:
        code = F.ascii(char)
        byte = F.conv(F.substr(digest, (at % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        turned = lambda first, size: F.char(F.lit(first) + (code - first + byte) % size)
        return (
            F.when(code.between(48, 57), turned(48, 10))
            .when(code.between(97, 122), turned(97, 26))
            .when(code.between(65, 90), turned(65, 26))
            .otherwise(char)
        )

    return F.when(text == "", text).otherwise(F.array_join(F.transform(F.split(text, ""), moved), ""))


def feistel_text(text: Column, key: str, tweak: Column) -> Column:
    """A keyed permutation of the texts of one format.

    The halves take turns: one moves its letters and digits along their
    alphabets by a keyed digest of the other, so every round can be undone.
    """
    half = F.floor(F.length(text) / 2).cast("int")

    def step(s: Column, k: Column) -> Column:
        even = k % 2 == 0
        fixed = F.when(even, s["left"]).otherwise(s["right"])
        digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, k.cast("string"), fixed), 256)
        changed = _shift(F.when(even, s["right"]).otherwise(s["left"]), digest)
        return F.struct(F.when(even, s["left"]).otherwise(changed).alias("left"), F.when(even, changed).otherwise(s["right"]).alias("right"))

    start = F.struct(F.substr(text, F.lit(1), half).alias("left"), F.substr(text, half + 1, F.length(text)).alias("right"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: F.concat(s["left"], s["right"]))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Sum of the digits from the right, every second one doubled, beginning at ``doubled``."""
    value = lambda d, k: F.when(k % 2 == doubled, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)
    listed = F.transform(F.split(F.reverse(digits), ""), lambda c, k: value(c.cast("int"), k))
    return F.aggregate(listed, F.lit(0), lambda n, d: n + d)


def _mod97(text: Column) -> Column:
    """Remainder of a text whose letters stand for 10 to 35."""
    code = lambda c: F.ascii(c)
    step = lambda n, c: F.when(code(c) < 65, (n * 10 + code(c) - 48) % 97).otherwise((n * 100 + code(c) - 55) % 97)
    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _filled(text: Column, digits: Column) -> Column:
    """``text`` with its digits replaced by ``digits``, in order."""

    def step(s: Column, c: Column) -> Column:
        digit = c.rlike("[0-9]")
        return F.struct(
            F.concat(s["out"], F.when(digit, F.substr(digits, s["at"], F.lit(1))).otherwise(c)).alias("out"),
            (s["at"] + F.when(digit, 1).otherwise(0)).alias("at"),
        )

    return F.aggregate(F.split(text, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), step, lambda s: s["out"])


def _whole(pattern: str) -> str:
    return f"^(?:{pattern})$"


def kind_of(hit: Column) -> Column:
    """The kind of a found value, NULL where validation fails."""
    digits = _digits(hit)
    octets = F.forall(F.split(hit, "\\."), lambda o: o.rlike("^(?:0|[1-9]\\d*)$") & (o.cast("int") <= 255))
    compact = F.regexp_replace(hit, " ", "")
    iban = _mod97(F.concat(F.substring(compact, 5, 40), F.substring(compact, 1, 4))) == 1
    real_ssn = hit.rlike("^(?!000|666|9)\\d{3}-(?!00)\\d{2}-(?!0000)\\d{4}$")
    # A card first: its groups may look like those of a telephone number.
    return (
        F.when(hit.rlike(_whole(EMAIL)), "email")
        .when(hit.rlike(_whole(IP)), F.when(octets, "ip"))
        .when(hit.rlike(_whole(DATE)), F.when(_date(hit).isNotNull(), "date"))
        .when(hit.rlike(_whole(SSN)), F.when(real_ssn, "ssn"))
        .when(hit.rlike(_whole(CARD)) & (_luhn_sum(digits, 1) % 10 == 0), "card")
        .when(hit.rlike(_whole(IBAN)) & (F.length(compact) >= 15) & iban, "iban")
        .when(hit.rlike(_whole(PHONE)) & F.length(digits).between(8, 15), "phone")
    )


def _date(hit: Column) -> Column:
    found = F.coalesce(F.try_to_date(hit, "yyyy-MM-dd"), F.try_to_date(hit, "M/d/yyyy"), F.try_to_date(hit, "d/M/yyyy"))
    first = F.lit(CYCLE_FIRST).cast("date")
    return F.when((found >= first) & (found < F.date_add(first, CYCLE_DAYS)), found)


WALK = 400  # steps; each leaves the form with a probability of 0.78 at most


def _new_date(hit: Column, key: str) -> Column:
    """Another date of the same written form.

    The form of a date with slashes is its order and its numbers of digits. The
    permutation of all dates is applied until a date has the form, which makes a
    permutation of the dates that have it. Day first is only read where the
    month can't stand first, so such days are greater than 12.
    """
    first = F.lit(CYCLE_FIRST).cast("date")
    permuted = lambda n: feistel_number(n, CYCLE_A, CYCLE_B, key, F.lit("date"))
    month_first = F.try_to_date(hit, "M/d/yyyy").isNotNull()
    parts = F.split(hit, "/")
    left, right = F.length(parts[0]), F.length(F.get(parts, F.lit(1)))
    month_size, day_size = F.when(month_first, left).otherwise(right), F.when(month_first, right).otherwise(left)

    def fits(n: Column) -> Column:
        day = F.date_add(first, n.cast("int"))
        short = ((month_size == 2) | (F.month(day) < 10)) & ((day_size == 2) | (F.dayofmonth(day) < 10))
        return hit.contains("-") | (short & (month_first | (F.dayofmonth(day) > 12)))

    def step(s: Column, _: Column) -> Column:
        return F.when(s["done"], s).otherwise(walked(permuted(s["n"])))

    def walked(n: Column) -> Column:
        # Bound by a list of one, so that it is worked out once.
        return F.transform(F.array(n), lambda x: F.struct(x.alias("n"), fits(x).alias("done")))[0]

    start = F.datediff(_date(hit), first).cast("bigint")
    n = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), F.struct(start.alias("n"), F.lit(False).alias("done")), step, lambda s: s["n"])
    sized = lambda value, size: F.when(size == 2, F.lpad(value.cast("string"), 2, "0")).otherwise(value.cast("string"))

    def written(day: Column) -> Column:
        month, of_month = sized(F.month(day), month_size), sized(F.dayofmonth(day), day_size)
        slashed = F.concat_ws("/", F.when(month_first, month).otherwise(of_month), F.when(month_first, of_month).otherwise(month), F.date_format(day, "yyyy"))
        return F.when(hit.contains("-"), F.date_format(day, "yyyy-MM-dd")).otherwise(slashed)

    return written(F.date_add(first, n.cast("int")))


def _new_ip(hit: Column, key: str) -> Column:
    number = F.aggregate(F.split(hit, "\\."), F.lit(0).cast("bigint"), lambda n, o: n * 256 + o.cast("bigint"))
    new = feistel_number(number, 65_536, 65_536, key, F.lit("ip"))
    octet = lambda shift: (F.shiftright(new, shift) % 256).cast("string")
    return F.concat_ws(".", octet(24), octet(16), octet(8), octet(0))


def _new_card(hit: Column, key: str) -> Column:
    digits = _digits(hit)
    payload = feistel_text(F.substr(digits, F.lit(1), F.length(digits) - 1), key, F.lit("card"))
    check = F.pmod(-_luhn_sum(payload, 0), F.lit(10)).cast("string")
    return _filled(hit, F.concat(payload, check))


def _new_iban(hit: Column, key: str) -> Column:
    compact = F.regexp_replace(hit, " ", "")
    country, account = F.substring(compact, 1, 2), feistel_text(F.substring(compact, 5, 40), key, F.lit("iban"))
    check = F.lpad((98 - _mod97(F.concat(account, country, F.lit("00")))).cast("string"), 2, "0")
    plain = F.concat(country, check, account)
    spaced = F.aggregate(
        F.split(hit, ""),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda s, c: F.struct(
            F.concat(s["out"], F.when(c == " ", c).otherwise(F.substr(plain, s["at"], F.lit(1)))).alias("out"),
            (s["at"] + F.when(c == " ", 0).otherwise(1)).alias("at"),
        ),
        lambda s: s["out"],
    )
    return spaced


def _new_ssn(hit: Column, key: str) -> Column:
    """Valid areas 1 to 899 but 666, groups 1 to 99, serials 1 to 9999, as one number."""
    area, group, serial = (F.split(hit, "-")[k].cast("bigint") for k in range(3))
    place = area - 1 - F.when(area > 666, 1).otherwise(0)
    number = (place * 99 + group - 1) * 9999 + serial - 1
    new = feistel_number(number, 898, 99 * 9999, key, F.lit("ssn"))
    new_place = F.floor(new / (99 * 9999))
    new_area = new_place + 1 + F.when(new_place + 1 >= 666, 1).otherwise(0)
    two = lambda value, width: F.lpad(value.cast("string"), width, "0")
    return F.concat_ws("-", two(new_area, 3), two(F.floor(new / 9999) % 99 + 1, 2), two(new % 9999 + 1, 4))


def _new_email(hit: Column, key: str) -> Column:
    """The part before the sign is permuted; the domain says nothing of the person."""
    at = F.instr(hit, "@")
    domain = F.substr(hit, at, F.length(hit))
    return F.concat(feistel_text(F.substr(hit, F.lit(1), at - 1), key, F.lower(domain)), domain)


def _new_phone(hit: Column, key: str) -> Column:
    """The first digit stays, so that a country code keeps its zone."""
    digits = _digits(hit)
    changed = feistel_text(F.substr(digits, F.lit(2), F.length(digits)), key, F.lit("phone"))
    return _filled(hit, F.concat(F.substr(digits, F.lit(1), F.lit(1)), changed))


def pseudonym(kind: Column, hit: Column, key: str) -> Column:
    """What replaces a value; the value itself where it has no kind."""
    makers = {"email": _new_email, "iban": _new_iban, "ip": _new_ip, "date": _new_date, "ssn": _new_ssn, "phone": _new_phone, "card": _new_card}
    chain = F
    for name, make in makers.items():
        chain = chain.when(kind == name, make(hit, key))
    return chain.otherwise(hit)


def pseudonymised(docs: DataFrame, key: str, *keep: str) -> DataFrame:
    """``keep`` columns, ``text`` with pseudonyms, and ``n_<kind>`` replaced values per row.

    ``key`` is the secret; another key gives other pseudonyms. A NULL text
    stays NULL with zero counts; values that fail validation are left as they
    are. Whole texts are worked on, row by row: repeated rows agree, extra
    columns that are not kept play no part, an empty table gives no rows.
    """
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), F.col("text").cast("string").alias("_text"))
    text = F.col("_text")
    may = text.rlike("@|\\d[ .)/-]?\\d")
    out = out.select("*", F.when(may, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).alias("_hits"))
    out = out.select("*", F.transform("_hits", lambda h: F.struct(kind_of(h).alias("kind"), h.alias("hit"))).alias("_found")).drop("_hits")
    some = F.size("_found") > 0
    new = F.transform("_found", lambda f: pseudonym(f["kind"], f["hit"], key))
    out = out.select("*", F.when(some, new).alias("_new"), F.when(some, F.split(text, ANY)).alias("_between"))
    # Piece by piece with what follows it; nothing follows the last.
    joined = F.array_join(F.zip_with("_between", "_new", lambda piece, new: F.concat(piece, F.coalesce(new, F.lit("")))), "")
    counted = lambda kind: F.size(F.filter("_found", lambda f: f["kind"] == kind))
    counts = [F.greatest(counted(kind), F.lit(0)).cast("long").alias(f"n_{kind}") for kind in KINDS]  # -1: no text
    rows = [F.col("_row").getField(c).alias(c) for c in keep]
    return out.select(*rows, F.when(some, joined).otherwise(text).alias("text"), *counts)
