"""Personal data: format-preserving Feistel pseudonyms for validated numbers, dates and mail addresses.

Each finding becomes a row of positions with a radix each (ten for a digit, 256 for an octet, 26 for a letter,
the two factors of the day range for a date). Rounds of a Feistel network add a keyed hash of one half to the
other half, position by position within its radix, so for one key, kind and shape the mapping is a permutation:
equal values get equal pseudonyms in every document, different ones stay different, and the shape stays.
Check digits are worked out anew, so a card number becomes a valid card number and a date a calendar date.

Found are card numbers (13 to 19 digits, Luhn), telephone numbers, social security numbers, IPv4 addresses,
dates (year-month-day, 1900-01-01 to 2100-01-31) and mail addresses, whose local part is permuted. What looks
alike but does not validate is left as it is. Only DataFrame functions are used and nothing is shuffled.

Defined results: a null text counts as empty and has no findings; repeated rows are treated alike; findings
never overlap, the leftmost comes first and of several that start together the kind listed first; whole
texts are searched; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioframe.llm.common import numbered_text

_LEFT, _RIGHT = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
# How each kind is written.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+",
    "date": _LEFT + r"[0-9]{4}-[0-9]{2}-[0-9]{2}" + _RIGHT,
    "ssn": _LEFT + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _RIGHT,
    "card": _LEFT + r"(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){2} [0-9]{1,7}|[0-9]{4}(?:-[0-9]{4}){2}-[0-9]{1,7})" + _RIGHT,
    "ip": r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9A-Za-z])",
    "phone": r"(?:(?<![0-9A-Za-z])\+[0-9]{1,3}[ .-]?)?(?<![0-9A-Za-z])(?:\([0-9]{2,4}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}" + _RIGHT,
}
KINDS = list(PATTERNS)
ROUNDS = 8
FIRST_DAY, DAY_FACTORS = "1900-01-01", (252, 290)
_ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _let(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, wherever and however often it stands in the result."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), 0)


def permute(values: Column, radices: Column, kind: str, key: str, rounds: int = ROUNDS) -> Column:
    """The values at their positions after the rounds; ``kind`` and the radices are part of the key."""
    given = F.struct(
        values.cast("array<bigint>").alias("values"),
        radices.alias("radices"),
        F.array_join(radices.cast("array<string>"), ",").alias("shape"),
        F.floor(F.size(values) / 2).cast("int").alias("half"),
    )

    def all_rounds(x: Column) -> Column:
        def one_round(acc: Column, t: Column) -> Column:
            even = t % 2 == 0
            right = F.slice(acc, x["half"] + 1, F.size(acc) - x["half"])
            other = F.array_join(F.when(even, right).otherwise(F.slice(acc, F.lit(1), x["half"])), ",")
            tweak = F.concat_ws("|", F.lit(key), F.lit(kind), x["shape"], t.cast("string"), other)

            def moved(c: Column, i: Column, tweaked: Column) -> Column:
                digest = F.sha2(F.concat_ws("|", tweaked, i.cast("string")), 256)
                shift = F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")
                turn = (i < x["half"]) == even
                return F.when(turn, ((c + shift) % F.get(x["radices"], i)).cast("long")).otherwise(c)

            return _let(tweak, lambda tweaked: F.transform(acc, lambda c, i: moved(c, i, tweaked)))

        return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), x["values"], one_round)

    return _let(given, all_rounds)


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _digits(text: Column) -> Column:
    return F.filter(_characters(text), lambda c: c.rlike("^[0-9]$")).cast("array<bigint>")


def _fill(stencil: Column, digits: Column) -> Column:
    """The stencil with its digits replaced in order."""
    return _let(digits, lambda worked_out: _filled(stencil, worked_out))


def _filled(stencil: Column, digits: Column) -> Column:
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def put(acc: Column, c: Column) -> Column:
        digit = c.rlike("^[0-9]$")
        out = F.concat(acc["out"], F.when(digit, F.get(digits, acc["at"]).cast("string")).otherwise(c))
        return F.struct(out.alias("out"), (acc["at"] + digit.cast("int")).alias("at"))

    return F.aggregate(_characters(stencil), start, lambda acc, c: put(acc, c), lambda acc: acc["out"])


def _luhn(digits: Column) -> Column:
    """Luhn sum of digits whose last one is doubled, the one before not, and so on."""
    n = F.size(digits)
    doubled = F.transform(digits, lambda d, i: F.when((n - i) % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    return F.aggregate(doubled, F.lit(0).cast("bigint"), lambda acc, d: acc + d)


def _tens(digits: Column) -> Column:
    return F.transform(digits, lambda d: F.lit(10).cast("bigint"))


def _card(value: Column, key: str) -> tuple[Column, Column]:
    digits = _digits(value)
    n = F.size(digits)
    body = F.slice(digits, F.lit(1), n - 1)
    valid = n.between(13, 19) & ((_luhn(body) + F.element_at(digits, -1)) % 10 == 0)
    made = _let(permute(body, _tens(body), "card", key), lambda m: F.array_append(m, (10 - _luhn(m) % 10) % 10))
    return valid, _fill(value, made)


def _phone(value: Column, key: str) -> tuple[Column, Column]:
    code = F.regexp_extract(value, r"^\+[0-9]{1,3}[ .-]?", 0)
    rest = F.substring(value, F.length(code) + 1, F.length(value))
    digits = _digits(rest)
    return F.lit(True), F.concat(code, _fill(rest, permute(digits, _tens(digits), "phone", key)))


def _ssn(value: Column, key: str) -> tuple[Column, Column]:
    parts = F.split(value, "-").cast("array<bigint>")
    area, group, serial = (F.get(parts, i) for i in range(3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = F.array(F.when(area > 666, area - 2).otherwise(area - 1), group - 1, serial - 1)
    made = permute(place, F.array(*[F.lit(x).cast("bigint") for x in (898, 99, 9999)]), "ssn", key)

    def written_out(m: Column) -> Column:
        new = F.get(m, 0) + 1
        parts = [F.when(new > 665, new + 1).otherwise(new), F.get(m, 1) + 1, F.get(m, 2) + 1]
        return F.concat_ws("-", *[F.lpad(p.cast("string"), n, "0") for p, n in zip(parts, (3, 2, 4))])

    return valid, _let(made, written_out)


def _ip(value: Column, key: str) -> tuple[Column, Column]:
    octets = F.split(value, r"\.").cast("array<bigint>")
    valid = F.forall(octets, lambda o: o < 256)
    made = permute(octets, F.transform(octets, lambda o: F.lit(256).cast("bigint")), "ip", key)
    return valid, F.array_join(made.cast("array<string>"), ".")


def _date(value: Column, key: str) -> tuple[Column, Column]:
    a, b = DAY_FACTORS
    day = F.datediff(F.to_date(F.try_to_timestamp(value, F.lit("yyyy-MM-dd"))), F.lit(FIRST_DAY).cast("date"))
    valid = F.coalesce(day.between(0, a * b - 1), F.lit(False))
    place = F.array(F.floor(day / b).cast("bigint"), (day % b).cast("bigint"))
    made = permute(place, F.array(F.lit(a).cast("bigint"), F.lit(b).cast("bigint")), "date", key)
    days = _let(made, lambda m: (F.get(m, 0) * b + F.get(m, 1)).cast("int"))
    return valid, F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), days), "yyyy-MM-dd")


def _email(value: Column, key: str) -> tuple[Column, Column]:
    local = F.substring_index(value, "@", 1)
    characters = _characters(local)
    alphabets = [("a", _LOWER), ("A", _UPPER), ("0", "0123456789")]

    def classes(c: Column, values: list[Column], otherwise: Column) -> Column:
        tests = ["^[a-z]$", "^[A-Z]$", "^[0-9]$"]
        out = F
        for test, v in zip(tests, values):
            out = out.when(c.rlike(test), v)
        return out.otherwise(otherwise)

    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    values = F.transform(characters, lambda c: classes(c, [(F.ascii(c) - ord(x[0])).cast("bigint") for _, x in alphabets], zero))
    radices = F.transform(characters, lambda c: classes(c, [F.lit(len(x)).cast("bigint") for _, x in alphabets], one))
    made = permute(values, radices, "email", key)
    new = F.zip_with(characters, made, lambda c, v: classes(c, [F.chr(v + ord(x[0])) for _, x in alphabets], c))
    return F.lit(True), F.concat(F.array_join(new, ""), F.substring(value, F.length(local) + 1, F.length(value)))


_MAKERS = {"email": _email, "date": _date, "ssn": _ssn, "card": _card, "ip": _ip, "phone": _phone}


def _finding(value: Column, key: str) -> Column:
    """kind, value and pseudonym of a match; the kind is null where it does not validate."""
    kind = F
    for name, pattern in PATTERNS.items():
        kind = kind.when(value.rlike(f"^(?:{pattern})$"), F.lit(name))

    def made(found: Column) -> Column:
        out = F
        for name, maker in _MAKERS.items():
            valid, new = maker(value, key)
            out = out.when((found == name) & valid, F.struct(found.alias("kind"), value.alias("value"), new.alias("pseudonym")))
        return out.otherwise(F.struct(F.lit(None).cast("string").alias("kind"), value.alias("value"), value.alias("pseudonym")))

    return _let(kind, made)


def pseudonymize(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, text with pseudonyms, and ``found``: kind, value and pseudonym of each finding, in order."""
    df = numbered_text(docs).withColumn("matches", F.regexp_extract_all("text", F.lit(_ANY), F.lit(0)))
    df = df.withColumn("made", F.when(F.size("matches") > 0, F.transform("matches", lambda m: _finding(m, key))))
    pieces = F.split("text", _ANY, -1)
    joined = F.zip_with(pieces, F.col("made.pseudonym"), lambda gap, new: F.concat(gap, F.coalesce(new, F.lit(""))))
    text = F.when(F.size("matches") > 0, F.array_join(joined, "")).otherwise(F.col("text"))
    found = F.coalesce(F.filter("made", lambda f: f["kind"].isNotNull()), F.array().cast("array<struct<kind:string,value:string,pseudonym:string>>"))
    return df.select("doc_id", text.alias("text"), found.alias("found"))
