"""Personal numbers and dates replaced by format-preserving Feistel pseudonyms.

Found are card numbers (Luhn digit right), North American phone numbers, social security
numbers, IPv4 addresses and dates (years 1900 to 2099; MM/dd/yyyy where dd/MM/yyyy is no date). A candidate is
checked, and replaced only if it is valid. A card is a whole run of 13 to 19 digits or, where digits stand before or
behind it, groups of three digits or more within a run. A valid value is a pair of numbers (left, right) below two radices; in each Feistel
round a keyed hash of one is added to the other, modulo its radix. So every kind's valid
values are permuted among themselves: a pseudonym has the form of its original and is valid
too, equal values have equal pseudonyms in all documents, and unequal ones unequal. Separators
stay, as do the first digit of a card and a ``+1``; a card's last digit is computed anew.

E-mail addresses aren't numbers; their local part becomes a keyed hash of the address, and
the domain a reserved one. Equal addresses (in lower case) stay equal.

Only built-in functions are used. A text is cut at the matches of one pattern, with its own cards in it, and put together again with
their pseudonyms, so that matches never meet each other's replacements. The pattern's runs
are possessive and begin where no run goes on, so long texts take linear time.

A null text stays null, with 0 values. An empty table gives no rows. Without the key pseudonyms can't be told.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Forms of the values that are looked for.
FORMS = {
    "email": r"(?<![\w.%+-])[\w.%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "phone": r"(?<![\w+-])(?:(?:\+1[ .-]?|1[ .-])?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}"
    r"|(?:\+1[ .-]?|1[.-])(?:\(\d{3}\) ?|\d{3}[ .-]?)\d{3}[ .-]?\d{4})(?![\w-])",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "ip": r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)",
    "isodate": r"(?<![\w/-])(?:19|20)\d{2}-\d{2}-\d{2}(?![\w-])",
    "date": r"(?<![\w/-])\d{2}/\d{2}/(?:19|20)\d{2}(?![\w/])",
    "card": r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])",
}
CARD = FORMS["card"]
OTHER = "|".join(form for kind, form in FORMS.items() if kind != "card")
#: At every group of digits, what a card that begins there could be read from.
GROUPS = r"(?:(?<![\w-])|(?<=\d-))(?=(\d(?:[ -]?\d){12,18})(?!\w|-(?!\d)))"
READINGS = (16, 15, 14, 13, 19, 18, 17)  #: digits, in the order of trial
DAYS = (17, 4297)  #: the 73,049 days from 1900 to 2099


def _ten(power: Column) -> Column:
    return F.element_at(F.array(*(F.lit(10**k) for k in range(19))), power.cast("int") + 1)


def _drawn(key: str, kind: Column, turn: Column, half: Column) -> Column:
    """A number of 60 bits from the key, the kind, the round and one half."""
    text = F.concat_ws(":", F.lit(key), kind, turn, half)
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("bigint")


def feistel(left: Column, right: Column, low: Column, high: Column, kind: Column, key: str) -> Column:
    """Struct (left, right) permuted within left < low and right < high."""
    start = F.struct(left.cast("bigint").alias("left"), right.cast("bigint").alias("right"))

    def turn(at: Column, i: Column) -> Column:
        moved_left = (at["left"] + _drawn(key, kind, i, at["right"]) % low) % low
        moved_right = (at["right"] + _drawn(key, kind, i, at["left"]) % high) % high
        return F.when(
            i % 2 == 1, F.struct(moved_left.cast("bigint").alias("left"), at["right"].alias("right"))
        ).otherwise(F.struct(at["left"].alias("left"), moved_right.cast("bigint").alias("right")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def _let(value: Column, body) -> Column:
    """``body(value)``, with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _luhn(payload: Column) -> Column:
    """Check digit of a number given without it."""
    digits = F.split(F.reverse(payload), "")
    total = F.aggregate(
        F.transform(
            digits,
            lambda d, i: F.when(
                i % 2 == 0, (d.cast("int") * 2) % 10 + F.floor(d.cast("int") * 2 / 10).cast("int")
            ).otherwise(d.cast("int")),
        ),
        F.lit(0),
        lambda a, b: a + b,
    )
    return ((10 - total % 10) % 10).cast("string")


def _refilled(match: Column, digits: Column) -> Column:
    """``match`` with its digits replaced in order."""
    state = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    return F.aggregate(
        F.split(match, ""),
        state,
        lambda acc, c: F.when(
            c.between("0", "9"),
            F.struct(
                F.concat(acc["out"], F.substr(digits, acc["at"], F.lit(1))).alias("out"),
                (acc["at"] + 1).alias("at"),
            ),
        ).otherwise(F.struct(F.concat(acc["out"], c).alias("out"), acc["at"].alias("at"))),
        lambda acc: acc["out"],
    )


def _padded(value: Column, width: Column | int) -> Column:
    width = F.lit(width) if isinstance(width, int) else width
    return F.lpad(value.cast("string"), width, F.lit("0"))


def _number(digits: Column, start: int, size: int) -> Column:
    return F.substring(digits, start, size).cast("bigint")


def _card(match: Column, digits: Column, key: str) -> Column:
    size = F.length(digits)
    payload = F.substr(digits, F.lit(1), size - 1)
    low = F.floor((size - 2) / 2)
    high = size - 2 - low
    moved = feistel(
        F.substr(digits, F.lit(2), low).cast("bigint"),
        F.substr(digits, low + 2, high).cast("bigint"),
        _ten(low), _ten(high), F.concat(F.lit("card"), size), key,
    )
    new = _let(
        moved,
        lambda m: F.concat(
            F.substring(digits, 1, 1), _padded(m["left"], low.cast("int")), _padded(m["right"], high.cast("int"))
        ),
    )
    valid = _luhn(payload) == F.substr(digits, size, F.lit(1))
    return F.when(valid, _let(new, lambda n: _refilled(match, F.concat(n, _luhn(n)))))


def _phone(match: Column, digits: Column, key: str) -> Column:
    lead = F.when(F.length(digits) > 10, "1").otherwise("")
    ten = F.substr(digits, F.length(lead) + 1, F.lit(10))
    moved = feistel(
        _number(ten, 1, 3), _number(ten, 4, 7), F.lit(1000), F.lit(10_000_000), F.lit("phone"), key
    )
    new = _let(moved, lambda m: F.concat(lead, _padded(m["left"], 3), _padded(m["right"], 7)))
    return _refilled(match, new)


def _ssn(match: Column, digits: Column, key: str) -> Column:
    area, group, serial = _number(digits, 1, 3), _number(digits, 4, 2), _number(digits, 6, 4)
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = area - 1 - F.when(area > 666, 1).otherwise(0)
    moved = feistel(
        place, (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), F.lit("ssn"), key
    )
    new = _let(
        moved,
        lambda m: F.concat(
            _padded(m["left"] + 1 + F.when(m["left"] >= 665, 1).otherwise(0), 3),
            _padded(F.floor(m["right"] / 9999) + 1, 2),
            _padded(m["right"] % 9999 + 1, 4),
        ),
    )
    return F.when(valid, _refilled(match, new))


def _ip(match: Column, key: str) -> Column:
    parts = F.transform(F.split(match, r"\."), lambda p: p.cast("bigint"))
    octet = lambda i: F.element_at(parts, i)
    moved = feistel(
        octet(1) * 256 + octet(2), octet(3) * 256 + octet(4), F.lit(65536), F.lit(65536), F.lit("ip"), key
    )
    new = _let(
        moved,
        lambda m: F.concat_ws(
            ".", F.floor(m["left"] / 256), m["left"] % 256, F.floor(m["right"] / 256), m["right"] % 256
        ),
    )
    return F.when(F.array_max(parts) <= 255, new)


def _date(match: Column, form: str, key: str) -> Column:
    day = F.datediff(F.try_to_date(match, form), F.lit("1900-01-01").cast("date"))
    moved = feistel(F.floor(day / DAYS[1]), day % DAYS[1], F.lit(DAYS[0]), F.lit(DAYS[1]), F.lit("date"), key)
    days = _let(moved, lambda m: m["left"] * DAYS[1] + m["right"])
    return F.when(day.isNotNull(), F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), days.cast("int")), form))


def _month_first(match: Column, key: str) -> Column:
    """Pseudonym of MM/dd/yyyy with a day over 12, which is permuted again until its day is over 12 as well."""
    form = "MM/dd/yyyy"
    late = lambda text: F.substring(text, 4, 2) > "12"
    moved = F.aggregate(
        F.sequence(F.lit(1), F.lit(64)),
        match,
        lambda at, i: F.when((i > 1) & late(at), at).otherwise(_date(at, form, key)),
    )
    return F.when(late(match) & F.try_to_date(match, form).isNotNull(), moved)


def _email(match: Column, key: str) -> Column:
    digest = F.sha2(F.concat_ws(":", F.lit(key), F.lit("email"), F.lower(match)), 256)
    return F.concat(F.lit("user-"), F.substring(digest, 1, 16), F.lit("@example.invalid"))


def kind_of(match: Column) -> Column:
    kind = F.lit("card")
    for name in ("date", "isodate", "ip", "ssn", "phone", "email"):
        kind = F.when(match.rlike(f"^(?:{FORMS[name]})$"), name).otherwise(kind)
    return kind


def pseudonym(match: Column, kind: Column, key: str) -> Column:
    """Pseudonym of a match; null if it isn't a valid value."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    return (
        F.when(kind == "email", _email(match, key))
        .when(kind == "phone", _phone(match, digits, key))
        .when(kind == "ssn", _ssn(match, digits, key))
        .when(kind == "ip", _ip(match, key))
        .when(kind == "isodate", _date(match, "yyyy-MM-dd", key))
        .when(kind == "date", F.coalesce(_date(match, "dd/MM/yyyy", key), _month_first(match, key)))
        .otherwise(_card(match, digits, key))
    )


def _is_card(reading: Column) -> Column:
    digits = F.regexp_replace(reading, "[^0-9]", "")
    size = F.length(digits)
    payload = F.substr(digits, F.lit(1), size - 1)
    return (size > 0) & (_luhn(payload) == F.substr(digits, size, F.lit(1)))


def cards(text: Column) -> Column:
    """Distinct cards of a text as they are written: whole runs of digits first, then readings within runs.

    A reading within a run begins and ends with a group of digits, and its groups have three digits or more.
    """
    whole = F.regexp_extract_all(text, F.lit(f"({CARD})"), F.lit(1))
    starts = F.array_distinct(F.regexp_extract_all(text, F.lit(GROUPS), F.lit(1)))
    within = F.flatten(
        F.transform(
            F.array(*(F.lit(rf"^(\d(?:[ -]?\d){{{n - 1}}})(?=[ -]|$)") for n in READINGS)),
            lambda form: F.transform(starts, lambda c: F.array_join(F.regexp_extract_all(c, form, F.lit(1)), "")),
        )
    )
    grouped = F.filter(within, lambda r: (r != "") & ~r.rlike(r"(?:^|[ -])\d{1,2}(?:[ -]|$)"))
    return F.filter(F.array_distinct(F.concat(whole, grouped)), _is_card)


def pseudonymised(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with its text rewritten, and ``pii``: an array of (kind, pseudonym) in their order.

    A column ``pii`` that is there is replaced.
    """
    some = F.col(text).rlike("[0-9@]")  # cheap tests that nearly all texts fail
    long = F.col(text).rlike(r"\d(?:[ -]?\d){12}")
    marked = docs.drop("pii").withColumn("__cards", F.when(some & long, cards(F.col(text))))
    # the cards of a text are looked for as they are, so that runs of digits hide no other value
    own = F.concat(F.lit(rf"{OTHER}|(?<!\w)(?:"), F.array_join("__cards", "|"), F.lit(r")(?!\w)"))
    marked = marked.withColumn("__any", F.when(F.size("__cards") > 0, own).otherwise(OTHER))
    matches = F.transform(
        F.regexp_extract_all(text, F.concat(F.lit("("), "__any", F.lit(")")), F.lit(1)),
        lambda m: F.struct(m.alias("old"), kind_of(m).alias("kind")),
    )
    found = F.transform(
        matches, lambda m: F.struct(m["old"], m["kind"], pseudonym(m["old"], m["kind"], key).alias("new"))
    )
    marked = marked.withColumn("__found", F.when(some, found))
    pieces = F.split(text, F.concat(F.lit("(?:"), "__any", F.lit(")")), -1)
    filled = F.zip_with(
        pieces, "__found", lambda p, m: F.concat(p, F.coalesce(m["new"], m["old"], F.lit("")))
    )
    return (
        marked.withColumn(
            text, F.when(F.size("__found") > 0, F.array_join(filled, "")).otherwise(F.col(text))
        )
        .withColumn(
            "pii",
            F.transform(
                F.filter(F.coalesce("__found", F.array()), lambda m: m["new"].isNotNull()),
                lambda m: F.struct(m["kind"], m["new"].alias("pseudonym")),
            ),
        )
        .drop("__found", "__cards", "__any")
    )
