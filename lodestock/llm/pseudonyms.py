"""Format-preserving pseudonyms of personal numbers and dates.

A validated value is permuted by a keyed Feistel network within its own format:
digits stay digits in their places, punctuation and letters stay, a card or
account number still passes its check digits, an address's parts stay 0 to 255,
a date stays a date.
The same value has the same pseudonym in every document, so links survive, and
the key holder can turn numbers, and dates that do not name the month first,
back.  A mail name becomes a keyed digest.  Everything is column expressions.

The network works on a number below a modulus a * b, as a pair of halves of
which one is added to by a keyed digest of the other; every round is a
bijection, and so is the whole.  Dates whose day or month has one digit move
among those of their widths: a place that is no day of the calendar is moved on,
at most ``WALKS`` times (one value in 10^8 needs more, and stays).

Defined results: a null or empty text stays as it is; values that fail their
validation (check digit, part range, calendar) stay; of overlapping values the
leftmost, and of two at one place the one earlier in ``KINDS``, is taken;
repeated documents come out alike; extra columns stay, but ``n_replaced`` is
replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .batches import without

ROUNDS = 4
COMPUTED = ["n_replaced", "_found", "_new"]

EDGE, END = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
# Card numbers in groups of 4-4-4-4 or 4-6-5, or in one run.
CARD = "(?:[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19})"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str


# What is written into a longer row of digits and marks is no date and no phone.
ALONE, NO_MORE = r"(?<![0-9A-Za-z+]|[0-9A-Za-z][/.-])", r"(?![0-9A-Za-z]|[/.-][0-9])"
# Account numbers in one run, or in groups of four and a last one of digits.
ACCOUNT = "[A-Z]{2}[0-9]{2}(?:[0-9A-Z]{11,30}|(?: [0-9A-Z]{4}){2,7}(?: [0-9]{1,3})?)"


# In order of precedence at one place.  Phone numbers need a country code, an
# area in brackets, or three groups of 3, 3 and 4 digits with one mark.
KINDS = (
    Kind("date", rf"{EDGE}[0-9]{{4}}[-/.][0-9]{{2}}[-/.][0-9]{{2}}{END}"),
    Kind("day_first", rf"{EDGE}[0-9]{{2}}[/.-][0-9]{{2}}[/.-][0-9]{{4}}{END}"),
    Kind("address", rf"(?<![0-9A-Za-z.])[0-9]{{1,3}}(?:\.[0-9]{{1,3}}){{3}}(?![0-9A-Za-z]|\.[0-9])"),
    Kind("phone", r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ -]?)?\([0-9]{2,4}\)[ -]?[0-9]{3,4}[ -][0-9]{3,4}(?![0-9A-Za-z])"),
    Kind("phone_plain", r"(?<![0-9A-Za-z+])\+[0-9]{1,3}(?:[ -][0-9]{2,4}){2,4}(?![0-9A-Za-z])"),
    Kind("phone_local", rf"{ALONE}(?:[0-9]{{3}}-[0-9]{{3}}-[0-9]{{4}}|[0-9]{{3}}\.[0-9]{{3}}\.[0-9]{{4}}){NO_MORE}"),
    Kind("short_date", rf"{ALONE}(?:[0-9][/.-][0-9]{{1,2}}|[0-9]{{2}}[/.-][0-9])[/.-][0-9]{{4}}{NO_MORE}"),
    Kind("account", rf"{EDGE}{ACCOUNT}{END}"),
    Kind("social", rf"{EDGE}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{END}"),
    Kind("card", rf"{EDGE}{CARD}{END}"),
    Kind("mail", r"(?<![0-9A-Za-z._%+-])[0-9A-Za-z._%+-]{1,64}@[0-9A-Za-z-]+(?:\.[0-9A-Za-z-]+)+"),
)
ANY = "|".join(f"(?:{k.pattern})" for k in KINDS)
# Cheap test before the patterns: a digit pair or an at-sign.
HINT = "[0-9][0-9]|[0-9]\\.[0-9]|@"
EPOCH, DAYS = "1900-01-01", 73_049  # 1900-01-01 up to 2099-12-31
FIRST_YEAR, YEARS, WALKS = 1900, 200, 5


def _bind(value: Column, use) -> Column:
    """``use`` of a value that is computed once: the one item of an array."""
    return F.get(F.transform(F.array(value), use), 0)


def _digest(key: str, label: Column, turn: int, half: Column) -> Column:
    """60 keyed pseudo-random bits for one half."""
    parts = F.concat(F.lit(f"{key}|"), label, F.lit(f"|{turn}|"), half.cast("string"), F.lit(f"|{key}"))
    return F.conv(F.substring(F.sha2(parts, 256), 1, 15), 16, 10).cast("long")


def _turned(state: Column, a: Column, b: Column, key: str, label: Column, back: bool, use) -> Column:
    """``use`` of a pair of halves below a and b after all rounds."""
    sign = F.lit(-1 if back else 1)

    def move_left(turn: int):
        return lambda s: F.struct(
            F.pmod(s["left"] + sign * (_digest(key, label, turn, s["right"]) % a), a).alias("left"), s["right"].alias("right")
        )

    def move_right(turn: int):
        return lambda s: F.struct(
            s["left"].alias("left"), F.pmod(s["right"] + sign * (_digest(key, label, turn, s["left"]) % b), b).alias("right")
        )

    moves = [move_right(t) if t % 2 else move_left(t) for t in range(ROUNDS)]
    for move in reversed(moves) if back else moves:
        state = _bind(state, move)
    return _bind(state, use)


def permute(value: Column, a: Column, b: Column, key: str, label: Column, back: bool = False) -> Column:
    """Keyed bijection of 0 .. a*b-1, for long columns."""
    state = F.struct(F.call_function("div", value, b).alias("left"), (value % b).alias("right"))
    return _turned(state, a, b, key, label, back, lambda s: s["left"] * b + s["right"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def permute_digits(digits: Column, key: str, label: str, back: bool = False) -> Column:
    """A digit text of 1 to 36 digits, as another one of its length."""
    power = lambda n: F.pow(F.lit(10.0), n).cast("long")
    number = lambda x: F.coalesce(F.nullif(x, F.lit("")).cast("long"), F.lit(0).cast("long"))

    def halves(d: Column) -> Column:
        n = F.length(d)
        half = F.floor(n / 2).cast("int")
        return F.struct(
            (n - half).alias("n"), half.alias("m"), power(n - half).alias("a"), power(half).alias("b"),
            F.concat(F.lit(label), n.cast("string")).alias("label"),
            F.struct(number(F.substr(d, F.lit(1), n - half)).alias("left"), number(F.substr(d, n - half + 1, half)).alias("right")).alias("state"),
        )

    def use(c: Column) -> Column:
        def text(s: Column) -> Column:
            return F.concat(F.lpad(s["left"].cast("string"), c["n"], F.lit("0")), F.lpad(s["right"].cast("string"), c["m"], F.lit("0")))

        return _turned(c["state"], c["a"], c["b"], key, c["label"], back, text)

    return _bind(_bind(digits, halves), use)


def luhn_sum(digits: Column, doubled: int) -> Column:
    """Sum of the digits from the right, every second one doubled from place ``doubled`` on."""
    places = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))

    def worth(d: Column, i: Column) -> Column:
        twice = d * 2
        return F.when(i % 2 == doubled, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.transform(F.filter(places, lambda d: d.isNotNull()), worth), F.lit(0), lambda a, x: a + x)


def _put_digits(shape: Column, digits: Column) -> Column:
    """Digits of ``shape`` replaced in order; what is between them stays."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, c: Column) -> Column:
        is_digit = c.rlike("[0-9]")
        return F.struct(
            (acc["at"] + is_digit.cast("int")).alias("at"),
            F.concat(acc["out"], F.when(is_digit, F.substr(digits, acc["at"] + 1, F.lit(1))).otherwise(c)).alias("out"),
        )

    return F.aggregate(F.split(shape, ""), start, step, lambda acc: acc["out"])


def _card(value: Column, key: str, back: bool) -> Column:
    """A number that passes its check digit: the others are permuted, the check digit is made anew."""

    def use(digits: Column) -> Column:
        body = permute_digits(F.substr(digits, F.lit(1), F.length(digits) - 1), key, "card", back)
        whole = _bind(body, lambda x: F.concat(x, F.pmod(-luhn_sum(x, 0), F.lit(10)).cast("string")))
        return F.when(luhn_sum(digits, 1) % 10 == 0, _put_digits(value, whole)).otherwise(value)

    return _bind(_digits(value), use)


def account_check(country: Column, body: Column) -> Column:
    """The two check digits that an account number of this country and body has."""

    def step(acc: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), acc * 10 + F.try_to_number(c, F.lit("9")).cast("int")).otherwise(acc * 100 + F.ascii(c) - 55) % 97

    whole = F.split(F.concat(body, country, F.lit("00")), "")
    left = F.aggregate(F.filter(whole, lambda c: c != ""), F.lit(0), step)
    return F.lpad((98 - left).cast("string"), 2, "0")


def _account(value: Column, key: str, back: bool) -> Column:
    """An account number that passes its check: country and letters stay, the check digits are made anew."""

    def use(shut: Column) -> Column:
        country, check, body = F.substr(shut, F.lit(1), F.lit(2)), F.substr(shut, F.lit(3), F.lit(2)), F.substr(shut, F.lit(5), F.length(shut))
        digits = _digits(body)
        moved = _bind(permute_digits(digits, key, "account", back), lambda d: F.struct(d.alias("d"), _put_digits(body, d).alias("body")))
        again = _bind(moved, lambda m: _put_digits(value, F.concat(account_check(country, m["body"]), m["d"])))
        return F.when((check == account_check(country, body)) & (F.length(digits) > 0), again).otherwise(value)

    return _bind(F.translate(value, " ", ""), use)


def _plain(value: Column, key: str, label: str, back: bool) -> Column:
    return _put_digits(value, permute_digits(_digits(value), key, label, back))


def _phone(value: Column, key: str, back: bool) -> Column:
    """The country code stays; the rest is permuted."""
    code = F.regexp_extract(value, r"^\+[0-9]{1,3}(?=[ -(])", 0)
    return _bind(F.length(code), lambda n: F.concat(code, _plain(F.substr(value, n + 1, F.length(value)), key, "phone", back)))


def _address(value: Column, key: str, back: bool) -> Column:
    def use(parts: Column) -> Column:
        number = F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a * 256 + x.cast("long"))
        half = F.lit(1 << 16).cast("long")
        moved = permute(number, half, half, key, F.lit("address"), back)
        again = _bind(
            moved, lambda n: F.concat_ws(".", *[(F.shiftright(n, s).bitwiseAND(F.lit(255))).cast("string") for s in (24, 16, 8, 0)])
        )
        return F.when(F.forall(parts, lambda x: x.cast("int") <= 255), again).otherwise(value)

    return _bind(F.split(value, "\\."), use)


def _moved_day(day: Column, key: str, back: bool) -> Column:
    """Another day of 1900 to 2099; other days stay."""
    number = F.datediff(day, F.lit(EPOCH).cast("date")).cast("long")
    moved = _permuted_day(number, key, back)
    # The modulus is a little larger than the range: walk on until inside.
    inside = (number >= 0) & (number < DAYS)
    return F.when(inside, F.date_add(F.lit(EPOCH).cast("date"), _walk(moved, key, back).cast("int")))


def _permuted_day(number: Column, key: str, back: bool) -> Column:
    return permute(number, F.lit(11).cast("long"), F.lit(DAYS // 11 + 1).cast("long"), key, F.lit("date"), back)


def _walk(number: Column, key: str, back: bool) -> Column:
    for _ in range(3):
        number = _bind(number, lambda n: F.when(n < DAYS, n).otherwise(_permuted_day(n, key, back)))
    return number


def _date(value: Column, key: str, year_first: bool, back: bool) -> Column:
    parts = r"^(\d{4})(.)(\d{2})(.)(\d{2})$" if year_first else r"^(\d{2})(.)(\d{2})(.)(\d{4})$"
    at = lambda i: F.regexp_extract(value, parts, i)
    year, middle, last = (1, 3, 5) if year_first else (5, 3, 1)

    def use(day: Column) -> Column:
        moved = _moved_day(day, key, back)
        names = {"y": F.date_format(moved, "yyyy"), "m": F.date_format(moved, "MM"), "d": F.date_format(moved, "dd")}
        order = "ymd" if year_first else "dmy"
        text = F.concat(names[order[0]], at(2), names[order[1]], at(4), names[order[2]])
        return F.coalesce(text, value)

    return _bind(F.try_to_date(F.concat_ws("-", at(year), at(middle), at(last)), "yyyy-MM-dd"), use)


def _month_first(value: Column, key: str, back: bool) -> Column:
    """``value`` with its first two fields changed over, moved, and changed back."""
    swap = lambda v: F.regexp_replace(v, r"^(\d{2})(.)(\d{2})", "$3$2$1")
    return _bind(swap(value), lambda v: swap(_date(v, key, False, back)))


def _short_date(value: Column, key: str, back: bool) -> Column:
    """A date whose day or month has one digit, as another one of the same widths.

    The day comes first, unless the second field can only be a day; such a day
    stays above 12, so it is still read as one.
    """

    def form(p: Column) -> Column:
        """Lowest value and number of values of both fields."""
        first, second = F.get(p, F.lit(0)), F.get(p, F.lit(1))
        month_first = second.cast("int") > 12
        one, one_more = F.length(first) == 1, F.length(second) == 1
        return F.struct(
            month_first.alias("month_first"),
            F.when(one, 1).otherwise(10).alias("low"),
            F.when(one, 9).when(month_first, 3).otherwise(22).cast("long").alias("span"),
            F.when(month_first, 13).when(one_more, 1).otherwise(10).alias("low_second"),
            F.when(month_first, 19).when(one_more, 9).otherwise(3).cast("long").alias("span_second"),
            first.cast("int").alias("first"), second.cast("int").alias("second"), F.get(p, F.lit(2)).cast("int").alias("year"),
        )

    def is_day(c: Column, first: Column, second: Column, year: Column) -> Column:
        day, month = F.when(c["month_first"], second).otherwise(first), F.when(c["month_first"], first).otherwise(second)
        return F.try_to_date(F.format_string("%04d-%02d-%02d", year, month, day), "yyyy-MM-dd").isNotNull()

    def use(c: Column) -> Column:
        pairs = c["span"] * c["span_second"]
        label = F.concat(F.lit("short"), (c["low"] * 10_000 + c["span"] * 100 + c["low_second"]).cast("string"))

        def fields(n: Column) -> list[Column]:
            rest = n % pairs
            ahead, after = rest % c["span"] + c["low"], F.call_function("div", rest, c["span"]) + c["low_second"]
            return [x.cast("int") for x in (ahead, after, F.call_function("div", n, pairs) + FIRST_YEAR)]

        def walk(n: Column, turn: Column) -> Column:
            moved = permute(n, F.lit(YEARS).cast("long"), pairs, key, label, back)
            return F.when((turn > 0) & is_day(c, *fields(n)), n).otherwise(moved)

        number = (c["year"] - FIRST_YEAR) * pairs + (c["second"] - c["low_second"]) * c["span"] + c["first"] - c["low"]
        place = F.aggregate(F.sequence(F.lit(0), F.lit(WALKS)), number.cast("long"), walk)
        marks = [F.regexp_extract(value, r"^\d+(.)\d+(.)", i) for i in (1, 2)]

        def text(n: Column) -> Column:
            first, second, year = fields(n)
            whole = F.concat(first.cast("string"), marks[0], second.cast("string"), marks[1], year.cast("string"))
            return F.when(is_day(c, first, second, year), whole).otherwise(value)

        in_range = c["year"].between(FIRST_YEAR, FIRST_YEAR + YEARS - 1) & (c["first"] >= c["low"]) & (c["second"] >= c["low_second"])
        return F.when(in_range & is_day(c, c["first"], c["second"], c["year"]), _bind(place, text)).otherwise(value)

    return _bind(_bind(F.split(value, "[/.-]"), form), use)


def _mail(value: Column, key: str) -> Column:
    """The local part becomes a keyed name of letters and digits; the domain stays."""
    local = F.substring_index(value, "@", 1)
    name = F.substring(F.sha2(F.concat(F.lit(f"{key}|mail|"), F.lower(value)), 256), 1, 12)
    return F.concat(F.lit("u"), name, F.substr(value, F.length(local) + 1, F.length(value)))


def pseudonym(value: Column, key: str, back: bool = False) -> Column:
    """The pseudonym of one found value; ``back`` undoes it, but for mail names."""
    is_kind = {k.name: value.rlike(f"^(?:{k.pattern})$") for k in KINDS}
    month = F.regexp_extract(value, r"^\d{2}.(\d{2})", 1).cast("int")
    return (
        F.when(value.contains("@"), value if back else _mail(value, key))
        .when(is_kind["date"], _date(value, key, True, back))
        .when(is_kind["day_first"] & (month > 12), _month_first(value, key, back))
        .when(is_kind["day_first"], _date(value, key, False, back))
        .when(is_kind["address"], _address(value, key, back))
        .when(is_kind["phone"] | is_kind["phone_plain"], _phone(value, key, back))
        .when(is_kind["phone_local"], _plain(value, key, "phone", back))
        .when(is_kind["short_date"], _short_date(value, key, back))
        .when(is_kind["account"], _account(value, key, back))
        .when(is_kind["social"], _plain(value, key, "social", back))
        .otherwise(_card(value, key, back))
    )


def pseudonymise(docs: DataFrame, key: str, text: str = "text", back: bool = False) -> DataFrame:
    """``docs`` with every found value in ``text`` replaced; ``n_replaced`` counts changed ones."""
    kept = without(docs, COMPUTED)
    body = F.col(text).cast("string")
    found = F.when(body.rlike(HINT), F.regexp_extract_all(body, F.lit(f"({ANY})"), F.lit(1)))
    parts = F.split(body, ANY)
    joined = F.array_join(F.flatten(F.zip_with(parts, F.col("_new"), lambda p, v: F.array(p, F.coalesce(v, F.lit(""))))), "")
    changed = F.size(F.filter(F.zip_with("_found", "_new", lambda a, b: a != b), lambda x: x))
    return (
        kept.withColumn("_found", found)
        .withColumn("_new", F.when(F.size("_found") > 0, F.transform("_found", lambda v: pseudonym(v, key, back))))
        .withColumn("n_replaced", F.when(F.col("_new").isNotNull(), changed).otherwise(F.lit(0)).cast("long"))
        .withColumn(text, F.when(F.col("_new").isNotNull(), joined).otherwise(body))
        .drop("_found", "_new")
    )
