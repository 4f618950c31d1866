"""Personal numbers, dates and addresses replaced by keyed pseudonyms of the same form.

Numbers found in text are validated (card numbers by their check digit, network addresses and dates by their
ranges), and then permuted within their format by a Feistel network keyed with a secret: a card number
becomes another valid card number, a date another date, and so on. The permutation depends on value and key alone, so
equal values stay linked across documents, and different values of a kind never meet. Names of mail addresses are replaced by
24 digits of a keyed digest, and long hexadecimal secrets by a keyed digest of their length: neither is a number of a fixed
format to permute, so for these two different values keep apart up to the digest's length (96 bits and more).

Everything is a Spark expression, applied row by row in the scan; nothing is shuffled. A text is split at the matches
of one pattern; texts without a match pass unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
_DIGEST = 15  # hexadecimal digits of a round's digest; these fit in a long

# The forms that are searched, in the order in which they are tried.
_EDGE = r"(?<![A-Za-z0-9])"
_END = r"(?![A-Za-z0-9])"
_NAME = r"[A-Za-z0-9À-ɏ._%+-]"
_MAIL = f"(?<!{_NAME}){_NAME}++@" + r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*(?<=\.[A-Za-z]{2,24})"
_SECRET = _EDGE + r"(?=[A-Fa-f]*[0-9])(?=[0-9]*[A-Fa-f])(?:[0-9a-f]{32,}|[0-9A-F]{32,})" + _END
_ADDRESS = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
_ISO_DATE = r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9]|-[0-9])"
_DAY_FIRST = r"(?<![0-9./])[0-9]{2}[./][0-9]{2}[./][0-9]{4}(?![0-9]|[./][0-9])"
_SOCIAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
_CARD = _EDGE + (
    r"(?:[0-9]{13,19}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})"
) + _END
# A phone number has 8 to 15 digits, those behind country code 1 eleven. It ends before what is a number of its own form, if it
# is whole by then, and otherwise goes on as long as it may.
_GROUP = r"[ .-]?[0-9]{2,4}"
_OWN = f"{_ADDRESS}|{_ISO_DATE}|{_DAY_FIRST}|" + r"[0-9]+[,:/][0-9]"
# Java wants the length of what it looks back at spelled out.
_DIGIT = r"[ .()-]{0,2}[0-9]"
_WHOLE = r"(?<=\+" + 8 * _DIGIT + 7 * f"(?:{_DIGIT}" + 7 * ")?" + ")(?![0-9])"
_PHONE = r"(?<![0-9A-Za-z])(?:\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])|" + "|".join(
    r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:" + before + _GROUP + "){2,4}" + _WHOLE for before in (f"(?![ .-](?:{_OWN}|{_SOCIAL}|{_CARD}))", f"(?![ .-](?:{_OWN}))", "")
) + ")"
_FORMS = {
    "mail": _MAIL, "secret": _SECRET, "phone": _PHONE, "address": _ADDRESS, "iso_date": _ISO_DATE,
    "day_first": _DAY_FIRST, "social": _SOCIAL, "card": _CARD,
}
# The days from 1900 to 2099, as a product of two factors for the two halves of the network.
_FIRST_DAY, _DAYS = "1900-01-01", (17, 4297)


def _digest(key: str, kind: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), *(p.cast("string") for p in parts)), 256)


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, _DIGEST), 16, 10).cast("long")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def feistel(left: Column, right: Column, left_size: Column, right_size: Column, key: str, kind: str) -> Column:
    """A keyed permutation of the pairs (left < left_size, right < right_size), as a struct l, r of longs.

    Each round adds to one half a keyed digest of the other, modulo the half's size, in turn; so any sizes do.
    """

    def step(state: Column, turn: Column) -> Column:
        noise = _number(_digest(key, kind, turn, F.when(turn % 2 == 0, state["r"]).otherwise(state["l"]), state["n"]))
        return F.struct(
            F.when(turn % 2 == 0, F.pmod(state["l"] + noise, state["n"])).otherwise(state["l"]).alias("l"),
            F.when(turn % 2 == 1, F.pmod(state["r"] + noise, state["m"])).otherwise(state["r"]).alias("r"),
            state["n"].alias("n"),
            state["m"].alias("m"),
        )

    start = F.struct(
        left.cast("long").alias("l"), right.cast("long").alias("r"),
        left_size.cast("long").alias("n"), right_size.cast("long").alias("m"),
    )
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """A string of up to 36 digits, permuted among the strings of its length; a single digit is shifted."""
    size = F.length(digits)
    half = F.floor(size / 2).cast("int")
    power = lambda n: F.rpad(F.lit("1"), n + 1, "0").cast("long")
    left = F.when(half == 0, F.lit("0")).otherwise(F.substring(digits, F.lit(1), half))
    right = F.substring(digits, half + 1, size - half)
    return _let(
        feistel(left, right, power(half), power(size - half), key, kind),
        lambda state: F.concat(
            F.when(half == 0, F.lit("")).otherwise(F.lpad(state["l"].cast("string"), half, "0")),
            F.lpad(state["r"].cast("string"), size - half, "0"),
        ),
    )


def _into_form(value: Column, digits: Column) -> Column:
    """The digits in the places of the value's digits, one for one."""

    def fill(new: Column) -> Column:
        state = F.aggregate(
            F.split(value, ""),
            F.struct(F.lit("").alias("text"), F.lit(1).alias("next")),
            lambda s, c: F.when(
                c.rlike("^[0-9]$"),
                F.struct(F.concat(s["text"], F.substring(new, s["next"], F.lit(1))).alias("text"), (s["next"] + 1).alias("next")),
            ).otherwise(F.struct(F.concat(s["text"], c).alias("text"), s["next"].alias("next"))),
        )
        return state["text"]

    return _let(digits, fill)


def _only_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def check_sum(digits: Column) -> Column:
    """The Luhn sum of a string of digits: from the right, every other digit doubled, with cross sum."""
    places = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)),
    )
    return F.aggregate(places, F.lit(0), lambda total, x: total + F.coalesce(x, F.lit(0)))


def _card(value: Column, key: str) -> Column:
    def new(digits: Column) -> Column:
        body = permuted_digits(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
        full = _let(
            body,
            lambda b: F.concat(b, F.pmod(10 - F.pmod(check_sum(F.concat(b, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string")),
        )
        return F.when(F.pmod(check_sum(digits), F.lit(10)) == 0, _into_form(value, full))

    return _let(_only_digits(value), new)


def _address(value: Column, key: str) -> Column:
    part = lambda i: F.split_part(value, F.lit("."), F.lit(i)).cast("int")
    valid = (part(1) < 256) & (part(2) < 256) & (part(3) < 256) & (part(4) < 256)
    new = _let(
        feistel(part(1) * 256 + part(2), part(3) * 256 + part(4), F.lit(65536), F.lit(65536), key, "address"),
        lambda s: F.concat_ws(
            ".", *(x.cast("string") for half in (s["l"], s["r"]) for x in (F.shiftright(half, 8), half % 256))
        ),
    )
    return F.when(valid, new)


def _date(value: Column, read: str, key: str) -> Column:
    """A date in the years 1900 to 2099, among the days of these years; the same day in another form links."""
    first = F.lit(_FIRST_DAY).cast("date")
    n, m = _DAYS

    def new(day: Column) -> Column:
        moved = _let(
            feistel(F.floor(day / m), day % m, F.lit(n), F.lit(m), key, "date"), lambda s: (s["l"] * m + s["r"]).cast("int")
        )
        return F.when((day >= 0) & (day < n * m), F.date_format(F.date_add(first, moved), read))

    return _let(F.datediff(F.try_to_timestamp(value, F.lit(read)).cast("date"), first), new)


def _social(value: Column, key: str) -> Column:
    """Area 1 to 899 but 666, group 1 to 99, serial 1 to 9999: permuted among the valid numbers."""
    digits = _only_digits(value)
    area, group, serial = (F.substring(digits, a, n).cast("int") for a, n in ((1, 3), (4, 2), (6, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    rank = F.when(area > 666, area - 2).otherwise(area - 1)  # 0 to 897
    pad = lambda x, n: F.lpad(x.cast("string"), n, "0")

    def new(s: Column) -> Column:
        moved = F.floor(s["l"] / 99)
        moved = F.when(moved >= 665, moved + 2).otherwise(moved + 1)
        return F.concat_ws("-", pad(moved, 3), pad(s["l"] % 99 + 1, 2), pad(s["r"] + 1, 4))

    return F.when(
        valid, _let(feistel(rank * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), key, "social"), new)
    )


def _phone(value: Column, key: str) -> Column:
    """International numbers of 8 to 15 digits; the first digit, of the country code, stays."""

    def new(digits: Column) -> Column:
        moved = permuted_digits(F.substring(digits, F.lit(2), F.length(digits) - 1), key, "phone")
        full = F.concat(F.substring(digits, 1, 1), moved)
        return F.when(F.length(digits).between(8, 15), _into_form(value, full))

    return _let(_only_digits(value), new)


def _mail(value: Column, key: str) -> Column:
    """A name of a keyed digest at the same domain."""
    low = F.lower(value)
    name = F.concat(F.lit("u"), F.substring(_digest(key, "mail", low), 1, 24))
    return F.concat(name, F.lit("@"), F.split_part(value, F.lit("@"), F.lit(-1)))


def _secret(value: Column, key: str) -> Column:
    """A keyed digest repeated to the secret's length, in its case."""
    digest = _digest(key, "secret", F.lower(value))
    new = F.rpad(digest, F.length(value), digest)
    return F.when(value == F.upper(value), F.upper(new)).otherwise(new)


def _pseudonym(value: Column, key: str) -> Column:
    """What stands for a match; a match that is not valid stays."""
    is_kind = lambda kind: value.rlike(f"^(?:{_FORMS[kind]})$")
    day_first = F.coalesce(*(_date(value, form, key) for form in ("dd.MM.yyyy", "dd/MM/yyyy", "MM/dd/yyyy")))
    new = (
        F.when(F.contains(value, F.lit("@")), _mail(value, key))
        .when(is_kind("secret"), _secret(value, key))
        .when(F.startswith(value, F.lit("+")), _phone(value, key))
        .when(is_kind("address"), _address(value, key))
        .when(is_kind("iso_date"), _date(value, "yyyy-MM-dd", key))
        .when(is_kind("day_first"), day_first)
        .when(is_kind("social"), _social(value, key))
        .otherwise(_card(value, key))
    )
    return F.coalesce(new, value)


_ANY = _EDGE + "(?:" + "|".join(f"(?:{form})" for form in _FORMS.values()) + ")"
_HINT = "[0-9@]"  # every form has one of these


def pseudonymised(text: Column, key: str) -> Column:
    """The text with every valid match replaced."""
    found = F.regexp_extract_all(text, F.lit(_ANY), F.lit(0))
    between = F.split(text, _ANY, -1)
    new = F.transform(found, lambda value: _pseudonym(value, key))
    joined = F.zip_with(between, new, lambda gap, value: F.concat(gap, F.coalesce(value, F.lit(""))))
    return F.when(text.rlike(_HINT), F.array_join(joined, "")).otherwise(text)


def pseudonyms(docs: DataFrame, key: str, text_col: str = "text", out_col: str | None = None) -> DataFrame:
    """The rows with valid numbers, dates, addresses and secrets in the text replaced by pseudonyms.

    ``out_col`` names a new column for the text; without it the text is replaced. A null text stays null; an
    empty one, and one without valid matches, stays as it is. Other columns are kept; no rows give no rows.
    """
    return docs.withColumn(out_col or text_col, pseudonymised(F.col(text_col), key))
