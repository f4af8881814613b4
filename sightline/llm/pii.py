"""Format-preserving pseudonyms for private values in text, in DataFrame functions only.

Values are found by one pattern and validated (Luhn sum of card numbers, mod-97 sum of IBANs, octets of addresses,
calendar of dates, ranges of social-security numbers). A validated value is replaced by its image under a keyed Feistel
permutation of its own format: the two halves of the value are numbers below `a` and `b` (or character
strings), and each round adds a keyed digest of one half to the other, modulo its range. So a pseudonym is a valid value of
the same format, equal values get equal pseudonyms in every document, and different values stay different.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
EMAIL = r"(?<![\w.%+-])[A-Za-z0-9][\w.%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![\w-])"
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _account(n: int, countries: str) -> str:
    rest = f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else ""
    return rf"(?:{countries.replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{n // 4 - 1}}}{rest}(?!\w)"


# A number of its country's length ends there, whatever upper-case word or number follows; any other is taken as far as it may go.
IBAN = rf"(?<!\w)(?:{'|'.join(_account(n, c) for n, c in IBAN_LENGTHS.items())}|[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?(?!\w))"
DATE = r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\w/-]|\.\d)"
ADDRESS = r"(?<!\w)(?<!\d\.)\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)"
SOCIAL = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
PHONE = r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w|-\d)"
CARD = r"(?<!\w)(?<!\d[.,])(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?!\w|-\d)"
FOUND = "|".join([EMAIL, DATE, ADDRESS, SOCIAL, CARD, PHONE, IBAN])
FIRST_DAY, DAY_A, DAY_B = "1900-01-01", 150, 487  # 73,050 days from 1900 to 2099


def _noise(key: str, tweak: str, turn: Column, value: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), turn.cast("string"), value.cast("string")), 256)


def _number(key: str, tweak: str, turn: Column, value: Column) -> Column:
    return F.conv(F.substring(_noise(key, tweak, turn, value), 1, 14), 16, 10).cast("long")


def permuted(key: str, tweak: str, left: Column, right: Column, a: Column | int, b: Column | int) -> Column:
    """struct(l, r): the image of (left below a, right below b) under a keyed permutation of all such pairs."""
    a, b = F.lit(a).cast("long") if isinstance(a, int) else a, F.lit(b).cast("long") if isinstance(b, int) else b

    def turn(state: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(
            F.when(even, (state["l"] + _number(key, tweak, i, state["r"]) % a) % a).otherwise(state["l"]).alias("l"),
            F.when(even, state["r"]).otherwise((state["r"] + _number(key, tweak, i, state["l"]) % b) % b).alias("r"),
        )

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _digits(key: str, tweak: str, digits: Column) -> Column:
    """The image of a string of 2 to 18 digits among the digit strings of its length."""
    n = F.length(digits)
    half = (n / 2).cast("int")
    ten = F.lit(10.0)
    state = permuted(key, tweak, digits.substr(F.lit(1), half), digits.substr(half + 1, n), F.pow(ten, half).cast("long"), F.pow(ten, n - half).cast("long"))
    return F.concat(F.lpad(state["l"].cast("string"), half, "0"), F.lpad(state["r"].cast("string"), n - half, "0"))


def _shifted(half: Column, noise: Column) -> Column:
    """Each letter or digit moved within its kind by a byte of noise (hex); other characters stay."""

    def move(c: Column, i: Column) -> Column:
        step = F.conv(F.substring(noise, i % 32 * 2 + 1, F.lit(2)), 16, 10).cast("int")
        code = F.ascii(c)
        kinds = [("0", "9", 48, 10), ("a", "z", 97, 26), ("A", "Z", 65, 26)]
        moved = F.coalesce(*[F.when(c.between(x, y), F.chr(F.lit(at) + (code - at + step) % size)) for x, y, at, size in kinds], c)
        return moved

    return F.when(half == "", half).otherwise(F.array_join(F.transform(F.split(half, ""), move), ""))


def _string(key: str, tweak: str, value: Column) -> Column:
    """The image of a string among the strings with the same kinds of characters at the same places."""
    n = F.length(value)
    half = (n / 2).cast("int")

    def turn(state: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(
            F.when(even, _shifted(state["l"], _noise(key, tweak, i, state["r"]))).otherwise(state["l"]).alias("l"),
            F.when(even, state["r"]).otherwise(_shifted(state["r"], _noise(key, tweak, i, state["l"]))).alias("r"),
        )

    start = F.struct(value.substr(F.lit(1), half).alias("l"), value.substr(half + 1, n).alias("r"))
    state = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)
    return F.concat(state["l"], state["r"])


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string; a valid number's is a multiple of ten."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda x, y: x + y)


def mod97(value: Column) -> Column:
    """Remainder of the number that letters (A = 10) and digits spell."""

    def add(x: Column, c: Column) -> Column:
        letter = c.between("A", "Z")
        return F.when(letter, (x * 100 + F.ascii(c) - 55) % 97).otherwise((x * 10 + F.coalesce(F.try_to_number(c, F.lit("9")).cast("int"), F.lit(0))) % 97)

    return F.aggregate(F.split(value, ""), F.lit(0), add)


def _laid_out(shape: Column, digits: Column, skip: Column | int = 0) -> Column:
    """The characters of `shape` with its digits after the first `skip` replaced in order by `digits`."""
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("n"))
    skip = F.lit(skip) if isinstance(skip, int) else skip

    def put(state: Column, c: Column) -> Column:
        digit = c.between("0", "9")
        new = F.when(digit & (state["n"] >= skip), F.substring(digits, state["n"] - skip + 1, F.lit(1))).otherwise(c)
        return F.struct(F.concat(state["text"], new).alias("text"), (state["n"] + digit.cast("int")).alias("n"))

    return F.aggregate(F.split(shape, ""), start, put)["text"]


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one found value; a value that no validation accepts is returned as it is."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    at = F.split(value, "@")
    domain = F.regexp_extract(at[1], r"^(.*)\.[^.]*$", 1)
    email = F.concat(_string(key, "local", at[0]), F.lit("@"), _string(key, "domain", domain), F.lit("."), F.regexp_extract(at[1], r"([^.]*)$", 1))

    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("int"))
    image = permuted(key, "address", octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], 65536, 65536)
    address = F.concat_ws(".", *[x.cast("string") for x in (F.floor(image["l"] / 256), image["l"] % 256, F.floor(image["r"] / 256), image["r"] % 256)])

    body = digits.substr(F.lit(1), F.length(digits) - 1)
    new = _digits(key, "card", body)
    card = _laid_out(value, F.concat(new, ((10 - luhn_sum(F.concat(new, F.lit("0"))) % 10) % 10).cast("string")))

    area = digits.substr(1, 3).cast("int")
    pair = permuted(key, "social", (area - 1 - (area > 666).cast("int")) * 99 + digits.substr(4, 2).cast("int") - 1, digits.substr(6, 4).cast("int") - 1, 898 * 99, 9999)
    new_area = F.floor(pair["l"] / 99) + 1
    social = F.concat_ws("-", F.lpad((new_area + (new_area > 665).cast("int")).cast("string"), 3, "0"), F.lpad((pair["l"] % 99 + 1).cast("string"), 2, "0"), F.lpad((pair["r"] + 1).cast("string"), 4, "0"))

    code = F.when(value.startswith("+"), F.length(F.regexp_extract(value, r"^\+(\d{1,3}?)(?=\D|\d{7,}$|$)", 1))).otherwise(0)
    phone = _laid_out(value, _digits(key, "phone", digits.substr(code + 1, F.length(digits))), code)

    tight = F.replace(value, F.lit(" "))
    account = _string(key, "account", tight.substr(F.lit(5), F.length(tight)))
    checked = F.lpad((98 - mod97(F.concat(account, tight.substr(1, 2), F.lit("00")))).cast("string"), 2, "0")
    iban = F.concat(tight.substr(1, 2), checked, account)
    iban = F.when(value.contains(" "), F.rtrim(F.regexp_replace(iban, "(.{4})", "$1 "))).otherwise(iban)

    def date(pattern: str) -> Column:
        day = F.datediff(F.try_to_timestamp(value, F.lit(pattern)).cast("date"), F.lit(FIRST_DAY).cast("date"))
        image = permuted(key, "date", F.floor(day / DAY_B), day % DAY_B, DAY_A, DAY_B)
        moved = F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), (image["l"] * DAY_B + image["r"]).cast("int")), pattern)
        return F.when(day.between(0, DAY_A * DAY_B - 1), moved)

    return (
        F.when(value.contains("@"), email)
        .when(value.rlike(r"^\d{4}-\d\d-\d\d$"), F.coalesce(date("yyyy-MM-dd"), value))
        .when(value.rlike(r"^\d\d\.\d\d\.\d{4}$"), F.coalesce(date("dd.MM.yyyy"), value))
        .when(value.rlike(r"^\d\d/\d\d/\d{4}$"), F.coalesce(date("MM/dd/yyyy"), date("dd/MM/yyyy"), value))
        .when(value.rlike(r"^\d+\.\d+\.\d+\.\d+$"), F.when(F.array_max(octets) < 256, address).otherwise(value))
        .when(value.rlike(r"^\d{3}-\d\d-\d{4}$"), F.when(area.between(1, 899) & (area != 666) & ~value.rlike("-00-|-0000$"), social).otherwise(value))
        .when(value.rlike(r"^\d(?:[ -]?\d){12,18}$") & (luhn_sum(digits) % 10 == 0), card)
        .when(value.rlike("^[A-Z]{2}"), F.when(mod97(F.concat(tight.substr(F.lit(5), F.length(tight)), tight.substr(1, 4))) == 1, iban).otherwise(value))
        .when(value.rlike(r"^[+(]|^\d{3}[.-]\d{3}[.-]\d{4}$") & F.length(digits).between(7, 15), phone)
        .otherwise(value)
    )


def pseudonymised(text: Column, key: str) -> Column:
    """The text with every validated value replaced by its pseudonym; null stays null."""
    gaps = F.split(text, FOUND, -1)
    new = F.transform(F.regexp_extract_all(text, F.lit(FOUND), F.lit(0)), lambda value: pseudonym(value, key))
    whole = F.array_join(F.zip_with(gaps, new, lambda gap, value: F.concat(gap, F.coalesce(value, F.lit("")))), "")
    return F.when(text.rlike(r"[0-9]{2}|@"), whole).otherwise(text)


def pseudonymise(docs: DataFrame, key: str = "pseudonym key", column: str = "text") -> DataFrame:
    """docs with the private values of a text column replaced.

    Null and empty texts stay as they are, and so does every character outside a validated value; dates outside
    1900 to 2099 and values that fail their check stay. Columns, rows and repeated rows are kept. The key is the secret
    that links equal values; give one of your own.
    """
    return docs.withColumn(column, pseudonymised(F.col(column), key))
