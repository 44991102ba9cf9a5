"""Format-preserving pseudonyms for personal data, with column functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brindle.functions.arrays import let

ROUNDS = 10

_DIGITS = "0123456789"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()

_EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){0,8}\.[A-Za-z]{2,24}(?![A-Za-z0-9])"
_SECRET = r"(?i:token|secret|password|api[_-]?key|key)[\"']?\s{0,4}[=:]\s{0,4}[\"']?(?=[A-Fa-f]{0,32}[0-9])[0-9A-Fa-f]{32,128}(?![0-9A-Za-z])"
_IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
# Lengths of account numbers by country, also where they are not registered but in use.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR",
    27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN_LISTED = "|".join(
    rf"(?:{lands.replace(' ', '|')})[0-9]{{2}}(?:[ ]?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])" for n, lands in _IBAN_LENGTHS.items()
)
_DATE = (
    r"(?<![0-9./-])(?:[0-9]{4}(?<ymd>[-/.])[0-9]{1,2}\k<ymd>[0-9]{1,2}|[0-9]{1,2}(?<dmy>[/.-])[0-9]{1,2}\k<dmy>[0-9]{4})(?![0-9]|[./-][0-9])"
)
_IPV4 = r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
_SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
_NATIONAL = r"(?<![0-9])(?:\([0-9]{3}\)[ ]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9]|-[0-9])"
# Groups that cards are printed in, behind the first one.
_PRINTED = (
    r"(?<![0-9A-Za-z])(?:[0-9]{4}(?<gap>[ -])(?:[0-9]{4}\k<gap>[0-9]{4}\k<gap>[0-9]{4}\k<gap>"
    r"(?![0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9]))[0-9]{3}(?![./-]?[0-9])"
    r"|[0-9]{4}\k<gap>[0-9]{4}\k<gap>[0-9]{1,7}|[0-9]{6}\k<gap>[0-9]{4,5}|[0-9]{5}\k<gap>[0-9]{6}"
    r"|[0-9]{3}\k<gap>[0-9]{3}\k<gap>[0-9]{3})|[0-9]{6}[ -][0-9]{13})(?![0-9A-Za-z])"
)
# All of a row of groups of two digits or more, 13 to 19 digits with one mark between them, without a printed
# card behind its first group.
_ROW = (
    r"(?<![0-9A-Za-z])(?<![0-9][ -])(?=[0-9](?:[ -]?[0-9]){12,18}(?![ ./-]?[0-9]))"
    r"(?![0-9]++(?:[ -][0-9]++)*?(?:(?:[ -][0-9]{4}){4}|[ -][0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})(?![0-9]))"
    r"[0-9]{2,17}(?<mark>[ -])[0-9]{2,}(?:\k<mark>[0-9]{2,})*(?![ ./-]?[0-9]|[A-Za-z])"
)
_CARD = rf"(?<![0-9A-Za-z])[0-9]{{13,19}}(?![0-9A-Za-z])|{_ROW}|{_PRINTED}"


def _again(form: str, mark: str) -> str:
    """A form for a second use in one pattern, where names of groups may not repeat."""
    for name in ("ymd", "dmy", "gap", "mark"):
        form = form.replace(f"<{name}>", f"<{name}{mark}>")
    return form


# After a space, the start of these is no further group of a phone number.
_OTHER = "|".join(_again(form, "x") for form in (_DATE, _IPV4, _SSN, _CARD, _NATIONAL))
_GROUPS = r"[0-9]{1,3}[ .-]?(?:\([0-9]{1,5}\)|[0-9]{2,5})(?:[ .-]?[0-9]{2,5}){1,5}"
_NEXT = "[ .()-]{0,2}[0-9]"
# 7 to 15 digits from the sign to here; written out, as a form that looks back may not repeat groups
_COUNTED = rf"(?<=\+{_NEXT * 7}{f'(?:{_NEXT}' * 8}{')?' * 8})(?![0-9])"
_PHONE = (
    r"(?<![0-9+])\+(?:1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
    rf"|{_GROUPS}{_COUNTED}(?=[ ](?:{_OTHER}))|{_GROUPS}{_COUNTED})|{_NATIONAL}"
)

# In this order at one place of a text: kind and form.
FORMS = {
    "email": _EMAIL,
    "secret": _SECRET,
    "iban": _IBAN,
    "date": _DATE,
    "ipv4": _IPV4,
    "ssn": _SSN,
    "card": _CARD,
    "phone": _PHONE,
}
_ANY = "|".join(f"(?:{form})" for form in FORMS.values())
# Between these no value but a secret goes on, so a text is read in regions from a form up to the next of them.
_STOP = r"\n\t,;<>{}\[\]|!?*&#~"
_REGION = rf"(?:{_ANY})[^{_STOP}]*?(?=(?={_SECRET})(?<!@[A-Za-z0-9.-]{{0,64}})|[{_STOP}]|\z)"
_DAYS, _FIRST_NEAR = 3_652_059, 693_595  # days of the years 1 to 9999, and those before 1900
_NEAR = (17, 4297)  # 1900 to 2099 have 17 * 4297 days,
_FAR = (1258, 2845)  # the other years 1258 * 2845


def _draw(key: str, kind: str, step: Column, other: Column, i: Column) -> Column:
    """A number below 2^28 from a keyed digest; `i` numbers the draws of one step."""
    text = F.concat_ws("|", F.lit(f"{key}|{kind}"), step.cast("string"), other, F.floor(i / 9).cast("string"))
    digits = F.substr(F.sha2(text, 256), (F.pmod(i, F.lit(9)) * 7 + 1).cast("int"), F.lit(7))
    return F.conv(digits, 16, 10).cast("long")


def _steps(invert: bool) -> Column:
    order = range(ROUNDS, 0, -1) if invert else range(1, ROUNDS + 1)
    return F.array(*[F.lit(i) for i in order])


def permute_text(value: Column, alphabets: list[str], key: str, kind: str, invert: bool = False) -> Column:
    """A Feistel network on the characters of a value; each stays in its alphabet, others stay.

    The halves take turns: the characters of one are shifted by draws that depend on the other.
    """
    chars = F.split(value, "")
    middle = F.floor(F.size(chars) / 2).cast("int")

    def shifted(half: Column, other: Column, step: Column) -> Column:
        seen = F.array_join(other, "")

        def one(c: Column, i: Column) -> Column:
            result = c
            for alphabet in alphabets:
                at = F.instr(F.lit(alphabet), c)
                draw = _draw(key, kind, step, seen, i)
                moved = F.pmod(at - 1 - draw if invert else at - 1 + draw, F.lit(len(alphabet)))
                result = F.when(at > 0, F.substr(F.lit(alphabet), (moved + 1).cast("int"), F.lit(1))).otherwise(result)
            return result

        return F.transform(half, one)

    def turn(acc: Column, step: Column) -> Column:
        left, right = acc["l"], acc["r"]
        odd = step % 2 == 1
        return F.struct(
            F.when(odd, shifted(left, right, step)).otherwise(left).alias("l"),
            F.when(odd, right).otherwise(shifted(right, left, step)).alias("r"),
        )

    start = F.struct(
        F.slice(chars, F.lit(1), middle).alias("l"), F.slice(chars, middle + 1, F.size(chars) - middle).alias("r")
    )
    done = F.aggregate(_steps(invert), start, turn)
    return let(done, lambda d: F.concat(F.array_join(d["l"], ""), F.array_join(d["r"], "")))


def permute_number(number: Column, sizes: tuple[int, int], key: str, kind: str, invert: bool = False) -> Column:
    """A Feistel network on the numbers below `sizes[0] * sizes[1]`, exact for any two factors."""
    a, b = sizes
    sign = -1 if invert else 1

    def turn(acc: Column, step: Column) -> Column:
        x, y = acc["x"], acc["y"]
        odd = step % 2 == 1
        zero = F.lit(0).cast("long")
        return F.struct(
            F.when(odd, F.pmod(x + sign * _draw(key, kind, step, y.cast("string"), zero), F.lit(a)))
            .otherwise(x)
            .cast("long")
            .alias("x"),
            F.when(odd, y)
            .otherwise(F.pmod(y + sign * _draw(key, kind, step, x.cast("string"), zero), F.lit(b)))
            .cast("long")
            .alias("y"),
        )

    start = F.struct(
        F.floor(number / b).cast("long").alias("x"), F.pmod(number, F.lit(b)).cast("long").alias("y")
    )
    return let(F.aggregate(_steps(invert), start, turn), lambda d: d["x"] * b + d["y"])


def _fill(form: Column, filler: Column, pattern: str = "[0-9]") -> Column:
    """Characters of `filler` in order, in the places of `form` that match the pattern."""
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("used"))

    def put(acc: Column, c: Column) -> Column:
        here = c.rlike(pattern)
        return F.struct(
            F.concat(acc["text"], F.when(here, F.substr(filler, acc["used"] + 1, F.lit(1))).otherwise(c)).alias("text"),
            (acc["used"] + here.cast("int")).alias("used"),
        )

    return F.aggregate(F.split(form, ""), start, put, lambda acc: acc["text"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn_sum(digits: Column) -> Column:
    """Weighted sum of digits, the last of which has weight 1."""
    each = F.transform(F.reverse(F.split(digits, "")), lambda c, i: c.cast("int") * (1 + i % 2))
    return F.aggregate(each, F.lit(0), lambda s, d: s + d - F.when(d > 9, 9).otherwise(0))


def _mod97(compact: Column) -> Column:
    """Remainder of an account number whose first four characters count last; A is 10."""
    moved = F.concat(F.substr(compact, F.lit(5)), F.substr(compact, F.lit(1), F.lit(4)))

    def step(rest: Column, c: Column) -> Column:
        digit = F.instr(F.lit(_DIGITS + _UPPER), c) - 1
        return F.pmod(rest * F.when(digit > 9, 100).otherwise(10) + digit, F.lit(97)).cast("int")

    return F.aggregate(F.split(moved, ""), F.lit(0), step)


def _email(v: Column, key: str, invert: bool) -> Column:
    last = F.length(F.substring_index(v, ".", -1)) + 1
    return F.concat(
        permute_text(F.substr(v, F.lit(1), F.length(v) - last), [_DIGITS, _LOWER, _UPPER], key, "email", invert),
        F.substr(v, F.length(v) - last + 1),
    )


def _secret(v: Column, key: str, invert: bool) -> Column:
    def whole(body: Column) -> Column:
        lower, upper = (permute_text(body, [_DIGITS + x], key, "secret", invert) for x in ("abcdef", "ABCDEF"))
        head = F.substr(v, F.lit(1), F.length(v) - F.length(body))
        return F.concat(head, F.when(body.rlike("[a-f]"), lower).otherwise(upper))

    return let(F.regexp_extract(v, "[0-9A-Fa-f]+$", 0), whole)


def _iban(v: Column, key: str, invert: bool) -> Column:
    def whole(compact: Column) -> Column:
        land = F.substr(compact, F.lit(1), F.lit(2))
        body = permute_text(F.substr(compact, F.lit(5)), [_DIGITS, _UPPER], key, "iban", invert)

        def checked(b: Column) -> Column:
            check = F.lpad((98 - _mod97(F.concat(land, F.lit("00"), b))).cast("string"), 2, "0")
            return _fill(v, F.concat(land, check, b), "[A-Z0-9]")

        return F.when(_mod97(compact) == 1, let(body, checked))

    return let(F.replace(v, F.lit(" "), F.lit("")), whole)


def _date(v: Column, key: str, invert: bool) -> Column:
    """The day as a number is permuted, so one date in several forms keeps one pseudonym."""

    def whole(parts: Column) -> Column:
        year_first = F.length(parts[0]) == 4
        one, two = parts[1].cast("int"), F.when(year_first, parts[2]).otherwise(parts[0]).cast("int")
        # after the year comes the month; else a dot or a number above 12 says that the day is first
        day_first = ~year_first & ((two > 12) | F.contains(v, F.lit(".")) & (one <= 12))
        month = F.when(year_first | day_first, one).otherwise(two)
        day = F.when(year_first | day_first, two).otherwise(one)
        year = F.when(year_first, parts[0]).otherwise(parts[2]).cast("int")
        date = F.try_to_date(
            F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0")),
            "yyyy-MM-dd",
        )
        number = F.date_diff(date, F.lit("0001-01-01").cast("date")).cast("long")
        inside = (number >= 0) & (number < _DAYS)
        padded = (F.length(parts[1]) == 2) & (F.length(F.when(year_first, parts[2]).otherwise(parts[0])) == 2)
        mark = F.regexp_extract(v, "[^0-9]", 0)

        def shown(d: Column) -> Column:
            mm, dd = F.date_format(d, "MM"), F.date_format(d, "dd")
            mm = F.when(padded, mm).otherwise(F.month(d).cast("string"))
            dd = F.when(padded, dd).otherwise(F.dayofmonth(d).cast("string"))
            yyyy = F.date_format(d, "yyyy")
            return F.when(year_first, F.concat(yyyy, mark, mm, mark, dd)).otherwise(
                F.when(day_first, F.concat(dd, mark, mm, mark, yyyy)).otherwise(F.concat(mm, mark, dd, mark, yyyy))
            )

        # near days stay near ones, so that pseudonyms of usual dates are usual dates
        past = number - _FIRST_NEAR
        near = (past >= 0) & (past < _NEAR[0] * _NEAR[1])
        other = number - F.when(past >= 0, _NEAR[0] * _NEAR[1]).otherwise(0)
        moved = permute_number(other, _FAR, key, "far date", invert)
        moved = let(moved, lambda m: m + F.when(m >= _FIRST_NEAR, _NEAR[0] * _NEAR[1]).otherwise(0))
        moved = F.when(near, permute_number(past, _NEAR, key, "date", invert) + _FIRST_NEAR).otherwise(moved)
        return F.when(inside, let(F.date_add(F.lit("0001-01-01").cast("date"), moved.cast("int")), shown))

    return let(F.split(v, "[^0-9]"), whole)


def _ipv4(v: Column, key: str, invert: bool) -> Column:
    octets = F.transform(F.split(v, r"\."), lambda o: o.cast("int"))

    def whole(o: Column) -> Column:
        number = F.aggregate(o, F.lit(0).cast("long"), lambda s, x: s * 256 + x)
        moved = permute_number(number, (1 << 16, 1 << 16), key, "ipv4", invert)

        def shown(n: Column) -> Column:
            return F.concat_ws(".", *[F.pmod(F.floor(n / (1 << s)), F.lit(256)).cast("string") for s in (24, 16, 8, 0)])

        return F.when(F.forall(o, lambda x: x < 256), let(moved, shown))

    return let(octets, whole)


def _ssn(v: Column, key: str, invert: bool) -> Column:
    """Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999."""
    area, group, serial = (F.split(v, "-")[i].cast("long") for i in range(3))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    place = area - 1 - (area > 666).cast("long")
    moved = permute_number((place * 99 + group - 1) * 9999 + serial - 1, (898 * 99, 9999), key, "ssn", invert)

    def shown(n: Column) -> Column:
        place = F.floor(n / (99 * 9999))
        return F.format_string(
            "%03d-%02d-%04d",
            (place + 1 + (place >= 665).cast("long")).cast("long"),
            (F.pmod(F.floor(n / 9999), F.lit(99)) + 1).cast("long"),
            (F.pmod(n, F.lit(9999)) + 1).cast("long"),
        )

    return F.when(valid, let(moved, shown))


def _card(v: Column, key: str, invert: bool) -> Column:
    def whole(digits: Column) -> Column:
        body = permute_text(F.substr(digits, F.lit(1), F.length(digits) - 1), [_DIGITS], key, "card", invert)

        def checked(b: Column) -> Column:
            check = F.pmod(10 - F.pmod(_luhn_sum(F.concat(b, F.lit("0"))), F.lit(10)), F.lit(10))
            return _fill(v, F.concat(b, check.cast("string")))

        valid = F.length(digits).between(13, 19) & (F.pmod(_luhn_sum(digits), F.lit(10)) == 0)
        return F.when(valid, let(body, checked))

    return let(_digits(v), whole)


def _phone(v: Column, key: str, invert: bool) -> Column:
    """The country code stays; valid with 7 to 15 digits."""

    def whole(head: Column) -> Column:
        rest = F.substr(v, F.length(head) + 1)
        moved = permute_text(_digits(rest), [_DIGITS], key, "phone", invert)
        return F.when(F.length(_digits(v)).between(7, 15), F.concat(head, _fill(rest, moved)))

    return let(F.regexp_extract(v, r"^\+[0-9]{1,3}(?=[^0-9])", 0), whole)


_REPLACE = {
    "email": _email,
    "secret": _secret,
    "iban": _iban,
    "date": _date,
    "ipv4": _ipv4,
    "ssn": _ssn,
    "card": _card,
    "phone": _phone,
}


# What a form that has taken in groups behind a value stands for first.
_LIKELY = rf"^(?:{_IBAN_LISTED}|{_PRINTED})"
# What it stands for last, when it is a row of digits: four groups of four, or a phone number.
_SHORTER = [r"^[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])", f"^(?:{_NATIONAL})"]


def _choices(value: Column) -> Column:
    """What a found form may stand for: its likely part, all of it, then shorter parts."""

    def parts(patterns: list[str]) -> Column:
        found = F.array(*[F.regexp_extract(value, p, 0) for p in patterns])
        return F.filter(found, lambda v: v != "")

    return F.concat(parts([_LIKELY]), F.array(value), parts(_SHORTER))


_FOUND = "struct<kind:string,pseudonym:string,used:int>"


def _replace(value: Column, key: str, invert: bool) -> Column:
    """`kind, pseudonym, used` of a found form: of its first choice and kind whose check holds, and its length."""

    def tried(choice: Column, kind: str) -> Column:
        made = _REPLACE[kind](choice, key, invert)
        whole = lambda m: F.struct(F.lit(kind).alias("kind"), m.alias("pseudonym"), F.length(choice).alias("used"))
        return F.when(
            choice.rlike(f"^(?:{FORMS[kind]})$"), let(made, lambda m: F.when(m.isNotNull(), whole(m).cast(_FOUND)))
        )

    return F.aggregate(
        _choices(value),
        F.lit(None).cast(_FOUND),
        lambda found, choice: F.coalesce(found, *[tried(choice, kind) for kind in FORMS]),
    )


def _read(region: Column, key: str, invert: bool) -> Column:
    """`text, kinds` of a region: its forms from left to right, a form that fails its check is passed by.

    The region is cut before every place where a form starts, also inside another form; `skip`
    characters of the next cuts belong to the last value.
    """
    cuts = F.arrays_zip(
        F.split(region, f"(?={_ANY})", -1).alias("cut"),
        F.regexp_extract_all(region, F.lit(f"(?=({_ANY}))"), F.lit(1)).alias("value"),
    )
    start = F.struct(
        F.lit("").alias("text"), F.array().cast("array<string>").alias("kinds"), F.lit(0).alias("skip")
    )

    def put(acc: Column, at: Column) -> Column:
        length = F.length(at["cut"])

        def after(made: Column) -> Column:
            used = F.coalesce(made["used"], F.lit(0))
            return F.struct(
                F.concat(acc["text"], F.coalesce(made["pseudonym"], F.lit("")), F.substr(at["cut"], used + 1)).alias("text"),
                F.when(made.isNull(), acc["kinds"]).otherwise(F.concat(acc["kinds"], F.array(made["kind"]))).alias("kinds"),
                F.greatest(used - length, F.lit(0)).alias("skip"),
            )

        covered = F.struct(
            F.concat(acc["text"], F.substr(at["cut"], acc["skip"] + 1)).alias("text"),
            acc["kinds"].alias("kinds"),
            F.greatest(acc["skip"] - length, F.lit(0)).alias("skip"),
        )
        return F.when(acc["skip"] > 0, covered).otherwise(let(_replace(at["value"], key, invert), after))

    return F.aggregate(cuts, start, put)


def pseudonymize(docs: DataFrame, key: str, invert: bool = False) -> DataFrame:
    """`docs(text, ...)` with every personal value of its texts replaced, and `pii_kinds`, the list of
    the replaced kinds in order.

    Values: mail addresses (all but the top domain), hexadecimal secrets named as such, account
    numbers (remainder 97), dates of the years 1 to 9999 (of 1900 to 2099 and others, each among
    themselves), IPv4 addresses, social security numbers, card
    numbers (check digit) and phone numbers (7 to 15 digits). What fails its check stays, and values
    that start inside it are still found. Of an account number with further groups behind, the part
    of its country's length counts, if its remainder is right. Card numbers of 13 to 19 digits are
    found without gaps, in the groups that cards are printed in, and as all of a row of groups of
    two digits or more with one mark between them. A value is permuted among the values of its form
    by a keyed Feistel network, so an equal value gets an equal pseudonym in every document, two
    values never share one, and who has the key gets the values back with `invert`. The exception is
    digits next to a value that with it could be read as another one: a check over both can come
    true by chance, before or after. Letters outside a-z stay as they are.

    Texts without digit and without `@` are passed on unread. A null text stays null with a null
    list, an empty one stays empty; other columns are not touched, a column named `pii_kinds` is
    replaced. Every row stays.
    """
    found = F.when(F.col("text").rlike("[0-9@]"), F.regexp_extract_all("text", F.lit(_REGION), F.lit(0)))
    made = F.transform(found, lambda region: _read(region, key, invert))
    gaps = F.split("text", _REGION, -1)
    held = "_made"
    while held.lower() in [c.lower() for c in docs.columns]:
        held += "_"
    rebuilt = F.array_join(
        F.transform(gaps, lambda gap, i: F.concat(gap, F.coalesce(F.get(held, i)["text"], F.lit("")))), ""
    )
    kinds = F.flatten(F.transform(held, lambda m: m["kinds"]))
    some = F.size(held) > 0
    return (
        docs.withColumn(held, made)
        .withColumn("pii_kinds", F.when(some, kinds).when(F.col("text").isNotNull(), F.array().cast("array<string>")))
        .withColumn("text", F.when(some, rebuilt).otherwise(F.col("text")))
        .drop(held)
    )
