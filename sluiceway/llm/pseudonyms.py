"""Format-preserving pseudonyms for personal numbers, dates and mail names, by keyed Feistel networks in SQL functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
# A value is marked off by these two characters; the first is escaped in texts that have it.
_ESCAPE, _OPEN, _KEPT = "\x01", "\x02", "\x03"

# The written forms.
MAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9](?:[A-Za-z0-9-]*\.)+[A-Za-z]{2,}"
# Lengths of the countries' IBANs; their account parts may have letters.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
IBAN = "(?<![A-Za-z0-9])(?:" + "|".join(
    f"(?:{'|'.join(names.split())})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, names in IBAN_LENGTHS.items()
) + ")(?![A-Za-z0-9])"
OTHER_IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[0-9]{4}){2,6}(?: ?[0-9]{1,3})?(?![A-Za-z0-9])"
PHONE = r"(?<![A-Za-z0-9])(?:\+1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[.-])[2-9][0-9]{2}[.-][0-9]{4}(?![A-Za-z0-9])"
ABROAD = r"(?<![A-Za-z0-9+])\+[1-9][0-9]{0,2}(?:[ .()-]{1,2}[0-9]{1,9}){1,6}(?![A-Za-z0-9])"
# Bare digit groups are a number only if no other groups stand beside them, which may be a card's.
SPACED = r"(?<![A-Za-z0-9.+-])(?<![0-9] )[2-9][0-9]{2} [2-9][0-9]{2} [0-9]{4}(?![A-Za-z0-9]|[ -][0-9])"
JOINED = r"(?<![A-Za-z0-9+])\+1[2-9][0-9]{2}[2-9][0-9]{6}(?![A-Za-z0-9])"
JOINED_ABROAD = r"(?<![A-Za-z0-9+])\+[2-9][0-9]{7,14}(?![A-Za-z0-9])"
ADDRESS = r"(?<![A-Za-z0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[A-Za-z0-9])"
SOCIAL = r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])"
YEAR_FIRST = r"(?<![A-Za-z0-9./-])[0-9]{4}([-/])[0-9]{1,2}\1[0-9]{1,2}(?![A-SU-Za-z0-9]|T(?![0-9]{2}))"
DAY_FIRST = r"(?<![A-Za-z0-9./-])[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}(?![A-Za-z0-9])"
#: With strokes the month comes first, unless the first number is none.
STROKES = r"(?<![A-Za-z0-9./-])[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}(?![A-Za-z0-9])"
# A run of digit groups that may hold cards: it stops before what is another kind of value, or has a letter behind it.
_NOT_CARD = r"(?![0-9]{1,3}\.[0-9]|[0-9]{1,2}/[0-9]|[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(?![0-9-])|[0-9]{3}-[0-9]{2,3}-[0-9]{4}(?![0-9-]))"
CARDS = rf"(?<![A-Za-z0-9-])(?=[0-9](?:[ -]?[0-9]){{12}})[0-9]++(?![A-Za-z])(?:[ -]{_NOT_CARD}[0-9]++(?![A-Za-z]))*+"
#: A card's digit groups, in this order of preference; beside these a single group of 13 to 19 digits.
CARD_FORMS = ((4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3))

#: Country codes of telephone numbers; others have three digits.
_CODE = r"^\+(7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"

#: 146,097 days, a whole Gregorian cycle, which is 189 times 773.
FIRST_DAY, DAYS = "1800-01-01", (189, 773)


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is evaluated once, however often ``then`` uses it: a lambda's variable."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _long(c: Column) -> Column:
    return c.cast("long")


class Keyed:
    """Permutations under one key; the same for equal values everywhere. ``back`` undoes them."""

    def __init__(self, key: str, back: bool = False):
        self.key, self.back = key, back

    def _draw(self, kind: str, turn: Column, half: Column, extra: Column | None = None) -> Column:
        """60 bits from the key, the kind, the round and the other half."""
        parts = [F.lit(f"{self.key}|{kind}|"), turn.cast("string"), F.lit("|"), half.cast("string")]
        parts += [F.lit("|"), extra.cast("string")] if extra is not None else []
        return _long(F.conv(F.substring(F.sha2(F.concat(*parts, F.lit(f"|{self.key}")), 256), 1, 15), 16, 10))

    def _turns(self) -> Column:
        return F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1)) if self.back else F.sequence(F.lit(1), F.lit(ROUNDS))

    def pair(self, kind: str, left: Column, right: Column, a: Column, b: Column) -> Column:
        """A permutation of ``[0, a) x [0, b)``: in turn one half is moved by a keyed function of the other."""
        sign = -1 if self.back else 1

        def turn(s: Column, i: Column) -> Column:
            new_left = F.pmod(s["l"] + sign * self._draw(kind, i, s["r"]), a)
            new_right = F.pmod(s["r"] + sign * self._draw(kind, i, s["l"]), b)
            return F.when(i % 2 == 0, F.struct(new_left.alias("l"), s["r"].alias("r"))).otherwise(F.struct(s["l"].alias("l"), new_right.alias("r")))

        return F.aggregate(self._turns(), F.struct(_long(left).alias("l"), _long(right).alias("r")), turn)

    def digits(self, kind: str, value: Column) -> Column:
        """Another string of as many digits (at most 36)."""
        n = F.length(value)
        half = F.floor(n / 2).cast("int")
        size = [_long(F.pow(F.lit(10.0), k.cast("double"))) for k in (half, n - half)]
        left, right = value.substr(F.lit(1), half), value.substr(half + 1, n)
        moved = self.pair(kind, F.when(half > 0, _try(left)).otherwise(F.lit(0)), _try(right), *size)
        return _let(moved, lambda m: F.concat(F.when(half > 0, _padded(m["l"], half)).otherwise(F.lit("")), _padded(m["r"], n - half)))

    def name(self, value: Column, kind: str = "mail") -> Column:
        """Letters and digits to others of their class and place."""
        sign = -1 if self.back else 1
        half = F.ceil(F.length(value) / 2).cast("int")

        def moved(text: Column, i: Column, other: Column) -> Column:
            def one(c: Column, j: Column) -> Column:
                def shifted(first: int, size: int) -> Column:
                    return F.char(F.pmod(F.ascii(c) - first + sign * self._draw(kind, i, other, j), F.lit(size)) + first)

                return F.when(c.between("a", "z"), shifted(97, 26)).when(c.between("A", "Z"), shifted(65, 26)).when(c.between("0", "9"), shifted(48, 10)).otherwise(c)

            return F.when(F.length(text) == 0, text).otherwise(F.array_join(F.transform(F.split(text, ""), one), ""))

        def turn(s: Column, i: Column) -> Column:
            left = F.struct(moved(s["l"], i, s["r"]).alias("l"), s["r"].alias("r"))
            right = F.struct(s["l"].alias("l"), moved(s["r"], i, s["l"]).alias("r"))
            return F.when(i % 2 == 0, left).otherwise(right)

        start = F.struct(value.substr(F.lit(1), half).alias("l"), value.substr(half + 1, F.length(value)).alias("r"))
        return _let(F.aggregate(self._turns(), start, turn), lambda both: F.concat(both["l"], both["r"]))


def _try(c: Column) -> Column:
    return c.try_cast("long")


def _padded(c: Column, n: Column) -> Column:
    return F.lpad(c.cast("string"), n, F.lit("0"))


def _only_digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _refilled(form: Column, digits: Column) -> Column:
    """The form with its digits replaced in order."""

    def filled(new: Column) -> Column:
        def one(i: Column) -> Column:
            c = form.substr(i, F.lit(1))
            return F.when(c.between("0", "9"), new.substr(F.length(_only_digits(form.substr(F.lit(1), i))), F.lit(1))).otherwise(c)

        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(form)), one), "")

    return _let(digits, filled)


def luhn(number: Column) -> Column:
    """The sum that a card number makes a multiple of ten."""

    def summed(digits: Column) -> Column:
        def one(i: Column) -> Column:
            d = F.coalesce(digits.substr(F.length(digits) - i + 1, F.lit(1)).try_cast("int"), F.lit(0))
            return F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

        return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), one), F.lit(0), lambda s, x: s + x)

    return _let(number, summed)


def _card(form: Column, k: Keyed) -> Column:
    """Another card in the same form, null where the number is not valid."""

    def checked(head: Column) -> Column:
        rest = F.pmod(F.lit(0) - luhn(F.concat(head, F.lit("0"))), F.lit(10))
        return _refilled(form, F.concat(head, rest.cast("string")))

    def new(d: Column) -> Column:
        head = F.concat(d.substr(F.lit(1), F.lit(1)), k.digits("card", d.substr(F.lit(2), F.length(d) - 2)))
        return F.when(luhn(d) % 10 == 0, _let(head, checked))

    return _let(_only_digits(form), new)


def _cards(run: Column, k: Keyed) -> Column:
    """The pieces of a run of digit groups, ``new`` and ``old``: its cards in the usual forms, each wherever it begins, and
    without any the whole run if that is a card. Which groups make one depends on the run's form and on valid sums only,
    so a card has the same pseudonym whatever numbers stand beside it."""
    parts = F.struct(F.split(run, "[ -]").alias("g"), F.regexp_extract_all(run, F.lit("[ -]"), F.lit(0)).alias("s"))

    def found(p: Column) -> Column:
        groups, seps = p["g"], p["s"]

        def span(i: Column) -> Column:
            """How many groups from here are a card, 0 if none are."""

            def fits(form: tuple[int, ...]) -> Column:
                sizes = F.transform(F.slice(groups, i + 1, len(form)), lambda g: F.length(g))
                return F.when(sizes == F.array(*map(F.lit, form)), len(form))

            forms = F.array(*map(fits, CARD_FORMS), F.when(F.length(F.get(groups, i)).between(13, 19), 1))
            valid = F.filter(forms, lambda n: n.isNotNull() & (luhn(F.array_join(F.slice(groups, i + 1, n), "")) % 10 == 0))
            usual = F.length(F.get(groups, i)).isin(4, *range(13, 20))
            return F.when(usual, F.coalesce(F.get(valid, F.lit(0)), F.lit(0))).otherwise(0)

        def written(i: Column, n: Column) -> Column:
            before = F.zip_with(F.slice(groups, i + 1, n - 1), F.slice(seps, i + 1, n - 1), lambda g, s: F.concat(g, s))
            return F.concat(F.array_join(before, ""), F.get(groups, i + n - 1))

        def chosen(spans: Column) -> Column:
            def one(n: Column, i: Column) -> Column:
                before = F.slice(spans, F.greatest(i - 3, F.lit(1)), F.least(i, F.lit(4)))
                covered = F.exists(F.transform(before, lambda m, j: m + j - F.size(before)), lambda over: over > 0)

                def made(m: Column) -> Column:
                    after = F.coalesce(F.get(seps, i + m - 1), F.lit(""))
                    return F.struct((n > 0).alias("card"), written(i, m).alias("old"), after.alias("after"))

                return F.when(~covered, _let(F.greatest(n, F.lit(1)), made))

            some = F.exists(spans, lambda n: n > 0)
            few = F.struct((F.length(_only_digits(run)).between(13, 19)).alias("card"), run.alias("old"), F.lit("").alias("after"))
            return F.when(some, F.filter(F.transform(spans, one), lambda a: a.isNotNull())).otherwise(F.array(few))

        def replaced(made: Column) -> Column:
            none = F.lit(None).cast("string").alias("new")
            return F.array(F.struct(F.when(made["card"], _card(made["old"], k)).alias("new"), made["old"].alias("old")), F.struct(none, made["after"].alias("old")))

        spans = F.transform(groups, lambda _, i: span(i))
        return F.flatten(F.transform(_let(spans, chosen), replaced))

    return _let(parts, found)


def _phone(v: Column, k: Keyed) -> Column:
    d = F.right(_only_digits(v), F.lit(10))
    left = (_try(d.substr(1, 3)) - 200) * 800 + _try(d.substr(4, 3)) - 200
    m = k.pair("phone", left, _try(d.substr(7, 4)), F.lit(640_000), F.lit(10_000))
    new = _let(m, lambda m: F.concat((F.floor(m["l"] / 800) + 200).cast("string"), (m["l"] % 800 + 200).cast("string"), _padded(m["r"], F.lit(4))))
    before = F.when(v.startswith("+1"), F.lit("1")).otherwise(F.lit(""))
    return _refilled(v, F.concat(before, new))


def _after(code_form: str, least: int) -> Callable[[Column, Keyed], Column]:
    """A telephone number with the country code that the form takes from it, and at least so many other digits."""

    def new(v: Column, k: Keyed) -> Column:
        code = F.regexp_extract(v, code_form, 1)
        d = _only_digits(v)
        n = F.length(d) - F.length(code)
        return F.when(n.between(least, 14), _refilled(v, F.concat(code, k.digits("abroad", d.substr(F.length(code) + 1, n)))))

    return new


def _address(v: Column, k: Keyed) -> Column:
    o = [F.coalesce(_try(F.split_part(v, F.lit("."), F.lit(i))), F.lit(999)) for i in range(1, 5)]
    valid = (o[0] < 256) & (o[1] < 256) & (o[2] < 256) & (o[3] < 256)
    m = k.pair("address", o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65_536), F.lit(65_536))

    def dotted(m: Column) -> Column:
        return F.concat_ws(".", *((F.floor(m[h] / 256) if i == 0 else m[h] % 256).cast("string") for h in ("l", "r") for i in (0, 1)))

    return F.when(valid, _let(m, dotted))


def _social(v: Column, k: Keyed) -> Column:
    area, group, serial = (F.coalesce(_try(v.substr(a, n)), F.lit(0)) for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    index = area - 1 - (area > 666).cast("int")
    m = k.pair("social", index * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999))

    def written(m: Column) -> Column:
        new = F.floor(m["l"] / 99) + 1
        return F.concat_ws("-", _padded(new + (new >= 666).cast("int"), F.lit(3)), _padded(m["l"] % 99 + 1, F.lit(2)), _padded(m["r"] + 1, F.lit(4)))

    return F.when(valid, _let(m, written))


#: Dates walk on until they fit their form: at most so often, which for the rarest form fails once in 10**21.
_STEPS = 200


def _date(v: Column, k: Keyed) -> Column:
    """A date as it is written: a year of four digits first, or last with the day before it, or with strokes the month,
    unless the first number is none. Each part keeps its number of digits: the permutation is repeated until the new date
    has such parts."""

    def parted(p: Column) -> Column:
        first_year = F.length(p[0]) == 4
        day_first = ~first_year & (v.contains(".") | (_try(p[0]) > 12))
        month = F.when(first_year | day_first, p[1]).otherwise(p[0])
        day = F.when(first_year, p[2]).when(day_first, p[0]).otherwise(p[1])
        return F.struct(
            F.when(first_year, p[0]).otherwise(p[2]).alias("y"), month.alias("m"), day.alias("d"), first_year.alias("first_year"),
            day_first.alias("day_first"), F.regexp_extract(v, "[^0-9]", 0).alias("mark"),
        )

    def dated(n: Column) -> Column:
        return F.date_add(F.lit(FIRST_DAY).cast("date"), n.cast("int"))

    def moved(w: Column) -> Column:
        n = F.datediff(F.concat_ws("-", w["y"], F.lpad(w["m"], 2, "0"), F.lpad(w["d"], 2, "0")).try_cast("date"), F.lit(FIRST_DAY).cast("date"))

        def step(s: Column, _: Column) -> Column:
            def fitting(m: Column) -> Column:
                at = m["l"] * DAYS[1] + m["r"]
                fits = ((F.length(w["m"]) == 2) | (F.month(dated(at)) < 10)) & ((F.length(w["d"]) == 2) | (F.day(dated(at)) < 10))
                told = ~w["day_first"] | (w["mark"] == ".") | (F.day(dated(at)) > 12)
                return F.struct(at.alias("n"), F.coalesce(fits & told, F.lit(False)).alias("done"))

            turned = k.pair("date", F.floor(s["n"] / DAYS[1]), s["n"] % DAYS[1], F.lit(DAYS[0]), F.lit(DAYS[1]))
            return F.when(s["done"], s).otherwise(_let(turned, fitting))

        start = F.struct(_long(n).alias("n"), F.lit(False).alias("done"))
        walked = F.when(n.between(0, DAYS[0] * DAYS[1] - 1), F.aggregate(F.sequence(F.lit(1), F.lit(_STEPS)), start, step))
        return F.struct(w.alias("w"), F.when(walked["done"], dated(walked["n"])).alias("date"))

    def written(s: Column) -> Column:
        w = s["w"]
        mm, dd, yy = _padded(F.month(s["date"]), F.length(w["m"])), _padded(F.day(s["date"]), F.length(w["d"])), _padded(F.year(s["date"]), F.lit(4))
        parts = F.when(w["first_year"], F.array(yy, mm, dd)).when(w["day_first"], F.array(dd, mm, yy)).otherwise(F.array(mm, dd, yy))
        return F.when(s["date"].isNotNull(), F.concat(parts[0], w["mark"], parts[1], w["mark"], parts[2]))

    return _let(_let(_let(F.split(v, "[^0-9]"), parted), moved), written)


def _mod97(text: Column) -> Column:
    """The remainder of a number in which letters stand for 10 to 35."""

    def step(r: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code > 64, (r * 100 + code - 55) % 97).otherwise((r * 10 + code - 48) % 97)

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _reformed(form: Column, chars: Column) -> Column:
    """The form with its letters and digits replaced in order, blanks staying."""

    def filled(new: Column) -> Column:
        def one(i: Column) -> Column:
            c = form.substr(i, F.lit(1))
            at = F.length(F.replace(form.substr(F.lit(1), i), F.lit(" "), F.lit("")))
            return F.when(c == " ", c).otherwise(new.substr(at, F.lit(1)))

        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(form)), one), "")

    return _let(chars, filled)


def _iban(v: Column, k: Keyed) -> Column:
    def new(d: Column) -> Column:
        country, check, body = d.substr(1, 2), d.substr(3, 2), d.substr(F.lit(5), F.length(d))

        def checked(moved: Column) -> Column:
            digits = F.lpad((98 - _mod97(F.concat(moved, country, F.lit("00")))).cast("string"), 2, "0")
            return _reformed(v, F.concat(country, digits, moved))

        moved = F.when(body.rlike("^[0-9]+$"), k.digits("iban", body)).otherwise(k.name(body, "iban"))
        return F.when(_mod97(F.concat(body, country, check)) == 1, _let(moved, checked))

    return _let(F.replace(v, F.lit(" "), F.lit("")), new)


def _mail(v: Column, k: Keyed) -> Column:
    at = F.instr(v, "@")
    return F.concat(k.name(v.substr(F.lit(1), at - 1)), v.substr(at, F.length(v)))


KINDS: list[tuple[list[str], Callable[[Column, Keyed], Column]]] = [
    ([MAIL], _mail), ([IBAN, OTHER_IBAN], _iban), ([PHONE, SPACED, JOINED], _phone), ([ABROAD], _after(r"^\+([0-9]+)", 6)),
    ([JOINED_ABROAD], _after(_CODE, 5)), ([ADDRESS], _address), ([SOCIAL], _social), ([YEAR_FIRST, DAY_FIRST, STROKES], _date),
]


def _either(patterns: list[str]) -> str:
    return "|".join(p.replace("([-/])", "(?<sep>[-/])").replace("\\1", "\\k<sep>") for p in patterns)


def _alone(patterns: list[str]) -> str:
    return f"^(?:{_either(patterns)})$"


# What a value can begin with is looked at first, which passes over letters quickly.
_ANY = f"(?:(?=[0-9+(])(?:{_either([p for forms, _ in KINDS[2:] for p in forms] + [CARDS])})|(?=[A-Z]{{2}}[0-9])(?:{IBAN}|{OTHER_IBAN})|{MAIL})"


def pseudonymised(text: Column, key: str, back: bool = False) -> Column:
    """A struct of the text with its valid values replaced, ``text``, and how many there were, ``n``."""
    k = Keyed(key, back)
    # Only texts with a digit or an at sign can have a value; for others all that follows is null.
    able = F.when(text.rlike("[0-9@]"), text)
    safe = F.replace(able, F.lit(_ESCAPE), F.lit(_ESCAPE + _KEPT))
    pieces = F.split(F.regexp_replace(safe, f"({_ANY})", f"{_ESCAPE}{_OPEN}$1{_ESCAPE}{_OPEN}"), f"{_ESCAPE}{_OPEN}")

    def new(v: Column) -> Column:
        out = F.lit(None).cast("string")
        for forms, make in reversed(KINDS):
            # Cut out of its text, a value is alone, so looking around it always succeeds.
            out = F.when(v.rlike(_alone(forms)), make(v, k)).otherwise(out)
        return out

    def piece(p: Column, i: Column) -> Column:
        plain = F.array(F.struct(F.lit(None).cast("string").alias("new"), p.alias("old")))
        one = F.array(F.struct(new(p).alias("new"), p.alias("old")))
        return F.when(i % 2 == 0, plain).when(p.rlike(_alone([p for forms, _ in KINDS for p in forms])), one).otherwise(_cards(p, k))

    def both(made: Column) -> Column:
        joined = F.array_join(F.transform(made, lambda m: F.coalesce(m["new"], m["old"])), "")
        count = F.size(F.filter(made, lambda m: m["new"].isNotNull()))
        plain = F.replace(joined, F.lit(_ESCAPE + _KEPT), F.lit(_ESCAPE))
        return F.struct(plain.alias("text"), count.cast("long").alias("n"))

    return _let(F.flatten(F.transform(pieces, piece)), lambda made: F.when(made.isNotNull(), both(made)))


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", back: bool = False) -> DataFrame:
    """Per row: id, ``text`` with pseudonyms, ``n_values`` replaced.

    Card numbers (Luhn, also beside other numbers), IBANs (modulo 97), telephone numbers, internet addresses, social
    security numbers, dates from 1800 to 2199 that the calendar has, and the names in mail addresses become others of the
    same format and validity; what is not valid stays. A value becomes the same pseudonym in every document, different
    values of a kind and format stay different, and ``back`` with the key restores them; only in a run of digit groups
    where a pseudonym makes other groups valid too, ``back`` may take those for the card. All is SQL functions in one projection:
    no shuffle, no Python. Null texts stay null with no value, as empty ones stay empty; repeated rows stay repeated
    rows; other columns are not read; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("given"))
    rows = rows.withColumn("r", pseudonymised(F.col("given"), key, back))
    return rows.select(F.col("id").alias(id_col), F.coalesce("r.text", "given").alias("text"), F.coalesce("r.n", F.lit(0).cast("long")).alias("n_values"))
