"""Format-preserving pseudonyms for personal data by keyed Feistel networks.

Values are found by one regular expression and checked (Luhn for cards, mod 97
for IBANs, the calendar for dates, the issuing rules for social-security numbers,
forms and number plan for phones). A checked value is replaced by its image under a keyed permutation of
all values of its format: a Feistel network whose halves are strings, each
position shifted within its own alphabet (digits stay digits, letters letters),
check digits computed anew; addresses and dates are permuted as numbers. So the
result is again a valid value of the same format, equal values get equal
pseudonyms in all documents, and different ones of a format stay different.
Round functions are SHA-256 with the key; whoever holds the key can invert them.

| kind | permuted | kept |
|-|-|-|
| email | letters and digits before the @ | domain, punctuation |
| card (13-19 digits, Luhn) | all digits but the last, which becomes the check digit | length, separators |
| iban (mod 97) | account part; check digits anew | country, length, spaces |
| ssn | nine digits, to one that may be issued | separators |
| phone | digits after the country code; +1 numbers within the number plan, or outside it | country code, separators |
| ip | 32 bits | dotted form |
| date (1900-2099) | day number | order of fields, separators |
| key | letters and digits of access keys and long hex tokens | prefix, length |

Everything is DataFrame expressions on the row, with no shuffle: texts without a
digit or @ are passed by; others are split at the matches and joined again. A
match that fails its check is split again: of the runs of its tokens that are
values, the first and longest ones are taken (a card beside its code or expiry,
numbers in a row). There is one network for strings and one for numbers, which
get what each format permutes; so the plan stays small.

Defined cases: a null text stays null; an empty one empty; values that fail
their check and hold no other stay as they are; repeated rows and null ids give a row each; other
columns are ignored by ``pseudonymize`` and kept by ``pseudonymized``. Dates
whose order can be read both ways are read month first, so a day-first and a
month-first date may meet in one string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Secret of the permutations. Set your own and keep it.
KEY = "set-your-own-key"
#: Rounds of a network (even), and most steps of a walk back into a format's values.
ROUNDS, WALK = 8, 64

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Length of an IBAN by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "PT ST", 26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV",
    29: "BR EG PS QA UA", 30: "JO KW", 31: "MT SC", 32: "LC",
}


def _iban_of_country(n: int, countries: str) -> str:
    groups, rest = divmod(n - 4, 4)
    return rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}" + (f" ?[A-Z0-9]{{{rest}}}" if rest else "")


_IBANS = "|".join(_iban_of_country(n, c) for n, c in IBAN_LENGTHS.items())
#: Formats, in the order in which they are tried at a place.
FORMATS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9][A-Za-z0-9._%+\-]*+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,24}",
    "key": r"(?<![A-Za-z0-9])(?:A[KS]IA[A-Z0-9]{16}|(?=[a-f]*[0-9])(?=[0-9]*[a-f])[0-9a-f]{32,}"
           r"|(?=[A-F]*[0-9])(?=[0-9]*[A-F])[0-9A-F]{32,})(?![A-Za-z0-9])",
    "iban": rf"(?<![A-Za-z0-9])(?:{_IBANS}|[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?)(?![A-Za-z0-9])",
    "ip": rf"(?<![0-9A-Za-z.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9A-Za-z]|\.[0-9])",
    "date": r"(?<![0-9])(?:[0-9]{4}([-/.])[0-9]{2}\1[0-9]{2}|[0-9]{2}([-/.])[0-9]{2}\2[0-9]{4})(?![0-9])",
    "ssn": r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])",
    "card": r"(?<![0-9])[0-9](?:[ \-]?[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z])(?:(?:\+?1[ .\-]?)?\([0-9]{3}\) ?[0-9]{3}[ .\-][0-9]{4}|\+1[ .\-]?[0-9]{3}[ .\-][0-9]{3}[ .\-][0-9]{4}"
             r"|(?:1[ .\-])?[2-9][0-9]{2}[ .\-][2-9][0-9]{2}[ .\-][0-9]{4}"
             r"|\+[2-9][0-9]{0,2}(?:[ .\-]?\(?[0-9]{2,4}\)?){2,5})(?![0-9])",
}
#: Digits with blanks and hyphens between them, as far as they go: one card, or several numbers.
RUN = r"(?<![0-9])[0-9](?:[ \-]?[0-9]){12}(?:[0-9 \-]*[0-9])?"
#: How a card is written among other numbers: in one, or in equal groups.
GROUPED = (r"^[2-6](?:[0-9]{12,18}|[0-9]{3}([ \-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?:\1[0-9]{3})?|[0-9]{3}([ \-])[0-9]{6}\2[0-9]{4,5}"
           r"|[0-9]{3}([ \-])[0-9]{4}\3[0-9]{5})$")
#: Characters of the longest value inside a match.
LONGEST = 45
ANY = "|".join(f"(?:{p})" for p in (FORMATS | {"card": RUN}).values()).replace(r"([-/.])[0-9]{2}\1", r"(?<s>[-/.])[0-9]{2}\k<s>") \
    .replace(r"([-/.])[0-9]{2}\2", r"(?<t>[-/.])[0-9]{2}\k<t>")

_ALPHABETS = {"d": "0123456789", "D": "23456789", "l": "abcdefghijklmnopqrstuvwxyz",
              "u": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "h": "0123456789abcdef", "H": "0123456789ABCDEF"}
_EPOCH, _DAYS = "1900-01-01", 73049  # to 2099-12-31


def _bits(text: Column) -> Column:
    """48 bits of a text's digest."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("long")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _classes(value: Column) -> Column:
    for pattern, name in (("[a-z]", "l"), ("[A-Z]", "u"), ("[0-9]", "d"), ("[^lud]", "-")):
        value = F.regexp_replace(value, pattern, name)
    return value


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _as_column(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def permute_string(key: str, kind, value: Column, classes: Column) -> Column:
    """A keyed permutation of the strings that have these classes at their positions.

    A round digests the half that stays, once, and each position's shift is a
    digest of that with its number; so long strings cost their length.
    """
    kind = _as_column(kind)
    half = F.floor(F.length(value) / 2).cast("int")

    def shifted(target: Column, kinds: Column, base: Column) -> Column:
        def one(c: Column, j: Column) -> Column:
            def moved(letters: Column) -> Column:
                at = F.pmod(F.instr(letters, c) - 1 + _bits(F.concat_ws("|", base, j)), F.length(letters)).cast("int")
                return F.when((letters != "") & (c != ""), F.substr(letters, at + 1, F.lit(1))).otherwise(c)
            alphabets = F.create_map(*[F.lit(x) for pair in _ALPHABETS.items() for x in pair])
            return _let(F.coalesce(F.try_element_at(alphabets, F.substr(kinds, j + 1, F.lit(1))), F.lit("")), moved)
        return F.array_join(F.transform(F.split(target, ""), one), "")

    def turn(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        kept = F.when(even, s["r"]).otherwise(s["l"])
        kinds = F.when(even, F.substr(classes, F.lit(1), half)).otherwise(F.substr(classes, half + 1))
        base = F.sha2(F.concat_ws("|", F.lit(key), kind, F.length(value), i, kept), 256)
        new = _let(base, lambda b: shifted(F.when(even, s["l"]).otherwise(s["r"]), kinds, b))
        return _let(new, lambda x: F.struct(F.when(even, x).otherwise(s["l"]).alias("l"), F.when(even, s["r"]).otherwise(x).alias("r")))

    start = F.struct(F.substr(value, F.lit(1), half).alias("l"), F.substr(value, half + 1).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: F.concat(s["l"], s["r"]))


def permute_number(key: str, kind, value: Column, high, low) -> Column:
    """A keyed permutation of 0 .. high * low - 1."""
    kind, high, low = _as_column(kind), _as_column(high).cast("long"), _as_column(low).cast("long")
    start = F.struct(F.floor(value / low).cast("long").alias("h"), F.pmod(value, low).cast("long").alias("l"))

    def turn(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        add = _bits(F.concat_ws("|", F.lit(key), kind, i, F.when(even, s["l"]).otherwise(s["h"])))
        return _let(add, lambda x: F.struct(F.when(even, F.pmod(s["h"] + x, high)).otherwise(s["h"]).alias("h"),
                                            F.when(even, s["l"]).otherwise(F.pmod(s["l"] + x, low)).alias("l")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: s["h"] * low + s["l"])


def _walked(value: Column, step, valid, steps: Column) -> Column:
    """``step`` once, and up to ``steps`` times more until the result is valid: again a permutation of the valid values."""
    return F.aggregate(F.sequence(F.lit(0), steps), value,
                       lambda v, i: F.when((i == 0) | ~valid(v), step(v)).otherwise(v))


def _refilled(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced in order."""
    def one(c: Column, i: Column) -> Column:
        nth = F.length(_digits(F.substr(shape, F.lit(1), i + 1)))
        return F.when(c.rlike("[0-9]"), F.substr(digits, nth, F.lit(1))).otherwise(c)
    return F.array_join(F.transform(F.split(shape, ""), one), "")


def _luhn_sum(digits: Column) -> Column:
    """Of digits without the check digit: each second one from the right, the last included, is doubled."""
    def add(total: Column, x: Column) -> Column:
        d = x["c"].cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(x["i"] % 2 == 0, twice).otherwise(d)
    marked = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""),
                         lambda c, i: F.struct(c.alias("c"), i.alias("i")))
    return F.aggregate(marked, F.lit(0), add)


def _check_digit(digits: Column) -> Column:
    return ((10 - _luhn_sum(digits) % 10) % 10).cast("string")


def _mod97(text: Column) -> Column:
    def add(total: Column, c: Column) -> Column:
        v = F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1
        return F.when(c == "", total).when(v < 10, (total * 10 + v) % 97).otherwise((total * 100 + v) % 97)
    return F.aggregate(F.split(text, ""), F.lit(0), add)


def _issued(digits: Column) -> Column:
    return ~digits.rlike("^(?:000|666|9)|^...00|0000$")


def _planned(digits: Column) -> Column:
    """+1 numbers that fit the plan: 2-9 first in area and exchange."""
    return digits.rlike("^[2-9]..[2-9]")


#: Orders of a date's fields, with what a text looks like that may have them: year first; else month first; else day first.
_ORDERS = (("^[0-9]{4}", "yyyy-MM-dd"), ("^[0-9]{2}[-/]", "MM-dd-yyyy"), ("^[0-9]{2}[-/.]", "dd-MM-yyyy"))


def _day(m: Column) -> Column:
    """struct(order, day): the first order of fields that reads a date of 1900-2099; null if none."""
    plain = F.regexp_replace(m, "[/.]", "-")

    def read(shape: str, order: str) -> Column:
        day = F.when(m.rlike(shape), F.datediff(F.try_to_date(plain, order), F.lit(_EPOCH).cast("date")).cast("long"))
        return _let(day, lambda d: F.when((d >= 0) & (d < _DAYS), F.struct(F.lit(order).alias("order"), d.alias("day"))))

    return F.coalesce(*[read(shape, order) for shape, order in _ORDERS])


def _kind(m: Column) -> Column:
    """The first format that fits all of ``m``, check included; null if none."""
    def checked(d: Column) -> Column:
        plain = F.replace(m, F.lit(" "), F.lit(""))
        checks = {
            "iban": _mod97(F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))) == 1,
            "date": _day(m).isNotNull(), "ssn": _issued(d), "card": _check_digit(F.substr(d, F.lit(1), F.length(d) - 1)) == F.right(d, F.lit(1)),
            "phone": ~m.rlike(r"^\+[2-9]") | F.length(d).between(8, 15),
        }
        out = F.lit(None).cast("string")
        for kind, pattern in reversed(FORMATS.items()):
            fits = m.rlike(f"^(?:{pattern})$")
            out = F.when(fits & checks[kind] if kind in checks else fits, F.lit(kind)).otherwise(out)
        return out
    return _let(_digits(m), checked)


def _secret(kind: Column, m: Column) -> Column:
    """What is permuted: struct(tag, text, classes, number, high, low, order, head); ``text`` or ``number`` is null.

    A phone of another country keeps its first two digits, an IBAN its country, an access key its prefix: the head.
    """
    def of(tag, text, classes, head=""):
        return F.struct(_as_column(tag).alias("tag"), text.alias("text"), classes.alias("classes"), _as_column(head).alias("head"))

    def body(d: Column) -> Column:
        plain = F.replace(m, F.lit(" "), F.lit(""))
        local = F.substring_index(m, "@", 1)
        own, account, rest = F.right(d, F.lit(10)), F.substr(plain, F.lit(5)), F.substr(m, F.lit(5))
        payload = F.substr(d, F.lit(1), F.length(d) - 1)
        digits = lambda x: F.repeat(F.lit("d"), F.length(x))
        access, small, north = m.rlike("^A[KS]IA"), m.rlike("[a-f]"), ~m.rlike(r"^\+[2-9]")
        code = F.substr(d, F.lit(1), F.length(d) - 10)
        return (F.when(kind == "email", of("email", local, _classes(local)))
                .when((kind == "key") & access, of("access", rest, _classes(rest), F.substr(m, F.lit(1), F.lit(4))))
                .when(kind == "key", of(F.when(small, "hexh").otherwise("hexH"), m, F.repeat(F.when(small, "h").otherwise("H"), F.length(m))))
                .when(kind == "iban", of("iban", account, _classes(account), F.substr(plain, F.lit(1), F.lit(2))))
                .when(kind == "ssn", of("ssn", d, digits(d)))
                .when(kind == "card", of("card", payload, digits(payload)))
                .when((kind == "phone") & north & _planned(own), of("phone1", own, F.lit("DddDdddddd"), code))
                .when((kind == "phone") & north, of("phone0", own, digits(own), code))
                .when(kind == "phone", of("phone", F.substr(d, F.lit(3)), digits(F.substr(d, F.lit(3))), F.substr(d, F.lit(1), F.lit(2)))))
    return _let(_digits(m), body)


def _permuted_text(key: str, x: Column) -> Column:
    """The one string network, walked on until the result is of the value's own kind."""
    valid = lambda v: F.when(x["tag"] == "ssn", _issued(v)).when(x["tag"] == "phone0", ~_planned(v)).otherwise(True)
    steps = F.when(x["tag"].isin("ssn", "phone0"), WALK).otherwise(0)
    return F.when(x.isNotNull(), _walked(x["text"], lambda v: permute_string(key, x["tag"], v, x["classes"]), valid, steps))


def _permuted_number(key: str, kind: Column, m: Column, day: Column) -> Column:
    """The one number network: days, walked on while they are beyond the last one, or 32 bits."""
    is_day = kind == "date"
    octets = F.transform(F.split(m, r"\."), lambda x: x.cast("long"))
    value = F.when(is_day, day["day"]).otherwise(F.aggregate(octets, F.lit(0).cast("long"), lambda a, x: a * 256 + x))
    size = lambda a, b: F.when(is_day, a).otherwise(b)
    step = lambda v: permute_number(key, kind, v, size(271, 65536), size(270, 65536))
    return F.when(kind.isin("date", "ip"), _walked(value, step, lambda v: ~is_day | (v < _DAYS), size(WALK, 0)))


def _rendered(kind: Column, m: Column, x: Column, text: Column, day: Column, number: Column) -> Column:
    """The pseudonym in the value's own dress."""
    head = x["head"]
    account = F.concat(head, F.lpad((98 - _mod97(F.concat(text, head, F.lit("00")))).cast("string"), 2, "0"), text)
    spaced = _let(account, lambda new: F.array_join(F.transform(F.split(m, ""), lambda c, i: F.when(c == " ", c).otherwise(F.substr(
        new, F.length(F.replace(F.substr(m, F.lit(1), i + 1), F.lit(" "), F.lit(""))), F.when(c == "", 0).otherwise(1)))), ""))
    date = F.date_add(F.lit(_EPOCH).cast("date"), number.cast("int"))
    orders = F.lit(None).cast("string")
    for _, order in _ORDERS:
        orders = F.when(day["order"] == order, F.date_format(date, order)).otherwise(orders)
    digits = F.when(kind == "card", F.concat(text, _check_digit(text))).otherwise(F.concat(head, text))
    return (F.when(kind == "email", F.concat(text, F.lit("@"), F.substring_index(m, "@", -1)))
            .when(kind == "key", F.concat(head, text))
            .when(kind == "iban", spaced)
            .when(kind == "ip", F.concat_ws(".", *[F.pmod(F.shiftright(number, 8 * i), F.lit(256)).cast("string") for i in (3, 2, 1, 0)]))
            .when(kind == "date", F.replace(orders, F.lit("-"), F.regexp_extract(m, "[-/.]", 0)))
            .otherwise(_refilled(m, digits)))


def _pseudonym(key: str, kind: Column, m: Column) -> Column:
    """The image of ``m`` in its format."""
    def text(s: Column) -> Column:
        day, x = s["day"], s["x"]
        return _let(F.struct(_permuted_text(key, x).alias("text"), _permuted_number(key, kind, m, day).alias("number")),
                    lambda new: _rendered(kind, m, x, new["text"], day, new["number"]))
    return _let(F.struct(_secret(kind, m).alias("x"), F.when(kind == "date", _day(m)).alias("day")), text)


def _pieces(m: Column) -> Column:
    """array of struct(kind, text) that make up a match: the whole, or, if it fails its check, the values inside and what is between."""
    piece = lambda kind, text: F.struct(kind.alias("kind"), text.alias("text"))
    def inner(chars: Column) -> Column:
        apart = lambda i: F.get(chars, i - 1).rlike(r"[ ./\-]")
        text = lambda s, e: F.array_join(F.slice(chars, s, e - s + 1), "")
        size = F.length(m)
        starts = F.filter(F.sequence(F.lit(1), size), lambda i: ~apart(i) & ((i == 1) | apart(i - 1)))
        ends = lambda s: F.filter(F.sequence(s, F.least(size, s + LONGEST)), lambda i: ~apart(i) & ((i == size) | apart(i + 1)))
        sure = lambda t: _let(_kind(t), lambda kind: F.when((kind != "card") | t.rlike(GROUPED), kind))
        span = lambda s, e: F.struct(s.alias("s"), (-e).alias("e"), _let(text(s, e), sure).alias("kind"))
        spans = F.flatten(F.transform(starts, lambda s: F.transform(ends(s), lambda e: span(s, e))))  # the longest of a start first
        none = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<s:int,e:int,kind:string>>").alias("kept"))
        chosen = F.aggregate(F.sort_array(F.filter(spans, lambda x: x["kind"].isNotNull())), none, lambda a, x: F.when(
            x["s"] > a["end"], F.struct((-x["e"]).alias("end"), F.concat(a["kept"], F.array(x)).alias("kept"))).otherwise(a))

        def cut(a: Column) -> Column:
            kept = a["kept"]
            before = lambda i: F.coalesce(-F.get(kept, i - 1)["e"], F.lit(0))
            parts = F.transform(kept, lambda x, i: F.array(
                piece(none_kind, text(before(i) + 1, x["s"] - 1)), piece(x["kind"], text(x["s"], -x["e"]))))
            return F.concat(F.flatten(parts), F.array(piece(none_kind, text(a["end"] + 1, size))))
        return _let(chosen, cut)

    none_kind = F.lit(None).cast("string")
    whole = lambda kind: (F.when(kind.isNotNull() | ~m.rlike(r"[ ./\-]"), F.array(piece(kind, m)))
                          .otherwise(_let(F.split(m, ""), inner)))
    return _let(_kind(m), whole)


def _replaced(df: DataFrame, key: str) -> DataFrame:
    """Adds _new (text) and _found (array of arrays of struct(kind, text)) for the column _text."""
    maybe = F.col("_text").rlike("[0-9@]")
    df = df.withColumn("_matches", F.when(maybe, F.regexp_extract_all("_text", F.lit(ANY), F.lit(0))))
    some = F.size("_matches") > 0
    told = lambda p: F.struct(p["kind"].alias("kind"), F.when(p["kind"].isNull(), p["text"]).otherwise(
        _pseudonym(key, p["kind"], p["text"])).alias("text"))
    df = df.withColumn("_found", F.when(some, F.transform("_matches", lambda m: F.transform(_pieces(m), told))))
    joined = F.transform(F.split("_text", ANY, -1), lambda p, i: F.concat(p, F.coalesce(F.array_join(F.get("_found", i)["text"], ""), F.lit(""))))
    return df.withColumn("_new", F.when(some, F.array_join(joined, "")).otherwise(F.col("_text")))


def pseudonymize(docs: DataFrame, key: str = KEY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text with pseudonyms, and how many values of which kinds were replaced."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    kinds = F.flatten(F.transform(F.coalesce("_found", F.array()), lambda x: F.filter(x["kind"], lambda k: k.isNotNull())))
    return _replaced(rows, key).select("doc_id", F.col("_new").alias("text"), F.size(kinds).cast("long").alias("n_values"),
                                       F.array_join(F.array_sort(F.array_distinct(kinds)), ",").alias("kinds"))


def pseudonymized(docs: DataFrame, key: str = KEY, text_col: str = "text") -> DataFrame:
    """The documents with pseudonyms in their texts; all other columns as they are."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(f"`{text_col}`").alias("_text"))
    return _replaced(whole, key).select(*[
        F.col("_new").alias(c) if c == text_col else F.col(f"_doc.`{c}`") for c in docs.columns])
