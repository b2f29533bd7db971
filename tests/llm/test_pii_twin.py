"""Pseudonyms against a plain Python version: the same values found, checked, permuted and written back."""

import datetime
import hashlib

import pytest
import regex

from tidepool.llm import pii
from tidepool.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ANY = regex.compile(regex.sub(r"\\k<(\w)>", r"(?P=\1)", regex.sub(r"\(\?<(\w)>", r"(?P<\1>", pii.ANY)))
WHOLE = {kind: regex.compile(f"^(?:{p})$") for kind, p in pii.FORMATS.items()}
LETTERS = pii._ALPHABETS
EPOCH = datetime.date(1900, 1, 1)
APART = " ./-"


def bits(text):
    return int(hashlib.sha256(text.encode()).hexdigest()[:12], 16)


def network(kind, value, classes, key=pii.KEY):
    half = len(value) // 2
    sides = [value[:half], value[half:]]
    kinds = [classes[:half], classes[half:]]
    for i in range(pii.ROUNDS):
        base = hashlib.sha256(f"{key}|{kind}|{len(value)}|{i}|{sides[1 - i % 2]}".encode()).hexdigest()
        new = ""
        for j, (c, k) in enumerate(zip(sides[i % 2], kinds[i % 2], strict=True)):
            letters = LETTERS.get(k, "")
            new += letters[(letters.find(c) + bits(f"{base}|{j}")) % len(letters)] if letters else c
        sides[i % 2] = new
    return "".join(sides)


def number_network(kind, value, high, low, key=pii.KEY):
    h, lo = divmod(value, low)
    for i in range(pii.ROUNDS):
        if i % 2 == 0:
            h = (h + bits(f"{key}|{kind}|{i}|{lo}")) % high
        else:
            lo = (lo + bits(f"{key}|{kind}|{i}|{h}")) % low
    return h * low + lo


def classes(text):
    return "".join("l" if "a" <= c <= "z" else "u" if "A" <= c <= "Z" else "d" if "0" <= c <= "9" else "-" for c in text)


def digits(text):
    return regex.sub("[^0-9]", "", text)


def check_digit(payload):
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 - i % 2)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def mod97(text):
    return int("".join(str(int(c, 36)) for c in text) or "0") % 97


def day(m):
    plain = regex.sub("[/.]", "-", m)
    for shape, form, order in (("^[0-9]{4}", "%Y-%m-%d", "ymd"), ("^[0-9]{2}[-/]", "%m-%d-%Y", "mdy"), ("^[0-9]{2}[-/.]", "%d-%m-%Y", "dmy")):
        if regex.search(shape, m):
            try:
                n = (datetime.datetime.strptime(plain, form).date() - EPOCH).days
            except ValueError:
                continue
            if 0 <= n < pii._DAYS:
                return form, n
    return None


def issued(d):
    return not regex.search("^(?:000|666|9)|^...00|0000$", d)


def planned(d):
    return bool(regex.search("^[2-9]..[2-9]", d))


def kind_of(m):
    d, plain = digits(m), m.replace(" ", "")
    checks = {"iban": lambda: mod97(plain[4:] + plain[:4]) == 1, "date": lambda: day(m), "ssn": lambda: issued(d),
              "card": lambda: check_digit(d[:-1]) == d[-1], "phone": lambda: not regex.search(r"^\+[2-9]", m) or 8 <= len(d) <= 15}
    return next((k for k, p in WHOLE.items() if p.search(m) and checks.get(k, lambda: True)()), None)


def walk(value, step, valid):
    value = step(value)
    while not valid(value):
        value = step(value)
    return value


def filled(shape, new):
    new = iter(new)
    return "".join(next(new) if "0" <= c <= "9" else c for c in shape)


def pseudonym(kind, m):
    d = digits(m)
    if kind == "email":
        local, domain = m.split("@")
        return network("email", local, classes(local)) + "@" + domain
    if kind == "key":
        if regex.search("^A[KS]IA", m):
            return m[:4] + network("access", m[4:], classes(m[4:]))
        c = "h" if regex.search("[a-f]", m) else "H"
        return network(f"hex{c}", m, c * len(m))
    if kind == "iban":
        plain = m.replace(" ", "")
        account = network("iban", plain[4:], classes(plain[4:]))
        new = iter(plain[:2] + f"{98 - mod97(account + plain[:2] + '00'):02d}" + account)
        return "".join(c if c == " " else next(new) for c in m)
    if kind == "ip":
        value = 0
        for o in m.split("."):
            value = value * 256 + int(o)
        value = number_network("ip", value, 65536, 65536)
        return ".".join(str(value >> 8 * i & 255) for i in (3, 2, 1, 0))
    if kind == "date":
        form, n = day(m)
        n = walk(n, lambda v: number_network("date", v, 271, 270), lambda v: v < pii._DAYS)
        return (EPOCH + datetime.timedelta(n)).strftime(form).replace("-", regex.search("[-/.]", m)[0])
    if kind == "ssn":
        return filled(m, walk(d, lambda v: network("ssn", v, "d" * 9), issued))
    if kind == "card":
        payload = network("card", d[:-1], "d" * (len(d) - 1))
        return filled(m, payload + check_digit(payload))
    if regex.search(r"^\+[2-9]", m):
        return filled(m, d[:2] + network("phone", d[2:], "d" * (len(d) - 2)))
    own, code = d[-10:], d[:-10]
    if planned(own):
        return filled(m, code + network("phone1", own, "DddDdddddd"))
    return filled(m, code + walk(own, lambda v: network("phone0", v, "d" * 10), lambda v: not planned(v)))


def values(m):
    """(start, end, kind) of the values in a match."""
    kind = kind_of(m)
    if kind or not any(c in APART for c in m):
        return [(0, len(m), kind)] if kind else []
    starts = [i for i, c in enumerate(m) if c not in APART and (i == 0 or m[i - 1] in APART)]
    ends = [i + 1 for i, c in enumerate(m) if c not in APART and (i + 1 == len(m) or m[i + 1] in APART)]
    out = []
    for s in starts:
        if out and s < out[-1][1]:
            continue
        for e in sorted((e for e in ends if s < e <= s + pii.LONGEST + 1), reverse=True):
            kind = kind_of(m[s:e])
            if kind and (kind != "card" or regex.search(pii.GROUPED, m[s:e])):
                out.append((s, e, kind))
                break
    return out


def twin(text):
    out, at, kinds = "", 0, []
    for found in ANY.finditer(text or ""):
        for s, e, kind in values(found[0]):
            out += text[at:found.start() + s] + pseudonym(kind, found[0][s:e])
            at = found.start() + e
            kinds.append(kind)
    return None if text is None else out + text[at:], len(kinds), ",".join(sorted(set(kinds)))


BESIDE = {
    "4111 1111 1111 1111 123": "card", "4111 1111 1111 1111 12/25": "card", "555-223-4567 555-987-6543": "phone,phone",
    "2024 212-555-0199": "phone", "4111 1111 1111 1111 20 30 40 50 60 70 80": "card", "4111-1111-1111-1111 2024-01-15": "card,date",
    "212-555-0199  212-555-0123, 212-555-0177": "phone,phone,phone", "4111111111111111 3782-822463-10005": "card,card",
    "1 4111 1111 1111 1111": "card", "12 34 56 78 90 12 34 56 78 90 12 34 56 78 91": "", "123-45-6789 4111 1111 1111 1111 7": "ssn,card",
    "AT61 1904 3002 3457 3201 EUR": "iban", "4041894974608796": "", "4041 8949 7460 8796 11": "",
    "x" * 70 + "@mail.example.org": "email", "0a" * 100: "key", "9" * 3000: "", "31.12.1999 42.144.35.254": "date,ip",
    "+49 30 1234567 +1 (988) 555-2485": "phone,phone", "1234 " * 200: "", "é 212-555-0199 ü": "phone",
}


def test_values_beside_others(spark):
    rows = [(i, text, kinds) for i, (text, kinds) in enumerate(BESIDE.items())]
    df = spark.createDataFrame(rows, "doc_id long, text string, kinds string")
    got = {r.doc_id: r for r in pii.pseudonymize(df).collect()}
    for i, text, kinds in rows:
        assert (got[i].text, got[i].n_values, got[i].kinds) == twin(text), text
        assert got[i].n_values == len([k for k in kinds.split(",") if k]), text
        assert got[i].kinds == ",".join(sorted({k for k in kinds.split(",") if k})), text


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op3_pii"](spark, SF).collect()
    assert len(got) == len(texts) and sum(r.n_values for r in got) > 0
    for r in got:
        assert (r.text, r.n_values, r.kinds) == twin(texts[r.doc_id])


def test_plan_stays_small(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = pii.pseudonymized(df)._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 41_000 and plan.count("sha2(") <= 4


@pytest.mark.parametrize("kind", ["d", "l", "h"])
def test_network_is_a_permutation(kind):
    import itertools

    every = ["".join(x) for x in itertools.product(LETTERS[kind], repeat=2)]
    assert sorted(network("t", x, kind * 2) for x in every) == sorted(every)
