"""Pseudonyms against the same permutations written out in Python."""

import hashlib
import re
from datetime import date, timedelta

from promptsieve.llm import pii

KEY = "a key"


def keyed(*parts):
    return int(hashlib.sha256("|".join([KEY, *map(str, parts), KEY]).encode()).hexdigest()[:15], 16)


def feistel(high, low, high_range, low_range, kind):
    for i in range(8):
        if i % 2 == 0:
            high = (high + keyed(kind, i, low)) % high_range
        else:
            low = (low + keyed(kind, i, high)) % low_range
    return high, low


def digits_permuted(digits, kind):
    n, half = len(digits), len(digits) // 2
    high, low = feistel(int(digits[:half]), int(digits[half:]), 10**half, 10 ** (n - half), f"{kind}{n}")
    return f"{high:0{half}d}{low:0{n - half}d}"


def luhn(payload):
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def in_form(match, digits):
    left = iter(digits)
    return "".join(next(left) if c.isdigit() else c for c in match)


def replaced(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in pii.pseudonymise(df, KEY).orderBy("doc_id").collect()]


def test_numbers_against_python(spark):
    card, phone, address, ssn = "4111-1111 11111111", "+1 (017) 555-7713", "97.51.17.173", "123-45-6789"
    got = replaced(spark, [f"a {x}, b" for x in (card, phone, address, ssn)])
    payload = digits_permuted("411111111111111", "card")
    area, rest = feistel(122, 44 * 9999 + 6788, 898, 99 * 9999, "security")
    high, low = feistel(97 * 256 + 51, 17 * 256 + 173, 65536, 65536, "address")
    want = [
        in_form(card, payload + luhn(payload)),
        in_form(phone, "1" + digits_permuted("0175557713", "phone")),
        f"{high // 256}.{high % 256}.{low // 256}.{low % 256}",
        f"{area + (2 if area >= 665 else 1):03d}-{rest // 9999 + 1:02d}-{rest % 9999 + 1:04d}",
    ]
    assert got == [f"a {x}, b" for x in want]


def test_cards_beside_other_digits(spark):
    def new(card):
        digits = re.sub("[^0-9]", "", card)
        payload = digits_permuted(digits[:-1], "card")
        return in_form(card, payload + luhn(payload))

    one, other, spaced = "4111111111111111", "5500-0055-5555-5559", "4111 1111 1111 1111"
    texts = [
        f"{spaced} 123", f"{one} 05/27", f"pay 12 {one} now", f"{spaced} {other}", f"12345 67890 {spaced}", f"{one} 1234567-x",
        f"no {spaced[:-1]}2 123", f"{one}-", "7" * 30_000,
    ]
    cards = [[spaced], [one], [one], [spaced, other], [spaced], [one], [], [], []]
    want = texts[:]
    for i, found in enumerate(cards):
        for c in found:
            want[i] = want[i].replace(c, new(c))
    assert replaced(spark, texts) == want
    # What follows a card is found as before.
    for tail in ("2024-01-15", "15.01.2024", "123-45-6789", "212-555-0123", "212 555 0123", "97.51.17.173"):
        got = replaced(spark, [f"12 {one} {tail}", f"x {tail}"])
        assert got[0] == f"12 {new(one)} {got[1][2:]}" and tail not in got[0]


def test_dates_against_python(spark):
    def new(y, m, d):
        days = (date(y, m, d) - date(1900, 1, 1)).days
        high, low = feistel(days // 270, days % 270, 270, 270, "date")
        return date(1900, 1, 1) + timedelta(days=high * 270 + low)

    n = new(1980, 2, 29)
    got = replaced(spark, ["1980-02-29", "29.02.1980", "02/29/1980", "29/2/1980", "1981-02-29", "31.12.1899"])
    assert got == [n.isoformat(), n.strftime("%d.%m.%Y"), n.strftime("%m/%d/%Y"), f"{n.day}/{n.month}/{n.year}", "1981-02-29", "31.12.1899"]


def test_pseudonyms_are_a_permutation(spark):
    texts = [f"{a:03d}-{b:02d}-0001" for a in range(1, 40) for b in range(1, 20)]
    got = replaced(spark, texts)
    assert len(set(got)) == len(texts) and all(re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}", g) for g in got)


def test_links_and_leaves_the_rest(spark):
    got = replaced(spark, [
        "4111111111111111 and 4111 1111 1111 1111", "4111 1111 1111 1112 300.1.1.1 000-12-3456", None, "",
        "Write to und.34@mail7.example.com and a@b.co.", "UND.34@mail7.example.com", "x" * 30_000,
    ])
    one, other = got[0].split(" and ")
    assert one == other.replace(" ", "") and luhn(one[:-1]) == one[-1] and one != "4111111111111111"
    assert got[1:4] == ["4111 1111 1111 1112 300.1.1.1 000-12-3456", None, ""]
    assert "mail7" not in got[4] and got[4].endswith(".co.") and got[5] in got[4] and got[6] == "x" * 30_000


def test_odd_rows(odd):
    rows = pii.pseudonymise(odd, KEY).collect()
    assert sorted((repr(r.text) for r in rows)) == sorted(repr(r.text) for r in odd.collect())
    assert {r.n_replaced for r in rows} == {0}
    assert pii.pseudonymise(odd.limit(0), KEY).collect() == []


def test_mailboxes_beyond_ascii(spark):
    texts = ["write to jörg@example.com now", "JÖRG@example.com", "anna@bücher.example", "rg@example.com", "имя@почта.рф, ok"]
    got = pii.pseudonymise(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), KEY).orderBy("doc_id").collect()
    found = [r.text for r in got]
    assert all(r.n_replaced == 1 for r in got)
    for text, clear in zip(found, ["jö", "JÖ", "ü", "rg@", "имя"]):
        assert clear not in text
    assert found[0].split()[2] == found[1] and found[3] not in found[0]
