import re
from itertools import product

import llm_helpers as given
import pytest

from docledger.llm.pii import KINDS, Feistel, luhn, pseudonymise, replace_pii, with_pseudonyms

F = Feistel(b"key")


def change(text, key=b"key"):
    return pseudonymise(text, Feistel(key))


@pytest.mark.parametrize("radices", [[7, 5], [2, 3, 4], [10, 10], [26, 10, 2]])
def test_permutation(radices):
    images = {tuple(F.permute(list(v), radices, "t")) for v in product(*map(range, radices))}
    assert images == set(product(*map(range, radices)))


@pytest.mark.parametrize("kind, text", [
    ("card", "4111111111111111"), ("card", "5500 0000 0000 0004"), ("card", "3782-822463-10005"),
    ("phone", "+1 (988) 555-2485"), ("phone", "555-123-4567"), ("phone", "+49 30 901820"), ("phone", "(555) 123-4567"),
    ("ssn", "123-45-6789"), ("ip", "70.123.182.155"), ("ip", "1.2.3.44"), ("email", "Jo.Do-9@mail8.example.com"),
    ("iban", "DE89 3704 0044 0532 0130 00"), ("iban", "GB82WEST12345698765432"),
    ("date", "1984-02-29"), ("date", "31.12.1999"), ("date", "12/25/2001"), ("date", "05/06/2001")])
def test_kinds(kind, text):
    whole = f"x {text}, y"
    new, spans = change(whole)
    assert spans == [(kind, 2, 2 + len(text))]
    value = new[2:-3]
    assert value != text and len(value) == len(text)
    shape = lambda t: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", t)))
    assert shape(value) == shape(text)
    # The pseudonym is valid itself, so nothing tells it from a real one.
    assert [k for k, _, _ in change(value)[1]] == [kind]
    assert change(f"at {text} and {text}")[0] == f"at {value} and {value}"
    assert change(text, b"other")[0] != value
    if kind == "card":
        assert luhn(re.sub("[^0-9]", "", value)) % 10 == 0


@pytest.mark.parametrize("kind, text, after", [
    ("card", "4111 1111 1111 1111", " 12/25"), ("card", "4111111111111111", " 2 items"),
    ("card", "4111-1111-1111-1111", "-22"), ("card", "3782 822463 10005", " 999"),
    ("iban", "ES9121000418450200051332", " EUR"), ("iban", "ES91 2100 0418 4502 0005 1332", " EUR"),
    ("iban", "AT611904300234573201", " IBAN 2 OF 3"), ("iban", "PL61109010140000071219812874", " X"),
    ("iban", "ES9121000418450200051332", " 4111 1111")])
def test_values_before_short_numbers_and_words(kind, text, after):
    new, spans = change(f"x {text}{after}")
    assert spans == [(kind, 2, 2 + len(text))]
    assert new[2:2 + len(text)] == change(text)[0] != text and new.endswith(after)


def test_number_before_a_card():
    first = next(n for n in range(20, 70) if luhn(f"{n}411111111111") % 10 == 0)
    new, spans = change(f"{first} 4111 1111 1111 1111")
    assert spans == [("card", 3, 22)] and new == f"{first} " + change("4111 1111 1111 1111")[0]


def test_equal_values_in_other_shapes_stay_linked():
    digits = lambda t: re.sub("[^0-9]", "", t)
    assert digits(change("4111 1111 1111 1111")[0]) == digits(change("4111111111111111")[0])
    assert digits(change("+1 (988) 555-2485")[0])[1:] == digits(change("988-555-2485")[0])


@pytest.mark.parametrize("text", [
    "", "no numbers", "4111111111111112", "000-12-3456", "666-12-3456", "256.1.1.1", "2001-02-30", "31.02.2001",
    "GB83WEST12345698765432", "135299847", "9566113270", "v1.2.3", "a@b", "12345678901234567890123", "1.2.3.4.5",
    "deadbeef24be64439e3e49cf46b2d7c9", "1111111111111111"])
def test_left_alone(text):
    assert change(text) == (text, [])


def test_distinct_values_stay_distinct():
    values = [f"{a}-{b}-{c}" for a in ("123", "124") for b in ("10", "11") for c in range(1000, 1200)]
    assert len({change(v)[0] for v in values}) == len(values)
    days = [f"2001-{m:02d}-{d:02d}" for m in range(1, 13) for d in range(1, 29)]
    assert len({change(v)[0] for v in days}) == len(days)


def test_tables(spark):
    rows = [(1, "a 555-123-4567 b"), (2, None), (3, ""), (None, "1984-02-29"), (1, "a 555-123-4567 b"),
            (4, "x " * 9000 + "jo@mail.example.com")]
    docs = given.clashing(given.documents(spark, rows))
    got = sorted(replace_pii(docs, b"key").collect(), key=str)
    assert sorted((r.doc_id, r.text) for r in got if r.doc_id) == sorted(
        (i, change(t or "")[0]) for i, t in rows if i)
    for r in got:
        assert r.n_replaced == len(r.spans) == sum(r[f"n_{k}"] for k in KINDS)
    new = with_pseudonyms(docs, b"key")
    assert new.schema.fieldNames() == docs.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in new.collect()) == sorted(
        (str(i), str(None if t is None else change(t)[0])) for i, t in rows)
    assert replace_pii(docs.limit(0), b"key").count() == 0
