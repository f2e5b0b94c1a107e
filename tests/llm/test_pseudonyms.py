import random

import corpus
import pytest

from llm.pseudonyms import EXAMPLE_KEY, PATTERNS, Permutation, Pseudonyms, luhn_digit, op6_pii_pseudonyms, pseudonymized, replace_personal

NAMES, BACK = Pseudonyms(EXAMPLE_KEY), Pseudonyms(EXAMPLE_KEY, inverse=True)


@pytest.mark.parametrize("size", [1, 2, 3, 10, 255, 1000])
def test_permutation_is_one(size):
    p = Permutation(b"k")
    image = [p.permute(v, size, "t") for v in range(size)]
    assert sorted(image) == list(range(size))
    assert [p.restore(v, size, "t") for v in image] == list(range(size))


VALID = {
    "card": ["4785380592391139", "4111 1111 1111 1111", "4111-1111-1111-1111"], "ip": ["152.143.123.131", "8.8.8.8"],
    "date": ["2024-02-29", "31/12/1999", "12.31.1999", "01-02-2003"], "ssn": ["123-45-6789"], "iban": ["GB82 WEST 1234 5698 7654 32"],
    "phone": ["+1 (743) 555-3824", "743-555-3824", "+4915112345678"], "email": ["hein.19@mail5.example.com"],
}


@pytest.mark.parametrize(("kind", "value"), [(k, v) for k, vs in VALID.items() for v in vs])
def test_format_stays_and_the_key_undoes_it(kind, value):
    new, found = pseudonymized(f"see {value}, thanks", NAMES)
    assert found == {kind: 1} and value not in new
    assert pseudonymized(new, NAMES)[1] == {kind: 1}  # it validates again
    assert pseudonymized(new, BACK)[0] == f"see {value}, thanks"
    if kind != "ip":
        shape = lambda s: "".join("9" if c.isdigit() else "A" if c.isupper() else "a" if c.islower() else c for c in s)
        assert shape(new) == shape(f"see {value}, thanks")
    assert set(VALID) == set(PATTERNS)


@pytest.mark.parametrize("text", ["4785380592391138", "999.1.1.1", "1.2.3.4.5", "2024-13-01", "31/02/2020", "000-12-3456", "version 4.0", "12345678901234567890123", "0000000000000000", "a@b", "+1 (123) 555-3824"])
def test_what_does_not_validate_stays(text):
    assert pseudonymized(text, NAMES) == (text, {})


FOLLOWED = [
    ("card", "4111111111111111", " 12/27"), ("card", "4111 1111 1111 1111", " 123"), ("card", "4785380592391139", " 42 items"),
    ("card", "4111-1111-1111-1111", "-123"), ("card", "4111.1111.1111.1111", ""), ("iban", "BE68 5390 0754 7034", " EUR"),
    ("iban", "BE68539007547034", " BIC"), ("iban", "AT61 1904 3002 3457 3201", " BIC CODE"), ("phone", "+44 20 7946 0958", ", ext"), ("phone", "+49 15112345678", "."),
]


@pytest.mark.parametrize(("kind", "value", "after"), FOLLOWED)
@pytest.mark.parametrize("before", ["see ", "no. 42 ", "AB12 "])
def test_a_value_is_replaced_whatever_follows_or_precedes_it(kind, value, after, before):
    text = f"{before}{value}{after}"
    new, found = pseudonymized(text, NAMES)
    assert found == {kind: 1} and value not in new and new.endswith(after)
    assert pseudonymized(new, BACK)[0] == text


def test_the_key_undoes_values_among_numbers():
    rng = random.Random(8)
    for _ in range(3000):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            digits = "".join(rng.choice("0123456789") for _ in range(rng.choice((11, 15, 12))))
            parts.append(rng.choice((str(rng.randrange(10**4)), digits + luhn_digit(digits), "4111 1111 1111 1111", "BE68 5390 0754 7034", "8.8.8.8", "+44 20 7946 0958", "EUR", "123-45-6789")))
        text = rng.choice(" -/.").join(parts)
        assert pseudonymized(pseudonymized(text, NAMES)[0], BACK)[0] == text, text


def test_digits_of_other_scripts_are_not_values():
    text = "\u0664\u0661\u0661\u0661" * 4
    assert pseudonymized(text, NAMES) == (text, {})


def test_equal_values_stay_linked():
    a, b = (pseudonymized(t, NAMES)[0] for t in ("4111 1111 1111 1111", "x 4111111111111111"))
    assert a.replace(" ", "") == b[2:] and luhn_digit(b[2:-1]) == b[-1]
    assert pseudonymized("4111111111111111", Pseudonyms(b"other"))[0] != b[2:]


def test_query_is_undone_by_the_key(spark):
    rows = {r.doc_id: r for r in op6_pii_pseudonyms(spark, corpus.SF).collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{corpus.SF}/documents.parquet").collect()}
    assert rows.keys() == docs.keys()
    for i, r in rows.items():
        assert pseudonymized(r.text, BACK)[0] == docs[i]
        assert (r.n_replaced > 0) == (r.text != docs[i])
    assert sum(r.n_replaced for r in rows.values()) > 0


def test_edges(spark):
    rows = replace_personal(corpus.edge_docs(spark)).collect()
    key = lambda p: (str(p[0]), str(p[1]))
    assert sorted([(r.doc_id, r.text) for r in rows], key=key) == sorted([(r[0], r[1]) for r in corpus.edge_rows()], key=key)
    assert replace_personal(corpus.no_docs(spark)).collect() == []
