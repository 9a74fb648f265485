"""Which forms the surrogates cover: telephone numbers without a plus, letters of other scripts."""

import re

from merchlake.llm import surrogates


def replaced(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["text"] for r in surrogates.replace_personal_data(rows, "key").orderBy("doc_id").collect()]


def test_telephone_numbers_without_a_plus(spark):
    numbers = ["(415) 555-0132", "415-555-0132", "415.555.0132", "1-415-555-0132", "+1 415 555 0132", "1 (415) 555-0132", "020 7946 0958",
               "(020) 7946 0958", "01 23 45 67 89", "030/1234567", "0171-5550132", "0044 20 7946 0958", "+44 20 7946 0958", "00 44 20 7946 0958"]
    out = replaced(spark, [f"Call {n}, or not." for n in numbers])
    digits = []
    for n, text in zip(numbers, out, strict=True):
        new = text.removeprefix("Call ").removesuffix(", or not.")
        assert re.sub(r"\d", "d", new) == re.sub(r"\d", "d", n) and new != n, (n, text)
        digits.append(re.sub(r"\D", "", new))
    # Spellings of one number: with and without the country code, with 00 for the plus.
    assert len({d[-10:] for d in digits[:6]}) == 1 and digits[3] == digits[4] == digits[5] and digits[3][0] == "1"
    assert digits[6] == digits[7] and digits[6][0] == "0"
    assert digits[11] == digits[13] == "00" + digits[12]


def test_numbers_that_are_no_telephone_numbers(spark):
    texts = ["on 01.02.2024 1030 rows", "order 4155550132", "2024-01-02 10.30", "1.415.555", "00 01 02 03 04 05", "pi 3.141 592 6535"]
    assert replaced(spark, texts) == texts


def test_two_numbers_side_by_side(spark):
    out = replaced(spark, ["415-555-0132 415-555-0133 012-34-5678 4111 1111 1111 1111"])[0]
    assert re.fullmatch(r"\d{3}-\d{3}-\d{4} \d{3}-\d{3}-\d{4} \d{3}-\d\d-\d{4} \d{4} \d{4} \d{4} \d{4}", out)
    assert not re.search("0132|0133|5678|1111", out)


def test_letters_of_every_script_are_replaced(spark):
    names = ["é" * 12, "ё" * 12, "山" * 12, "م" * 12, "ά" * 12, "ש" * 12, "ひ" * 12, "कि" * 6, "é" * 6]
    for name, text in zip(names, replaced(spark, [f"to {n}@mail.com" for n in names]), strict=True):
        got = re.fullmatch(r"to (.{12})@[a-z]{4}\.example", text)[1]
        assert not any(c in got for c in name if c != "e") and name not in text


def test_more_values_than_their_form_has_room_for(spark):
    """Every one-letter name of a domain and 6,000 of the 10,000 numbers of five digits: surrogates grow and stay distinct."""
    letters = [f"{c}@mail.com" for c in "abcdefghijklmnopqrstuvwxyzé"]
    numbers = [f"+{n}" for n in range(12_000, 18_000)]
    values = [("email", x) for x in letters] + [("phone", n[1:]) for n in numbers]
    given = surrogates.assign(spark.createDataFrame(values, "kind string, value string"), "key").collect()
    assert {(r["kind"], r["value"]) for r in given} == set(values)
    assert len({(r["kind"], r["surrogate"]) for r in given}) == len(values)
    assert not {(r["kind"], r["surrogate"]) for r in given} & set(values)
    out = replaced(spark, [f"to {x} now" for x in letters])
    assert len(set(out)) == len(letters)
    assert all(re.fullmatch(r"to [a-z]{1,4}@[a-z]{4}\.example now", t) for t in out)


def test_longer_surrogates_are_written_whole(spark, monkeypatch):
    monkeypatch.setattr(surrogates, "CROWDED", 1)
    drawn = surrogates.candidate
    monkeypatch.setattr(surrogates, "candidate", lambda kind, value, key, attempt: drawn(kind, value, key, attempt + 2))
    out = replaced(spark, ["call +49 30 123456 now", "pay 4111 1111 1111 1111 now"])
    assert re.fullmatch(r"call \+4\d \d\d \d{8} now", out[0]) and re.fullmatch(r"pay (\d{4} ){3}\d{6} now", out[1])


def test_columns_of_any_name_stay(spark):
    names = ["doc_id", "text", "_count", "row", "a.b", "_text", "_key", "_lookup"]
    data = [(1, "to me@mail.com", 7, "r", "d", "t", "k", "l"), (2, "nothing", None, None, None, None, None, None), (3, None, 1, "x", "y", "z", "k", "l")]
    docs = spark.createDataFrame(data, "doc_id long, text string, _count int, row string, `a.b` string, _text string, _key string, _lookup string")
    out = surrogates.replace_personal_data(docs, "key", count_col="n_entities")
    assert out.columns == [*names, "n_entities"]
    got = {r[0]: tuple(r) for r in out.collect()}
    assert got[1][2:] == (7, "r", "d", "t", "k", "l", 1) and "me@mail" not in got[1][1]
    assert got[2] == (*data[1], 0) and got[3] == (*data[2], 0)
