import datetime
import random

from pyspark.sql import functions as F

from revlens.llm import pii

NAMES = pii.Pseudonyms(b"key")
BACK = pii.Pseudonyms(b"key", back=True)
VALUES = ["4111 1111 1111 1111", "5500-0000-0000-0004", "378282246310005", "+1 (386) 555-3733", "386-555-3733", "123-45-6789",
          "61.131.143.218", "2024-02-29", "31.12.1999", "7/4/2021", "25/12/2020", "Ann.Lee99@mail8.example.com",
          "24be64439e3e49cf46b2d7c90f3602a3d0b907ff", "GB82 WEST 1234 5698 7654 32"]
LEFT = ["4111111111111112", "9914969043960559", "300.1.2.3", "2024-02-30", "000-12-3456", "1.2.3.4.5", "0123456789", "v 12.5",
        "GB82 WEST 1234 5698 7654 33", "(186) 555-3733"]


def test_feistel_is_a_permutation_with_an_inverse():
    f = pii.Feistel(b"k")
    for n in (1, 2, 10, 97, 1000):
        assert sorted(f.permute(x, n, "t") for x in range(n)) == list(range(n))
        assert all(f.invert(f.permute(x, n, "t"), n, "t") == x for x in range(n))
    big = 26 ** 40
    assert f.invert(f.permute(12345, big, "t"), big, "t") == 12345


def test_values_keep_their_format_and_come_back():
    for v in VALUES:
        text = f"see {v}, then"
        new, counts = NAMES(text)
        assert sum(counts.values()) == 1 and v not in new, v
        assert len(new) == len(text) or "ip" in counts or "date" in counts
        assert NAMES(new)[1] == counts
        assert BACK(new)[0] == text
        assert NAMES(f"{v} again {v}###")[0] == f"{new[4:-6]} again {new[4:-6]}###"


def test_invalid_numbers_stay():
    for v in LEFT:
        assert NAMES(f"see {v}, then") == (f"see {v}, then", {}), v


def test_every_date_round_trips():
    rnd = random.Random(1)
    for _ in range(300):
        d = datetime.date.fromordinal(rnd.randint(pii.FIRST_DAY, pii.LAST_DAY))
        for text in (d.isoformat(), f"{d.day}.{d.month}.{d.year}", f"{d.month:02d}/{d.day:02d}/{d.year}"):
            new = NAMES(text)[0]
            back = BACK(new)[0]
            assert back.replace("/0", "/").replace(".0", ".").lstrip("0") == text.replace("/0", "/").replace(".0", ".").lstrip("0")


def test_layouts_of_one_number_stay_linked():
    a, b = NAMES("+1 (386) 555-3733")[0], NAMES("386-555-3733")[0]
    assert [c for c in a if c.isdigit()][1:] == [c for c in b if c.isdigit()]


def test_cards_and_accounts_beside_other_digits_and_capitals():
    card, iban = "4111 1111 1111 1111", "GB82 WEST 1234 5698 7654 32"
    for before, value, after, kind in [
            ("card ", card, " 12/25", "card"), ("card ", card, " 123", "card"), ("5 ", card, " end", "card"), ("12-", card, "-99 1", "card"),
            ("no ", "378282246310005", " 1234", "card"), ("7 ", "6011 1111 1111 1117", " 123", "card"),
            ("pay ", iban, " EUR 500", "iban"), ("pay ", iban, " PLEASE PAY", "iban"), ("AB12 ", iban, " DEUTDEFF 77", "iban")]:
        text = before + value + after
        new, counts = NAMES(text)
        assert counts == {kind: 1} and new.startswith(before) and new.endswith(after) and value not in new, (text, new)
        assert BACK(new)[0] == text
        assert NAMES(value)[0] == new[len(before):len(new) - len(after)]
    assert NAMES(f"{card} 5500 0000 0000 0004")[1] == {"card": 2}


def test_runs_of_digits_and_capitals_come_back():
    rnd = random.Random(3)
    found = 0
    for _ in range(1500):
        parts = [rnd.choice(["4", "65", "6011", "5500", "34", ""]) + "".join(rnd.choices("0123456789", k=rnd.choice([2, 3, 4, 4]))) for _ in range(9)]
        words = [rnd.choice(["GB", "DE", "QQ"]) + "%02d" % rnd.randint(2, 98)] + [rnd.choice(["AB", "1234", "77", "X9"]) for _ in range(9)]
        text = rnd.choice(" -").join(parts) + "; " + " ".join(words)
        new, counts = NAMES(text)
        assert BACK(new) == (text, counts)
        found += counts.get("card", 0) + counts.get("iban", 0)
    assert found > 300


def test_numbers_with_plus_and_country_code_never_stay():
    for v in ("+1 (017) 555-7713", "+1 217-155-7713", "+1.017.055.7713"):
        new, counts = NAMES(f"call {v}, now")
        assert counts == {"phone": 1} and v not in new and new.startswith("call +1")
        assert BACK(new) == (f"call {v}, now", counts)


def test_edge_cases(spark, make_docs):
    assert pii.pseudonymise(make_docs([]), "k").collect() == []
    docs = make_docs([(1, None), (2, ""), (3, "x " * 100_000 + VALUES[0]), (4, VALUES[6]), (4, VALUES[6]), (None, "plain")])
    docs = docs.withColumns({"counts": F.lit(1), "pii_text": F.lit("y")})
    out = pii.pseudonymise(docs, "k")
    assert out.columns == [*docs.columns, "pii_counts"]
    rows = sorted(out.collect(), key=lambda r: r.doc_id or 0)
    assert rows[0].text == "plain" and rows[1].text is None and rows[1].pii_counts == {} and rows[2].text == ""
    assert rows[3].pii_counts == {"card": 1} and rows[4].text == rows[5].text != VALUES[6]
    back = pii.pseudonymise(out.drop("pii_counts"), "k", back=True, counts=None)
    assert sorted((r.doc_id or 0, r.text or "") for r in back.collect()) == sorted((r.doc_id or 0, r.text or "") for r in docs.collect())
    assert pii.pseudonymise(docs, "other").where("doc_id = 4").first().text != rows[4].text
