import re

import pytest

from brindle.llm import pii

KEY = "test key"
VALUES = {
    "email": ["the.72@mail3.example.com", "THE.72@MAIL3.EXAMPLE.COM", "a@b.org", "x_y+z@sub-1.host.co"],
    "secret": ['token = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b"', "API_KEY: 9233A8ECF7C5B09FE5949719B6B82BC439E9329B"],
    "iban": ["DE89370400440532013000", "GB29 NWBK 6016 1331 9268 19"],
    "date": ["1999-02-28", "2000/02/29", "31.12.2024", "12/31/2024", "31/12/2024", "1.5.1987", "5/1/1987", "1899-12-31", "2150-01-02", "0001-01-01", "9999-12-31"],
    "ipv4": ["169.122.221.182", "8.8.8.8"],
    "ssn": ["123-45-6789"],
    "card": ["4111111111111111", "4111 1111 1111 1111", "378282246310005"],
    "phone": ["+1 (017) 555-7713", "+49 30 901820", "(555) 123-4567", "555-123-4567"],
}
LEFT = [
    "4111111111111112",
    "300.1.2.3",
    "1.2.3.4.5",
    "2023-02-30",
    "0000-12-31",
    "666-12-3456",
    "DE89370400440532013001",
    "version 1.2.3",
    "12345",
    "3.14159",
    "a@b",
    "9233a8ecf7c5b09fe5949719b6b82bc439e9329b",
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def shape(value):
    return re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub("[0-9]", "0", value)))


def replaced(make_docs, texts, key=KEY, invert=False):
    docs = make_docs(list(enumerate(texts)))
    found = pii.pseudonymize(docs, key, invert).orderBy("doc_id").collect()
    return [(r.text, r.pii_kinds) for r in found]


def test_values_keep_their_form(make_docs):
    flat = [(kind, v) for kind, values in VALUES.items() for v in values]
    found = replaced(make_docs, [v for _, v in flat])
    for (kind, value), (made, kinds) in zip(flat, found, strict=True):
        assert kinds == [kind], value
        assert made != value
        digits = re.sub("[^0-9]", "", made)
        if kind in ("email", "phone", "ssn", "card"):
            assert shape(made) == shape(value)
        if kind == "card":
            assert luhn(digits)
        if kind == "email":
            assert made.rsplit(".", 1)[1] == value.rsplit(".", 1)[1]
        if kind == "secret":
            assert re.fullmatch(r'token = "[0-9a-f]{40}"|API_KEY: [0-9A-F]{40}', made)
        if kind == "ipv4":
            assert all(0 <= int(x) < 256 for x in made.split("."))
        if kind == "iban":
            compact = made.replace(" ", "")
            moved = compact[4:] + compact[:4]
            assert int("".join(str(int(c, 36)) for c in moved)) % 97 == 1 and made[:2] == value[:2]
    dates = dict(zip([v for _, v in flat], [m for m, _ in found], strict=True))
    # one day in several forms keeps one pseudonym
    a, b, c = (re.split("[./]", dates[x]) for x in ("31.12.2024", "12/31/2024", "31/12/2024"))
    assert a == c and [a[1], a[0], a[2]] == b
    assert [int(x) for x in re.split("[.]", dates["1.5.1987"])] == [int(re.split("/", dates["5/1/1987"])[i]) for i in (1, 0, 2)]


def test_equal_values_are_linked_and_come_back(make_docs):
    values = [v for vs in VALUES.values() for v in vs]
    texts = [f"Start {v}, again {v}!! und\n{v}." for v in values] + [" | ".join(values), "x" * 50_000 + " 8.8.8.8"]
    made = replaced(make_docs, texts)
    for value, (text, _) in zip(values, made, strict=False):
        own = re.fullmatch(r"Start (.*), again (.*)!! und\n(.*)\.", text)
        assert own and len(set(own.groups())) == 1 and own[1] != value
        assert own[1] in made[len(values)][0]
    back = replaced(make_docs, [t for t, _ in made], invert=True)
    assert [t for t, _ in back] == texts
    other = replaced(make_docs, texts, key="another")
    assert all(a != b for a, b in zip(other, made, strict=True))


def test_what_fails_its_check_stays(make_docs):
    texts = [f"see {v} here" for v in LEFT]
    assert replaced(make_docs, texts) == [(t, []) for t in texts]


def test_odd_texts(make_docs, odd_texts):
    found = pii.pseudonymize(make_docs(odd_texts), KEY)
    assert found.columns == [*make_docs([]).columns, "pii_kinds"]
    rows = [(r.doc_id, r.text) for r in found.collect()]
    assert sorted(rows, key=str) == sorted(odd_texts, key=str)
    assert pii.pseudonymize(make_docs([]), KEY).count() == 0


def test_numbers_are_permuted(spark):
    """Every number has another, each once, and the inverse leads back."""
    numbers = spark.range(17 * 29).withColumnRenamed("id", "n")
    moved = numbers.select("n", pii.permute_number(numbers["n"], (17, 29), KEY, "x").alias("m"))
    back = moved.select("n", "m", pii.permute_number(moved["m"], (17, 29), KEY, "x", True).alias("b")).collect()
    assert sorted(r.m for r in back) == list(range(17 * 29))
    assert all(r.b == r.n for r in back)


@pytest.mark.parametrize("length", [1, 2, 3])
def test_texts_are_permuted(spark, length):
    rows = spark.range(10**length).selectExpr(f"lpad(cast(id as string), {length}, '0') as v")
    moved = {r[0] for r in rows.select(pii.permute_text(rows["v"], ["0123456789"], KEY, "x")).collect()}
    assert len(moved) == 10**length


def test_given_documents(sf_docs):
    """Only texts with values change, and no value with a check is left."""
    found = pii.pseudonymize(sf_docs, KEY).join(sf_docs.selectExpr("doc_id as d", "text as before"), sf_docs["doc_id"] == pii.F.col("d"))
    for r in found.collect():
        assert (r.text != r.before) == bool(r.pii_kinds)
        for mail in re.findall(r"[\w.]+@[\w.]+\.com", r.before):
            assert mail not in r.text
        for card in re.findall(r"\b\d{16}\b", r.before):
            assert (card in r.text) != luhn(card)


OTHERS = ["144.137.247.239", "2020-01-02", "12/31/2024", "123-45-6789", "800-555-1234", "4111 1111 1111 1111", "+49 30 901820"]


@pytest.mark.parametrize("phone", ["+1 (803) 555-5351", "+44 20 7946 0958", "800-555-9876"])
def test_phone_before_another_value(make_docs, phone):
    """Each is replaced as it is alone, and both come back."""
    texts = [f"call {phone} {other} now" for other in OTHERS]
    alone = [text for text, _ in replaced(make_docs, [phone, *OTHERS])]
    made = replaced(make_docs, texts)
    assert [text for text, _ in made] == [f"call {alone[0]} {other} now" for other in alone[1:]]
    assert [kinds[0] for _, kinds in made] == ["phone"] * len(OTHERS) and all(len(k) == 2 for _, k in made)
    assert [text for text, _ in replaced(make_docs, [t for t, _ in made], invert=True)] == texts


IBANS = ["ES91 2100 0418 4502 0005 1332", "BE68 5390 0754 7034", "AT61 1904 3002 3457 3201", "DE89370400440532013000"]


@pytest.mark.parametrize("iban", IBANS)
def test_account_number_before_a_word_or_number(make_docs, iban):
    texts = [f"to {iban} {more}" for more in ("ON Monday", "EUR 20", "1234 5678", "A1", "BIC ABCD 12 34")]
    texts += [f"to {iban} {iban}.", f"{iban} 4111111111111111"]
    alone = replaced(make_docs, [iban, "4111111111111111"])
    made = replaced(make_docs, texts)
    expected = [t.replace(iban, alone[0][0]).replace("4111111111111111", alone[1][0]) for t in texts]
    assert [text for text, _ in made] == expected
    assert [text for text, _ in replaced(make_docs, expected, invert=True)] == texts


def test_values_inside_a_failed_account_number(make_docs):
    values = ["4111 1111 1111 1111", "BE68 5390 0754 7034", "800-555-1234"]
    alone = [text for text, _ in replaced(make_docs, values)]
    heads = ["ID42 CARD", "ES42 CARD", "DE89 3704 0044 0532 0130 01"]
    made = replaced(make_docs, [f"{head} {value}" for head in heads for value in values])
    assert [text for text, _ in made] == [f"{head} {value}" for head in heads for value in alone]


GROUPED = [
    "3782 822463 10005",
    "3782-822463-10005",
    "6212 3456 7890 0000 003",
    "6212-3456-7890-0000-003",
    "3056 930902 5904",
    "621234 5678900000003",
]
ROWS = ["41 111 111111 11 111", "3782-8224-631-0005"]  # in groups that no card is printed in


def test_cards_in_other_groups(make_docs):
    assert all(luhn(re.sub("[ -]", "", card)) for card in GROUPED + ROWS)
    near = ["{}", "no. 12: {}, paid", "{} 2020-01-02", "{} 800-555-1234", "{} and {}"]
    cases = [(card, form) for card in GROUPED for form in near] + [(row, form) for row in ROWS for form in near[:2]]
    texts = [form.replace("{}", card) for card, form in cases]
    alone = dict(zip(GROUPED + ROWS, [text for text, _ in replaced(make_docs, GROUPED + ROWS)], strict=True))
    for card, moved in alone.items():
        assert moved != card and shape(moved) == shape(card) and luhn(re.sub("[ -]", "", moved))
    more = [text for text, _ in replaced(make_docs, ["2020-01-02", "800-555-1234"])]
    made = replaced(make_docs, texts)
    expected = [
        form.replace("{}", alone[card]).replace("2020-01-02", more[0]).replace("800-555-1234", more[1])
        for card, form in cases
    ]
    assert [text for text, _ in made] == expected
    assert [text for text, _ in replaced(make_docs, expected, invert=True)] == texts


def test_cards_among_numbers(make_docs):
    card = "4111 1111 1111 1111"
    alone = replaced(make_docs, [card])[0][0]
    texts = [f"{card} 12", f"{card} 800 555 1234", f"12 {card}", f"7 12 {card}", f"{card} 999"]
    found = [text for text, _ in replaced(make_docs, texts)]
    assert all(text.count(alone) == 1 for text in found)
    assert [found[0], found[2], found[3]] == [f"{alone} 12", f"12 {alone}", f"7 12 {alone}"]
    # a row that is no card may begin with a phone number
    phone, moved = "800 555 1234", replaced(make_docs, ["800 555 1234"])[0][0]
    assert [text for text, _ in replaced(make_docs, [f"{phone} 5679"])] == [f"{moved} 5679"]


def test_days_of_all_years_are_permuted_among_near_and_far_ones(spark):
    days = spark.sql("select explode(sequence(date'1890-01-01', date'1910-12-31')) as d union all "
                     "select explode(sequence(date'2090-01-01', date'2110-12-31')) union all "
                     "select explode(array(date'0001-01-01', date'9999-12-31', date'0999-02-28'))")
    docs = days.selectExpr("cast(d as string) as text", "'born ' || d as _made", "1 as made", "2 as gaps", "3 as `row`")
    made = pii.pseudonymize(docs, KEY)
    assert made.columns == [*docs.columns, "pii_kinds"]
    rows = made.selectExpr("substring(_made, 6) as old", "text as new", "made", "gaps", "`row`").collect()
    assert len({r.new for r in rows}) == len(rows) and all(tuple(r)[2:] == (1, 2, 3) for r in rows)
    near = lambda d: "1900" <= d[:4] <= "2099"
    assert all(len(r.new) == 10 and near(r.old) == near(r.new) for r in rows)
    back = pii.pseudonymize(made.drop("pii_kinds"), KEY, invert=True)
    assert back.where("text <> substring(_made, 6)").count() == 0


def test_key_is_a_setting(spark):
    from brindle.llm.queries import PII_KEY, pii_key

    assert pii_key(spark) == pii_key(spark) and len(pii_key(spark)) == 64
    spark.conf.set(PII_KEY, "mine")
    try:
        assert pii_key(spark) == "mine"
    finally:
        spark.conf.unset(PII_KEY)
