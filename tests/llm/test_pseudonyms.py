import random

from tidegrain.llm import pseudonyms as ps

KEY = b"a key"


def one(value, key=KEY, undo=False):
    return ps.replaced(value, key, undo)[0]


def test_feistel_is_a_permutation():
    for n in (1, 2, 7, 100, 999):
        moved = [ps.permute(KEY, "k", n, i) for i in range(n)]
        assert sorted(moved) == list(range(n))
        assert [ps.permute(KEY, "k", n, i, undo=True) for i in moved] == list(range(n))
    even = [ps.permute(KEY, "k", 500, i, lambda x: x % 2 == 0) for i in range(0, 500, 2)]
    assert sorted(even) == list(range(0, 500, 2))
    assert [ps.permute(KEY, "k", 999, i) for i in range(999)] != [ps.permute(b"other", "k", 999, i) for i in range(999)]


def test_each_kind_stays_valid_and_can_be_undone():
    rng = random.Random(1)
    values = ["4337166598464399", "4337 1665 9846 4399", "378282246310005", "3782 822463 10005", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "123-45-6789", "+1 (988) 555-2485", "988-555-2485",
              "+49 30 12345678", "42.144.35.254", "2001-02-28", "1999/12/31", "28.02.2001", "5/6/1987", "12/25/2001", "anna.b99@mail4.example.com"]
    values += [f"{rng.randrange(1, 224)}.{rng.randrange(256)}.{rng.randrange(256)}.{rng.randrange(256)}" for _ in range(40)]
    for v in values:
        new = one(v)
        assert new != v and len(ps.replaced(v, KEY)[1]) == 1, v
        assert len(ps.replaced(new, KEY)[1]) == 1 and one(new, undo=True) == v, (v, new)
    shape = lambda s: "".join("9" if c.isdigit() else c for c in s)
    assert all(shape(one(v)) == shape(v) for v in values[:4] + values[6:10] + values[11:14])
    card = one(values[0])
    assert ps.luhn(card[:-1]) == int(card[-1]) and card[0] == "4"


def test_equal_values_stay_linked():
    assert one("4337 1665 9846 4399").replace(" ", "") == one("pay 4337166598464399!")[4:-1]
    assert one("call +1 (988) 555-2485 4337166598464399 x") == f"call {one('+1 (988) 555-2485')} {one('4337166598464399')} x"
    assert one("7 4337166598464399") == "7 " + one("4337166598464399")
    assert one("tel. 988.555.2485").replace(".", "")[4:] == one("(988) 555-2485").translate({ord(c): None for c in "() -"})


def test_punctuation_of_telephone_numbers_and_order_of_dates():
    digits = lambda s: "".join(c for c in s if c.isdigit())
    same = [("+1 415 555 2671", "+14155552671", "+1 415 5552671", "(415) 555-2671"), ("+7 495 123 45 67", "+74951234567", "+7 (495) 1234567"), ("+49 30 12345678", "+493012345678"), ("+353 1 234 5678", "+35312345678"),
            ("+1 115 555 2671", "+11155552671")]
    for key in (KEY, *(b"key %d" % i for i in range(20))):
        for layouts in same:
            new = [one(v, key) for v in layouts]
            assert len({digits(x)[-10:] for x in new}) == 1, (layouts, new)
            assert [one(x, key, undo=True) for x in new] == list(layouts)
    assert one("+353 1 234 5678").startswith("+353") and one("+74951234567").startswith("+7")
    linked = 0
    for i in range(300):
        iso, us = f"{1950 + i % 100}-{1 + i % 12:02d}-{13 + i % 16}", f"{1 + i % 12:02d}/{13 + i % 16}/{1950 + i % 100}"
        new, y = one(us), one(iso)
        assert one(new, undo=True) == us and int(new[3:5]) > 12
        if int(y[8:]) > 12:
            assert new == f"{y[5:7]}/{y[8:]}/{y[:4]}"
            linked += 1
    assert linked > 150


def test_invalid_and_other_strings_stay():
    for v in ("4337166598464390", "0000000000000000", "999.1.1.1", "1.2.3", "1.2.3.4.5", "2001-02-30", "31/31/2001", "1899-01-01", "000-12-3456", "123-45-678", "DE00 3704 0044 0532 0130 00", "x4337166598464399",
              "(188) 555-2485", "a@b", "@example.com", "n = 12345678", "ü", "", " "):
        assert one(v) == v and not ps.replaced(v, KEY)[1], v


def test_valid_values_beside_or_inside_failed_readings():
    cases = [("BE68 5390 0754 7034 EUR", "BE68 5390 0754 7034", "iban"), ("BE68539007547034 2024", "BE68539007547034", "iban"), ("ES91 2100 0418 4502 0005 1332 USD", "ES91 2100 0418 4502 0005 1332", "iban"),
             ("2025 4337 1665 9846 4399", "4337 1665 9846 4399", "card"), ("AB12 4337 1665 9846 4399", "4337 1665 9846 4399", "card"), ("2001-02-28T10:00:00Z", "2001-02-28", "date")]
    for text, value, kind in cases:
        for key in (KEY, *(b"key %d" % i for i in range(40))):
            new, spans = ps.replaced(text, key)
            assert [(text[a:b], k) for a, b, k in spans] == [(value, kind)], text
            assert value not in new and one(new, key, undo=True) == text, (text, key)


def test_neighbouring_values_round_trip():
    rng = random.Random(9)
    cards = [(body := str(rng.randrange(10**14, 10**15))) + str(ps.luhn(body)) for _ in range(30)]
    grouped = [" ".join(c[i : i + 4] for i in range(0, 16, 4)) for c in cards]
    for i in range(300):
        text = " ".join(rng.choice([*grouped, "2025", "1234", "AB12", "BE68 5390 0754 7034", "EUR", "+1 988 555 2485", "2001-02-28"]) for _ in range(6))
        new = ps.replaced(text, b"%d" % i)[0]
        assert one(new, b"%d" % i, undo=True) == text, text


def test_spans_point_at_the_originals():
    text = "é: anna@x.org, 42.144.35.254; 2001-02-28."
    _, spans = ps.replaced(text, KEY)
    assert [(text[a:b], k) for a, b, k in spans] == [("anna@x.org", "email"), ("42.144.35.254", "ip"), ("2001-02-28", "date")]


def test_documents(spark):
    rows = [(1, "card 4337166598464399"), (2, None), (3, ""), (None, "4337166598464399"), (1, "card 4337166598464399"), (4, "a " * 50_000 + "42.144.35.254"), (5, "no numbers")]
    df = spark.createDataFrame([(i, t, "s", t) for i, t in rows], "doc_id long, text string, spans string, kind string")
    got = ps.counted(ps.pseudonymize(df, KEY)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=repr) == sorted(((i, None if t is None else one(t)) for i, t in rows), key=repr)
    assert sorted(r["n_replaced"] for r in got) == [0, 0, 0, 1, 1, 1, 1] and sum(r["n_card"] for r in got) == 3
    back = ps.pseudonymize(ps.pseudonymize(df, KEY), KEY, undo=True)
    assert sorted(((r["doc_id"], r["text"]) for r in back.collect()), key=repr) == sorted(rows, key=repr)
    assert ps.pseudonymize(df.limit(0), KEY).collect() == []


def test_real_documents_round_trip(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    new = ps.pseudonymize(docs, KEY)
    assert new.where("size(spans) > 0").count() > 5
    assert ps.pseudonymize(new, KEY, undo=True).select("doc_id", "text").exceptAll(docs).count() == 0
