import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, start string, keys int, a int, _text string"

LONG = " ".join(f"word{i % 997} and{i % 31}" for i in range(30_000))
TEXTS = [
    (1, "one two three four five six seven eight nine ten eleven twelve"),
    (2, "one two three four five six seven eight nine ten eleven twelve"),
    (3, ""), (4, None), (5, "   \n\t "), (6, "lone"), (7, LONG), (8, LONG + " tail"), (None, "no id here at all, none"),
    (9, "Mail a.b@c.example.org or +1 (375) 555-4393, card 4242424242424242, ip 10.0.0.255 or 10.0.0.256"),
    (9, "Mail a.b@c.example.org or +1 (375) 555-4393, card 4242424242424242, ip 10.0.0.255 or 10.0.0.256"),
    (10, "x" * 3000), (11, "ΑΣ Straße <|endoftext|> naïve é İstanbul 'll nb \x1c odd 12345 日本語"), (12, "#*$%&|<> a a a a a a a a a a a a"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns whose names an operator uses itself."""
    rows = [(d, t, None if d == 6 else "en", None if d == 5 else f"src{(d or 0) % 3}", None if t is None else len(t), "i", "s", 1, 2, "t") for d, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").toPandas()
