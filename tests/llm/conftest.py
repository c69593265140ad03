import pytest

from tarmac.llm import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship.ensure(spark)


@pytest.fixture()
def documents(spark):
    """``documents(rows, extra)``: a documents table; rows are (doc_id, text) or (doc_id, text, source)."""

    def build(rows, extra=()):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
        for name in extra:
            df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return build


#: Null, empty and blank texts, repeated rows, ties, a null id, a text without ASCII, a very long text.
ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (4, "one"), (5, "one two"), (6, "ONE two"),
    (None, "one two"), (7, "é漢😀 " * 40), (8, "word " * 30000), (9, "a\x0bb\x0cc"),
]

#: Names that operators use for themselves or return.
CLASHING = ["score", "held_out", "predicted", "block", "part", "_fp", "_key", "_text", "_id", "leaks", "quality_score", "taken", "root"]


@pytest.fixture()
def odd():
    return ODD


@pytest.fixture()
def clashing():
    return CLASHING
