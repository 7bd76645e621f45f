import pytest

#: Names that an operator might use itself; each is a column beside the real ones.
CLASHES = ["score", "size", "fp", "id", "cell", "component_id", "label_", "y", "n", "k", "start", "block", "target", "taken", "copies", "kept", "host", "path", "rule", "row", "ids", "media", "part", "b", "a"]


def long_text(n: int = 20_000) -> str:
    return " ".join(f"word{i % 977}" for i in range(n))


ODD_DOCS = [
    (1, "the quick brown fox jumps over the lazy dog", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (3, "", None, None),
    (None, "an id is missing here", "en", "b"),
    (5, long_text(), "en", "b"),
    (6, "the same text in two rows of the table", "de", "a"),
    (7, "the same text in two rows of the table", "de", "c"),
    (7, "the same text in two rows of the table", "de", "c"),
    (8, "\t \n ", "fr", ""),
    (9, "x" * 50_000, "fr", "a"),
    (10, "日本語 é ñ ß \U0001f600 ok", "es", "a"),
]


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    """A folder of small tables with every odd case, and one of empty tables."""
    from pyspark.sql import functions as F

    full, empty = str(tmp_path_factory.mktemp("odd")), str(tmp_path_factory.mktemp("empty"))
    extra = {c: F.lit("clash") for c in CLASHES}
    tables = {
        "documents": spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in ODD_DOCS], "doc_id long, text string, lang string, source string, n_chars long").withColumns(extra),
        "labels": spark.createDataFrame([(1, 1, 0), (3, 0, None), (5, 1, 0), (6, 0, 1), (6, 1, 0), (None, 1, 1), (10, None, 1)], "doc_id long, quality int, toxic int"),
        "pages": spark.createDataFrame([(1, "HTTP://WWW.Example.com/en/1?a=1&b=2"), (2, None), (3, ""), (4, "no scheme"), (5, "http://x.net/fr/#top"), (5, "http://x.net/fr/#top"), (None, "ftp://a.org"), (6, "http://" + "long" * 5000 + ".com/p")], "page_id long, url string").withColumns(extra),
        "embeddings": spark.createDataFrame(
            [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, None, 1), (5, [0.0, 0.0], 1), (6, [float("nan"), 1.0], 1), (7, [None, 1.0], 1), (8, [1.0, 0.0], None), (9, [1.0, 0.0], 1), (9, [1.0, 0.0], 1), (None, [1.0, 0.01], 1), (11, [1.0, 0.0, 0.0], 1), (12, [], 1), (13, [float("inf"), 1.0], 1)],
            "vec_id long, embedding array<float>, label int",
        ).withColumns({c: v for c, v in extra.items()}),
    }
    for name, df in tables.items():
        df.coalesce(2).write.parquet(f"{full}/{name}.parquet")
        df.limit(0).write.parquet(f"{empty}/{name}.parquet")
    return full, empty
