import datetime

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, class string, words string, score double, keep_id int, digest date"


@pytest.fixture()
def odd_docs(spark):
    """Rows with nulls everywhere, empty, very long and repeated texts, and columns whose names the operators use themselves."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    day = datetime.date(2024, 1, 1)
    more = ("en", "s", 1, 7, "c", "w", 0.5, 3, day)
    none = (None,) * 9
    rows = [(1, "One two three four five six seven eight nine ten eleven twelve.", *more), (2, None, *more), (3, "", *none), (4, "  \t\n", *more),
            (5, long, *more), (6, long, *none), (7, "one  two\tthree four five six seven eight nine ten eleven twelve.", *more),
            (8, "One two three four five six seven eight nine ten eleven twelve.", *none), (8, "One two three four five six seven eight nine ten eleven twelve.", *none),
            (None, "no id at all but a text that is long enough for windows", *more), (None, None, *none), (None, "", *none),
            (9, "!!! ... ???", *more), (10, "ü", *more), (11, "word", *none), (12, "\U0001F600 émoji ﬁ ½", *more)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
