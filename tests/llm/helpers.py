"""Small tables that all operators must take."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"word{i % 977} of{i}" for i in range(60_000))


def sentence(seed: int, words: int = 30) -> str:
    return " ".join(f"w{(seed * 7919 + i * 104729) % 5003}" for i in range(words))


def odd_rows():
    """Nulls in every column, empty, short and very long texts, repeated rows, equal texts."""
    near = sentence(3, 80)
    return [
        (0, sentence(1), "en", "a", 10),
        (1, None, "en", "b", None),
        (2, "", "fr", "a", 0),
        (3, " \n\t ", None, None, 4),
        (4, "one two", "en", "", 7),
        (5, "one  two", "en", "c", 8),
        (None, sentence(2), "de", "a", 1),
        (None, sentence(2), "de", "a", 1),
        (7, near, None, "b", 1),
        (8, near + " tail", "en", "b", 1),
        (8, near + " tail", "en", "b", 1),
        (9, near, "en", "c", 1),
        (10, "1234 5678 !!", "en", "c", 1),
        (11, LONG, "en", "a", len(LONG)),
        (12, "été à la plage ñandú 漢字 かな 🙂 İstanbul   x", "fr", "ü", 5),
    ]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def clashing(frame, *names):
    """The frame with extra columns of the names an operator uses inside."""
    for name in names:
        frame = frame.selectExpr("*", f"'extra' AS `{name}`")
    return frame
