"""Tables with nulls in every column, empty and repeated rows, very long texts and clashing extra columns."""

DOCS_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
               "score double, Simhash long, N_WORDS string, spans string, masked_text string, row string, id string")


def docs(spark, texts):
    rows = [(i, t, "en", "s", len(t or ""), .5, 1, "x", "y", "z", "r", "i") for i, t in texts]
    return spark.createDataFrame(rows, DOCS_SCHEMA)


EDGE_TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one two three four five six seven eight nine ten eleven"),
    (5, "one two three four five six seven eight nine ten eleven"),
    (5, "one two three four five six seven eight nine ten eleven"), (None, "words without an id here"),
    (None, None), (6, "é ü 中文 😀 x" * 3), (7, "long " * 60_000), (8, "a" * 50_000),
]
