import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs in every column, empty, blank and very long texts, repeated rows, repeated keys, clashing columns."""
    long = " ".join(f"word{i % 977} and{i % 31}" for i in range(60_000))
    prose = "the quick brown fox jumps over the lazy dog while seven wizards quietly judge vexing boxes of liquor near the old stone bridge"
    rows = [
        (1, prose, "en", "a", 1),
        (1, prose, "en", "a", 1),
        (1, "another text with the same key as the one before it", "en", "a", 2),
        (2, None, None, None, None),
        (3, "", "en", "b", 0),
        (4, "", "en", "b", 0),
        (5, " \n\t ", "fr", "b", 4),
        (None, prose + " tonight", "en", "c", 3),
        (None, None, None, "c", None),
        (6, long, "en", "c", len(long)),
        (7, "1234 5678 !!! ??? 99", "fr", None, 20),
        (8, "été déjà vu là-bas où naît le français très élégant " * 4, "fr", "a", 9),
        (9, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" x', "en", "a", 9),
    ]
    clash = ["shard", "Slot", "copy", "POSITION", "host", "verdict", "kept", "n_words", "lang_pred", "items", "class_id", "a.b", "__found", "text_crc32", "secret_spans", "start"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for i, c in enumerate(clash):
        docs = docs.withColumn(c, docs["n_chars"] * i)
    return docs


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
