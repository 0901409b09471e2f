"""Rows that every operator is tried with: nulls, empty and long texts, ties, repeated rows, clashing names."""

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, text_key string, k int, range int, node int"

LONG = " ".join(f"word{i % 997} of the number {i}" for i in range(8000))
PASSAGE = "This passage of more than one hundred bytes stands in several documents, word for word, and again. "
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away into the dark forest."),
    (2, None),
    (3, ""),
    (4, "   \n\t "),
    (5, LONG),
    (6, "The quick brown fox jumps over the lazy dog and runs away into the dark forest."),
    (6, "The quick brown fox jumps over the lazy dog and runs away into the dark forest."),
    (7, "Another version of seven."),
    (7, "A second version of seven, " + PASSAGE),
    (None, "A text without an id. " + PASSAGE),
    (None, None),
    (8, "Ünïcödé ΣΊΣΥΦΟΣ   日本語 😀 <|endoftext|> don't " + PASSAGE),
    (9, "a"),
    (10, "na " * 400),
    (-3, PASSAGE + "ends here. " + PASSAGE),
]


def documents(spark, texts=TEXTS):
    rows = [(i, t, None, [None, "", "src1", "src2"][n % 4], None, "x", n, 1, 2) for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def sample(spark, folder="/root/testdata/sf0.001"):
    return spark.read.parquet(f"{folder}/documents.parquet")
