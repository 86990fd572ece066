"""Small tables with every awkward row: nulls, empty and long texts, ties, repeated rows, columns with clashing names."""

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, id long, fp long, score double, key string, blob string, "
    "found string, own long, words string, n_words long, kept string, component string, _text string, _own string"
)
LONG = " ".join(f"word{k % 977} and{k % 31}" for k in range(30_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today"),
    (2, "The quick brown fox jumps over the lazy dog near the old river bank today"),
    (2, "The quick brown fox jumps over the lazy dog near the old river bank today"),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, LONG),
    (None, "A text without an id that nobody else has"),
    (None, None),
    (7, "é" * 50 + " ▁ ① 日本語 😀 token = \"abcdef0123456789abcdef0123456789\""),
    (8, "x"),
]


def awkward(spark, rows=None):
    full = [(i, t, None, "s", None, 0, 0, 0.5, "k", "b", "f", 0, "w", 0, "k", "c", "t", "o") for i, t in (ROWS if rows is None else rows)]
    return spark.createDataFrame(full, SCHEMA)
