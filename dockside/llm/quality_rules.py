"""Quality rules: a table of thresholds compiled into one projection of built-in functions, row by row and without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
GRAM = 5

#: Common words of the corpus' languages (English, German, French, Spanish).
STOP_WORDS = (
    "the of and to in is it that for on are as with be by this was from or an at a "
    "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch "
    "le la les de des et un une que qui en du dans pour par sur est pas avec au "
    "el los las y del se por con para una su al lo como más no"
).split()

MEASURES = (
    "n_words word_chars n_symbols n_capitals n_stop_words n_lines n_dup_lines n_repeat_words base_failed kept _text _words".split()
)

#: name, ratio (see ``measures``), least, most. A text is kept if every ratio lies between them.
THRESHOLDS = [
    ("words", "n_words", 10, None),
    ("word_length", "word_chars / n_words", 2.0, 14.0),
    ("symbols", "n_symbols / n_words", None, 0.2),
    ("capitals", "n_capitals / word_chars", None, 0.4),
    ("stop_words", "(n_stop_words + 1) / n_words", 0.04, None),
    ("repeated_lines", "n_dup_lines / n_lines", None, 0.5),
    ("repeated_words", "n_repeat_words / n_words", None, 0.2),
]


def _with(value: Column, use) -> Column:
    """``use(value)``, with the value computed once, also where a filter further on has the optimiser put expressions together."""
    return F.transform(F.array(value), use)[0]


def _repeated(words: Column) -> Column:
    """Words that lie in a window of ``GRAM`` words which the text has twice or more, the first one included.

    Windows are compared by 64-bit hashes. Only a text in which two agree sorts them with their places; each repeated window
    then adds the words up to the next one's start.
    """

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = lambda all_: F.filter(
            all_, lambda x, i: F.coalesce(x["h"] == F.get(all_, i + 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(all_, i - 1)["h"], F.lit(False))
        )
        places = _with(placed, lambda all_: F.sort_array(F.transform(twice(all_), lambda x: x["i"])))
        steps = lambda at: F.transform(at, lambda x, i: F.least(F.lit(GRAM), F.coalesce(F.get(at, i + 1) - x, F.lit(GRAM))))
        return _with(places, lambda at: F.aggregate(steps(at), F.lit(0), lambda s, x: s + x))

    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - GRAM), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(GRAM)]))
    counted = _with(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0)))
    return F.when(F.size(words) >= GRAM, counted).otherwise(F.lit(0))


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts that the thresholds are stated in; null is read as a text without words.

    Words are runs without ASCII white space. A line counts as repeated if it has a word and equals an earlier line. A column of
    ``docs`` that is named like a count gives way to it.
    """
    text, own = F.coalesce(F.col(text_col).cast("string"), F.lit("")), [c for c in docs.columns if c not in MEASURES]
    split = docs.withColumns({"_text": text, "_words": F.filter(F.split(text, WHITE), lambda w: w != "")})
    lines = F.filter(F.split("_text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    lowered = lambda w: F.lower(F.regexp_replace(w, r"[.,;:!?]+$", ""))
    return split.select(
        *[F.col(f"`{c}`") for c in own],
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_text", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("_text", r"\P{Lu}+", "")).cast("long").alias("n_capitals"),
        F.size(F.filter("_words", lambda w: lowered(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        _with(F.col("_words"), _repeated).cast("long").alias("n_repeat_words"),
    )


def verdict(thresholds=THRESHOLDS) -> Column:
    """The table as one expression; a ratio without a denominator passes."""
    passed = F.lit(True)
    for _, ratio, least, most in thresholds:
        value = F.expr(f"try_divide({ratio.replace(' / ', ', ')})" if " / " in ratio else ratio)
        if least is not None:
            passed &= F.coalesce(value >= least, F.lit(True))
        if most is not None:
            passed &= F.coalesce(value <= most, F.lit(True))
    return passed


def judge(docs: DataFrame, text_col: str = "text", thresholds=THRESHOLDS) -> DataFrame:
    """``docs`` with its counts, ``base_failed`` and ``kept``.

    ``base_failed``: under 10 words, or over 20 of 100 words in repeated windows; null and empty texts fail. Each row is judged by
    its own text, repeated rows alike.
    """
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return measures(docs, text_col).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(thresholds))
