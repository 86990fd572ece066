"""Spelling variants: words one edit apart, found by PartEnum signatures of their letter multisets, joined and verified.

A word is a binary vector: for each letter and each k up to its count, the place (letter, k) is 1. One replaced letter
changes two places, one inserted or deleted letter changes one. The places are dealt by hash to a few partitions; with d
changed places and p partitions, at least p - d partitions agree, so two such words share the projection on some p - d of
them. All these projections are enumerated as signatures and joined for equality: no near pair is missed.

Letter multisets alone cannot tell anagrams apart, and in a large vocabulary each word has dozens of them. Since one edit
leaves either the first or the last half of the shorter word as it stands, a signature also holds one of the halves and
the lengths it is meant for. Both parts are exact; what they let through is verified by edit distance.
"""

from __future__ import annotations

from itertools import combinations
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dockside.llm.storage import Scratch

RUN = "([A-Za-zÀ-ÿ]+)"
LEAST_LETTERS, LEAST_COUNT, TIMES = 6, 5, 5
SLIP = 199  # a run whose checksum this divides loses a letter
#: kind of edit: (places it changes in a letter multiset, partitions)
REPLACED, INSERTED = (2, 4), (1, 3)


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the letter runs of whole texts, A to Z in lower case, with a letter left out where the checksum says so.

    Null texts have no runs; a null id counts as the empty string; repeated rows count as often as they stand. Words are
    summed before they are shuffled, so that a frequent one is one row for each task.
    """
    text = F.translate(F.col(text_col), ascii_uppercase, ascii_lowercase)
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), F.explode(F.regexp_extract_all(text, F.lit(RUN), 1)).alias("run"))
    checksum = F.crc32(F.concat("i", F.lit(":"), "run").cast("binary"))
    runs = runs.select("run", checksum.alias("h"))
    cut = (F.col("h") % F.length("run")).cast("int")
    slipped = F.concat(F.expr("left(run, cut)"), F.expr("substring(run, cut + 2)"))
    word = F.when(F.col("h") % SLIP == 0, slipped).otherwise(F.col("run"))
    found = runs.withColumn("cut", cut).select(word.alias("word")).where(F.length("word") >= LEAST_LETTERS)
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def _projections(places: Column, changed: int, parts: int) -> Column:
    """The word's places in each choice of ``parts - changed`` partitions, as strings."""

    def of(chosen):
        kept = F.filter(places, lambda x: F.pmod(F.xxhash64(x), F.lit(parts)).isin(*chosen))
        return F.concat_ws(".", F.lit("".join(map(str, chosen))), F.array_join(kept, ""))

    return F.array(*[of(chosen) for chosen in combinations(range(parts), parts - changed)])


def _keyed(projections: Column, key: Column, role: int) -> Column:
    return F.transform(projections, lambda p: F.struct(F.concat(key, p).alias("signature"), F.lit(role).alias("role")))


def signatures(table: DataFrame) -> DataFrame:
    """(signature, role, word, n): role 0 meets 0 (replaced letter), role 1, the shorter word, meets 2 (inserted letter)."""
    letters = F.sort_array(F.split("word", ""))
    places = F.transform(letters, lambda c, i: F.concat(c, (i - F.array_position(letters, c) + 1).cast("string")))
    rows = table.select("word", "n", F.length("word").alias("size"), places.alias("places"))
    rows = rows.select("word", "n", "size", _projections(F.col("places"), *REPLACED).alias("two"), _projections(F.col("places"), *INSERTED).alias("one"))
    made = []
    for role, size, kind in ((0, "size", "two"), (1, "size", "one"), (2, "size - 1", "one")):
        half = f"({size}) div 2"
        for side, part in (("<", f"left(word, {half})"), (">", f"right(word, {size} - {half})")):
            key = F.concat(F.lit(kind[0]), F.expr(f"string({size})"), F.lit(side), F.expr(part), F.lit(" "))
            made.append(_keyed(F.col(kind), key, role))
    return rows.select(F.explode(F.concat(*made)).alias("s"), "word", "n").select("s.*", "word", "n")


def near_pairs(table: DataFrame) -> DataFrame:
    """(word, n, other, other_n): every two words of ``table(word, n)`` that one edit makes equal, once, the pair's order open."""
    found = signatures(table)
    left, right = found.alias("l"), found.alias("r")
    meets = F.expr("l.signature = r.signature and ((l.role = 0 and r.role = 0 and l.word < r.word) or (l.role = 1 and r.role = 2))")
    pairs = left.join(right, meets).where("levenshtein(l.word, r.word, 1) = 1")
    return pairs.selectExpr("l.word as word", "l.n as n", "r.word as other", "r.n as other_n").distinct()


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root): each word's last form. A form is ``TIMES`` as frequent as its word, so chains are short; every round doubles the steps."""
    turn, steps = 0, scratch.keep(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots-0")
    while not steps.where("moved").isEmpty():
        turn += 1
        further = steps.select(F.col("word").alias("_at"), F.col("root").alias("_to"))
        steps = steps.join(further, F.col("root") == F.col("_at"), "left")
        steps = scratch.keep(steps.select("word", F.coalesce("_to", "root").alias("root"), F.col("_to").isNotNull().alias("moved")), f"roots-{turn}")
    return steps.select("word", "root")


def variants(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word with at least ``LEAST_LETTERS`` letters and ``least`` occurrences.

    ``form`` is the most frequent near word (of equals the first in code-point order) if it occurs ``TIMES`` as often, else
    null; ``root`` the last of the chain of forms, the word itself if it has none. No texts give no rows.
    """
    scratch = Scratch(spark, "spelling")
    table = scratch.keep(words(docs, id_col, text_col, least), "words")
    pairs = scratch.keep(near_pairs(table), "pairs")
    both = pairs.unionByName(pairs.selectExpr("other as word", "other_n as n", "word as other", "n as other_n"))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus_n"), "other")).alias("best"))
    joined = table.join(best, "word", "left")
    good = -F.col("best.minus_n") >= TIMES * F.col("n")
    judged = scratch.keep(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(good, F.col("best.other")).alias("form"), F.when(good, -F.col("best.minus_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(judged.where("form is not null"), scratch)
    found = judged.join(roots, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
