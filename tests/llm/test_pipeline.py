"""The pipeline against its stages in plain Python."""

import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from dockside.llm import pieces, secret_scan, simhash, toxicity
from tables import awkward
from test_native import plain_spans
from test_simhash import brute_components, plain_fingerprint


def masked(text):
    out, at = "", 0
    for start, _, end, _ in plain_spans(text):
        if start >= at:
            out += text[at:start] + secret_scan.MASK
        at = max(at, end)
    return out + text[at:]


def test_run_is_what_its_stages_say(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{small}/labels.parquet"))
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    rows = [row for row in rows if model.scores(pa.array([row[1]]))[0] < 0.5]
    root = brute_components([plain_fingerprint(t) for _, t in rows])
    rows = [row for k, row in enumerate(rows) if root[k] == k]
    words = lambda t: [w for w in ("".join(c for c in x.lower() if c.isalnum()) for x in t.split()) if w]
    grams = lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    tests = [grams(words(r.text)) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    rows = [(i, t) for i, t in rows if not any(len(g & grams(words(t))) >= 0.8 * len(g) for g in tests)]
    want = {i: masked(t) for i, t in rows}
    own = pieces.Pieces()
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, small).collect()}
    assert set(got) == set(want) and 0 < len(got) < docs.count()
    for i, text in want.items():
        assert got[i].lossless and got[i].pieces == own.encode([text])[0].tolist()


def test_stages_keep_the_columns_and_take_awkward_rows(spark, small):
    docs = awkward(spark)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "sentencepiece"]
    for name, stage in corpus_pipeline.STAGES:
        for rows in (docs, awkward(spark, [])):
            out = stage(spark, rows, small)
            assert name == "sentencepiece" or out.columns == docs.columns
            assert (out.count() > 0) == (rows is docs)


def test_near_duplicates_are_told_apart_by_id_and_text(spark):
    copy, clean = "one two three four five six seven", "an altogether different text about nothing in particular at all"
    rows = [(1, copy), (2, copy), (2, clean), (None, "no id has this text of a few words"), (None, "no id has this text of a few words"), (None, copy)]
    rows += [(7, "the same row twice over and over again"), (7, "the same row twice over and over again"), (8, None), (9, ""), (10, " \n")]
    out = simhash.keep_one(spark, awkward(spark, rows))
    kept = sorted((str(r.doc_id), r.text) for r in out.collect())
    assert kept == sorted([("1", copy), ("2", clean), ("None", rows[3][1]), ("7", rows[6][1]), ("8", None)], key=lambda r: (r[0], str(r[1])))


def test_stages_leave_the_other_columns_as_they_were(spark):
    secret = "token = abcdef0123456789abcdef0123456789"
    docs = awkward(spark, [(1, f"before {secret} after"), (2, "nothing to hide here"), (3, None)])
    names = [c for c in docs.columns if c not in ("text", "n_chars")]
    for stage in (simhash.keep_one, secret_scan.redact):
        out = {r.doc_id: r for r in stage(spark, docs.withColumns({"_blob": F.lit("b"), "_found": F.lit("f"), "_gone": F.lit(1), "row": F.lit("r")})).collect()}
        assert [c for c in out[1].asDict() if c in names] == names
        for r in docs.collect():
            assert all(out[r.doc_id][c] == r[c] for c in names) and out[r.doc_id]["_blob"] == "b" and out[r.doc_id]["row"] == "r"
    assert out[1].text == masked(f"before {secret} after") and out[1].n_chars == len(out[1].text) and out[2].text == "nothing to hide here" and out[3].text is None
