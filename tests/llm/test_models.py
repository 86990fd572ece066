"""Toxicity and SentencePiece: gradients, held-out accuracy, equality with the library, exact round trips."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from dockside.llm import pieces, toxicity
from tables import LONG, awkward

# ---- toxicity ----


def test_gradients_are_those_of_the_loss():
    texts = ["a bad word here", "some other words " * 15, "x"]
    model = toxicity.Model({k: v.astype(np.float64) for k, v in toxicity._start(3).items()}, np.zeros(toxicity.WORD_BUCKETS), np.zeros(toxicity.GRAM_BUCKETS), 0.1)
    words = toxicity.coded(pa.array(texts))
    windows, text = toxicity.windows_of(words)
    wanted, weight = np.array([1.0, 0.0, 1.0])[text], np.ones(len(text))

    def loss():
        x, _ = model.inputs(words)
        z = model.run(x, windows)
        return float(np.mean(np.logaddexp(0, z) - wanted * z))

    x, sizes = model.inputs(words)
    g = model.gradients(words, x, sizes, windows, wanted, weight)
    for name, places in {"ahead_h": [(0, 0), (3, 17)], "back_x": [(1, 2), (5, 20)], "back_b": [(4,)], "attend": [(2,)], "out": [(9,)], "bias": [(0,)]}.items():
        for place in places:
            step, at = 1e-3, model.p[name]
            before, at[place] = at[place], at[place] + step
            up = loss()
            at[place] = before - step
            down = loss()
            at[place] = before
            assert g[name][place] == pytest.approx((up - down) / (2 * step), rel=0.05, abs=2e-5)


def test_windows_hold_every_word_and_overlap():
    words = toxicity.coded(pa.array(["", None, "one", " ".join(f"w{k}" for k in range(100))]))
    windows, text = toxicity.windows_of(words)
    assert list(np.unique(text)) == [2, 3]
    assert set(words.ids[words.starts[3] :]) == set(windows[text == 3].ravel()) - {-1}
    assert (windows[text == 3][1, : toxicity.STRIDE] == windows[text == 3][0, toxicity.STRIDE :]).all()


@pytest.fixture(scope="module")
def fitted(spark):
    directory = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{directory}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, toxicity.fit(docs, labels)


def test_held_out_accuracy(spark, fitted):
    docs, labels, model = fitted
    held = docs.join(labels, "doc_id").where(toxicity.held_out(docs.doc_id)).select("doc_id", "text", "toxic")
    rows = toxicity.score(held, model).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows) and len(rows) > 500
    score, truth = np.array([r.score for r in rows]), np.array([r.toxic for r in rows])
    rank = score.argsort().argsort()
    area = (rank[truth == 1].mean() - (truth == 1).sum() / 2) / (truth == 0).sum()
    assert area > 0.93
    assert (score[truth == 1] >= 0.5).mean() > 0.8 and (score[truth == 0] < 0.5).mean() > 0.97


def test_scores_of_awkward_rows(spark, fitted):
    model = fitted[2]
    rows = toxicity.score(awkward(spark), model).collect()
    assert len(rows) == 11 and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows if not (r.text or "").strip()} == {model.empty} and model.empty < 0.5
    far = LONG + " you stupid worthless idiot scum moron loser clown"
    assert model.scores(pa.array([far]))[0] > model.scores(pa.array([LONG]))[0]  # the last window counts
    assert toxicity.score(awkward(spark), model, keep_below=1.1).columns == awkward(spark).columns
    assert toxicity.score(awkward(spark, []), model).count() == 0


def test_labels_of_other_texts_do_not_use_up_the_sample(spark, monkeypatch):
    docs = awkward(spark, [(k, f"text {k}") for k in range(200)])
    labels = spark.sql("select id as doc_id, cast(id % 2 as int) as toxic from range(20000)")
    monkeypatch.setattr(toxicity, "train", lambda texts, wanted: (texts, wanted))
    texts, wanted = toxicity.fit(docs, labels, sample=50)
    assert len(texts) == len(set(texts)) == 100 and sum(wanted) == 50


def test_every_id_is_held_out_or_not(spark):
    rows = spark.sql("select cast(null as bigint) as doc_id union all select 1 union all select 5").select(toxicity.held_out(F.col("doc_id")).alias("h"))
    assert [r.h for r in rows.collect()] == [True, zlib.crc32(b"1") % 5 == 0, zlib.crc32(b"5") % 5 == 0]


def test_fit_without_labels_or_with_one(spark):
    docs = awkward(spark)
    assert set(np.round(toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int")).scores(pa.array(["a", ""])), 2)) == {0.01}
    one = spark.createDataFrame([(1, 1), (2, None), (None, 1), (8, 1)], "doc_id long, toxic int")
    assert toxicity.fit(docs, one).scores(pa.array(["a b"]))[0] > 0.5


# ---- pieces ----

ODD = ["", "a", " ", "  a  b   c", "\n\n x\t", "é①ﬁ 日本語テキスト 😀", "a" * 300 + " " + "ab" * 200, " " * 40, "x" + " " * 100 + "y", "trailing ", None, LONG[:5000]]


@pytest.fixture(scope="module")
def own():
    return pieces.Pieces()


def _split(found):
    ids, sizes = found
    ends = np.concatenate(([0], np.cumsum(sizes)))
    return [ids[s:e] for s, e in zip(ends, ends[1:])]


def test_without_dropout_pieces_are_the_librarys(own, spark, small):
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = ODD + [r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    for text, found in zip(texts, _split(own.encode(texts, rate=0.0))):
        assert found.tolist() == model.encode(text or "")


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.5, 1.0])
def test_all_segmentations_decode_to_the_text(own, rate):
    texts = [*ODD, "▁ a▁b ▁▁", "\x00\x7f"]
    for seed in "ab":
        assert [own.decode(x) for x in _split(own.encode(texts, seed, rate))] == [t or "" for t in texts]


def test_seeds_vary_and_repeat(own):
    a, b, again = (own.encode([LONG[:20000]], seed)[0].tolist() for seed in "aba")
    assert a == again and a != b
    assert len(own.encode([LONG], rate=0.0)[0]) < len(own.encode([LONG], rate=0.1)[0]) < len(own.encode([LONG], rate=1.0)[0])


def test_occurrences_of_a_word_vary_within_a_seed(own):
    ids = own.encode([" ".join(["international"] * 500)])[0]
    raw, found, word = [own.bytes[own.byte_start[k] :][: own.byte_size[k]].tobytes() for k in ids.tolist()], set(), ()
    for piece in [*raw, b" "]:
        if piece.startswith(b" ") and word:
            found.add(word)
            word = ()
        word += (piece,)
    assert {b"".join(w) for w in found} == {b" international"} and len(found) > 20
    one, other = (own.encode([f"{head} " + "the " * 50])[0].tolist() for head in ("a", "b"))
    assert one[-80:] != other[-80:]


@pytest.mark.parametrize("rate", [0.1, 0.5])
def test_shared_merges_are_those_of_each_occurrence(own, rate):
    text = LONG[:30000] + " 日本 Überraschung" * 4 + " aab" * 50 + (" " + "xy" * 60) * 4
    words = pieces._WORD.findall(" " + text)
    key = (pieces.xxhash.xxh64_intdigest(text) + pieces.key_of("7")) & pieces._MASK
    assert own.encode([text, text], "7", rate)[0].tolist() == own.merge(words, key, rate)[0].tolist() * 2


def test_heap_and_arrays_run_the_same_agenda(own, monkeypatch):
    words = sorted({w for w in pieces._WORD.findall(" " + LONG)})[:800] + [" Überraschung", "   日本 ", " " + "aab" * 30]
    side = own.merge(words, pieces.key_of("7"), 0.3)
    monkeypatch.setattr(pieces, "LONG", 0)
    heap = own.merge(words, pieces.key_of("7"), 0.3)
    assert all(np.array_equal(x, y) for x, y in zip(side, heap))


def test_pieces_of_awkward_rows(spark):
    rows = pieces.encode(awkward(spark)).collect()
    assert len(rows) == 11 and all(r.lossless and r.n_pieces == len(r.pieces) for r in rows)
    twins = [r.pieces for r in rows if r.doc_id == 2]
    assert twins[0] == twins[1] and sum(r.n_pieces == 0 for r in rows) == 3
    assert pieces.encode(awkward(spark, [])).count() == 0
