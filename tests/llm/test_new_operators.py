"""Spelling variants, the log-bilinear model and the conversation trie against plain Python."""

import collections
import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from compare import difference
from dockside.llm import centroids, log_bilinear, prefix_trie, spelling
from dockside.llm.queries import registry, statements
from dockside.llm.storage import Scratch
from tables import awkward


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- spelling variants


def plain_variants(rows, least=5):
    counts = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", lowered(text)):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= least}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    around = {w: [o for o in words if o != w and abs(len(o) - len(w)) < 2 and near(w, o)] for w in words}
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        if best and words[best] >= 5 * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n, len(around[w]), words[form[w]] if w in form else None) for w, n in words.items())


def listed(found):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found.collect())


MISSPELT = (
    "received " * 130 + "recieved " * 8 + "receivd " * 26 + "receivdx " * 5 + "receved " * 5 + "abcdef bacdef abcdeg abcdfe abcdefg xabcdef abcde " * 5
    + "Éclairs éclairs éclair " * 6 + "übermut übermüt ÷×÷×÷× " * 7 + "aaaaaa aaaaaaa aaaaaaaa aaaaaab " * 9
)


def test_variants_are_those_of_all_pairs(spark):
    rows = [(1, MISSPELT), (None, MISSPELT.upper()), (2, "received " * 40), (2, "received " * 40), (3, None), (4, ""), (5, "z" * 200_000)]
    found = listed(spelling.variants(spark, awkward(spark, rows)))
    assert found == plain_variants(rows) and any(r[1] for r in found) and any(r[1] != r[2] and r[1] for r in found)


def test_slips_take_a_letter_out(spark):
    rows = [(k, "wonderful") for k in range(3_000)]
    found = listed(spelling.variants(spark, spark.createDataFrame(rows, "doc_id long, text string"), least=1))
    assert found == plain_variants(rows, 1) and len(found) > 3


def test_signatures_miss_no_near_pair(spark):
    words = sorted({"".join(w) for w in np.random.default_rng(3).choice(list("aabcde"), (900, 7))} | {"".join(w) for w in np.random.default_rng(4).choice(list("abc"), (300, 6))})
    table = spark.createDataFrame([(w, k + 1) for k, w in enumerate(words)], "word string, n long")
    found = {tuple(sorted((r.word, r.other))) for r in spelling.near_pairs(table).collect()}
    holes = collections.defaultdict(set)
    for w in words:
        for k in range(len(w)):
            holes[w[:k] + "_" + w[k + 1 :]].add(w)
    expected = {(a, b) for group in holes.values() for a in group for b in group if a < b}
    expected |= {tuple(sorted((w, w[:k] + w[k + 1 :]))) for w in words for k in range(len(w)) if w[:k] + w[k + 1 :] in words}
    assert found == expected and len(found) > 300


def test_no_documents_have_no_variants(spark):
    assert spelling.variants(spark, awkward(spark, [])).collect() == []


# --- language model


def test_base_scores_and_sums_of_probabilities(spark):
    rows = [(k, f"The cat sat on mat {k % 7} and the Dog-{k} ran\x0baway now É") for k in range(120)] + [(None, None), (500, ""), (500, "the the"), (501, " x" * 3000), (502, "q" * 100_000)]
    found = log_bilinear.score(spark, awkward(spark, rows)).collect()
    training = [(i, t) for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", lowered(t))
    counts = collections.Counter(w for _, t in training for w in words(t))
    counts[None] = len(training)
    total = sum(counts.values())
    expected = []
    for i, text in rows:
        tokens = [*words(text), None]
        base = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in tokens)
        held = zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
        expected.append((str(i), held, len(tokens), sum(counts[w] > 0 for w in tokens), total, round(base, 6)))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == sorted(expected)
    assert all(r.score < 0 for r in found)


def test_the_model_beats_the_counts_on_held_out_texts(spark, small):
    found = registry()["op12_lm_scoring"](spark, small).where("held_out")
    r = found.agg(F.sum("score").alias("model"), F.sum("base_score").alias("base"), F.sum("n_tokens").alias("n")).first()
    assert r.model / r.n > r.base / r.n + 0.1


def some_counts():
    words = pa.array([f"w{k:03}" for k in range(900)])
    return log_bilinear.Counts(10, 5000, 2000, words, np.arange(1000, 100, -1), pa.array(["ab", "cd"]), {log_bilinear.FIRST: (50, 500), log_bilinear.FIRST + 1: (3, 9), log_bilinear.OTHER: (7, 8)})


def test_symbol_probabilities_add_up_to_one():
    model, rng = log_bilinear.Model(some_counts().prior()), np.random.default_rng(1)
    model.out = rng.normal(0, 1, model.out.shape).astype(np.float32)
    symbols = np.array([s for s in range(len(model.prior)) if s != log_bilinear.START])
    for before in ([1, 1], [5, 300], [1023, 2]):
        logs = model.log_probabilities(np.tile(before, (len(symbols), 1)), symbols)
        assert abs(np.exp(logs).sum() - 1) < 1e-5


def test_gradients_are_those_of_the_loss():
    model, rng = log_bilinear.Model(some_counts().prior()), np.random.default_rng(2)
    model.out = rng.normal(0, 0.3, model.out.shape)
    model.into, model.bias, model.weight = model.into.astype(float), model.bias.astype(float), rng.normal(1, 0.2, model.weight.shape)
    trainer = log_bilinear.Trainer(model)
    before, symbols, noise = rng.integers(3, 40, (60, 2)), rng.integers(2, 40, 60), np.array([3, 5, 5, 260, 700])
    for values, by in zip((model.into, model.out, model.bias, model.weight), trainer.gradients(before, symbols, noise)):
        flat, slope = values.reshape(-1), by.reshape(-1)
        for at in rng.choice(np.flatnonzero(slope), 4):
            was, step = flat[at], 1e-5
            flat[at] = was + step
            up = trainer.loss(before, symbols, noise)
            flat[at] = was - step
            down = trainer.loss(before, symbols, noise)
            flat[at] = was
            assert abs((up - down) / (2 * step) - slope[at]) < 1e-5


def test_contexts_stop_at_the_texts():
    before, symbols, starts = log_bilinear._flat(pa.array([[7, 8, 9, 0], [0], [5, 0]], pa.list_(pa.int16())))
    assert before.tolist() == [[1, 1], [7, 1], [8, 7], [9, 8], [1, 1], [1, 1], [5, 1]] and symbols.tolist() == [7, 8, 9, 0, 0, 5, 0] and starts.tolist() == [0, 4, 5, 7]


@pytest.mark.parametrize("rows", [[], [(11, "no text to learn from")], [(None, None)]])
def test_scores_without_much_to_learn(spark, rows):
    found = log_bilinear.score(spark, awkward(spark, rows)).collect()
    assert len(found) == len(rows) and all(r.score <= 0 and r.n_tokens >= 1 for r in found)


# --- conversation trie


def plain_trie(rows):
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns[conv].append(((turn is not None, turn or 0), role, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), text))
    turns = {c: [(r, t) for _, r, _, t in sorted(v)] for c, v in turns.items()}
    nodes, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        full = tuple(turns.get(c - c % 20, [])[:h] + own[h:])
        for d in range(len(full) + 1):
            nodes[full[:d]].append(c)
        ends[full].append(c)
    below = collections.defaultdict(list)
    for node in nodes:
        for d in range(len(node) + 1):
            below[node[:d]].append(node)
    children = collections.Counter(n[:-1] for n in nodes if n)
    words = lambda n: len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
    return sorted(
        (
            min(m), len(n), min(nodes[n[:-1]]) if n else None, len(m), children[n], sum(not children[x] for x in below[n]),
            sum((len(nodes[x]) - 1) * words(x) for x in below[n]), hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest(),
        )
        for n, m in nodes.items()
    )


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, id long, top string")


CHATS = (
    [(c, t, "user" if t % 2 == 0 else "bot", f"turn {t} {c % 3 if t > 1 else ''} é x") for c in range(45) for t in range(c % 6)]
    + [(7, None, "user", "before all"), (7, None, "user", "before all"), (7, 2, None, None), (8, 1, "a", ""), (8, 1, "", "a"), (None, 1, "user", "nobody's")]
    + [(c, 0, "s", "same first turn") for c in range(100, 140)] + [(200, t, "u", f"long {t}") for t in range(90)] + [(201, t, "u", f"long {t}") for t in range(60)]
)


@pytest.mark.parametrize("local", [3, 4096])
def test_trie_is_that_of_all_prefixes(spark, local):
    found = prefix_trie.trie(spark, conversations(spark, CHATS), local=local)
    assert sorted(tuple(r) for r in found.collect()) == plain_trie(CHATS)


def test_long_sequences_are_put_together_from_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 7)
    found = prefix_trie.trie(spark, conversations(spark, CHATS))
    assert sorted(tuple(r) for r in found.collect()) == plain_trie(CHATS)


def test_no_conversations_have_no_trie(spark):
    assert prefix_trie.trie(spark, conversations(spark, [(None, 1, "a", "b")])).collect() == []


def plain_sums(parents, own):
    sums = own.copy()
    for v, up in enumerate(parents):
        while up >= 0:
            sums[up] += own[v]
            up = parents[up]
    return sums


@pytest.mark.parametrize("kind", ["path", "hub", "random"])
def test_centroid_splits_give_the_subtree_sums(kind):
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 50, 700):
        up = [-1] + [{"path": i - 1, "hub": 0, "random": int(rng.integers(0, i))}[kind] for i in range(1, n)]
        place = rng.permutation(n)
        parents = np.full(n, -1)
        parents[place[1:]] = place[up[1:]] if n > 1 else []
        own = rng.integers(0, 100, (n, 2))
        assert (centroids.decompose(parents, own) == plain_sums(parents.tolist(), own)).all()


def test_large_components_are_split_by_joins(spark):
    rng = np.random.default_rng(6)
    up = [-1, *range(60), *[0] * 40, *[int(x) for x in rng.integers(0, 100, 60)], -1]  # a path, a hub, branches; a tree of one node
    own = rng.integers(0, 9, (len(up), 1))
    ids = np.arange(len(up)) * 7_919 + (1 << 55)
    rows = [(int(ids[v]), int(ids[p]) if p >= 0 else None, int(own[v, 0])) for v, p in enumerate(up)]
    nodes = spark.createDataFrame(rows, "id long, parent long, n long")
    found = {r.id: r.n for r in centroids.subtree_sums(nodes, ["n"], Scratch(spark, "sums"), local=10).collect()}
    assert found == {int(i): int(n) for i, n in zip(ids, plain_sums(up, own)[:, 0])}


# --- registered queries


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op13_conversation_trie"])
def test_query_matches_sql(spark, small, name):
    connection = duckdb.connect()
    for table in ("documents", "conversations"):
        connection.execute(f"create view {table} as select * from '{small}/{table}.parquet'")
    assert difference(registry()[name](spark, small), connection.execute(statements()[name])) is None
