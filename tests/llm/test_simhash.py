"""SimHash near duplicates against all pairs."""

import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from dockside.llm import components, simhash
from dockside.llm.storage import Scratch
from tables import awkward


def brute_components(fps, radius=4):
    parent = list(range(len(fps)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in itertools.combinations(range(len(fps)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= radius:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    return [root(k) for k in range(len(fps))]


def plain_fingerprint(text):
    words = [w for w in (text or "").encode().lower().split()]
    runs = [b" ".join(words[k : k + 4]) for k in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_masks_cover_every_pair_within_the_radius():
    rng, masks = random.Random(1), simhash.covering_masks(list(range(64)))
    assert len(masks) == 31 and all(30 <= m.bit_count() <= 34 for m in masks)
    for _ in range(3000):
        differ = sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
        assert any(not m & differ for m in masks)


def test_fingerprint(spark):
    for text in ("", None, "one", "a b c", "A b C d", "a b c d e f g " * 30, "é È x\x0by\x85z w"):
        assert simhash.fingerprint(text) == plain_fingerprint(text)
    assert spark.sql("select xxhash64('a b c d')").first()[0] & (1 << 64) - 1 == xxhash.xxh64_intdigest("a b c d", 42)


@pytest.mark.parametrize("limit", [2, 8, 2048])
def test_links_join_what_all_pairs_join(spark, tmp_path, limit):
    rng = random.Random(limit)
    fps = {rng.getrandbits(64) for _ in range(150)}
    for seed in list(fps)[:6]:  # crowded groups, and chains
        for _ in range(25):
            seed ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            fps.add(seed)
    fps = sorted(fps)
    table = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    scratch = Scratch(spark, "test-links")
    root = {r.node: r.root for r in components.roots(simhash.links(table, limit=limit), scratch).collect()}
    got = [root.get(simhash._signed(f), simhash._signed(f)) for f in fps]
    want = brute_components(fps)
    assert len(set(want)) < len(fps)
    assert {(want[a], want[b]) for a in range(len(fps)) for b in range(len(fps)) if got[a] == got[b]} == {(w, w) for w in want}


def test_components_of_a_random_graph(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(0, k) for k in range(300, 400)] + [(k, k + 1) for k in range(500, 540)]
    label = {}
    for a, b in edges:
        label.setdefault(a, a), label.setdefault(b, b)
    for _ in range(600):
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
        if not changed:
            break
    table = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components.roots(table, Scratch(spark, "test-graph")).collect()}
    assert got == {k: v for k, v in label.items() if any(k in e and e[0] != e[1] for e in edges)}


def test_near_duplicates_of_awkward_rows(spark):
    docs = awkward(spark)
    got = sorted(((r.id, r.fp, r.component) for r in simhash.near_duplicates(spark, docs).collect()), key=str)
    rows = [(r.doc_id, simhash._signed(plain_fingerprint(r.text))) for r in docs.collect()]
    root = brute_components([f & (1 << 64) - 1 for _, f in rows])
    least = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    assert got == sorted(((i, f, least.get(r)) for (i, f), r in zip(rows, root)), key=str)
    assert (None, 0, 3) in got


def test_one_of_each_group_stays(spark):
    kept = simhash.keep_one(spark, awkward(spark))
    assert sorted((r.doc_id or 0 for r in kept.collect())) == [0, 1, 3, 6, 7, 8]  # the row without id and text goes with the empty ones
    assert kept.columns == awkward(spark).columns


def test_empty_table(spark):
    assert simhash.near_duplicates(spark, awkward(spark, [])).count() == 0
    assert simhash.keep_one(spark, awkward(spark, [])).count() == 0


def test_registered_query_matches_all_pairs(spark, small):
    from dockside.llm.queries import registry

    got = {r.doc_id: r for r in registry()["op6_simhash_near_dedup"](spark, small).collect()}
    rows = sorted((r.doc_id, plain_fingerprint(r.text)) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect())
    root = brute_components([f for _, f in rows])
    assert {i: (f"{f:016x}", rows[r][0]) for (i, f), r in zip(rows, root)} == {i: (r.fingerprint, r.component_id) for i, r in got.items()}
    assert np.unique([r.component_id for r in got.values()]).size < len(got)


def test_the_exploded_fingerprints_are_not_broadcast(spark):
    """Spark sizes them as one row a fingerprint; 31 rows each are held by the driver before they are sent."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        found = simhash.links(spark.range(2000).select(F.xxhash64("id").alias("fp")))
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
