"""Token counts, license scans, line dedup, decontamination and page text against plain Python."""

import collections
import html
import random
import re
import time

import pytest

from dockside.llm import decontaminate, html_text, licenses, line_dedup, token_counts
from dockside.llm.queries import registry
from tables import LONG, awkward

# ---- token counts ----


def _totals(rollups):
    return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in rollups.totals().collect() if r.n_docs}


def test_totals_follow_inserts_revisions_and_deletes(spark, tmp_path):
    words = {"words-1": token_counts.TOKENIZERS["words-1"]}
    rollups = token_counts.Rollups(spark, f"file://{tmp_path}/rollups")
    table = lambda rows: spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    first = table([(1, "a b c", "s", "en"), (2, "d e", "s", "en"), (3, None, None, None), (None, "no id", "s", "en"), (4, "x y z", "t", "de"), (4, "x", "t", "de")])
    assert _totals(rollups) == {}
    assert rollups.apply("1", token_counts.counted(first, words))
    assert _totals(rollups) == {("s", "en", "words-1"): (3, 7), (None, None, "words-1"): (1, 0), ("t", "de", "words-1"): (1, 3)}
    before = rollups.totals().collect()
    assert not rollups.apply("1", token_counts.counted(first, words)) and rollups.totals().collect() == before  # sent again
    second = table([(1, "a b c d e", "t", "en"), (2, "d e", "s", "en")])  # moved and revised; unchanged
    gone = spark.createDataFrame([("4",), ("99",), ("2",)], "key string")
    rollups.apply("2", token_counts.counted(second, words), gone)
    assert _totals(rollups) == {("s", "en", "words-1"): (2, 4), (None, None, "words-1"): (1, 0), ("t", "en", "words-1"): (1, 5)}


def test_a_batch_that_failed_before_its_commit_is_written_anew(spark, tmp_path):
    words = {"words-1": token_counts.TOKENIZERS["words-1"]}
    rollups = token_counts.Rollups(spark, f"file://{tmp_path}/rollups")
    docs = awkward(spark)
    spark.createDataFrame([("x", "s", "e", "w", 9, 9)], "key string, source string, lang string, tokenizer string, n_docs long, n_tokens long").write.parquet(f"{rollups.root}/entries/1")
    spark.createDataFrame([("s", "e", "w", 9, 9, 9)], "source string, lang string, tokenizer string, n_docs long, n_tokens long, n_entries long").write.parquet(f"{rollups.root}/deltas/1")
    assert _totals(rollups) == {}
    rollups.apply("1", token_counts.counted(docs, words))
    assert _totals(rollups) == {("s", None, "words-1"): (10, 15 + 15 + 60_000 + 9 + 8 + 1)}


def test_registered_counts_match_plain_python(spark, small):
    got = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in registry()["op3_token_counts"](spark, small).collect()}
    encode, want, first = token_counts.byte_bpe(token_counts.VOCABULARY).encode_ordinary, collections.Counter(), {}
    for r in sorted(spark.read.parquet(f"{small}/documents.parquet").collect(), key=lambda r: r.doc_id):
        mine = first.setdefault(r.text, r.doc_id) == r.doc_id
        text = "\n".join(dict.fromkeys(r.text.split("\n")))
        for name, n in (("byte_bpe_50k-1", len(encode(text))), ("words-1", len(text.split()))):
            want[r.source, r.lang, name, 0] += mine
            want[r.source, r.lang, name, 1] += n * mine
    assert got == {k[:3]: (want[(*k[:3], 0)], want[(*k[:3], 1)]) for k in want}


# ---- licenses ----


def test_licenses_are_found_whole_changed_and_nowhere_else(spark, small):
    names = dict(licenses.TEMPLATES)
    near = names["MIT-text"].replace("free of charge", "without charge").replace("sublicense, ", "")
    texts = [(30, f"{LONG} {names['GPL-3.0']} tail"), (31, f"é {near}\nend"), (32, names["BSD"][:60]), (33, " ".join([names["MIT"]] * 3)), (34, names["Apache-2.0-header"])]
    rows = licenses.scan(awkward(spark).unionByName(awkward(spark, texts))).collect()
    found = collections.defaultdict(list)
    for r in rows:
        found[r.doc_id].append(r)
    assert set(found) == {30, 31, 33, 34} and len(found[33]) == 3
    assert [(r.license, r.coverage) for r in found[30]] == [("GPL-3.0", 1.0)] and found[30][0].stop - found[30][0].start == len(names["GPL-3.0"])
    assert found[31][0].license == "MIT-text" and 0.95 < found[31][0].coverage < 1 and found[31][0].start == 2
    assert [r.license for r in found[34]] == ["Apache-2.0-header"]
    assert licenses.scan(awkward(spark, [])).count() == 0 and licenses.scan(awkward(spark), [("none", "...")]).count() == 0


def test_every_notice_of_the_table(spark, small):
    got = sorted((r.doc_id, r.start, r.license) for r in registry()["op7_license_scans"](spark, small).collect())
    notices = {name: text for name, text in licenses.TEMPLATES + licenses.NOTICES if len(text) < 80 and not name.endswith("-text")}
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    want = [(r.doc_id, m.start(), name) for r in docs for name, text in notices.items() for m in re.finditer(re.escape(text), r.text)]
    assert got == sorted(want) and {"All-rights-reserved", "Apache-2.0", "MIT"} <= {name for _, _, name in got}


@pytest.mark.parametrize("name", ["Apache-2.0", "GPL-3.0", "MPL-2.0"])
def test_whole_licenses_are_covered_to_their_end(spark, name):
    text = (licenses._TEXTS / f"{name}.txt").read_text()
    rows = sorted(licenses.scan(awkward(spark, [(35, text)])).collect(), key=lambda r: r.start)
    assert all(r.coverage == 1 for r in rows) and len(rows) > 20
    rest = "".join(text[a:b] for a, b in zip([0, *[r.stop for r in rows]], [*[r.start for r in rows], len(text)]))
    assert not re.search(r"[^\W_]", rest)


def test_mit_with_its_warranty_ends_at_its_end(spark):
    parts = dict(licenses.TEMPLATES)
    text = f"Copyright (c) 2020 Someone\n\n{parts['MIT-text']}\n\n{parts['MIT-warranty']}"
    rows = licenses.scan(awkward(spark, [(36, text)])).collect()
    assert [(r.license, r.coverage) for r in rows] == [("MIT-text", 1), ("MIT-warranty", 1)] and text[rows[1].stop :] in ("", ".")


def test_alignment_counts_the_longest_common_order_in_the_band():
    rng = random.Random(5)
    for _ in range(60):
        template, words = [rng.randrange(6) for _ in range(8)], [rng.randrange(6) for _ in range(14)]
        length = [[0] * 15 for _ in range(9)]
        for i in range(8):
            for j in range(14):
                length[i + 1][j + 1] = length[i][j] + 1 if template[i] == words[j] else max(length[i][j + 1], length[i + 1][j])
        matched, first, end = licenses.align(template, words, 0, 14)
        assert matched == length[8][14] and 0 <= first <= end <= 14


# ---- line dedup ----


def plain_removals(rows, least):
    first, want = {}, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for _, _, _, digest in line_dedup.units(text):
            first.setdefault(digest, doc)
    for doc, text in rows:
        seen, repeated = set(), []
        for n, (start, stop, words, digest) in enumerate(line_dedup.units(text)):
            if digest in seen or first[digest] != doc:
                repeated.append((n, start, stop, words))
            seen.add(digest)
        want.append((doc, line_dedup.removed_runs(repeated, least)))
    return want


@pytest.mark.parametrize("least", [1, line_dedup.LEAST_WORDS])
def test_repeated_units_leave_all_but_the_first(spark, small, least):
    passage = "Every unit of this passage stands in two documents. It has several sentences of some length. They are cut one by one, and they all go together in the end. A last one makes it long."
    docs = awkward(spark).unionByName(awkward(spark, [(40, f"before it {passage} After it."), (41, f"Other words\nthat end here {passage} And others follow that nobody has.")]))
    docs = docs.select("doc_id", "text", "own").unionByName(spark.read.parquet(f"{small}/documents.parquet").selectExpr("doc_id + 100 as doc_id", "text", "0L own"))
    got = line_dedup.dedup(spark, docs, least).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    key = lambda r: str(r)
    assert sorted(((r.doc_id, [(s.start, s.stop) for s in r.removed]) for r in got), key=key) == sorted(plain_removals(rows, least), key=key)
    texts = {r.doc_id: r.text for r in got}
    assert "Every unit" in texts[40] and "They are cut" in texts[40] and "They are cut" not in texts[41] and texts[41].startswith("Other words\nthat end here")
    assert texts[3] is None and texts[4] == "" and texts[1] and (texts[2] == "") == (least == 1)
    assert line_dedup.dedup(spark, awkward(spark, []), least).count() == 0


def test_registered_dedup_keeps_each_line_once(spark, small):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    plain = lambda line: " ".join(line.lower().split())
    first, again = {}, 0
    for doc, text in sorted(rows.items()):
        for n, line in enumerate(text.split("\n")):
            again += first.setdefault(plain(line), (doc, n)) != (doc, n) and bool(line.strip())
    assert again > 0
    for r in registry()["op8_substring_dedup"](spark, small).collect():
        spans = [tuple(map(int, s.split(":"))) for s in r.removed_spans.split(",") if s]
        assert r.text == line_dedup.without(rows[r.doc_id], spans) and spans == sorted(spans)
        at = 0
        for n, line in enumerate(rows[r.doc_id].split("\n")):
            gone = "".join(line[max(s - at, 0) : max(e - at, 0)] for s, e in spans)
            if line.strip() and first[plain(line)] != (r.doc_id, n):
                assert gone.strip() == line.strip()
            at += len(line) + 1


def test_short_lines_go_and_short_parts_of_lines_stay(spark):
    texts = [
        (60, "Read more here.\nA line of two sentences here. It comes back with other capitals. \nOnly here"),
        (61, "read more here.\na line of two sentences here. it comes back with other capitals.\nNothing else here. It comes back with other capitals. So"),
        (62, "x\n\n x \nx"),
    ]
    got = {r.doc_id: r.text for r in line_dedup.dedup(spark, awkward(spark, texts), lines=True).collect()}
    assert got[60] == texts[0][1] and got[61] == "\n" + texts[1][1].split("\n")[2] and got[62] == "x\n\n"


def test_units_cover_every_word():
    for text in (LONG, "a. B c. " * 9, "É x\n\n  y z.\tW"):
        assert " ".join(text[s:e] for s, e, _, _ in line_dedup.units(text)).split() == text.split()


# ---- decontamination ----


def _plain_words(text):
    return [w for w in (re.sub(r"[\W_]+", "", w.lower()) for w in (text or "").split()) if w]


def test_contaminated_documents_are_those_that_hold_an_item(spark, small):
    docs, items = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    want = set()
    grams = lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    tests = [(i.item_id, grams(_plain_words(i.text))) for i in items.collect()]
    for d in docs.collect():
        own = grams(_plain_words(d.text))
        want |= {(d.doc_id, i) for i, g in tests if len(g & own) >= 0.8 * len(g)}
    assert got == want and got
    kept = {r.doc_id for r in decontaminate.clean(docs, items).collect()}
    assert kept == {d.doc_id for d in docs.collect()} - {d for d, _ in want}


def test_awkward_documents_and_items(spark):
    long_item = " ".join(f"long{k} item" for k in range(300))
    items = spark.createDataFrame([(1, "What is the name of the tallest hill here? It is called Mount Example."), (2, None), (3, "..."), (4, "tiny"), (None, long_item), (1, "twice")], "item_id long, text string")
    texts = [(50, f"{LONG} what is THE name of the tallest hill here it is called mount example"), (51, f"x {long_item} y"), (52, "the tallest hill is called something"), (53, "What is the name of the tallest hill here? Nobody knows.")]
    docs = awkward(spark).unionByName(awkward(spark, texts))
    got = sorted((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect() if r.doc_id)
    assert (50, 1) in got and (51, None) in got and not [g for g in got if g[0] in (52, 53)]
    assert decontaminate.clean(docs, items).columns == docs.columns
    assert decontaminate.contaminated(docs, items.where("false")).count() == 0 and decontaminate.clean(docs, items.where("false")).count() == docs.count()
    assert decontaminate.contaminated(awkward(spark, []), items).count() == 0


def test_no_passage_above_the_threshold_is_passed_over(spark, small):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    index = decontaminate.Index(items, 64)
    rng, pool = random.Random(2), [w for _, t in items for w in t.split()]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randint(1, 200))) + " " + " ".join(rng.sample(t.split(), len(t.split()) * 2 // 3)) for _, t in items]
    import pyarrow as pa

    coded = decontaminate.read_words(pa.array(texts))
    got = {(d, i, start) for d, i, _, start, _ in index.search(*coded)}
    want, (ids, starts, names) = set(), coded
    names = names.to_pylist()
    for d in range(len(texts)):
        words = [names[k] for k in ids[starts[d] : starts[d + 1]]]
        for start in range(0, max(len(words) - 64, 1), 64):
            seen = {index.terms.get(w) for w in words[start : start + 128]}
            want |= {(d, i, start) for i, x in enumerate(index.impacts) if sum(v for t, v in x.items() if t in seen) >= 0.5}
    assert got == want and len(got) > 10


# ---- pages ----


def test_pages_of_the_table_give_their_articles(spark, small):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    rows = registry()["op10_html_extraction"](spark, small).collect()
    assert len(rows) == len(pages)
    for r in rows:
        body = re.search(r"<article>(.*?)(</article>|<footer>|$)", pages[r.page_id], re.S)[1]
        blocks = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br|li|ul|div)>", "\0", body)).split("\0")
        assert r.text == " ".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x) and r.n_chars == len(r.text)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("plain   text", "plain text"), ("<p>unclosed <script>var x='<p>no'", "unclosed"),
        ("<article><header><h1>Title &amp; more</h1></header><p>a&nbsp;b<b>c</b>d <button>Buy</button>e<p>f<ul><li>x<li>y</ul><aside>rel</aside></article>", "Title & more a bcd e f x y"),
        ("<nav><a>m</a><article><p>hello there</p></article>", "hello there"),
        ("<body class='has-sidebar'><header>Site</header><div class=cookie-banner>We use cookies</div><main><h1>T</h1><p>" + "long text " * 30 + "</p><p>Short.</p></main><section id=comments><p>" + "nice " * 90 + "</p></section></body>", "T " + ("long text " * 30).strip() + " Short."),
        ("<div><div id=a><p>" + "one two three " * 20 + "</p><p>x</p></div><div class='sidebar-left'>" + "side " * 80 + "</div><form><p>Name</p></form></div>", ("one two three " * 20).strip() + " x"),
        ("<article>a<!-- no -->b &#233;&lt;</article><footer>f</footer>", "ab é<"),
    ],
)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


PLAIN = "one two three four five six seven eight nine ten " * 6
MENU = "".join(f"<div><a href=/{w}>{w}</a></div>" for w in "home news shop about".split())


@pytest.mark.parametrize(
    ("page", "text"),
    [
        # no element or class says what is what: the ratio does
        (f"<body><div>{MENU}</div><div><p>{PLAIN}</p><p>Short.</p><p>{PLAIN}</p></div><div><span>(c)</span> <b>Firm</b> <i>2020</i></div></body>", f"{PLAIN}Short. {PLAIN}".strip()),
        (f"<body><div><h1>Title</h1></div><div><p>{PLAIN}</p></div></body>", f"Title {PLAIN}".strip()),
        (f"<body><div>{MENU}<p>{PLAIN}</p><ul><li>x<li>y</ul></div></body>", f"{PLAIN}x y"),
        (f"<div><p>{PLAIN}</p></div><div>{MENU * 3}</div><div><p>{PLAIN}</p></div>", f"{PLAIN}{PLAIN}".strip()),
        # several articles, one of them short; an article in a reader's comment
        (f"<article><p>{PLAIN}</p></article><div class=ad>Buy now</div><article><p>Tiny.</p></article>", f"{PLAIN}Tiny."),
        (f"<article><p>{PLAIN}</p></article><div class=comments><article><p>{PLAIN}</p></article></div>", PLAIN.strip()),
        # classes that may mean what is no content only weight it; clear ones leave it out
        (f"<article><p>{PLAIN}</p><div class=notice-of-results><p>{PLAIN}</p></div><div class=newsletter-signup-box><p>{PLAIN}</p></div></article>", f"{PLAIN}{PLAIN}".strip()),
    ],
)
def test_main_text_by_ratio(page, text):
    assert html_text.main_text(page) == text


def test_the_ratio_decides_where_nothing_is_marked(monkeypatch):
    page = f"<body><div><div>a</div> <div>b</div></div><div><p>{PLAIN}</p></div><div><b>c</b><i>d</i></div></body>"
    assert html_text.main_text(page) == PLAIN.strip()
    monkeypatch.setattr(html_text, "ratios", lambda size, tags: size * 0 + 1)
    assert html_text.main_text(page) != PLAIN.strip()


def test_stray_tags_take_time_in_proportion():
    html_text.main_text("<p>x")
    started = time.process_time()
    assert html_text.main_text("<b>" * 20_000 + "x" + "</i>" * 20_000 + "<p>y") == "x y"
    assert html_text.main_text("<div>" * 20_000 + "x" + "<p>y " * 2000) == ("x" + " y" * 2000)
    assert time.process_time() - started < 10


def test_pages_table_of_awkward_rows(spark):
    rows = [(1, "u", "<article>x</article>", 3), (1, "u", "<article>x</article>", 3), (None, None, None, None), (2, "v", "<p>" * 3000 + LONG, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars long")
    got = html_text.extract(pages).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == sorted([(0, 0), (1, 1), (1, 1), (2, len(" ".join(LONG.split())))])
    assert html_text.extract(pages.where("false")).count() == 0
