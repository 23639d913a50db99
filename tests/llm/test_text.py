"""Suffix dedup, n-gram join, quality, tokens, toxicity and extraction on the fixture tables."""

import random
import re
import time
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_support import edge_docs, no_docs, pairs, prose, same  # noqa: F401  (fixtures)

from dockcast.llm import extraction, ngram_join, quality, suffix_dedup, tokens, toxicity
from dockcast.llm.components import components
from dockcast.llm.shingles import shingle_sets


def removed(docs):
    return [(r.doc_id, bytes(r.kept), r.n_removed, r.n_spans) for r in suffix_dedup.remove_repeats(docs, "doc_id", "text").collect()]


def test_repeats_equal_brute_force(edge_docs):
    wanted = brute.remove_repeats(pairs(edge_docs))
    assert sum(w[2] > 0 for w in wanted) >= 7
    same(removed(edge_docs), wanted)


def test_parts_are_cut_by_bytes(spark, monkeypatch):
    """Short and long rows: no part above its size but a longer text; equal to brute force also where few buckets are allowed."""
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 20_000)
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdefgh \n") for _ in range(n))
    rows = [(k, text(40)) for k in range(300)] + [(300 + k, text(9_000)) for k in range(30)] + [(400, text(50_000))]
    rows += [(500 + k, rows[305 + k][1][100:400]) for k in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    table = pa.table({"doc_id": [i for i, _ in rows], "body": [t.encode() for _, t in rows]})
    monkeypatch.setattr(suffix_dedup.TaskContext, "get", lambda: type("T", (), {"partitionId": lambda self: 3})())
    sizes = Counter()
    for batch in suffix_dedup._deal(iter(table.to_batches(max_chunksize=50))):
        for part, body in zip(batch.column("part").to_pylist(), batch.column("body").to_pylist()):
            sizes[part] += len(body)
    monkeypatch.undo()
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 20_000)
    assert sorted(sizes.values())[-1] == 50_000 and sorted(sizes.values())[-2] <= 20_000 and len(sizes) > 10
    tables = {t.name for t in spark.catalog.listTables()}
    spark.conf.set("spark.sql.sources.bucketing.maxBuckets", "3")
    try:
        got = removed(df)
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.maxBuckets")
    wanted = brute.remove_repeats(rows)
    assert sum(w[2] > 0 for w in wanted) >= 5
    same(got, wanted)
    assert {t.name for t in spark.catalog.listTables()} == tables


def test_repeats_of_an_empty_table(no_docs):
    assert removed(no_docs) == []


def test_repeats_across_many_parts_and_shards(spark, monkeypatch):
    """Small parts and shards: the merge by binary search has work to do."""
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 20_000)
    rng = random.Random(3)
    pool = [prose(rng, 25) for _ in range(12)]
    rows = [(k, " ".join(rng.choice(pool) if rng.random() < 0.4 else prose(rng, 12) for _ in range(rng.randint(1, 6)))) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    same(removed(docs), brute.remove_repeats(rows))


def test_shards_of_a_bucket_are_merged(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 99, 54, dtype=np.uint8)) for _ in range(9)]
    pool = [rng.integers(0, len(texts), 8) for _ in range(3)]

    def sent():
        rows = []
        for part, pick in enumerate(pool):
            pick = np.unique(pick)
            ids = np.array([100 * part + k for k in range(len(pick))], np.int64)
            rows.append((0, part, 7 * part, np.full(len(pick), 54 - suffix_dedup.SPAN, np.uint8).tobytes(), ids.tobytes(),
                         np.ones(len(pick), np.uint8).tobytes(), b"".join(texts[k] for k in pick)))
        return suffix_dedup._packed_rows(rows, suffix_dedup.SENT)

    whole = suffix_dedup._resolve(sent()).to_pylist()
    monkeypatch.setattr(suffix_dedup, "SHARD_CONTEXTS", 2)
    assert suffix_dedup._resolve(sent()).to_pylist() == whole
    assert isinstance(sent(), pa.Table)


def hot_phrase_rows(n):
    """A frequent phrase of 49 bytes with different text around it, some of it alike."""
    rng = random.Random(11)
    phrase = "The terms of use apply to every page of this site"
    pool = ["".join(rng.choices("abcdefgh ", k=200)) for _ in range(10)]
    around = lambda: rng.choice(pool) if rng.random() < 0.2 else "".join(rng.choices("abcdefgh ", k=200))
    return [(k, around() + phrase + around()) for k in range(n)]


@pytest.mark.parametrize("hot", [20, 10 ** 9])
def test_repeats_around_a_hot_phrase(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 20_000)
    monkeypatch.setattr(suffix_dedup, "HOT_CONTEXTS", hot)
    rows = hot_phrase_rows(300)
    wanted = brute.remove_repeats(rows)
    assert sum(w[2] > 0 for w in wanted) > 50
    same(removed(spark.createDataFrame(rows, "doc_id long, text string")), wanted)


def test_contexts_of_a_hot_phrase_go_to_many_buckets():
    import pyarrow as pa

    rows, buckets = hot_phrase_rows(600), 64
    parts = [pa.table({"part": [p] * 100, "doc_id": [i for i, _ in rows[100 * p:100 * p + 100]],
                       "body": [t.encode() for _, t in rows[100 * p:100 * p + 100]]}) for p in range(6)]

    def by(column, tables):
        whole = pa.concat_tables(tables)
        return {v: whole.filter(pa.compute.equal(whole.column(column), v)) for v in set(whole.column(column).to_pylist())}

    def largest(hot):
        asked = by("bucket", [suffix_dedup._ask(6)(p) for p in parts])
        told = by("part", [suffix_dedup._tell_shared(hot)(t) for t in asked.values()])
        asked = by("bucket", [suffix_dedup._ask_windows(6)(p, told[k]) for k, p in enumerate(parts)])
        more = [suffix_dedup._tell_shared(None)(t) for t in asked.values()]
        told = by("part", [*told.values(), *more])
        sent = by("bucket", [suffix_dedup._send(6, buckets)(p, told[k]) for k, p in enumerate(parts)])
        return max(sum(map(len, t.column("size").to_pylist())) for t in sent.values())

    assert 2 * largest(100) < largest(10 ** 9)


def test_suffix_ranks_and_common_prefixes():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 99, 700, dtype=np.uint8)
    data[300:420] = data[100:220]
    data[500:560] = 97
    ends = np.array([60, 250, 480, 700])
    places, rank = suffix_dedup.suffix_ranks(data, ends)
    windows = [data[p:p + 50].tobytes() for p in places]
    assert [windows[k] for k in np.argsort(rank)] == sorted(windows)
    assert all((rank[a] == rank[b]) == (windows[a] == windows[b]) for a in range(0, len(places), 3) for b in range(len(places)))
    order = np.argsort(rank)
    prefix = suffix_dedup.common_prefixes(data, places, rank, ends)
    for k in range(1, len(order)):
        a, b = windows[order[k - 1]], windows[order[k]]
        assert prefix[k] == next((i for i in range(50) if a[i] != b[i]), 50)


def joined(docs):
    return [(r.doc_id, r.class_id, r.n_links) for r in ngram_join.jaccard_join(docs, "doc_id", "text").collect()]


def test_join_equals_brute_force(edge_docs):
    wanted = brute.jaccard_join(pairs(edge_docs))
    assert sum(w[2] > 0 for w in wanted) >= 12
    same(joined(edge_docs), wanted)


def test_join_of_a_large_group(spark, monkeypatch):
    """A group of more nodes than a block: pairs of blocks, no link lost, none counted twice."""
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    rng = random.Random(9)
    base = prose(rng, 120).split()
    rows = []
    for k in range(70):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10 ** 6)}"
        rows.append((k, " ".join(w)))
    rows += [(100 + k, rows[0][1]) for k in range(30)] + [(200 + k, prose(rng, 60)) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    wanted = brute.jaccard_join(rows)
    assert max(w[2] for w in wanted) > 60
    same(joined(docs), wanted)


def chained(rng, n, step):
    """Texts each a few words on from the one before: neighbours are near, the ends share nothing."""
    stream = prose(rng, 200 + n * step).split()
    return [(k, " ".join(stream[k * step:k * step + 200])) for k in range(n)]


def test_join_of_a_chain(spark, monkeypatch):
    """A long chain is compared by buckets: every link at its place, counted once."""
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    rng = random.Random(19)
    rows = chained(rng, 120, 4) + [(200 + k, t) for k, t in chained(rng, 12, 4)]
    rows += [(300 + k, rows[50][1]) for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    wanted = brute.jaccard_join(rows)
    assert sum(w[2] > 6 for w in wanted) > 100 and len({w[1] for w in wanted}) == 2
    same(joined(docs), wanted)


@pytest.mark.parametrize("n", [1_250, 2_500, 5_000])
def test_texts_of_a_chain_grow_with_its_nodes(spark, monkeypatch, n):
    """Rows that reach the comparing tasks: at most some for each node of one group, however long."""
    monkeypatch.setattr(ngram_join, "BLOCK", 50)
    places = spark.range(n).selectExpr("id as node", "explode(sequence(0, 22)) as slot").selectExpr(
        "node", "slot", "xxhash64(slot, (node + slot) div 10) as band")
    groups = spark.range(n).selectExpr("id as node", "0L as component")
    found = ngram_join.units(places, groups)
    assert found.where("slot < 0").count() == 0 and found.where("n > 50").count() == 0
    assert n * 9 < found.count() <= n * 23
    # buckets of the same members once
    again = places.selectExpr("node", "slot", "xxhash64(slot, node div 10) as band")
    assert ngram_join.units(again, groups).count() == n


def test_one_of_each_group_stays(edge_docs, no_docs):
    out = ngram_join.drop_near_duplicates(edge_docs, "doc_id", "text")
    assert out.columns == edge_docs.columns
    kept = pairs(out)
    groups = {c for _, c, _ in brute.jaccard_join(pairs(edge_docs))}
    ids = [i for i, _ in kept if i is not None]
    assert set(ids) == {g for g in groups if g is not None} and ids.count(22) == 1 and ids.count(21) == 2
    assert ngram_join.drop_near_duplicates(no_docs, "doc_id", "text").count() == 0 and joined(no_docs) == []


def test_band_shape_reaches_its_recall():
    bands, rows = ngram_join.band_shape(0.8)
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.999 and bands * rows <= ngram_join.MAX_HASHES


def test_shingles_equal_brute_force(edge_docs):
    texts = [t for _, t in pairs(edge_docs)]
    got, wanted = shingle_sets(texts), [brute.shingles(t) for t in texts]
    assert [len(g) for g in got] == [len(w) for w in wanted]
    for a in range(len(texts)):
        for b in range(a):
            assert len(np.intersect1d(got[a], got[b])) == len(wanted[a] & wanted[b])


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(k, k + 1) for k in range(500, 560)] + [(600, 600)]
    root = {}

    def find(k):
        while root.setdefault(k, k) != k:
            k = root[k]
        return k

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    wanted = [(k, find(k)) for k in list(root) if any(k in e and e[0] != e[1] for e in edges)]
    same(components(spark.createDataFrame(edges, "a long, b long")).collect(), wanted)


def test_statistics_equal_brute_force(edge_docs):
    out = quality.judge(edge_docs, "text", "lang", "source")
    rows = out.select("row.doc_id", "row.text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    same([(r.doc_id, r.text) for r in rows], pairs(edge_docs))
    for r in rows:
        s = brute.statistics(r.text)
        assert tuple(r[2:7]) == s and r.base_failed == (s[0] < 20 or 100 * s[4] > 30 * s[0])
        assert not (r.base_failed and r.kept)
    assert out.select("row.*").columns == edge_docs.columns


def vectors(texts):
    x = []
    for t in texts:
        n, c, s, l, r = brute.statistics(t)
        x.append([np.log1p(n), np.log1p(c / n), np.log1p(100 * s / c), np.log1p(20 * l / n), np.log1p(10 * r / n)])
    return np.array(x)


def verdicts(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string").repartition(3)
    out = quality.judge(docs, "text", "lang", "source", ["doc_id"]).select("row.doc_id", "distance", "base_failed", "kept").collect()
    return {r.doc_id: r for r in out}


@pytest.mark.parametrize("share", [0.03, 0.3, 0.4])
def test_outliers_by_brute_force(spark, share):
    """Verdicts row by row against plain numpy; clustered outliers go, be they few or a large part, and
    ordinary rows stay."""
    rng = random.Random(6)
    n = round(400 * share)
    rows = [(k, prose(rng, rng.randint(60, 400))) for k in range(400 - n)]
    rows += [(1000 + k, prose(rng, 100).replace(" ", "### ")) for k in range(n)]
    got = verdicts(spark, rows)
    assert not any(got[1000 + k].kept for k in range(n)) and sum(got[k].kept for k in range(400 - n)) > 0.98 * (400 - n)
    wanted = brute.robust_distances(vectors([t for _, t in rows]), quality.FLOOR)
    for (i, _), d in zip(rows, wanted):
        assert got[i].kept == (d <= quality.CUTOFF) and got[i].distance == pytest.approx(d, rel=1e-6)


def test_mild_outliers_in_each_coordinate(spark):
    rng = random.Random(16)
    rows = [(k, prose(rng, rng.randint(60, 400))) for k in range(400)]

    def repeated(n, again):
        w = prose(rng, n).split()
        return " ".join(w[:again] + w[:again] + w[again:n - again])

    def sprinkled(percent):
        w = prose(rng, 200).split()
        for _ in range(int(sum(map(len, w)) * percent / 100)):
            w[rng.randrange(len(w))] += "#"
        return " ".join(w)

    planted = {"length": prose(rng, 6_000), "word_length": " ".join(prose(rng, 3).replace(" ", "") for _ in range(150)),
               "symbols": sprinkled(4), "lines": "\n".join("the same line\n" + prose(rng, 9) for _ in range(20)),
               "repeats": repeated(200, 25)}
    rows += [(1000 + k, t) for k, t in enumerate(planted.values())]
    got = verdicts(spark, rows)
    for k, name in enumerate(planted):
        assert not got[1000 + k].base_failed and not got[1000 + k].kept, (name, got[1000 + k])
    assert all(got[k].kept for k in range(400))


def test_quality_of_no_rows(no_docs):
    assert quality.judge(no_docs, "text", "lang", "source").count() == 0


def spec():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


def test_token_counts_equal_the_library():
    counter, rng = tokens.TokenCounter(spec()), random.Random(12)
    alphabet = ["a", "the", " ", "  ", "\n", "\t", "\r\n", "'s", "'", "é", "😀", "日本", "1", "23", "!", "...", "<|endoftext|>", "\u00a0", "\u2003", "\u0301",
                "\x1c", "\x85", "x" * 70]
    texts = ["", " ", "   ", "<|endoftext|>", "a <|endoftext|> b", " a", "a "] + ["".join(rng.choices(alphabet, k=rng.randint(1, 12))) for _ in range(4000)]
    assert counter.count(texts) == [len(counter.library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_token_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 50)
    counter, rng = tokens.TokenCounter(spec()), random.Random(1)
    for _ in range(20):
        texts = [prose(rng, 8) for _ in range(4)]
        assert counter.count(texts) == [counter.whole(t) for t in texts]
        assert len(counter.cache) <= 100


def test_token_query_on_edge_rows(edge_docs, no_docs):
    counter = tokens.TokenCounter(spec())
    got = edge_docs.select("doc_id", "text", tokens.count_tokens(edge_docs, F.col("text"), spec()).alias("n")).collect()
    same([(r.doc_id, r.text) for r in got], pairs(edge_docs))
    assert all(r.n == (counter.whole(r.text) if r.text else 0) for r in got)
    assert no_docs.select(tokens.count_tokens(no_docs, F.col("text"), spec())).count() == 0


def toxic_tables(spark, n=600):
    rng, bad = random.Random(8), ["idiot", "moron", "scum"]
    rows, labels = [], []
    for k in range(n):
        w = prose(rng, rng.randint(20, 120)).split()
        toxic = k % 6 == 0
        if toxic:
            for _ in range(rng.randint(1, 3)):
                w.insert(rng.randrange(len(w)), rng.choice(bad))
        rows.append((k, " ".join(w)))
        labels.append((k, 1, int(toxic)))
    return (spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_tables(spark)
    out = toxicity.score_toxicity(docs, "text", labels, F.col("doc_id") % 4 != 2).select("row.doc_id", "score").collect()
    held = [(r.score, r.doc_id % 6 == 0) for r in out if r.doc_id % 4 == 2]
    assert sum((s >= toxicity.THRESHOLD) == t for s, t in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in out) and len(out) == 600


def test_toxicity_features_of_long_words_take_linear_time():
    old = re.compile(r"[^\W\d_]+[0-9@$*!|]+[^\W\d_]+")
    rng = random.Random(2)
    for _ in range(5000):
        text = "".join(rng.choice("aéB1@$ _!|*z") for _ in range(rng.randint(0, 20)))
        assert toxicity.OBFUSCATED.findall(text) == old.findall(text)
    for text in ("a" * 1_000_000, "a1" * 500_000, "aa" + "1" * 1_000_000):
        began = time.process_time()
        assert len(toxicity.features(text, {}, {})) == len(toxicity.FEATURES)
        assert time.process_time() - began < 3


def test_toxicity_trains_on_the_least_hashes(spark):
    docs = spark.range(5000).withColumnRenamed("id", "doc_id")
    labels = docs.withColumn("toxic", (F.col("doc_id") % 2).cast("int"))
    got = {r.doc_id for r in toxicity.training_labels(docs, labels, F.lit(True), 1000).collect()}
    least = labels.orderBy(F.xxhash64("doc_id")).limit(1000).collect()
    assert got == {r.doc_id for r in least}


def test_toxicity_of_edge_rows(spark, edge_docs, no_docs):
    _, labels = toxic_tables(spark, 60)
    odd = labels.union(spark.createDataFrame([(1, 1, None), (None, 0, 1), (2, 1, 1), (2, 1, 0)], labels.schema))
    out = toxicity.score_toxicity(edge_docs, "text", odd, F.lit(True))
    assert out.select("row.*").columns == edge_docs.columns
    same([(r.doc_id, r.text) for r in out.select("row.doc_id", "row.text").collect()], pairs(edge_docs))
    assert out.where("score is null or score < 0 or score > 1").count() == 0
    alike = toxicity.score_toxicity(edge_docs, "text", labels.where("toxic = 0"), F.lit(True))
    assert [r.score for r in alike.select("score").distinct().collect()] == [0.0]
    assert toxicity.score_toxicity(no_docs, "text", labels.where("false"), F.lit(True)).count() == 0


PAGES = [
    ("<html><head><title>T</title></head><body><header><a href='/'>Site</a></header><nav><ul><li><a>One</a><li><a>Two</a></ul></nav><article><h1>A &amp; B</h1>"
     "<p>First   paragraph\n of it.<p>Second &lt;one&gt;.<div class='comments'><p>Nice post!</p></div><aside>See also this.</aside><form><p>Mail us</p>"
     "</form></article><footer>&copy; 2020</footer><script>var x = '<p>no</p>';</script></body>", "A & B\nFirst paragraph of it.\nSecond <one>."),
    ("<main><p>Text <b>in <i>parts</i></b>, whole.</p><div id=cookie-notice>We use cookies</div></main>", "Text in parts, whole."),
    ("", ""), (None, ""), ("<p", "<p"), ("<!-- only -->", ""), ("<article>unclosed <p>end", "unclosed\nend"),
    ("<nav><a>menu</a></nav><div class=content><p>A long enough sentence stands in this block of text, and it ends well.</p></div>",
     "A long enough sentence stands in this block of text, and it ends well."),
]


def test_pages(spark):
    df = spark.createDataFrame([(k, h) for k, (h, _) in enumerate(PAGES)] + [(0, PAGES[0][0])], "page_id long, html string")
    got = df.select("page_id", extraction.extract(df, F.col("html")).alias("text")).collect()
    for r in got:
        if PAGES[r.page_id][0] != "<p":                 # broken markup: any defined result
            assert r.text == PAGES[r.page_id][1], r
    assert len(got) == len(PAGES) + 1
    empty = df.where("false")
    assert empty.select(extraction.extract(empty, F.col("html"))).count() == 0


BODY = "<p>A long enough sentence stands in this block of text, and it ends well.</p>"
SAYS = "A long enough sentence stands in this block of text, and it ends well."


@pytest.mark.parametrize("page, wanted", [
    (f"<article class='post-12 post type-post tag-python hentry'>{BODY}</article>", SAYS),
    (f"<div class='content has-sidebar'>{BODY}</div>", SAYS),
    (f"<div class='main-content layout-right-sidebar'>{BODY}</div>", SAYS),
    (f"<article><div class='entry-header'><h1>Title</h1></div>{BODY}</article>", "Title\n" + SAYS),
    (f"<main class='search'>{BODY}</main>", SAYS),
    (f"<div class='widget'><p>Join us now</p><article>{BODY}</article></div>", SAYS),
    (f"<nav class=menu><article>{BODY}</article></nav>", ""),
    (f"<div id=comments><article class='comment-body'>{BODY}</article></div>", ""),
    (f"<article>{BODY}<div class='share-buttons'><p>Send this on to all friends.</p></div><div id=comments>{BODY}</div></article>", SAYS),
    (f"<article>{BODY}<div class='ad'>{BODY}</div><div class='cookie-notice'>{BODY}</div></article>", SAYS),
])
def test_names_with_a_word_of_boilerplate(page, wanted):
    assert extraction.main_text(page, extraction.PRIOR) == wanted


OTHER = "<p>Readers wrote this long sentence below the text, and it ends here too.</p>"


@pytest.mark.parametrize("name", [
    "reader-comments", "user-comments", "usercomments", "comment-thread", "post-comments-list", "post-sidebar", "content-sidebar",
    "sidebar sidebar-main", "post-footer", "article-footer", "entry-meta", "related-articles", "story-related", "newsletter-signup",
    "site-notice", "notice-bar", "cookie-law", "banner-ad", "content-ad", "adsbygoogle", "main-nav-wrapper", "nav-main", "menu-main",
    "widget_text", "readerComments", "comments", "site-header"])
def test_boilerplate_by_its_name(name):
    for page in (f"<article>{BODY}<div class='{name}'>{OTHER}</div></article>", f"<article>{BODY}</article><div class='{name}'>{OTHER}</div>",
                 f"<div class=content>{BODY}<div id={name.split()[-1]}>{OTHER}</div></div>"):
        if name != "site-header" or "<article>" not in page:
            assert extraction.main_text(page, extraction.PRIOR) == SAYS, page
    if "omment" in name:
        assert extraction.main_text(f"<article>{BODY}</article><div class='{name}'><article>{OTHER}</article></div>", extraction.PRIOR) == SAYS


RUNNING = "<p>" + "Many words of running text stand in this block of the page, one after another, so that it counts as text. " * 2 + "</p>"


@pytest.mark.parametrize("page, wanted", [
    (f"<article title='The hidden cost of it'>{BODY}</article>", SAYS),
    (f"<article class='a hidden b'>{BODY}</article>", SAYS),
    ("<article><p>See <a title='A hidden gem'>this link</a> now.</article>", "See this link now."),
    ("<article><p>So <math><mi>x</mi><mo>+</mo><mn>1</mn></math> holds.</article>", "So x+1 holds."),
    (f"<form id=aspnet><nav><a>One</a></nav><article>{BODY}</article></form>", SAYS),
    (f"<form id=aspnet><div id=content>{RUNNING}<form>{OTHER}</form></div></form>", " ".join(RUNNING[3:-4].split())),
    (f"<article>{BODY}<form>{OTHER}</form></article>", SAYS),
    (f"<form><p>Your name</p><p>Your mail</p></form><article>{BODY}</article>", SAYS),
    (f"<article class='post hentry category-social comments-open'>{BODY}</article>", SAYS),
    (f"<div class='content sidebar-right'>{BODY}</div>", SAYS),
    (f"<article data-x='a > b' title=\"it's\">{BODY}</article>", SAYS),
    (f"<article><p title='no end>{SAYS}</p></article>", SAYS),
])
def test_articles_that_stay(page, wanted):
    assert extraction.main_text(page, extraction.PRIOR) == wanted


@pytest.mark.parametrize("unit", [
    "<a ", "<div>", "<div>x", "<li>a", "word ", "<a b=\"", "<a b='x>", "<form>x", "<!--", "<!", "</x", "x=y ", "<p>word</p>", "&amp", "<script>"])
def test_long_odd_pages_take_linear_time(unit):
    def seconds(size):
        page = "<article>" + unit * (size // len(unit)) + "</article>"
        began = time.process_time()
        extraction.main_text(page, extraction.PRIOR)
        return time.process_time() - began
    assert seconds(1_000_000) < max(20 * seconds(100_000), 2)


def test_generated_pages_equal_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in pages.select("html", extraction.extract(pages, F.col("html")).alias("text")).collect():
        assert r.text == brute.article(r.html)


def test_weights_do_not_depend_on_the_order_of_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html")
    rows = pages.collect()
    weights = [extraction.train_weights(spark.createDataFrame(r, "html string").repartition(n), F.col("html"), 20)
               for r, n in ((rows, 1), (rows[::-1], 1), (rows + rows[:1] * 50, 5))]
    assert weights[0] != extraction.PRIOR and weights[0] == weights[1] == weights[2]


def test_minimum_cut_is_least():
    rng = random.Random(4)
    for _ in range(150):
        n = rng.randint(1, 8)
        gains = [rng.choice([-3, -1, -0.2, 0, 0.2, 1, 3]) * rng.random() for _ in range(n)]
        edges = [(a, b, rng.random()) for a in range(n) for b in range(a) if rng.random() < 0.5]
        price = lambda labels: sum(max(g, 0) if not c else max(-g, 0) for g, c in zip(gains, labels)) + sum(w for a, b, w in edges if labels[a] != labels[b])  # noqa: E731, B023
        least = min(price([bool(m >> k & 1) for k in range(n)]) for m in range(1 << n))
        assert price(extraction.minimum_cut(gains, edges)) == pytest.approx(least)
