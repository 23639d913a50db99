"""The registered queries: SQL where there is some, columns and row counts for all."""

import hashlib
import os
import re
import sys
import zlib

import brute
import pytest
from test_support import same

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

import __spark_entry__ as entry  # noqa: E402
from oracle_harness import compare, duck_connect  # noqa: E402

from dockcast.llm.oracle import SQL  # noqa: E402
from dockcast.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_equals_its_sql(spark, key):
    r = compare(spark, duck_connect(SF), key, QUERIES[key], SQL[key], SF)
    assert r["ok"], r


def test_all_operators_are_registered():
    names = [m[1] for n in entry.queries() if (m := re.match(r"op(\d+)_", n))]
    assert sorted(map(int, names)) == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def test_sharding_query(spark, docs):
    rows = QUERIES["op1_sharding"](spark, SF).collect()
    texts = dict(docs)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    sizes = {}
    for r in rows:
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len((texts[r.doc_id] or "").encode()) + 8, brute.crc(texts[r.doc_id]), "bytes", None)
        sizes.setdefault(r.shard, []).append(r)
    total = sum(r.size for r in rows)
    assert set(sizes) == set(range(24))
    for own in sizes.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / 24) <= max(r.size for r in rows)


def test_extraction_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = QUERIES["op3_extraction"](spark, SF).collect()
    same([(r.page_id, r.url, r.text, r.n_chars) for r in rows],
         [(p.page_id, p.url, t, len(t)) for p in pages.values() for t in [brute.article(p.html)]])


def test_suffix_dedup_query(spark, docs):
    rows = QUERIES["op4_suffix_dedup"](spark, SF).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    wanted = [(d, len(kept) + removed, removed, spans, hashlib.sha256(kept).hexdigest()) for d, kept, removed, spans in brute.remove_repeats(docs)]
    assert any(w[2] for w in wanted)
    same(rows, wanted)


def test_toxicity_query(spark, docs):
    rows = QUERIES["op6_toxicity"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(d for d, _ in docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_toxicity_query_on_held_out_labels(spark):
    large = "/root/testdata/sf0.01"
    score = {r.doc_id: r.score for r in QUERIES["op6_toxicity"](spark, large).where("held_out").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{large}/labels.parquet").collect() if r.doc_id in score}
    toxic, clean = ([score[i] for i, t in labels.items() if t == kind] for kind in (1, 0))
    area = sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert area > 0.85


def test_quality_query(spark, docs):
    rows = QUERIES["op7_quality"](spark, SF).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    stats = [(d, *brute.statistics(t)) for d, t in docs]
    same(rows, [(*s, s[1] < 20 or 100 * s[5] > 30 * s[1]) for s in stats])


def test_quality_keeps_clean_and_drops_junk(spark):
    large = "/root/testdata/sf0.01"
    kept = {r.doc_id: r.kept for r in QUERIES["op7_quality"](spark, large).where("not base_failed").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{large}/labels.parquet").collect() if r.doc_id in kept}
    good, bad = ([kept[i] for i, q in labels.items() if q == kind] for kind in (1, 0))
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.2


def test_join_query(spark, docs):
    same(QUERIES["op8_ngram_join"](spark, SF).select("doc_id", "class_id", "n_links").collect(), brute.jaccard_join(docs))


def test_token_query(spark, docs):
    from dockcast.llm.tokens import TokenCounter
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        whole = TokenCounter(f.read()).whole
    counts = [(d, t or "", whole(t or "")) for d, t in docs]
    same(QUERIES["op10_tokens"](spark, SF).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect(),
         [(d, len(t.encode()), n, n > 512) for d, t, n in counts])
