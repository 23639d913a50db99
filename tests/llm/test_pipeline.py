"""The pipeline's stages against brute force, each on its own input, over the small tables."""

import collections
import os
import sys

import brute
import duckdb
import pytest
from test_support import pairs, same

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402

from dockcast.llm.common import cut  # noqa: E402
from dockcast.llm.oracle import SQL  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def results(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, SF), f"test-{name}")
        out.append(docs)
    return out


def test_stages_keep_the_columns(results):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_join", "decontamination", "mixing", "sharding"]
    for df in results[:5]:
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_toxicity_drops_toxic_and_keeps_clean(spark, results):
    kept = {i for i, _ in pairs(results[1])}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    toxic, clean = [i for i in labels if labels[i]], [i for i in labels if not labels[i]]
    assert sum(i in kept for i in clean) / len(clean) > 0.95
    assert sum(i in kept for i in toxic) / len(toxic) < 0.35


def test_one_of_each_near_duplicate_group(results):
    before = pairs(results[1])
    index, sets = collections.defaultdict(list), {i: brute.shingles(t) for i, t in before}
    for i, s in sets.items():
        for g in s:
            index[g].append(i)
    root = {i: i for i in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    shared = collections.Counter()
    for ids in index.values():
        shared.update((a, b) for a in ids for b in ids if a < b)
    for (a, b), n in shared.items():
        if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n) - 1e-9:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert {i for i, _ in pairs(results[2])} == {find(i) for i in sets}


def test_contaminated_documents_go(results):
    con = duckdb.connect()
    documents = results[2].toPandas()
    con.register("documents", documents)
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SF}/benchmark.parquet'")
    clean = {r[0] for r in con.sql(SQL["op2_decontamination"]).filter("NOT contaminated").project("doc_id").fetchall()}
    assert {i for i, _ in pairs(results[3])} == clean and len(clean) < len(documents)


def test_mix_takes_what_the_sql_takes(results):
    con = duckdb.connect()
    con.register("documents", results[3].toPandas())
    wanted = {r[0]: r[4] // r[1] if r[1] else None for r in con.sql(SQL["op5_mixing"]).project("doc_id, size, source_size, target, taken").fetchall()}
    got = collections.Counter(i for i, _ in pairs(results[4]))
    assert all(got[i] == n for i, n in wanted.items() if n is not None) and set(got) <= set(wanted)


def test_all_rows_are_sharded(results):
    rows = results[5].select("doc_id", "text", "shard", "slot", "size").collect()
    same([(r.doc_id, r.text) for r in rows], pairs(results[4]))
    sizes = collections.Counter()
    for r in rows:
        sizes[r.shard] += r.size
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 2 * max(r.size for r in rows)


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, SF), "test-empty")
    assert docs.count() == 0


def test_run_is_the_stages_in_turn(spark, results):
    same(corpus_pipeline.run(spark, SF).select("doc_id", "shard", "slot").collect(), results[5].select("doc_id", "shard", "slot").collect())
