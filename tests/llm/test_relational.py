"""Sharding, decontamination, mixing and chat formatting on the fixture tables."""

import hashlib
import random
import re

import brute
import pytest
from pyspark.sql import functions as F
from test_support import CLASH, edge_docs, no_docs, pairs, same  # noqa: F401  (fixtures)

from dockcast.llm import chat, common, decontamination, mixing, sharding


def placed(docs, n, order=("doc_id",)):
    return sharding.assign_shards(docs, n, sharding.document_bytes(F.col("text")), list(order))


@pytest.mark.parametrize("n", [1, 3, 24])
def test_shards_are_contiguous_and_even(edge_docs, n):
    out = placed(edge_docs, n)
    rows = out.select("doc_id", "text", "size", "shard", "slot").collect()
    same([(r.doc_id, r.text) for r in rows], pairs(edge_docs))
    assert all(r.size == len((r.text or "").encode()) + 8 for r in rows)
    held = {}
    for r in rows:
        held.setdefault(r.shard, []).append(r)
    total, largest = sum(r.size for r in rows), max(r.size for r in rows)
    for s, own in held.items():
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert 0 <= s < n and abs(sum(r.size for r in own) - total / n) <= largest
    ids = [r.doc_id or 0 for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert ids == sorted(ids)                              # null ids first
    assert set(CLASH) <= set(out.columns) and len(set(out.columns)) == len(out.columns)


def test_shards_split_a_hot_key(spark):
    """A third of all rows under one id is still spread evenly."""
    docs = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("abcd").alias("text"))
    sizes = [r.n for r in placed(docs, 10).groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    assert len(sizes) == 10 and max(sizes) - min(sizes) <= 24


def test_no_rows(no_docs):
    assert placed(no_docs, 4).count() == 0
    assert mixing.mix_sources(no_docs, "source", mixing.word_count(F.col("text")), [F.col("doc_id")]).count() == 0


ITEMS = [(1, "x"), (2, None), (3, ""), (4, "one TWO"), (5, None), (None, "a b c d e f g h a b c d"), (6, "never seen anywhere at all")]


def items(spark, edge_docs):
    passage = edge_docs.where("doc_id = 14").first().text
    return spark.createDataFrame(ITEMS + [(7, "Before " + passage), (7, passage), (8, " ".join(passage.split()[20:30]))], "item_id long, text string")


def test_decontamination_equals_brute_force(spark, edge_docs):
    bench = items(spark, edge_docs)
    found = decontamination.find_matches(edge_docs, F.col("text"), bench, F.col("item_id"), F.col("text"))
    ids = decontamination.hit_items(F.col("hits"))
    n_hit = decontamination.hit_words(F.col("hits"))
    got = found.select("row.doc_id", "n_words", n_hit, F.size(ids), F.sha2(F.array_join(ids, ","), 256), n_hit > 0).collect()
    wanted = brute.decontaminate(pairs(edge_docs), [(r.item_id, r.text) for r in bench.collect()])
    assert sum(w[5] for w in wanted) >= 6
    same(got, wanted)
    assert found.select("row.*").columns == edge_docs.columns


def test_decontamination_where_the_bitmap_is_full(spark, edge_docs, monkeypatch):
    """Texts that share a place of the bitmap with others, and items too long to be shipped."""
    monkeypatch.setattr(decontamination, "FILTER_BITS", 2)
    monkeypatch.setattr(common, "SMALL_BYTES", 0)
    test_decontamination_equals_brute_force(spark, edge_docs)


def test_decontamination_of_empty_tables(spark, edge_docs, no_docs):
    bench = items(spark, edge_docs)
    args = F.col("item_id"), F.col("text")
    assert decontamination.find_matches(no_docs, F.col("text"), bench, *args).count() == 0
    clean = decontamination.find_matches(edge_docs, F.col("text"), bench.where("false"), *args)
    assert clean.where("hits is not null").count() == 0 and clean.count() == edge_docs.count()


def test_proximity_matches(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    w = item.split()
    docs = spark.createDataFrame([(1, item), (2, " ".join(w[:5] + ["extra"] + w[5:])), (3, " ".join(reversed(w))), (4, "alpha kappa"),
                                  (5, " ".join(w[:5] + ["far"] * 40 + w[5:]))], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = decontamination.find_matches(docs, F.col("text"), bench, F.col("item_id"), F.col("text"), slop=2, share=0.9)
    hits = {r.doc_id: [h.exact for h in r.hits or []] for r in found.select("row.doc_id", "hits").collect()}
    assert True in hits[1] and hits[2] and True not in hits[2]
    assert not hits[4] and not hits[5]


@pytest.mark.parametrize("slop, share", [(2, 0.8), (0, 0.8), (3, 1.0), (1, 0.5)])
def test_proximity_matches_equal_brute_force(spark, slop, share):
    rng = random.Random(7)
    w = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()
    bench = [(1, " ".join(w)), (2, "one two one three"), (3, "nowhere else beta")]
    texts = [" ".join(w), " ".join(w[:4] + ["unseen"] + w[5:]), " ".join(w[:1] + [w[6]] + w[2:6] + [w[1]] + w[7:]), "alpha kappa", "beta", "two one three",
             " ".join(w[:5] + ["far"] * 9 + w[5:])]
    for _ in range(40):
        own = [x if rng.random() < 0.85 else rng.choice(["other", "far", rng.choice(w)]) for x in w]
        k = rng.randrange(len(own) - 1)
        own[k], own[k + 1] = own[k + 1], own[k]
        texts.append(" ".join(["pad"] * rng.randint(0, 5) + own[rng.randint(0, 3):] + ["pad"] * rng.randint(0, 5)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = decontamination.find_matches(docs, F.col("text"), spark.createDataFrame(bench, "item_id long, text string"),
                                         F.col("item_id"), F.col("text"), slop=slop, share=share)
    got = [(r.doc_id, h.item_id, h.start, h.width, h.exact) for r in found.select("row.doc_id", "hits").collect() for h in r.hits or []]
    wanted = []
    for doc, text in enumerate(texts):
        t = brute.words(text)
        for item, body in bench:
            b = brute.words(body)
            n = min(len(b), 10)
            for window in (b[s:s + n] for s in range(len(b) - n + 1)):
                for at in range(max(len(t) - n, 0) + 1):
                    terms = set(window)
                    if len(terms & set(t[max(at - slop, 0):at + n + slop])) >= share * len(terms) - 1e-9:
                        wanted.append((doc, item, at, n, t[at:at + n] == window))
    assert any(not x[4] for x in wanted)
    same(got, wanted)


def test_targets_stop_at_the_cap(spark):
    """Excess goes to the others by weight until none is above its cap."""
    sizes = {"a": 10, "b": 1000, "c": 5, "d": 400, None: 100}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df, (1, 2, 3), 3).collect()}
    weight = dict(zip(["a", "b", "c", "d", None], (1, 2, 3, 1, 2)))
    total, capped = sum(sizes.values()), set()
    while True:
        free = total - sum(3 * sizes[s] for s in capped)
        level = free / sum(weight[s] for s in sizes if s not in capped)
        more = {s for s in sizes if s not in capped and weight[s] * level > 3 * sizes[s]}
        if not more:
            break
        capped |= more
    for s in sizes:
        assert got[s] == pytest.approx(3 * sizes[s] if s in capped else weight[s] * level)
    assert sum(got.values()) == pytest.approx(total) and capped


def test_mix_comes_near_its_targets(edge_docs):
    mixed = mixing.mix_sources(edge_docs, "source", mixing.word_count(F.col("text")), [F.col("doc_id"), F.col("text")])
    rows = mixed.select("row.source", "row.doc_id", "row.text", "size", "source_size", "target", "times").collect()
    same([(r.doc_id, r.text) for r in rows], pairs(edge_docs))
    assert all(r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) and 0 <= r.times <= 3 for r in rows)
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert own[0].source_size == sum(r.size for r in own)
        assert abs(sum(r.size * r.times for r in own) - own[0].target) <= max(r.size for r in own)
    again = mixing.mix_sources(edge_docs.repartition(5), "source", mixing.word_count(F.col("text")), [F.col("doc_id"), F.col("text")])
    same(again.select("row.doc_id", "row.text", "times").collect(), mixed.select("row.doc_id", "row.text", "times").collect())


def test_mix_ends_between_equal_rows(spark):
    """A source of equal rows, in many partitions: as many are taken as the target holds."""
    rows = [(7, "a", "one two three four five")] * 400 + [(k, "b", "w " * 1000) for k in range(3)] + [(k, None, "x y z") for k in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(13)
    got = mixing.mix_sources(df, "source", mixing.word_count(F.col("text")), [F.col("doc_id"), F.col("text")]).select(
        "row.source", "size", "target", "times").collect()
    assert len(got) == len(rows)
    for source in ("a", "b", None):
        own = [r for r in got if r.source == source]
        assert abs(sum(r.size * r.times for r in own) - own[0].target) <= own[0].size / 2
    assert len({r.times for r in got if r.source == "a"}) == 2


SAID = ["", " ", "</s>[INST] ok [/INST]", "\\</s>", "\\\\[INST]", "a\\", "<s> [/INST] <s>", "[INST", "[/INST] ", "\\\\\\<s>x\\", "é😀\n"]


def test_chat_round_trip(spark):
    rows = [(1, k, ("user", "assistant", "assistant", "sys[INST]tem\\")[k % 4], t) for k, t in enumerate(SAID)]
    rows += [(2, 0, None, None), (2, 0, "assistant", "tie b"), (2, 0, "assistant", "tie a"), (2, None, "user", "first"), (None, 1, "user", "x"),
             (3, 0, "user", "same"), (3, 0, "user", "same"), (4, 0, "assistant", "</s>")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in ("turns", "segments", "t")})
    out = chat.format_chats(df, *[F.col(c) for c in ("conv_id", "turn", "role", "text")])
    got = {r.conv_id: r for r in out.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("read"),
                                            chat.loss_text(F.col("segments")).alias("loss"), "segments").collect()}
    assert set(got) == {1, 2, 3, 4, None}
    for conv, r in got.items():
        own = sorted(((-1 if t is None else t), role or "", text or "") for c, t, role, text in rows if c == conv)
        assert [(x.role, x.text) for x in r.read] == [(role, text) for _, role, text in own]
        assert r.loss == "".join(text for _, role, text in own if role == "assistant")
        assert r.formatted == "".join(s.text for s in r.segments)
    assert got[1].formatted.count(chat.OPEN) < len(SAID)          # adjacent assistant turns share a block
    assert chat.format_chats(df.where("false"), *[F.col(c) for c in ("conv_id", "turn", "role", "text")]).count() == 0


def test_chat_digest_of_the_planted_conversation(spark):
    from dockcast.llm.queries import op9_chat

    r = op9_chat(spark, "/root/testdata/sf0.001").where("conv_id = -7").first()
    says = "</s>[INST] ok [/INST]"
    assert r.n_turns == 2 and r.loss_chars == len(says) and r.loss_sha256 == hashlib.sha256(says.encode()).hexdigest()
    assert r.turns_sha256 == hashlib.sha256(f"user\n{says}\nassistant\n{says}\n".encode()).hexdigest()
