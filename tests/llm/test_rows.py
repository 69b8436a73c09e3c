"""Mixing, sharding, searches, near-duplicates and URL rules against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerspark.llm import ann, dedup, mixing, queries, sharding, topk, url_filter
from ledgerspark.scratch import scratch_path

FOLDER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, clashing columns, a hot source."""
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices("abcdefgh", k=rng.randint(0, 40))), "s1" if i % 3 else rng.choice(["s2", None, "S"])) for i in range(300)]
    rows += [(300, "x " * 20_000, "s2"), (301, None, "s1"), (None, "a b c", None), (302, "", "only"), (5, rows[5][1], rows[5][2])]
    return spark.createDataFrame([(i, t, None, s, None, 0, 0) for i, t, s in rows], DOCS)


def test_targets_stop_and_are_shared_again():
    goals = mixing.weighted_targets([100, 10, 50], [3, 1, 2], 1.5, 2)
    assert goals == pytest.approx([132, 20, 88])
    assert all(g <= 2 * n + 1e-9 for g, n in zip(goals, [100, 10, 50]))
    assert mixing.weighted_targets([0, 0], [1, 1], 1.5, 2) == [0, 0] and mixing.weighted_targets([], [], 1.5, 2) == []


def test_permutations_are_bijections():
    for count in (1, 2, 3, 17, 256, 1000):
        found = mixing.permuted(np.arange(count), np.full(count, count), np.full(count, 99))
        assert sorted(found) == list(range(count))


def test_tree_deals_every_block_once_whoever_walks_it():
    quotas = np.array([500, 3, 0, 77])
    whole = list(mixing.shard_quotas(quotas, 13, 0, 13, 5))
    assert (sum(own for _, _, own in whole) == quotas).all()
    parts = [x for a in range(0, 13, 4) for x in mixing.shard_quotas(quotas, 13, a, min(13, a + 4), 5)]
    assert [(s, b.tolist(), o.tolist()) for s, b, o in whole] == [(s, b.tolist(), o.tolist()) for s, b, o in parts]
    assert max(o.sum() for _, _, o in whole) - min(o.sum() for _, _, o in whole) <= 1


@pytest.mark.parametrize("block_words", [64, 8192])
def test_mix_meets_its_targets(odd, block_words):
    mixed = mixing.mix_documents(odd, block_words=block_words, shard_words=5000)
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["words"])
    rows = mixed.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken")).collect()
    words = Counter((r.doc_id, len(WORD.findall(r.text or ""))) for r in odd.collect())
    assert Counter((r.doc_id, r["size"]) for r in rows) == words
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert own[0].source_size == sum(r["size"] for r in own)
        assert abs(sum(r.taken for r in own) - own[0].target) <= 2
    assert all(r.taken <= 2 * r["size"] for r in rows)
    again = mixing.mix_documents(odd, block_words=block_words, shard_words=5000)
    again = again.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken")).collect()
    assert Counter(rows) == Counter(again)


def test_the_mix_is_dealt_out_by_shard_and_shuffled(spark):
    rows = [(i, " ".join(["w"] * (20 + i % 30)), None, f"s{i % 3}", None, None, None) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, ids string")
    settings = {"block_words": 64, "shard_words": 10_000}
    dealt = mixing.shuffled_shards(docs, **settings).select("*", F.spark_partition_id().alias("task")).collect()
    words, tasks, order = Counter(), {}, {}
    for r in dealt:
        words[r["__shard"]] += len(r.text.split())
        tasks.setdefault(r["__shard"], set()).add(r.task)
        order.setdefault(r["__shard"], []).append(r.doc_id)
    assert len(words) > 10 and all(len(t) == 1 for t in tasks.values())
    assert max(words.values()) < 1.2 * np.mean(list(words.values())) and min(words.values()) > 0.8 * np.mean(list(words.values()))
    assert all(ids != sorted(ids) for ids in order.values())
    shares = {s: Counter(r.source for r in dealt if r["__shard"] == s) for s in words}
    whole = Counter(r.source for r in dealt)
    for source, n in whole.items():  # every shard mixes the sources as the whole does
        assert all(abs(c[source] / sum(c.values()) - n / len(dealt)) < 0.15 for c in shares.values())
    path = scratch_path(spark, "mix")
    mixing.write_mix(docs, path, **settings)
    written = spark.read.parquet(path)
    assert Counter((r["__shard"], r.doc_id) for r in written.collect()) == Counter((r["__shard"], r.doc_id) for r in dealt)
    with pytest.raises(ValueError):
        mixing.shuffled_shards(docs.withColumn("__shard", F.lit(1)))


def test_each_shard_of_the_mix_is_a_task_of_its_own(spark):
    docs = spark.range(600).selectExpr("id AS doc_id", "'s' AS source", "repeat(concat('w', id, ' '), 50) AS text")
    dealt = mixing.shuffled_shards(docs, block_words=64, shard_words=2000)
    places = dealt.select("__shard", F.spark_partition_id().alias("task")).distinct().collect()
    assert len(places) == len({r["__shard"] for r in places}) == len({r.task for r in places}) > 20


def test_mixed_texts_are_whole_but_one_for_each_source(odd):
    mixed = mixing.mixed_texts(odd, block_words=64).collect()
    whole = {r.doc_id: r.text for r in odd.collect()}
    cut = [r for r in mixed if r.text != whole[r.doc_id]]
    assert all(whole[r.doc_id].startswith(r.text) for r in cut)
    assert max(Counter(r.source for r in cut).values(), default=0) <= 2
    assert mixing.mix_documents(odd.limit(0)).count() == 0


@pytest.mark.parametrize("block_words", [64, 8192])
def test_mixed_texts_are_never_cut_and_near_the_target(spark, odd, block_words):
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.randint(50, 900)), None, f"s{i % 4}", None, 0, 0) for i in range(400, 440)]
    docs = odd.unionAll(spark.createDataFrame(rows, DOCS))
    whole = {r.doc_id: r.text for r in docs.collect()}
    goals = {r.source: r.target for r in mixing.mix_documents(docs, block_words=block_words).collect()}
    longest, taken = Counter(), Counter()
    for r in docs.collect():
        longest[r.source] = max(longest[r.source], len(WORD.findall(r.text or "")))
    for r in mixing.mixed_texts(docs, block_words=block_words).collect():
        assert r.text == whole[r.doc_id]
        taken[r.source] += len(WORD.findall(r.text or ""))
    assert all(abs(taken[s] - goals[s]) <= longest[s] / 2 + 1 for s in goals)


@pytest.mark.parametrize("parts", [5, 20_000])
def test_shards_are_even_and_numbered(odd, parts):
    rows = sharding.shard_by_bytes(odd, 8, rows_per_part=parts).collect()
    assert len(rows) == odd.count()
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    loads, slots = Counter(), defaultdict(list)
    for r in rows:
        assert (r["size"], r.text_crc32) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id].encode()))
        loads[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_by_bytes(odd.limit(0)).count() == 0


def test_shards_split_a_hot_group(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text here").otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("text"))
    loads = [r.b for r in sharding.shard_by_bytes(docs, 8, rows_per_part=100).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(loads) == 8 and max(loads) - min(loads) <= 0.02 * sum(loads) / 8 + 30


def brute(vectors, queries_, k, score):
    out = {}
    for q in queries_:
        found = sorted(((-score(vectors[q], v), i) for i, v in vectors.items() if i != q and len(v) == len(vectors[q])))
        out[q] = [(i, -s) for s, i in found[:k]]
    return out


@pytest.fixture(scope="module")
def odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(400)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(400, 700)]  # a hot vector
    bad = [(700, None), (800, [1.0, None, 0.0, 0.0]), (900, [float("nan"), 0.0, 0.0, 0.0]), (1000, [float("inf")] * 4), (None, [1.0] * 4), (1100, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 0, 0.0) for i, v in rows + bad], "vec_id long, embedding array<double>, rank int, score double")
    return df, dict(rows) | {1100: [1.0, 2.0]}


def test_exact_search(odd_vectors):
    df, good = odd_vectors
    whole = {i: [int(np.floor(1024 * x)) for x in v] for i, v in good.items()}
    wanted = brute(whole, [i for i in good if i % 100 == 0], 10, lambda a, b: sum(x * y for x, y in zip(a, b)))
    found = defaultdict(list)
    for r in sorted(topk.search_every_hundredth(df).collect(), key=lambda r: r.rank):
        found[r.query_id].append((r.vec_id, r.score))
    assert found == {q: v for q, v in wanted.items() if v}
    assert topk.search_every_hundredth(df.limit(0)).count() == 0


def test_huge_components_stop_at_the_ends_of_the_range():
    big = np.array([[1 << 62, 1 << 62]])
    assert topk.products(big, big)[0, 0] == (1 << 63) - 1
    assert topk.products(np.array([[1 << 30]]), np.array([[1 << 30]]))[0, 0] == 1 << 60


def test_approximate_search(spark, odd_vectors):
    df, good = odd_vectors

    def cosine(a, b):
        a, b = np.array(a), np.array(b)
        return float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))

    zero = spark.createDataFrame([(1150, [0.0] * 4, 0, 0.0)], df.schema)
    wanted = brute(good, [i for i in good if i % 50 == 0], 5, lambda a, b: round(cosine(a, b), 12))
    found = defaultdict(list)
    for r in ann.search_every_fiftieth(df.unionAll(zero)).collect():
        assert r.score == pytest.approx(cosine(good[r.query_id], good[r.vec_id]), abs=1e-12)
        found[r.query_id].append(r.vec_id)
    hits = sum(len({i for i, _ in v} & set(found[q])) for q, v in wanted.items())
    assert hits >= 0.9 * sum(map(len, wanted.values()))
    assert set(found[400]) == {401, 402, 403, 404, 405}


def test_chi_square_and_recall_on_the_table(spark):
    assert ann.chi_square(15.507, 8) == pytest.approx(0.95, abs=1e-4)
    e = {r.vec_id: np.array(r.embedding, dtype=float) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()}
    ids = np.array(sorted(e))
    unit = np.array([e[i] / np.linalg.norm(e[i]) for i in ids])
    hits = total = 0
    found = defaultdict(set)
    for r in queries.op6_nearest_neighbours(spark, FOLDER).collect():
        found[r.query_id].add(r.vec_id)
    for q, got in found.items():
        near = unit @ e[q]
        near[ids == q] = -np.inf
        hits, total = hits + len(got & set(ids[np.argsort(-near)[:5]])), total + 5
    assert hits >= 0.9 * total


def components_by_force(texts):
    sets = {}
    for i, t in texts.items():
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()
    label = {i: i for i in texts}
    ids = [i for i in sorted(texts) if sets[i]]
    links = [(a, b) for n, a in enumerate(ids) for b in ids[:n] if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label, {i: len(s) for i, s in sets.items()}


def test_near_duplicates_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(dedup, "TILE_ROWS", 16)
    rng = random.Random(4)
    words = ["w%d" % i for i in range(400)]
    base = rng.choices(words, k=60)
    texts = {}
    for i in range(150):  # a family whose members are linked, nearly linked or far
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(60)] = rng.choice(words)
        texts[i] = " ".join(w)
    for i in range(150, 260):
        texts[i] = " ".join(rng.choices(words, k=rng.randint(1, 30)))
    texts |= {260: texts[3].upper(), 261: "", 262: None, 263: " \t\n", 264: "one two", 265: "ONE\ttwo", 266: "x y " * 3000, 267: "x y " * 2999}
    rows = [(i, t, None, None, None, 0, 0) for i, t in texts.items()] + [(None, texts[3], None, None, None, 0, 0), (7, texts[7], None, None, None, 0, 0)]
    docs = spark.createDataFrame(rows, DOCS)
    label, sizes = components_by_force(texts)
    found = dedup.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id, r.kept) == (sizes[r.doc_id], label[r.doc_id], label[r.doc_id] == r.doc_id)
    assert dedup.keep_first(docs).columns == docs.columns
    assert {r.doc_id for r in dedup.keep_first(docs).collect()} - {None} == {i for i, c in label.items() if i == c}
    assert dedup.near_duplicates(docs.limit(0)).count() == 0


def test_one_row_of_each_group_stays_whatever_its_id(spark):
    rng = random.Random(9)
    texts = [" ".join(rng.choices(["w%d" % i for i in range(400)], k=60)) for _ in range(5)]
    near = [t + " more" for t in texts]
    rows = [(1, texts[0]), (5, texts[1]), (5, near[0]), (None, texts[0]), (None, texts[2]), (None, texts[2]), (None, near[2])]
    rows += [(7, texts[3])] * 3 + [(None, texts[4]), (9, near[4]), (None, ""), (None, None)]
    docs = spark.createDataFrame([(i, t, *[None] * 5) for i, t in rows], DOCS)
    kept = [(r.doc_id, r.text) for r in dedup.keep_first(docs).collect()]
    pair = [x for x in kept if x in ((None, texts[2]), (None, near[2]))]
    wanted = Counter([(1, texts[0]), (5, texts[1]), (7, texts[3]), (9, near[4]), (None, ""), (None, None)])
    assert len(pair) == 1 and Counter(kept) == wanted + Counter(pair)


def test_components_of_a_chain(spark):
    chain = spark.range(1, 40).selectExpr("encode(lpad(id, 3, '0'), 'utf-8') AS a", "encode(lpad(id + 1, 3, '0'), 'utf-8') AS b")
    labels = dedup.components(chain, "chain")
    assert labels.count() == 40 and labels.select("component").distinct().count() == 1


def test_rules_and_false_positives(spark):
    rules = spark.createDataFrame([*queries.URL_RULES, ("b.net", "/x", "allow"), (None, "/", "block")], "host string, path string, verdict string")
    urls = ["http://A.Net/x", "https://net", "http://q.b.net/xyz?u", "//no", None, "", "http://example.net/en/1", "http://xnet/", "ftp://y.org/fr/?#", "http://net?a://b/", "http://b.net/" + "y" * 50_000]
    pages = spark.createDataFrame([(i % 9, u, "h", "r") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    found = sorted((r.page_id, r.host, r.path[:5], r.rule, r.verdict) for r in url_filter.judge_urls(pages, rules).collect())
    wanted = [
        (0, "a.net", "/x", "net/", "block"), (1, "net", "", None, "allow"), (2, "q.b.net", "/xyz", "b.net/x", "allow"), (3, "", "", None, "allow"),
        (4, "", "", None, "allow"), (5, "", "", None, "allow"), (6, "example.net", "/en/1", "example.net/en/", "allow"), (7, "xnet", "/", None, "allow"),
        (8, "y.org", "/fr/", "org/fr/", "allow"), (0, "net", "", None, "allow"), (1, "b.net", "/yyyy", "net/", "block"),
    ]
    assert Counter(found) == Counter(wanted)
    full = np.full((1, url_filter.BLOCK_WORDS), np.iinfo(np.uint64).max, dtype=np.uint64)
    assert url_filter.probe_filter(full, np.array([5, -7]), np.array([1, 2])).all()
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0 and url_filter.judge_urls(pages, rules.limit(0)).filter("verdict != 'allow'").isEmpty()


def test_listed_keys_always_pass_the_filter(spark):
    rules = spark.range(3000).selectExpr("concat('h', id, '.com') AS host", "'/' AS path", "'block' AS verdict")
    filled = url_filter.build_filter(rules)
    a, b = url_filter._hashes(F.col("host"), F.col("path"))
    own = rules.select(a.alias("a"), b.alias("b")).toPandas()
    assert url_filter.probe_filter(filled, own["a"].to_numpy(), own["b"].to_numpy()).all()
    other = spark.range(20_000).selectExpr("concat('z', id) AS host", "'/' AS path").select(a.alias("a"), b.alias("b")).toPandas()
    assert url_filter.probe_filter(filled, other["a"].to_numpy(), other["b"].to_numpy()).mean() < 0.05
