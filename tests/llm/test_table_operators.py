"""Operators over whole tables: against brute force on the small fixture and hand-written tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from demandcast.llm import ann, exactdup, mixing, neardup, quality, queries, sharding
from demandcast.llm.common import read_table, ship_package
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.conftest import ODD, documents


@pytest.fixture(scope="module")
def small(spark):
    ship_package(spark)
    return [(r.doc_id, r.text) for r in read_table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]


# --- 1 ----------------------------------------------------------------------------------------

def test_shards_are_near_equal_and_slots_gapless(spark):
    rows = queries.op1_kd_sharding(spark, SF_MID).collect()
    texts = {r.doc_id: r.text for r in read_table(spark, SF_MID, "documents").collect()}
    bytes_, slots = Counter(), defaultdict(list)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "bytes", None)
        bytes_[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert len(rows) == len(texts) and sorted(bytes_) == list(range(24))
    target = sum(bytes_.values()) / 24
    assert all(abs(b - target) < 0.01 * target + max(r.size for r in rows) / 2 for b in bytes_.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_with_one_source_and_many_copies(spark):
    rows = [(i, "copy of one text" if i % 3 else f"text {i} " * (i % 7), "hot" if i % 2 else None) for i in range(3000)]
    got = sharding.assign_shards(documents(spark, rows), 24).groupBy("shard").sum("size").collect()
    sizes = [r["sum(size)"] for r in got]
    assert len(sizes) == 24 and max(sizes) < 1.03 * min(sizes)


def test_shards_of_odd_rows(odd, none, tmp_path, spark):
    rows = sharding.assign_shards(odd, 24).collect()
    assert len(rows) == len(ODD) and len({(r.shard, r.slot) for r in rows}) == len(ODD)
    assert sharding.assign_shards(none, 24).count() == 0
    sharding.write_shards(odd, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(repr, [(r.document.doc_id, r.document.text) for r in back.collect()])) == \
        sorted(repr((i, t)) for i, t, _ in ODD)


# --- 2 ----------------------------------------------------------------------------------------

def test_quality_on_the_held_out_fold(spark):
    rows = {r.doc_id: r for r in queries.op2_pairwise_quality(spark, SF_MID).collect()}
    labels = read_table(spark, SF_MID, "labels").collect()
    for r in rows.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [x for x in labels if rows[x.doc_id].held_out]
    assert len(held) > 50
    assert np.mean([rows[x.doc_id].predicted == x.quality for x in held]) > 0.97


def test_quality_of_odd_rows_and_labels(spark, odd, none):
    labels = spark.createDataFrame([(1, 0, 0), (4, 1, 0), (4, 1, 1), (10, None, 0), (8, 1, None), (None, 1, 0)],
                                   "doc_id long, quality int, text int")
    rows = quality.score_documents(odd, labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert quality.score_documents(none, labels).count() == 0
    assert {r.predicted for r in quality.score_documents(odd, labels.limit(0)).collect()} == {1}
    kept = quality.accepted_documents(odd, labels)
    assert kept.columns == odd.columns


def test_pairwise_fit_ranks_and_cuts():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(400, len(quality.FEATURES)))
    y = (x[:, 0] - 2 * x[:, 3] > 0.8).astype(int)
    model = quality.fit(x, y)
    assert ((model.score(x) >= 0.5) == y).mean() > 0.98


# --- 3 ----------------------------------------------------------------------------------------

def shingles(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def brute_components(rows, words, percent=80):
    sets = [(i, shingles(t, words)) for i, t in rows]
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    where = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            where[x].append(k)
    for k, (_, s) in enumerate(sets):
        for j, n in Counter(j for x in s for j in where[x] if j > k).items():
            if 100 * n >= percent * (len(s) + len(sets[j][1]) - n):
                up[root(j)] = root(k)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[root(k)] = min(least.get(root(k), float("inf")), float("inf") if i is None else i)
    return sorted((i, len(s), least[root(k)]) for k, (i, s) in enumerate(sets))


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates_equal_brute_force(spark, words):
    docs = read_table(spark, SF_MID, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = neardup.near_duplicates(docs, words).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows, words)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_in_one_large_group(spark, monkeypatch):
    """Variants of one text that are linked only through some of the others, in buckets of many tiles."""
    monkeypatch.setattr(neardup, "TILE", 16)
    draw = np.random.default_rng(3)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(300):
        words = list(base)
        for k in draw.choice(60, size=draw.integers(0, 4), replace=False):
            words[k] = f"x{draw.integers(1000)}"
        rows.append((i, " ".join(words)))
    docs = documents(spark, [(i, t, "s") for i, t in rows])
    got = neardup.near_duplicates(docs, 2).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows, 2)


@pytest.mark.parametrize("first, second, shift", [(4, 5, 0), (5, 6, 0), (8, 10, 0), (9, 9, 1)])
def test_near_duplicates_of_short_documents(spark, first, second, shift):
    ship_package(spark)
    rows = []
    for p in range(2000):                                  # isolated pairs of so many two-word shingles, at 0.8 or above
        words = [f"p{p}w{k}" for k in range(second + shift + 1)]
        rows += [(2 * p, " ".join(words[:first + 1]), "a"), (2 * p + 1, " ".join(words[shift:]), "a")]
        a, b = shingles(rows[-2][1], 2), shingles(rows[-1][1], 2)
        assert (len(a), len(b)) == (first, second) and 100 * len(a & b) >= 80 * len(a | b)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, source string"), 2).collect()
    assert {r.doc_id for r in got if r.component_id != r.doc_id // 2 * 2} == set()


def test_near_duplicates_without_ids(spark):
    """Null and reused ids: texts are found by digest, so the rows read stay linear, and one of each group stays."""
    ship_package(spark)
    texts = [" ".join(f"g{p}w{k}" for k in range(30)) + f" end{v}" for p in range(400) for v in range(2)]
    rows = [(None if k < 600 else 7, t, "s") for k, t in enumerate(texts)] + [(None, texts[0], "s")] * 50
    docs = documents(spark, rows)
    sketches = neardup.sketch_documents(docs, 5).withColumn("row", F.monotonically_increasing_id())
    wanted = sketches.groupBy("digest").agg(F.min("row").alias("class"), F.min("doc_id").alias("doc_id"))
    assert neardup._class_texts(docs, wanted, 5).count() == len(texts)
    assert neardup.near_duplicates(docs).count() == len(rows)
    kept = neardup.keep_first(docs)
    groups = Counter(r.text.rsplit(" ", 1)[0] for r in kept.collect())
    assert kept.columns == docs.columns and len(groups) == 400 and set(groups.values()) == {1}


def test_keep_first_with_an_id_of_two_texts(spark):
    one, two = (" ".join(f"{c}{k}" for k in range(40)) for c in "ab")
    rows = [(1, one, "s"), (5, one + " more", "s"), (5, two, "s"), (5, two, "s"), (None, two + " more", "s"),
            (None, "", "s"), (None, "", "s"), (None, None, "s")]
    kept = neardup.keep_first(documents(spark, rows)).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter([(1, one), (5, two), (None, ""), (None, None)])


def test_near_duplicates_of_odd_rows(odd, none):
    got = {(r.doc_id, r.n_shingles): r for r in neardup.near_duplicates(odd, 2).collect()}
    assert got[1, 0].component_id == 1 and got[2, 0].component_id == 2 and got[3, 0].kept
    assert got[5, 1].component_id == got[6, 1].component_id == got[7, 1].component_id == 5
    assert got[9, got[4, max(n for i, n in got if i == 4)].n_shingles].component_id == 4
    assert got[11, 6].component_id == 10 and not got[11, 6].kept
    assert neardup.near_duplicates(none, 2).count() == 0
    kept = neardup.keep_first(odd, 2)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 2, 3, 4, 5, 8, 10]
    assert {r["__size"] for r in kept.collect()} == {-7}


def test_registers_estimate_jaccard():
    draw = np.random.default_rng(2)
    for share in (0.5, 0.8, 0.95):
        pool = np.unique(draw.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2))
        n = int(len(pool) * (1 - share) / 2)
        a, b = pool[n:], pool[:len(pool) - n]
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        got = neardup.estimate(neardup.registers(a), neardup.registers(b)[None])[0]
        assert abs(got - true) < 5 * np.sqrt(true * (1 - true) / neardup.REGISTERS) + 0.01


# --- 7 ----------------------------------------------------------------------------------------

def brute_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, i))
    return sorted(((i, (keep := min(groups[n := re.sub(r"[\x20\x09-\x0D]", "", t or "")])[3]), len(groups[n]), i == keep,
                    hashlib.sha256(n.encode()).hexdigest()) for i, t in rows), key=repr)


def test_exact_duplicates_equal_brute_force(spark, odd, none):
    rows = [(i, t) for i, t, _ in ODD]
    columns = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    for history, batch in (exactdup.split_by_age(odd), (none, odd), (odd, none)):
        got = exactdup.deduplicate(history, batch).select(*columns).collect()
        assert sorted(map(tuple, got), key=repr) == brute_exact(rows)
    assert exactdup.deduplicate(none, none).count() == 0
    kept = exactdup.keep_winners(odd, exactdup.deduplicate(*exactdup.split_by_age(odd)))
    assert kept.columns == odd.columns and {r["__size"] for r in kept.collect()} == {-7}
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [11, 3, 4, 5, 7, 8, None]


def test_perfect_hash_is_minimal_and_perfect():
    draw = np.random.default_rng(4)
    for n in (1, 2, 5, 4096):
        cells = max(1, n // exactdup.KEYS_PER_CELL)
        h1, h2 = draw.integers(0, exactdup.PRIME, n), draw.integers(1, exactdup.PRIME, n)
        cell = draw.integers(0, cells, n)
        pilots, slots = exactdup.find_pilots(h1, h2, cell, cells)
        assert sorted(slots) == list(range(n))
        assert (exactdup.slot_of(h1, h2, pilots[cell], n) == slots).all()


def test_perfect_hash_of_keys_that_step_evenly(spark):
    """Hashes whose pilots once met a part of the slots only: small and even, and two of 700 buckets drawn at random."""
    cases = [(np.array([1, 3]), np.array([2, 2]), np.zeros(2, np.int64)),
             (np.arange(0, 128, 2), np.full(64, 64), np.arange(64))]
    for seed in (147, 382):
        draw = np.random.default_rng(seed)
        n = int(draw.poisson(exactdup.KEYS_PER_BUCKET))
        h1, h2 = draw.integers(0, exactdup.PRIME, n), draw.integers(1, exactdup.PRIME, n)
        cases.append((h1, h2, draw.integers(0, 1 << 48, n) % (n // exactdup.KEYS_PER_CELL)))
    for h1, h2, cell in cases:
        n = len(h1)
        pilots, slots = exactdup.find_pilots(h1, h2, cell, int(cell.max()) + 1)
        assert sorted(slots) == list(range(n))
        assert (exactdup.slot_of(h1, h2, pilots[cell], n) == slots).all()
        assert pilots.max() < 100_000
        rows = [tuple(map(int, r)) for r in zip(h1, h2, pilots[cell], slots)]
        got = spark.createDataFrame(rows, "h1 long, h2 long, pilot long, slot long").select(
            "slot", exactdup.slot_of(F.col("h1"), F.col("h2"), F.col("pilot"), F.lit(n)).alias("found"))
        assert got.where("slot <> found").count() == 0


def test_exact_stage_with_hashes_that_step_evenly(spark, monkeypatch):
    """The pipeline's second stage on hashes whose steps share factors with the number of digests."""
    hashes = exactdup.with_hashes
    monkeypatch.setattr(exactdup, "with_hashes",
                        lambda df, buckets: hashes(df, buckets).withColumn("h2", F.lit(840).cast("long")))
    texts = [f"text {k}" for k in range(120)]
    rows = [(k, t, "s") for k, t in enumerate(texts)] + [(1000 + k, t + " ", "s") for k, t in enumerate(texts[:30])]
    docs = documents(spark, rows).withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text"))
    kept = corpus_pipeline.exact_stage(spark, docs, "").collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([(i, t) for i, t, _ in rows if i >= 30])


def test_slots_at_the_ends_of_the_hashes(spark):
    """The largest hashes and pilots stay below 2^63 in numpy and in Spark; Python's integers are the measure."""
    ends = [0, 1, 2, exactdup.PRIME // 2, exactdup.PRIME - 2, exactdup.PRIME - 1]
    rows = [(a, b, p) for a in ends for b in ends[1:] for p in ends]
    right = [pow(a + p * b, 5, exactdup.PRIME) % 4099 for a, b, p in rows]
    h1, h2, pilot = (np.array(c, np.int64) for c in zip(*rows))
    assert exactdup.slot_of(h1, h2, pilot, 4099).tolist() == right
    df = spark.createDataFrame(rows, "h1 long, h2 long, pilot long")
    found = df.select("h1", "h2", "pilot", exactdup.slot_of(F.col("h1"), F.col("h2"), F.col("pilot"), F.lit(4099)))
    assert {tuple(r)[:3]: r[3] for r in found.collect()} == dict(zip(rows, right))


# --- 8 ----------------------------------------------------------------------------------------

def test_mix_meets_targets(spark):
    sizes = {f"s{k:02}": 40 * (k + 1) if k else 3 for k in range(9)}      # the first one is capped
    rows = [(i * 100 + k, "w " * (1 + (i * 7 + k) % 30), s) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    got = mixing.mix(documents(spark, rows)).collect()
    source = {i: s for i, _, s in rows}
    taken, target, size, whole = Counter(), {}, {}, 0
    for r in got:
        s = source[r.doc_id]
        taken[s] += r.taken
        target[s], size[s] = r.target, r.source_size
        whole += r.size
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
    assert abs(sum(target.values()) - whole) < 1e-6 * whole
    assert all(target[s] <= 3 * size[s] + 1e-6 for s in target)
    free = {s for s in target if target[s] < 3 * size[s] - 1e-6}
    levels = {round(target[s] / (1 + k % 3), 6) for k, s in enumerate(sorted(sizes)) if s in free}
    assert len(levels) == 1 and target["s00"] == 3 * size["s00"]
    assert all(abs(taken[s] - target[s]) <= 15.5 for s in target)


def test_mix_prefers_quality_and_reruns_agree(spark):
    rows = [(i, ("good words here " * 3 if i % 2 else "### $$$ %%% &&& *** ||| ### $$$ %%%"), "a") for i in range(2000)]
    rows += [(10_000 + i, "one two three", "b") for i in range(100)]
    docs = documents(spark, rows)
    one = sorted(tuple(r) for r in mixing.mix(docs).collect())
    two = sorted(tuple(r) for r in mixing.mix(docs.repartition(7)).collect())
    assert one == two
    share = [np.mean([r[4] > 0 for r in one if r[0] < 2000 and r[0] % 2 == k]) for k in (0, 1)]
    assert share[1] > share[0]


def test_mix_of_odd_rows(odd, none):
    rows = mixing.mix(odd).collect()
    assert len(rows) == len(ODD) and all(r.taken <= 3 * r.size for r in rows)
    assert mixing.mix(none).count() == 0
    out = mixing.mixed_documents(odd)
    assert out.columns == odd.columns and {r["__size"] for r in out.collect()} == {-7}
    assert mixing.mixed_documents(none).count() == 0


# --- 9 ----------------------------------------------------------------------------------------

def test_search_recall_and_order(spark):
    got = queries.op9_one_bit_search(spark, SF_MID).collect()
    table = read_table(spark, SF_MID, "embeddings").collect()
    ids = np.array([r.vec_id for r in table])
    v = np.array([r.embedding for r in table], dtype=float)
    found = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((v - v[ids == q][0]) ** 2).sum(axis=1))
        order = [k for k in np.lexsort((ids, d)) if ids[k] != q][:10]
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 11))
        assert [r.score for r in mine] == sorted(r.score for r in mine)
        assert np.allclose([r.score for r in mine], [d[ids == r.vec_id][0] for r in mine], rtol=1e-12)
        found += len({r.vec_id for r in mine} & set(ids[order]))
    assert found >= 0.9 * 10 * (ids % 100 == 0).sum()


def test_search_over_odd_vectors(spark, monkeypatch):
    ship_package(spark)
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 2.0, 3.0]), (100, [1.0, 0.0]), (None, [1.0, 1.0]),
            (2, [0.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r.rank, r.vec_id) for r in ann.search(table).collect())
    assert got == [(0, 1, 1), (0, 2, 100), (0, 3, 2), (0, 4, 2), (100, 1, 0), (100, 2, 1), (100, 3, 2), (100, 4, 2)]
    assert ann.search(table.limit(0)).count() == 0
