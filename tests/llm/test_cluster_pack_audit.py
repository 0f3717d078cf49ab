"""Centroid clustering, packing and source divergence against brute force and on odd tables."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

from demandcast.llm import centroids, divergence, packing, queries
from demandcast.llm.common import read_table, ship_package
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.conftest import LONG, ODD, rows_of

VECTORS = "vec_id long, embedding array<float>, cluster int, ints string, apex string"


def vectors(spark, rows):
    ship_package(spark)
    return spark.createDataFrame([(i, v, -1, "x", "y") for i, v in rows], VECTORS)


# --- 11 ---------------------------------------------------------------------------------------

@pytest.mark.parametrize("spread", [1.0, 0.01])
def test_apex_bounds_hold_and_filter(spread):
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(8, 64)) * 1000
    v = np.floor(middles[rng.integers(0, 8, 2000)] + rng.normal(size=(2000, 64)) * 1000 * spread).astype(np.int64)
    simplex = centroids.Simplex.over(v[:64].tolist(), 16)
    apex, centres = simplex.apexes(v.astype(float)), simplex.apexes(middles)
    exact = ((v[:, None, :] - middles[None]) ** 2).sum(2)
    flat = ((apex[:, None, :-1] - centres[None, :, :-1]) ** 2).sum(2)
    low = flat + (apex[:, None, -1] - centres[None, :, -1]) ** 2
    high = flat + (apex[:, None, -1] + centres[None, :, -1]) ** 2
    slack = centroids.SLACK * exact.max()
    assert (low <= exact + slack).all() and (exact <= high + slack).all()
    kept = centroids.candidates(apex, centres)
    assert kept[np.arange(len(v)), exact.argmin(1)].all()
    if spread < 0.1:
        assert kept.sum() == len(v)                          # clear clusters: one exact comparison a vector


def test_filter_leaves_out_comparisons_on_the_table(spark):
    ship_package(spark)
    kept = centroids.kept_vectors(read_table(spark, SF_MID, "embeddings"), 64, 1024)
    start = np.array(centroids.first_by_hash(kept, "3", 8), dtype=np.int64)
    simplex = centroids.Simplex.over(centroids.first_by_hash(kept, "3:pivot", 64), 16)
    rows = centroids.assignments(centroids.with_apexes(kept, simplex), simplex, start)
    compared, n = rows.selectExpr("sum(compared)", "count(*)").first()
    assert n <= compared < 8 * n


def test_clusters_of_odd_vectors(spark):
    good = [(i, [float((i * 7 + d) % 5) - 2.5 for d in range(64)]) for i in range(20)]
    bad = [(100, None), (101, [1.0] * 63), (102, [float("nan")] * 64), (103, [float("inf")] * 64), (104, []),
           (105, [None] + [1.0] * 63)]
    same = [(200, [0.0] * 64), (200, [0.0] * 64), (None, [1.0] * 64)]
    rows = centroids.cluster(vectors(spark, good + bad + same)).collect()
    assert sorted(repr(r.vec_id) for r in rows) == sorted(repr(i) for i, _ in good + same)
    assert {r.inertia for r in rows} == {sum(r.distance for r in rows)}
    for c in {r.cluster for r in rows}:
        mine = [r for r in rows if r.cluster == c]
        assert {r.cluster_inertia for r in mine} == {sum(r.distance for r in mine)}
    assert centroids.cluster(vectors(spark, [])).count() == 0
    assert centroids.cluster(vectors(spark, bad)).count() == 0
    few = centroids.cluster(vectors(spark, good[:3])).collect()
    assert len(few) == 3 and {r.distance for r in few} == {0}
    huge = centroids.cluster(vectors(spark, [(1, [3e38] * 64), (2, [-3e38] * 64), (3, [0.0] * 64)]), k=2).collect()
    assert len(huge) == 3


# --- 12 ---------------------------------------------------------------------------------------

def check_packing(docs, rows, capacity=1024):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    want = Counter()
    for doc_id, text in docs:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        first = len(ids) if len(ids) <= capacity else len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids), capacity), len(ids)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[doc_id, n, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), -(-sum(r.length for r in rows) // capacity)


@pytest.mark.parametrize("group", [packing.GROUP, 150])
def test_packing_of_the_table(spark, group):
    ship_package(spark)
    docs = read_table(spark, SF_MID, "documents")
    rows = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), group=group).collect()
    bins, least = check_packing([(r.doc_id, r.text) for r in docs.collect()], rows)
    assert bins <= 1.01 * least + 1


def test_packing_of_odd_rows(odd, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    check_packing([(i, t) for i, t, _ in ODD], packing.pack_documents(odd, path).collect())
    assert packing.pack_documents(none, path).count() == 0


def test_encoder_equals_the_library(monkeypatch):
    monkeypatch.setattr(packing, "CACHED", 50)
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), packing.Encoder(path)
    rng = random.Random(9)
    settled = [c for c in map(chr, range(0xD7A4)) if re.match(f"[{packing.SETTLED}]", c)]
    texts = ["", " ", "it's  a\n\n\ttest ", "<|endoftext|> x", "a\x1cb\x85c \u00a0d", "e\u0301 \U0001F600", "don't'S 12\u00b2"]
    texts += ["".join(rng.choices(settled if rng.random() < 0.7 else settled[:100], k=rng.randint(1, 30)))
              for _ in range(6000)]
    texts += ["".join(rng.choices(" \n\tab'st1.", k=rng.randint(1, 30))) for _ in range(3000)]
    texts += ["".join(chr(rng.choice([rng.randint(0, 0xD7FF), rng.randint(0xE000, 0x1FFFF)])) for _ in range(12))
              for _ in range(3000)]
    got = [ids for at in range(0, len(texts), 100) for ids in own.encode(texts[at:at + 100])]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_pretokens_go_through_the_library_many_at_a_time(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), packing.Encoder(path)
    texts = [" ".join(f"word{i}x" for i in range(at, at + 100)) + " \n\n  it's 'x' \t\v!?" for at in range(0, 2000, 100)]
    calls, real = [], own._library
    monkeypatch.setattr(own, "_library", lambda given: (calls.append(len(given)), real(given))[1])
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert own.encode(texts) == want and len(own.known) > 2000
    assert sum(calls) < 50
    assert packing.kept_encoder(path) is packing.kept_encoder(path)
    own.newline, own.known = b"".join(real(["ab"])), {}          # newlines that do not come back: singly
    assert own.encode(texts) == want


def test_settled_characters_split_as_the_pattern_does():
    kinds = {kind: re.compile(f"[{chars}]") for kind, chars in
             ((r"\p{L}", packing.LETTERS), (r"\p{N}", packing.NUMBERS), (r"\s", packing.SPACE))}
    for c in filter(re.compile(f"[{packing.SETTLED}]").match, map(chr, range(0xD7A4))):
        assert all(bool(regex.match(kind, c)) == bool(own.match(c)) for kind, own in kinds.items()), hex(ord(c))


def test_trades_raise_the_squared_fill_and_empty_bins():
    rng = random.Random(3)
    fewer = 0
    for n in (3, 6, 120, 900):                                # whole sequences cut in three
        halves = [(rng.randint(200, 420), rng.randint(200, 420)) for _ in range(n // 3)]
        lengths = [x for a, b in halves for x in (a, b, 1024 - a - b)]
        start = packing.best_fit(lengths, 1024)
        search = packing.Search(start, lengths, 1024)
        while True:
            before, made = (search.fill ** 2).sum(), False
            for giver in np.argsort(search.fill).tolist():
                if search.fill[giver] and (found := search.trade(giver)):
                    search.apply(giver, *found)
                    assert (search.fill ** 2).sum() > before and search.fill.max() <= 1024
                    before, made = (search.fill ** 2).sum(), True
            if not made:
                break
        bins = packing.pack(lengths, 1024)
        assert sorted(i for b in bins for i in b) == list(range(n))
        assert all(sum(lengths[i] for i in b) <= 1024 for b in bins)
        assert packing.least_bins(np.array(lengths), 1024) <= len(bins) <= len(start)
        fewer += len(start) - len(bins)
    assert fewer > 0


def test_each_kind_of_trade():
    def result(bins, lengths):
        search = packing.Search(bins, lengths, 10)
        return search.trade(0)
    assert result([[0], [1]], [3, 7]) == ([0], None, 1)                  # a move
    assert result([[0], [1, 2]], [6, 5, 4]) == ([0], 1, 1)               # one for one: 9 becomes 10
    assert result([[0, 1], [2, 3]], [3, 3, 5, 4]) == ([0, 1], 2, 1)      # two for one: 9 becomes 10
    assert result([[0], [1]], [9, 9]) is None


def test_lower_bound():
    assert packing.least_bins(np.array([513] * 7), 1024) == 7
    assert packing.least_bins(np.array([400] * 7), 1024) == 4
    assert packing.least_bins(np.array([512] * 7), 1024) == 4
    for seed in range(20):
        rng = random.Random(seed)
        lengths = [rng.randint(1, 10) for _ in range(7)]

        def fits(rest, rooms):
            if not rest:
                return True
            return any(fits(rest[1:], rooms[:i] + [r - rest[0]] + rooms[i + 1:]) for i, r in enumerate(rooms) if r >= rest[0])
        best = next(k for k in range(1, 8) if fits(sorted(lengths, reverse=True), [10] * k))
        assert packing.least_bins(np.array(lengths), 10) <= best <= len(packing.pack(lengths, 10))


# --- 13 ---------------------------------------------------------------------------------------

def brute_audit(rows, least=3, top=200):
    """(text, lang, source) rows to the result rows, term by term in Python integers."""
    docs = [[x or "" for x in r] for r in rows]
    lower = {c: c + 32 for c in range(65, 91)}
    found = [(lang, source, re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(lower))) for text, lang, source in docs]
    out = []
    for lang in {d[0] for d in found}:
        mine = [d for d in found if d[0] == lang]
        df, everywhere, count = Counter(), Counter(), defaultdict(Counter)
        for _, source, terms in mine:
            df.update(set(terms))
            everywhere.update(terms)
            count[source].update(terms)
        kept = [t for t in df if df[t] >= least]

        def prices(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 1) // (n + len(kept)) for t in kept}
        whole, own = prices(everywhere), {s: prices(c) for s, c in count.items()}
        for source, p in own.items():
            pairs = [(sum((p[t] - q[t]) ** 2 // q[t] for t in kept), o) for o, q in own.items() if o != source]
            terms = [((p[t] - whole[t]) ** 2 // whole[t], t) for t in kept if count[source][t] and p[t] > whole[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                order = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, source, part, item, v, n) for n, (v, item) in enumerate(order, 1) if part == "pair" or n <= top]
    return sorted(out)


NAMES = ("lang", "source", "part", "item", "value", "rank")


@pytest.mark.parametrize("bucket, tile", [(divergence.BUCKET, divergence.TILE), (50, 2)])
def test_audit_equals_brute_force(spark, bucket, tile):
    ship_package(spark)
    docs = read_table(spark, SF_SMALL, "documents")
    rows = [tuple(r) for r in docs.select("text", "lang", "source").collect()]
    got = divergence.audit(docs, bucket=bucket, tile=tile)
    assert sorted(tuple(r) for r in got.select(*NAMES).collect()) == brute_audit(rows)


def test_audit_of_odd_rows(spark, odd, none, monkeypatch):
    monkeypatch.setattr(divergence, "ENTRIES", 5)
    rows = [(t, None if s is None else "en", s) for _, t, s in ODD]
    assert sorted(tuple(r) for r in divergence.audit(odd, least=2).select(*NAMES).collect()) == brute_audit(rows, 2)
    assert divergence.audit(none).count() == 0
    assert "word1" in LONG
    wordless = [("", "xx", "a"), (None, "xx", "b"), ("1 2 3", "xx", None)]
    df = spark.createDataFrame(wordless, "text string, lang string, source string")
    assert rows_of(divergence.audit(df), *NAMES) == sorted(brute_audit(wordless), key=repr)


def test_terms_are_counted_on_bytes(spark):
    ship_package(spark)
    texts = ["".join(map(chr, range(0x250))) + " \u0130\u1E9E\uFF21\U00010400Z", "A a\x00b[c`d{e\x7ff", "\u00c9t\u00c9 \u2028x\xa0y\x85Z"]
    letters = "".join(map(chr, range(0x61, 0x69)))
    texts.append(" ".join("".join(letters[i >> k & 7] for k in range(0, 18, 3)) for i in range(120_000)))
    df = spark.createDataFrame([(t, "en", "s") for t in texts * 2], "text string, lang string, source string").coalesce(1)
    want = Counter()
    for t in texts:
        want.update(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate({c: c + 32 for c in range(65, 91)})))
    got = [r for r in divergence.term_counts(df).collect() if r.term is not None]
    assert {r.term: r.n for r in got} == {t: 2 * n for t, n in want.items()}
    assert len(got) == len(want)                                # a frequent term is one row of the task


def test_galloping_equals_sets():
    rng = np.random.default_rng(1)
    for n, m in ((0, 5), (1, 1), (7, 300), (200, 200)):
        a, b = (np.sort(rng.choice(400, k, replace=False)) for k in (n, m))
        left, right = divergence.gallop(a, b)
        assert (a[left] == b[right]).all() and set(a[left]) == set(a) & set(b)


def test_every_result_has_the_contract_columns(spark):
    got = queries.op12_swap_packing(spark, SF_SMALL)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
