"""Operators that map one row to one row: against the libraries, regular expressions and hand-written pages."""

import base64
import hashlib
import random
import re
import time
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from demandcast.llm import bpe, htmlmain, pii, tokencount
from demandcast.llm.common import ship_package
from tests.llm.conftest import ODD

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
PARTS = st.sampled_from(["the", "ing", " ", "  ", "\n", "\t", "\x1c", "\x85", "1", "½", "é", "日本", "😀", "'s", "'LL", "!!",
                         "a" * 40, "<|endoftext|>", "<|endof", "\x00", "\r\n", "क्", "zqxj", "THE", "ß"])
TEXTS = st.lists(PARTS, max_size=12).map("".join)


@pytest.fixture(scope="module")
def counter():
    return tokencount.TokenCounter(tokencount.MergeTable.load(JSON)), Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def codec():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return bpe.Codec(bpe.Vocabulary.load(RANKS), public_tokenizers.PATTERN), library


@settings(deadline=None, max_examples=300)
@given(text=TEXTS)
def test_counts_and_ids_equal_the_libraries(counter, codec, text):
    own, library = counter
    assert own.count(text) == len(library.encode(text, add_special_tokens=False).ids)
    own, library = codec
    ids = own.encode(text)
    assert ids == library.encode_ordinary(text)
    assert own.decode(ids) == text.encode()


@settings(deadline=None, max_examples=200)
@given(data=st.binary(max_size=60), new=st.binary(max_size=8), cut=st.tuples(st.integers(0, 60), st.integers(0, 60)))
def test_prefix_encoding_appends_and_edits(codec, data, new, cut):
    v = codec[0].v
    whole = bpe.PrefixEncoding(v, data)
    grown = bpe.PrefixEncoding(v)
    for b in data:
        grown.append(bytes([b]))
    assert grown.last == whole.last
    begin, end = sorted(min(c, len(data)) for c in cut)
    whole.replace(begin, end, new)
    edited = data[:begin] + new + data[end:]
    assert bytes(whole.data) == edited
    assert whole.ids() == bpe.PrefixEncoding(v, edited).ids()
    assert b"".join(v.bytes[i] for i in whole.ids()) == edited


def test_encoder_and_counter_over_tables(spark, odd, none, counter, codec):
    got = {(r.doc_id, r.n_bytes): r for r in tokencount.count_tokens(odd, JSON).collect()}
    for i, t, _ in ODD:
        r = got[i, len((t or "").encode())]
        assert r.n_tokens == len(counter[1].encode(t or "", add_special_tokens=False).ids)
        assert r.over_limit == (r.n_tokens > 1024)
    rows = bpe.round_trip_digests(odd, RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(ODD)
    want = sorted((repr(i), len(ids := codec[1].encode_ordinary(t or "")),
                   hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                   hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _ in ODD)
    assert sorted((repr(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == want
    encoded = bpe.encode(odd, RANKS, public_tokenizers.PATTERN)
    back = bpe.decode(encoded, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(bytes(r.data) for r in back) == sorted((t or "").encode() for _, t, _ in ODD)
    assert tokencount.count_tokens(none, JSON).count() == 0
    assert bpe.round_trip_digests(none, RANKS, public_tokenizers.PATTERN).count() == 0


# --- personal data --------------------------------------------------------------------------

REGEX = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def by_regex(text):
    def digits(s):
        return re.sub("[^0-9]", "", s)
    fine = {"email": lambda s: True, "ip": lambda s: all(int(x) <= 255 for x in s.split(".")),
            "card": lambda s: 16 <= len(digits(s)) <= 19 and pii.luhn(digits(s)),
            "phone": lambda s: 8 <= len(digits(s)) <= 15}
    return {k: [m.span() for m in re.finditer(p, text) if fine[k](m[0])] for k, p in REGEX.items()}


def test_spans_equal_the_regular_expressions():
    anchors, draw = pii._anchors(), random.Random(5)
    letters = "0123456789" * 2 + "..--  ++()@@aZé%_4111111111111111"
    for _ in range(20_000):
        text = "".join(draw.choice(letters) for _ in range(draw.randrange(50)))
        found = pii.find_spans(text, anchors)
        assert {k: found[k] for k in pii.BASE_KINDS} == by_regex(text), text


def test_added_spans_and_masking(spark):
    anchors = pii._anchors()
    text = 'See https://a.example/x?y=1. token = "9abc12ff0ca8", account: none, Account #12345678 mytoken=12345678'
    found = pii.find_spans(text, anchors)
    assert [text[a:b] for a, b in found["url"]] == ["https://a.example/x?y=1"]
    assert [text[a:b] for a, b in found["account"]] == ["9abc12ff0ca8", "12345678"]
    docs = spark.createDataFrame([(1, "mail a@b.cd now"), (2, None)], "doc_id long, text string")
    assert [r.text for r in pii.mask_personal_data(docs).orderBy("doc_id").collect()] == ["mail [email] now", None]


@pytest.mark.parametrize("text, value", [
    ("account number: 12345678", "12345678"), ("Account no. 12345678", None), ("account no.: 12345678", "12345678"),
    ("IBAN DE89 3704 0044 0532 0130 00 is mine", "DE89 3704 0044 0532 0130 00"),
    ("IBAN: DE89 3704 0044 0532 0130 00", "DE89 3704 0044 0532 0130 00"), ("IBAN DE88 3704 0044 0532 0130 00", None),
    ("iban=DE88370400440532013000", "DE88370400440532013000"), ("password: hunter2", "hunter2"),
    ("my password is hunter2", "hunter2"), ("access_token=9abc12ff", "9abc12ff"), ("client_secret=9abc12ff", "9abc12ff"),
    ("auth-token: 9abc12ff", "9abc12ff"), ("mytoken=9abc12ff", None), ("account 12345678", None), ("token is", None),
    ("accountno: 12345678", None)])
def test_written_forms_of_accounts(text, value):
    found = pii.find_spans(text, pii._anchors())["account"]
    assert [text[a:b] for a, b in found] == ([] if value is None else [value])


def test_personal_data_of_odd_rows(odd, none):
    rows = pii.find_personal_data(odd).collect()
    assert len(rows) == len(ODD) and {r.spans for r in rows} == {""}
    assert {r.base_sha256 for r in rows} == {hashlib.sha256(b"").hexdigest()}
    assert pii.find_personal_data(none).count() == 0


# --- pages ----------------------------------------------------------------------------------

PAGE = """<html><head><title>t</title><style>p{}</style></head><body class="has-sidebar"><header>Site</header><nav><ul><li>a
<li>b</ul></nav><div class="cookie-notice">We use</div>%s<section id="comments"><p>first!</p></section><footer>f</footer>
<script>if (a<b) x("</p>")</script></body>"""


def kinds(page):
    return [t for k, t in htmlmain.page_blocks(page) if k == htmlmain.ARTICLE]


def test_article_markup():
    page = PAGE % ("<article><header><h1>Head &amp; more</h1><span>by me</span></header><p>One <b>bold<br>line&nbsp;two"
                   "<p>Three 1 &lt; 2<aside>no</aside><form>no<input></form><h2>Sub</h2>tail<!-- no <p> --><table><tr>"
                   "<td>1<td>2</table><div class='share'>no</div><ul><li>x<li>y</ul></article>")
    assert kinds(page) == ["Head & more", "One bold line two", "Three 1 < 2", "Sub", "tail", "1", "2", "x", "y"]
    assert kinds('<div class="site-header">no</div><main><div id="crumbs">x</div><div class="post article-body"><div '
                 'class="entry-header"><h1>T</h1>by</div><p>Body</div></main><div class="sidebar">no</div><ol class="commentlist"><li>no</ol>') == ["T", "Body"]
    assert htmlmain.page_blocks("<main><p>a</p></main><p data-class='menu'>b") == [(htmlmain.MAIN, "a"), (htmlmain.OPEN, "b")]
    assert kinds("") == [] and kinds("a < b") == [] and kinds("<article>a < b <i") == ["a < b <i"]


@pytest.mark.parametrize("before", [
    "<div class='content has-sidebar'>", "<div id='page' class='with-comments'>", "<section class='widget'>",
    "<div class='page-header-fixed header'>", "<div title='the hidden life'>", "<div data-css='display: none'>"])
def test_names_around_an_article_do_not_lose_it(before):
    story = "<article><h2 id='related-work'>Related work</h2><p>one two three<p class='notice'>Note this</article>"
    assert kinds(f"<body>{before}{story}") == ["Related work", "one two three", "Note this"]
    assert [t for k, t in htmlmain.page_blocks(f"{before}<main><p>a b</main>") if k == htmlmain.MAIN] == ["a b"]


def test_names_inside_an_article():
    page = ("<article><h2 id='social-impact'>Impact</h2><section id='search-methods'><p>how</p></section>"
            "<h3 class='has-menu'>Menu</h3><p>tail<p class='share'>no<div class='related-posts'>no</div>"
            "<div id='comments'>no</div><p hidden>no</p><p style='color:red; display: none'>no</p>"
            "<p aria-hidden='true'>no</p><p class='x hidden'>seen</article>")
    assert kinds(page) == ["Impact", "how", "Menu", "tail", "seen"]
    # an article in furniture stays there beside a larger one, a card is no article, a menu is not main
    assert kinds("<div class='related'><article>a b</article></div><article>a b c</article>") == ["a b c"]
    assert htmlmain.page_blocks("<div class='article-card'>x</div><nav>a</nav><div id='main-column'>b") == [
        (htmlmain.OPEN, "x"), (htmlmain.FURNITURE, "a"), (htmlmain.OPEN, "b")]


def test_repeated_text_decides_where_markup_is_silent(spark):
    from demandcast.llm.common import ship_package
    ship_package(spark)
    line = "this same long line stands on every page of the host without any markup"
    rows = [(i, "http://h.example/" + str(i), f"<body><div><p>{line}</p><p>own words of page {i} follow here and "
             f"there {i}</p></div></body>") for i in range(6)]
    rows += [(10, "http://other.example/", f"<body><p>{line}</p></body>"), (11, None, None), (12, "x", ""),
             (13, "http://h.example/a", "<body><article><p>" + line + "</p></article></body>"),
             (0, "http://h.example/0", rows[0][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.page_id, r.text, r.n_chars) for r in htmlmain.extract_main_text(pages).collect())
    own = [(i, t := f"own words of page {i} follow here and there {i}", len(t)) for i in (0, 0, 1, 2, 3, 4, 5)]
    assert got == sorted(own + [(10, line, len(line)), (11, "", 0), (12, "", 0), (13, line, len(line))])
    assert htmlmain.extract_main_text(pages.limit(0)).count() == 0


def test_repeated_text_inside_articles_and_main(spark):
    from demandcast.llm.common import ship_package
    ship_package(spark)
    share = "share this story with all of your friends on every network today"
    shared = "a passage that the first two articles of this host both have in full"
    rows = [(i, f"http://h.example/{i}", f"<article><p>own story {i} goes on with words of {i} alone</p><p>{share}</p>"
             f"<p>Tell us more</p>{f'<p>{shared}</p>' if i < 2 else ''}</article>") for i in range(6)]
    rows += [(6 + i, f"http://h.example/m{i}", f"<main><p>the whole report of day {i} stands here in main {i}</p>"
              f"<article>teaser</article></main>") for i in range(2)]
    rows += [(8, "http://one.example/", f"<article><p>{share}</p></article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in htmlmain.extract_main_text(pages).collect()}
    own = [f"own story {i} goes on with words of {i} alone" + (f"\n{shared}" if i < 2 else "") for i in range(6)]
    assert [got[i] for i in range(6)] == own
    assert [got[6 + i] for i in range(2)] == [f"the whole report of day {i} stands here in main {i}" for i in range(2)]
    assert got[8] == share


def test_short_repeated_blocks_without_markup(spark):
    from demandcast.llm.common import ship_package
    ship_package(spark)
    rows = [(i, "http://h.example/", f"<p>Home and news</p><p>w{i} x{i} y{i}</p><p>All rights</p>") for i in range(3)]
    rows += [(3, "http://o.example/", "<p>Home and news</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in htmlmain.extract_main_text(pages).collect()}
    assert got == {0: "w0 x0 y0", 1: "w1 x1 y1", 2: "w2 x2 y2", 3: "Home and news"}


@pytest.mark.parametrize("page", [
    lambda n: "<article>" + "<a" * n, lambda n: "<i>" * n + "</b>" * n, lambda n: "<a \"> \"" * n,
    lambda n: "<li><div>" + "<i>" * n + "<li>x" * n, lambda n: "<button>a" * n, lambda n: "<a '" * n + ">",
    lambda n: "<p>" + "<i>" * n + "<p>x" * n])
def test_malformed_pages_take_linear_time(page):
    seconds = []
    for n in (4000, 32000):
        began = time.process_time()
        htmlmain.page_blocks(page(n))
        seconds.append(time.process_time() - began)
    assert seconds[1] < 0.2 + 24 * seconds[0]              # eight times the page; quadratic would be 64


def test_forms_and_buttons():
    assert htmlmain.page_blocks("<form><article><p>a b</p></article></form>") == [(htmlmain.ARTICLE, "a b")]
    assert kinds("<article><p>a</p><form>b</form></article>") == ["a"]
    assert kinds("<article><p>one<button>x<p>two</article>") == ["one", "two"]
    assert kinds("<article><p>a <button><div>m</div></button> b</p></article>") == ["a b"]


def test_repeated_runs_equal_brute_force(spark):
    """Covered tokens and page counts against a search of every run of min_run tokens on every page."""
    ship_package(spark)
    draw = np.random.default_rng(5)
    words = [f"w{k}" for k in range(400)]
    passage = [" ".join(draw.choice(words, size)) for size in (8, 9, 15, 40)]
    pages = []
    for i in range(120):
        blocks = [" ".join(draw.choice(words, draw.integers(1, 60))) for _ in range(6)]
        for p in draw.choice(4, draw.integers(0, 4), replace=False):
            k = int(draw.integers(6))
            at = int(draw.integers(1 + blocks[k].count(" ")))
            blocks[k] = " ".join(blocks[k].split(" ")[:at] + [passage[p]] + blocks[k].split(" ")[at:])
        pages.append((i, ["h0", "h1", None][i % 3], blocks))
    pages += [(200 + i, h, list(b)) for i, h, b in pages[:40]]                     # copies count once
    rows = [(i, None if h is None else f"http://{h}/", "".join(f"<p>{b}</p>" for b in bs)) for i, h, bs in pages]
    got = {r.page_id: r.text for r in htmlmain.extract_main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string"), covered_share=0.3).collect()}

    where = defaultdict(set)                                                       # runs and short blocks by host
    for _, h, bs in pages:
        tokens = " ".join(bs).split(" ")
        for k in range(len(tokens) - 7):
            where[h, tuple(tokens[k:k + 8])].add(tuple(bs))
        for b in bs:
            if b.count(" ") < 7:
                where[h, b].add(tuple(bs))
    dropped = 0
    for i, h, bs in pages:
        tokens, kept, at = " ".join(bs).split(" "), [], 0
        under = [False] * len(tokens)
        for k in range(len(tokens) - 7):
            if len(where[h, tuple(tokens[k:k + 8])]) > 1:
                under[k:k + 8] = [True] * 8
        for b in bs:
            size = b.count(" ") + 1
            whole = size < 8 and len(where[h, b]) > 1
            kept += [b] if not whole and sum(under[at:at + size]) < 0.3 * size else []
            at += size
        dropped += len(bs) - len(kept)
        assert got[i] == "\n".join(kept)
    assert dropped > 40


def test_odd_page_tables(spark):
    long = "<article>" + "<p>" + "word " * 100_000 + "</p>" + "<p>end</p></article>"
    rows = [(1, None, None, 7, "x", -1), (1, None, None, 7, "x", -1), (None, "", "", 7, "x", -1),
            (2, "http://h/", long, 7, "x", -1), (3, "http://h/", long, 7, "x", -1), (4, "::", "<", 7, "x", -1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, rid long, content string, n_chars int")
    got = {(r.page_id, r.n_chars) for r in htmlmain.extract_main_text(pages).collect()}
    assert got == {(1, 0), (None, 0), (2, 500_003), (3, 500_003), (4, 1)}
    assert htmlmain.extract_main_text(pages).count() == 6
    assert htmlmain.extract_main_text(pages).columns == ["page_id", "url", "text", "n_chars"]


def test_runs_that_cannot_bear_on_a_choice_are_not_counted(spark):
    """Articles that share passages two by two: of these no run is sent, only those of the line on every page."""
    from demandcast.llm.common import written_tables
    ship_package(spark)
    draw = np.random.default_rng(3)
    text = lambda n: " ".join(f"w{k}" for k in draw.integers(0, 50_000, n))
    shared = [text(40) for _ in range(150)]
    rows = [(i, f"http://h.example/{i}", f"<nav><p>a b c d e f g h i j</p></nav><article><p>{text(20)}</p>"
             f"<p>{shared[i // 2]}</p></article>") for i in range(300)]
    before = set(written_tables())
    got = {r.page_id: r.text for r in htmlmain.extract_main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)).collect()}
    assert all(got[i].split("\n")[1] == shared[i // 2] for i in range(300))
    found = spark.read.parquet(*[p for p in written_tables() if p not in before and "html-suffixes" in p])
    assert 900 <= found.count() <= 3000 and found.where("asked and at >= 10").count() == 0


def test_parts_hand_on_every_mark_that_may_decide():
    """Marks of random parts of a host: those on MANY_PAGES pages and MANY_SHARE of all (pairs: two) always stay."""
    draw = np.random.default_rng(7)
    kept = dropped = 0
    for trial in range(300):
        pages = int(draw.choice([1, 4, 5, 6, 12, 20, 40, 200]))
        paired = trial % 4 == 0
        on = draw.random((pages, 30)) < draw.choice([.02, .1, .2, .25, .3, .6], 30)
        part = draw.integers(0, int(draw.choice([1, 2, 5, 40])), pages)
        weight, least = np.zeros(30, int), np.full(30, 99)
        for p in np.unique(part):
            page, mark = np.nonzero(on[part == p])
            if len(page):
                n = int((part == p).sum())
                m, count, need = htmlmain._part_marks(page, mark, np.full(n, 9), np.full(n, paired))
                weight[m] += count
                least[m] = np.minimum(least[m], need)
        total, stays = on.sum(0), weight >= least
        wanted = total >= (2 if paired else max(htmlmain.MANY_PAGES, htmlmain.MANY_SHARE * pages))
        assert not (wanted & ~stays).any()
        kept, dropped = kept + int(wanted.sum()), dropped + int((~stays & (total > 1)).sum())
    assert kept > 500 and dropped > 500


def test_choices_on_articles_equal_brute_force(spark):
    """Articles, mains, both and neither, on hosts of many sizes, with copies and equal texts of other kinds."""
    ship_package(spark)
    draw = np.random.default_rng(11)
    text = lambda low, high: " ".join(f"w{k}" for k in draw.integers(0, 300, draw.integers(low, high)))
    rows = []
    for h, n in enumerate([1, 2, 4, 5, 6, 9, 20, 21, 40, 90]):
        lines = [(text(2, 30), share) for share in (.1, .2, .25, .3, .5, 1.)]
        for j in range(n):
            bs = [b for b, share in lines if draw.random() < share] + [text(1, 60) for _ in range(3)]
            bs = [bs[k] for k in draw.permutation(len(bs))]
            at, put = int(draw.integers(len(bs))), lambda x: "".join(f"<p>{b}</p>" for b in x)
            form = 0 if h % 2 else int(draw.integers(4))
            page = [f"<nav>{put(bs[:1])}</nav><article>{put(bs[1:])}</article>", f"<nav>{put(bs[:1])}</nav>{put(bs[1:])}",
                    f"<main>{put(bs[:at])}<article>{put(bs[at:])}</article></main>", f"<main>{put(bs)}</main>"][form]
            rows.append((len(rows), f"http://h{h}/{j}", page))
            if j % 7 == 3:
                rows += [(len(rows), f"http://h{h}/", page),
                         (len(rows) + 1, f"http://h{h}/", page.replace("nav>", "article>"))]
    got = {r.page_id: r.text for r in htmlmain.extract_main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    scanned = [(i, htmlmain.host_of(u), htmlmain.page_blocks(p)) for i, u, p in rows]
    where, host_pages = defaultdict(set), defaultdict(set)

    def places(host, blocks):
        tokens = " ".join(t for _, t in blocks).split(" ")
        yield from ((k, (host, tuple(tokens[k:k + 8]))) for k in range(len(tokens) - 7))
        yield from ((-k - 1, (host, t)) for k, (_, t) in enumerate(blocks) if t.count(" ") < 7)

    for _, host, blocks in scanned:
        content = tuple(t for _, t in blocks)
        host_pages[host].add(content)
        for _, key in places(host, blocks):
            where[key].add(content)
    changed = 0
    for i, host, blocks in scanned:
        kinds, sizes = [k for k, _ in blocks], [t.count(" ") + 1 for _, t in blocks]
        repeats = {at: len(where[key]) for at, key in places(host, blocks) if len(where[key]) > 1}
        many = max(htmlmain.MANY_PAGES, htmlmain.MANY_SHARE * len(host_pages[host]))
        kept = htmlmain.choose_blocks(kinds, sizes, repeats, many, 8, 0.8)
        changed += kept != htmlmain.choose_blocks(kinds, sizes, {}, many, 8, 0.8)
        assert got[i] == "\n".join(blocks[k][1] for k in kept)
    assert changed > 60


def test_packed_marks_weigh_as_counted(monkeypatch):
    """Marks packed by parts, put in the order of buckets and summed in small portions, against plain sums."""
    import pyarrow as pa
    monkeypatch.setattr(htmlmain, "PART_MARKS", 50)
    draw = np.random.default_rng(2)
    names = draw.integers(-2 ** 63, 2 ** 63 - 1, 400)
    names[200:] = (names[200:] & ~np.int64(4095)) | 7                        # half of them in one bucket
    expected, rows = defaultdict(int), []
    for _ in range(12):
        mark = np.sort(draw.choice(names, 150, replace=False))
        pages, least = draw.integers(1, 4, 150), draw.choice([1, 2, 3], 150)
        for m, n, k in zip(mark.tolist(), pages.tolist(), least.tolist()):
            expected[m & (1 << 44) - 1] += n * (6 // k)
        rows += htmlmain._packed(mark, pages, least).to_pylist()
    rows.sort(key=lambda r: r["bucket"])
    schema = pa.schema([("bucket", pa.int32()), ("marks", pa.binary()), ("weights", pa.binary())])
    got = [m for batch in htmlmain._heavy_marks(iter(pa.RecordBatch.from_pylist(rows[k:k + 9], schema)
                                                     for k in range(0, len(rows), 9)))
           for m in batch.column("mark").to_pylist()]
    assert sorted(got) == sorted(m for m, w in expected.items() if w >= 6)
    assert list(htmlmain._heavy_marks(iter([]))) == []
