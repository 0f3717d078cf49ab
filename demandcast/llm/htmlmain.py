"""Main text of web pages: markup where it speaks, the host's suffix array where it is silent.

1. Every page is scanned once into blocks (one task-local pass, no tree kept): scripts, styles, forms and other
   raw elements are skipped, character references decoded, white space inside a block made one space.  A block
   is *furniture* (inside navigation, headers, footers, sidebars, adverts, notices, comments, by element, role or
   class name), else *article*, *main* (inside ``main`` only) or *open* (none of these).  Of a header inside an
   article the headings stay.  What only a name marks is furniture unless an article or main stands in it that has
   more words than all others of the page; names that tell a state (``has-sidebar``), ids of headings, sections and
   paragraphs inside articles, and compound names on headings mark nothing.
2. The token streams of all blocks of a page are laid end to end per host.  A suffix counts by its first ``min_run``
   tokens: a place lies under a substring of that length or more which repeats on another page exactly if it lies
   under such a beginning that does.  Suffixes are met in two steps, so that few of them go through the shuffle.
   Every suffix has a mark, the least hash of the short grams in its first ``min_run`` tokens; equal beginnings have
   equal marks, and a page has about a third as many marks as suffixes.  Marks are counted by pages first, part by
   part of the table, and shuffled only if suffixes under them may be on as many pages as the choice asks for (see
   ``frequent_marks``); only the suffixes under the marks that stay are then counted themselves, with their exact
   number of pages.  Tokens under a repeated one are covered.  Blocks shorter than ``min_run`` are also keyed whole.
   No host and no run is ever gathered in one task.
3. On pages without article and main blocks, open blocks that are covered to ``covered_share`` are boilerplate; the
   rest, the unique runs, is the text.  Otherwise the text is the article blocks or the blocks of ``main`` outside
   articles, whichever have more uncovered tokens (articles if equal).  Of these a block goes only if it is covered
   by runs on at least ``MANY_PAGES`` pages and ``MANY_SHARE`` of the host's pages: a passage that two articles
   share is still article text.  If all would go, all stay.  The choice is made on block sizes and covered places;
   texts move only where it differs from the one without repeats.

Defined results: null and empty html give an empty text.  A page without host is compared with the other pages
without host.  Pages of a host with equal content count as one page, so copies do not erase each other.  Time is
linear in a page's length, whatever its markup: beyond the last ">" all is text, and after a quote that never ends
the next ">" ends a tag.  Repeated rows give repeated rows; columns other than page_id, url and html are ignored.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.llm.common import FILTER_BITS, _marked, likely_rows, map_rows, materialize, split_rows

ARTICLE, MAIN, OPEN, FURNITURE = 3, 1, 0, 2
PAGES, TOKENS = 1000, 1 << 18  # pages and tokens of them that a task hashes at a time (one page at least)
PART_MARKS = 1 << 20           # marks of pages that a task counts at a time
MARK_BITS, BUCKET_BITS = 44, 12   # bits of a mark that are shuffled, and those that number its bucket
ENOUGH = 6                     # weight of a mark that stays; 2 and FEW_PAGES divide it
MANY_PAGES, MANY_SHARE = 5, 0.25   # pages of a host that repeat what is boilerplate even inside an article
FEW_PAGES = 3                  # marks on fewer pages of a host's small parts need not be met: see frequent_marks
DOUBTED = 4                    # added to the kind of an article or main inside an element that has a name of furniture

#: Element names by role, and class, id and role words of page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea select svg math object title button canvas "
                "video audio".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table "
                  "tbody td tfoot th thead tr ul caption".split())
FURNITURE_TAGS = frozenset("nav aside footer menu dialog".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FURNITURE_WORDS = frozenset("nav navbar navigation menu menubar footer sidebar ad ads advert adverts advertisement "
                            "advertising banner cookie cookies consent gdpr notice alert newsletter subscribe promo "
                            "promotion sponsor sponsored share sharing social comment comments respond disqus "
                            "breadcrumb breadcrumbs pagination pager popup modal overlay login signup search related "
                            "recommended contentinfo complementary masthead topbar toolbar widget skip menus notices "
                            "alerts notification reply replies copyright signin".split())
#: Beginnings of further such words.
FURNITURE_STEMS = re.compile("advert|adsby|adslot|adunit|adbox|breadcrumb|cookie|newsletter|sidebar|subscri|sponsor|"
                             "navbar|navigation|footer|paginat|commentl|commentb|commentt")
#: The only words that make an article itself furniture.
ARTICLE_WORDS = frozenset("ad ads advert adverts advertisement comment comments promo sponsored".split())
#: Names, as whole tokens, of elements that hold an article or the main part.
ARTICLE_NAMES = frozenset("article articlebody article-body article_body article__body article-content article-text "
                          "articletext".split())
MAIN_NAMES = frozenset("main main-content maincontent main_content".split())
#: Words of compound names that tell a state of the page and not what the element is.
STATE_WORDS = frozenset("has with without no is not show hide".split())
#: Elements that articles hold their text in, and the only words that make them furniture there.
TEXT_TAGS = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6".split())
TEXT_WORDS = ARTICLE_WORDS | frozenset("advertising share sharing newsletter subscribe cookie cookies".split())
#: An open element ends when one of these opens, unless a list, table or container lies between.
CLOSES = {"li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
          "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"])}
HOLDS = frozenset("ul ol dl table div section article main body nav aside footer header form".split())

_NAME = re.compile(r"<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)")
_ATTRS = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?=>)")
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none")
_WORD = re.compile(r"[a-z]+")
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
#: A button that is not closed ends where the next block or button begins.
_BUTTON_END = re.compile(rf"</button\s*>|<(?=button\b|/?(?:{'|'.join(sorted(BLOCK - {'div'}))})\b)", re.I)


def _attributes(attrs: str) -> dict[str, str]:
    """The attributes of a tag by name, in lower case; of repeated ones the first."""
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(attrs):
        found.setdefault(name.lower(), (a or b or c).lower())
    return found


def _is_hidden(named: dict[str, str]) -> bool:
    return ("hidden" in named or named.get("aria-hidden", "").strip() == "true"
            or bool(_NO_DISPLAY.search(named.get("style", ""))))


def _tokens(named: dict[str, str], names: tuple[str, ...] = ("class", "id", "role", "itemprop")) -> set[str]:
    return {t for n in names if n in named for t in named[n].split()}


def _words(tokens: set[str]) -> set[str]:
    """The words of names, without those of names that tell a state."""
    split = map(_WORD.findall, tokens)
    return {w for words in split if STATE_WORDS.isdisjoint(words) for w in words}


def _telling_words(name: str, named: dict[str, str], inside: bool) -> set[str]:
    """The words by which an element may be furniture or a header; ``inside``: of an article or main."""
    if name in HEADINGS:
        return _tokens(named, ("class", "role"))
    if not inside:
        return _words(_tokens(named))
    own = _words(_tokens(named, ("class", "role", "itemprop")))
    return own if name in TEXT_TAGS or name == "section" else own | _tokens(named, ("id",))


def _is_named_furniture(name: str, words: set[str], inside: bool) -> bool:
    if name in ("article", "main"):
        return not words.isdisjoint(ARTICLE_WORDS)
    if inside and name in TEXT_TAGS:
        return not words.isdisjoint(TEXT_WORDS)
    return not words.isdisjoint(FURNITURE_WORDS) or any(map(FURNITURE_STEMS.match, words))


def page_blocks(page: str) -> list[tuple[int, str]]:
    """(kind, text) of every non-empty block in page order."""
    out: list[tuple[int, str]] = []
    # name; article, main, furniture (by element; by name) and header depth inside it, names that an article reset
    stack: list[tuple[str, int, int, int, int, int, int]] = []
    parts: list[str] = []
    article = main = furniture = named = header = doubt = heading = 0

    def flush():
        if parts:
            words = " ".join("".join(parts).split())
            parts.clear()
            if words:
                hidden = furniture or named or (header and not ((article or main) and heading))
                kind = FURNITURE if hidden else ARTICLE if article else MAIN if main else OPEN
                out.append((kind + DOUBTED * (doubt > 0 and not hidden), words))

    places: dict[str, list[int]] = {}            # where on the stack elements of a name lie
    holds: list[int] = []                         # and those of HOLDS

    def pop_to(at: int):
        nonlocal article, main, furniture, named, header, doubt
        for name, *_ in reversed(stack[at:]):
            places[name].pop()
            if name in HOLDS:
                holds.pop()
        del stack[at:]
        article, main, furniture, named, header, doubt = stack[-1][1:] if stack else (0, 0, 0, 0, 0, 0)

    at, n = 0, len(page)
    last, quotes = page.rfind(">"), True          # no tag ends beyond; whether quotes may still hide a ">"
    while at < n:
        lt = page.find("<", at)
        if lt < 0 or lt > last:
            parts.append(entities.unescape(page[at:]))
            break
        if lt > at:
            parts.append(entities.unescape(page[at:lt]))
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            at = page.find(">", lt) + 1
            continue
        tag = _NAME.match(page, lt)
        if tag is None:                              # a bare "<" is text
            parts.append("<")
            at = lt + 1
            continue
        rest = _ATTRS.match(page, tag.end()) if quotes else None
        if rest is None:                             # a quote without end: from here on the next ">" ends a tag
            quotes = False
            at = page.find(">", lt) + 1
        else:
            at = rest.end() + 1
        if at == 0 or at <= tag.end():               # the name ran to the end of the page
            parts.append(entities.unescape(page[lt:]))
            break
        attrs = page[tag.end():at - 1]
        name, closing = tag["name"].lower(), bool(tag["close"])
        if name in RAW:
            if not closing and not attrs.rstrip().endswith("/"):
                end = (_BUTTON_END if name == "button" else _RAW_END[name]).search(page, at)
                at = n if end is None else end.end() if end[0] != "<" else end.start()
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in BLOCK:
            flush()
        if name in VOID:
            continue
        if closing:
            if name in HEADINGS:
                heading = 0
            if places.get(name):
                pop_to(places[name][-1])
            continue
        if name in BLOCK:
            held = holds[-1] if holds else -1
            ends = [place[k] for e in (*CLOSES.get(name, ()), "p") if (place := places.get(e))
                    and (k := bisect_right(place, held)) < len(place)]
            if ends:
                pop_to(min(ends))
            heading = int(name in HEADINGS)
        if attrs.rstrip().endswith("/") and name not in BLOCK:
            continue
        if name not in ("html", "body"):
            own = _attributes(attrs) if attrs else {}
            tokens = _tokens(own)
            is_article = name == "article" or not tokens.isdisjoint(ARTICLE_NAMES)
            is_main = name == "main" or not tokens.isdisjoint(MAIN_NAMES)
            if (is_article or is_main) and not (article or main) and (named or header):
                doubt, named, header = 1, 0, 0
            words = _telling_words(name, own, bool(article or main))
            article += is_article
            main += is_main
            furniture += name in FURNITURE_TAGS or _is_hidden(own)
            named += name == "form" or _is_named_furniture(name, words, bool(article or main))
            header += name == "header" or "header" in words
        places.setdefault(name, []).append(len(stack))
        if name in HOLDS:
            holds.append(len(stack))
        stack.append((name, article, main, furniture, named, header, doubt))
    flush()
    sure = sum(t.count(" ") + 1 for k, t in out if k in (ARTICLE, MAIN))
    doubted = sum(t.count(" ") + 1 for k, t in out if k >= DOUBTED)
    return [(k if k < DOUBTED else k - DOUBTED if doubted > sure else FURNITURE, t) for k, t in out]


def host_of(url: str | None) -> str | None:
    m = re.match(r"\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#\s]+)", url or "")
    return m[1].lower() if m else None


def scan_pages(pages: DataFrame) -> DataFrame:
    """One row per page: its host, its blocks, a hash of both (pages that agree in it count as one) and with kinds.

    ``pairs``: runs of two pages already bear on its choice; ``plain``: the choice if no run repeats.
    """
    def make() -> Callable[..., tuple]:
        def row(page_id, url, page):
            blocks = page_blocks(page or "")
            texts, host = [t for _, t in blocks], _host_seed(host_of(url))
            content = xxhash.xxh3_64_intdigest("\n".join(texts), host)
            kinds, sizes = [k for k, _ in blocks], [t.count(" ") + 1 for t in texts]
            form = xxhash.xxh3_64_intdigest(bytes(kinds), content)
            return (page_id, url, _signed(host), _signed(content), _signed(form), kinds, sizes, texts,
                    needs_pairs(kinds), choose_blocks(kinds, sizes, {}, 0, 0, 0))
        return row

    return map_rows(pages.select("page_id", "url", F.col("html").cast("string").alias("html")),
                    ["page_id", "url", "html"], "page_id long, url string, host long, content long, form long, "
                    "kinds array<int>, sizes array<int>, blocks array<string>, pairs boolean, plain array<int>", make)


def _host_seed(host: str | None) -> int:
    return xxhash.xxh3_64_intdigest(b"-" if host is None else b"+" + host.encode("utf-8", "surrogatepass"))


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _hashes(hashed: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` tokens."""
    n = max(0, len(hashed) - length + 1)
    runs = np.zeros(n, np.uint64)
    for k in range(length if n else 0):
        runs = (runs ^ (runs >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + hashed[k:k + n]
    return runs


def page_suffixes(pages: pa.RecordBatch, min_run: int) -> tuple[np.ndarray, ...]:
    """(page, at, key, mark) of the suffixes of some pages' streams, in order, and then of their short blocks whole.

    ``key`` stands for host and first ``min_run`` tokens (``at``: the token where they start) or for a short block
    (``at``: minus its number and one).  ``mark`` is the least hash of the shorter grams among these tokens: equal
    keys have equal marks, and neighbouring suffixes mostly share theirs, so there are far fewer marks than keys.
    """
    blocks = pages.column("blocks").flatten()
    page_of, sizes = _block_sizes(pages)
    seeds = pages.column("host").to_numpy(zero_copy_only=False).view(np.uint64)
    tokens = pc.split_pattern(blocks, " ").flatten().dictionary_encode()
    known = np.array([xxhash.xxh3_64_intdigest(t) for t in tokens.dictionary.cast(pa.binary()).to_pylist()], np.uint64)
    page = np.repeat(page_of, sizes)
    h = (known[tokens.indices.to_numpy()] ^ seeds[page]) * np.uint64(0xD6E8FEB86659FD93)
    lengths = np.bincount(page, minlength=pages.num_rows)
    ends = np.cumsum(lengths)
    gram = max(1, min_run // 2)
    h ^= h >> np.uint64(32)
    keys = _hashes(h, min_run)
    least = _hashes(h, gram)
    marks = least[:len(keys)].copy()
    for k in range(1, min_run - gram + 1 if len(keys) else 0):
        np.minimum(marks, least[k:k + len(keys)], out=marks)
    start = np.arange(len(keys))
    inside = start + min_run <= ends[page[:len(keys)]]                      # no run goes over the end of its page
    page, start, keys, marks = page[:len(keys)][inside], start[inside], keys[inside], marks[inside]
    short = np.flatnonzero(sizes < min_run)
    number = short - np.searchsorted(page_of, page_of[short])
    texts = blocks.take(pa.array(short)).cast(pa.binary()).to_pylist()
    whole = np.array([xxhash.xxh3_64_intdigest(b"\n" + b, s) for b, s in zip(texts, seeds[page_of[short]].tolist())],
                     np.uint64)
    return (np.concatenate([page, page_of[short]]), np.concatenate([start - (ends - lengths)[page], -number - 1]),
            np.concatenate([keys, whole]).view(np.int64), np.concatenate([marks, whole]).view(np.int64))


def _block_sizes(pages: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The page and the number of tokens of every block."""
    sizes = pages.column("sizes")
    counts = pc.list_value_length(sizes).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(pages.num_rows), counts), sizes.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _firsts(page: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Places of the first of every value in every page."""
    order = np.lexsort((value, page))
    new = (np.diff(page[order], prepend=-1) != 0) | (np.diff(value[order], prepend=0) != 0)
    return order[new]


def _some_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in pieces of at most PAGES pages, and of few if they are long."""
    for batch in batches:
        page, sizes = _block_sizes(batch)
        tokens = np.bincount(page, sizes, batch.num_rows).tolist()
        first = held = 0
        for k in range(len(tokens) + 1):
            if k == len(tokens) or (k > first and (k - first == PAGES or held + tokens[k] > TOKENS)):
                if k > first:
                    yield batch.slice(first, k - first)
                first, held = k, 0
            held += tokens[k] if k < len(tokens) else 0


def _part_marks(page: np.ndarray, mark: np.ndarray, host: np.ndarray, paired: np.ndarray) -> tuple[np.ndarray, ...]:
    """(mark, pages, least) of a part of the table: see ``frequent_marks``."""
    order = np.argsort(mark)
    mark, page = mark[order], page[order]
    starts = np.flatnonzero(np.diff(mark, prepend=~mark[:1]))
    pages = np.diff(np.append(starts, len(mark)))
    _, number, of_host = np.unique(host, return_inverse=True, return_counts=True)
    share = MANY_SHARE * (MANY_PAGES - FEW_PAGES + 1) / MANY_PAGES
    enough = np.ceil(share * of_host - 1e-9)[number][page[starts]]         # at least 2: the part is large for the host
    pairs = paired[page[starts]]
    sent = pairs | (pages >= enough)
    least = np.where(pairs, 2, np.where(enough > 1, 1, FEW_PAGES))
    return mark[starts][sent], pages[sent], least[sent]


def frequent_marks(scanned: DataFrame, min_run: int) -> DataFrame:
    """(mark): the lowest bits of the marks that are on enough pages of their host to bear on a choice, and some more.

    On a host with pages whose choice asks for runs on two pages (``paired``), these are the marks on two pages.
    Elsewhere a run bears on the choice if it is on T = max(MANY_PAGES, MANY_SHARE * pages of the host) pages.  A task
    counts marks in parts of the table.  A part that is large for a host hands on the marks on at least the share
    s = MANY_SHARE * (MANY_PAGES - FEW_PAGES + 1) / MANY_PAGES of its pages of that host; small parts hand on all, and
    of these the marks on FEW_PAGES pages stay.  Nothing is lost: a mark that no large part hands on, and that is on
    fewer than FEW_PAGES pages of small ones, is on fewer than s * pages of the host + FEW_PAGES - 1 <= T pages.
    Marks travel packed by buckets; that only their lowest bits do can keep further ones, but lose none.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        pages = entries = 0
        for part in _some_pages(batches):
            page, _, _, mark = page_suffixes(part, min_run)
            new = np.flatnonzero((np.diff(page, prepend=-1) != 0) | (np.diff(mark, prepend=0) != 0))
            page, mark = page[new], mark[new]
            first = _firsts(page, mark)
            held.append((page[first] + pages, mark[first], part.column("host").to_numpy(zero_copy_only=False),
                         part.column("paired").to_numpy(zero_copy_only=False)))
            pages, entries = pages + part.num_rows, entries + len(first)
            if entries > PART_MARKS:
                yield _packed(*_part_marks(*map(np.concatenate, zip(*held))))
                held, pages, entries = [], 0, 0
        if entries:
            yield _packed(*_part_marks(*map(np.concatenate, zip(*held))))

    sent = scanned.select("host", "paired", "sizes", "blocks") \
        .mapInArrow(run, "bucket int, marks binary, weights binary")
    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_heavy_marks, "mark long")


def _packed(mark: np.ndarray, pages: np.ndarray, least: np.ndarray) -> pa.RecordBatch:
    """(bucket, marks, weights): marks as four bytes beside their bucket, and ENOUGH times pages / least as one."""
    bucket = mark & ((1 << BUCKET_BITS) - 1)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    rest = ((mark[order] & ((1 << MARK_BITS) - 1)) >> BUCKET_BITS).astype(np.uint32)
    weight = np.minimum(ENOUGH, pages * (ENOUGH // least))[order].astype(np.uint8)
    starts = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = np.append(starts, len(bucket))
    column = lambda values: pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer((ends * values.itemsize).astype(np.int32)), pa.py_buffer(values)])
    return pa.RecordBatch.from_arrays([pa.array(bucket[starts], pa.int32()), column(rest), column(weight)],
                                      ["bucket", "marks", "weights"])


def _heavy_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The marks (their lowest MARK_BITS) whose weights make ENOUGH, from rows in the order of their buckets."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    entries = 0

    def summed() -> tuple[np.ndarray, np.ndarray]:
        mark, weight = map(np.concatenate, zip(*held))
        order = np.argsort(mark)
        mark, weight = mark[order], weight[order]
        starts = np.flatnonzero(np.diff(mark, prepend=-1))
        return mark[starts], np.minimum(ENOUGH, np.add.reduceat(weight, starts))

    for batch in batches:
        marks, weights = batch.column("marks"), batch.column("weights")
        bucket = np.repeat(batch.column("bucket").to_numpy(), pc.binary_length(weights).to_numpy()).astype(np.int64)
        rest = np.frombuffer(b"".join(marks.to_pylist()), np.uint32).astype(np.int64)
        held.append((rest << BUCKET_BITS | bucket, np.frombuffer(b"".join(weights.to_pylist()), np.uint8).astype(int)))
        entries += len(rest)
        if entries > PART_MARKS:                      # all but the last bucket are whole
            mark, weight = summed()
            last = (mark & ((1 << BUCKET_BITS) - 1)) == bucket[-1]
            yield pa.RecordBatch.from_arrays([pa.array(mark[~last & (weight >= ENOUGH)])], ["mark"])
            held, entries = [(mark[last], weight[last])], 0
    if held:
        mark, weight = summed()
        yield pa.RecordBatch.from_arrays([pa.array(mark[weight >= ENOUGH])], ["mark"])


def _bitmap(met: DataFrame) -> bytes:
    """The lowest bits of all marks as a bitmap, compressed: at most FILTER_BITS / 8 bytes, whatever the table holds."""
    bit = F.col("mark").bitwiseAND(F.lit(FILTER_BITS - 1))
    parts = met.groupBy(F.shiftright(bit, 15).alias("part")) \
        .agg(F.bitmap_construct_agg(bit.bitwiseAND(F.lit(32767))).alias("map"))
    found = bytearray(FILTER_BITS // 8)
    for part, bits in parts.collect():
        found[part * 4096:part * 4096 + len(bits)] = bits
    return zlib.compress(found, 1)


def asked_blocks(kinds: np.ndarray, page: np.ndarray) -> np.ndarray:
    """Of blocks and their pages: whether the choice depends on what covers the block."""
    text = (kinds == ARTICLE) | (kinds == MAIN)
    marked = np.bincount(page, text, page[-1] + 1 if len(page) else 0) > 0
    return text | ((kinds == OPEN) & ~marked[page])


def marked_suffixes(scanned: DataFrame, met: DataFrame, min_run: int) -> DataFrame:
    """(content, at, key, first, asked): the suffixes under the marks ``met``; ``first`` of its key in the page.

    ``asked``: the choice depends on what it covers (always on a ``mixed`` page, which stands for other kinds too).
    Neighbouring suffixes under one mark travel as one row; the lowest bit of a key gives way to ``first``.
    """
    compressed = _bitmap(met)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(zlib.decompress(compressed), np.uint8)
        for part in _some_pages(batches):
            page, at, key, mark = page_suffixes(part, min_run)
            mark &= (1 << MARK_BITS) - 1
            bit = mark & (FILTER_BITS - 1)
            likely = np.flatnonzero((bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1)
            if not len(likely):
                continue
            page, at, key, mark = page[likely], at[likely], key[likely], mark[likely]
            block_page, sizes = _block_sizes(part)
            asked = asked_blocks(part.column("kinds").flatten().to_numpy(zero_copy_only=False), block_page) \
                | part.column("mixed").to_numpy(zero_copy_only=False)[block_page]
            until = np.concatenate([[0], np.cumsum(np.repeat(asked, sizes))])   # tokens asked for before each
            first_block = np.searchsorted(block_page, page)
            begins = (np.cumsum(sizes) - sizes)[first_block] + np.maximum(at, 0)
            wanted = np.where(at < 0, asked[first_block + np.where(at < 0, -at - 1, 0)],
                              until[np.minimum(begins + min_run, len(until) - 1)] > until[begins])
            sent = key & ~np.int64(1)
            sent[_firsts(page, sent)] |= 1
            new = ((np.diff(page, prepend=-1) != 0) | (np.diff(mark, prepend=0) != 0) | (at <= 0)
                   | (np.diff(at, prepend=0) != 1) | (np.diff(wanted, prepend=False) != 0))
            starts = np.flatnonzero(new)
            lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(sent)), pa.int32()), pa.array(sent))
            content = part.column("content").to_numpy(zero_copy_only=False)[page[starts]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(content), pa.array(mark[starts]), pa.array(at[starts], pa.int32()),
                 pa.array(wanted[starts].astype(bool)), lists], ["content", "mark", "at", "asked", "keys"])

    rows = scanned.select("content", "host", "mixed", "kinds", "sizes", "blocks") \
        .mapInArrow(run, "content long, mark long, at int, asked boolean, keys array<long>")
    return (rows.join(met, "mark")
            .select("content", "at", "asked", F.posexplode("keys").alias("k", "sent"))
            .select("content", (F.col("at") + F.col("k")).alias("at"), F.shiftright("sent", 1).alias("key"),
                    (F.col("sent").bitwiseAND(F.lit(1).cast("long")) == 1).alias("first"), "asked"))


def needs_pairs(kinds: list[int]) -> bool:
    """Whether the choice asks for runs on two pages: between article and main, or among open blocks."""
    return (ARTICLE in kinds) == (MAIN in kinds) and any(k != FURNITURE for k in kinds)


def choose_blocks(kinds: list[int], sizes: list[int], repeats: dict[int, int], many: float, min_run: int,
                  covered_share: float) -> list[int]:
    """Numbers of the blocks of a page's main text; ``repeats`` has the pages of every repeated suffix by place."""
    if not repeats:
        words = {kind: sum(n for k, n in zip(kinds, sizes) if k == kind) for kind in (ARTICLE, MAIN)}
        best = MAIN if words[MAIN] > words[ARTICLE] else ARTICLE if words[ARTICLE] else OPEN
        return [i for i, k in enumerate(kinds) if k == best]
    starts = list(accumulate(sizes, initial=0))

    def covered(least: float) -> list[int]:
        under = bytearray(starts[-1])
        for at, n in repeats.items():
            if at >= 0 and n >= least:
                under[at:at + min_run] = b"\x01" * min_run
        return [size if repeats.get(-k - 1, 0) >= least else sum(under[at:at + size])
                for k, (at, size) in enumerate(zip(starts, sizes))]

    some = covered(2)
    unique = {k: sum(n - c for kind, n, c in zip(kinds, sizes, some) if kind == k) for k in (ARTICLE, MAIN)}
    if ARTICLE in kinds or MAIN in kinds:
        best = MAIN if ARTICLE not in kinds or (MAIN in kinds and unique[MAIN] > unique[ARTICLE]) else ARTICLE
        often = covered(many)
        found = [(i, c < covered_share * n) for i, (k, n, c) in enumerate(zip(kinds, sizes, often)) if k == best]
        return [i for i, stays in found if stays] or [i for i, _ in found]
    return [i for i, (k, n, c) in enumerate(zip(kinds, sizes, some)) if k == OPEN and c < covered_share * n]


def _without_copies(scanned: DataFrame, by: str) -> DataFrame:
    """One page of every value of ``by``; ``scanned`` itself where none repeats."""
    first = scanned.groupBy(by).agg(F.min("rid").alias("rid"), F.count("*").alias("n"))
    again = materialize(scanned.select(by, F.col("rid").alias("__rid"))
                        .join(first.where("n > 1").drop("n"), by).where("__rid <> rid").select("__rid"),
                        "html-copies")
    if not again.head(1):
        return scanned
    maybe, sure = split_rows(scanned, "rid", again)
    return sure.unionByName(maybe.join(again, F.col("rid") == F.col("__rid"), "left_anti"))


def _flagged(rows: DataFrame, column: str, wanted: DataFrame, flag: str) -> DataFrame:
    """``rows`` with ``flag``: true wherever ``column`` is among the values of ``wanted`` (and for few others)."""
    if not wanted.head(1):
        return rows.withColumn(flag, F.lit(False))
    return _marked(rows, column, wanted, FILTER_BITS).withColumnRenamed("__likely", flag)


def decisions(scanned: DataFrame, min_run: int, covered_share: float) -> DataFrame:
    """(form, chosen): block numbers, for the pages of which repeated suffixes change the choice."""
    one = _without_copies(scanned, "content")
    forms = one if one is scanned else _without_copies(scanned, "form")
    paired = materialize(scanned.where("pairs").select("host").distinct(), "html-paired")
    mixed = materialize(scanned.groupBy("content").agg(F.min("form").alias("a"), F.max("form").alias("b"))
                        .where("a <> b").select("content"), "html-mixed") if one is not scanned else paired.limit(0)
    one = _flagged(_flagged(one, "host", paired, "paired"), "content", mixed, "mixed")
    met = materialize(frequent_marks(one, min_run), "html-met")
    found = materialize(marked_suffixes(one, met, min_run), "html-suffixes")
    repeated = materialize(found.where("first").groupBy("key").agg(F.count("*").cast("int").alias("n"))
                           .where("n > 1"), "html-repeated")
    hits = likely_rows(found.where("asked").select("content", "at", "key"), "key", repeated.select("key")) \
        .join(repeated, "key")
    pages = hits.groupBy("content").agg(F.collect_list(F.struct("at", "n")).alias("hits"))  # at most a page's length
    hosts = materialize(one.groupBy("host").agg(F.count("*").alias("host_pages")), "html-hosts")
    rows = forms.select("form", "content", "host", "kinds", "sizes").join(pages, "content").join(hosts, "host")

    def make() -> Callable[..., tuple]:
        def row(form, kinds, sizes, hits, host_pages):
            many = max(MANY_PAGES, MANY_SHARE * host_pages)
            chosen = choose_blocks(kinds, sizes, {x["at"]: x["n"] for x in hits}, many, min_run, covered_share)
            return form, None if chosen == choose_blocks(kinds, sizes, {}, many, min_run, covered_share) else chosen
        return row

    return map_rows(rows, ["form", "kinds", "sizes", "hits", "host_pages"], "form long, chosen array<int>",
                    make).where("chosen is not null")


def extract_main_text(pages: DataFrame, min_run: int = 8, covered_share: float = 0.8) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (page_id, url, html)."""
    scanned = materialize(scan_pages(pages).withColumn("rid", F.monotonically_increasing_id()), "html-scan", "zstd")
    changed = materialize(decisions(scanned, min_run, covered_share).withColumnRenamed("form", "__form"),
                          "html-changed")
    rows = scanned.select("page_id", "url", "form", "blocks", F.col("plain").alias("chosen"))
    if changed.head(1):
        maybe, sure = split_rows(rows, "form", changed.select("__form"))
        maybe = maybe.withColumnRenamed("chosen", "plain").join(changed, F.col("form") == F.col("__form"), "left")
        rows = maybe.withColumn("chosen", F.coalesce("chosen", "plain")).select(rows.columns).unionByName(sure)
    text = F.array_join(F.transform("chosen", lambda k: F.get("blocks", k)), "\n")
    return rows.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
