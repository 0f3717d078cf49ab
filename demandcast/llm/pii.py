"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over the text: at-signs, plus signs, digits, URL schemes
and identifier cues.  Around each anchor a deterministic local parser walks outwards over the characters its
kind may hold and validates what it reached; nothing else of the text is looked at.

Base kinds (spans in code points, end exclusive, leftmost and non-overlapping within a kind):

* ``email``  ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, from the at-sign to both sides
* ``ip``     four dotted numbers, each at most 255
* ``card``   digits with single spaces or hyphens between, 16 to 19 of them, passing Luhn
* ``phone``  a plus sign and 8 to 15 digits among ``space ( ) . -``

A match that fails its check is dropped whole and not retried from a later start.  Added kinds:

* ``account``  the value behind an identifier cue (``account``, ``iban``, ``access_token`` ...), words such as
  ``number``, and ``:``, ``=``, ``#`` or ``is``: 8 or more of ``[A-Za-z0-9_-]`` (4 behind a password cue) with at least
  one digit; behind ``iban`` also groups between single spaces that pass mod 97, with or without such a mark
* ``url``      a scheme and what follows up to white space, quotes or angle brackets, without closing punctuation

Defined results: null and empty texts have no spans (empty strings, zero counts, the digest of the empty
string).  Repeated rows give repeated rows; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.llm.common import map_rows

Span = tuple[int, int]

_ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
DIGITS = frozenset("0123456789")
LOCAL = frozenset(_ALNUM + "._%+-")
LABEL = frozenset(_ALNUM + "-")
PHONE = frozenset("0123456789 ().-")
ACCOUNT = frozenset(_ALNUM + "_-")
ALNUM = frozenset(_ALNUM)
SPACE, QUOTES = frozenset(" "), frozenset(" \"'")
URL_END = frozenset(" \t\n\x0b\x0c\r\"'<>`{}|\\^")
URL_TRAIL = frozenset(".,;:!?)]")
#: Schemes and identifier cues that start an added span.
SCHEMES = ("http://", "https://", "ftp://", "ssh://", "sftp://", "mailto:")
CUES = ("account", "acct", "iban", "token", "api_key", "apikey", "secret", "password", "passwd", "ssn", "passport")
#: Words that may stand between a cue and its value, the cues of short values, and the least lengths of values.
FILLERS = frozenset("number no num nr id code is".split())
SHORT_CUES = frozenset(["password", "passwd"])
LEAST, LEAST_SHORT = 8, 4
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "account", "url")


def _automaton(words: dict[str, tuple]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for word, value in words.items():
        a.add_word(word, value)
    a.make_automaton()
    return a


def _anchors() -> ahocorasick.Automaton:
    words: dict[str, tuple] = {"@": ("@", 1), "+": ("+", 1)}
    words |= {d: ("0", 1) for d in "0123456789"}
    for s in SCHEMES:
        words |= {v: ("url", len(s)) for v in (s, s.upper(), s.capitalize())}
    for c in CUES:
        words |= {v: ("cue", len(c)) for v in (c, c.upper(), c.capitalize())}
    return _automaton(words)


def _run(text: str, at: int, allowed: frozenset) -> int:
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def expand_email(text: str, at: int, floor: int) -> Span | None:
    """Both sides of the at-sign ``at``, not left of ``floor``."""
    begin = at
    while begin > floor and text[begin - 1] in LOCAL:
        begin -= 1
    end = _run(text, at + 1, LABEL)
    if begin == at or end == at + 1:
        return None
    dotted = False
    while end < len(text) and text[end] == "." and (after := _run(text, end + 1, LABEL)) > end + 1:
        end, dotted = after, True
    return (begin, end) if dotted else None


def expand_ip(text: str, at: int) -> tuple[int, bool] | None:
    """End of four dotted numbers from the digit ``at``, and whether each is at most 255."""
    end, valid = at, True
    for k in range(4):
        if k:
            if end >= len(text) or text[end] != ".":
                return None
            end += 1
        after = _run(text, end, DIGITS)
        if after == end:
            return None
        part = text[end:after].lstrip("0")
        valid &= len(part) < 4 and int(part or 0) <= 255
        end = after
    return end, valid


def expand_card(text: str, at: int) -> tuple[int, bool] | None:
    """End of the digits from ``at``, single spaces and hyphens between, and whether they pass."""
    n, end, digits = len(text), at + 1, [text[at]]
    while end < n:
        k = end + (text[end] in " -")
        if k >= n or text[k] not in DIGITS:
            break
        digits.append(text[k])
        end = k + 1
    if len(digits) < 2:
        return None
    return end, 16 <= len(digits) <= 19 and luhn("".join(digits))


def expand_phone(text: str, at: int) -> tuple[int, bool] | None:
    """End of the number behind the plus sign ``at``, and whether it has 8 to 15 digits."""
    if at + 1 >= len(text) or text[at + 1] not in DIGITS:
        return None
    end = _run(text, at + 2, PHONE)
    while end > at + 3 and text[end - 1] not in DIGITS:
        end -= 1
    if end <= at + 3:
        return None
    return end, 8 <= sum(c in DIGITS for c in text[at:end]) <= 15


def expand_url(text: str, begin: int, end: int) -> Span | None:
    """The scheme at ``begin:end`` and what follows it."""
    if begin and text[begin - 1] in ACCOUNT:
        return None
    stop = end
    while stop < len(text) and text[stop] not in URL_END:
        stop += 1
    while stop > end and text[stop - 1] in URL_TRAIL:
        stop -= 1
    return (begin, stop) if stop > end else None


def expand_account(text: str, begin: int, end: int) -> Span | None:
    """The identifier that the cue at ``begin:end`` announces."""
    if begin and text[begin - 1] in ALNUM:
        return None
    cue = text[begin:end].lower()
    at, marked = _run(text, end, SPACE), False
    while (stop := _run(text, at, ALNUM)) > at and at > end and (word := text[at:stop].lower()) in FILLERS:
        marked |= word == "is"
        stop += text[stop:stop + 1] == "." and word in ("no", "num", "nr")
        at = _run(text, stop, SPACE)
        end = stop
    if at < len(text) and text[at] in ":=#":
        at, marked = at + 1, True
    at = _run(text, at, QUOTES)
    if cue == "iban" and (stop := expand_iban(text, at)):
        return at, stop
    stop = _run(text, at, ACCOUNT)
    least = LEAST_SHORT if cue in SHORT_CUES else LEAST
    return (at, stop) if marked and stop - at >= least and any(c in DIGITS for c in text[at:stop]) else None


def expand_iban(text: str, at: int) -> int | None:
    """End of the longest account number from ``at``, in groups between single spaces, that passes mod 97."""
    ends, chars, stop = [], "", at
    while (after := _run(text, stop, ALNUM)) > stop and len(chars) + after - stop <= 34:
        chars += text[stop:after].upper()
        ends.append((after, len(chars)))
        if text[after:after + 1] != " ":
            break
        stop = after + 1
    if not (chars[:2].isalpha() and chars[2:4].isdigit()):
        return None
    for end, n in reversed(ends):
        if n >= 15 and int("".join(str(int(c, 36)) for c in chars[4:n] + chars[:4])) % 97 == 1:
            return end
    return None


def find_spans(text: str, anchors: ahocorasick.Automaton) -> dict[str, list[Span]]:
    """All spans by kind, in text order."""
    found: dict[str, list[Span]] = {k: [] for k in KINDS}
    past = dict.fromkeys((*KINDS, "ip_run", "card_run"), 0)   # where each kind's last match ended
    for last, (kind, length) in anchors.iter(text):
        begin = last - length + 1
        if kind == "0":
            if begin >= past["ip_run"]:
                got = expand_ip(text, begin)
                past["ip_run"] = got[0] if got else _run(text, begin, DIGITS)
                if got and got[1]:
                    found["ip"].append((begin, got[0]))
            if begin >= past["card_run"] and (got := expand_card(text, begin)):
                past["card_run"] = got[0]
                if got[1]:
                    found["card"].append((begin, got[0]))
        elif kind == "@":
            if span := expand_email(text, begin, past["email"]):
                found["email"].append(span)
                past["email"] = span[1]
        elif kind == "+":
            if begin >= past["phone"] and (got := expand_phone(text, begin)):
                past["phone"] = got[0]
                if got[1]:
                    found["phone"].append((begin, got[0]))
        else:
            name = "url" if kind == "url" else "account"
            expand = expand_url if kind == "url" else expand_account
            if begin >= past[name] and (span := expand(text, begin, last + 1)):
                found[name].append(span)
                past[name] = span[1]
    return found


def listed(found: dict[str, list[Span]], kinds) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in found[k])


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans, for every row of ``docs``."""
    def make() -> Callable[..., tuple]:
        anchors = _anchors()
        nothing = hashlib.sha256(b"").hexdigest()

        def row(doc_id, text):
            if not text:
                return doc_id, 0, 0, 0, 0, nothing, ""
            found = find_spans(text, anchors)
            base = listed(found, BASE_KINDS)
            return (doc_id, *(len(found[k]) for k in BASE_KINDS),
                    hashlib.sha256(base.encode()).hexdigest(), listed(found, KINDS))
        return row

    return map_rows(docs.select("doc_id", F.col("text").cast("string").alias("text")), ["doc_id", "text"],
                    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
                    "spans string", make)


def mask_personal_data(docs: DataFrame, mask: str = "[{}]") -> DataFrame:
    """``doc_id, text`` with every span replaced by its kind (overlapping spans: by that of the first)."""
    def make() -> Callable[..., tuple]:
        anchors = _anchors()

        def row(doc_id, text):
            if not text:
                return doc_id, text
            found = find_spans(text, anchors)
            out, at = [], 0
            for begin, end, kind in sorted((a, -b, k) for k in KINDS for a, b in found[k]):
                if begin >= at:
                    out += [text[at:begin], mask.format(kind)]
                at = max(at, -end)
            return doc_id, "".join(out) + text[at:]
        return row

    return map_rows(docs, ["doc_id", "text"], "doc_id long, text string", make)
