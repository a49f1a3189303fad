"""Personal data: base patterns, and candidates that boosted trees select.

Base spans come from four patterns with their checks (address ranges, Luhn, digit
counts) and always stand.  Generators with high recall then propose overlapping
spans: chains of digits, anything with an at sign (also spelled out), dotted
numbers, long mixed tokens.  Boosted trees score a proposal's format and
context; they see neither its kind nor a check's outcome.  They learn from weak
labels.  Right are base spans, assigned secrets, addresses spelled out, numbers
that a word like "call" or "card" announces, and phone formats.  Wrong are, of
every kind, what failed its check where no word announces it: dates, ranges of
years, grouped numbers, ISBNs, parts of longer tokens, unassigned tokens; and
short numbers and versions.  ``EXAMPLES``, a fixed set of lines of both sorts, is
learned beside the documents, as these may hold none of a kind.  All documents
count: their proposals go into a grid of features in tasks, and the trees are
fitted in tasks on all its cells by their numbers, however many.  Of overlapping
proposals over the threshold the likelier one stays, if it touches no base span.
Proposals come from the text between base spans.  What the base patterns find
between the spans chosen, where a tag will stand at either end, is added until
they find nothing more: a text with its spans replaced holds no base pattern.

Marks (at signs, dots between digits) are found first and grow within runs of
the bytes that a pattern allows, so time is linear in a token's length.

Rates are calibrated on folds left out of training.  A kind's threshold is the
least rate at which the share ``PRECISION`` of its labelled proposals beside base
spans is right on those folds (an isotonic fit by kind).

Defined results: null and empty texts have no spans; repeated rows have equal
spans; offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import math
import random
import re
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upcheck.llm.boosting import Calibrated, isotonic
from upcheck.llm.boosting_tasks import calibrated, grown, held_out, packed, pooled
from upcheck.llm.common import SPACE, Scratch, slices, text_bytes, unused, word_spans

KINDS = ["email", "ip", "card", "phone", "secret"]
#: What all documents' proposals weigh at most, each alike, beside the examples; folds left out in turn.
DOCS_WEIGHT, FOLDS = 30_000.0, 4
PRECISION = 0.95
CONTEXT = 24  # bytes on each side

DOMAIN = re.compile(rb"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")

#: Generators that look at a bounded number of bytes from any start, or start at the head of a run only.
PROPOSED = [
    ("ip", re.compile(rb"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])")),
    ("ip", re.compile(rb"(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}")),
    ("card", re.compile(rb"[0-9](?:[ -]?[0-9]){12,18}")),
    ("phone", re.compile(rb"\+?\(?[0-9](?:[ ().-]{0,2}[0-9]){6,14}")),
    ("secret", re.compile(rb"[A-Za-z0-9_+/=-]{16,}")),
    ("plain", re.compile(rb"[0-9]++(?:[.,:/-][0-9]++)*+")),
    ("plain", re.compile(rb"(?<![A-Za-z])[A-Za-z]*+[0-9][A-Za-z0-9.]*+")),
]
SPELLED_DOMAIN = re.compile(rb" ?[A-Za-z0-9-]++(?:(?: ?[(\[{] ?dot ?[)\]}] ?|\.)[A-Za-z0-9-]++)++", re.I)
ASSIGNED = re.compile(rb"(?:token|key|secret|password|passwd|pwd)\s*[:=]\s*[\"']?$", re.I)
SPELLED = re.compile(rb"[(\[{] ?at ?[)\]}]", re.I)
_LOCAL = np.zeros(256, dtype=bool)
_LOCAL[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")] = True
_TOKEN = ~SPACE  # of a proposed address
_TOKEN[list(b"<>\"',;:()[]\x1c\x1d\x1e\x1f")] = False
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True


def luhn(digits: list[int]) -> bool:
    twice = [d * 2 - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(twice)) % 10 == 0


def _runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of a mask, none over the edge of a row."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = edge[0] = edge[n] = True
    first = inside & (edge[:-1] | np.append(True, ~inside[:-1]))
    last = inside & (edge[1:] | np.append(~inside[1:], True))
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _left_of(marks: np.ndarray, inside: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the run of a mask that ends at each mark starts, in the mark's row; the mark itself if none does."""
    starts, ends = _runs(inside, offsets)
    at = np.searchsorted(ends, marks)
    found = (at < len(ends)) & (ends[np.minimum(at, len(ends) - 1)] == marks) if len(ends) else np.zeros(len(marks), bool)
    left = np.where(found, starts[np.minimum(at, len(ends) - 1)] if len(ends) else marks, marks)
    return np.maximum(left, offsets[np.searchsorted(offsets, marks, side="right") - 1])


def in_octet(digits: bytes) -> bool:
    """Whether the number is 255 at most; digits may be more than int() takes."""
    digits = digits.lstrip(b"0")
    return len(digits) < 3 or len(digits) == 3 and digits <= b"255"


def base_spans(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, str]]:
    """Byte spans of the four patterns; every match lies in a run of bytes that its pattern allows."""
    raw, out = data.tobytes(), []
    signs = np.flatnonzero(data == 64)
    if len(signs):
        left = _left_of(signs, _LOCAL[data], offsets)
        stop = offsets[np.searchsorted(offsets, signs, side="right")]
        end = 0
        for p, s, e in zip(signs.tolist(), left.tolist(), stop.tolist()):
            s = max(s, end)
            m = DOMAIN.match(raw, p + 1, e) if s < p else None
            if m:
                end = m.end()
                out.append((s, end, "email"))
    starts, ends = _runs(_DIGIT[data], offsets)
    if len(starts) > 3:
        tied = np.zeros(len(starts), dtype=bool)  # to the run before, by a dot alone
        tied[1:] = (starts[1:] - ends[:-1] == 1) & (data[ends[:-1]] == 46)
        tied[1:] &= np.searchsorted(offsets, starts[1:], side="right") == np.searchsorted(offsets, ends[:-1] - 1, side="right")
        head = np.flatnonzero(~tied)
        count = np.diff(np.append(head, len(starts)))
        for h, n in zip(head[count > 3].tolist(), count[count > 3].tolist()):
            for k in range(h, h + n - 3, 4):
                if all(in_octet(raw[s:e]) for s, e in zip(starts[k:k + 4].tolist(), ends[k:k + 4].tolist())):
                    out.append((int(starts[k]), int(ends[k + 3]), "ip"))
    at = np.flatnonzero(_DIGIT[data])
    if len(at):
        row = np.searchsorted(offsets, at, side="right") - 1
        gap = np.diff(at)
        between = data[at[:-1] + 1]
        tied = ((gap == 1) | ((gap == 2) & ((between == 32) | (between == 45)))) & (row[1:] == row[:-1])
        head = np.flatnonzero(np.append(True, ~tied))
        size = np.diff(np.append(head, len(at)))
        for h, n in zip(head[(size >= 16) & (size <= 19)].tolist(), size[(size >= 16) & (size <= 19)].tolist()):
            if luhn((data[at[h:h + n]] - 48).astype(int).tolist()):
                out.append((int(at[h]), int(at[h + n - 1]) + 1, "card"))
    plus = np.flatnonzero(data[:-1] == 43)
    for p in plus[_DIGIT[data[plus + 1]]].tolist():
        end = int(offsets[np.searchsorted(offsets, p, side="right")])
        m = PHONE.match(raw, p, end)
        if m and 8 <= sum(48 <= c < 58 for c in m.group()) <= 15:
            out.append((p, m.end(), "phone"))
    return out


def regions(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
    """Runs of words that hold a digit or an at sign (or spell one out), one space or sign apart."""
    starts, ends, first = word_spans(data, offsets)
    marked = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_DIGIT[data] | (data == 64), out=marked[1:])
    hot = marked[ends] > marked[starts]
    for m in SPELLED.finditer(data.tobytes()):
        w = np.searchsorted(starts, m.start(), side="right") - 1
        hot[max(0, w - 1):w + 4] = True
    at = np.flatnonzero(hot)
    if not len(at):
        return []
    row = np.searchsorted(first, at, side="right") - 1
    split = np.append(True, (np.diff(at) > 1) | (row[1:] != row[:-1]) | (starts[at[1:]] - ends[at[:-1]] > 2))
    head = np.flatnonzero(split)
    return list(zip(starts[at[head]].tolist(), ends[at[np.append(head[1:], len(at)) - 1]].tolist()))


def proposals(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, str]]:
    """Spans of all generators, overlapping; none over the edge of a row."""
    raw, out = data.tobytes(), set()
    # tokens with an at sign inside
    starts, ends = _runs(_TOKEN[data], offsets)
    signs = np.zeros(len(data) + 1, np.int64)
    np.cumsum(data == 64, out=signs[1:])
    inner = signs[np.maximum(ends - 1, starts)] > signs[np.minimum(starts + 1, ends)]
    out.update((s, e, "email") for s, e in zip(starts[inner].tolist(), ends[inner].tolist()))
    # addresses spelled out
    marks = [m.span() for m in SPELLED.finditer(raw)]
    if marks:
        at = np.array([s for s, _ in marks])
        row = np.searchsorted(offsets, at, side="right") - 1
        at -= (at > offsets[row]) & (data[at - 1] == 32)
        for (_, e), s, p, stop in zip(marks, _left_of(at, _LOCAL[data], offsets).tolist(), at.tolist(), offsets[row + 1].tolist()):
            m = SPELLED_DOMAIN.match(raw, e, stop) if s < p and e <= stop else None
            if m:
                out.add((s, m.end(), "email"))
    for a, b in regions(data, offsets):
        for kind, pattern in PROPOSED:
            for m in pattern.finditer(raw, a, b):
                text = m.group()
                if kind == "secret" and not (re.search(rb"[0-9]", text) and re.search(rb"[A-Za-z]", text)):
                    continue
                out.add((m.start(), m.end(), kind))
    out.update(_card_parts(data, offsets))
    return sorted(out)


def _card_parts(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, str]]:
    """Of chains with more digits than a card has, the runs of whole groups (of three digits or more) that pass Luhn."""
    starts, ends = _runs(_DIGIT[data], offsets)
    long = ends - starts >= 3
    starts, ends = starts[long], ends[long]
    if len(starts) < 2:
        return []
    tied = np.zeros(len(starts), dtype=bool)
    between = data[ends[:-1]]
    tied[1:] = (starts[1:] - ends[:-1] == 1) & ((between == 32) | (between == 45))
    tied[1:] &= np.searchsorted(offsets, starts[1:], side="right") == np.searchsorted(offsets, ends[:-1] - 1, side="right")
    head = np.flatnonzero(~tied)
    stop = np.append(head[1:], len(starts))
    digits = np.append(0, np.cumsum(ends - starts))
    out = []
    for h, t in zip(*(x[digits[stop] - digits[head] > 19].tolist() for x in (head, stop))):
        for i in range(h, t):
            for j in range(i + 1, t):
                n = digits[j + 1] - digits[i]
                if n > 19:
                    break
                if n >= 15:
                    part = data[starts[i]:ends[j]]
                    if luhn((part[_DIGIT[part]] - 48).astype(int).tolist()):
                        out.append((int(starts[i]), int(ends[j]), "card"))
    return out


_WORDS = [rb"token|key|secret|passw|pwd", rb"phone|tel|call|mobile|fax", rb"card|visa|account|iban", rb"\bip\b|host|server|address", rb"mail|contact", rb"version|license|licence|\bv\b|gpl|page|chapter"]
_CONTEXT = [re.compile(w, re.I) for w in _WORDS]
INSIDE = re.compile(rb"(?:token|key|secret|password|passwd|pwd)=", re.I)
CALLED = re.compile(rb"\b(?:phone|tel|call|mobile|fax)\b[^0-9]{0,12}$", re.I)
CARDED = re.compile(rb"\b(?:card|visa|mastercard|amex)\b[^0-9]{0,12}$", re.I)
FORMATTED = re.compile(rb"(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[.-])[0-9]{3}[.-][0-9]{4}")
DATED = re.compile(rb"(?:1[5-9]|20)[0-9]{2}[ .-]{1,3}(?:(?:1[5-9]|20)[0-9]{2}|[01]?[0-9][ .-][0-3]?[0-9])|[0-3]?[0-9][ .-][0-3]?[0-9][ .-](?:1[5-9]|20)[0-9]{2}")
FEATURES = 26


def described(raw: bytes, span: tuple[int, int, str], lo: int, hi: int) -> list[float]:
    """Format and context of a span in the text ``raw[lo:hi]``, whatever its kind."""
    s, e, _ = span
    text = raw[s:e]
    n = len(text)
    count = lambda chars: sum(text.count(c) for c in chars)
    digits = sum(48 <= c < 58 for c in text)
    letters = sum(65 <= (c & 0xDF) < 91 for c in text)
    hexes = sum(c in b"abcdefABCDEF" for c in text)
    counts = [text.count(bytes([c])) for c in set(text)]
    entropy = -sum(c / n * math.log2(c / n) for c in counts)
    groups = re.findall(rb"[0-9]+", text)
    before, after = raw[max(lo, s - CONTEXT):s], raw[e:min(hi, e + CONTEXT)]
    prev, next_ = before[-1:] or b" ", after[:1] or b" "
    return [
        n, digits, letters, digits / n, (hexes + digits) / n, entropy, count([b"."]), count([b" ", b"-"]), count([b"(", b")"]), count([b"@"]), count([b":"]), float(text[:1] == b"+"),
        len(groups), max((len(g) for g in groups), default=0), min((len(g) for g in groups), default=0), sum(len(g) <= 3 for g in groups),
        float(prev in b" \n\t"), float(prev in b"\"'=:<("), float(SPACE[next_[0]]), float(next_.isalnum()),
        float(bool(_CONTEXT[0].search(before) or INSIDE.search(text))), *(float(bool(w.search(before))) for w in _CONTEXT[1:])]


BASE = 2


def weak_label(raw: bytes, span: tuple[int, int, str], base: dict[tuple[int, int], set[str]], touched: bool, lo: int, hi: int) -> int:
    """BASE for base spans, 1 for proposals that are right, 0 for those that are wrong; -1 where neither is sure."""
    s, e, kind = span
    if kind in base.get((s, e), ()):
        return BASE
    if touched:
        return -1
    text, before = raw[s:e], raw[max(lo, s - CONTEXT):s]
    digits = bytes(c for c in text if 48 <= c < 58)
    if kind == "plain":
        return 0 if len(digits) <= 6 and e - s < 16 else -1
    if kind == "secret":
        return int(bool(ASSIGNED.search(before) or INSIDE.search(text)))
    if kind == "email":
        end = re.split(rb"[.@)\]} ]", text)[-1]
        named = len(end) >= 2 and not any(c < 128 and not chr(c).isalpha() for c in end)
        if b"@" in text:
            return int(named and b"." in text[text.rindex(b"@"):])
        return 0 if not named else 1 if re.search(rb"[(\[{] ?dot", text, re.I) else -1
    if before[-1:].isalnum() or raw[e:min(hi, e + 1)].isalnum():
        return 0  # a part of something longer
    if kind == "ip":
        if b":" in text:
            groups = text.split(b":")
            return 0 if text.replace(b":", b"").isdigit() and max(map(len, groups)) <= 2 else 1 if len(groups) == 8 and not text.replace(b":", b"").isdigit() else -1
        return -1 if _CONTEXT[3].search(before) else 0
    if kind == "card":
        if len(digits) == 13 and digits[:3] in (b"978", b"979"):
            return 0
        if CARDED.search(before):
            return 1 if len(digits) >= 15 else -1
        return -1 if luhn([c - 48 for c in digits]) else 0
    if DATED.fullmatch(text) or len(digits) == 13 and digits[:3] in (b"978", b"979"):
        return 0
    if CALLED.search(before) or FORMATTED.fullmatch(text):
        return 1
    return -1 if text[:1] in b"+(" or text[:1] == b"0" and re.search(rb"[^0-9]", text) else 0


def _examples() -> list[str]:
    rnd = random.Random(11)
    d = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    w = lambda: "".join(rnd.choice("abcdefghiklmnoprstuvw") for _ in range(rnd.randint(3, 9)))
    year = lambda: str(rnd.randint(1900, 2030))
    long_ = lambda: "".join(rnd.choice("abcdef0123456789" if rnd.random() < 0.5 else "abcdefghijklmnopqrstuvwxyzABCDEFGHIJ0123456789") for _ in range(rnd.choice([20, 24, 32, 40, 64])))
    hexed = lambda n: "".join(rnd.choice("0123456789abcdef") for _ in range(n))
    part = lambda: f"{rnd.randint(1, 12):02d}"
    name = lambda: rnd.choice(["token", "key", "secret", "password", "api_key"])
    phone = lambda: rnd.choice([f"{rnd.randint(200, 999)}-{d(3)}-{d(4)}", f"({rnd.randint(200, 999)}) {d(3)}-{d(4)}", f"0{d(3)} {d(7)}", f"{rnd.randint(2, 9)}{d(9)}"])
    card = lambda: rnd.choice([" ", "-", ""]).join(d(4) for _ in range(4))
    spans = [
        # right
        lambda: f"{name()}{rnd.choice([' = ', ': ', '='])}{rnd.choice(['', chr(34)])}{long_()}", lambda: f"{name()}{rnd.choice([' = ', ': '])}{rnd.choice(['', chr(34)])}{w()}_{year()}_{hexed(12)}",
        lambda: f"{w()} (at) {w()} (dot) com", lambda: f"{w()}.{w()}[at]{w()}[dot]org", lambda: ":".join(hexed(4) for _ in range(8)),
        lambda: f"{rnd.choice(['call', 'phone', 'tel', 'mobile', 'fax'])}{rnd.choice([' ', ': ', ' me on '])}{phone()}", lambda: f"({rnd.randint(200, 999)}) {d(3)}-{d(4)}", lambda: f"{rnd.randint(200, 999)}-{d(3)}-{d(4)}",
        lambda: f"{rnd.choice(['card', 'visa', 'my card is', 'Mastercard'])}{rnd.choice([' ', ': '])}{card()}",
        # wrong
        lambda: f"{year()}-{part()}-{part()}", lambda: f"{part()}.{part()}.{year()}", lambda: f"{year()}-{year()}", lambda: f"{year()} - {year()}", lambda: f"{rnd.randint(1, 999)} {d(3)} {d(3)}",
        lambda: f"{rnd.randint(1, 999)} {d(3)} {d(3)} {d(3)}", lambda: rnd.choice(["978", "979"]) + rnd.choice([f"-{d(1)}-{d(2)}-{d(6)}-{d(1)}", f"-{d(1)}-{d(3)}-{d(5)}-{d(1)}", d(10), f" {d(1)} {d(4)} {d(4)} {d(1)}"]),
        lambda: d(rnd.randint(7, 19)), card, lambda: f"{w()}_{year()}_{w()}_{w()}", lambda: f"{w()}-{w()}-{w()}-{d(2)}-{w()}", lambda: f"{w()}/{w()}/{w()}{d(2)}/{w()}", lambda: rnd.choice("/_-").join([w(), f"{w()}-{d(1)}", f"{w()}_{d(2)}_{w()}"]), long_, lambda: f"the {name()} is in {w()}_{year()}_{w()}_{w()}",
        lambda: f"{w()}@{w()}", lambda: f"@{w()}{d(2)}", lambda: f"{w()}@", lambda: f"{w()} (at) {d(2)}.{d(2)}", lambda: f"{rnd.randint(256, 999)}.{rnd.randint(0, 999)}.{rnd.randint(0, 999)}.{rnd.randint(0, 999)}",
        lambda: ":".join(f"{rnd.randint(0, 59):02d}" for _ in range(4)), lambda: f"version {rnd.randint(256, 999)}.{d(1)}.{d(1)}.{d(1)}"]
    return [f"{w()} {w()} {w()} {make()}{rnd.choice([' ', '. ', ', '])}{w()} {w()}" for _ in range(EACH) for make in spans]


#: Lines made of each sort of example.
EACH = 60
EXAMPLES = _examples()


def _between(offsets: np.ndarray, spans: list) -> np.ndarray:
    """Edges of rows and of spans."""
    return np.unique(np.concatenate([offsets, np.array([x for s, e, *_ in spans for x in (s, e)], np.int64)]))


def _examined(data: np.ndarray, offsets: np.ndarray):
    """Base spans, proposals that aren't base, their features, and those of base spans, by byte."""
    raw, base = data.tobytes(), base_spans(data, offsets)
    known: dict[tuple[int, int], set[str]] = {}
    covered = np.zeros(len(data), dtype=bool)
    for s, e, kind in base:
        known.setdefault((s, e), set()).add(kind)
        covered[s:e] = True
    offered = proposals(data, _between(offsets, base))
    seen = set(offered)
    every = [*offered, *(x for x in base if x not in seen)]
    rows = np.searchsorted(offsets, [s for s, _, _ in every], side="right").tolist()
    x = [described(raw, span, int(offsets[r - 1]), int(offsets[r])) for span, r in zip(every, rows)]
    y = [weak_label(raw, span, known, bool(covered[span[0]:span[1]].any()), int(offsets[r - 1]), int(offsets[r])) for span, r in zip(every, rows)]
    return base, every, np.array(x, float).reshape(-1, FEATURES), y


def cutoffs(kinds: np.ndarray, y: np.ndarray, rate: np.ndarray, weight: np.ndarray | None = None) -> dict[str, float]:
    """For each kind the least rate at which PRECISION of the labels beside base spans are right; infinite if none is."""
    out = {}
    for kind in KINDS:
        mine = np.flatnonzero((kinds == kind) & (y != BASE))
        mine = mine[np.argsort(-y[mine], kind="stable")]  # so that equal rates are pooled
        out[kind] = _least(*isotonic(rate[mine], y[mine].astype(float), None if weight is None else weight[mine]))
    return out


def _least(xs: np.ndarray, ys: np.ndarray) -> float:
    """The least rate at which an isotonic fit reaches PRECISION; infinite if none does."""
    return float(min(xs[ys >= PRECISION], default=math.inf))


#: Values that a feature is rounded up to for training: counts, shares, entropy.  A cut at one of them parts the values themselves alike.
_GRIDS = [np.array([*range(21), 24, 28, 32, 40, 64, 128, 256, 1024], float), np.arange(17) / 16, np.arange(33) / 4]
GRID = [_GRIDS[{3: 1, 4: 1, 5: 2}.get(f, 0)] for f in range(FEATURES)]
BEYOND = 1e9


def gridded(x: np.ndarray) -> np.ndarray:
    """For each feature the place on its grid of the least value that is not below."""
    return np.stack([np.searchsorted(g, x[:, f], side="left") for f, g in enumerate(GRID)], axis=1).astype(np.uint8)


def coarser(cells: np.ndarray, step: int) -> np.ndarray:
    """The same on grids of every ``step``-th value."""
    return ((cells.astype(np.int64) + step - 1) // step).astype(np.uint8)


def ungridded(cells: np.ndarray, step: int = 1) -> np.ndarray:
    """The values at these places."""
    return np.stack([np.append(g, BEYOND)[np.minimum(cells[:, f].astype(np.int64) * step, len(g))] for f, g in enumerate(GRID)], axis=1)


_CELL_SQL = "cell binary, kind string, y int, n long"


def _counted(cells: np.ndarray, kinds: list, y: list, n: list) -> pa.RecordBatch:
    """Equal cells of a kind and label as one."""
    total: dict[tuple, int] = {}
    for key in zip(map(bytes, cells), kinds, y, n):
        total[key[:3]] = total.get(key[:3], 0) + key[3]
    return pa.RecordBatch.from_arrays([pa.array([c for c, _, _ in total], pa.binary()), pa.array([k for _, k, _ in total], pa.string()),
                                       pa.array([v for _, _, v in total], pa.int32()), pa.array(list(total.values()), pa.int64())], names=["cell", "kind", "y", "n"])


def counted(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``(cell, kind, y, n)`` over the labelled proposals of all documents, on the finest grids."""
    def examine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for i, j in slices(offsets):
                _, every, x, y = _examined(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                use = [k for k in range(len(y)) if y[k] >= 0]
                if use:
                    yield _counted(gridded(x[use]), [every[k][2] for k in use], [y[k] for k in use], [1] * len(use))
    return _summed(docs.select("text").mapInArrow(examine, _CELL_SQL), scratch, "proposals")


def _summed(df: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    return scratch.save(df.groupBy("cell", "kind", "y").agg(F.sum("n").alias("n")), name)


def counts(docs: DataFrame, most: int, scratch: Scratch | None = None) -> tuple[DataFrame, int]:
    """The same as an overview of ``most`` rows at most (or of two places to a feature), and its grids' step, a power of two.

    For looking at what is learned from; the model is fitted on all that ``counted`` gives."""
    scratch = Scratch(docs.sparkSession) if scratch is None else scratch

    def widen(step: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cells = np.frombuffer(b"".join(batch.column("cell").to_pylist()), np.uint8).reshape(-1, FEATURES)
                yield _counted(coarser(cells, step), *(batch.column(c).to_pylist() for c in ("kind", "y", "n")))
        return run
    step = 1
    finest = table = counted(docs, scratch)
    while step < 32 and table.count() > most:
        step *= 2
        table = _summed(finest.mapInArrow(widen(step), _CELL_SQL), scratch, f"proposals{step}")
    return table, step


#: Numbers of the kinds in blocks.
_KINDS = [*KINDS, "plain"]


def train(docs: DataFrame) -> tuple[Calibrated, dict[str, float]]:
    """The model and each kind's threshold, from the proposals of all documents.

    Proposals are counted by their features on a grid, and trees, calibration and thresholds come
    from all these counts, in tasks.  In all they weigh ``DOCS_WEIGHT`` at most, so that the examples keep their part."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    table = counted(docs, scratch)
    n = table.agg(F.sum("n")).first()[0] or 0
    _, every, x, y = _examined(*text_bytes(pa.array(EXAMPLES)))
    use = [k for k in range(len(y)) if y[k] >= 0]
    examples = _counted(gridded(x[use]), [every[k][2] for k in use], [y[k] for k in use], [1] * len(use)).to_pylist()
    kind = F.array_position(F.array(*map(F.lit, _KINDS)), F.col("kind")).cast("int") - 1
    rows = (table.select("cell", kind.alias("kind"), "y", "n", F.lit(min(1.0, DOCS_WEIGHT / max(n, 1))).alias("unit"))
            .unionAll(spark.createDataFrame([tuple(e.values()) for e in examples], _CELL_SQL).select("cell", kind, "y", "n", F.lit(1.0))))
    blocks = packed(rows, FOLDS, scratch)
    state, fine = grown(blocks, GRID, min(n, DOCS_WEIGHT) + len(use), FOLDS)
    held = held_out(blocks, state, fine, scratch)
    parts = max(1, blocks.count())
    right = F.when(F.col("y") > 0, 1).otherwise(0).alias("y")
    points = pooled(held.select(F.lit(0).alias("group"), F.col("held").alias("score"), right, "w"), parts)[0]
    model = calibrated(state, GRID, points)

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("kind"), pa.array(np.interp(batch.column("held").to_numpy(), *points)), batch.column("y"), batch.column("w")], names=["group", "score", "y", "w"])
    beside = held.where((F.col("y") != BASE) & (F.col("kind") < len(KINDS))).mapInArrow(rated, "`group` int, score double, y int, w long")
    fits = pooled(beside, parts)
    scratch.drop(*list(scratch.paths))
    return model, {k: _least(*fits[i]) if i in fits else math.inf for i, k in enumerate(KINDS)}


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("s", pa.int64()), ("e", pa.int64()), ("base", pa.bool_())]))
SPANS_SQL = "array<struct<kind:string,s:bigint,e:bigint,base:boolean>>"


def selected(base: list, every: list, rate: np.ndarray, thresholds: dict[str, float], size: int) -> tuple[list[tuple[int, int, str, bool]], np.ndarray]:
    """Base spans, and the likeliest proposals over their thresholds that touch nothing chosen before; the bytes in them."""
    out = [(s, e, k, True) for s, e, k in base]
    covered = np.zeros(size, dtype=bool)
    for s, e, _ in base:
        covered[s:e] = True
    ranked = sorted((-r, s - e, s, e, k) for (s, e, k), r in zip(every, rate) if k in thresholds and r >= thresholds[k])
    for _, _, s, e, k in ranked:
        if not covered[s:e].any():
            covered[s:e] = True
            out.append((s, e, k, False))
    return out, covered


def closed(data: np.ndarray, offsets: np.ndarray, spans: list, covered: np.ndarray) -> list:
    """``spans``, and what the base patterns find between them, again and again until that is nothing."""
    while spans:
        more = [(s, e, k, False) for s, e, k in base_spans(data, _between(offsets, spans)) if not covered[s:e].any()]
        if not more:
            break
        spans = spans + more
        for s, e, *_ in more:
            covered[s:e] = True
    return spans


def find(docs: DataFrame, model: tuple[Calibrated, dict[str, float]], keep: list[str], name: str = "spans") -> DataFrame:
    """Columns ``keep`` and the spans of every document as ``name``, by kind as in KINDS, then start."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(*dict.fromkeys([*keep, "text"]))
    types = {f.name: f.dataType.simpleString() for f in source.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, thresholds = sent.value
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            out: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for i, j in slices(offsets):
                part, edge = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                base, every, x, _ = _examined(part, edge)
                spans = closed(part, edge, *selected(base, every, trees.rate(x), thresholds, len(part)))
                if not spans:
                    continue
                points = np.zeros(len(part) + 1, np.int64)  # code points before each byte
                np.cumsum((part & 0xC0) != 0x80, out=points[1:])
                for s, e, kind, is_base in sorted(spans, key=lambda x: (KINDS.index(x[2]), x[0])):
                    r = int(np.searchsorted(edge, s, side="right")) - 1
                    out[i + r].append({"kind": kind, "s": int(points[s] - points[edge[r]]), "e": int(points[e] - points[edge[r]]), "base": is_base})
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(out, SPANS)], names=[*keep, name])
    return source.mapInArrow(run, ", ".join([*(f"`{c}` {types[c]}" for c in keep), f"`{name}` {SPANS_SQL}"]))


def redact(docs: DataFrame, model: tuple[Calibrated, dict[str, float]]) -> DataFrame:
    """Rows of ``docs`` with every span of ``text`` replaced, and ``n_chars`` counted anew."""
    name = unused("spans", docs.columns)
    found = find(docs, model, docs.columns, name).withColumn("text", redacted(F.col("text"), F.col(name)))
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def redacted(text, spans):
    """Column of ``text`` with every span replaced by its kind in angle brackets; of overlapping spans one tag stays."""
    empty = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))))
    between = lambda a, x: F.substring(text, (a["at"] + 1).cast("int"), F.greatest(x["s"] - a["at"], F.lit(0)).cast("int"))
    tag = lambda a, x: F.when(x["s"] >= a["at"], F.concat(F.lit("<"), F.upper(x["kind"]), F.lit(">"))).otherwise("")
    step = lambda a, x: F.struct(F.concat(a["out"], between(a, x), tag(a, x)).alias("out"), F.greatest(a["at"], x["e"]).alias("at"))
    end = lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(ordered, empty, step, end))
