"""Plain Python versions of the operators, and a small table with every awkward case."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(x: str | bytes) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def edge_rows() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars, rk, score): nulls, empty and long texts, ties, repeated rows."""
    rnd = random.Random(7)
    vocabulary = [f"{a}{b}{c}" for a in ("tho", "éa", "ver", "qui", "Bo", "ñe") for b in ("n", "rr", "ß", "ux") for c in ("a", "ing", "é", "lich", "os")]
    text = lambda n, sep=" ": sep.join(rnd.choice(vocabulary) for _ in range(n))
    passage, long_ = text(70), text(9000)
    base = text(120)
    near = base.split(" ")
    near[60] = "other"
    texts = [
        None, "", "   \n\t ", "a", "!!! 123 ...", "one two three", "ONE two THREE", text(300), base, base, " ".join(near),
        text(30) + " " + passage + " " + text(40), passage, text(10) + "\n" + passage + "\n" + text(10), text(15) + " é" + passage + "è" + text(5),
        "ab " * 700, "x" * 3000, "Shti " * 500, long_, text(20) + " " + " ".join(long_.split(" ")[200:900]),
        "line one here\nline one here\n\nline two\nline one here", "don't we'll <|endoftext|> <|startoftext|> ΑΣ İ 12 345",
        " nb sp　wide  sep \x1c ctl é \U0001F600\U0001F600 �", "日本語のテキストは空白がない" * 40,
        "mail a.b@c-d.org or x@y and +1 (555) 010-9999, 10.0.0.300 10.0.0.3 4111 1111 1111 1111 é 4111-1111-1111-1112",
        'token = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b" version 2.0 page 17', "idiot! You STUPID moron, y0u are tr4sh", "\n".join(["dup line of words"] * 40),
        passage[:150], "a b c d e", "A B C D E", "a b c d", "tail"]
    rows = [(i * 3, t, "en" if i % 2 else "fr", f"s{i % 4}" if i % 7 else None, None if t is None else len(t), 1, 0.5) for i, t in enumerate(texts)]
    rows += [rows[8], rows[8], rows[0], rows[3], (None, base, None, None, 1, 2, 0.1), (None, None, None, None, None, None, None), (1000, passage, "de", "s1", 1, 1, 0.2)]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rk long, score double"


def cut_bytes(rows, window=200):
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i:i + window] for b in raw for i in range(len(b) - window + 1))
    out = []
    for (doc, _), b in zip(rows, raw):
        mask = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if seen[b[i:i + window]] > 1:
                mask[i:i + window] = b"\1" * window
        out.append((doc, len(b), sum(mask), len(re.findall(b"\1+", bytes(mask))), sha(bytes(x for x, m in zip(b, mask) if not m))))
    return out


def cut_words(rows, window=20):
    key = lambda d: float("inf") if d is None else d
    words = [(key(d), WORD.findall(t or "")) for d, t in rows]
    first: dict[tuple, tuple] = {}
    for d, w in words:
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            first[k] = min(first.get(k, (d, i)), (d, i))
    out = []
    for (doc, _), (d, w) in zip(rows, words):
        mask = [0] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < (d, i):
                mask[i:i + window] = [1] * window
        out.append((doc, len(w), sum(mask), sha(" ".join(x for x, m in zip(w, mask) if not m))))
    return out


def measures(rows):
    out = []
    for doc, t in rows:
        t = t or ""
        w = WORD.findall(t)
        grams = Counter(zip(w, w[1:], w[2:]))
        mask = [0] * len(w)
        for i in range(len(w) - 2):
            if grams[tuple(w[i:i + 3])] > 1:
                mask[i:i + 3] = [1] * 3
        lines = [x for x in t.split("\n") if WORD.search(x)]
        out.append((doc, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), sum(mask),
                    len(w) < 50 or 100 * sum(mask) > 50 * len(w)))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def personal(text: str | None) -> list[list[tuple]]:
    t = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    return [
        [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)],
        [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))],
        [("card", m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))],
        [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits(m)) <= 15]]


def shingles(text: str | None) -> frozenset:
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components(rows):
    """(doc_id, size, least id of the component) by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                up[root(i)] = root(j)
    least: dict[int, int | None] = {}
    for i, (doc, _) in enumerate(rows):
        r = root(i)
        if doc is not None and (least.get(r) is None or doc < least[r]):
            least[r] = doc
    return [(doc, len(s), least.get(root(i))) for i, ((doc, _), s) in enumerate(zip(rows, sets))]


VECTORS = "vec_id long, embedding array<float>, label int, x string, tally double, place int"


def edge_vectors() -> list[tuple]:
    """Null, non-finite and equal vectors, ties between entries, repeated rows and ids, null ids and labels, clashing names."""
    rnd = random.Random(5)
    vector = lambda spread: [rnd.uniform(-spread, spread) for _ in range(16)]
    rows = [(i, vector(0.6), i % 4 if i % 5 else None) for i in range(30, 130)]
    rows += [(i, [float(rnd.randint(-1, 1)) for _ in range(16)], 9) for i in range(200, 260)]  # many ties
    rows += [(i, rows[0][1], 1) for i in range(3)] + [(5, rows[7][1], 2), (6, [0.0] * 16, 2), (7, [-0.0] * 16, 2)]
    rows += [rows[4]] * 3 + [(rows[4][0], vector(0.1), None), (None, vector(0.2), 0), (None, None, None), (4, None, 1)]
    rows += [(8, [float("nan")] + [0.0] * 15, 1), (9, [float("inf")] + [0.0] * 15, 1), (10, [float("-inf")] * 16, 1), (11, [None] + [0.5] * 15, 1)]
    rows += [(12, [2.0 ** -12 * k for k in range(16)], 3), (13, [-(2.0 ** -13)] * 16, 3), (300, vector(40.0), 3)]
    rnd.shuffle(rows)
    return [(*r, "x", 0.5, 1) for r in rows]


def vector_codes(rows, parts=8, entries=16, rounds=6):
    """(vec_id, code, error, label_error, codebooks_sha256) by comparing every part with every entry."""
    import math
    kept = [(i, [math.floor(4096 * v) for v in x], label) for i, x, label in rows if x is not None and all(v is not None and math.isfinite(v) for v in x)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    n = len(kept[0][1]) // parts if kept else 0
    cut = [[x[p * n:(p + 1) * n] for p in range(parts)] for _, x, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    near = lambda part, book: min((sum((a - b) ** 2 for a, b in zip(part, entry)), k) for k, entry in enumerate(book))
    for t in range(rounds + 1):
        found = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
        if t == rounds:
            break
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [c[p] for c, f in zip(cut, found) if f[p][1] == k]
                if mine:
                    books[p][k] = [sum(v) // len(mine) for v in zip(*mine)]
    digest = sha(",".join(str(v) for book in books for entry in book for v in entry))
    by_label = Counter()
    for (_, _, label), f in zip(kept, found):
        by_label[label] += sum(d for d, _ in f)
    return [(i, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), by_label[label], digest) for (i, _, label), f in zip(kept, found)]


def merkle(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of (doc_id, source, lang, n_chars, text); each tree built whole."""
    import zlib
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: sha("".join(map(part, r)))
    small = lambda t: None if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    groups: dict = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i:i + 8])) for i in range(0, len(levels[-1]), 8)])
        return levels

    def way(levels, at):
        out = []
        for nodes in levels[:-1]:
            run = at // 8 * 8
            out.append(("".join(nodes[run:at]), "".join(nodes[at + 1:run + 8])))
            at //= 8
        return out
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([leaf(r) for r in sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))]) for g in names}
    top = tree([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for at, r in enumerate(sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))):
            steps = way(trees[g], at) + way(top, k)
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            digest = leaf((*r[:4], small(r[4]))) if changed else leaf(r)
            for a, b in steps:
                digest = sha(a + digest + b)
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], sha("".join(a + b for a, b in steps)), digest, digest == top[-1][0]))
    return out
