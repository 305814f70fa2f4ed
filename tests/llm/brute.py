"""Plain single-machine versions of the operators, which the tests compare with."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = re.compile(r"[\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingle_set(text, k):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    if len(words) < k:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def jaccard_components(rows, k=4, percent=85):
    """(doc_id, set size, smallest id reachable) for rows (doc_id, text) with unique ids."""
    sets = {i: shingle_set(t, k) for i, t in rows}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, s in sets.items():
        shared = defaultdict(int)
        for x in s:
            for j in holders[x]:
                if j < i:
                    shared[j] += 1
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return sorted((i, len(s), root(i)) for i, s in sets.items())


ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.I | re.A,
)


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    for order, kind, pattern, least in (
        (1, "access", r"AKIA[A-Z0-9]+", 18),
        (2, "hex", r"[0-9a-f]+", 16),
    ):
        found += [
            (m.start(), order, m.end(), kind)
            for m in re.finditer(pattern, text)
            if len(m[0]) >= least
        ]
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found)]


def exact_groups(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[SPACE.sub(" ", t or "")].append(i)
    return sorted(
        (i, min(ids), len(ids), i == min(ids), hashlib.sha256(t.encode()).hexdigest())
        for t, ids in groups.items()
        for i in ids
    )


def edited(rows):
    """(doc_id, n_chars, edited_sha256) of rows (doc_id, text) with unique ids."""
    rows = sorted((i, t or "") for i, t in rows)
    out = []
    for at, (i, t) in enumerate(rows):
        half = len(t) // 2
        new = t[: len(t) - half] + rows[(at + 1) % len(rows)][1][:half]
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest()))
    return out


def word_count(text):
    return len(WORD.findall(text or ""))


ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def item_words(text):
    return ITEM_WORD.findall((text or "").translate(LOWER))


def contaminated(rows, items, window=10):
    """(doc_id, words, hit words, items as text, hit) per row (doc_id, text)."""
    grams = defaultdict(set)
    for item, text in items:
        words = item_words(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            grams[tuple(words[i : i + size])].add(item)
    sizes = {len(g) for g in grams}
    out = []
    for doc_id, text in rows:
        words, hit, found = item_words(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                owners = grams.get(tuple(words[i : i + size]))
                if owners is not None:
                    hit.update(range(i, i + size))
                    found |= owners
        names = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(words), len(hit), ",".join(names), bool(hit)))
    return out


LETTERS = re.compile("[A-Za-zÀ-ÿ]+")


def spelling(rows, ratio=2):
    """(word, n, n_near, form, form_n, root) by comparing all words with all words."""
    counts = defaultdict(int)
    for doc_id, text in rows:
        for run in LETTERS.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        if len(a) > len(b):
            a, b = b, a
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    forms, table = {}, {}
    for w, n in counts.items():
        others = [v for v in counts if near(w, v)]
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= ratio * n:
            forms[w] = best
        table[w] = (n, len(others))

    def root(w):
        return root(forms[w]) if w in forms else w

    return sorted(
        (w, n, m, forms.get(w), counts.get(forms.get(w)), root(w)) for w, (n, m) in table.items()
    )


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _climb(digests):
    """Levels of a tree, from the leaves to the root."""
    levels = [digests]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([_h(*last[i : i + 3]) for i in range(0, len(last), 3)])
    return levels


def _siblings(levels, place):
    out = []
    for level in levels[:-1]:
        first = place // 3 * 3
        out.append([(p, d) for p, d in enumerate(level[first : first + 3], first)])
        place //= 3
    return out


def merkle(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified), rows as (id, source, lang, n, text)."""

    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    sources = defaultdict(list)
    for row in rows:
        doc_id, source, lang, n, text = row
        even = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
        lost = text.replace("\n", "") if even and text is not None else text
        leaf = _h(*map(field, row))
        claimed = _h(*map(field, (doc_id, source, lang, n, lost)))
        sources[source].append((doc_id is not None, doc_id or 0, leaf, claimed))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = [_climb([x[2] for x in sorted(sources[s])]) for s in names]
    top = _climb([t[-1][0] for t in trees])
    out = []
    for number, name in enumerate(names):
        for place, (known, doc_id, leaf, claimed) in enumerate(sorted(sources[name])):
            proof, fold = [], claimed
            for levels, at in ((trees[number], place), (top, number)):
                for run in _siblings(levels, at):
                    proof += [d for p, d in run if p != at]
                    fold = _h(*(fold if p == at else d for p, d in run))
                    at //= 3
            root = top[-1][0]
            row = (leaf, trees[number][-1][0], root, _h(*proof), fold, fold == root)
            out.append((doc_id if known else None, *row))
    return out
