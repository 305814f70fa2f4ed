"""Secret scan: patterns plus a linear-chain conditional random field.

Three patterns find the base spans. A conditional random field then tags every token of a text as
secret begin, inside or outside (B, I, O) and adds what the patterns miss: random-looking strings
without a known key in front, values on the line after their key, secrets beside a base span.

A token is a run of the secret alphabet with a letter or digit in it. Its features are its shape
(length, digits, case, entropy, changes between kinds of letters), the words before and after it
(hashed) and whether a key word stands before it, the characters in between, and counts over the
whole file. Most tokens are plain words, whose best score as a secret, whatever stands around them,
is below their score outside; no best path takes them, so Viterbi decoding runs on the stretches
of other tokens between them and gives the path of the whole text.

The field is trained by penalised likelihood (forward-backward) on windows around tokens that the
base spans label. The corpus labels few kinds of secrets, so each labelled value is also taught
respelt in other alphabets, behind other key words and without any. Unlabelled tokens that look
like secrets are not taught as outside.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import narrowed, pieces, stored

KINDS = ("assign", "access", "hex")
# Only ASCII letters ignore case.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
_ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")
# Greedy runs: asking for the least length in the pattern equals dropping short matches.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

# Every repeat below is of single characters and followed by nothing, so scans are linear.
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]+")
_BARE = re.compile(r"[+/_.=-]*")
_KEY = r"(?:pass(?:word|wd|phrase)?|pwd|secret|token|key|bearer|auth[a-z]{0,12}|credentials?|private|signature)"
KEY_END = re.compile(f"{_KEY}$", re.IGNORECASE | re.ASCII)
INSIDE_KEY = re.compile(f"(?:[A-Za-z0-9]{{0,12}}_)?{_KEY}=", re.IGNORECASE | re.ASCII)
PUNCTUATION = re.compile(r"[+/_.=-]")
PLAIN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# A gap without these, and no quote or @ behind the token, is a plain place.
_SPECIAL = re.compile(r"[:=\"'@]")
_OTHER = re.compile(r"[^\x20\t\r\n.,;:=\"']")

O, B, I = 0, 1, 2
_WORDS = 64
_CACHED_TOKENS = 200_000
# The groups of features, with how many of each; a token has at most one of a group.
_SHAPE = {
    "bias": 1, "length": 7, "short": 3, "digits": 5, "case": 4, "hex": 3, "entropy": 6, "number": 2,
    "dots": 2, "slashes": 2, "any_digit": 2, "key_inside": 2, "punctuation": 2, "changes": 6,
}
_CONTEXT = {
    "key": 2, "assigned": 2, "line": 2, "quoted": 2, "other": 2, "mail": 2, "closed": 2,
    "base": 4, "tokens": 6, "size": 6, "before": _WORDS, "after": _WORDS,
}
_FIRST: dict[str, int] = {}
for _name, _n in (_SHAPE | _CONTEXT).items():
    _FIRST[_name] = sum((_SHAPE | _CONTEXT)[k] for k in _FIRST)
N_FEATURES = sum((_SHAPE | _CONTEXT).values())
# Words and files may tip the balance, but many of them occur in one window only.
_WEAK_GROUPS, _WEAK = ("base", "tokens", "size", "before", "after"), 0.3
# What tells a token that goes on from one that begins: the characters before it.
_GAP_GROUPS = ("bias", "line")

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """Pattern matches as (start, end, kind), leftmost and non-overlapping within a kind."""
    found = []
    # lower() maps ASCII letters as the pattern does; other letters only let more texts through
    lower = text.lower()
    if any(word in lower for word in _ASSIGN_WORDS):
        found = [
            (m.start(), m.end(), "assign")
            for m in ASSIGN.finditer(text)
            if m.end(2) - m.start(2) >= 12
        ]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _values(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """The base spans as places of secrets: of an assignment the value alone."""
    return [
        ASSIGN.match(text, s, e).span(2) if kind == "assign" else (s, e) for s, e, kind in base
    ]


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


# Tokens and features


def tokens(text: str) -> list[tuple[int, int]]:
    """(start, end) of every token: runs of the alphabet without dots at their ends."""
    found = []
    for m in _RUN.finditer(text):
        run, start = m.group(), m.start()
        if run[0] == "." or run[-1] == ".":
            start += len(run) - len(run.lstrip("."))
            run = run.strip(".")
        if run and not _BARE.fullmatch(run):
            found.append((start, start + len(run)))
    return found


def _entropy(token: str) -> float:
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values())


def _kind(c: str) -> str:
    return "0" if c.isdigit() else "a" if c.islower() else "A"


def _changes(token: str) -> float:
    """How often a lower-case letter, capital or digit stands beside one of another kind.

    A capital at the start of a word is no change, and words joined by signs have none.
    """
    turns = sum(
        _kind(a) != _kind(b) and not (a.isupper() and b.islower())
        for a, b in zip(token, token[1:])
        if a.isalnum() and b.isalnum()
    )
    return turns / len(token)


def _numbers(options: dict[str, int | None]) -> list[int]:
    return [_FIRST[name] + value for name, value in options.items() if value is not None]


def shape_features(token: str) -> list[int]:
    n = len(token)
    digits = sum(c.isdigit() for c in token)
    upper, lower = token.upper() != token, token.lower() != token
    low_hex = not token.strip("0123456789abcdef")
    high_hex = not token.strip("0123456789ABCDEF")
    return _numbers(
        {
            "bias": 0,
            "length": min(n // 8, 6),
            "short": 0 if n < 6 else 1 if n < 10 else 2,
            "digits": min(int(digits / n * 5), 4),
            "case": 2 * upper + lower,
            "hex": 1 if low_hex else 2 if high_hex else 0,
            "entropy": min(int(_entropy(token[:256])), 5),
            "number": int(digits == n),
            "dots": int("." in token),
            "slashes": int(token.count("/") > 1),
            "any_digit": int(digits > 0),
            "key_inside": int(bool(INSIDE_KEY.match(token))),
            "punctuation": int(bool(PUNCTUATION.search(token))),
            "changes": min(int(_changes(token[:256]) * 10), 5),
        }
    )


def _bucket(word: str) -> int:
    return zlib.crc32(word.lower().encode()) % _WORDS


def file_features(n_others: int, n_tokens: int, n_chars: int) -> list[int]:
    """Features of the whole file: its base spans besides the token's own, its tokens, its length."""
    return _numbers(
        {
            "base": min(n_others, 3),
            "tokens": min(int(math.log10(n_tokens + 1)), 5),
            "size": min(int(math.log10(n_chars + 1)), 5),
        }
    )


def context_features(text: str, places: list[tuple[int, int]], i: int) -> list[int]:
    """Features of what stands around token ``i``."""
    start, end = places[i]
    before = places[i - 1] if i else None
    gap_from = before[1] if before else 0
    # of a long gap both ends
    gap = text[gap_from:start] if start - gap_from <= 16 else text[gap_from : gap_from + 8] + text[start - 8 : start]
    after = text[end : end + 1]
    word = text[before[0] : before[1]] if before else ""
    return _numbers(
        {
            "key": int(bool(KEY_END.search(word[-24:]))),
            "assigned": int(":" in gap or "=" in gap),
            "line": int("\n" in gap),
            "quoted": int('"' in gap or "'" in gap),
            "other": int(bool(_OTHER.search(gap))),
            "mail": int(after == "@" or gap[-1:] == "@"),
            "closed": int(after in ("'", '"') and after != ""),
            "before": _bucket(word[-32:]) if before else None,
            "after": _bucket(text[slice(*places[i + 1])][:32]) if i + 1 < len(places) else None,
        }
    )


# The field


@dataclass(frozen=True)
class Field:
    """Weights: ``emit`` feature by state, ``move`` state by state, ``start`` by state."""

    emit: np.ndarray
    move: np.ndarray
    start: np.ndarray

    def scores(self, features: list[list[int]]) -> np.ndarray:
        return np.array([self.emit[f].sum(axis=0) for f in features])

    def viterbi(
        self, features: list[list[int]], *, after_outside: bool = False, before_outside: bool = False
    ) -> list[int]:
        """The best states; of a stretch between tokens outside, as the flags say."""
        scores = self.scores(features)
        best, back = (self.move[O] if after_outside else self.start) + scores[0], []
        for row in scores[1:]:
            step = best[:, None] + self.move
            back.append(step.argmax(axis=0))
            best = step.max(axis=0) + row
        if before_outside:
            best = best + self.move[:, O]
        state = int(best.argmax())
        path = [state]
        for pointers in reversed(back):
            state = int(pointers[state])
            path.append(state)
        return path[::-1]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _emission(weights: np.ndarray, goes_on: np.ndarray) -> np.ndarray:
    """Feature by state: nothing for O, a weight for B, and for I the same and what tells it apart."""
    own, more = weights[:, 0], weights[:, 1] * goes_on
    return np.stack([np.zeros_like(own), own, own + more], axis=1)


def train(runs: list[tuple[list[list[int]], list[int]]], steps: int = 200) -> Field | None:
    """Fit the field by gradient steps (Adam) on the penalised log-likelihood; None without data.

    Runs of equal length are stacked, so each step is a forward and a backward pass over arrays.
    Moving into I from O, and starting in I, is ruled out. B and I share their weights but for those
    of the characters in front, which tell a token that goes on from one that begins. Weights of
    neighbouring words and of files stay small.
    """
    if not any(s != O for _, states in runs for s in states):
        return None
    by_length: dict[int, list] = {}
    for features, states in runs:
        by_length.setdefault(len(states), []).append((features, states))
    stacks = []
    for length, group in sorted(by_length.items()):
        x = np.zeros((len(group), length, N_FEATURES))
        for i, (features, _) in enumerate(group):
            for t, active in enumerate(features):
                x[i, t, active] = 1
        stacks.append((x, np.array([s for _, s in group])))
    barred = np.zeros((3, 3))
    barred[O, I] = -30.0
    start_barred = np.array([0.0, 0.0, -30.0])
    weights = [np.zeros((N_FEATURES, 2)), np.zeros((3, 3)), np.zeros(3)]
    goes_on = np.zeros(N_FEATURES)
    for group in _GAP_GROUPS:
        goes_on[_FIRST[group] : _FIRST[group] + (_SHAPE | _CONTEXT)[group]] = 1
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    total = sum(len(y) for _, y in stacks)
    for step in range(1, steps + 1):
        grads = [0.05 * w / total for w in weights]
        emission = _emission(weights[0], goes_on)
        for x, y in stacks:
            n, length = y.shape
            emit = x @ emission
            move, start = weights[1] + barred, weights[2] + start_barred
            alpha = np.empty((n, length, 3))
            beta = np.zeros((n, length, 3))
            alpha[:, 0] = start + emit[:, 0]
            for t in range(1, length):
                alpha[:, t] = _log_sum(alpha[:, t - 1, :, None] + move, 1) + emit[:, t]
            for t in range(length - 2, -1, -1):
                beta[:, t] = _log_sum(move + (emit[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            z = _log_sum(alpha[:, -1], 1)
            expected = np.exp(alpha + beta - z[:, None, None]) - np.eye(3)[y]
            slope = np.einsum("ntf,nts->fs", x, expected) / total
            grads[0][:, 0] += slope[:, B] + slope[:, I]
            grads[0][:, 1] += slope[:, I] * goes_on
            grads[2] += expected[:, 0].sum(axis=0) / total
            for t in range(1, length):
                pair = np.exp(
                    alpha[:, t - 1, :, None]
                    + move
                    + (emit[:, t] + beta[:, t])[:, None, :]
                    - z[:, None, None]
                )
                pair -= np.eye(3)[y[:, t - 1]][:, :, None] * np.eye(3)[y[:, t]][:, None, :]
                grads[1] += pair.sum(axis=0) / total
        for w, g, m, v in zip(weights, grads, first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        for group in _WEAK_GROUPS:
            rows = weights[0][_FIRST[group] : _FIRST[group] + _CONTEXT[group]]
            np.clip(rows, -_WEAK, _WEAK, out=rows)
        np.clip(weights[0][:, 1], -1, 1, out=weights[0][:, 1])
    return Field(_emission(weights[0], goes_on), weights[1] + barred, weights[2] + start_barred)


# Training windows

WINDOW = "place bigint, secret boolean, text string, spans array<array<int>>, n_others int, n_tokens int, n_chars int"
_AROUND, _LONGEST, _PER_TEXT = 2, 400, 6


def _looks_secret(token: str) -> bool:
    """Whether an unlabelled token is so random that it may well be a secret."""
    return len(token) >= 12 and _entropy(token[:256]) >= 3 and _changes(token[:256]) >= 0.2


def _hash(*parts: object) -> int:
    key = repr(parts).encode()
    return int.from_bytes(hashlib.blake2b(key, digest_size=7).digest(), "little")


def training_windows(text: str) -> Iterator[tuple]:
    """(place, secret, text, spans, ...) of windows around some tokens of a text.

    All tokens in base spans, and of the others a few: some that are no plain words, by hash, the
    longest plain word and one more. A window reaches two tokens to either side; windows with very long tokens are left out.
    """
    base = _values(text, base_spans(text))
    places = tokens(text)
    if not places:
        return
    inside, odd, plain = [], [], []
    for i, (start, end) in enumerate(places):
        if base and any(s < end and start < e for s, e in base):
            inside.append(i)
            continue
        token = text[start:end]
        if PLAIN.fullmatch(token):
            plain.append(i)
        elif not _looks_secret(token):
            odd.append(i)
    by_hash = {i: _hash(text[slice(*places[i])][:64], i) for i in odd}
    chosen = sorted(odd, key=by_hash.__getitem__)[:_PER_TEXT]
    if plain:
        longest = max(plain, key=lambda i: places[i][1] - places[i][0])
        chosen += [longest, plain[len(text) // 7 % len(plain)]]
    for i in [*inside, *chosen]:
        low, high = max(0, i - _AROUND), min(len(places), i + _AROUND + 1)
        begin, stop = places[low][0], places[high - 1][1]
        if stop - begin > _LONGEST:
            continue
        own = [
            (max(s, begin) - begin, min(e, stop) - begin)
            for s, e in base
            if s < stop and begin < e
        ]
        around = [text[slice(*places[j])] for j in range(low, high) if j not in inside]
        if any(map(_looks_secret, around)):
            continue
        # up to the quote or bracket behind
        snippet = text[begin : stop + 1]
        yield (
            _hash(snippet, own), bool(own), snippet, own,
            len(base) - len(own), len(places), len(text),
        )


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    spans = pa.list_(pa.list_(pa.int32()))
    types = (pa.int64(), pa.bool_(), pa.string(), spans, pa.int32(), pa.int32(), pa.int32())
    names = ["place", "secret", "text", "spans", "n_others", "n_tokens", "n_chars"]
    for batch in pieces(batches):
        rows = [row for t in batch.column("text").to_pylist() for row in training_windows(t)]
        columns = zip(*rows) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def labelled(
    text: str, spans: list, n_others: int = 0, n_tokens: int = 100, n_chars: int = 1000
) -> tuple[list[list[int]], list[int]]:
    """(features, states) of a window. A token is inside if it goes on in a span of the one before."""
    places = tokens(text)
    features, states, last = [], [], set()
    shared = file_features(n_others, n_tokens, n_chars)
    for i, (start, end) in enumerate(places):
        own = {tuple(s) for s in spans if s[0] < end and start < s[1]}
        features.append(shape_features(text[start:end]) + context_features(text, places, i) + shared)
        states.append(O if not own else I if own & last else B)
        last = own
    return features, states


# How secrets of common services and tools are written.
_HEX, _DIGITS, _LOWER = "0123456789abcdef", "0123456789", "abcdefghijklmnopqrstuvwxyz"
_ALPHABETS = (
    (_HEX, 32), (_HEX, 40), (_HEX.upper(), 32), (_HEX.upper(), 40), (_LOWER + _DIGITS, 24),
    (_LOWER + _LOWER.upper() + _DIGITS, 16), (_LOWER + _LOWER.upper() + _DIGITS, 32),
    (_LOWER + _LOWER.upper() + _DIGITS, 40), (_LOWER + _LOWER.upper() + _DIGITS + "+/", 40),
    (_LOWER + _LOWER.upper(), 14), (_LOWER + _LOWER.upper(), 24), (_LOWER.upper() + _DIGITS, 20),
)
_KEYS = (
    "password: ", "pwd: ", "pwd=", "passphrase = ", "secret:\n", "token:\n  ", "bearer ", "credentials ",
    "private_key = ", "access_key = '", "api_key: \"", "auth_token=", "credentials: ", "signature ",
)
_PREFIXES = ("ghp_", "sk_live_", "xoxb-", "glpat-", "")


def respelt(text: str, spans: list, seed: int) -> list[tuple[str, list]]:
    """The window with its secret written in other ways, each with the span of the new value."""
    r = random.Random(seed)
    start, end = min(s[0] for s in spans), max(s[1] for s in spans)
    before, after = text[:start], text[end:]
    out = []

    def value() -> str:
        letters, n = r.choice(_ALPHABETS)
        return r.choice(_PREFIXES) * (r.random() < 0.3) + "".join(r.choices(letters, k=n))

    def add(parts: list[tuple[str, bool]]) -> None:
        line, marks = before, []
        for part, secret in parts:
            if secret:
                marks.append((len(line), len(line) + len(part)))
            line += part
        out.append((line + after, marks))

    # plain in the text, behind a key word, words as a password, two secrets side by side
    add([(value(), True)])
    add([(r.choice(_KEYS), False), (value(), True)])
    words = "-".join("".join(r.choices(_LOWER, k=r.randint(3, 8))) for _ in range(r.randint(2, 4)))
    add([(r.choice([k for k in _KEYS if k[-1] in " =\n\"'"]), False), (words, True)])
    add([(value(), True), (r.choice((" ", ",", ", ")), False), (value(), True)])
    # a value that goes on in the next line
    add([(r.choice(_KEYS), False), (f"{value()}\n{value()}", True)])
    return out


def fit(
    docs: DataFrame, text: str = "text", max_runs: int = 2000, max_texts: int = 20_000
) -> Field | None:
    """Train on at most ``max_runs`` distinct windows with and four times as many without a base span.

    Windows come from about ``max_texts`` texts (all, if there are fewer). Texts and windows are
    chosen by their hash, so the same documents give the same field. A window with a base span is taught as it stands and respelt (``respelt``). Null and blank
    texts have no windows, and repeated rows give the same ones. None without a base span.
    """
    texts = narrowed(docs, text=text).filter("text is not null")
    share = max(1, 1_000_000 * max_texts // max(texts.count(), 1))
    texts = texts.filter(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < share)
    columns = ("secret", "text", "spans", "n_others", "n_tokens", "n_chars")
    windows = stored(
        texts.mapInArrow(_training_rows, WINDOW)
        .groupBy("place")
        .agg(*(F.first(c).alias(c) for c in columns)),
        "training_windows",
    )
    runs = []
    for secret, most in ((True, max_runs), (False, 4 * max_runs)):
        sample = windows.filter(F.col("secret") == secret).orderBy("place").limit(most)
        for w in sample.collect():
            counts = (w.n_others, w.n_tokens, w.n_chars)
            spans = [list(x) for x in w.spans]
            runs.append(labelled(w.text, spans, *counts))
            if secret:
                runs += [labelled(t, x, *counts) for t, x in respelt(w.text, spans, w.place)]
    return train(runs)


# Scan


class Tagger:
    """Decodes whole texts with a field.

    For a token that is seen the first time it works out how much better than outside it could ever
    score as a secret: with and without a key word before it, between plain words and elsewhere.
    Where that is below zero no best path takes the token, and the chain falls apart there.
    """

    def __init__(self, field: Field):
        self.field = field
        self.known: dict[str, tuple[tuple[bool, ...] | None, bool]] = {}
        self.gaps: dict[str, bool] = {}
        self.plain: dict[tuple[int, bool, bool, bool], tuple[bool, ...]] = {}
        over = field.emit[:, [B, I]] - field.emit[:, [O]]

        def best(values: np.ndarray, name: str, only: int | None = None) -> np.ndarray:
            rows = values[_FIRST[name] : _FIRST[name] + (_SHAPE | _CONTEXT)[name]]
            # a group may be absent
            return rows[only] if only is not None else np.maximum(rows.max(axis=0), 0)

        at_words = ("assigned", "quoted", "mail", "closed")
        rest = sum(best(over, n) for n in _CONTEXT if n != "key" and n not in at_words)
        plain_place = rest + sum(best(over, n, only=0) for n in at_words)
        any_place = rest + sum(best(over, n) for n in at_words)
        # a token outside makes the one after it begin where it went on
        on = field.emit[:, [I]] - field.emit[:, [B]]
        switch = float(sum(best(on, name) for name in _SHAPE | _CONTEXT)[0])
        move, start = field.move, field.start
        switch += max(0.0, float((move[I] - move[B]).max()))
        turn = np.full(2, -np.inf)
        for j, s in enumerate((B, I)):
            for first, instead in [(start[s], start[O]), *((move[a, s], move[a, O]) for a in (O, B, I))]:
                ends = [0.0, move[s, O] - move[O, O], move[s, B] - move[O, B]]
                ends.append(move[s, I] - move[O, B] + switch)
                turn[j] = max(turn[j], first - instead + max(ends))
        self.over, self.turn = over, turn
        self.most = [
            place + best(over, "key", only=key) + turn
            for key in (0, 1)
            for place in (plain_place, any_place)
        ]

    def _verdict(self, token: str) -> tuple[tuple[bool, ...] | None, bool]:
        """(whether it may be a secret, by 2 * key word before it + special place; is a key word).

        None instead of four times no.
        """
        if len(self.known) >= _CACHED_TOKENS:
            self.known.clear()
        may = self._of_plain(token) if PLAIN.fullmatch(token) else None
        if may is None or may[0]:
            may = self._may(self.over[shape_features(token)].sum(axis=0))
        found = (may if any(may) else None, bool(KEY_END.search(token[-24:])))
        self.known[token] = found
        return found

    def _may(self, own: np.ndarray) -> tuple[bool, ...]:
        return tuple(bool((own + most).max() >= 0) for most in self.most)

    def _of_plain(self, word: str) -> tuple[bool, ...]:
        """The same for all plain words of this length and case, whatever their letters.

        Worked out once, as if their entropy were the one that suits secrets best.
        """
        low_hex = not word.strip("abcdef")
        high_hex = not word.strip("ABCDEF")
        kind = (min(len(word), 64), word.islower(), word.isupper(), low_hex or high_hex)
        if kind not in self.plain:
            features = [f for f in shape_features(word) if not 0 <= f - _FIRST["entropy"] < 6]
            entropy = self.over[_FIRST["entropy"] : _FIRST["entropy"] + 6].max(axis=0)
            self.plain[kind] = self._may(self.over[features].sum(axis=0) + entropy)
        return self.plain[kind]

    def _special(self, gap: str, after: str) -> bool:
        if len(gap) > 16:
            gap = gap[:8] + gap[-8:]
        found = self.gaps.get(gap)
        if found is None:
            if len(self.gaps) >= _CACHED_TOKENS:
                self.gaps.clear()
            found = self.gaps[gap] = bool(_SPECIAL.search(gap))
        return found or after in ("'", '"', "@")

    def possible(
        self, text: str, places: list[tuple[int, int]], base: list[Span]
    ) -> dict[int, list[int]]:
        """The tokens that a best path may take, with their features.

        Those that may be secrets somewhere are looked at with what really stands around them.
        """
        out, after_key, last, known = {}, 0, 0, self.known
        for i, (start, end) in enumerate(places):
            token = text[start:end]
            may, is_key = known.get(token) or self._verdict(token)
            if may and may[2 * after_key + self._special(text[last:start], text[end : end + 1])]:
                features = self.features(text, places, i, base)
                if (self.over[features].sum(axis=0) + self.turn).max() >= 0:
                    out[i] = features
            after_key, last = int(is_key), end
        return out

    def nothing_possible(self, text: str) -> bool:
        """Quick look at the distinct runs of a text that has plain places only and no key word."""
        if _SPECIAL.search(text):
            return False
        for run in set(_RUN.findall(text)):
            token = run.strip(".") if run[-1] == "." or run[0] == "." else run
            if token and not _BARE.fullmatch(token):
                may, is_key = self.known.get(token) or self._verdict(token)
                if is_key or (may and may[0]):
                    return False
        return True

    def states(self, text: str, base: list[Span]) -> list[tuple[int, int, int, int]]:
        """(number, start, end, state) of the tokens that are not outside."""
        if self.nothing_possible(text):
            return []
        places = tokens(text)
        found = self.possible(text, places, base)
        chosen, out, at = list(found), [], 0
        while at < len(chosen):
            stop = at + 1
            while stop < len(chosen) and chosen[stop] == chosen[stop - 1] + 1:
                stop += 1
            stretch = chosen[at:stop]
            states = self.field.viterbi(
                [found[i] for i in stretch],
                after_outside=stretch[0] > 0,
                before_outside=stretch[-1] < len(places) - 1,
            )
            out += [(i, *places[i], s) for i, s in zip(stretch, states) if s != O]
            at = stop
        return out

    def features(
        self, text: str, places: list[tuple[int, int]], i: int, base: list[Span]
    ) -> list[int]:
        start, end = places[i]
        others = sum(not (s < end and start < e) for s, e, _ in base)
        return (
            shape_features(text[start:end])
            + context_features(text, places, i)
            + file_features(others, len(places), len(text))
        )


def _uncovered(text: str, start: int, end: int, base: list[Span]) -> list[tuple[int, int]]:
    """What base spans leave of a token: all of it, or the parts that are tokens themselves."""
    meeting = [(s, e) for s, e, _ in base if s < end and start < e]
    if not meeting:
        return [(start, end)]
    left, at = [], start
    for s, e in [*meeting, (end, end)]:
        if at < s:
            left += [
                (at + b, at + e)
                for b, e in tokens(text[at:s])
                if not PLAIN.fullmatch(text, at + b, at + e)
            ]
        at = max(at, e)
    return left


def crf_spans(text: str, field: Field | Tagger | None, base: list[Span]) -> list[Span]:
    """Spans the field adds: a B token with the I tokens after it, less what base spans hold.

    Tokens that meet a base span cut such a span; those before and after it stay.
    """
    if field is None:
        return []
    tagger = field if isinstance(field, Tagger) else Tagger(field)
    added: list[Span] = []
    joins = -2  # the token that the next one may go on from
    for i, start, end, state in tagger.states(text, base):
        left = _uncovered(text, start, end, base)
        whole = left == [(start, end)]
        if joins == i - 1 and state == I and whole:
            added[-1] = (added[-1][0], end, "crf")
        else:
            added += [(s, e, "crf") for s, e in left]
        joins = i if whole else -2
    return added


SPAN = "struct<start:int,end:int,kind:string,value:string>"


def scan(
    docs: DataFrame, field: Field | None, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Rows (doc_id, spans): each span with its place in code points, kind and secret text.

    A null or empty text has no spans. Rows with equal ids stay separate rows; ids may be null.
    Long texts are scanned whole. Other columns of ``docs`` are ignored.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [("start", pa.int32()), ("end", pa.int32())]
        fields += [("kind", pa.string()), ("value", pa.string())]
        span_type = pa.list_(pa.struct(fields))
        tagger = None if field is None else Tagger(field)
        for batch in pieces(batches):
            spans = []
            for text_value in batch.column("text").to_pylist():
                if not text_value:
                    spans.append([])
                    continue
                base = base_spans(text_value)
                found = sorted(
                    base + crf_spans(text_value, tagger, base),
                    key=lambda s: (s[0], (*KINDS, "crf").index(s[2])),
                )
                spans.append(
                    [
                        {"start": s, "end": e, "kind": k, "value": text_value[s:e]}
                        for s, e, k in found
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(spans, span_type)], ["doc_id", "spans"]
            )

    return narrowed(docs, doc_id=id_column, text=text).mapInArrow(
        run, f"doc_id {kind}, spans array<{SPAN}>"
    )


def digests(scanned: DataFrame) -> DataFrame:
    """Counts per kind, all spans as one text, and the hash of the base spans."""

    def joined(spans):
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(parts, ",")

    base = F.filter("spans", lambda s: s["kind"] != "crf")
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [
        (F.size("spans") - F.size(F.array_remove(kinds, kind))).cast("bigint").alias(f"n_{kind}")
        for kind in (*KINDS, "crf")
    ]
    return scanned.select(
        "doc_id",
        *counts,
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
