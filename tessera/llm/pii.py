"""Personal data: exact patterns, and a linear-chain conditional random field.

The patterns find e-mail addresses, IP addresses, payment cards and phone
numbers.  The random field adds what they can't see: phone numbers without a
country prefix, e-mail addresses spelt with "[at]", identity numbers, and
credentials (keys, passwords, access tokens).  It reads white-space-separated
words by their shape and those of their neighbours, is trained here by maximum
likelihood on the small labelled table that ``labelled_table`` derives from a
rule, and is decoded by Viterbi in numpy, many stretches at a time.

A constraint of the model makes whole texts cheap: a plain word between plain
words is outside any span, in training and decoding alike.  Decoding thus
falls apart, exactly, into the stretches around words that are not plain.

An added span that overlaps a pattern's span is left out; pattern spans always
stay.  Null or empty text has no spans.  Repeated rows give repeated results;
an empty table gives no rows; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import random
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import documents, map_rows, text_of
from tessera.llm.registry import register

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret", "identity")
#: Kinds that the random field tags.
TAGGED = ("email", "phone", "secret", "identity")
TAGS = ("O", *(f"{x}-{k}" for k in TAGGED for x in "BI"))

_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the patterns' matches: leftmost, not overlapping
    within a kind; a match that fails its test is dropped, not retried."""
    out = []
    if "@" in text:
        end = 0
        for m in _AT.finditer(text):
            start = m.start()
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                end = m.end()
                out.append((start, end, "email"))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := _DIGITS.sub("", m[0])) <= 19 and _luhn(d):
            out.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGITS.sub("", m[0])) <= 15:
                out.append((m.start(), m.end(), "phone"))
    return out


# ---- words and their features

_TRIGGER = re.compile(r"[0-9@=]|[\[(](?:at|dot)[\])]|__")
_WORD = re.compile(r"\S+")
_EDGE = ".,;:!?\"'()[]{}<>"
_AROUND = ".,;:!?\"'[]{}<> \t\n"
#: A key, its sign and a value in quotes, of which the closing one ends the span.
_QUOTED = re.compile(r"""\w+\s*[=:]\s*(["'])(?:(?!\1).)+(?=\1)""", re.S)
#: Words whose identity is a feature; every other plain word looks alike.
CUES = ("password", "passwd", "pwd", "secret", "token", "key", "api_key", "phone", "tel", "call", "mobile", "fax",
        "ssn", "passport", "id", "identity", "version", "page", "section", "year", "in", "at", "dot", "=", ":", "is")


def is_plain(word: str) -> bool:
    return not _TRIGGER.search(word)


def _shape(word: str) -> str:
    s = re.sub(r"[A-Z]", "A", re.sub(r"[^\W\dA-Z_]", "a", re.sub(r"[0-9]", "9", word)))
    return re.sub(r"(.)\1+", r"\1+", s)


def features(word: str) -> list[str]:
    """Features of one word: its class, shape, lengths and, if a cue, itself."""
    bare = word.strip(_EDGE)
    low, found = bare.lower(), []
    if (low or word) in CUES:
        found.append(f"cue {low or word}")
    if is_plain(word):
        return [*found, "plain"]
    digits = sum(c.isdigit() for c in bare)
    letters = sum(c.isalpha() for c in bare)
    found += [f"shape {_shape(bare)[:12]}", f"digits {min(digits, 16)}", f"letters {min(letters, 8)}", f"long {min(len(bare) // 4, 6)}"]
    if letters and digits and bare.isalnum():
        found.append("hex" if re.fullmatch(r"[0-9a-f]+", bare) else "upper mix" if bare.isupper() else "mix")
        if len(bare) >= 16:
            found.append("long mix")
    if re.fullmatch(r"[0-9]{3}-[0-9]{2}-[0-9]{4}", bare):
        found.append("3-2-4")
    if re.fullmatch(r"[0-9]{3}[-.][0-9]{3}[-.][0-9]{4}", bare):
        found.append("3-3-4")
    if re.fullmatch(r"\(?[0-9]{3,4}\)?", word):
        found.append("group")
    if "=" in bare and (key := bare.split("=")[0].strip(_EDGE).lower()):
        found.append(f"assigns {key if key in CUES else 'other'}")
    if bare in ("at", "dot") and word != bare:
        found.append("spelt")
    return found


# ---- the labelled table

def labelled_table(seed: int = 11, copies: int = 6) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """(text, spans): sentences of invented words around values made by rule."""
    rng = random.Random(seed)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    of = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    word = lambda: of("aeinorstldé", rng.randint(2, 9)) + rng.choice(["", "", "", ",", "."])
    name = lambda: of("abcdefgiklmnoprst", rng.randint(3, 7))
    upper, hexa = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789abcdef"
    values = [
        ("phone", lambda: f"({digits(3)}) {digits(3)}-{digits(4)}"), ("phone", lambda: f"{digits(3)}-{digits(3)}-{digits(4)}"),
        ("phone", lambda: f"{digits(3)}.{digits(3)}.{digits(4)}"), ("phone", lambda: f"{digits(3)} {digits(3)} {digits(4)}"),
        ("email", lambda: f"{name()} [at] {name()} [dot] {rng.choice(['com', 'org', 'net'])}"),
        ("email", lambda: f"{name()}{digits(2)} (at) {name()} (dot) {rng.choice(['com', 'org', 'net'])}"),
        ("identity", lambda: f"{digits(3)}-{digits(2)}-{digits(4)}"),
        ("secret", lambda: f"AKIA{of(upper, 16)}"), ("secret", lambda: f"password={of(hexa, rng.randint(8, 20))}"),
        ("secret", lambda: f"{rng.choice(['pwd', 'passwd', 'secret', 'token', 'api_key'])}={of(hexa + 'xyzXYZ', rng.randint(8, 30))}"),
        ("secret", lambda: f"token = \"{of(hexa, rng.choice([32, 40]))}\""),
        ("", lambda: f"version {digits(1)}.{digits(1)}."), ("", lambda: f"{rng.choice('12')}{digits(3)}"),
        ("", lambda: digits(rng.randint(1, 3))), ("", lambda: f"{digits(1)}.{digits(1)}.{digits(1)}"),
        ("", lambda: f"page {digits(2)}"), ("", lambda: f"{digits(2)}/{digits(2)}/{digits(4)}"), ("", lambda: f"{digits(2)}:{digits(2)}"),
        ("", lambda: f"{digits(4)}-{digits(2)}-{digits(2)}"), ("", lambda: f"{name()}={digits(2)}"), ("", lambda: f"{name()} = {digits(2)}"),
        ("", lambda: f"{digits(1)},{digits(3)}"), ("", lambda: f"{name()}.{digits(2)}@mail{digits(1)}.{name()}.com"),
        ("", lambda: f"{digits(2)}.{digits(3)}.{digits(2)}.{digits(2)}"), ("", lambda: f"+{digits(1)} ({digits(3)}) {digits(3)}-{digits(4)}"),
        ("", lambda: f"+{digits(2)} {digits(3)} {digits(3)} {digits(4)}"), ("", lambda: digits(16)), ("", lambda: " ".join(digits(4) for _ in range(4))),
        ("", lambda: f"{of('ABCD', 2)}{digits(2)}"), ("", lambda: f"{digits(4)} {digits(4)}"), ("", lambda: f"{digits(3)} {digits(3)}"),
        ("", lambda: f"the token {word()}"), ("", lambda: f"{name()}{digits(3)}"), ("", lambda: f"x = {digits(1)}"),
    ]
    table = []
    for kind, value in values * copies:
        before = " ".join(word() for _ in range(rng.randint(0, 4)))
        before += rng.choice(["", "", " phone", " tel:"]) if kind == "phone" else ""
        before = before.strip() + " " if before.strip() else ""
        v = value()
        after = " " + " ".join(word() for _ in range(rng.randint(0, 4))) if rng.random() < 0.85 else "."
        table.append((before + v + after, [(len(before), len(before) + len(v), kind)] if kind else []))
    return table


# ---- the random field

class Field:
    """Weights by feature and tag, for a word itself, its predecessor and its
    successor; transitions between tags."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, moves: np.ndarray):
        self.index, self.weights, self.moves = index, weights, moves
        self.row = lru_cache(100_000)(self._row)

    def _row(self, word: str) -> np.ndarray:
        """Scores (as the word itself, as predecessor, as successor) by tag."""
        out = np.zeros((3, len(TAGS)))
        for f in features(word):
            for k in range(3):
                j = self.index.get(f"{k} {f}")
                if j is not None:
                    out[k] += self.weights[j]
        return out

    def emissions(self, words: list[str]) -> np.ndarray:
        rows = np.array([self.row(w) for w in words])
        out = rows[:, 0].copy()
        out[1:] += rows[:-1, 1]
        out[:-1] += rows[1:, 2]
        return out + _forbidden(words)

    def __getstate__(self):
        return self.index, self.weights, self.moves

    def __setstate__(self, state):
        self.__init__(*state)


def _forbidden(words: list[str]) -> np.ndarray:
    """-inf (as a large number) for tags that the constraint rules out: a
    plain word between plain words is outside."""
    plain = np.array([True, *map(is_plain, words), True])
    out = np.zeros((len(words), len(TAGS)))
    out[plain[:-2] & plain[1:-1] & plain[2:], 1:] = -1e4
    return out


def _legal() -> np.ndarray:
    """Moves allowed from a tag (or, last row, the start) to a tag."""
    ok = np.ones((len(TAGS) + 1, len(TAGS)))
    for j, t in enumerate(TAGS):
        if t[0] == "I":
            ok[:, j] = [x[1:] == t[1:] and x != "O" for x in (*TAGS, "O")]
    return np.where(ok > 0, 0.0, -1e4)


def _tagged(text: str, spans: list[tuple[int, int, str]]) -> tuple[list[str], list[int]]:
    words, tags = [], []
    for m in _WORD.finditer(text):
        inside = next((s for s in spans if s[0] < m.end() and m.start() < s[1]), None)
        words.append(m[0])
        tags.append(TAGS.index(("B-" if m.start() <= inside[0] else "I-") + inside[2]) if inside else 0)
    return words, tags


def train(table: list[tuple[str, list[tuple[int, int, str]]]], steps: int = 100, l2: float = 1e-3) -> Field:
    """Maximum likelihood by Adam; forward and backward sums run over all
    sequences of the (small) table at once."""
    seqs = [_tagged(*row) for row in table]
    index: dict[str, int] = {}
    active = []
    for words, _ in seqs:
        own = [features(w) for w in words]
        active.append([[index.setdefault(f"{k} {f}", len(index)) for k, at in ((0, i), (1, i - 1), (2, i + 1))
                        if 0 <= at < len(own) for f in own[at]] for i in range(len(own))])
    n, longest, t = len(seqs), max(len(w) for w, _ in seqs), len(TAGS)
    x = np.zeros((n, longest, len(index)))
    live, gold, barred = np.zeros((n, longest)), np.zeros((n, longest, t)), np.zeros((n, longest, t))
    for s, (words, tags) in enumerate(seqs):
        for i, fs in enumerate(active[s]):
            x[s, i, fs] += 1
            live[s, i], gold[s, i, tags[i]] = 1, 1
        barred[s, :len(words)] = _forbidden(words)
    flat = x.reshape(n * longest, -1)
    legal = _legal()
    params = [np.zeros((len(index), t)), np.zeros((t + 1, t))]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    lse = lambda a, axis: (m := a.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - m).sum(axis=axis))
    pairs = np.zeros((t + 1, t))
    for words_tags in seqs:
        for a, b in zip([t, *words_tags[1]], words_tags[1]):
            pairs[a, b] += 1
    for step in range(1, steps + 1):
        move = params[1] + legal
        e = (flat @ params[0]).reshape(n, longest, t) + barred
        fwd, back = np.zeros_like(e), np.zeros_like(e)
        fwd[:, 0] = move[t] + e[:, 0]
        for i in range(1, longest):
            new = lse(fwd[:, i - 1, :, None] + move[None, :t], 1) + e[:, i]
            fwd[:, i] = np.where(live[:, i, None] > 0, new, fwd[:, i - 1])
        total = lse(fwd[:, -1], 1)
        for i in range(longest - 2, -1, -1):
            new = lse(move[None, :t] + (e[:, i + 1] + back[:, i + 1])[:, None, :], 2)
            back[:, i] = np.where(live[:, i + 1, None] > 0, new, 0)
        prob = np.exp(fwd + back - total[:, None, None]) * live[..., None]
        expected = np.zeros_like(pairs)
        expected[t] = prob[:, 0].sum(axis=0)
        for i in range(1, longest):
            p = np.exp(fwd[:, i - 1, :, None] + move[None, :t] + (e[:, i] + back[:, i])[:, None, :] - total[:, None, None])
            expected[:t] += (p * live[:, i, None, None]).sum(axis=0)
        grads = [flat.T @ (gold - prob).reshape(n * longest, t) / n - l2 * params[0], (pairs - expected) / n - l2 * params[1]]
        for k, g in enumerate(grads):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            params[k] += 0.1 * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
    return Field(index, params[0], params[1] + legal)


def viterbi(emissions: list[np.ndarray], moves: np.ndarray, cells: int = 200_000) -> list[np.ndarray]:
    """The best tags of each sequence; sequences of similar length run together."""
    order = sorted(range(len(emissions)), key=lambda s: len(emissions[s]))
    out: list[np.ndarray] = [np.zeros(0, int)] * len(emissions)
    at, t = 0, len(TAGS)
    while at < len(order):
        stop = at + 1
        while stop < len(order) and (stop + 1 - at) * len(emissions[order[stop]]) <= cells:
            stop += 1
        group = order[at:stop]
        longest = len(emissions[group[-1]])
        e = np.zeros((len(group), longest, t))
        size = np.array([len(emissions[s]) for s in group])
        for k, s in enumerate(group):
            e[k, :size[k]] = emissions[s]
        came = np.zeros((len(group), longest, t), np.int8)
        best = moves[t] + e[:, 0]
        for i in range(1, longest):
            scores = best[:, :, None] + moves[None, :t]
            came[:, i] = scores.argmax(axis=1)
            best = np.where((i < size)[:, None], scores.max(axis=1) + e[:, i], best)
        tag, rows = best.argmax(axis=1), np.arange(len(group))
        tags = np.zeros((len(group), longest), int)
        for i in range(longest - 1, -1, -1):
            tags[:, i] = tag
            tag = np.where(i < size, came[rows, i, tag] if i else tag, tag)
        for k, s in enumerate(group):
            out[s] = tags[k, :size[k]]
        at = stop
    return out


def _stretches(text: str) -> list[list[tuple[int, int]]]:
    """Runs of words (start, end) that the constraint leaves open, with a plain
    word between plain words, outside by constraint, at either end where there is one."""
    runs: list[list[tuple[int, int]]] = []
    seen = 0  # end of the last word with a trigger
    for m in _TRIGGER.finditer(text):
        if m.start() < seen:
            continue
        start = m.start()
        while start and not text[start - 1].isspace():
            start -= 1
        left = []
        at = start
        for _ in range(2):  # two words before
            while at and text[at - 1].isspace():
                at -= 1
            if not at:
                break
            end = at
            while at and not text[at - 1].isspace():
                at -= 1
            left.append((at, end))
        right = [w.span() for _, w in zip(range(3), _WORD.finditer(text, start))]
        seen = right[0][1]
        words = [*left[::-1], *right]
        if runs and words[0][0] < runs[-1][-1][1]:
            last = runs[-1][-1][1]
            runs[-1] += [w for w in words if w[0] >= last]
        else:
            runs.append(words)
    return runs


def _ends(text: str, a: int, b: int) -> tuple[int, int]:
    """Where a value in the words ``text[a:b]`` starts and ends: at the closing
    quote if it has an opening one, without punctuation or brackets that only
    surround it."""
    if quoted := _QUOTED.match(text, a, b):
        b = quoted.end()
    close, opened = text.find(")", a, b), text.rfind("(", a, b)  # the first and the last
    while a < b:
        if text[a] in _AROUND or text[a] == "(" and (close < 0 or close >= b - 1):
            a += 1
        elif text[b - 1] in _AROUND or text[b - 1] == ")" and opened < a:
            b -= 1
        else:
            break
    return a, b


def added_spans(texts: list[str], field: Field) -> list[list[tuple[int, int, str]]]:
    """The random field's spans in each text."""
    owner, runs = [], []
    for k, text in enumerate(texts):
        for run in _stretches(text):
            owner.append(k)
            runs.append(run)
    tags = viterbi([field.emissions([texts[k][a:b] for a, b in run]) for k, run in zip(owner, runs)], field.moves)
    out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    for k, run, ts in zip(owner, runs, tags):
        i = 0
        while i < len(run):
            if TAGS[ts[i]][0] == "B":
                j = i + 1
                while j < len(run) and TAGS[ts[j]] == "I" + TAGS[ts[i]][1:]:
                    j += 1
                a, b = _ends(texts[k], run[i][0], run[j - 1][1])
                if a < b:
                    out[k].append((a, b, TAGS[ts[i]][2:]))
                i = j
            else:
                i += 1
    return out


def find_spans(text: str, field: Field) -> list[tuple[int, int, str, bool]]:
    """(start, end, kind, is a pattern's) by start, then kind as listed."""
    base = base_spans(text)
    more = [s for s in added_spans([text], field)[0] if not any(a < s[1] and s[0] < b for a, b, _ in base)]
    return sorted([*((*s, True) for s in base), *((*s, False) for s in more)], key=lambda s: (s[0], KINDS.index(s[2])))


def detect(docs: DataFrame, field: Field | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans: array of (kind, start, stop, base) in code points, end exclusive."""
    shared = docs.sparkSession.sparkContext.broadcast(field or train(labelled_table()))

    def make():
        model = shared.value
        return lambda i, text: (i, [{"kind": k, "start": a, "stop": b, "base": known} for a, b, k, known in find_spans(text, model)])

    return map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")), make,
                    "doc_id long, spans array<struct<kind:string,start:long,stop:long,base:boolean>>")


@register("op7_pii")
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["base"])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, BASE),
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
