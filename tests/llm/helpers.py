"""Small tables and brute-force counterparts of the operators."""

import collections
import random

import pyarrow as pa
import pyarrow.parquet as pq

DOCS = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])


def tables(path, docs, benchmark=(), labels=(), files=1):
    """Writes the tables (documents: (doc_id, text[, lang, source])) and returns the folder."""
    rows = [{"doc_id": r[0], "text": r[1], "lang": r[2] if len(r) > 2 else "en", "source": r[3] if len(r) > 3 else "s",
             "n_chars": len(r[1] or "")} for r in docs]
    if files == 1:
        pq.write_table(pa.Table.from_pylist(rows, DOCS), f"{path}/documents.parquet")
    else:
        (path / "documents.parquet").mkdir()
        for k in range(files):
            pq.write_table(pa.Table.from_pylist(rows[k::files], DOCS), f"{path}/documents.parquet/part-{k}.parquet")
    pq.write_table(pa.Table.from_pylist([{"item_id": i, "text": t} for i, t in benchmark],
                                        pa.schema([("item_id", pa.int64()), ("text", pa.string())])), f"{path}/benchmark.parquet")
    pq.write_table(pa.Table.from_pylist([{"doc_id": i, "quality": q, "toxic": t} for i, q, t in labels], pa.schema(
        [("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())])), f"{path}/labels.parquet")
    return str(path)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)


def words(text):
    return (text or "").encode().lower().split()


class Union:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def near_groups(docs):
    """doc_id -> (set size, component) by comparing all pairs."""
    sets = {}
    for i, text, *_ in docs:
        w = words(text)
        sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    union, ids = Union(sets), list(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            both = len(x & y)
            if x and y and 100 * both >= 75 * (len(x) + len(y) - both):
                union.join(a, b)
    return {i: (len(s), union.find(i)) for i, s in sets.items()}


_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def leaks(docs, items):
    """doc_id, words, words hit, items, contaminated by looking up every window."""
    split = lambda t: (t or "").encode().translate(_FOLD).split()
    windows = collections.defaultdict(set)
    for i, t in items:
        w = split(t)
        for j in range(max(1, len(w) - 9)):
            if w:
                windows[tuple(w[j:j + 10])].add(str(i))
    sizes = {len(k) for k in windows}
    for i, t, *_ in docs:
        w, hit, found = split(t), set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                if (k := tuple(w[j:j + n])) in windows:
                    hit.update(range(j, j + n))
                    found |= windows[k]
        yield i, len(w), len(hit), sorted(found), bool(hit)


def line_removals(docs):
    """doc_id -> (lines with tokens, numbers of removed lines) by comparing all pairs."""
    earlier, out = [], {}
    for i, t, *_ in sorted(docs):
        n, gone = 0, []
        for k, line in enumerate((t or "").encode().lower().split(b"\n")):
            w = frozenset(line.split())
            if w:
                n += 1
                if any(4 * len(w & v) >= 3 * len(w | v) for v in earlier):
                    gone.append(k)
                earlier.append(w)
        out[i] = (n, gone)
    return out


def edited_documents(n, seed=5, lines=False):
    """Documents that are edited copies of a few bases, with empty and null ones."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60 if lines else 300)]
    bases = [" ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 5, 8, 13, 30] if lines else [3, 8, 40, 120]))) for _ in range(25)]

    def edited():
        w = rng.choice(bases).split()
        for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
            w[rng.randrange(len(w))] = rng.choice(vocabulary) if lines else f"q{rng.randint(0, 50)}"
        return " ".join(w)

    def text():
        if rng.random() < 0.08:
            return rng.choice([None, "", "  \n", "\n\n"])
        return "\n".join(edited() for _ in range(rng.randint(1, 6) if lines else 1))

    return [(i, text()) for i in range(n)]
