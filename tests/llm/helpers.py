"""Brute-force versions that the operators are held against."""

import hashlib
import re
from collections import Counter, defaultdict

ODD_TEXTS = [
    None,
    "",
    " \t\n",
    "one",
    "Two words",
    "same same same same same same",
    "ünïcödé 漢字 \U0001f600 words and more words here",
    "x" * 5000,
    "tie break " * 700,
    "nul\x00byte and \x1c separators \x85 here now",
]


def odd_documents(spark, texts=None):
    """Rows with nulls in any column, repeated rows and ids, and extra columns."""
    texts = ODD_TEXTS if texts is None else texts
    rows = [(i, t, "en" if i % 2 else None, None, None if t is None else len(t), i) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, texts[5], None, "s", 3, 0), (None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `extra` long")


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


class Groups(dict):
    def top(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.top(a), self.top(b)
        self[max(a, b)] = min(a, b)


def near_duplicate_classes(texts: dict[int, str], width: int, percent: int) -> dict[int, int]:
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    groups = Groups()
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                groups.join(a, b)
    return {i: groups.top(i) for i in ids}


def repeated_bytes(texts: list[bytes], width: int) -> list[bytearray]:
    seen = Counter(t[i : i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for t in texts:
        flags = bytearray(len(t))
        for i in range(len(t) - width + 1):
            if seen[t[i : i + width]] > 1:
                flags[i : i + width] = b"\1" * width
        out.append(flags)
    return out


def contamination(text, items: dict[int, str], width: int):
    split = lambda t: re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").encode().lower())
    words = split(text)
    hit, found = [False] * len(words), set()
    for item, t in items.items():
        w = split(t)
        m = min(width, len(w))
        windows = {tuple(w[i : i + m]) for i in range(len(w) - m + 1)} if m else set()
        for i in range(len(words) - m + 1):
            if tuple(words[i : i + m]) in windows:
                hit[i : i + m] = [True] * m
                found.add(item)
    return len(words), sum(hit), sorted(found)


def by_key(rows, key):
    out = defaultdict(list)
    for r in rows:
        out[r[key]].append(r)
    return out
