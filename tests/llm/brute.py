"""Plain versions that the operators are held against."""

import hashlib
import math
import re
from collections import Counter

WORD = re.compile("[^\x20\x09-\x0d]+")

# The base patterns as the query's contract gives them.
PRIVATE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def private_spans(text):
    out = []
    for kind, pattern in PRIVATE:
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def removed(docs, window=20):
    """doc -> (words, removed words, digest of the kept); docs: (id, text) with distinct ids."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        words = WORD.findall(text or "")
        covered = [False] * len(words)
        for s in range(len(words) - window + 1):
            key = tuple(words[s:s + window])
            if key in seen:
                covered[s:s + window] = [True] * window
            seen.add(key)
        kept = [w for w, c in zip(words, covered, strict=True) if not c]
        out[i] = (len(words), sum(covered), sha(" ".join(kept)))
    return out


def kmers(text, k=5):
    """Occurrence-labelled k-mers in order."""
    words = WORD.findall(text.encode().lower().decode())
    grams = [tuple(words[i:i + k]) for i in range(max(len(words) - k + 1, 1))] if words else []
    seen = Counter()
    out = []
    for g in grams:
        out.append((g, seen[g]))
        seen[g] += 1
    return out


def chain(a, b):
    """Longest common chain of two sequences of distinct items, by the textbook table."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(before[j + 1], row[j])
    return row[-1]


def similar(a, b):
    x, y = kmers(a), kmers(b)
    if not x or not y:
        return float(len(x) == len(y))
    n = chain(x, y)
    return n / (len(x) + len(y) - n)


def classes(nodes, linked):
    """node -> least node of its component."""
    above = {n: n for n in nodes}

    def top(n):
        while above[n] != n:
            n = above[n]
        return n
    for a, b in linked:
        a, b = sorted((top(a), top(b)))
        above[b] = a
    return {n: top(n) for n in nodes}


def overlap_items(words, item, window=13, agree=11):
    """Whether a window of the item stands in the words with all but two words alike."""
    if 0 < len(item) < window:
        return any(words[i:i + len(item)] == item for i in range(len(words)))
    return any(
        sum(a == b for a, b in zip(words[i:i + window], item[j:j + window], strict=True)) >= agree
        for i in range(len(words) - window + 1) for j in range(len(item) - window + 1))


def unigram(docs, trained):
    """doc -> (tokens, known, N, base score); docs: id -> text."""
    count = Counter()
    for i in trained:
        count.update([*WORD.findall(docs[i].encode().lower().decode()), None])
    n, d = sum(count.values()), sum(count.values()) + 0.1 * (len(count) + 1)
    out = {}
    for i, text in docs.items():
        tokens = [*WORD.findall(text.encode().lower().decode()), None]
        out[i] = (len(tokens), sum(count[t] > 0 for t in tokens), n, sum(math.log10((count[t] + 0.1) / d) for t in tokens))
    return out
