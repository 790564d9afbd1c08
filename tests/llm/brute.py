"""Plain Python versions that the corpus operators are compared with."""

import hashlib
import re
from collections import Counter, defaultdict

SPACED = re.compile("[^\x20\x09-\x0D]+")
BENCH = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def key(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


def rules(text):
    text = text or ""
    words = SPACED.findall(text)
    grams = Counter(zip(words, words[1:], words[2:]))
    hit = {j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    n, rep = len(words), len(hit)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), rep,
            n < 50 or 100 * rep > 50 * n)


SECRETS = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                          re.I | re.A)),
    ("access", re.compile(r"AKIA[A-Z0-9]+")), ("hex", re.compile(r"[0-9a-f]+"))]
LEAST = {"access": 16, "hex": 32}


def secrets(text):
    spans = []
    for k, (kind, pattern) in enumerate(SECRETS):
        for m in pattern.finditer(text or ""):
            if len(m[2]) >= 8 if kind == "assign" else len(m[0]) >= LEAST[kind]:
                spans.append((m.start(), k, m.end()))
    return [f"{SECRETS[k][0]}:{a}:{b}" for a, k, b in sorted(spans)]


def hits(docs, items, n=10):
    windows = defaultdict(set)
    for item, text in items:
        ws = BENCH.findall(low(text))
        m = min(n, len(ws))
        for i in range(len(ws) - m + 1 if ws else 0):
            windows[tuple(ws[i:i + m])].add(item)
    out = []
    for doc, text in docs:
        ws, hit, found = BENCH.findall(low(text)), set(), set()
        for m in {len(w) for w in windows}:
            for i in range(len(ws) - m + 1):
                own = windows.get(tuple(ws[i:i + m]))
                if own:
                    hit |= set(range(i, i + m))
                    found |= own
        ids = ",".join(sorted(map(str, found)))
        out.append((doc, len(ws), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return out


def components(rows):
    """(doc_id, size, component) by Jaccard 0.75 over word 5-shingles."""
    sets = []
    for _, text in rows:
        ws = SPACED.findall(low(text))
        n = min(5, len(ws))
        sets.append(frozenset(tuple(ws[k:k + n]) for k in range(len(ws) - n + 1)) if ws else frozenset())
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if both and 100 * both >= 75 * (len(x) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(k)] = min(least.get(find(k), doc), doc)
    return [(rows[k][0], len(sets[k]), rows[k][0] if not sets[k] else least.get(find(k))) for k in range(len(sets))]
