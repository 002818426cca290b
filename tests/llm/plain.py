"""The contracts of the operators written plainly, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
BENCH = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(data):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in data)


def raw(text):
    return (text or "").encode()


def rest(doc_id, n):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % n


def op1(docs):
    tokens = [(d, WORD.findall(lower(raw(t))) + [None]) for d, t in docs]
    held = [rest(d, 7) == 2 for d, _ in docs]
    c = Counter(w for (d, ws), h in zip(tokens, held) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    return [
        (d, h, len(ws), sum(c[w] > 0 for w in ws), n,
         round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6))
        for (d, ws), h in zip(tokens, held)
    ]


def op2(docs, long=200):
    c = Counter(raw(t)[i:i + long] for _, t in docs for i in range(len(raw(t)) - long + 1))
    out = []
    for d, t in docs:
        data = raw(t)
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - long + 1):
            if c[data[i:i + long]] > 1:
                gone[i:i + long] = True
        spans = int((gone[:-1] & ~np.append(False, gone[:-1])[:-1]).sum())
        left = bytes(b for b, g in zip(data, gone) if not g)
        out.append((d, len(data), len(data) - len(left), spans, hashlib.sha256(left).hexdigest()))
    return out


def op3(docs, bench, width=10):
    windows = defaultdict(set)
    for item, text in bench:
        ws = BENCH.findall(lower(raw(text)))
        for k in range(max(1, len(ws) - width + 1)):
            if ws:
                windows[tuple(ws[k:k + width])].add(str(item))
    out = []
    for d, t in docs:
        ws = BENCH.findall(lower(raw(t)))
        hit, items = set(), set()
        for m in {len(w) for w in windows}:
            for k in range(len(ws) - m + 1):
                found = windows.get(tuple(ws[k:k + m]))
                if found:
                    hit.update(range(k, k + m))
                    items |= found
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        out.append((d, len(ws), len(hit), len(items), digest, bool(hit)))
    return out


def op4(docs):
    """docs: (doc_id, text, source), with ids that are not shared by different documents."""
    sized = [(d, s, len(WORD.findall(raw(t)))) for d, t, s in docs]
    total = sum(z for *_, z in sized)
    names = sorted({s for _, s, _ in sized}, key=lambda s: (s is None, raw(s)))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    size = {s: sum(z for _, o, z in sized if o == s) for s in names}
    free, goal, left = set(names), {}, total
    while free:
        share = left / sum(weight[s] for s in free)
        full = {s for s in free if share * weight[s] > 3 * size[s]}
        if not full:
            goal |= {s: share * weight[s] for s in free}
            break
        goal |= {s: 3.0 * size[s] for s in full}
        left -= sum(3 * size[s] for s in full)
        free -= full
    return {d: (z, size[s], goal[s], s) for d, s, z in sized}


def op6(text):
    data = raw(text)
    ws = WORD.findall(data)
    n, seen, dup = len(ws), set(), 0
    for line in data.split(b"\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    c = Counter(tuple(ws[i:i + 8]) for i in range(n - 7))
    twice = {p for i in range(n - 7) if c[tuple(ws[i:i + 8])] > 1 for p in range(i, i + 8)}
    symbols = sum(ch in "#*$%&|<>" for ch in text or "")
    chars = sum(len(w.decode()) for w in ws)
    failed = n < 20 or 100 * len(twice) > 30 * n
    return n, chars, symbols, dup, len(twice), failed


def fingerprint(text):
    ws = WORD.findall(lower(raw(text)))
    if not ws:
        return 0
    hashes = [
        xxhash.xxh64_intdigest(b" ".join(ws[i:i + 4]), 42) for i in range(max(1, len(ws) - 3))
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, ids, bits=4):
    """Smallest id of everything reachable within ``bits``."""
    prints, parent = np.array(prints, np.uint64), list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= bits):
            parent[find(i)] = find(int(j))
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(prints))]


def op7(docs):
    prints = [fingerprint(t) for _, t in docs]
    heads = components(prints, [d for d, _ in docs])
    return [(d, f"{f:016x}", h) for (d, _), f, h in zip(docs, prints, heads)]


def shingles(text, width=5):
    ws = WORD.findall(lower(raw(text)))
    return {tuple(ws[i:i + width]) for i in range(max(1, len(ws) - width + 1))} if ws else set()


def jaccard(one, two):
    return len(one & two) / len(one | two) if one | two else 1.0


def alike(docs):
    """Smallest id of each row's group: what pairs with a five-word Jaccard of 0.8 connect."""
    sets, group = [shingles(t) for _, t in docs], list(range(len(docs)))
    for i, one in enumerate(sets):
        for j in range(i):
            if group[i] != group[j] and jaccard(one, sets[j]) >= 0.8:
                group = [group[j] if g == group[i] else g for g in group]
    least = {}
    for (d, _), g in zip(docs, group):
        if d is not None:
            least[g] = min(d, least.get(g, d))
    return [least.get(g) for g in group]


RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"),
         ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def op10(url):
    """Host, path, rule and its verdict."""
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = found.groups() if found else ("", "")
    host = lower(host.encode()).decode()
    fits = [
        (len(h + p), h + p, v) for v, h, p in RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    _, rule, verdict = max(fits, default=(0, None, None))
    return host, path, rule, verdict
