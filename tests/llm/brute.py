"""The contracts in plain Python, one text at a time."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc(value):
    return zlib.crc32(("" if value is None else str(value)).encode())


def mix(rows, weights=(5, 2, 1), budget=1.5, most=2.0):
    """source -> (size, target) by reshaping the excess until none is above."""
    size = Counter()
    for _, source, text in rows:
        size[source] += len(WORD.findall(text or ""))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = set(), budget * sum(size.values())
    while True:
        free = [s for s in order if s not in full]
        rest = total - sum(most * size[s] for s in full)
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] >= most * size[s]}
        if not over:
            break
        full |= over
        if len(full) == len(order):
            share = {}
            break
    return {s: (size[s], most * size[s] if s in full else share[s]) for s in order}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def pii(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    }
    return [(k, m.start(), m.end()) for k, (p, ok) in kinds.items() for m in re.finditer(p, text) if ok(m[0])]


def secrets(text):
    text = text or ""
    names = "(password|passwd|secret|token|api_?key)"
    assign = rf"""(?ai:{names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [("assign", m.start(), m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 8]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    order = ["assign", "access", "hex"]
    return sorted(found, key=lambda s: (s[1], order.index(s[0])))


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def fingerprint(text, width=4):
    words = WORD.findall(lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, bits=4):
    """id -> smallest id reachable; ``prints`` is a list of (id, fingerprint)."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= bits:
                parent[find(i)] = find(j)
    best = {}
    for i, (key, _) in enumerate(prints):
        root = find(i)
        best[root] = min(best.get(root, key), key)
    return {key: best[find(i)] for i, (key, _) in enumerate(prints)}


def contamination(docs, items, window=13):
    """id -> (words, hit, sorted items)."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    windows = defaultdict(set)
    for key, text in items:
        words = split(text)
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[i : i + n])].add(str(key))
    sizes = {len(w) for w in windows}
    out = {}
    for key, text in docs:
        words, hit, found = split(text), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if (got := windows.get(tuple(words[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= got
        out[key] = (len(words), len(hit), sorted(found))
    return out


def base_scores(docs, train):
    """id -> (tokens, known, base); docs and train are lists of (id, text)."""
    split = lambda t: [*WORD.findall(lower(t or "")), ""]
    counts = Counter(w for _, t in train for w in split(t))
    total, types = sum(counts.values()), len(counts)
    out = {}
    for key, text in docs:
        tokens = split(text)
        score = sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in tokens)
        out[key] = (len(tokens), sum(counts[w] > 0 for w in tokens), score)
    return out, total
