"""Plain versions of the corpus operators, for small tables held in lists of (doc_id, text)."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import xxhash

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def as_bytes(docs):
    """Documents in order, without repeated rows; no identifier comes first."""
    known = {(d, (t or "").encode()) for d, t in docs}
    return sorted(known, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def repeated_bytes(docs, window=100):
    seen, out = {}, {}
    for d, t in as_bytes(docs):
        cover = bytearray(len(t))
        for p in range(len(t) - window + 1):
            if seen.setdefault(t[p : p + window], (d, p)) != (d, p):
                cover[p : p + window] = b"\1" * window
        kept = bytes(c for c, m in zip(t, cover) if not m)
        spans = sum(1 for i, m in enumerate(cover) if m and not (i and cover[i - 1]))
        out[d] = (len(t), sum(cover), spans, hashlib.sha256(kept).hexdigest())
    return out


def repeated_phrases(docs, window=13):
    first, words, out = {}, {}, {}
    for d, t in as_bytes(docs):
        words[d] = WORDS.findall(t)
        for p in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][p : p + window]), d)
    for d, w in words.items():
        cover = bytearray(len(w))
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] != d:
                cover[p : p + window] = b"\1" * window
        kept = b" ".join(x for x, m in zip(w, cover) if not m)
        out[d] = (len(w), sum(cover), hashlib.sha256(kept).hexdigest())
    return out


def near_duplicates(docs, size=5, percent=80):
    sets = {}
    for d, t in as_bytes(docs):
        w = WORDS.findall(t.translate(LOWER))
        sets[d] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    common = defaultdict(int)
    for ids in holders.values():
        for pair in combinations(ids, 2):
            common[pair] += 1
    group = {d: d for d in sets}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((root(a), root(b)), key=lambda v: (v is None, v or 0))
            group[b] = a
    return {d: (len(s), root(d)) for d, s in sets.items()}


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _valid(kind, body):
    digits = re.sub("[^0-9]", "", body)
    if kind == "ip":
        return all(int(x) <= 255 for x in body.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and _luhn(digits)
    return kind != "phone" or 9 <= len(digits) <= 15


def base_spans(text):
    spans = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        spans += [(m.start(), rank, m.end(), kind) for m in pattern.finditer(text or "") if _valid(kind, m[0])]
    counts = tuple(sum(s[3] == kind for s in spans) for kind in BASE)
    joined = [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans)]
    return counts + (hashlib.sha256(",".join(joined).encode()).hexdigest(),), joined


def prefix_trie(rows):
    """Nodes of the trie of rebuilt conversations, from rows (conv_id, turn, role, text)."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    rebuilt = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + v[h:]  # the remainder has the sign of c, as in SQL
    members = defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[tuple(rebuilt[c][:d])].append(c)
    kids, leaves, saved = Counter(), Counter(), Counter()
    for p in sorted(members, key=len, reverse=True):
        leaves[p] += not kids[p]
        if p:
            saved[p] += (len(members[p]) - 1) * len(p[-1][1].encode())
            kids[p[:-1]] += 1
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in m if len(rebuilt[c]) == len(p))
        above = members[p[:-1]][0] if p else None
        out.append((m[0], len(p), above, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def _hash(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _climb(nodes):
    levels = []
    while len(nodes) > 1:
        levels.append(nodes)
        nodes = [_hash("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
    return levels, nodes[0]


def _path(levels, i):
    out = []
    for nodes in levels:
        start = i // 16 * 16
        out.append(("".join(nodes[start:i]), "".join(nodes[i + 1 : start + 16])))
        i //= 16
    return out


def merkle_proofs(rows):
    """Proofs of all rows (doc_id, source, lang, n_chars, text)."""

    def leaf(*values):
        return _hash("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sources = defaultdict(list)
    for row in rows:
        sources[row[1]].append(row)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        sources[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[s] = _climb([leaf(*r) for r in sources[s]])
    top, root = _climb([trees[s][1] for s in order]) if order else ([], None)
    out = []
    for place, s in enumerate(order):
        levels, subroot = trees[s]
        for i, r in enumerate(sources[s]):
            proof, node = _path(levels, i) + _path(top, place), leaf(*r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                node = leaf(*r[:4], r[4] and r[4].translate(lower))
            for left, right in proof:
                node = _hash(left + node + right)
            out.append((r[0], leaf(*r), subroot, root, _hash("".join(a + b for a, b in proof)), node, node == root))
    return Counter(out)


def fingerprint(text, size=4):
    words = WORDS.findall((text or "").encode().translate(LOWER))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + size]), 42) for i in range(max(1, len(words) - size + 1))] if words else []
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def reachable(values, near):
    """The smallest value that each of some numbers reaches by links."""
    values = sorted(set(values))
    group = {v: v for v in values}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in combinations(values, 2):
        if near(a, b):
            x, y = sorted((root(a), root(b)))
            group[y] = x
    return {v: root(v) for v in values}


def simhash_duplicates(docs, radius=4):
    bits = [(d, fingerprint(t)) for d, t in docs]
    group = reachable([b for _, b in bits], lambda a, b: (a ^ b).bit_count() <= radius)
    least = {}
    for d, b in bits:
        known = least.setdefault(group[b], d)
        least[group[b]] = d if known is None or d is not None and d < known else known
    return Counter((d, f"{b:016x}", least[group[b]]) for d, b in bits)
