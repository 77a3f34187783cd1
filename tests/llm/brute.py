"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import string
import zlib
from collections import Counter

FOLD = {i: i + 32 for i in range(65, 91)}


def words(text, lower=True):
    text = (text or "").translate(FOLD) if lower else (text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def shingle_set(text, k):
    w = words(text)
    if not w:
        return frozenset()
    if len(w) < k:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def near_duplicates(rows, k, percent):
    """rows of (doc_id, text) -> (doc_id, n_shingles, component_id, n_links)."""
    sets = [shingle_set(t, k) for _, t in rows]
    n = len(rows)
    root, links = list(range(n)), [0] * n

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    name = {}
    key = lambda d: (d is not None, d)
    for i in range(n):
        r = find(i)
        if r not in name or key(rows[i][0]) < key(name[r]):
            name[r] = rows[i][0]
    return [(rows[i][0], len(sets[i]), name[find(i)], links[i]) for i in range(n)]


def spans(text):
    """Checked base spans as (start, kind number, end)."""
    out = []
    text = text or ""
    patterns = [
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+",
        r"\+[0-9][\x20().0-9-]+[0-9]",
    ]
    for k, p in enumerate(patterns):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = True
            if k == 1:
                ok = all(int(x) <= 255 for x in m[0].split("."))
            elif k == 2:
                total = sum(sum(divmod(int(c) * (2 if i % 2 else 1), 10)) for i, c in enumerate(reversed(digits)))
                ok = 14 <= len(digits) <= 19 and total % 10 == 0
            elif k == 3:
                ok = 10 <= len(digits) <= 15
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def more_spans(text):
    """Checked spans of the further kinds as (kind, start, end), by plain loops
    over what the text holds."""
    text = text or ""
    out = []
    sides = lambda m, signs: not (m.start() and text[m.start() - 1] in signs) and not (m.end() < len(text) and text[m.end()] in signs)
    digits, letters = "0123456789", string.ascii_letters + string.digits
    for m in re.finditer(r"\(?([0-9]{3})\)?[ .-]([0-9]{3})[ .-][0-9]{4}(?![0-9])", text):
        if not (m.start() and text[m.start() - 1] in digits + "+(") and m[1][0] in "23456789" and m[2][0] in "23456789":
            out.append(("national", m.start(), m.end()))
    for m in re.finditer(r"([0-9]{3})-([0-9]{2})-([0-9]{4})", text):
        if sides(m, digits + "-") and m[1] not in ("000", "666") and m[1][0] != "9" and m[2] != "00" and m[3] != "0000":
            out.append(("identity", m.start(), m.end()))
    for m in re.finditer(r"[A-Z]{2}[0-9]{2}( ?[A-Z0-9]{4}){2,7}( ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", text):
        plain = m[0].replace(" ", "")
        if sides(m, letters) and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
            out.append(("account", m.start(), m.end()))
    for m in re.finditer(r"(?i)(token|secret|password|passwd|api[_-]?key|access[_-]?key) {0,3}[=:] {0,3}[\"']?([A-Za-z0-9_/+-]{12,})", text):
        own = m[2]
        if not (m.start() and text[m.start() - 1] in letters) and re.search("[0-9]", own) and re.search("[A-Za-z]", own) and len(set(own)) >= 7:
            out.append(("secret", m.start(), m.end()))
    for m in re.finditer(r"(?i)[a-z0-9._%+-]+ ?[\[(]at[\])] ?[a-z0-9-]+( ?([\[(]dot[\])]|\.) ?[a-z0-9-]+)+", text):
        if re.search(r"[A-Za-z]{2,}$", m[0]):
            out.append(("spelled", m.start(), m.end()))
    return out


def crc(doc_id, m):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % m


def tokens(text):
    return [*words(text), None]


class Katz:
    """The model of stationday.llm.katz, with dictionaries."""

    def __init__(self, texts, k, discounts, order=2):
        self.k, self.order = k, order
        self.c = [Counter() for _ in range(order + 1)]  # n-grams as tuples
        for t in texts:
            ts = tokens(t)
            for i, w in enumerate(ts):
                for n in range(1, order + 1):
                    self.c[n][(*self.history(ts, i, n), w)] += 1
        self.n = sum(self.c[1].values())
        self.uni = Counter({w: c for (w,), c in self.c[1].items()})
        self.words = list(self.uni)
        self.d = [None] + [discounts([sum(c == r for c in self.c[n].values()) for r in range(1, k + 2)]) for n in range(1, order + 1)]
        self.after = {}
        for n in range(2, order + 1):
            for (*h, w), c in self.c[n].items():
                self.after.setdefault(tuple(h), {})[w] = c
        self.unknown = 1 - sum(self.less(1, c) for c in self.uni.values()) / (self.n + 1)
        self.alphas = {}

    @staticmethod
    def history(ts, i, n):
        return tuple("<s>" if j < 0 else ts[j] for j in range(i - n + 1, i))

    def less(self, n, c):
        return c if c > self.k else c * self.d[n][c - 1]

    def prob(self, h, w):
        if not h:
            return self.less(1, self.uni[w]) / (self.n + 1) if w in self.uni else self.unknown
        after, n = self.after.get(h, {}), len(h) + 1
        if w in after:
            return self.less(n, after[w]) / (sum(after.values()) + 1)
        if not after:
            return self.prob(h[1:], w)
        if h not in self.alphas:
            free = 1 - sum(self.less(n, c) for c in after.values()) / (sum(after.values()) + 1)
            self.alphas[h] = free / (1 - sum(self.prob(h[1:], x) for x in after))
        return self.alphas[h] * self.prob(h[1:], w)

    def score(self, text):
        ts = tokens(text)
        return sum(math.log10(self.prob(self.history(ts, i, self.order), w)) for i, w in enumerate(ts))


def prefix_trie(rows):
    """Nodes of the trie of rebuilt conversations from (conv_id, turn, role,
    text) rows with distinct turns in a conversation."""
    own = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(math.fmod(c, 5))
        full[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members, kids = {}, {}
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
            if d:
                kids.setdefault(turns[: d - 1], set()).add(turns[:d])
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = kids.get(node, ())
        leaves[node] = sum(leaves[k] for k in below) or 1
        weight = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = weight + sum(saved[k] for k in below)
    out = []
    for node, ids in members.items():
        ends = ",".join(map(str, sorted(c for c in ids if len(full[c]) == len(node))))
        out.append((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(kids.get(node, ())), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def hard_negatives(rows):
    """(anchor, positive, rank, negative, positive score, negative score) from
    (vec_id, vector, label) rows with distinct ids."""
    own = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        own.append((i, [math.floor(256 * x) for x in v], (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    out = []
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    for n, (i, v, label) in enumerate(own):
        if i is None or i % 100:
            continue
        scores = [(sum(a * b for a, b in zip(v, w)), j, l) for k, (j, w, l) in enumerate(own) if k != n]
        positives = sorted((s for s in scores if s[2] == label), key=order)[:5]
        others = sorted((s for s in scores if s[2] != label), key=order)
        for p, j, _ in positives:
            fits = [s for s in others if 30 * p <= 100 * s[0] <= 90 * p][:10]
            out += [(i, j, r + 1, s[1], p, s[0]) for r, s in enumerate(fits)]
    return out
