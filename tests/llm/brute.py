"""Plain Python for what the operators return, written after the contracts."""

import base64
import hashlib
import itertools
import math
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def exact(docs):
    groups = defaultdict(list)
    for i, t in docs:
        groups[sha(re.sub(SPACE, " ", t or ""))].append(i)
    return {i: (min(g), len(g), i == min(g), h) for h, g in groups.items() for i in g}


def shingles(text, k):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(WORD, text or "")]
    if not words:
        return frozenset()
    return frozenset(tuple(words[j : j + k]) for j in range(max(len(words) - k + 1, 1)))


def linked(docs, k, percent):
    sets = {i: shingles(t, k) for i, t in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    by_size = sorted((len(s), i) for i, s in sets.items() if s)
    for a, (n, i) in enumerate(by_size):
        for m, j in itertools.islice(by_size, a + 1, None):
            if 100 * n < percent * m:
                break
            if find(i) != find(j):
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (n + m - both):
                    x, y = sorted((find(i), find(j)))
                    parent[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    free, left, out = set(order), sum(sizes.values()), {}
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] > 3 * sizes[s] * total]
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        for s in over:
            out[s] = 3 * sizes[s]
            left -= out[s]
            free.remove(s)
    return out


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def secrets(text):
    text = text or ""
    assign = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    out = [("assign", m.start(), m.end()) for m in re.finditer(assign, text, re.A) if len(m[2]) >= 6]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return out + [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]


def private(text):
    text = text or ""
    out = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", m))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", m))
    return [(k, m.start(), m.end()) for k, m in out]


def listed(spans, kinds):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], kinds.index(s[0]))))


def captures(pages):
    digests = {i: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode() for i, h in pages}
    first = {}
    for i in sorted(digests):
        first.setdefault(digests[i], i)
    return {
        i: (len((h or "").encode()), digests[i], "response" if first[digests[i]] == i else "revisit", None if first[digests[i]] == i else first[digests[i]])
        for i, h in pages
    }


def words(text):
    return len(re.findall(WORD, text or ""))


def source_sizes(docs):
    sizes = Counter()
    for _, text, source in docs:
        sizes[source] += words(text)
    return dict(sizes)


def looped(i, words):
    h = crc32(str(i).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (j - a) % p] for j in range(a, n)]


def runs(words):
    """start, length, period of the runs, period by period."""
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    own, found = np.array([numbers[w] for w in words], np.int64), {}
    for q in range(1, len(words) // 4 + 1):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], own[:-q] == own[q:], [0]])))
        for i, j in edges.reshape(-1, 2).tolist():
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)  # the smallest period comes first
    return sorted((a, n, q) for (a, n), q in found.items())


def collapsed(words, found):
    gone = {j for a, n, q in found for j in range(a + q, a + n)}
    return " ".join(w for j, w in enumerate(words) if j not in gone)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        h = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(conv, turn, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return out


def cheapest(rows):
    """Cost and audit of rows (initial, fault) by all paths, row by row, the best of each state kept."""
    follows = {0: 2, 1: 2, 2: 3, 3: 2}  # begin, system, user, assistant

    def inserted(best):
        for _ in range(3):
            for s, (cost, audit) in list(best.items()):
                best[follows[s]] = min((cost + 2, audit + "I"), best.get(follows[s], (1 << 60, "")))
        return best

    best = inserted({0: (0, "")})
    for initial, fault in rows:
        after = {}
        for s, (cost, audit) in best.items():
            ways = [("D", 3, s)]
            if fault not in ("blank", "duplicate"):
                more = int(fault == "truncated")
                ways.append(("R", 2 + more, follows[s]))
                if s == 0 and initial == "s":
                    ways.append(("K", more, 1))
                elif initial == ("a" if s == 2 else "u"):
                    ways.append(("K", more, follows[s]))
            for edit, price, to in ways:
                after[to] = min((cost + price, audit + edit), after.get(to, (1 << 60, "")))
        best = inserted(after)
    return min(best[s] for s in (0, 3) if s in best)


def repaired(rows):
    """gaps, blank, duplicate, truncated, illegal, cost, audit, hash of a conversation's rows (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    initials = [role[:1] for _, role, _ in rows]
    cost, audit = cheapest(list(zip(initials, faults, strict=True)))
    lines, state, left = [], 0, list(rows)
    for edit in audit:
        _, role, text = left.pop(0) if edit != "I" else (None, None, "")
        if edit in "IR":
            role = "assistant" if state == 2 else "user"
        if edit != "D":
            state = {"s": 1, "u": 2, "a": 3}[role[0]]
            lines.append(f"{role}:{text}")
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(lines)))


def language_model(docs, held_out, order, strength):
    """n_tokens, n_known, train_tokens, base and score of (id, text), word by word."""
    lower = {i: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(WORD, t or "")] + [None] for i, t in docs}
    counts, contexts = Counter(), Counter()
    for i, words in lower.items():
        if not held_out(i):
            begun = ["<"] + words
            for j in range(1, len(begun)):
                for n in range(order):
                    if j - n >= 0:
                        counts[tuple(begun[j - n : j + 1])] += 1
                        contexts[tuple(begun[j - n : j])] += 1
    total = contexts[()]
    distinct = sum(len(k) == 1 for k in counts)
    out = {}
    for i, words in lower.items():
        begun, base, score = ["<"] + words, 0.0, 0.0
        for j in range(1, len(begun)):
            p = (counts[(begun[j],)] + 0.5) / (total + 0.5 * (distinct + 1))
            base += math.log10(p)
            for n in range(1, order):
                if j - n >= 0:
                    p = (counts[tuple(begun[j - n : j + 1])] + strength * p) / (contexts[tuple(begun[j - n : j])] + strength)
            score += math.log10(p)
        out[i] = (len(words), sum((w,) in counts for w in words), total, base, score)
    return out
