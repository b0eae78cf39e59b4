"""Plain versions of what the operators compute, for small inputs."""

import re
from collections import Counter


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    n = min(5, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def components(rows):
    """``{(index): (n, component)}`` of ``(id, text)`` rows by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 4 * min(len(sets[i]), len(sets[j])) >= 3 * max(len(sets[i]), len(sets[j])):
                common = len(sets[i] & sets[j])
                if 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                    up[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        r = root(i)
        if k is not None:
            least[r] = min(least.get(r, k), k)
    return Counter((k, len(s), least.get(root(i)) if s else k) for i, ((k, _), s) in enumerate(zip(rows, sets)))


def nearest(rows, asked, k):
    """``{query: [(vec_id, score)]}`` by all inner products."""
    import numpy as np

    ids = np.array([r[0] for r in rows])
    v = np.array([r[1] for r in rows], float)
    out = {}
    for q in asked:
        s = v @ np.array(q[1], float)
        order = sorted((i for i in range(len(ids)) if ids[i] != q[0]), key=lambda i: (-s[i], ids[i]))
        out[q[0]] = [(int(ids[i]), float(s[i])) for i in order[:k]]
    return out


def leaks(docs, items, similarity=0.75):
    """Pairs of document and item of which some window of the item's size is similar enough."""
    import math

    def runs(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]

    sets = {k: runs(t) for k, t in items if runs(t)}
    df = Counter(s for r in sets.values() for s in set(r))
    weight = lambda s: math.log(1 + len(sets) / df.get(s, 1))
    found = set()
    for d, text in docs:
        r = runs(text)
        for k, item in sets.items():
            if not set(r) & set(item):
                continue
            b = set(item)
            for at in range(max(1, len(r) - len(item) + 1)):
                a = set(r[at : at + len(item)])
                if sum(map(weight, a & b)) >= similarity * sum(map(weight, a | b)):
                    found.add((d, k))
                    break
    return found


def repair(rows):
    """``{conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha256)}`` by exhaustive search.

    ``rows`` are ``(conv_id, turn, role, text)``; every conversation ID of them is answered.
    """
    import functools
    import hashlib
    import zlib

    def key(v):
        return " " if v is None else str(v)

    damaged = {}
    for c, t, r, x in rows:
        damaged.setdefault(c, [])
        r, x = (" " if r is None else r), (" " if x is None else x)
        h = zlib.crc32(f"{key(c)}:{key(t)}".encode()) % 20
        if h == 0:
            continue
        if h == 1:
            x = ""
        if h == 2:
            x = re.sub(r"[.!?]", "", x)
        if h == 4:
            r = "user"
        damaged[c] += [(t, r, x)] * (2 if h == 3 else 1)
    grammar = re.compile(r"(s?(ua)+)?")
    out = {}
    for c, rs in damaged.items():
        rs.sort(key=lambda v: (v[0] is not None, v[0] if v[0] is not None else 0, v[1].encode(), v[2].encode()))
        turns = [t for t, _, _ in rs if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        kinds, seen = [], set()
        for _, r, x in rs:
            core = x.rstrip(" \t\n\x0b\x0c\r")
            if not re.search(r"[^\x20\x09-\x0D]", x):
                kinds.append("B")
            elif (r, x) in seen:
                kinds.append("P")
            elif core[-1] not in ".!?":
                kinds.append("T")
            else:
                kinds.append("O")
            seen.add((r, x))
        initials = [r[:1] for _, r, _ in rs]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))

        @functools.lru_cache(maxsize=None)
        def best(i, roles, inserts):
            """Least (cost, audit, lines) from row i with role initials so far; roles kept as a string."""
            options = []
            if i == len(rs) and grammar.fullmatch(roles):
                options.append((0, "", ()))
            if inserts < 3:
                for r in ("user", "assistant"):
                    sub = best(i, roles + r[0], inserts + 1) if _prefix_ok(roles + r[0]) else None
                    if sub:
                        options.append((5 + sub[0], "I" + sub[1], (f"{r}:",) + sub[2]))
            if i < len(rs):
                _, r, x = rs[i]
                sub = best(i + 1, roles, 0)
                if sub:
                    options.append((2 + sub[0], "D" + sub[1], sub[2]))
                if kinds[i] in "TO":
                    extra = 5 if kinds[i] == "T" else 0
                    for letter, new in (("K", r), ("R", "user"), ("R", "assistant")):
                        if letter == "R" and new[0] == r[:1]:
                            continue
                        if _prefix_ok(roles + new[:1]):
                            sub = best(i + 1, roles + new[:1], 0)
                            if sub:
                                cost = (0 if letter == "K" else 1) + extra
                                options.append((cost + sub[0], letter + sub[1], (f"{new}:{x}",) + sub[2]))
            return min(options, key=lambda o: (o[0], o[1])) if options else None

        def _prefix_ok(roles):
            return bool(re.fullmatch(r"s?(ua)*u?", roles))

        import sys

        sys.setrecursionlimit(100000)
        cost, audit, lines = best(0, "", 0)
        best.cache_clear()
        out[c] = (gaps, kinds.count("B"), kinds.count("P"), kinds.count("T"), illegal, cost, audit,
                  hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def url_rule(url, rules):
    """``(host, path, rule, verdict)`` by the rules alone (verdict None where none fits)."""
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group(0)
        path = re.match(r"[^?#]*", rest[len(host):]).group(0)
        host = "".join(chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch for ch in host)
    fit = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fit:
        return host, path, None, None
    _, text, verdict = min(fit, key=lambda f: (-f[0], f[1]))
    return host, path, text, verdict
