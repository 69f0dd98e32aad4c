"""Plain Python versions of what the operators return, one row at a time."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import defaultdict

import numpy as np

SPACE = re.compile("[^\x20\x09-\x0d]+")


def words(text: str | None) -> list[str]:
    return SPACE.findall(text or "")


def shingle_set(text: str | None) -> set[tuple[str, ...]]:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = words(lower)
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return {tuple(found[k : k + 5]) for k in range(len(found) - 4)}


def grouped(links: list[tuple], nodes: list) -> dict:
    """The smallest node reachable from each."""
    least = {n: n for n in nodes}
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(least[a], least[b])
            if least[a] != low or least[b] != low:
                least[a] = least[b] = low
                moved = True
    return least


def near_duplicates(docs: list[tuple], percent: int = 75) -> set[tuple]:
    """Rows (doc_id, n_shingles, component_id, kept) for distinct (doc_id, text)."""
    sets = {i: shingle_set(t) for i, t in docs if i is not None}
    links = []
    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * len(sets[a] | sets[b]):
            links.append((a, b))
    least = grouped(links, list(sets))
    out = {(i, len(sets[i]), least[i], least[i] == i) for i in sets}
    return out | {(None, len(shingle_set(t)), None, True) for i, t in docs if i is None}


def luhn(number: str) -> bool:
    doubled = [int(c) * (2 if k % 2 else 1) for k, c in enumerate(reversed(number))]
    return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


BASE = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    out = []
    for kind, rule in enumerate(BASE):
        for m in re.finditer(rule, text or ""):
            number = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(part) > 255 for part in m[0].split(".")):
                continue
            if kind == 2 and not (12 <= len(number) <= 19 and luhn(number)):
                continue
            if kind == 3 and not 9 <= len(number) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


def targets(sizes: dict, weights=(3, 1, 2), share=1.5, limit=2) -> dict:
    """Words of each source: by weight, the excess over the limit shared again."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    out, left, rest = {}, set(order), share * sum(sizes.values())
    while left:
        whole = sum(weight[s] for s in left)
        over = [s for s in left if rest * weight[s] / whole > limit * sizes[s]]
        if not over:
            return out | {s: rest * weight[s] / whole for s in left}
        for s in over:
            out[s] = limit * sizes[s]
            left.discard(s)
        rest = share * sum(sizes.values()) - sum(out.values())
    return out


def source_sizes(docs: list[tuple]) -> dict:
    out: dict = defaultdict(int)
    for _, text, source in docs:
        out[source] += len(words(text))
    return dict(out)


def edited(docs: list[tuple]) -> dict:
    """Per doc_id: characters and digest of the text with its last half replaced."""
    down = sorted(docs, key=lambda d: d[0], reverse=True)
    out = {}
    for k, (i, text) in enumerate(down):
        following = down[(k + 1) % len(down)][1] or ""
        text = text or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        out[i] = (len(text), hashlib.sha256(changed.encode()).hexdigest())
    return out


def vector_links(rows: list[tuple], cosine: float = 0.98) -> set[tuple]:
    """Rows (vec_id, n_links, component_id, kept) by comparing every pair."""
    good = {}
    for i, vector, label in rows:
        x = None if vector is None or None in vector else np.array(vector, dtype=np.float64)
        if i is not None and label is not None and x is not None and len(x) and np.isfinite(x).all() and x.any():
            good[i] = (label, x / np.sqrt((x * x).sum()))
    links = [
        (a, b)
        for a, b in itertools.combinations(sorted(good), 2)
        if good[a][0] == good[b][0]
        and len(good[a][1]) == len(good[b][1])
        and good[a][1] @ good[b][1] >= cosine
    ]
    ids = [i for i, *_ in rows if i is not None]
    least, n = grouped(links, ids), dict.fromkeys(ids, 0)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return {(i, n[i], least[i], least[i] == i) for i in ids}


def crc32(ids) -> int:
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def lower(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point makes a of b."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def spelling(docs: list[tuple], least: int = 2, ratio: int = 10) -> set[tuple]:
    """Rows (word, form, root, n, n_near, form_n), every pair of words compared."""
    n: dict = defaultdict(int)
    for i, text in docs:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += len(run) >= 7
    n = {w: c for w, c in n.items() if c >= least}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= ratio * n[w]:
            form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return out


def trie(turns: list[tuple]) -> set[tuple]:
    """Nodes of the rebuilt conversations, from rows (conv_id, turn, role, text)."""
    own: dict = defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            told = f"{len(role.encode())}:{role}{text}".encode()
            own[c].append((turn is not None, turn or 0, hashlib.md5(told).hexdigest(), role, text))
    own = {c: [x[3:] for x in sorted(rows)] for c, rows in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, rows in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = own.get(c - int(np.fmod(c, 5)), [])
        path = tuple(base[:h] + rows[h:])
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children: dict = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        size = len(path[-1][1].encode()) if path else 0
        below = children[path]
        leaves[path] = sum(leaves[x] for x in below) if below else 1
        saved[path] = (len(members[path]) - 1) * size + sum(saved[x] for x in below)
    return {
        (
            min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(children[p]), leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
        )
        for p, cs in members.items()
    }


def language_model(docs: list[tuple], gain: float = 1e-4) -> list[tuple]:
    """Per document its tokens, known ones, base score and score, n-grams counted in dictionaries."""
    texts = []
    for i, text in docs:
        fold = zlib.crc32(("" if i is None else str(i)).encode()) % 5
        texts.append((fold, [*words(lower(text or "")), None]))

    def counts(folds):
        c, n, known = defaultdict(int), 0, set()
        for fold, ws in texts:
            if fold in folds:
                known.update(ws)
                for k in range(len(ws)):
                    n += 1
                    v = ws[k - 1] if k else "\n"
                    u = ws[k - 2] if k > 1 else "\n"
                    for gram in ((ws[k],), (v, ws[k]), (u, v, ws[k])):
                        c[gram] += 1
                c["\n",] += 1
                c["\n", "\n"] += 1
        return c, n, len(known)

    def estimates(ws, c, n):
        for k, w in enumerate(ws):
            v = ws[k - 1] if k else "\n"
            u = ws[k - 2] if k > 1 else "\n"
            one, two = c.get((v,), 0), c.get((u, v), 0)
            yield (
                c.get((w,), 0) / max(1, n), c.get((v, w), 0) / max(1, one), c.get((u, v, w), 0) / max(1, two),
                one.bit_length(), two.bit_length(),
            )

    a, b, d = 0.5, [0.0] + [0.5] * 64, [0.0] + [0.5] * 64
    c, n, size = counts((0, 2, 3))
    learned_on = [e for fold, ws in texts if fold == 4 for e in estimates(ws, c, n)]
    last = None
    while learned_on:
        won = [[0.0] * 65 for _ in range(3)]
        of = [[0.0] * 65 for _ in range(3)]
        bits = 0.0
        for f1, f2, f3, k2, k3 in learned_on:
            p1 = a * f1 + (1 - a) / (size + 1)
            p2 = b[k2] * f2 + (1 - b[k2]) * p1
            p3 = d[k3] * f3 + (1 - d[k3]) * p2
            s1, s2, s3 = a * f1 / p1, b[k2] * f2 / p2, d[k3] * f3 / p3
            bits += np.log2(p3)
            for level, k, w, o in ((0, 0, (1 - s3) * (1 - s2) * s1, (1 - s3) * (1 - s2)), (1, k2, (1 - s3) * s2, 1 - s3), (2, k3, s3, 1)):
                won[level][k] += w
                of[level][k] += o
        bits /= len(learned_on)
        if last is not None and bits - last < gain:
            break
        last = bits

        def after(old, level, k):
            new = won[level][k] / of[level][k] if of[level][k] else old
            return min(max(round(new, 6), 1e-6), 1 - 1e-6)

        a = after(a, 0, 0)
        b = [0.0] + [after(b[k], 1, k) for k in range(1, 65)]
        d = [0.0] + [after(d[k], 2, k) for k in range(1, 65)]
    c, n, size = counts((0, 2, 3, 4))
    out = []
    for (i, _), (fold, ws) in zip(docs, texts, strict=True):
        base = sum(np.log10((c.get((w,), 0) + 0.5) / (n + 0.5 * (size + 1))) for w in ws)
        score = 0.0
        for f1, f2, f3, k2, k3 in estimates(ws, c, n):
            p1 = (a if n else 0) * f1 + (1 - (a if n else 0)) / (size + 1)
            p2 = b[k2] * f2 + (1 - b[k2]) * p1
            score += np.log10(d[k3] * f3 + (1 - d[k3]) * p2)
        out.append((i, fold == 1, len(ws), sum((w,) in c for w in ws), n, base, score))
    return out


def kd_tree(points, room, extents=None, leaf=0):
    """Leaf of every point (dims, mix, weight): sorted, and cut where it is nearest to the goal."""
    if not points:
        return {}
    if extents is None:
        columns = list(zip(*(p[0] for p in points), strict=True))
        extents = [max(1, max(c) - min(c)) for c in columns]
    if len(room) == 1:
        return {p[:2]: leaf for p in points}
    columns = list(zip(*(p[0] for p in points), strict=True))
    widths = [(max(c) - min(c)) / e for c, e in zip(columns, extents, strict=True)]
    dim = widths.index(max(widths))
    ordered = sorted(points, key=lambda p: (p[0][dim], p[1]))
    half = len(room) // 2
    goal = round(sum(p[2] for p in points) * (sum(room[:half]) / sum(room)))
    below, cut = 0, 0
    while below + ordered[cut][2] < goal:
        below += ordered[cut][2]
        cut += 1
    cut += below + ordered[cut][2] - goal <= goal - below
    left = kd_tree(ordered[:cut], room[:half], extents, 2 * leaf)
    return left | kd_tree(ordered[cut:], room[half:], extents, 2 * leaf + 1)
