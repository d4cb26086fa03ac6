"""Plain versions of the operators' contracts over a list of (doc_id, text)."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LEAST = -(1 << 63)


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def low_id(i):
    return LEAST if i is None else i


def pii(text):
    spans = []
    for k, (name, pattern) in enumerate(PII.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if name == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            doubled = sum(int(d) if i % 2 == 0 else sum(divmod(int(d) * 2, 10)) for i, d in enumerate(digits[::-1]))
            if name == "card" and (not 12 <= len(digits) <= 19 or doubled % 10):
                continue
            if name == "phone" and not 9 <= len(digits) <= 15:
                continue
            spans.append((m.start(), k, m.end(), name))
    spans.sort()
    return Counter(s[3] for s in spans), ",".join(f"{n}:{s}:{e}" for s, _, e, n in spans)


def decontaminate(rows, items, n=13):
    windows = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall((text or "").translate(AZ))
        for i in range(max(1, len(w) - n + 1) if w else 0):
            windows[tuple(w[i : i + n])].add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in rows:
        w, hit, found = ALNUM.findall((text or "").translate(AZ)), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                got = windows.get(tuple(w[i : i + size]))
                if got:
                    hit.update(range(i, i + size))
                    found |= got
        out.append((doc_id, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def substrings(rows, n=13):
    texts = [(i, WORD.findall(t or "")) for i, t in rows]
    least = {}
    for i, w in texts:
        for j in range(len(w) - n + 1):
            key = tuple(w[j : j + n])
            least[key] = min(least.get(key, 1 << 63), low_id(i))
    out = []
    for i, w in texts:
        gone = [False] * len(w)
        for j in range(len(w) - n + 1):
            if least[tuple(w[j : j + n])] < low_id(i):
                gone[j : j + n] = [True] * n
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def shingles(text, k=5):
    w = WORD.findall((text or "").translate(AZ))
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[j : j + k]) for j in range(len(w) - k + 1)}


def jaccard(rows, share=75):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= share * (len(sets[a]) + len(sets[b]) - common):
                root[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        least[find(a)] = min(least.get(find(a), 1 << 63), low_id(i))
    shown = [least[find(a)] for a in range(len(rows))]
    return [(i, len(sets[a]), None if shown[a] == LEAST else shown[a]) for a, (i, _) in enumerate(rows)]


def factors(rows, n=200, keep_first=False):
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(w[j : j + n] for _, w in texts for j in range(len(w) - n + 1))
    order = sorted(range(len(texts)), key=lambda a: low_id(texts[a][0]))
    seen, out = set(), [None] * len(texts)
    for a in order:
        i, w = texts[a]
        gone = bytearray(len(w))
        for j in range(len(w) - n + 1):
            x = w[j : j + n]
            if (x in seen) if keep_first else count[x] > 1:
                gone[j : j + n] = b"\1" * n
            seen.add(x)
        kept = bytes(c for c, g in zip(w, gone) if not g)
        out[a] = (i, len(w), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept))
    return out


def quality(rows):
    """Base counts and base_failed of (doc_id, text)."""
    out = []
    for i, text in rows:
        text = text or ""
        w = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        count = Counter(tuple(w[j : j + 3]) for j in range(len(w) - 2))
        again = {p for j in range(len(w) - 2) if count[tuple(w[j : j + 3])] > 1 for p in (j, j + 1, j + 2)}
        out.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
                    len(again), len(w) < 50 or 100 * len(again) > 50 * len(w)))
    return out


def merkle(rows, fanout=8):
    """rows: (doc_id, source, lang, n_chars, text); rows of the manifest's contract."""

    def leaf(row):
        return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))

    def tree(leaves):
        """The node that remains, and for each leaf the siblings (left, right) of each level."""
        steps, groups, nodes = [[] for _ in leaves], [[i] for i in range(len(leaves))], list(leaves)
        while len(nodes) > 1:
            new_groups, new_nodes = [], []
            for at in range(0, len(nodes), fanout):
                run = nodes[at : at + fanout]
                for j in range(len(run)):
                    for i in groups[at + j]:
                        steps[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
                new_groups.append([i for g in groups[at : at + fanout] for i in g])
                new_nodes.append(sha("".join(run)))
            groups, nodes = new_groups, new_nodes
        return nodes[0] if nodes else None, steps

    parts = defaultdict(list)
    for r in rows:
        parts[r[2]].append((low_id(r[0]), leaf(r), r))
    names = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    below = {p: (sorted(parts[p], key=lambda x: x[:2]), *tree([x[1] for x in sorted(parts[p], key=lambda x: x[:2])])) for p in names}
    root, above = tree([below[p][1] for p in names])
    out = []
    for p, top in zip(names, above):
        leaves, subroot, steps = below[p]
        for (_, h, row), path in zip(leaves, steps):
            path = path + top
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None
            node = leaf((*row[:4], row[4].translate(AZ))) if changed else h
            for left, right in path:
                node = sha(left + node + right)
            out.append((row[0], h, subroot, root, sha("".join(x + y for x, y in path)), node, node == root))
    return out


def alignment(rows, encode_a, encode_b):
    """encode_*: text -> [(id, bytes)]; rows of the alignment's contract."""
    held, found = Counter(), []
    for doc_id, text in rows:
        a, b = (encode_a(text), encode_b(text)) if text else ([], [])
        whole = b" " + (text or "").encode()
        if not text or b"".join(t for _, t in a) != whole or b"".join(t for _, t in b) != whole:
            found.append((doc_id, [], []))
            continue
        ends = []
        for side in (a, b):
            at, places = 0, []
            for _, t in side:
                at += len(t)
                places.append(at)
            ends.append(places)
        shared = sorted(set(ends[0]) & set(ends[1]))
        groups, low = [], 0
        for high in shared:
            groups.append(tuple([i for (i, _), e in zip(side, places) if low < e <= high] for side, places in zip((a, b), ends)))
            low = high
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        held.update(set(links))
        found.append((doc_id, groups, links))
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    return [
        (i, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links),
         sum(held[l] == best[l[0]] for l in links), sum(held[l] for l in links),
         sha(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)) if groups else "")
        for i, groups, links in found
    ]
