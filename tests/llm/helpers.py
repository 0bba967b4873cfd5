"""Brute-force versions of the operators for small inputs."""

import collections
import hashlib
import re
import zlib

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes(range(65, 91)), bytes(range(97, 123))


def words(text, lower=False):
    raw = (text or "").encode()
    if lower:
        raw = raw.translate(bytes.maketrans(*LOWER))
    return WORD.findall(raw)


def shingles(text, k=5):
    w = words(text, True)
    if not w:
        return set()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}


def jaccard_components(rows):
    """{doc_id: (set size, smallest doc_id reachable)}; rows are (doc_id, text) with different ids."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if sets[a] and sets[b] and min(len(sets[a]), len(sets[b])) * 5 >= 4 * max(len(sets[a]), len(sets[b])):
                inter = len(sets[a] & sets[b])
                if 100 * inter >= 80 * (len(sets[a]) + len(sets[b]) - inter):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def removed_windows(rows, window=35):
    """[(doc_id, words, removed, sha256 of the rest)] in the order of rows."""
    split = [words(t) for _, t in rows]
    count = collections.Counter(tuple(w[k:k + window]) for w in split for k in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, split):
        gone = bytearray(len(w))
        for k in range(len(w) - window + 1):
            if count[tuple(w[k:k + window])] > 1:
                gone[k:k + window] = b"\1" * window
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climbed(nodes, fan=3):
    """(top, [(left, right) siblings from bottom to top] per node)."""
    paths, cover = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        tops, covers = [], []
        for a in range(0, len(nodes), fan):
            run = nodes[a:a + fan]
            for k in range(len(run)):
                for leaf in cover[a + k]:
                    paths[leaf].append(("".join(run[:k]), "".join(run[k + 1:])))
            tops.append(H(*run))
            covers.append(sum(cover[a:a + fan], []))
        nodes, cover = tops, covers
    return nodes[0], paths


def manifest_rows(rows):
    """[(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)]; rows: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0], H(*map(encoded, r)), r))
    subs, found = [], []
    for source in sorted(groups, key=lambda x: (x is not None, (x or "").encode())):
        leaves = sorted(groups[source], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        sub, paths = climbed([x[1] for x in leaves])
        subs.append(sub)
        found.append((leaves, paths))
    if not subs:
        return []
    root, up = climbed(subs)
    out = []
    for (leaves, paths), sub, above in zip(found, subs, up):
        for (i, leaf, r), path in zip(leaves, paths):
            node = leaf
            if i is not None and zlib.crc32(str(i).encode()) % 2 == 0 and r[4] is not None:
                node = H(*map(encoded, (*r[:4], r[4].replace("\n", ""))))
            for left, right in path + above:
                node = H(left, node, right)
            out.append((i, leaf, sub, root, H(*[a + b for a, b in path + above]), node, node == root))
    return out


def trie_rows(rows):
    """[(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)]; rows: (conv_id, turn, role, text)."""
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, role or "", hashlib.sha256(
                f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest(), text or ""))
    own = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in own.items()}
    nodes = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seq = tuple(own.get(c - c % 20, [])[:h] + v[h:])
        for d in range(len(seq) + 1):
            nodes.setdefault(seq[:d], []).append((c, d == len(seq)))
    first = {p: min(c for c, _ in m) for p, m in nodes.items()}
    children = collections.Counter(p[:-1] for p in nodes if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in nodes.items():
        gain = (len(m) - 1) * len(words(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += gain
    return [(first[p], len(p), first[p[:-1]] if p else None, len(m), children[p], leaves[p], saved[p],
             H(",".join(str(c) for c in sorted(c for c, end in m if end)))) for p, m in nodes.items()]
