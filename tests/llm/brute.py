"""Plain versions of the operators, over lists of (doc_id, text)."""

import collections
import hashlib
import math
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(raw):
    return hashlib.sha256(raw if isinstance(raw, bytes) else raw.encode()).hexdigest()


def jaccard(docs, k, t):
    sets = []
    for _, x in docs:
        w = WORD.findall((x or "").translate(LOWER))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    parent = list(range(len(docs)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= t * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(docs)), key=str)


def contamination(docs, items):
    grams = collections.defaultdict(set)
    for name, x in items:
        w = ITEM.findall((x or "").translate(LOWER))
        if w:
            k = min(13, len(w))
            for i in range(len(w) - k + 1):
                grams[tuple(w[i : i + k])].add("" if name is None else str(name))
    out = []
    for d, x in docs:
        w = ITEM.findall((x or "").translate(LOWER))
        hit, names = set(), set()
        for k in {len(g) for g in grams}:
            for i in range(len(w) - k + 1):
                g = tuple(w[i : i + k])
                if g in grams:
                    hit |= set(range(i, i + k))
                    names |= grams[g]
        out.append((d, len(w), len(hit), len(names), sha(",".join(sorted(names))), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def language(train, texts, buckets, temper=32):
    """(language, score) of each text by naive Bayes over dictionaries of n-grams; train: (text, lang)."""

    def grams(text):
        t = re.sub(r"[\x00-\x40\x5b-\x60\x7b-\x7f]", " ", text.translate(LOWER))
        return [t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)]

    langs = sorted({g for _, g in train})
    seen = {g: collections.Counter() for g in langs}
    rows = collections.Counter(g for _, g in train)
    for t, g in train:
        seen[g].update(grams(t))
    size = {g: sum(seen[g].values()) for g in langs}
    out = []
    for t in texts:
        if t is None or not any(c.isalpha() for c in t):
            out.append(("und", 0.0))
            continue
        x = grams(t)
        logs = [math.log(rows[g] / len(train)) + sum(math.log((seen[g][y] + 0.5) / (size[g] + 0.5 * buckets)) for y in x) for g in langs]
        z = [math.exp((v - max(logs)) * min(len(x), temper) / len(x)) for v in logs]
        out.append((langs[logs.index(max(logs))], max(z) / sum(z)))
    return out


def secrets_base(text):
    """Base spans over code points, as the contract words them: (counts, digest)."""
    found = []
    for rank, (kind, pattern, least) in enumerate((("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6), ("access", "AKIA[A-Z0-9]+", 20), ("hex", "[0-9a-f]+", 24))):
        for m in re.finditer(pattern, text or ""):
            if len(m.group(2) if kind == "assign" else m.group()) >= least:
                found.append((m.start(), rank, kind, m.end()))
    found.sort()
    return [sum(x[2] == k for x in found) for k in ("assign", "access", "hex")], sha(",".join(f"{k}:{a}:{b}" for a, _, k, b in found))


def shots(payload, frame=4096, look_back=8):
    """First frames of shots: each block's transform by its formula, histograms, adaptive threshold."""
    order = sorted(((i, j) for i in range(8) for j in range(8)), key=lambda c: (c[0] + c[1], c[0] if (c[0] + c[1]) % 2 else c[1]))
    c = [[round(1024 * math.cos((2 * x + 1) * k * math.pi / 16) * (math.sqrt(0.5) if k == 0 else 1.0)) for x in range(8)] for k in range(8)]
    histograms = []
    for a in range(0, len(payload), frame):
        h = collections.Counter()
        for b in range(a, min(a + frame, len(payload)), 64):
            v = [[0] * 8 for _ in range(8)]
            for (i, j), x in zip(order, payload[b : b + 64]):
                v[i][j] = x if x >= 128 else x - 255
            half = [[sum(v[i][j] * c[j][x] for j in range(8)) for x in range(8)] for i in range(8)]
            for y in range(8):
                for x in range(8):
                    s = sum(half[i][x] * c[i][y] for i in range(8))
                    h[min(255, max(0, (s + (1 << 21) >> 22) + 128))] += 1
        n = sum(h.values())
        histograms.append({k: x / n for k, x in h.items()})
    diff = [sum(abs(a.get(k, 0) - b.get(k, 0)) for k in set(a) | set(b)) / 2 for a, b in zip(histograms, histograms[1:])]
    cuts = [0]
    for t, d in enumerate(diff):
        before = diff[max(0, t - look_back) : t]
        mean = sum(before) / len(before) if before else 0
        least = max(0.25, mean + 3 * math.sqrt(sum((x - mean) ** 2 for x in before) / len(before))) if before else 0.25
        if d > least:
            cuts.append(t + 1)
    return cuts, len(histograms)


def suffixes(docs, k):
    raw = [(x or "").encode() for _, x in docs]
    seen = collections.Counter(t[i : i + k] for t in raw for i in range(len(t) - k + 1))
    out = []
    for (d, _), t in zip(docs, raw):
        gone = bytearray(len(t))
        for i in range(len(t) - k + 1):
            if seen[t[i : i + k]] > 1:
                gone[i : i + k] = b"\1" * k
        out.append((d, len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(bytes(c for c, g in zip(t, gone) if not g))))
    return sorted(out, key=str)


def shared(docs, k):
    """Bytes of each text in k-byte strings that also start in another one."""
    raw = [(x or "").encode() for _, x in docs]
    owners = collections.defaultdict(set)
    for j, t in enumerate(raw):
        for i in range(len(t) - k + 1):
            owners[t[i : i + k]].add(j)
    out = []
    for (d, _), t in zip(docs, raw):
        hit = set()
        for i in range(len(t) - k + 1):
            if len(owners[t[i : i + k]]) > 1:
                hit.update(range(i, i + k))
        out.append((d, len(hit)))
    return sorted(out, key=str)


def substrings(docs, k):
    least = {}
    words = [(d, WORD.findall(x or "")) for d, x in docs]
    big = float("inf")
    for d, w in words:
        for i in range(len(w) - k + 1):
            g = tuple(w[i : i + k])
            least[g] = min(least.get(g, big), big if d is None else d)
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - k + 1):
            if least[tuple(w[i : i + k])] < (big if d is None else d):
                gone |= set(range(i, i + k))
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return sorted(out, key=str)


def edited(docs):
    """(doc_id, text, edited text, next text) in descending order; ties by the text's 64-bit hash."""
    import xxhash

    def key(row):
        h = xxhash.xxh64((row[1] or "").encode(), seed=42).intdigest()
        return (row[0] is not None, row[0] or 0, h - (1 << 64) if h >> 63 else h)

    rows = [(d, t or "") for d, t in sorted(docs, key=key, reverse=True)]
    out = []
    for i, (d, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        out.append((d, t, t[: len(t) - half] + after[:half], after))
    return out


def shingles(text, k=5):
    w = WORD.findall(text.translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def contained(a, b):
    return (len(a & b) / len(a), len(a & b) / len(a | b)) if a and b else (float(len(a) == len(b)),) * 2


def trie(rows, every=20, heads=4):
    """Nodes of the trie of rebuilt conversations; rows: (conv_id, turn, role, text)."""
    import zlib

    turns = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            turns[c].append(((t is not None, t or 0), sha(f"{len(r)}:{r}{x}"), r, x))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    made = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % heads
        made[c] = turns.get(c - int(math.fmod(c, every)), [])[:h] + own[h:]
    members = collections.defaultdict(list)
    for c, line in sorted(made.items()):
        for d in range(len(line) + 1):
            members[tuple(line[:d])].append(c)
    below = {n: [m for m in members if m[: len(n)] == n] for n in members}
    leaf = {n: not any(len(m) == len(n) + 1 for m in below[n]) for n in members}
    out = []
    for n, cs in members.items():
        saved = sum((len(members[m]) - 1) * len(WORD.findall(m[-1][1])) for m in below[n] if m)
        ends = ",".join(str(c) for c in cs if len(made[c]) == len(n))
        up = members[n[:-1]][0] if n else None
        out.append((cs[0], len(n), up, len(cs), sum(len(m) == len(n) + 1 for m in below[n]), sum(leaf[m] for m in below[n]), saved, sha(ends)))
    return sorted(out, key=str)


def clusters(rows, k=16, rounds=3, dims=64, scale=64, seed=1):
    """Full Lloyd rounds over Python integers; rows: (vec_id, vector)."""
    fine = [(v, [math.floor(scale * x) for x in e]) for v, e in rows if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) and abs(scale * x) < 1 << 27 for x in e)]
    order = sorted(fine, key=lambda r: (r[0] is None, sha(f"{seed}:{r[0]}") if r[0] is not None else "", r[1]))
    centroids = [q for _, q in order[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for at in range(rounds + 1):
        owner = [min((far(q, c), i) for i, c in enumerate(centroids)) for _, q in fine]
        if at < rounds:
            for i in range(len(centroids)):
                mine = [q for (_, q), (_, o) in zip(fine, owner) if o == i]
                if mine:
                    centroids[i] = [sum(col) // len(mine) for col in zip(*mine)]
    per = collections.Counter()
    for d, i in owner:
        per[i] += d
    names = [sha(",".join(map(str, c))) for c in centroids]
    return sorted(((v, i, d, per[i], sum(per.values()), names[i]) for (v, _), (d, i) in zip(fine, owner)), key=str)
