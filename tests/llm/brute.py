"""Plain versions of the document operators, for small inputs."""

import collections
import hashlib
import math
import re
import zlib

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AZ = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(s):
    return hashlib.sha256(s.encode() if isinstance(s, str) else s).hexdigest()


def words(t):
    return WORD.findall((t or "").translate(AZ))


def luhn(x):
    total = 0
    for i, c in enumerate(reversed(x)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def digits(m):
    return re.sub("[^0-9]", "", m)


PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
}


def pii(t):
    return [f"{k}:{m.start()}:{m.end()}" for k, (p, ok) in PII.items() for m in re.finditer(p, t or "") if ok(m[0])]


def secrets(t):
    t = t or ""
    found = [("assign", m) for m in re.finditer(
        r"""(?ai:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[1]) >= 6]
    found += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    found += [("hex", m) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    order = ["assign", "access", "hex"]
    return [f"{k}:{m.start()}:{m.end()}" for k, m in sorted(found, key=lambda x: (x[1].start(), order.index(x[0])))]


def contamination(docs, items):
    grams = {}
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            grams.setdefault(tuple(w[k:k + n]), set()).add(str(i))
    sizes, out = {len(k) for k in grams}, []
    for d, t in docs:
        w = words(t)
        hit, names = [0] * len(w), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (g := tuple(w[k:k + n])) in grams:
                    hit[k:k + n] = [1] * n
                    names |= grams[g]
        out.append((d, len(w), sum(hit), len(names), sha(",".join(sorted(names))), any(hit)))
    return out


def repeats(docs, length=400):
    raw = [(d, (t or "").encode()) for d, t in docs]
    count = collections.Counter(b[i:i + length] for _, b in raw for i in range(len(b) - length + 1))
    out = []
    for d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), len(re.findall(b"\1+", gone)), sha(kept)))
    return out


def near(docs, similarity=0.8):
    """(id, least id of the class, class size, links) by all pairs."""
    sets = []
    for _, t in docs:
        w = words(t)
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    parent, links = list(range(len(docs))), [0] * len(docs)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and both >= similarity * (len(a) + len(sets[j]) - both) - 1e-9:
                links[i] += 1
                links[j] += 1
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    groups = collections.defaultdict(list)
    for i, (d, _) in enumerate(docs):
        groups[root(i)].append(d)
    return [(d, min(groups[root(i)]), len(groups[root(i)]), links[i]) for i, (d, _) in enumerate(docs)]


def targets(size_of, share=1.5, cap=2.0):
    """Targets by resharing the excess until no source is above its cap."""
    names = sorted((s for s in size_of if s is not None)) + [None] * (None in size_of)
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    left, free, out = share * sum(size_of.values()), set(names), {}
    while free:
        level = left / sum(weight[n] for n in free)
        over = [n for n in free if level * weight[n] > cap * size_of[n] + 1e-9]
        if not over:
            return out | {n: level * weight[n] for n in free}
        for n in over:
            out[n] = cap * size_of[n]
            left -= out[n]
            free.discard(n)
    return out


def one_edit(a, b):
    """Whether two words differ by exactly one inserted, deleted or replaced letter."""
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def spelling(docs, typo_every=97, min_length=5, min_count=3):
    """(word, form, root, n, n_near, form_n) by comparing all words."""
    counts = collections.Counter()
    for d, t in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(AZ)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if typo_every and h % typo_every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    n = {w: c for w, c in counts.items() if len(w) >= min_length and c >= min_count}
    at = collections.defaultdict(set)
    for w in n:
        for x in [w, *(w[:i] + w[i + 1:] for i in range(len(w)))]:
            at[x].add(w)
    near = {w: {v for x in [w, *(w[:i] + w[i + 1:] for i in range(len(w)))] for v in at[x] if one_edit(w, v)} for w in n}
    form = {}
    for w, c in n.items():
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * c else None
    out = []
    for w, c in n.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, c, len(near[w]), n[form[w]] if form[w] else None))
    return out


def hard_negatives(rows, anchor, scale=256, positives=5, negatives=5):
    """(anchor, positive, rank, negative, positive score, negative score) of
    (id, vector, label) rows by scoring all pairs."""
    def usable(v, label):
        return label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ready = [(i, [math.floor(scale * float(x)) for x in v], label) for i, v, label in rows if usable(v, label)]

    def order(x):
        return -x[0], x[1] is None, x[1] or 0
    out = []
    for a, (i, v, label) in enumerate(ready):
        if not anchor(i):
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), j, m == label) for b, (j, w, m) in enumerate(ready) if a != b]
        for s, p, _ in sorted((x for x in scored if x[2]), key=order)[:positives]:
            hard = sorted((x for x in scored if not x[2] and 80 * s <= 100 * x[0] <= 100 * s), key=order)[:negatives]
            out += [(i, p, r, j, s, t) for r, (t, j, _) in enumerate(hard, 1)]
    return out
