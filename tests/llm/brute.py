"""Plain versions of the corpus operators, for small inputs."""

import collections
import hashlib
import re
import zlib

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def suffix_dedup(docs, length=200):
    data = {d: (t or "").encode() for d, t in docs}
    count = collections.Counter(b[i : i + length] for b in data.values() for i in range(len(b) - length + 1))
    out = {}
    for d, b in data.items():
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[d] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


def substring_dedup(docs, length=50):
    words = {d: WORD.findall(t or "") for d, t in docs}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - length + 1):
            first.setdefault(tuple(words[d][i : i + length]), d)
    out = {}
    for d, w in words.items():
        gone = [0] * len(w)
        for i in range(len(w) - length + 1):
            if first[tuple(w[i : i + length])] < d:
                gone[i : i + length] = [1] * length
        out[d] = (len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest())
    return out


def shingles(text, size):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in (text or "")))
    return [" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] if len(w) >= size else [" ".join(w)] if w else []


def fingerprint(text, size=3):
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles(text, size)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, linked):
    parent = {d: d for d in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(ids)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def simhash(docs):
    prints = {d: fingerprint(t) for d, t in docs}
    roots = components(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    return {d: (f"{prints[d]:016x}", roots[d]) for d in prints}


def packed(rows, width=2048):
    """rows: (doc_id, ids with the end id, place in the sequence of all)."""
    out = []
    for d, ids, at in rows:
        i = 0
        while i < len(ids):
            n = min(len(ids) - i, width - (at + i) % width)
            crc = zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[i : i + n]))
            out.append((d, i, n, crc, len(ids), (at + i) // width, (at + i) % width))
            i += n
    return out


def quality_base(text):
    t = text or ""
    words = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    seen = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + j for i in range(len(words) - 4) if seen[tuple(words[i : i + 5])] > 1 for j in range(5)}
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n


def phrases(rows, longest=3, least=10, share=50, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text) rows."""
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = tuple(w for w in re.split(r"[\x20\x09]+", piece) if w)
            totals[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    counts[lang][words[i : i + m]] += 1
    out = []
    for lang, f in counts.items():
        found = []
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        for p, a in candidates.items():
            inside = [q for q, n in candidates.items() if len(q) > len(p) and 100 * n >= share * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not inside:
                cut = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-cut[0], -a, " ".join(p).encode(), f[p[: cut[1]]], f[p[cut[1] :]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def divergence(rows, least=3, top=200):
    """(lang, source, part, item, value, rank) of (lang, source, text) rows."""
    terms = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for lang, source, text in rows]
    held = collections.Counter((lang, t) for lang, _, found in terms for t in set(found))
    count = collections.defaultdict(collections.Counter)
    for lang, source, found in terms:
        count[lang, source].update(t for t in found if held[lang, t] >= least)
    out = []
    for lang, source in count:
        kept = [t for (x, t), n in held.items() if x == lang and n >= least]
        mine = {s: c for (x, s), c in count.items() if x == lang}
        whole = sum(mine.values(), collections.Counter())
        p = {s: {t: 1 + 1000000000 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept} for s, c in [*mine.items(), (None, whole)]}
        f = lambda t, other: (p[source][t] - p[other][t]) ** 2 // p[other][t]  # noqa: B023, E731
        pairs = [(-sum(f(t, o) for t in kept), o.encode()) for o in mine if o != source]
        best = [(-f(t, None), t.encode()) for t in kept if count[lang, source][t] and p[source][t] > p[None][t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(best)[:top])):
            out += [(lang, source, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(found, 1)]
    return sorted(out)
