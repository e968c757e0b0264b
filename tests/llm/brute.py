"""Plain versions of the operators for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def repeats(rows, length=400):
    """{id: (bytes, removed, runs, sha of the rest)}; ids are unique."""
    seen = Counter()
    for _, text in rows:
        raw = (text or "").encode()
        seen.update(raw[s:s + length] for s in range(len(raw) - length + 1))
    out = {}
    for i, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if seen[raw[s:s + length]] > 1:
                gone[s:s + length] = b"\1" * length
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        out[i] = (len(raw), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), sha(kept))
    return out


def shared_words(rows, size=51):
    """{id: words in passages of `size` words that a text with another id has too}; ids are unique."""
    words = {i: WORD.findall(t or "") for i, t in rows}
    owners = {}
    for i, w in words.items():
        for s in range(len(w) - size + 1):
            owners.setdefault(tuple(w[s:s + size]), set()).add(i)
    out = {}
    for i, w in words.items():
        hit = bytearray(len(w))
        for s in range(len(w) - size + 1):
            if len(owners[tuple(w[s:s + size])]) > 1:
                hit[s:s + size] = b"\1" * size
        out[i] = sum(hit)
    return out


def shingles(text, size):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def components(rows, size, threshold):
    """{id: smallest id reachable}; ids are unique."""
    sets = [(i, shingles(t, size)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, (i, a) in enumerate(sets):
        for j, b in sets[n + 1:]:
            if a and b and 100 * len(a & b) >= threshold * len(a | b):
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    return {i: top(i) for i in parent}


def url_parts(url):
    """Host, path and the tokens of a whole url."""
    lower = {c: c + 32 for c in range(65, 91)}
    if url is None or "://" not in url:
        return "", "", frozenset()
    scheme, rest = url.split("://", 1)
    host = re.match(r"[^/?#]*", rest).group().translate(lower)
    path = re.match(r"[^/?#]*([^?#]*)", rest).group(1)
    query = re.match(r"[^?#]*(?:\?([^#]*))?", rest).group(1) or ""
    fragment = rest.split("#", 1)[1] if "#" in rest else ""
    out = [("s", scheme.translate(lower))] + [("h", x) for x in host.split(".")] + [("p", x) for x in path.split("/")]
    for pair in re.split("[&;]", query):
        name, _, value = pair.partition("=")
        out += [("q", name), ("v", value)]
    out += [("f", x) for x in re.split("[/?&=]", fragment)]
    return host, path, frozenset(x for x in out if x[1])


def url_verdicts(pages, labels, rules, min_pages, min_confidence=0.8):
    """{id: (host, path, rule, verdict)}; ids and labels are unique."""
    known = {i: q == 0 or t == 1 for i, q, t in labels if q is not None or t is not None}
    seen = {i: url_parts(u) for i, u in pages}
    labelled = [(seen[i][2], bad) for i, bad in known.items() if i in seen and seen[i][2]]
    counts = Counter(t for tokens, bad in labelled if bad for t in tokens)
    often = {t for t, n in counts.items() if n >= min_pages}
    sets = Counter()
    for tokens, bad in labelled:
        of = sorted(tokens & often)
        sets.update((frozenset(t for j, t in enumerate(of) if m >> j & 1), bad) for m in range(1, 1 << len(of)))
    mined = [s for s, bad in sets if bad and sets[s, True] >= min_pages
             and sets[s, True] / (sets[s, True] + sets[s, False]) >= min_confidence]
    out = {}
    for i, (host, path, tokens) in seen.items():
        fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, name, verdict = max(fits, default=(0, None, None))
        out[i] = host, path, name, verdict or ("block" if any(s <= tokens for s in mined) else "allow")
    return out


def lines(rows, min_sites):
    """{id: text without boilerplate}."""
    sites, first = {}, {}
    for i, site, text in rows:
        for line in (text or "").split("\n"):
            if WORD.search(line):
                sites.setdefault(line, set()).add(site)
                first[line] = min(i, first.get(line, i))
    drop = {line for line, s in sites.items() if len(s) >= min_sites}
    return {
        i: None if text is None else "\n".join(x for x in text.split("\n") if x not in drop or first[x] == i)
        for i, _, text in rows
    }


def _xx(seed, *values):
    """Spark's xxhash64 of strings, longs and booleans; nulls leave the hash as it is."""
    for v in values:
        if v is None:
            continue
        raw = v.encode() if isinstance(v, str) else int(v).to_bytes(4 if isinstance(v, bool) else 8, "little", signed=True)
        seed = xxhash.xxh64_intdigest(raw, seed=seed % 2**64)
    return seed - 2**64 if seed >= 2**63 else seed


def shards(rows, n, per_shard):
    """{id: (size, shard, slot)}; ids are unique.  Units one after the other, by the largest dot product."""
    facts, groups = [], {}
    for i, text in rows:
        g = _xx(42, text, text is None)
        v = (len((text or "").encode()) + 8, len(WORD.findall(text or "")), 1)
        facts.append((i, g, v, zlib.crc32((text or "").encode())))
        groups[g] = tuple(map(sum, zip(groups.get(g, (0, 0, 0)), v)))
    total = [sum(v[d] for v in groups.values()) for d in range(3)]
    most = [max(1.0, t / (n * per_shard)) for t in total]
    units = {}
    for fact in facts:
        weight = max(x / m for x, m in zip(groups[fact[1]], most))
        if weight > 1:
            name = f"g:{fact[1]}:{_xx(42, fact[0], 'piece') % math.ceil(weight)}"
        else:
            name = f"u:{fact[1] % (n * per_shard)}"
        units.setdefault(name, []).append(fact)
    sums = {u: [sum(f[2][d] for f in fs) * n / total[d] if total[d] else 0.0 for d in range(3)] for u, fs in units.items()}
    room = [[1.0 if t else 0.0 for t in total] for _ in range(n)]
    offset, out, of = [0] * n, {}, {}
    for u in sorted(sorted(units), key=lambda u: -max(sums[u])):
        scores = [sum(a * b for a, b in zip(r, sums[u])) for r in room]
        # Sums of products in another order may differ in the last places.
        of[u] = next(s for s, x in enumerate(scores) if x >= max(scores) - 1e-12)
        room[of[u]] = [a - b for a, b in zip(room[of[u]], sums[u])]
    for u in sorted(units):
        for k, (i, g, v, crc) in enumerate(sorted(units[u], key=lambda f: (f[1], f[0], f[2][0], f[3]))):
            out[i] = v[0], of[u], offset[of[u]] + k
        offset[of[u]] += len(units[u])
    return out
