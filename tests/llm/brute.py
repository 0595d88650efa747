"""Brute-force versions to hold the operators' results against."""

from __future__ import annotations

import numpy as np
import xxhash


def smallest_reachable(ids, links):
    best = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(best[a], best[b])
            if best[a] != low or best[b] != low:
                best[a] = best[b] = low
                changed = True
    return best


def simhash(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words)] if len(words) < 3 else [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(docs):
    fps = {i: simhash(t or "") for i, t in docs}
    keys = list(fps)
    links = [(a, b) for x, a in enumerate(keys) for b in keys[x + 1 :] if bin(fps[a] ^ fps[b]).count("1") <= 3]
    best = smallest_reachable(keys, links)
    return {i: (f"{fps[i]:016x}", best[i]) for i in keys}


def vector_links(rows, threshold=0.98):
    """rows: (id, vec, label). {id: (n_links, component, kept)}"""
    unit = {}
    for i, v, lab in rows:
        if lab is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        a = np.array(v, np.float64)
        unit[i] = (a / np.sqrt((a * a).sum()), lab)
    keys = list(unit)
    links = [(a, b) for x, a in enumerate(keys) for b in keys[x + 1 :] if unit[a][1] == unit[b][1] and len(unit[a][0]) == len(unit[b][0]) and float(unit[a][0] @ unit[b][0]) >= threshold]
    best = smallest_reachable([r[0] for r in rows], links)
    n = {r[0]: 0 for r in rows}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return {i: (n[i], best[i], best[i] == i) for i in n}


def repeated_spans(texts, width=200):
    """{id: maximal removed runs} of bytes under a width-byte string that starts at two places."""
    seen = {}
    for i, t in texts:
        for a in range(len(t) - width + 1):
            seen.setdefault(t[a : a + width], []).append((i, a))
    out = {i: [] for i, _ in texts}
    for places in seen.values():
        if len(places) > 1:
            for i, a in places:
                out[i].append((a, a + width))
    merged = {}
    for i, spans in out.items():
        runs = []
        for a, b in sorted(spans):
            if runs and a <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], b)
            else:
                runs.append([a, b])
        merged[i] = [tuple(r) for r in runs]
    return merged
