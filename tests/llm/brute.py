"""Plain versions of what the operators compute, over lists in memory."""

from __future__ import annotations

import numpy as np
import xxhash


def components(nodes, links):
    """The smallest node that each node reaches."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def fingerprint(text: str | None, size: int = 3) -> int:
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for bit in range(64):
            counts[bit] += h >> bit & 1
    return sum((2 * c > len(shingles)) << bit for bit, c in enumerate(counts))


def near(prints: dict[int, int], most: int):
    ids = list(prints)
    return [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (prints[a] ^ prints[b]).bit_count() <= most]


def cosine_links(vectors: dict[int, list[float]], labels: dict[int, object], threshold: float):
    ids = list(vectors)
    out = []
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if labels[a] is None or labels[a] != labels[b] or len(vectors[a]) != len(vectors[b]):
                continue
            x, y = np.array(vectors[a], float), np.array(vectors[b], float)
            if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                out.append((a, b))
    return out


def mixed(docs: list[tuple[int, str, str]], limit: float) -> list[int]:
    """Ids of ``(id, source, text)``, each as often as temperature mixing repeats it."""
    import hashlib
    import math
    from collections import defaultdict

    tokens = {i: -(-len(text.encode()) // 4) for i, _, text in docs}
    members = defaultdict(list)
    for i, source, _ in docs:
        members[source].append(i)
    total = {s: sum(tokens[i] for i in ids) for s, ids in members.items()}
    share = {s: t / sum(total.values()) for s, t in total.items()}
    spread = max(share.values()) / min(share.values())
    a = next(k / 1e6 for k in range(1_000_001) if spread ** (1 - k / 1e6) <= limit * (1 + 1e-12))
    z = sum(p**a for p in share.values())
    budget = sum(total.values()) * z * max(share.values()) ** (1 - a)
    out = []
    for s, ids in members.items():
        quota = max(total[s], math.floor(budget * share[s] ** a / z + 1e-6))
        passes, rest = divmod(quota, total[s])
        out += ids * passes

        def draw(i, passes=passes):
            return int(hashlib.md5(f"0|{passes}|{i}".encode()).hexdigest()[:10], 16)

        for i in sorted(ids, key=lambda i: (draw(i), i)):
            rest -= tokens[i]
            if rest < 0:
                break
            out.append(i)
    return sorted(out)
