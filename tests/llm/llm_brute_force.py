"""Plain versions that several tests compare with."""

import xxhash


def fingerprint(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    votes = [0] * 64
    for shingle in shingles:
        h = xxhash.xxh64_intdigest(shingle, 42)
        for bit in range(64):
            votes[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * votes[bit] > len(shingles))


def components(prints, radius):
    top = {i: i for i in prints}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = root(a), root(b)
                top[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}
