"""Content-chosen anchors in texts, so that long common stretches meet at one.

For stretches of ``span`` characters and grams of ``gram`` < span, each window of ``span`` characters
names one of its span - gram + 1 grams, the one of the smallest hash (the leftmost on a tie). What it
names depends on the window alone, so two texts with a common stretch of ``span`` characters have a
gram in common that both name, wherever the stretch stands. A text of n characters names about
2 n / (span - gram + 2) grams.
"""

from __future__ import annotations

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Characters hashed as one array; a longer text is taken in pieces that overlap by a span.
PIECE = 1 << 21

_POWERS: dict = {}


def _powers(n: int):
    """Powers of the base and of its inverse modulo 2^64, kept for the worker."""
    import numpy as np

    if len(_POWERS.get("up", ())) < n:
        for name, b in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def mix(x):
    """64-bit finaliser in place (the constants are those of splitmix64)."""
    import numpy as np

    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def gram_hashes(codes, gram: int):
    """Hashes of all grams of an array of code points."""
    import numpy as np

    n = len(codes) - gram + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = _powers(len(codes) + 1)
    c = codes.astype(np.uint64)
    c *= np.uint64(0xD6E8FEB86659FD93)
    c ^= c >> np.uint64(32)
    c *= up[: len(c)]
    sums = np.empty(len(c) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(c, out=sums[1:])
    h = sums[gram:] - sums[:n]
    h *= down[:n]
    return mix(h)


def _sliding_min(x, width: int):
    """Minimum of each ``width`` neighbours: running minima of blocks from both sides."""
    import numpy as np

    n = len(x)
    pad = (-n) % width
    y = np.concatenate([x, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]) if pad else x
    blocks = y.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def anchors(texts: list[str], span: int, gram: int):
    """(text number, character position, gram hash) of the named grams of all texts, as arrays.

    A gram at a piece border may be returned twice.
    """
    import numpy as np

    width = span - gram + 1
    got: list = []
    group: list = []
    held = 0

    def flush():
        nonlocal group, held
        if not group:
            return
        codes = np.frombuffer("".join(t for _, _, t in group).encode("utf-32-le", "surrogatepass"), np.uint32)
        h = gram_hashes(codes, gram)
        if len(h) >= width:
            # the upper 40 bits of the hash, then the place: the least is the leftmost least
            packed = (h & ~np.uint64((1 << 24) - 1)) | np.arange(len(h), dtype=np.uint64)
            best = (_sliding_min(packed, width) & np.uint64((1 << 24) - 1)).astype(np.int64)
            sizes = np.array([len(t) for _, _, t in group])
            ends = np.cumsum(sizes)
            inside = np.zeros(len(best) + 1, np.int32)  # windows that lie within one text
            starts = ends - sizes
            full = sizes >= span
            np.add.at(inside, starts[full], 1)
            np.add.at(inside, np.minimum(ends[full] - span + 1, len(best)), -1)
            ok = np.cumsum(inside[:-1]) > 0
            best = best[ok]
            if len(best):
                at = best[np.r_[True, best[1:] != best[:-1]]]
                which = np.searchsorted(ends, at, side="right")
                owner = np.array([i for i, _, _ in group])[which]
                shift = np.array([s for _, s, _ in group])[which]
                got.append((owner, at - starts[which] + shift, h[at].view(np.int64)))
        group, held = [], 0

    for i, t in enumerate(texts):
        if not t or len(t) < span:
            continue
        for s in range(0, max(1, len(t) - span + 1), PIECE):
            piece = t if len(t) <= PIECE + span else t[s : s + PIECE + span - 1]
            group.append((i, s, piece))
            held += len(piece)
            if held >= PIECE:
                flush()
            if piece is t:
                break
    flush()
    if not got:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*got))
