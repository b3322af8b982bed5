"""Word shingles of whole texts as 64-bit hashes, in numpy."""


def mixed(x):
    """Spread the bits of 64-bit integers."""
    import numpy as np
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts, size=5):
    """Sorted distinct hashes of the ``size``-word shingles of each text of an Arrow array without NULLs.

    Words are what stands between blanks (code points 32 and 9 to 13), A-Z in lower case. Fewer words
    than ``size`` make one shingle, no words none.
    """
    import numpy as np
    import pyarrow as pa
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], "int64")[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, "uint8")[offsets[0]:offsets[-1]] if data else np.zeros(0, "uint8")
    offsets = offsets - offsets[0]
    table = np.arange(256, dtype="uint8")
    table[65:91] += 32
    blank = np.zeros(256, bool)
    blank[[32, 9, 10, 11, 12, 13]] = True
    white = blank[raw]
    begins = ~white
    begins[1:] &= white[:-1]
    first_bytes = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[first_bytes] = ~white[first_bytes]
    ends = ~white
    ends[:-1] &= white[1:]
    ends[offsets[1:][offsets[:-1] < offsets[1:]] - 1] |= ~white[offsets[1:][offsets[:-1] < offsets[1:]] - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    # Hash of a word: its bytes times powers of an odd number, moved to power 0 by the inverse.
    odd = 0x9E3779B97F4A7C15
    n = np.uint64(len(raw) + 1)
    powers = np.cumprod(np.concatenate([np.ones(1, "uint64"), np.full(len(raw), odd, "uint64")]))
    inverse = np.cumprod(np.concatenate([np.ones(1, "uint64"), np.full(len(raw), pow(odd, -1, 1 << 64), "uint64")]))
    letters = mixed(np.arange(1, 257, dtype="uint64"))[table[raw]]
    total = np.concatenate([np.zeros(1, "uint64"), np.cumsum(letters * powers[:-1])])
    words = mixed((total[stops] - total[starts]) * inverse[starts] + (stops - starts).astype("uint64"))
    del powers, inverse, letters, total
    bounds = np.searchsorted(starts, offsets)
    step = np.uint64(0xD1342543DE82EF95)
    grams = words[:max(0, len(words) - size + 1)].copy()
    for i in range(1, size):
        grams = grams * step + words[i:len(grams) + i]
    grams = mixed(grams)
    found = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= size:
            found.append(np.unique(grams[a:b - size + 1]))
        elif b > a:
            one = np.full(1, b - a, "uint64")
            for w in words[a:b]:
                one = one * step + w
            found.append(mixed(one))
        else:
            found.append(np.zeros(0, "uint64"))
    return found
