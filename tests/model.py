"""Plain Python definitions the Spark code is tested against."""

import math
import struct
from collections import Counter


def to_float(x):
    return struct.unpack("f", struct.pack("f", x))[0]


def distance(a, b):
    if not a or not b or len(a) < 2 or len(b) < 2:
        return to_float(0.8)
    x, y = (Counter(s[i : i + 2] for i in range(len(s) - 1)) for s in (a, b))
    nx, ny = (math.sqrt(sum(c * c for c in v.values())) for v in (x, y))
    return to_float(1 - abs(sum(x[g] * y[g] for g in x if g in y) / nx / ny))


def score(nom, nom_reg, ape, ape_reg, full, full_reg):
    whole = distance(full, full_reg)
    lengths = [[len(s) for s in pair if s is not None] for pair in ((nom, nom_reg), (ape, ape_reg))]
    if not all(lengths) or any(max(part) == 0 for part in lengths):
        return whole
    inv_n, inv_a = (1 / max(part) for part in lengths)
    parts = distance(nom, nom_reg) * (inv_n / (inv_n + inv_a)) + distance(ape, ape_reg) * (inv_a / (inv_n + inv_a))
    return max(whole, parts)
