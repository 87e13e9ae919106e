"""Reduction of Miller indices by point-group operations, in expressions: no row is multiplied."""

from __future__ import annotations

import re
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reciprospark.functions import vec

IDENTITY = ((1, 0, 0), (0, 1, 0), (0, 0, 1))


def diagonal(a: int, b: int, c: int):
    return ((a, 0, 0), (0, b, 0), (0, 0, c))


_2X, _2Y, _2Z, _4Z = diagonal(1, -1, -1), diagonal(-1, 1, -1), diagonal(-1, -1, 1), ((0, -1, 0), (1, 0, 0), (0, 0, 1))
_3Z, _6Z, _3XYZ = ((0, -1, 0), (1, -1, 0), (0, 0, 1)), ((1, -1, 0), (1, 0, 0), (0, 0, 1)), ((0, 0, 1), (1, 0, 0), (0, 1, 0))
_2XY, _2YX = ((0, 1, 0), (1, 0, 0), (0, 0, -1)), ((0, -1, 0), (-1, 0, 0), (0, 0, -1))
#: Rotations that generate the point groups of crystals of chiral molecules, by symbol: b is the axis of "2", hexagonal axes for 3.
GENERATORS = {
    "1": (), "2": (_2Y,), "121": (_2Y,), "112": (_2Z,), "222": (_2Z, _2Y), "4": (_4Z,), "422": (_4Z, _2X), "3": (_3Z,), "32": (_3Z, _2XY), "321": (_3Z, _2XY),
    "312": (_3Z, _2YX), "6": (_6Z,), "622": (_6Z, _2XY), "23": (_2Z, _3XYZ), "432": (_4Z, _3XYZ),
}


def closed(generators):
    """All products of integer matrices, the identity first, then in the order in which they are found."""
    found = [IDENTITY]
    for a in found:  # the list grows as it is read
        for g in generators:
            product = tuple(tuple(int(x) for x in row) for row in np.array(g) @ np.array(a))
            if product not in found:
                found.append(product)
            if len(found) > 48:
                raise ValueError("these matrices generate no crystallographic point group")
    return tuple(found)


def point_group(group: str) -> str:
    """The symbol of a space group's rotations: "P 21 21 21" and "P222" are "222"."""
    if not (found := re.fullmatch(r"[A-Z]((?: *[1-6]+)+)", group.strip())):
        return ""
    parts = found[1].split()
    return "".join(p[0] for p in parts) if " " in group.strip() else parts[0]  # a screw axis turns as its rotation does


_TOKEN = re.compile(r"-[1-6]|[1-6][1-5]?/[a-z]|[1-6][1-5]?|[a-z]")


def elements(group: str) -> list[str]:
    """The symmetry elements of a Hermann-Mauguin symbol without their translations: "P n m a" gives m, m, m and "I 41/a m d" gives 4/m, m, m."""
    text = group.strip()
    rest = re.sub(r"\s+", "", text[1:])
    if not re.fullmatch(r"[PABCFIRH]", text[:1]) or not rest or "".join(found := _TOKEN.findall(rest)) != rest:
        return []
    if " " in text:
        found = [x for part in text[1:].split() for x in _TOKEN.findall(part)]
    return ["m" if x.isalpha() else x[:2] if x[0] == "-" else x[0] + ("/m" if "/" in x else "") for x in found]


def negative(m):
    return tuple(tuple(-x for x in row) for row in m)


def generators(found: list[str]) -> list | None:
    """What generates the point group of elements in the order of a symbol; None if they name none. The axes that an element's
    place stands for go by the crystal system: c, a and a - b of the tetragonal, trigonal and hexagonal, c, a + b + c and a - b of the
    cubic, a, b and c of the others; one element alone is along b if it is of the monoclinic system."""
    turns = {"3": _3Z, "4": _4Z, "6": _6Z}
    first = found[0].strip("-").split("/")[0] if found else ""
    cubic = len(found) > 1 and found[1] in ("3", "-3") and first in ("2", "4", "m")
    if cubic:
        axes = [turns.get(first, _2Z), _3XYZ, _2XY]
    elif first in ("3", "6"):
        axes = [turns[first], _2XY, _2YX]
    elif first == "4":
        axes = [_4Z, _2X, _2XY]
    else:
        axes = [_2Y] if len(found) == 1 else [_2X, _2Y, _2Z]
        if any(x.strip("-").split("/")[0] not in ("1", "2", "m") for x in found):
            return None
    if not found or len(found) > len(axes) or len(found) == 2 and axes[0] is _2X:
        return None
    out = []
    for x, axis in zip(found, axes, strict=False):
        if x == "-1" or x.endswith("/m"):
            out.append(negative(IDENTITY))
        if x == "m":
            axis = {id(_4Z): _2Z}.get(id(axis), axis)
            out.append(negative(axis))
        elif x == "-3":
            out += [axis, negative(IDENTITY)]
        elif x[0] == "-" and x != "-1":
            out.append(negative(axis))
        elif x not in ("1", "-1"):
            out.append(axis)
    return out


def operations(group: str):
    """The rotations, mirrors and inversions of a space group by its Hermann-Mauguin symbol, as "P 43 21 2", "Pnma" or "F d -3 m"; ValueError for what is no such symbol.

    Symbols of digits alone that are written without blanks are point groups: "P222"."""
    if (symbol := point_group(group)) in GENERATORS:
        return closed(GENERATORS[symbol])
    if (found := generators(elements(group))) is None:
        raise ValueError(f"no operations for space group {group!r}; pass them as matrices")
    return closed(found)


def for_indices(ops):
    """The operations as they act on Miller indices: transposed. An operation R takes a point x to R x, and a plane of indices h to R^T h. For
    orthogonal axes the mates of a whole group are the same either way; for hexagonal ones they are not, and only the transposed ones keep |q|.
    What takes ops takes them as they are: pass operations(group) for R h, for_indices(operations(group)) for R^T h."""
    return tuple(tuple(zip(*op, strict=True)) for op in ops)


def parsed(triplets) -> tuple:
    """Rotations of a crystal's own operations given as "x,y,z", "-y,x-y,z+1/3" ...: translations are left out."""
    out = []
    for text in triplets:
        rows = []
        for part in text.lower().replace(" ", "").split(","):
            row = [Fraction(0)] * 3
            for sign, axis in re.findall(r"([+-]?)([xyz])", part):
                row["xyz".index(axis)] += -1 if sign == "-" else 1
            rows.append(tuple(int(x) for x in row))
        if len(rows) != 3 or abs(round(np.linalg.det(np.array(rows, dtype=float)))) != 1:
            raise ValueError(f"{text!r} is no symmetry operation")
        out.append(tuple(rows))
    return tuple(dict.fromkeys(out))


def mates(hkl: DataFrame, ops) -> DataFrame:
    """hkl once for each operation, with op (its number) and h, k, l turned by it: a literal list, no join."""
    each = [F.struct(F.lit(n).alias("op"), *[x.alias(c) for x, c in zip(vec.apply(op, [F.col(c) for c in ("h", "k", "l")]), ("h", "k", "l"), strict=True)]) for n, op in enumerate(ops)]
    return hkl.withColumn("_m", F.explode(F.array(*each))).withColumns({c: F.col(f"_m.{c}") for c in ("op", "h", "k", "l")}).drop("_m")


def reduced(hkl: DataFrame, ops, mode: str = "canonical") -> DataFrame:
    """h, k, l replaced by their representative: the greatest mate, or (mode l1_last) the last of least absolute sum."""
    mates = [vec.apply(op, [F.col(c) for c in ("h", "k", "l")]) for op in ops]
    if mode == "canonical":
        best = F.greatest(*[F.struct(*[x.alias(c) for x, c in zip(m, ("h", "k", "l"), strict=True)]) for m in mates]) if len(mates) > 1 else F.struct("h", "k", "l")
    elif mode == "l1_last":
        rows = [F.struct((F.abs(m[0]) + F.abs(m[1]) + F.abs(m[2])).alias("s"), F.lit(-k).alias("late"), *[x.alias(c) for x, c in zip(m, ("h", "k", "l"), strict=True)]) for k, m in enumerate(mates)]
        best = F.least(*rows) if len(rows) > 1 else rows[0]
    else:
        raise ValueError(f"mode {mode!r} is neither canonical nor l1_last")
    return hkl.withColumn("_best", best).withColumns({c: F.col(f"_best.{c}") for c in ("h", "k", "l")}).drop("_best")
