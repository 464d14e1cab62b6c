"""Bigram cosine distance between names, as native SQL expressions.

A name is a multiset of overlapping two-character grams. Grams are held as numbers: both
code points packed into one long, which is one-to-one. Spark compiles and hashes array
operations for longs but not for strings. Each name is reduced once, before any join, to
its distinct grams, the repeats beyond the first occurrence, and its squared norm; a pair
then costs one array intersection plus a little work on the few repeats.

Expressions are SQL text, so that a whole formula reaches the session in one call; wrap a
text in ``F.expr`` to use it alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from idweave.functions.normalize import FAMILY, FULL, GIVEN
from idweave.spec import UNCOMPARABLE

REGISTRY_NAMES = {GIVEN: "p_nombres_reg", FAMILY: "p_apellidos_reg", FULL: "p_nombres_apellidos_reg"}

# Two code points take 42 bits; the rank of a gram goes above them.
CODE_BITS, POINT_BITS = 42, 21

# Grams are ranked by slots, five low bits of either code point: letters fall into slots of
# their own, other characters share them.
SLOTS = 1024


def bigrams(name: str) -> str:
    """Overlapping two-character grams; none for a null or shorter name."""
    return (
        f"if(length({name}) >= 2, "
        f"transform(sequence(1, length({name}) - 1), i -> substring({name}, i, 2)), cast(array() as array<string>))"
    )


def points(name: str) -> str:
    """Code points of a name."""
    return f"transform(split({name}, ''), c -> cast(ascii(c) as bigint))"


def gram_slot(code: str) -> str:
    return f"cast(((shiftright({code}, {POINT_BITS}) & 31) * 32 + ({code} & 31)) as int)"


def gram_codes(points: str, ranking: Sequence[int] = (), ordered: bool = True) -> str:
    """Gram codes of a name given as a column of code points, sorted if ``ordered``; none for a null or
    shorter name.

    ``ranking`` gives each slot its place. It renumbers grams one-to-one, so it orders them
    (rare first, if common slots have high places) and never changes a distance.
    """
    head, tail = (f"slice({points}, {start}, size({points}) - 1)" for start in (1, 2))
    codes = f"zip_with({head}, {tail}, (a, b) -> shiftleft(a, {POINT_BITS}) | b)"
    if ranking:
        places = f"array({', '.join(f'{r}L' for r in ranking)})"
        codes = f"transform({codes}, g -> shiftleft(get({places}, {gram_slot('g')}), {CODE_BITS}) | g)"
    return f"if(size({points}) >= 2, {f'sort_array({codes})' if ordered else codes}, cast(array() as array<bigint>))"


def distinct_codes(codes: str) -> str:
    return f"array_distinct({codes})"


def repeated_codes(codes: str) -> str:
    """Every occurrence after the first one of sorted codes."""
    return f"filter({codes}, (g, i) -> i > 0 and get({codes}, i - 1) = g)"


def _occurrences(codes: str, gram: str) -> str:
    return f"(size({codes}) - size(array_remove({codes}, {gram})))"


def _repeats_product(a: str, b: str) -> str:
    walk = f"aggregate({a}, 0, (n, g) -> n + {_occurrences(b, 'g')})"
    return f"if(size({a}) > 0 and size({b}) > 0, {walk}, 0)"


def squared_norm(distinct: str, repeats: str) -> str:
    """Sum of squared gram counts: the dot product of the name with itself."""
    return f"(size({distinct}) + 2 * size({repeats}) + {_repeats_product(repeats, repeats)})"


def dot(a: str, b: str) -> str:
    """Dot product of two gram count vectors prepared by ``with_grams``.

    With counts split into "present" (0/1) and "repeats", the product has four terms. The
    last three walk the repeats only, of which a name has few.
    """

    def found(repeats: str, distinct: str) -> str:
        return f"if(size({repeats}) > 0, size(filter({repeats}, g -> array_contains({distinct}, g))), 0)"

    return (
        f"(size(array_intersect({a}_u, {b}_u)) + {found(f'{a}_x', f'{b}_u')} + {found(f'{b}_x', f'{a}_u')}"
        f" + {_repeats_product(f'{a}_x', f'{b}_x')})"
    )


def distance(a: str, b: str) -> str:
    """Cosine distance (32-bit) of two names prepared by ``with_grams``."""
    return _distance(f"{a}_n2", f"{b}_n2", dot(a, b))


def _distance(norm_a: str, norm_b: str, product: str) -> str:
    cosine = f"{product} / sqrt({norm_a}) / sqrt({norm_b})"
    return f"cast(if({norm_a} = 0 or {norm_b} = 0, {UNCOMPARABLE}D, 1 - abs({cosine})) as float)"


def prefix_size(side: str, cosine: float) -> str:
    """How many leading grams can decide whether a cosine of ``cosine`` is in reach.

    Let two names share grams, and let w be the first shared one in the common order. If w
    lies outside this prefix of either name, all shared grams lie in a tail that holds less
    than ``cosine`` squared of that name's squared norm, so by Cauchy-Schwarz the pair stays
    below ``cosine``. Pairs at or above it therefore have w in both prefixes.
    """
    count = f"(1 + {_occurrences(f'{side}_x', 'g')})"
    return (
        f"aggregate({side}_u, named_struct('total', 0, 'size', 0), (s, g) -> named_struct("
        f"'total', s.total + {count} * {count}, "
        f"'size', s.size + if({side}_n2 - s.total >= {cosine * cosine!r}D * {side}_n2, 1, 0)), s -> s.size)"
    )


def largest_count(repeats: str) -> str:
    """How often the most frequent gram of a name occurs."""
    most = f"aggregate({repeats}, 0, (n, g) -> greatest(n, {_occurrences(repeats, 'g')}))"
    return f"(1 + if(size({repeats}) > 0, {most}, 0))"


def squares_from(side: str, at: str) -> str:
    """Sum of squared gram counts of a name from its distinct gram number ``at`` (from 0) on."""
    count = f"(1 + {_occurrences(f'{side}_x', 'g')})"
    before = f"aggregate(slice({side}_u, 1, {at}), 0, (n, g) -> n + {count} * {count})"
    return f"({side}_n2 - if(size({side}_x) > 0, {before}, {at}))"


def signature(codes: str) -> list[str]:
    """Two longs of which each gram sets one bit of 128."""
    word = "aggregate({codes}, 0L, (s, g) -> s | if(xxhash64(g) & 64 {which} 0, shiftleft(1L, cast(xxhash64(g) & 63 as int)), 0L))"
    return [word.format(codes=codes, which=which) for which in ("=", "<>")]


def shared_squares(a: str, b: str) -> str:
    """At least the sum of squared gram counts of ``a`` over the grams that ``b`` has too, from the signatures."""
    return f"({a}_n2 - bit_count({a}_s0 & ~{b}_s0) - bit_count({a}_s1 & ~{b}_s1))"


def with_grams(df: DataFrame, names: Mapping[str, str], ranking: Sequence[int] = (), ordered: bool = True) -> DataFrame:
    """For each ``prefix: name`` (SQL text) add ``<prefix>_u`` (distinct codes), ``_x``
    (repeats) and ``_n2`` (squared norm).

    Distances do not ask for an order of the distinct codes. Without ``ordered`` they stand as in the name, and only
    names with a repeat, which are few, are sorted and searched for repeats."""
    keep = df.columns
    df = df.selectExpr(*keep, *[f"{points(c)} as {p}_points" for p, c in names.items()])
    df = df.selectExpr(*keep, *[f"{gram_codes(f'{p}_points', ranking, ordered)} as {p}_codes" for p in names])
    distinct = [f"{distinct_codes(f'{p}_codes')} as {p}_u" for p in names]
    if not ordered:
        df = df.selectExpr(*keep, *[f"{p}_codes" for p in names], *distinct)
        single = "if(size({0}_u) = size({0}_codes), cast(array() as array<bigint>), sort_array({0}_codes)) as {0}_codes"
        distinct = [f"{p}_u" for p in names]
        df = df.selectExpr(*keep, *distinct, *[single.format(p) for p in names])
    df = df.selectExpr(*keep, *distinct, *[f"{repeated_codes(f'{p}_codes')} as {p}_x" for p in names])
    return df.selectExpr("*", *[f"{squared_norm(f'{p}_u', f'{p}_x')} as {p}_n2" for p in names])


def with_distance(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """For each ``out: (name column, name column)`` add the distance column ``out``.

    Grams are made only where they matter: not beside a null, and once for two equal names.
    """
    names: dict[str, str] = {}
    distances = []
    for i, (out, (a, b)) in enumerate(pairs.items()):
        names |= {f"_a{i}": f"if({b} is null, null, {a})", f"_b{i}": f"if({a} is null or {a} = {b}, null, {b})"}
        equal = _distance(f"_a{i}_n2", f"_a{i}_n2", f"_a{i}_n2")
        distances.append(f"if({a} = {b}, {equal}, {distance(f'_a{i}', f'_b{i}')}) as {out}")
    keep = df.columns
    return with_grams(df, names, ordered=False).selectExpr(*keep, *distances)


def set_cosine(a: str, b: str) -> str:
    """Cosine of two character sets; null when either is empty or null."""
    sa, sb = (f"array_distinct(split({c}, ''))" for c in (a, b))
    return (
        f"if(length({a}) > 0 and length({b}) > 0, "
        f"size(array_intersect({sa}, {sb})) / sqrt(size({sa}) * size({sb})), null)"
    )


def name_weights(given: str, given_reg: str, family: str, family_reg: str) -> tuple[str, str]:
    """Weights of given names and surnames: the shorter part weighs more.

    Null when a part has no length on either side, which leaves the full name to decide.
    """
    inv_given = f"try_divide(1D, greatest(length({given}), length({given_reg})))"
    inv_family = f"try_divide(1D, greatest(length({family}), length({family_reg})))"
    total = f"({inv_given} + {inv_family})"
    return f"try_divide({inv_given}, {total})", f"try_divide({inv_family}, {total})"


def combined_score(full: str, given: str, family: str, w_given: str, w_family: str) -> str:
    """The worse of the full-name distance and the weighted distance of the parts."""
    return f"greatest(cast({full} as double), {given} * {w_given} + {family} * {w_family})"


def has_parts(columns) -> bool:
    """Whether given names and surnames are both there; the test ignores case."""
    upper = {c.upper() for c in columns}
    return GIVEN.upper() in upper and FAMILY.upper() in upper


def with_name_score(
    df: DataFrame,
    out: str = "semidifuso",
    parts: bool = True,
    registry: Mapping[str, str] = REGISTRY_NAMES,
) -> DataFrame:
    """Add the name score of a pivot row against the registry names beside it.

    ``parts`` = False compares full names only; the score then is a 32-bit distance. A pivot
    without any full name cannot be compared.
    """
    if FULL not in df.columns:
        return df.selectExpr("*", f"cast({UNCOMPARABLE}D as float) as {out}")
    if not parts:
        return with_distance(df, {out: (FULL, registry[FULL])})
    scored = with_distance(df, {f"_d_{c}": (c, registry[c]) for c in (FULL, GIVEN, FAMILY)})
    weights = name_weights(GIVEN, registry[GIVEN], FAMILY, registry[FAMILY])
    score = combined_score(f"_d_{FULL}", f"_d_{GIVEN}", f"_d_{FAMILY}", *weights)
    return scored.selectExpr(*df.columns, f"{score} as {out}")
