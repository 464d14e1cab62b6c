"""Name matching inside a block of equal columns and a date, the same or within some days.

All pairs of a block would be quadratic in the block, and default birth dates make blocks
huge. Candidates come first and only they are compared; every reduction is exact:

* rows that agree on block and names are one *profile* on either side, so copies are
  compared once. Profiles are numbered and stored with their grams, each prepared once;
* an accepted pair must have close full names, so it shares one of the rarest grams of both
  (``similarity.prefix_size``): the equi-join key is block + gram, not block, hashed to one number;
* two names that share a gram are candidates only if their lengths, what is left of both from that
  gram on, and a signature of all their grams allow the cosine: few pairs pass that are not close;
* a pair is compared where it meets, at the first gram that both names have and nowhere else. Pairs, of which
  there may be many more than profiles, are never shuffled or stored: only the best one of each row is.

What is shuffled are profiles unfolded by gram, which grow with the tables. Beyond ``STEP_BYTES`` of them the
search goes in steps over ranges of grams, and the disk holds the unfolded profiles of one step at a time.

Dates within some days are found by an equi-join on buckets of that many days.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from idweave.functions.similarity import (
    CODE_BITS,
    SLOTS,
    combined_score,
    distance,
    gram_codes,
    gram_slot,
    largest_count,
    name_weights,
    points,
    prefix_size,
    shared_squares,
    signature,
    squares_from,
    with_distance,
    with_grams,
)
from idweave.operators.cascade import LABEL, PERSON, key_text
from idweave.operators.joins import shuffled_join
from idweave.operators.uniqueness import unique_on
from idweave.operators.validate import SCORE
from idweave.runtime import Workspace
from idweave.spec import THRESHOLD, FuzzyRule

#: So many bytes of unfolded profiles, before compression, are shuffled in one step of a search.
STEP_BYTES = 4 << 30
#: A row of them besides its grams, about.
ENTRY_BYTES = 250


@dataclass(frozen=True)
class Step:
    """Grams whose place is at least ``low`` and below ``high`` (None: no bound), and of their join keys one of ``parts``."""

    low: int = 0
    high: int | None = None
    part: int = 0
    parts: int = 1


def reachable(threshold: float) -> float:
    """The cosine above which accepted full names lie: an accepted distance is below the threshold, so the cosine is
    above one minus it; the margin covers rounding to 32 bits."""
    return 1 - threshold - 1e-6


def gram_ranking(registry: DataFrame, full: str) -> list[int]:
    """Place of each gram slot by how often the registry's full names use it, rare first.

    One small aggregate; there are ``SLOTS`` slots whatever the table holds.
    """
    codes = registry.selectExpr(f"{points(full)} as points").selectExpr(f"explode({gram_codes('points')}) as code")
    counts = codes.groupBy(F.expr(f"{gram_slot('code')} as slot")).count().collect()
    uses = {row.slot: row["count"] for row in counts}
    places = [0] * SLOTS
    for place, slot in enumerate(sorted(range(SLOTS), key=lambda slot: (uses.get(slot, 0), slot))):
        places[slot] = place
    return places


def _profiles(df: DataFrame, side: str, rule: FuzzyRule, ranking: Sequence[int], more: Sequence[str] = ()) -> DataFrame:
    """Numbered profiles: block key, day, names, grams of the full name, and the columns ``more``."""
    day = f"unix_date({rule.date})" if rule.date else "0"
    names = [f"{c} as {side}_{n}" for c, n in zip(rule.names, ("given", "family", "full"), strict=True) if c in df.columns]
    keyed = df.selectExpr(f"{key_text(rule.equal)} as {side}_block", f"{day} as {side}_day", *names, *more)
    numbered = with_grams(keyed, {side: f"{side}_full"}, ranking)
    return numbered.withColumn(f"{side}_no", F.monotonically_increasing_id())


def prepared(profiles: DataFrame, side: str, cosine: float) -> DataFrame:
    """Profiles with the figures that bound a cosine and ``_prefix``, how many grams decide whether ``cosine`` is
    in reach. Profiles that were stored with them stay as they are."""
    if f"{side}_prefix" in profiles.columns:
        return profiles
    sizes = [f"size({side}_u) + size({side}_x) as {side}_length", f"{largest_count(f'{side}_x')} as {side}_peak"]
    signed = [f"{word} as {side}_s{i}" for i, word in enumerate(signature(f"{side}_u"))]
    return profiles.selectExpr("*", *sizes, *signed, f"{prefix_size(side, cosine)} as {side}_prefix")


def _volumes(profiles: DataFrame, side: str) -> Counter[int]:
    """About how many bytes the profiles take when unfolded by gram, not compressed, by the place of the gram."""
    places = f"explode(transform(slice({side}_u, 1, {side}_prefix), g -> shiftright(g, {CODE_BITS}))) as place"
    grams = profiles.selectExpr(places, f"{ENTRY_BYTES} + 8L * (size({side}_u) + size({side}_x)) as bytes")
    return Counter({row.place: row.bytes for row in grams.groupBy("place").agg(F.sum("bytes").alias("bytes")).collect()})


def steps_of(volumes: Mapping[int, int], most: int) -> list[Step]:
    """Steps of about ``most`` bytes at most that together have all grams once: ranges of places, and where a single place
    holds more, parts of its join keys."""
    steps, low, held = [], 0, 0
    for place in sorted(volumes):
        if held and held + volumes[place] > most:
            steps.append(Step(low, place))
            low, held = place, 0
        if volumes[place] > most:
            parts = math.ceil(volumes[place] / most)
            steps += [Step(place, place + 1, part, parts) for part in range(parts)]
            low = place + 1
        else:
            held += volumes[place]
    return [*steps, Step(low, None)] if held or not steps else steps


def _entries(profiles: DataFrame, side: str, days: int, wide: bool, step: Step) -> DataFrame:
    """One row per gram of the prefix of the full name that is in ``step``, with all that a comparison needs; ``wide``: in
    all buckets of dates that may be near instead of its own."""
    grams = f"slice({side}_u, 1, {side}_prefix)"
    bounds = [f"g >= {step.low << CODE_BITS}L"] * (step.low > 0) + [f"g < {(step.high or 0) << CODE_BITS}L"] * (step.high is not None)
    if bounds:  # before the rows are unfolded: most profiles have few grams in a step
        grams = f"filter({grams}, g -> {' and '.join(bounds)})"
    unfolded = profiles.selectExpr("*", f"explode({grams}) as {side}_gram")
    if days > 0 and wide:
        low, high = (f"floor(({side}_day {sign} {days - 1}) / {days})" for sign in "-+")
        slot = f"explode(sequence({low}, {high}))"
    else:
        slot = f"floor({side}_day / {days})" if days > 0 else f"{side}_day"
    slots = unfolded.selectExpr("*", f"{slot} as _slot")
    keyed = slots.selectExpr("*", f"xxhash64(xxhash64({side}_block), {side}_gram, cast(_slot as bigint)) as _key")
    if step.parts > 1:
        keyed = keyed.where(f"pmod(_key, {step.parts}) = {step.part}")
    at = f"cast(array_position({side}_u, {side}_gram) - 1 as int)"
    tailed = keyed.selectExpr("*", f"{squares_from(side, at)} as {side}_tail")
    # What is read at every meeting stands together, at the head of the row.
    head = ["_key", *[f"{side}_{c}" for c in ("day", "tail", "n2", "s0", "s1")]]
    left_out = {*head, "_slot", f"{side}_prefix", f"{side}_full"}
    return tailed.select(*head, *[c for c in tailed.columns if c not in left_out])


def candidates(
    people: DataFrame, rows: DataFrame, days: int, cosine: float, wide: str = "p", step: Step = Step()
) -> DataFrame:
    """All pairs of profiles whose full names may reach ``cosine``, each once (or those of one step), with the profiles.

    Block, gram and date meet as one hashed number. Of the grams a pair shares, the first is in both prefixes and
    has everything shared behind it: by Cauchy-Schwarz the squares from there on bound the dot product. The pair
    counts at that gram only, so where it meets at another one it is left to the first. The number of grams of one name
    times the largest count of the other is a bound as well, and so are the squares that the signatures do not
    show to be unshared: each bit that one name lacks is a gram of the other, and its square, that is not shared.

    The profiles of the side ``wide`` are unfolded into all buckets of dates that may be near.
    """
    people = _entries(prepared(people, "r", cosine), "r", days, wide == "r", step).drop("r_gram")
    rows = _entries(prepared(rows, "p", cosine), "p", days, wide == "p", step)
    near = f"abs(r_day - p_day) < {days}" if days > 0 else "r_day = p_day"
    reach = f"{cosine * cosine!r}D * p_n2 * r_n2"
    enough = f"cast(p_tail as double) * r_tail >= {reach}"
    lengths = "cast(least(p_length * r_peak, r_length * p_peak) as double)"
    shared = f"cast({shared_squares('p', 'r')} as double) * {shared_squares('r', 'p')} >= {reach}"
    bounds = f"{near} and {enough} and {shared} and {lengths} * {lengths} >= {reach}"
    first = "get(array_intersect(p_u, r_u), 0) = p_gram"
    return shuffled_join(rows, people, "_key").where(f"{bounds} and p_block = r_block and {first}")


def fuzzy_pairs(
    people: DataFrame,
    rows: DataFrame,
    days: int,
    parts: bool,
    threshold: float = THRESHOLD,
    wide: str = "p",
    step: Step = Step(),
) -> DataFrame:
    """``p_no``, person, ``_days`` apart, score of all pairs of profiles with close full names, or those of one step
    (see ``candidates``). Every pair whose score is below ``threshold`` is among them."""
    met = candidates(people, rows, days, reachable(threshold), wide, step)
    names = [f"{side}_{n}" for side in "pr" for n in ("given", "family")] if parts else []
    close = met.selectExpr("p_no", PERSON, "abs(r_day - p_day) as _days", *names, f"{distance('p', 'r')} as _d_full")
    close = close.where(f"coalesce(_d_full < {threshold}D, false)")
    if not parts:
        return close.selectExpr("p_no", PERSON, "_days", f"_d_full as {SCORE}")
    scored = with_distance(close, {"_d_given": ("p_given", "r_given"), "_d_family": ("p_family", "r_family")})
    score = combined_score("_d_full", "_d_given", "_d_family", *name_weights("p_given", "r_given", "p_family", "r_family"))
    return scored.selectExpr("p_no", PERSON, "_days", f"{score} as {SCORE}")


def fuzzy_match(
    registry: DataFrame,
    pivot: DataFrame,
    rules: Sequence[FuzzyRule],
    parts: bool,
    threshold: float = THRESHOLD,
    ranking: Sequence[int] | None = None,
    work: Workspace | None = None,
    name: str = "fuzzy",
) -> DataFrame:
    """Pivot rows matched by the first rule that accepts anyone: person, pivot columns,
    label, score.

    Rules over the same block and name columns share one search with the widest tolerance: the first
    rule that admits a pair ranks above the score, so rows met by an earlier rule are never
    left to a later one. Of the people that share a profile the lowest id stands for all, which is
    also how ties are broken. Profiles are stored as ``<name>_people`` and ``<name>_rows``; a search in several
    steps stores the best pairs of each as ``<name>_best``.
    """
    rule, days = rules[0], max(r.days for r in rules)
    if any((r.block, r.names) != (rule.block, rule.names) for r in rules):
        raise ValueError("fuzzy rules searched together must share their block and name columns; see searches")
    work = work or Workspace(pivot.sparkSession)
    given, family, full = rule.names
    profile = [*rule.block, *([given, family] if parts else []), full]
    usable = " and ".join([*[f"{c} is not null" for c in rule.block], f"length({full}) >= 2"])
    if ranking is None:
        ranking = gram_ranking(registry, full)

    people = registry.where(usable).groupBy(*profile).agg(F.min(PERSON).alias(PERSON))
    people = prepared(_profiles(people, "r", rule, ranking, [PERSON]), "r", reachable(threshold))
    people = work.store(people, f"{name}_people")
    kept = [f"{c} as _q{i}" for i, c in enumerate(profile)]
    rows = _profiles(pivot.where(usable).select(*profile).distinct(), "p", rule, ranking, kept)
    rows = work.store(prepared(rows, "p", reachable(threshold)), f"{name}_rows")
    asked = [f"_q{i}" for i in range(len(profile))]
    work.clean()
    volumes = {"r": _volumes(people, "r"), "p": _volumes(rows, "p")}
    wide = min(volumes, key=lambda side: volumes[side].total())
    for place in volumes[wide]:
        volumes[wide][place] *= 3 if days > 1 else 1  # buckets of dates
    steps = steps_of(volumes["r"] + volumes["p"], STEP_BYTES)

    admits = [f"when {'_days = 0' if r.days == 0 else f'_days < {r.days}'} then {i}" for i, r in enumerate(rules)]
    # Accepted pairs rank first and are tested after the ranking, see validate.best_candidate.
    ok = f"coalesce({SCORE} < {threshold}D and _rule is not null, false)"
    first = Window.partitionBy("p_no").orderBy(F.expr(f"not {ok}"), "_rule", SCORE, PERSON)

    def best_of(pairs: DataFrame) -> DataFrame:
        ranked = pairs.withColumn("_rank", F.row_number().over(first)).where("_rank = 1")
        return ranked.where(ok).select("p_no", "_rule", SCORE, PERSON)

    def searched(step: Step) -> DataFrame:
        pairs = fuzzy_pairs(people, rows.drop(*asked), days, parts, threshold, wide, step)
        return best_of(pairs.selectExpr("p_no", f"case {' '.join(admits)} end as _rule", SCORE, PERSON))

    if len(steps) == 1:
        best = searched(steps[0])
    else:
        for step in steps:
            found = work.add(searched(step), f"{name}_best")
            work.clean()
        best = best_of(found)
    best = best.selectExpr("p_no", "_rule", f"{SCORE} as _score", f"{PERSON} as _person")
    best = shuffled_join(best, rows.select("p_no", *asked), "p_no").drop("p_no")
    # Block columns and the full name are never null here; the name parts may be.
    never_null = {*rule.block, full}
    same = " and ".join(f"{c} {'=' if c in never_null else '<=>'} _q{i}" for i, c in enumerate(profile))
    columns = [c for c in pivot.columns if c != PERSON]
    labels = ", ".join(f"'{r.label}'" for r in rules)
    return pivot.select(*columns).join(best, F.expr(same), "inner").selectExpr(
        f"_person as {PERSON}",
        *columns,
        f"element_at(array({labels}), _rule + 1) as {LABEL}",
        f"_score as {SCORE}",
    )


def searches(rules: Sequence[FuzzyRule]) -> list[list[FuzzyRule]]:
    """Rules in their order, those next to each other with the same block and name columns together."""
    return [list(same) for _, same in groupby(rules, key=lambda r: (r.block, r.names))]


def fuzzy_block(
    registry: DataFrame, pivot: DataFrame, rule: FuzzyRule, parts: bool, threshold: float = THRESHOLD
) -> DataFrame:
    """Best accepted match inside the block, with the same date."""
    return fuzzy_match(registry, pivot, [rule], parts, threshold)


def fuzzy_range(
    registry: DataFrame, pivot: DataFrame, rule: FuzzyRule, parts: bool, threshold: float = THRESHOLD
) -> DataFrame:
    """Best accepted match inside the block, with a date less than ``rule.days`` away."""
    return fuzzy_match(registry, pivot, [rule], parts, threshold)


def used_once(matches: DataFrame) -> DataFrame:
    """Matches whose person occurs once."""
    return unique_on(matches, [PERSON])
