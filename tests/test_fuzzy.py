import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import model
from conftest import rows
from idweave.operators.fuzzy import candidates, fuzzy_block, fuzzy_match, fuzzy_pairs, used_once
from idweave.spec import FUZZY_RULES

REG = "p_idr string, p_nombres string, p_apellidos string, p_nombres_apellidos string, p_sexo string, p_fecha_nac date"
PIV = REG.replace("p_idr", "p_idp")
START = dt.date(1969, 12, 1)


def person(rng, i, prefix, days):
    """Names from a small stock, with the odd typo, null, empty text and default date."""
    def name():
        text = " ".join(rng.choice(["ANA", "LUIS", "MARIA", "JOSE", "É", "ANANA"]) for _ in range(rng.randrange(1, 3)))
        return text if rng.random() < 0.7 else text[: rng.randrange(len(text) + 1)] + rng.choice(["X", "", " "])

    nom, ape = (rng.choice([None, ""]) if rng.random() < 0.05 else name() for _ in range(2))
    full = " ".join(x for x in (ape, nom) if x is not None) if rng.random() < 0.9 else None
    day = START + dt.timedelta(days=rng.randrange(days)) if rng.random() < 0.6 else START
    return (f"{prefix}{i:04d}", nom, ape, full, rng.choice(["1", "2", "2", None]), rng.choice([day, day, day, None]))


def brute(people, pivot, rules, parts, threshold=0.2):
    out = []
    for p in pivot:
        for rule in rules:
            found = []
            for r in people:
                if None in (p[4], p[5], r[4], r[5]) or p[4] != r[4]:
                    continue
                gap = abs((p[5] - r[5]).days)
                if not (gap == 0 if rule.days == 0 else gap < rule.days):
                    continue
                if parts:
                    s = model.score(p[1], r[1], p[2], r[2], p[3], r[3])
                else:
                    s = model.distance(p[3], r[3])
                if s < threshold:
                    found.append((s, r[0]))
            if found:
                s, who = min(found)
                out.append((p[0], who, rule.label, s))
                break
    return sorted(out)


@pytest.mark.parametrize("parts,partitions", [(True, 1), (True, 7), (False, 4)])
def test_equals_all_pairs(spark, conf, parts, partitions):
    rng = random.Random(partitions)
    people = [person(rng, i, "r", 90) for i in range(150)]
    pivot = [person(rng, i, "p", 90) for i in range(150)]
    pivot += [("q" + p[0], *p[1:]) for p in pivot[:30]]
    with conf(spark__sql__shuffle__partitions=partitions):
        found = fuzzy_match(spark.createDataFrame(people, REG), spark.createDataFrame(pivot, PIV), FUZZY_RULES, parts)
        got = rows(found, "p_idp", "p_idr", "id_etiqueta", "semidifuso")
    expected = brute(people, pivot, FUZZY_RULES, parts)
    assert len({e[2] for e in expected}) == 2
    assert got == expected


def test_same_date_rule_alone(spark):
    rng = random.Random(9)
    people = [person(rng, i, "r", 20) for i in range(120)]
    pivot = [person(rng, i, "p", 20) for i in range(120)]
    found = fuzzy_block(spark.createDataFrame(people, REG), spark.createDataFrame(pivot, PIV), FUZZY_RULES[0], True)
    assert rows(found, "p_idp", "p_idr", "id_etiqueta", "semidifuso") == brute(people, pivot, FUZZY_RULES[:1], True)


def test_thirty_days_are_too_many(spark):
    def rec(i, day):
        return (i, "ANA MARIA", "PAZ VERA", "PAZ VERA ANA MARIA", "2", dt.date(1999, 3, day))

    people = spark.createDataFrame([rec("r1", 1)], REG)
    pivot = spark.createDataFrame([rec("p30", 31), rec("p29", 30), rec("p0", 1)], PIV)
    found = fuzzy_match(people, pivot, FUZZY_RULES, True)
    labels = [r.label for r in FUZZY_RULES]
    assert rows(found, "p_idp", "id_etiqueta") == [("p0", labels[0]), ("p29", labels[1])]


def test_used_once(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "c")], "p_idr string, p_idp string")
    assert rows(used_once(df), "p_idr", "p_idp") == [("2", "c")]


def profiles(spark, side, names, more=()):
    from idweave.operators.fuzzy import _profiles
    from idweave.spec import FuzzyRule

    name = F.element_at(F.array(*map(F.lit, names)), (F.col("id") + 1).cast("int"))
    table = spark.range(len(names)).select(*[name.alias(c) for c in ("p_nombres", "p_apellidos", "p_nombres_apellidos", "p_idr")], F.lit("1").alias("p_sexo"))
    return _profiles(table, side, FuzzyRule("r", date=None), (), more)


def test_candidates_are_close(spark):
    """Names that share grams, even the first ones, are no candidates when most of their grams differ; those that are
    close stay, repeats of a gram included."""
    people = ["AB CDEFGHIJKLMNOPQRSTUVWX", "ABABABABAB XY"]
    asked = ["AB YZXWVUTSRQPONMLKJIHGFED", "AB CDEFGHIJKLMNOPQRSTUVWXY", "ABABABABABAB XY"]
    people, asked = (profiles(spark, side, names) for side, names in (("r", people), ("p", asked)))
    found = candidates(people, asked, 0, 0.8).join(asked, "p_no").join(people, "r_no")
    assert rows(found, "p_full", "r_full") == [
        ("AB CDEFGHIJKLMNOPQRSTUVWXY", "AB CDEFGHIJKLMNOPQRSTUVWX"),
        ("ABABABABABAB XY", "ABABABABAB XY"),
    ]


def test_unfolded_profiles_are_not_broadcast(spark):
    """Small files may unfold into rows that no driver holds."""
    people, asked = (profiles(spark, side, ["ANA MARIA PAZ", "LUIS VERA"], more) for side, more in (("r", ["p_idr"]), ("p", [])))
    plan = fuzzy_pairs(people, asked, 0, False)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_unlike_blocks_are_refused(spark):
    from idweave.spec import FuzzyRule

    with pytest.raises(ValueError, match="block"):
        fuzzy_match(None, None, [FuzzyRule("a"), FuzzyRule("b", date="p_fecha_de_fatte")], True)


def test_pairs_are_compared_where_they_meet(spark):
    """Both sides are shuffled once, unfolded by gram. Pairs, of which there may be many more, are not."""
    people, asked = (profiles(spark, side, ["ANA MARIA PAZ", "LUIS VERA"], more) for side, more in (("r", ["p_idr"]), ("p", [])))
    pairs = fuzzy_pairs(people, asked, 0, False)
    assert pairs._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2
    assert rows(pairs, "p_no", "p_idr") == [(r.p_no, r.p_idr) for r in people.selectExpr("r_no as p_no", "p_idr").sort("p_no").collect()]


@pytest.mark.parametrize("wide", "pr")
def test_pairs_meet_once(spark, wide):
    """Names that share many grams, with dates near enough for several buckets."""
    from idweave.operators.fuzzy import _profiles

    names = ["ANA MARIA PAZ VERA", "ANA MARIA PAZ VERAS", "ANANANA PAZ"]
    recs = [(str(i), n, n, n, "1", START + dt.timedelta(days=d)) for i, n in enumerate(names) for d in (0, 20, 29, 50)]
    people, asked = (_profiles(spark.createDataFrame(recs, REG), side, FUZZY_RULES[1], ()) for side in "rp")
    found = candidates(people, asked, 30, 0.8, wide)
    near = sum(abs((a[5] - b[5]).days) < 30 for a in recs for b in recs if a[0] == b[0] or {a[0], b[0]} == {"0", "1"})
    assert found.count() == found.select("p_no", "r_no").distinct().count() == near


def test_steps_find_the_same(spark, monkeypatch):
    """A search in several steps, some of them parts of a single gram, equals the search of all pairs."""
    from idweave.operators import fuzzy

    rng = random.Random(3)
    people = [person(rng, i, "r", 90) for i in range(60)]
    pivot = [person(rng, i, "p", 90) for i in range(60)]
    taken = []

    def steps_of(volumes, most):
        taken.extend(plan(volumes, sum(volumes.values()) // 12))
        return taken

    plan = fuzzy.steps_of
    monkeypatch.setattr(fuzzy, "steps_of", steps_of)
    found = fuzzy_match(spark.createDataFrame(people, REG), spark.createDataFrame(pivot, PIV), FUZZY_RULES, True)
    assert rows(found, "p_idp", "p_idr", "id_etiqueta", "semidifuso") == brute(people, pivot, FUZZY_RULES, True)
    assert len(taken) > 5 and max(step.parts for step in taken) > 1


def test_steps_have_all_grams_once():
    from idweave.operators.fuzzy import Step, steps_of

    assert steps_of({}, 10) == steps_of({3: 4, 5: 6}, 10) == [Step()]
    assert steps_of({0: 25, 7: 10, 9: 1, 12: 11}, 10) == [
        *(Step(0, 1, part, 3) for part in range(3)), Step(1, 9), Step(9, 12), Step(12, 13, 0, 2), Step(12, 13, 1, 2)
    ]
    for most in (1, 5, 17, 200):
        volumes = {place: place % 13 + 1 for place in range(0, 300, 3)}
        for place, volume in volumes.items():
            mine = [s for s in steps_of(volumes, most) if s.low <= place and (s.high is None or place < s.high)]
            assert sorted(s.part for s in mine) == list(range(mine[0].parts)) and volume <= most * mine[0].parts


def test_persons_used_once_read_stored_matches(spark, tmp_path):
    """f05 reads the matches twice, so they are stored: the search is in no plan twice."""
    import __spark_entry__ as entry

    spark.range(40).selectExpr("id as c_custkey", "id % 5 as c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(600).selectExpr("id as o_orderkey", "id % 37 as o_custkey").write.parquet(f"{tmp_path}/orders.parquet")
    used = entry.queries()["f05_unico"](spark, str(tmp_path))
    assert "Window" not in used._jdf.queryExecution().executedPlan().toString()
    matches = rows(entry.queries()["f02_fuzzy_range"](spark, str(tmp_path)), "p_idr", "id_hash")
    persons = [m[0] for m in matches]
    once = [m for m in matches if persons.count(m[0]) == 1]
    assert once and len(once) < len(matches) and rows(used, "p_idr", "id_hash") == once
