import random
import re

import pytest

import model
from idweave.functions import similarity

ALPHABETS = ["ab", "ABÑ é", "AEIOU LMNRST", "a😀 z"]


def names(n, seed=7):
    rng = random.Random(seed)
    fixed = [None, "", "a", "aa", "aaaa", "casa", "mesa", "JOSÉ LUIS", "JOSE LUIS", "ana ana ana ana"]
    made = ["".join(rng.choices(rng.choice(ALPHABETS), k=rng.randrange(0, 24))) for _ in range(n)]
    return [(a, rng.choice(fixed + made)) for a in fixed + made] + [(a, a) for a in fixed]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_distance_equals_row_by_row_definition(spark, conf, ansi):
    pairs = names(1500)
    with conf(spark__sql__ansi__enabled=ansi):
        df = spark.createDataFrame(pairs, "a string, b string")
        got = similarity.with_distance(df, {"d": ("a", "b")}).collect()
    assert [(r.a, r.b, r.d) for r in got] == [(a, b, model.distance(a, b)) for a, b in pairs]


def test_known_distances(spark):
    pairs = [("casa", "mesa"), ("JOSÉ LUIS", "JOSE LUIS"), ("aaaa", "aa"), ("a", "a"), (None, "x")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [round(r.d, 6) + 0.0 for r in similarity.with_distance(df, {"d": ("a", "b")}).collect()]
    assert got == [0.666667, 0.25, 0.0, 0.8, 0.8]


def test_ranking_keeps_norms(spark):
    df = spark.createDataFrame([(a,) for a, _ in names(200)], "a string")
    plain = similarity.with_grams(df, {"g": "a"}).select("g_n2").collect()
    ranked = similarity.with_grams(df, {"g": "a"}, list(range(similarity.SLOTS))[::-1]).select("g_n2").collect()
    assert plain == ranked


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_name_score(spark, conf, ansi):
    rng = random.Random(3)
    pool = [None, "", "ANA", "ANA MARIA", "ANNA MARIA", "LUIS", "PAZ VERA", "PAS VERA", "A"]
    data = [tuple(rng.choice(pool) for _ in range(6)) for _ in range(400)]
    columns = ["p_nombres", "p_nombres_reg", "p_apellidos", "p_apellidos_reg"]
    columns += ["p_nombres_apellidos", "p_nombres_apellidos_reg"]
    with conf(spark__sql__ansi__enabled=ansi):
        df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns))
        got = similarity.with_name_score(df).collect()
        full = similarity.with_name_score(df, parts=False)
        assert dict(full.dtypes)["semidifuso"] == "float"
        assert [r.semidifuso for r in full.collect()] == [model.distance(r[4], r[5]) for r in data]
    assert [r.semidifuso for r in got] == [model.score(*r) for r in data]


def test_set_cosine(spark):
    df = spark.createDataFrame([("aab", "b😀"), ("ab", "ab"), ("", "a"), (None, "a")], "a string, b string")
    got = [r.c for r in df.selectExpr(f"{similarity.set_cosine('a', 'b')} as c").collect()]
    assert got == [0.5, 1.0, None, None]


def test_bigrams(spark):
    df = spark.createDataFrame([("abc",), ("a",), (None,), ("😀é",)], "a string")
    got = [r.g for r in df.selectExpr(f"{similarity.bigrams('a')} as g").collect()]
    assert got == [["ab", "bc"], [], [], ["😀é"]]


def test_parts_are_found_in_any_case():
    assert similarity.has_parts(["P_NOMBRES", "p_apellidos"])
    assert not similarity.has_parts(["p_nombres"])


def test_distances_sort_only_names_with_repeated_grams(spark):
    df = spark.createDataFrame([(a,) for a, _ in names(300)], "a string")
    both = similarity.with_grams(df, {"g": "a"}).select("a", "g_u", "g_x", "g_n2").collect()
    plain = similarity.with_grams(df, {"g": "a"}, ordered=False).select("a", "g_u", "g_x", "g_n2").collect()
    assert [(r.a, sorted(r.g_u), sorted(r.g_x), r.g_n2) for r in both] == [(r.a, sorted(r.g_u), sorted(r.g_x), r.g_n2) for r in plain]
    pairs = spark.createDataFrame(names(5), "a string, b string")
    text = similarity.with_distance(pairs, {"d": ("a", "b")})._jdf.queryExecution().optimizedPlan().toString()
    # Every sort of grams stands behind the test that there is a repeat.
    assert text.count("sort_array(") == len(re.findall(r"if \(\(size\(_[ab]0_u#\d+, \w+\) = size\(_[ab]0_codes#\d+, \w+\)\)\) \[\] else sort_array\(", text))
    assert "sort_array(" in text
