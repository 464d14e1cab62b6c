"""ANSI SQL counterparts of the registered queries, as run by DuckDB on the same tables.

Written rule by rule and row by row, with plain joins and windows, independently of how the
library plans the same work.
"""

from __future__ import annotations

from typing import NamedTuple

from linkage_fixtures import PV_SQL, REGISTRY_SQL, REPEATED_KEY


class Rule(NamedTuple):
    label: str
    keys: tuple[str, ...]
    unique: bool = False


# Labels, key columns, order, and whether the registry must be unique on the key. Kept apart from the
# library's own table, so that a slip there shows.
RULES = [
    Rule("id_cedula_nombre_apell", ("p_cedula", "p_nombres", "p_apellidos")),
    Rule("id_cedula_nombreyapllido", ("p_cedula", "p_nombres_apellidos")),
    Rule("id_cedula_sexo_fna", ("p_cedula", "p_sexo", "p_fecha_nac")),
    Rule("id_nombre_apell_sexo_fnac", ("p_nombres", "p_apellidos", "p_sexo", "p_fecha_nac")),
    Rule("id_nombreyapell_sexo_fnac", ("p_nombres_apellidos", "p_sexo", "p_fecha_nac")),
    Rule("id_cedula_iniciales_sexo", ("p_cedula", "iniciales", "p_sexo")),
    Rule("id_apell_sexo_fnac", ("p_apellidos", "p_sexo", "p_fecha_nac"), True),
    Rule("id_cedulma_fna_sexo", ("p_cedula_mad", "p_fecha_nac", "p_sexo"), True),
    Rule("id_cedulpa_fna_sexo", ("p_cedula_pad", "p_fecha_nac", "p_sexo"), True),
    Rule("id_cedulma_nombre_apell", ("p_cedula_mad", "p_nombres", "p_apellidos")),
    Rule("id_cedulma_nombreyapell", ("p_cedula_mad", "p_nombres_apellidos")),
    Rule("id_cedulpa_nombre_apell", ("p_cedula_pad", "p_nombres", "p_apellidos")),
    Rule("id_cedulpa_nombreyapell", ("p_cedula_pad", "p_nombres_apellidos")),
    Rule("id_cedulma_iniciale_sexo", ("p_cedula_mad", "iniciales", "p_sexo"), True),
    Rule("id_cedulpa_iniciale_sexo", ("p_cedula_pad", "iniciales", "p_sexo"), True),
    Rule("id_cedulma_apell", ("p_cedula_mad", "p_apellidos"), True),
    Rule("id_cedulpa_apell", ("p_cedula_pad", "p_apellidos"), True),
]

CONCEPTS = [
    "p_cedula",
    "p_nombres",
    "p_apellidos",
    "p_nombres_apellidos",
    "p_sexo",
    "p_fecha_nac",
    "p_cedula_mad",
    "p_cedula_pad",
]
REG_NAMES = "p_nombres_reg, p_apellidos_reg, p_nombres_apellidos_reg"


def initials(x: str) -> str:
    words = f"list_filter(string_split_regex({x}, '\\s+'), lambda w: w <> '')"
    return (
        f"case when length({x}) > 0 then array_to_string(list_transform({words}, lambda w: upper(substr(w, 1, 1))), '') end"
    )


def date_of(x: str) -> str:
    return (
        f"try_cast(regexp_replace(regexp_replace({x}, '[0-9][0-9]:[0-9][0-9]:.*', ''), '\\s+', '', 'g') as date)"
    )


FULL_NAME = "coalesce(nullif(nombres_apellidos, ''), concat_ws(' ', apellidos, nombres))"

FIXTURES = {
    "registry": REGISTRY_SQL.format(customer="customer"),
    "pv": PV_SQL.format(orders="orders", registry="registry"),
    "reg0": f"select p_cedula p_idr, {', '.join(c for c in CONCEPTS if c != 'p_fecha_nac')}, "
    f"{date_of('p_fecha_nac')} p_fecha_nac, {initials('p_nombres_apellidos')} iniciales from registry",
    "piv_all": f"select id_hash p_idp, cls, truth, cedula p_cedula, nombres p_nombres, apellidos p_apellidos, "
    f"{FULL_NAME} p_nombres_apellidos, sexo p_sexo, {date_of('fecha_nac')} p_fecha_nac, "
    f"cedula_mad p_cedula_mad, cedula_pad p_cedula_pad, id_hash, {initials(FULL_NAME)} iniciales, "
    "id_etiqueta old_label from pv",
    "piv": f"select p_idp, {', '.join(CONCEPTS)}, id_hash, iniciales from piv_all",
}
PIVOT = f"{', '.join(CONCEPTS)}, id_hash, iniciales"

# The same for the pivot that knows full names, sex and date only.
FULL_FIXTURES = {
    "registry": FIXTURES["registry"],
    "pv": FIXTURES["pv"],
    "reg0": FIXTURES["reg0"],
    "piv": "select id_hash p_idp, full_name p_nombres_apellidos, sexo p_sexo, "
    f"{date_of('fecha_nac')} p_fecha_nac, id_hash, {initials('full_name')} iniciales "
    f"from (select *, coalesce(nombres_apellidos, concat_ws(' ', apellidos, nombres)) full_name from pv)",
}
FULL_PIVOT = "p_nombres_apellidos, p_sexo, p_fecha_nac, id_hash, iniciales"


def statement(ctes: dict[str, str], final: str) -> str:
    return "with " + ",\n".join(f"{n} as materialized ({q})" for n, q in ctes.items()) + "\n" + final


# --- names -----------------------------------------------------------------------------


def grams(x: str) -> str:
    return f"list_transform(range(1, length({x})), lambda i: substr({x}, cast(i as integer), 2))"


def _n(items: str, x: str) -> str:
    return f"len(list_filter({items}, lambda y: y = {x}))"


def norm(items: str) -> str:
    return (
        f"sqrt(cast(coalesce(list_sum(list_transform(list_distinct({items}), "
        f"lambda x: {_n(items, 'x')} * {_n(items, 'x')})), 0) as double))"
    )


def cosine(a: str, b: str) -> str:
    """Distance of names a and b whose grams are in columns g_a and g_b."""
    dot = (
        f"coalesce(list_sum(list_transform(list_intersect(list_distinct(g_{a}), list_distinct(g_{b})), "
        f"lambda x: {_n(f'g_{a}', 'x')} * {_n(f'g_{b}', 'x')})), 0)"
    )
    return (
        f"cast(case when {a} is null or {b} is null or length({a}) < 2 or length({b}) < 2 then 0.8 "
        f"else 1 - abs({dot} / {norm(f'g_{a}')} / {norm(f'g_{b}')}) end as float)"
    )


NAMES = ("p_nombres", "p_apellidos", "p_nombres_apellidos")


def with_distances(pairs: str) -> str:
    """Pairs plus d_nombres, d_apellidos, d_full."""
    gram_columns = ", ".join(f"{grams(c)} g_{c}" for n in NAMES for c in (n, f"{n}_reg"))
    out = ", ".join(
        f"{cosine(n, f'{n}_reg')} d_{s}" for n, s in zip(NAMES, ("nombres", "apellidos", "full"), strict=True)
    )
    drop = ", ".join(f"g_{c}" for n in NAMES for c in (n, f"{n}_reg"))
    return f"select * exclude ({drop}), {out} from (select *, {gram_columns} from ({pairs}))"


INV_N = "1.0::double / nullif(greatest(length(p_nombres), length(p_nombres_reg)), 0)"
INV_A = "1.0::double / nullif(greatest(length(p_apellidos), length(p_apellidos_reg)), 0)"
WEIGHTS = f"({INV_N}) / (({INV_N}) + ({INV_A})) w_n, ({INV_A}) / (({INV_N}) + ({INV_A})) w_a"
SCORE = "greatest(cast(d_full as double), d_nombres * w_n + d_apellidos * w_a)"


def with_score(pairs: str, parts: bool = True) -> str:
    """Pairs plus semidifuso."""
    if not parts:
        g = ", ".join(f"{grams(c)} g_{c}" for c in ("p_nombres_apellidos", "p_nombres_apellidos_reg"))
        d = cosine("p_nombres_apellidos", "p_nombres_apellidos_reg")
        return (
            "select * exclude (g_p_nombres_apellidos, g_p_nombres_apellidos_reg), "
            f"{d} semidifuso from (select *, {g} from ({pairs}))"
        )
    return (
        f"select * exclude (d_nombres, d_apellidos, d_full, w_n, w_a), {SCORE} semidifuso "
        f"from (select *, {WEIGHTS} from ({with_distances(pairs)}))"
    )


def best(query: str, by: str = "p_idp") -> str:
    return (
        f"select * exclude (rn) from (select *, row_number() over (partition by {by} order by semidifuso, p_idr) rn "
        f"from ({query})) where rn = 1"
    )


# --- cascade ---------------------------------------------------------------------------


def unique(table: str, keys: tuple[str, ...]) -> str:
    return (
        f"select * exclude (n) from (select *, count(*) over (partition by {', '.join(keys)}) n from {table}) "
        "where n = 1"
    )


def matched(table: str, pivot: str, rule: Rule, columns: str) -> str:
    on = " and ".join(f"r.{k} = p.{k}" for k in rule.keys)
    return f"select r.p_idr, p.p_idp, {', '.join('p.' + c.strip() for c in columns.split(','))}, '{rule.label}' id_etiqueta from {table} r join {pivot} p on {on}"


def names_of(table: str) -> str:
    renamed = ", ".join(f"{n} {n}_reg" for n in NAMES)
    return f"select p_idr, {renamed} from {table}"


def cascade(ctes: dict[str, str], rules=RULES, columns: str = PIVOT) -> dict[str, str]:
    """Adds m (all matches), rest (pivot left) and reg (registry left)."""
    ctes = dict(ctes)
    reg, piv, parts = "reg0", "piv", []
    for i, rule in enumerate(rules):
        if rule.unique:
            ctes[f"reg{i + 1}"] = unique(reg, rule.keys)
            reg = f"reg{i + 1}"
        ctes[f"m{i}"] = matched(reg, piv, rule, columns)
        ctes[f"piv{i + 1}"] = f"select * from {piv} where p_idp not in (select p_idp from m{i})"
        piv = f"piv{i + 1}"
        parts.append(f"select * from m{i}")
    ctes["m"] = " union all ".join(parts)
    ctes["rest"] = f"select * from {piv}"
    ctes["reg"] = f"select * from {reg}"
    ctes["names"] = names_of("reg")
    return ctes


def validation(ctes: dict[str, str], parts: bool = True) -> dict[str, str]:
    ctes = dict(ctes)
    ctes["named"] = f"select m.*, {REG_NAMES} from m left join names using (p_idr)"
    ctes["scored"] = with_score("select * from named", parts)
    ctes["validated"] = "select * exclude (semidifuso) from (" + best("select * from scored where semidifuso < 0.20") + ")"
    ctes["recovered"] = "select * from named except select * from validated"
    return ctes


def block_pairs(reg: str, piv: str, on: str, parts: bool = True) -> str:
    keep = ", ".join(f"r.{n} {n}_reg" for n in NAMES)
    return f"select p.*, r.p_idr, {keep} from {reg} r join {piv} p on r.p_sexo = p.p_sexo and {on}"


SAME_DATE = "r.p_fecha_nac = p.p_fecha_nac"
NEAR_DATE = "abs(date_diff('day', r.p_fecha_nac, p.p_fecha_nac)) < 30"


def fuzzy(reg: str, piv: str, on: str, label: str, parts: bool = True) -> str:
    scored = with_score(block_pairs(reg, piv, on), parts)
    return f"select *, '{label}' id_etiqueta from (" + best(f"select * from ({scored}) where semidifuso < 0.20") + ")"


def residual(piv: str, names: str, own: str = "p.p_cedula", parts: bool = True) -> str:
    joined = f"select p.*, {own} p_idr, {REG_NAMES} from {piv} p left join {names} n on n.p_idr = {own}"
    return with_score(joined, parts)


def settled(scored: str, accept: str, label: str) -> str:
    return f"select *, '{label}' id_etiqueta from (" + best(f"select * from {scored} where {accept}") + ")"


def linkage(full_only: bool = False, drop_matched: bool = False, base: dict[str, str] | None = None) -> dict[str, str]:
    """Adds the four outcomes: matched, not_found, validated, residual."""
    parts = not full_only
    columns = FULL_PIVOT if full_only else PIVOT
    base = base or (FULL_FIXTURES if full_only else FIXTURES)
    have = {c.strip() for c in columns.split(",")}
    rules = [r for r in RULES if have.issuperset(r.keys)]
    ctes = validation(cascade(base, rules, columns), parts)
    outcome = f"p_idr, p_idp, {columns}, id_etiqueta, {REG_NAMES}"
    left = "reg"
    if drop_matched:
        ctes["reg_left"] = "select distinct * from reg where p_idr not in (select p_idr from m)"
        left = "reg_left"
    ctes["f1"] = fuzzy(left, "rest", SAME_DATE, "idif_sexo_fna_N_A", parts)
    ctes["rest2"] = "select * from rest where p_idp not in (select p_idp from f1)"
    ctes["f2"] = fuzzy(left, "rest2", NEAR_DATE, "idif_sexo_fna_N_A_30", parts)
    ctes["rest3"] = "select * from rest2 where p_idp not in (select p_idp from f2)"
    ctes["matched"] = " union all ".join(f"select {outcome} from {t}" for t in ("recovered", "f1", "f2"))
    ctes["unresolved"] = residual("rest3", "names", "cast(null as varchar)" if full_only else "p.p_cedula", parts)
    ctes["residual"] = settled("unresolved", "semidifuso < 0.2", "match cedula")
    ctes["not_found"] = settled("unresolved", "semidifuso >= 0.2", "no encontrado")
    return ctes


def outcomes(full_only: bool = False) -> str:
    columns = FULL_PIVOT if full_only else PIVOT
    shown = f"p_idr, {columns}, id_etiqueta, {REG_NAMES}"
    score = {"residual": "round(cast(semidifuso as double), 6)", "not_found": "round(cast(semidifuso as double), 6)"}
    parts = [
        f"select '{t}' outcome, {shown}, {score.get(t, 'cast(null as double)')} semidifuso from {t}"
        for t in ("matched", "not_found", "validated", "residual")
    ]
    return " union all ".join(parts)


# --- write-back ------------------------------------------------------------------------

KNOWN = "p_nombres_reg is not null and p_apellidos_reg is not null"
UNKNOWN = "p_nombres_reg is null and p_apellidos_reg is null"
UPDATES = {
    "validated": ("validated", "validados", "true", "all"),
    "not_found": ("not_found", "no encontrado", "true", "none"),
    "recovered": ("matched", "recuperado", KNOWN, "all"),
    "recovered_no_names": ("matched", "recuperado", UNKNOWN, "id"),
    "residual": ("residual", "residuales", KNOWN, "all"),
    "residual_no_names": ("residual", "residuales", UNKNOWN, "id"),
}
SOURCE = (
    "select id_hash, cls, cedula, nombres, apellidos, nombres_apellidos, sexo, fecha_nac, cedula_mad, cedula_pad, "
    "id_etiqueta, cast(null as varchar) estado_identidad, cast(null as varchar) p_nombres_apellidos from pv"
)


def merged(ctes: dict[str, str], steps: list[str]) -> str:
    """The updates as a chain of CTEs, one after the other. Where an outcome has several rows for one key, the lowest
    score it knows decides, then the lowest person, then label and names."""
    ctes = dict(ctes)
    ctes["t0"] = SOURCE
    names = ", ".join(f"{n.strip()} nulls first" for n in REG_NAMES.split(","))
    for i, step in enumerate(steps):
        outcome, state, rows, sets = UPDATES[step]
        ctes[f"u{i}"] = (
            f"select * exclude (rn) from (select id_hash, p_idr, id_etiqueta, {REG_NAMES}, row_number() over "
            f"(partition by id_hash order by {'semidifuso, ' if outcome in ('residual', 'not_found') else ''}"
            f"p_idr nulls last, id_etiqueta, {names}) rn from {outcome} where {rows}) where rn = 1"
        )

        def value(column: str, new: str) -> str:
            return f"case when u.id_hash is not null then {new} else t.{column} end {column}"

        new = {"id_etiqueta": "u.id_etiqueta", "estado_identidad": f"'{state}'"}
        if sets in ("all", "id"):
            new |= {"cedula": "u.p_idr", "nombres_apellidos": "u.p_nombres_apellidos_reg"}
        if sets == "all":
            new |= {"nombres": "u.p_nombres_reg", "apellidos": "u.p_apellidos_reg"}
        columns = ", ".join(
            value(c, new[c]) if c in new else f"t.{c}"
            for c in (
                "id_hash cls cedula nombres apellidos nombres_apellidos sexo fecha_nac cedula_mad cedula_pad "
                "id_etiqueta estado_identidad p_nombres_apellidos"
            ).split()
        )
        ctes[f"t{i + 1}"] = f"select {columns} from t{i} t left join u{i} u on t.id_hash = u.id_hash"
    return statement(ctes, f"select * from t{len(steps)}")


# --- all queries -----------------------------------------------------------------------

TRUTH_PAIRS = (
    "select p.id_hash, r.p_idr, "
    + ", ".join(f"p.{n}, r.{n} {n}_reg" for n in NAMES)
    + " from piv_all p join reg0 r on r.p_idr = p.truth"
)
SOURCE_COLUMNS = "id_hash, cedula, nombres, apellidos, nombres_apellidos, sexo, fecha_nac, cedula_mad, cedula_pad"
MAPPED = ", ".join(
    f"{c} p_{c}" for c in "cedula nombres apellidos nombres_apellidos sexo fecha_nac cedula_mad cedula_pad".split()
)


def r6(x: str, name: str) -> str:
    # Adding zero turns a negative zero into the plain one.
    return f"round(cast({x} as double), 6) + 0.0::double {name}"


def all_sql() -> dict[str, str]:
    fixtures = dict(FIXTURES)
    names0 = fixtures | {"names": names_of("reg0")}
    link, casc = linkage(), cascade(FIXTURES)
    valid = validation(casc)
    full = linkage(full_only=True)
    # Row ids stay unique while keys repeat.
    repeated = linkage(
        base=FIXTURES
        | {
            "pv": f"select * replace ({REPEATED_KEY} as id_hash), id_hash as row_id from ({FIXTURES['pv']})",
            "piv_all": FIXTURES["piv_all"].replace("select id_hash p_idp", "select row_id p_idp"),
        }
    )
    sql = {
        "s03_mapped_projection": statement(fixtures, f"select {MAPPED}, id_hash from pv"),
        "s04_missing_defaults": statement(
            fixtures,
            "select cedula p_cedula, cast(null as varchar) p_nombres, apellidos p_apellidos, '2' p_sexo, id_hash from pv",
        ),
        "s05_pending_filter": statement(
            fixtures, f"select {MAPPED}, id_hash from pv where id_etiqueta = 'no encontrado' or id_etiqueta is null"
        ),
        "s06_registry_scope": statement(fixtures, "select * from registry where substring(id_hash_rp, 1, 5) = '00101'"),
        "s07_registry_pruned": statement(
            fixtures,
            "select p_cedula, p_nombres, p_apellidos, p_nombres_apellidos, p_sexo, p_fecha_nac, "
            "p_cedula_mad p_identidad_mad, p_cedula_pad p_identidad_pad from registry",
        ),
        "n03_row_id": statement(
            fixtures,
            "select id_hash, count(*) row_count, count(*) id_count "
            "from (select 'k' || right(id_hash, 2) id_hash, sexo from pv) group by id_hash",
        ),
        "n05_full_name": statement(fixtures, "select id_hash, concat_ws(' ', apellidos, nombres) full_name from pv"),
        "n06_full_name_fallback": statement(fixtures, f"select id_hash, {FULL_NAME} full_name from pv"),
        "n07_initials": statement(
            fixtures, f"select id_hash, {initials(FULL_NAME)} iniciales from pv"
        ),
        "n08_normalize_date": statement(fixtures, f"select id_hash, {date_of('fecha_nac')} p_fecha_nac from pv"),
    }
    for i, rule in enumerate(RULES):
        ctes = dict(fixtures)
        reg = "reg0"
        if rule.unique:
            ctes["reg1"], reg = unique("reg0", rule.keys), "reg1"
        shown = f"p_idr, {PIVOT}, id_etiqueta"
        sql[f"d{i + 1:02d}_{rule.label}"] = statement(ctes, f"select {shown} from ({matched(reg, 'piv', rule, PIVOT)})")
    d07 = RULES[6].keys
    sql |= {
        "u01_unique_key": statement(fixtures, unique("reg0", d07)),
        "u02_ambiguous_key": statement(fixtures, unique("reg0", d07).replace("n = 1", "n > 1")),
        "c01_unmatched": statement(casc, f"select {PIVOT} from rest"),
        "c04_registry_remaining": statement(
            fixtures | {"d": matched("reg0", "piv", RULES[9], PIVOT)},
            "select distinct * from reg0 where p_idr not in (select p_idr from d)",
        ),
        "j00_cascade": statement(casc, f"select p_idr, {PIVOT}, id_etiqueta from m"),
        "m01_bigrams": statement(
            fixtures, f"select p_idr, array_to_string({grams('p_nombres_apellidos')}, '|') grams from reg0"
        ),
        "m02_norm": statement(
            fixtures,
            f"select p_idr, cast(len(g) as bigint) n_grams, {r6(norm('g'), 'norm')} "
            f"from (select p_idr, {grams('p_nombres_apellidos')} g from reg0)",
        ),
        "m03_cosine_distance": statement(
            fixtures,
            f"select id_hash, p_idr, {r6('d_nombres', 'd_nombres')}, {r6('d_apellidos', 'd_apellidos')}, "
            f"{r6('d_full', 'd_full')} from ({with_distances(TRUTH_PAIRS)})",
        ),
        "m04_set_cosine": statement(
            fixtures,
            "select id_hash, p_idr, round(case when length(a) > 0 and length(b) > 0 then "
            "len(list_intersect(sa, sb)) / sqrt(cast(len(sa) * len(sb) as double)) end, 6) set_cosine from ("
            "select id_hash, p_idr, p_nombres_apellidos a, p_nombres_apellidos_reg b, "
            "list_distinct(string_split(p_nombres_apellidos, '')) sa, "
            f"list_distinct(string_split(p_nombres_apellidos_reg, '')) sb from ({TRUTH_PAIRS}))",
        ),
        "m05_name_weights": statement(
            fixtures,
            f"select id_hash, p_idr, round(w_n, 6) w_n, round(w_a, 6) w_a from (select *, {WEIGHTS} from ({TRUTH_PAIRS}))",
        ),
        "m06_name_score": statement(
            fixtures, f"select id_hash, p_idr, {r6('semidifuso', 'semidifuso')} from ({with_score(TRUTH_PAIRS)})"
        ),
        "m07_full_name_score": statement(
            fixtures, f"select id_hash, p_idr, {r6('semidifuso', 'semidifuso')} from ({with_score(TRUTH_PAIRS, False)})"
        ),
        "v01_attach_names": statement(
            casc, f"select p_idr, id_hash, id_etiqueta, {REG_NAMES} from m left join names using (p_idr)"
        ),
        "v02_validated": statement(valid, f"select p_idr, {PIVOT}, id_etiqueta, {REG_NAMES} from validated"),
        "v03_recovered": statement(valid, f"select p_idr, {PIVOT}, id_etiqueta, {REG_NAMES} from recovered"),
        "f01_fuzzy_block": statement(
            fixtures | {"f": fuzzy("reg0", "piv", SAME_DATE, "idif_sexo_fna_N_A")},
            f"select p_idr, id_hash, id_etiqueta, {r6('semidifuso', 'semidifuso')} from f",
        ),
        "f02_fuzzy_range": statement(
            fixtures | {"f": fuzzy("reg0", "piv", NEAR_DATE, "idif_sexo_fna_N_A_30")},
            f"select p_idr, id_hash, id_etiqueta, {r6('semidifuso', 'semidifuso')} from f",
        ),
        "f06_custom_block": statement(
            fixtures
            | {"f": fuzzy("reg0", "piv", f"{NEAR_DATE} and left(r.p_nombres, 1) = left(p.p_nombres, 1)", "idif_sexo_inicial_fna_30")},
            f"select p_idr, id_hash, id_etiqueta, left(p_nombres, 1) inicial, {r6('semidifuso', 'semidifuso')} from f",
        ),
        "f03_best_candidate": statement(
            names0
            | {
                "d": matched("reg0", "piv", RULES[4], PIVOT),
                "s": with_score(f"select d.*, {REG_NAMES} from d join names using (p_idr)"),
            },
            f"select p_idr, id_hash, {r6('semidifuso', 'semidifuso')} from ({best('select * from s')})",
        ),
        "f05_unico": statement(
            fixtures | {"f": fuzzy("reg0", "piv", NEAR_DATE, "idif_sexo_fna_N_A_30")},
            "select p_idr, id_hash from f where p_idr in (select p_idr from f group by p_idr having count(*) = 1)",
        ),
        "r01_residual_join": statement(
            names0, f"select p.p_cedula p_idr, id_hash, {REG_NAMES} from piv p left join names n on n.p_idr = p.p_cedula"
        ),
        "r02_residuals": statement(
            names0 | {"s": residual("piv", "names")},
            f"select p_idr, {PIVOT}, id_etiqueta, {REG_NAMES}, {r6('semidifuso', 'semidifuso')} "
            f"from ({settled('s', 'semidifuso < 0.2', 'match cedula')})",
        ),
        "r03_not_found": statement(
            names0 | {"s": residual("piv", "names")},
            f"select p_idr, {PIVOT}, id_etiqueta, {REG_NAMES}, {r6('semidifuso', 'semidifuso')} "
            f"from ({settled('s', 'semidifuso >= 0.2', 'no encontrado')})",
        ),
        "j01_full_linkage": statement(link, outcomes()),
        "j01_full_name_pivot": statement(full, outcomes(full_only=True)),
        "j02_drop_matched": statement(linkage(drop_matched=True), outcomes()),
        "a01_label_counts": statement(valid, 'select id_etiqueta, count(*) "count" from recovered group by id_etiqueta'),
        "a02_total": statement(valid, "select count(*) total from recovered"),
        "a03_outcome_summary": statement(
            link,
            'select id_etiqueta, count(*) "count" from matched group by id_etiqueta '
            "union all select 'total deterministico', count(*) from recovered "
            "union all select 'total difuso', (select count(*) from matched) - (select count(*) from recovered) "
            "union all select 'total encontrados', count(*) from matched "
            "union all select 'No encontrados', count(*) from unresolved "
            "union all select 'Validados', count(*) from validated",
        ),
        "w01_schema_growth": statement(
            fixtures,
            "select id_hash, cedula, id_etiqueta, cast(null as varchar) estado_identidad, "
            "cast(null as varchar) p_nombres_apellidos from pv",
        ),
        "w03_validated": merged(link, ["validated"]),
        "w04_not_found": merged(link, ["not_found"]),
        "w05_recovered": merged(link, ["recovered"]),
        "w06_recovered_no_names": merged(link, ["recovered_no_names"]),
        "w07_residual": merged(link, ["residual"]),
        "w08_residual_no_names": merged(link, ["residual_no_names"]),
        "w09_merged": merged(link, list(UPDATES)),
        "w10_from_written": merged(link, list(UPDATES)),
        "w12_repeated_key": merged(repeated, list(UPDATES)),
    }
    return sql
