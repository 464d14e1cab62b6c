"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The table of the reflected CRC-32 polynomial, from its rule: one shift for each bit.
CRC_TABLE = (
    "select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), "
    "lambda c, z: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end)) as t"
)


def crc32(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes; the table ``t`` of ``CRC_TABLE`` is in reach."""
    number = lambda digit: f"(instr('0123456789ABCDEF', {digit}) - 1)"
    digit = lambda i: f"substr(hex(encode({text})), cast({i} as integer), 1)"
    octets = f"list_transform(range(strlen({text})), lambda i: {number(digit('2 * i + 1'))} * 16 + {number(digit('2 * i + 2'))})"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor(c // 256, t[cast(xor(c, b) % 256 + 1 as integer)])), 4294967295)"


def _field(value: str) -> str:
    return f"coalesce(strlen(cast({value} as varchar)) || ':' || cast({value} as varchar), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str, leaves: str) -> str:
    """Nodes of all levels over ``leaves`` (g, pos, size, node)."""
    return f"""{name}(level, g, pos, size, node) as (
  select 0, g, pos, size, node from {leaves}
  union all
  select level + 1, g, pos // 8, (size + 7) // 8, sha256(string_agg(node, '' order by pos))
  from {name} where size > 1 group by level, g, pos // 8, size)"""


def _siblings(name: str, tree: str) -> str:
    """What stands before and after each node in its run."""
    return f"""{name} as (
  select a.level, a.g, a.pos, coalesce(string_agg(b.node, '' order by b.pos) filter (b.pos < a.pos), '') left_of,
    coalesce(string_agg(b.node, '' order by b.pos) filter (b.pos > a.pos), '') right_of
  from {tree} a join {tree} b on a.level = b.level and a.g is not distinct from b.g and a.pos // 8 = b.pos // 8
  where a.size > 1 group by a.level, a.g, a.pos)"""


MERKLE = f"""with recursive crc as materialized ({CRC_TABLE}),
leaves as materialized (
  select doc_id, lang g, {_leaf('text')} node,
    case when {crc32("cast(doc_id as varchar)")} % 3 = 0 then {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} end tampered
  from documents, crc),
placed as materialized (
  select *, row_number() over (partition by g order by doc_id nulls first, node) - 1 pos, count(*) over (partition by g) size
  from leaves),
{_tree('tree', 'placed')},
subroots as materialized (
  select g lang, node, row_number() over (order by g nulls first) - 1 pos, count(*) over () size, 0 g from tree where size = 1),
{_tree('top', 'subroots')},
root as (select node from top where size = 1),
{_siblings('below', 'tree')},
{_siblings('above', 'top')},
paths as materialized (
  select p.g, p.pos, s.level step, s.left_of, s.right_of
  from placed p join below s on s.g is not distinct from p.g and s.pos = p.pos // cast(8 ** s.level as bigint)
  union all
  select p.g, p.pos, 100 + s.level, s.left_of, s.right_of
  from placed p join subroots r on r.lang is not distinct from p.g
  join above s on s.pos = r.pos // cast(8 ** s.level as bigint)),
numbered as materialized (select *, row_number() over (partition by g, pos order by step) n from paths),
fold(g, pos, n, node) as (
  select g, pos, cast(0 as bigint), coalesce(tampered, node) from placed
  union all
  select f.g, f.pos, f.n + 1, sha256(p.left_of || f.node || p.right_of)
  from fold f join numbered p on p.g is not distinct from f.g and p.pos = f.pos and p.n = f.n + 1),
proofs as (
  select g, pos, max(n) last, sha256(string_agg(left_of || right_of, '' order by n)) proof from numbered group by g, pos)
select p.doc_id, p.node leaf, s.node subroot, r.node root, coalesce(q.proof, sha256('')) proof_sha256,
  f.node folded_root, f.node = r.node verified
from placed p join subroots s on s.lang is not distinct from p.g cross join root r
left join proofs q on q.g is not distinct from p.g and q.pos = p.pos
join fold f on f.g is not distinct from p.g and f.pos = p.pos and f.n = coalesce(q.last, 0)"""


VARIANTS = f"""with recursive crc as materialized ({CRC_TABLE}),
runs as (
  select coalesce(cast(doc_id as varchar), '') id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) run from documents),
lowered as (
  select id, translate(run, '{UPPER}', '{LOWER}') w, count(*) n from runs where length(run) >= 6 group by all),
hashed as materialized (select w, n, {crc32("(id || ':' || w)")} h from lowered, crc),
edited as (
  select case when h % 199 = 0 then substr(w, 1, cast(h % length(w) as integer)) || substr(w, cast(h % length(w) + 2 as integer)) else w end word, n
  from hashed),
counts as materialized (
  select word, cast(sum(n) as bigint) n from edited where length(word) >= 6 group by word having sum(n) >= 5),
places as (select word, n, unnest(range(1, length(word) + 1)) i from counts),
cuts as materialized (
  select word, n, substr(word, 1, cast(i - 1 as integer)) || '_' || substr(word, cast(i + 1 as integer)) mask,
    substr(word, 1, cast(i - 1 as integer)) || substr(word, cast(i + 1 as integer)) shorter
  from places),
near as materialized (
  select a.word, b.word other, b.n from cuts a join cuts b on a.mask = b.mask and a.word <> b.word
  union
  select a.word, b.word, b.n from cuts a join counts b on a.shorter = b.word
  union
  select b.word, a.word, a.n from cuts a join counts b on a.shorter = b.word),
best as (
  select word, first(other order by n desc, other) other, max(n) n, count(*) n_near from near group by word),
forms as materialized (
  select c.word, c.n, coalesce(b.n_near, 0) n_near,
    case when b.n >= 5 * c.n then b.other end form, case when b.n >= 5 * c.n then b.n end form_n
  from counts c left join best b using (word)),
chains(word, here, n) as (
  select word, word, 0 from forms
  union all
  select c.word, f.form, c.n + 1 from chains c join forms f on f.word = c.here where f.form is not null),
roots as (select word, arg_max(here, n) root from chains group by word)
select word, form, root, n, n_near, form_n from forms join roots using (word)"""


def all_sql() -> dict[str, str]:
    return {"op11_merkle_manifest": MERKLE, "op12_spelling_variants": VARIANTS}
