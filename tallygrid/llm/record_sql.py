"""DuckDB SQL for the operators on records: Merkle manifest, WARC archives, conversation trie."""

from __future__ import annotations


def crc32_sql(name: str, ids: str) -> str:
    """CTEs (for `with recursive`) that end in `name` (id, c): the unsigned CRC-32 of each id of the query `ids`, written as text."""
    return f"""
{name}_bits as (select range as i, 0 as k, cast(range as bigint) as v from range(256)
  union all select i, k + 1, case when v % 2 = 1 then xor(v // 2, 3988292384) else v // 2 end from {name}_bits where k < 8),
{name}_run as (select id, cast(id as varchar) as s, 1 as p, cast(4294967295 as bigint) as c from ({ids})
  union all select r.id, r.s, r.p + 1, xor(r.c // 256, b.v) from {name}_run r join {name}_bits b on b.k = 8 and b.i = xor(r.c % 256, ascii(r.s[r.p])) where r.p <= len(r.s)),
{name} as (select id, xor(c, 4294967295) as c from {name}_run where p > len(s))"""


def _tree_sql(name: str, levels: int) -> str:
    """From `name`0 (g, pos, h): per level l the siblings `name`s<l> (g, pos, lt, rt, more), and `name`<levels>, a node a group."""
    parts = []
    for i in range(levels):
        near = {k: f"coalesce({f}(h, {n}) over r, '')" for k, (f, n) in {"a": ("lag", 2), "b": ("lag", 1), "c": ("lead", 1), "d": ("lead", 2)}.items()}
        parts.append(
            f"{name}s{i} as materialized (select g, pos, {near['a']} || {near['b']} as lt, {near['c']} || {near['d']} as rt, count(*) over (partition by g) > 1 as more "
            f"from {name}{i} window r as (partition by g, pos // 3 order by pos))"
        )
        parts.append(
            f"{name}{i + 1} as materialized (select g, pos // 3 as pos, case when any_value(more) then sha256(string_agg(h, '' order by pos)) else any_value(h) end as h "
            f"from {name}{i} join {name}s{i} using (g, pos) group by g, pos // 3)"
        )
    return ",\n".join(parts)


def _climb_sql(out: str, start: str, tree: str, levels: int, group: str) -> str:
    """From `start` (with f, p, spot and the group's column): fold and proof text over the levels of `tree`."""
    parts, last = [], start
    for i in range(levels):
        parts.append(
            f"{out}{i} as materialized (select d.* exclude (f, p, spot), case when s.more then sha256(s.lt || d.f || s.rt) else d.f end as f, "
            f"case when s.more then d.p || s.lt || s.rt else d.p end as p, d.spot // 3 as spot from {last} d join {tree}s{i} s on s.g = d.{group} and s.pos = d.spot)"
        )
        last = f"{out}{i}"
    return ",\n".join(parts)


#: Levels that serve 3 ** 12 documents a source and 3 ** 6 sources.
_LOW, _TOP = 12, 6


def _framed(column: str) -> str:
    return f"case when {column} is null then '-' else strlen(cast({column} as varchar)) || ':' || {column} end"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_framed(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


OP11 = f"""
with recursive {crc32_sql("crc", "select distinct doc_id as id from documents where doc_id is not null")},
d0 as (select *, coalesce('=' || source, '') as src, {_leaf("text")} as leaf, {_leaf("claimed")} as claim
  from (select d.*, case when c.c % 2 = 0 then replace(text, chr(10), '') else text end as claimed from documents d left join crc c on c.id = d.doc_id)),
d as materialized (select *, row_number() over (partition by src order by doc_id nulls first, leaf) - 1 as spot from d0),
n0 as (select src as g, spot as pos, leaf as h from d),
{_tree_sql("n", _LOW)},
m0 as (select 0 as g, row_number() over (order by g) - 1 as pos, h, g as src from n{_LOW}),
{_tree_sql("m", _TOP)},
low as (select doc_id, leaf, src, claim as f, '' as p, spot from d),
{_climb_sql("x", "low", "n", _LOW, "src")},
high as (select x.* exclude (spot), 0 as world, m0.h as subroot, m0.pos as spot from x{_LOW - 1} x join m0 using (src)),
{_climb_sql("y", "high", "m", _TOP, "world")}
select doc_id, leaf, subroot, h as root, sha256(p) as proof_sha256, f as folded_root, f = h as verified from y{_TOP - 1}, m{_TOP}
"""

OP12 = """
with p as (select page_id, coalesce(html, '') as h from pages),
d as (select page_id, strlen(h) as payload_bytes, sha256(h) as payload_digest from p),
m as (select *, payload_bytes >= 100 and page_id > min(page_id) over (partition by payload_digest) as again, min(page_id) over (partition by payload_digest) as head from d)
select page_id, payload_bytes, payload_digest, case when again then 'revisit' else 'response' end as record_type, case when again then head end as refers_to, true as intact from m
"""

OP13 = rf"""
with recursive {crc32_sql("crc", "select distinct conv_id as id from conversations where conv_id is not null")},
t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
k as (select conv_id, turn, md5(strlen(role) || ':' || role || text) as tid, len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) as words from t),
o as (select *, row_number() over (partition by conv_id order by turn nulls first, tid) as p from k),
c as (select id as c, crc.c % 4 as h, id - id % 20 as base from crc),
b as (select conv_id as base, count(*) as n from o group by conv_id),
w as (select c.c, least(c.h, coalesce(b.n, 0)) as lent, c.h, c.base from c left join b using (base)),
r as (select w.c, o.p as d, o.tid, o.words from w join o on o.conv_id = w.base and o.p <= w.h
  union all select w.c, w.lent + o.p - w.h, o.tid, o.words from w join o on o.conv_id = w.c and o.p > w.h),
x as (select c, d, words, string_agg(tid, '') over (partition by c order by d rows between unbounded preceding and current row) as key from r),
n as materialized (select key, d, count(*) as n, min(c) as c, (count(*) - 1) * any_value(words) as saved from x group by key, d
  union all select '', 0, count(*), min(c), 0 from w having count(*) > 0),
kids as (select left(key, 32 * (d - 1)) as key, count(*) as n_children from n where d > 0 group by 1),
f as (select n.*, coalesce(n_children, 0) as n_children from n left join kids on kids.key = n.key),
s as (select left(key, 32 * i) as key, count(*) filter (where n_children = 0) as n_leaves, sum(saved) as saved_tokens from (select *, unnest(range(d + 1)) as i from f) group by 1),
z as (select w.c, coalesce(max(x.key), '') as key from w left join x on x.c = w.c group by w.c),
e as (select key, sha256(string_agg(cast(c as varchar), ',' order by c)) as ends from z group by key)
select f.c as conv_id, f.d as depth, up.c as parent_conv_id, f.n as n_convs, f.n_children, s.n_leaves, cast(s.saved_tokens as bigint) as saved_tokens, coalesce(e.ends, sha256('')) as ends_sha256
from f join s using (key) left join e using (key) left join f up on f.d > 0 and up.key = left(f.key, 32 * (f.d - 1))
"""
