"""DuckDB SQL for the queries that SQL can express, written apart from the Spark code."""

from __future__ import annotations

from upcheck.llm.host_quality import MAX_RATE, MAX_REPEATED_PERCENT, MIN_WORDS, STRONGEST
from upcheck.llm.vector_codes import ENTRIES, PARTS, ROUNDS, SCALE

_SPLIT = r"[x for x in string_split_regex({}, '[\x20\x09-\x0D]+') if x <> '']"
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SUFFIX_DEDUP = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
starts as (select doc_id, unnest(range(0, length(h) // 2 - 199)) as i from d where length(h) >= 400),
keys as (select s.doc_id, s.i, md5_number(substring(h, 2 * i + 1, 400)) as k from starts s join d using (doc_id)),
twice as (select doc_id, i from keys qualify count(*) over (partition by k) > 1),
marked as (select doc_id, i, case when i <= lag(i) over (partition by doc_id order by i) + 200 then 0 else 1 end as new from twice),
numbered as (select doc_id, i, sum(new) over (partition by doc_id order by i rows unbounded preceding) as run from marked),
spans as (select doc_id, run, min(i) as s, max(i) + 200 as e from numbered group by doc_id, run),
edges as (select doc_id, s, lag(e, 1, 0) over (partition by doc_id order by s) as before from spans
          union all select d.doc_id, length(h) // 2, coalesce(max(e), 0) from d left join spans using (doc_id) group by d.doc_id, h),
kept as (select doc_id, string_agg(substring(h, 2 * before + 1, 2 * (s - before)), '' order by s) as rest from edges join d using (doc_id) group by doc_id),
sums as (select doc_id, sum(e - s) as n_removed, count(*) as n_spans from spans group by doc_id)
select doc_id, cast(length(h) // 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
       cast(coalesce(n_spans, 0) as bigint) as n_spans, sha256(unhex(rest)) as kept_sha256
from d join kept using (doc_id) left join sums using (doc_id)
"""

SUBSTRING_DEDUP = f"""
with d as (select doc_id, {_SPLIT.format("coalesce(text, '')")} as w from documents),
windows as (select doc_id, i, array_to_string(w[i:i + 19], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 18)) as i from d)),
later as (select doc_id, i from windows qualify row_number() over (partition by g order by doc_id, i) > 1),
removed as (select distinct doc_id, unnest(range(i, i + 20)) as p from later),
words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from d),
kept as (select doc_id, string_agg(word, ' ' order by p) as rest, count(*) as n from words anti join removed using (doc_id, p) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed, sha256(coalesce(rest, '')) as kept_sha256
from d left join kept using (doc_id)
"""

HOST_QUALITY = f"""
with d as (select doc_id, source, coalesce(text, '') as t from documents),
w as (select doc_id, source, t, {_SPLIT.format("t")} as w,
             [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] as lines from d),
grams as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from w)),
twice as (select doc_id, i from grams qualify count(*) over (partition by doc_id, g) > 1),
hit as (select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from twice) group by doc_id),
m as (select doc_id, source, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
             cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
             cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines, cast(coalesce(n, 0) as bigint) as n_repeat_words
      from w left join hit using (doc_id)),
j as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words as base_failed from m),
hosts as (select source, count(*) as docs, sum(base_failed::int) as failed from j where source is not null group by source),
prior as (select avg(failed / docs) as mean, var_pop(failed / docs) as var from hosts),
fit as (select mean, case when var > 0 then least({STRONGEST}, greatest(0, mean * (1 - mean) / var - 1)) else {STRONGEST} end as weight from prior),
verdicts as (select source, (failed + mean * weight) / (docs + weight) <= {MAX_RATE} as ok from hosts, fit)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and coalesce(ok, true) as kept
from j left join verdicts using (source)
"""

JACCARD_JOIN = f"""
with recursive d as (select doc_id, {_SPLIT.format(f"translate(coalesce(text, ''), '{_CAPITALS}', '{_SMALL}')")} as w from documents),
s as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as g
      from (select doc_id, w, unnest(range(1, case when len(w) = 0 then 1 else greatest(len(w) - 3, 2) end)) as i from d)),
n as (select doc_id, count(*) as n from s group by doc_id),
links as (select a.doc_id as a, b.doc_id as b from s a join s b on a.g = b.g and a.doc_id < b.doc_id
          join n x on x.doc_id = a.doc_id join n y on y.doc_id = b.doc_id
          group by a.doc_id, b.doc_id, x.n, y.n having 100 * count(*) >= 75 * (x.n + y.n - count(*))),
both_ways as (select a, b from links union all select b, a from links),
reached as (select a as doc_id, b as other from both_ways union select r.doc_id, l.b from reached r join both_ways l on r.other = l.a),
least as (select doc_id, min(other) as other from reached group by doc_id)
select d.doc_id, coalesce(n, 0) as n_shingles, least(d.doc_id, coalesce(other, d.doc_id)) as component_id
from d left join n using (doc_id) left join least using (doc_id)
"""


def _field(column: str) -> str:
    return f"case when {column} is null then '-' else strlen({column}::varchar) || ':' || {column}::varchar end"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_field, ['doc_id', 'source', 'lang', 'n_chars', text]))})"


_CRC32 = """xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::varchar, ''), lambda c: ord(c)::bigint)),
    lambda a, c: list_reduce(list_concat([xor(a, c)], range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""
_UP = "list_transform(range(0, len(nodes), 8), lambda i: sha256(array_to_string(nodes[i + 1:i + 8], '')))"
_LEFT, _RIGHT = ("coalesce(array_to_string(nodes[{slot} // 8 * 8 + 1:{slot}], ''), '')", "coalesce(array_to_string(nodes[{slot} + 2:{slot} // 8 * 8 + 8], ''), '')")
_SLOT = "(place // (8 ** j)::bigint)"

MERKLE_MANIFEST = f"""
with recursive d as (
  select doc_id, lang, {_leaf('text')} as leaf, case when {_CRC32} % 3 = 0 then {_leaf(f"translate(text, '{_CAPITALS}', '{_SMALL}')")} end as changed from documents),
numbered as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos from d),
up as (select lang, 0 as level, list(leaf order by pos) as nodes from numbered group by lang
       union all select lang, level + 1, {_UP} from up where len(nodes) > 1),
subroots as (select lang, nodes[1] as subroot, level as height, row_number() over (order by lang nulls first) - 1 as pos from up where len(nodes) = 1),
top as (select 0 as level, list(subroot order by pos) as nodes from subroots
        union all select level + 1, {_UP} from top where len(nodes) > 1),
steps as (select lang, level as k, level as j, nodes, cast(null as bigint) as fixed from up where len(nodes) > 1
          union all select s.lang, s.height + t.level, t.level, t.nodes, s.pos from subroots s, top t where len(t.nodes) > 1),
sides as (select n.lang, n.pos, s.k, s.j, s.nodes, coalesce(s.fixed, n.pos) as place from numbered n join steps s on s.lang is not distinct from n.lang),
ways as (select lang, pos, list({{'l': {_LEFT.format(slot=_SLOT)}, 'r': {_RIGHT.format(slot=_SLOT)}}} order by k) as way from sides group by lang, pos),
folded as (
  select n.doc_id, n.leaf, s.subroot, coalesce(w.way, []) as way,
         list_reduce(list_concat([{{'l': coalesce(n.changed, n.leaf), 'r': ''}}], coalesce(w.way, [])), lambda a, x: {{'l': sha256(x.l || a.l || x.r), 'r': ''}}).l as folded_root
  from numbered n join subroots s on s.lang is not distinct from n.lang left join ways w on w.lang is not distinct from n.lang and w.pos = n.pos)
select doc_id, leaf, subroot, nodes[1] as root, sha256(coalesce(array_to_string(list_transform(way, lambda x: x.l || x.r), ''), '')) as proof_sha256,
       folded_root, folded_root = nodes[1] as verified
from folded, (select nodes from top where len(nodes) = 1)
"""


def _vector_codes(scale: int, parts: int, entries: int, rounds: int) -> str:
    """Plain rounds over all entries, one common table expression each."""
    gap = "list_sum(list_transform(list_zip(v.x, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    tables = [f"""
kept as (select row_number() over (order by vec_id nulls last, x) - 1 as r, vec_id, label, x
         from (select vec_id, label, list_transform(embedding, lambda v: floor({scale} * v::double)::bigint) as x from embeddings
               where embedding is not null and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0)),
parts as materialized (select r, p, x[p * n + 1:(p + 1) * n] as x from (select r, x, len(x) // {parts} as n, unnest(range({parts})) as p from kept)),
b0 as materialized (select p, r as e, x as c from parts where r < {entries})"""]
    for t in range(rounds + 1):
        tables.append(f"a{t} as materialized (select v.r, v.p, any_value(v.x) as x, min([{gap}::bigint, b.e]) as m from parts v join b{t} b using (p) group by v.r, v.p)")
        if t < rounds:
            tables.append(f"""
s{t} as (select p, m[2] as e, i, sum(x[i]) as total, count(*) as n from (select p, m, x, unnest(range(1, len(x) + 1)) as i from a{t}) group by all),
b{t + 1} as materialized (
  select p, e, list(((total - ((total % n) + n) % n) // n)::bigint order by i) as c from s{t} group by p, e
  union all select p, e, c from b{t} anti join s{t} using (p, e))""")
    return f"""
with {", ".join(tables)},
coded as (select r, string_agg(format('{{:02x}}', m[2]), '' order by p) as code, sum(m[1])::bigint as error from a{rounds} group by r),
book as (select sha256(string_agg(array_to_string(c, ','), ',' order by p, e)) as codebooks_sha256 from b{rounds})
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256 from coded join kept using (r), book
"""


VECTOR_CODES = _vector_codes(SCALE, PARTS, ENTRIES, ROUNDS)
