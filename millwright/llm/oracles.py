"""The same results in DuckDB SQL, each by a plainer way than the operator's."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_ASSIGN = (
    r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)

MIX = rf"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::bigint as size,
    md5(concat(coalesce(doc_id::varchar, ''), ':', md5(coalesce(text, '')))) as k
  from documents),
s as (
  select source, sum(size)::hugeint as ss,
    [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::hugeint as w
  from d group by source),
f as (
  select *, sum(ss) over () as t,
    coalesce(sum(3 * ss) over (order by ss / w::double, source nulls last rows between unbounded preceding and 1 preceding), 0) as filled,
    sum(w) over (order by ss / w::double, source nulls last rows between current row and unbounded following) as open
  from s),
c as (select *, 3 * ss * open <= w * (t - filled) as capped from f),
g as (
  select source, ss, case when capped then (3 * ss)::double else (w * (t - coalesce(sum(3 * ss) filter (capped) over (), 0)))::double
    / (sum(w) filter (not capped) over ())::double end as target
  from c),
b as (
  select *, case when ss > 0 then floor(target)::bigint // ss::bigint else 0 end as e from g),
r as (
  select d.*, b.ss, b.target, b.e, floor(b.target)::bigint - b.e * b.ss::bigint as rest,
    coalesce(sum(size) over (partition by d.source order by k range between unbounded preceding and current row), 0)
      - sum(size) over (partition by d.source, k) as before,
    count(*) over (partition by d.source, k) as copies
  from d join b on d.source is not distinct from b.source)
select doc_id, source, size, ss::bigint as source_size, target,
  (e * size + case when before + copies * size <= rest then size
    when before >= rest then 0 else (rest - before) // copies end)::bigint as taken
from r
"""

QUALITY = rf"""
with d as (select *, row_number() over () as r from documents),
w as (
  select r, unnest(l) as a, generate_subscripts(l, 1) as i
  from (select r, regexp_extract_all(coalesce(text, ''), '{_WORD}') as l from d)),
t as (select r, i, a, lead(a, 1) over o as b, lead(a, 2) over o as c from w window o as (partition by r order by i)),
n as (select r, i, c is not null and count(*) over (partition by r, a, b, c) > 1 as again from t),
v as (select r, i, max(again::int) over (partition by r order by i rows between 2 preceding and current row) as hit from n),
q as (select r, count(*) as n_words, sum(hit) as n_repeat_words from v group by r),
l as (
  select r, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines
  from (select r, unnest(string_split(text, chr(10))) as line from d)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by r),
m as (
  select doc_id, coalesce(n_words, 0)::bigint as n_words,
    length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    length(regexp_replace(coalesce(text, ''), '[^A-Z]', '', 'g'))::bigint as n_upper,
    coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words
  from d left join q using (r) left join l using (r)),
b as (
  select *, (n_words < 50)::bigint + 2 * (100 * n_repeat_words > 50 * n_words)::bigint
    + 4 * (word_chars < 2 * n_words)::bigint + 8 * (word_chars > 12 * n_words)::bigint
    + 16 * (100 * n_symbols > 10 * n_words)::bigint + 32 * (100 * n_dup_lines > 30 * n_lines)::bigint
    + 64 * (100 * n_upper > 50 * word_chars)::bigint as failures
  from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  failures & (1 + 2 + 4 + 8 + 16 + 64) = 0 as kept, failures
from b
"""

LINES = r"""
with d as (select *, row_number() over () as r from documents),
p as (select source, count(*) as pages from d group by source),
x as (
  select r, doc_id, source, unnest(string_split(text, chr(10))) as line,
    generate_subscripts(string_split(text, chr(10)), 1) as i from d),
f as (
  select source, line from x where regexp_matches(line, '[^\x20\x09-\x0D]')
  group by source, line
  having count(distinct r) >= 5
    and count(distinct r) > 0.05::double * (select pages from p where p.source is not distinct from x.source)),
y as (
  select x.*, f.line is not null as hit from x left join f
    on x.source is not distinct from f.source and x.line = f.line),
g as (
  select r, count(*) as n, count(*) filter (hit) as hits,
    coalesce(sum(length(line)) filter (not hit), 0) as rest, sum(length(line)) as whole,
    string_agg(line, chr(10) order by i) filter (not hit) as kept
  from y group by r)
select doc_id, source, coalesce(n, 0)::bigint as n_lines,
  (case when hits > 0 and rest >= (1 - 0.9::double) * whole then hits else 0 end)::bigint as n_removed,
  case when hits > 0 and rest >= (1 - 0.9::double) * whole then coalesce(kept, '') else text end as text
from d left join g using (r)
"""

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
EXACT = f"""
with d as (select doc_id, sha256({_FOLDED}) as text_sha256 from documents)
select doc_id, max(doc_id) over (partition by text_sha256) as keep_id,
  count(*) over (partition by text_sha256)::bigint as group_size,
  doc_id = max(doc_id) over (partition by text_sha256) as kept, text_sha256
from d
"""

WARC = """
with d as (
  select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes,
    sha256(coalesce(html, '')) as payload_digest from pages),
f as (select *, min(page_id) over (partition by payload_digest) as first_id from d)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 100 and page_id <> first_id then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and page_id <> first_id then first_id end as refers_to
from f
"""


def _matches(name: str, pattern: str, group: int = 0) -> str:
    """Matches of a pattern with their places, from what a split leaves between them."""
    return rf"""
{name}_l as (
  select r, unnest(regexp_extract_all(text, '{pattern}')) as found,
    unnest(regexp_extract_all(text, '{pattern}', {group})) as inner_found,
    unnest(string_split_regex(text, '{pattern}')[:-2]) as gap,
    generate_subscripts(regexp_extract_all(text, '{pattern}'), 1) as i
  from d where regexp_matches(text, '{pattern}')),
{name} as (
  select r, found, inner_found, (sum(length(gap) + length(found)) over (partition by r order by i))::bigint as e,
    (sum(length(gap) + length(found)) over (partition by r order by i) - length(found))::bigint as s
  from {name}_l)"""


def _random(name: str, kind: str, rank: int, most: int, window: int = 24) -> str:
    """Spans of windows whose sum of ``c * log2(c)``, in millionths, is at most ``most``."""
    return rf"""
{name}_w as (
  select r, s + p - 1 as place, substr(found, p::int, {window}) as win
  from (select r, s, found, unnest(generate_series(1, length(found) - {window} + 1)) as p from {name}
    where not regexp_matches(found, '^[A-Za-z_-]*$') and not regexp_matches(found, '^[0-9_+/-]*$')
      and not regexp_matches(found, '^[A-Za-z]+([/_-][A-Za-z]+)*([/_-][0-9]+)?$')
      and not regexp_matches(found, '(?i)example|placeholder|xxxxxxxx|0123456789|abcdefghij'))),
{name}_c as (
  select r, place, sum(case when n > 1 then round(n * log2(n) * 1000000) else 0 end) as cost
  from (select r, place, c, count(*) as n from (select r, place, unnest(string_split(win, '')) as c from {name}_w) group by r, place, c)
  group by r, place),
{name}_h as (
  select r, place, case when place - lag(place) over (partition by r order by place) <= {window} then 0 else 1 end as new
  from {name}_c where cost <= {most}),
{name}_g as (select r, place, sum(new) over (partition by r order by place) as g from {name}_h),
{name}_s as (
  select r, min(place)::bigint as s, {rank} as rank, (max(place) + {window})::bigint as e, '{kind}' as kind
  from {name}_g group by r, g)"""


SECRETS = rf"""
with d as (select doc_id, coalesce(text, '') as text, row_number() over () as r from documents),
{_matches("a", _ASSIGN, 1)},
{_matches("k", "AKIA[A-Z0-9]+")},
{_matches("h", "[0-9a-f]{32,}")},
{_matches("x", "[0-9A-Fa-f]{24,}")},
{_matches("y", "[A-Za-z0-9+/_-]{24,}")},
base as (
  select r, s, 0 as rank, e, 'assign' as kind from a where length(inner_found) >= 8
  union all select r, s, 1, e, 'access' from k where length(found) >= 16
  union all select r, s, 2, e, 'hex' from h),
{_random("x", "entropy_hex", 3, 38039100)},
{_random("y", "entropy_base64", 4, 14039100)},
spans as (
  select * from base
  union all select * from (select * from x_s union all select * from y_s) m
    where not exists (select 1 from base b where b.r = m.r and b.s <= m.s and m.e <= b.e)),
j as (
  select r, count(*) filter (rank = 0) as n_assign, count(*) filter (rank = 1) as n_access, count(*) filter (rank = 2) as n_hex,
    string_agg(concat(kind, ':', s, ':', e), ',' order by s, rank) filter (rank < 3) as base,
    string_agg(concat(kind, ':', s, ':', e), ',' order by s, rank) as spans
  from spans group by r)
select doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access,
  coalesce(n_hex, 0)::bigint as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join j using (r)
"""

URLS = r"""
with u as (
  select page_id, case when contains(url, '://') then regexp_extract(substr(url, instr(url, '://') + 3), '^[^?#]*') else '' end as rest
  from pages),
h as (
  select page_id, translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    substr(rest, length(regexp_extract(rest, '^[^/]*')) + 1) as path
  from u),
rules(verdict, rule_host, rule_path) as (values
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/'))
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
from (
  select page_id, host, path, rule_host || rule_path as rule, verdict,
    row_number() over (partition by page_id, host, path order by length(rule_host) desc nulls last, length(rule_path) desc) as n
  from h left join rules on ends_with('.' || host, '.' || rule_host) and starts_with(path, rule_path))
where n = 1
"""

TRIE = """
with t as (
  select conv_id as c, octet_length(encode(coalesce(text, '')))::bigint as b, turn,
    sha256(concat(octet_length(encode(coalesce(role, ''))), ':', coalesce(role, ''), coalesce(text, '')))[:32] as dg
  from conversations where conv_id is not null),
o as (select c, b, dg, row_number() over (partition by c order by turn nulls first, dg) - 1 as i from t),
h as (
  select c, c - (c % 5 + 5) % 5 as base, n,
    xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(c::varchar, ''), lambda d: ord(d)::bigint)),
      lambda x, y: list_reduce(list_prepend(xor(x, y), range(8)),
        lambda z, k: case when z & 1 = 1 then xor(z >> 1, 3988292384::bigint) else z >> 1 end)), 4294967295::bigint) % 9 as h
  from (select c, count(*) as n from o group by c)),
g as (select h.c, h.base, h.h, least(h.h, coalesce(f.n, 0)) as taken from h left join h as f on f.c = h.base),
s as (
  select g.c, o.i as i, dg, b from g join o on o.c = g.base and o.i < g.h
  union all
  select g.c, g.taken + o.i - g.h as i, dg, b from g join o on o.c = g.c and o.i >= g.h),
m as (
  select c, i + 1 as d, b, sha256(string_agg(dg, '') over (partition by c order by i)) as k from s
  union all
  select c, 0 as d, 0 as b, sha256('') as k from g),
p as (
  select *, lag(k) over (partition by c order by d) as pk, lead(k) over (partition by c order by d) is null as ending from m),
n as (
  select k, any_value(pk) as pk, any_value(d) as d, min(c) as c, count(*) as n, any_value(b) as b,
    sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (ending), '')) as ends_sha256
  from p group by k),
w as (select pk as k, count(*) as n_children from n where pk is not null group by pk),
v as (
  select p.k, sum(case when w.k is null then 1 else 0 end) as n_leaves, sum((n.n - 1) * n.b) as saved_tokens
  from n left join w on w.k = n.k join p on p.c = n.c and p.d <= n.d group by p.k)
select n.c as conv_id, n.d::bigint as depth, f.c as parent_conv_id, n.n::bigint as n_convs,
  coalesce(w.n_children, 0)::bigint as n_children, v.n_leaves::bigint as n_leaves, v.saved_tokens::bigint as saved_tokens, n.ends_sha256
from n join v on v.k = n.k left join w on w.k = n.k left join n as f on f.k = n.pk
"""

TOPK = """
with v as (
  select vec_id, row_number() over () as r, list_transform(embedding, lambda x: floor(64 * x::double)) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
p as (
  select q.r, q.vec_id as query_id, c.vec_id,
    coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])), 0)::bigint as score
  from v as q join v as c on q.r <> c.r and q.vec_id % 20 = 0)
select query_id, rank, vec_id, score
from (select *, (row_number() over (partition by r order by score desc, vec_id))::int as rank from p)
where rank <= 20
"""

ORACLES: dict[str, str] = {
    "op1_mix_sources": MIX,
    "op2_quality_rules": QUALITY,
    "op3_line_dedup": LINES,
    "op6_exact_dedup": EXACT,
    "op7_warc": WARC,
    "op8_secret_scan": SECRETS,
    "op10_url_filter": URLS,
    "op11_conversation_trie": TRIE,
    "op13_topk_search": TOPK,
}
