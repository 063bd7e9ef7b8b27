"""The operators' results in plain SQL, for comparison."""

from __future__ import annotations

#: ASCII letters to lower case, words split at the six ASCII spaces.
_WORDS = r"""
words as (
  select doc_id, list_filter(
    string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from documents
)"""

OP9 = f"""
with recursive {_WORDS},
sets as (
  select doc_id, case
    when len(w) >= 2 then list_distinct(list_transform(range(1, len(w)),
      lambda i: w[i] || ' ' || w[i + 1]))
    when len(w) = 1 then w else [] end as s
  from words
),
reps as (select s, min(doc_id) as rep from (select doc_id, list_sort(s) as s from sets)
         where len(s) > 0 group by s),
shingles as (select rep, unnest(s) as shingle, len(s) as n from reps),
common as (
  select a.rep as a, b.rep as b, count(*) as shared, any_value(a.n) as na, any_value(b.n) as nb
  from shingles a join shingles b on a.shingle = b.shingle and a.rep < b.rep
  where a.n * 100 >= b.n * 80 and b.n * 100 >= a.n * 80
  group by a.rep, b.rep
),
links as (select a, b from common where 100 * shared >= 80 * (na + nb - shared)),
both_ways as (select a, b from links union select b, a from links),
reached(a, b) as (
  select a, b from both_ways
  union
  select reached.a, both_ways.b from reached join both_ways on reached.b = both_ways.a
),
lowest as (select a, least(a, min(b)) as label from reached group by a),
labels as (select r.s, coalesce(l.label, r.rep) as label from reps r left join lowest l on l.a = r.rep)
select d.doc_id, cast(len(d.s) as bigint) as n_shingles,
       coalesce(l.label, d.doc_id) as component_id,
       d.doc_id = coalesce(l.label, d.doc_id) as kept
from sets d left join labels l on list_sort(d.s) = l.s
"""

OP10 = """
with payloads as (
  select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as h,
         cast(strlen(coalesce(html, '')) as bigint) as payload_bytes
  from pages
),
firsts as (select payload, min(page_id) as first_id from payloads group by payload)
select page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((cast('0x' || substr(h, 1 + 5 * (k // 4), 5) as bigint) >> (15 - 5 * (k % 4))) & 31)::int,
    1)), '') as payload_digest,
  case when page_id = first_id then 'response' else 'revisit' end as record_type,
  case when page_id <> first_id then first_id end as refers_to,
  true as intact
from payloads join firsts using (payload)
"""

OP6 = r"""
with captures as (
  select page_id, nullif(lower(regexp_replace(regexp_extract(url,
           '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@\[\]]+)', 1), '\.+$', '')), '') as host,
         date '2024-01-01' + cast(cast('0x' || substr(md5(cast(page_id as varchar)), 1, 8) as bigint)
           % 366 as integer) as day
  from pages
),
hosts as (select distinct host from captures where host is not null),
above as (
  select host, unnest(case when regexp_matches(host, '^[0-9.]+$') then [host]
    else list_transform(range(1, greatest(len(string_split(host, '.')), 2)),
      lambda k: array_to_string(string_split(host, '.')[k:], '.')) end) as domain
  from hosts
),
drawn as (
  select domain, cast('0x' || substr(md5(domain), 1, 8) as bigint) as n
  from (select distinct domain from above)
),
entries as (
  select domain, ['adult', 'malware', 'spam'][cast(n // 3 % 3 + 1 as integer)] as category,
         date '2024-01-01' + cast(n // 9 % 200 as integer) as since,
         date '2024-01-01' + cast(200 + n // 9 % 70 as integer) as until
  from drawn where n % 3 = 0
  union all
  select domain, ['adult', 'malware', 'spam'][cast(n // 3 % 3 + 1 as integer)],
         date '2024-01-01' + cast(270 + n // 9 % 90 as integer), null
  from drawn where n % 3 = 0
),
found as (
  select c.host, c.day, max_by(e.domain, length(e.domain)) as matched,
         array_to_string(list_sort(list_distinct(list(e.category))), ',') as categories,
         max(e.since) as listed_on
  from (select distinct host, day from captures where host is not null) c
  join above a on a.host = c.host
  join entries e on e.domain = a.domain and c.day >= e.since and (e.until is null or c.day < e.until)
  group by c.host, c.day
)
select c.page_id, c.host, cast(c.day as varchar) as fetched_on, f.matched is not null as blocked,
       f.matched, f.categories, cast(f.listed_on as varchar) as listed_on
from captures c left join found f on f.host = c.host and f.day = c.day
"""

#: The CRC of an id's decimal digits, byte by byte and bit by bit.
_CRC32 = """
xor(list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(
      string_split(cast(conv_id as varchar), ''), lambda c: cast(ascii(c) as bigint))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), cast(range(8) as bigint[])),
      lambda r, i: case when r & 1 = 1 then xor(r >> 1, 3988292384) else r >> 1 end)),
  4294967295)"""

OP13 = f"""
with given as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  where conv_id is not null
),
own as (
  select conv_id, list({{'role': role, 'text': text}} order by turn nulls first, role, sha256(
    concat(strlen(role), ':', role, text))) as own
  from given group by conv_id
),
rebuilt as (
  select c.conv_id, list_concat(list_slice(coalesce(b.own, []), 1, c.h), list_slice(c.own, c.h + 1, len(c.own)))
    as path
  from (select conv_id, own, cast({_CRC32} % 4 as bigint) as h from own) c
  left join own b on b.conv_id = c.conv_id - c.conv_id % 20
),
steps as (
  select conv_id, len(path) as size, unnest(range(0, len(path) + 1)) as depth, path from rebuilt
),
members as (
  select conv_id, size, depth, list_slice(path, 1, depth) as prefix,
         list_slice(path, 1, depth - 1) as above
  from steps
),
nodes as (
  select prefix, depth, any_value(above) as above, min(conv_id) as conv_id, count(*) as n_convs,
         string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (size = depth) as ends,
         case when depth = 0 then 0 else len(list_filter(string_split_regex(
           any_value(prefix[len(prefix)].text), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) end as words
  from members group by prefix, depth
),
kids as (
  select above as prefix, depth - 1 as depth, count(*) as n from nodes where depth > 0 group by all
),
counted as (
  select n.*, coalesce(k.n, 0) as n_children
  from nodes n left join kids k on k.prefix = n.prefix and k.depth = n.depth
),
upwards as (
  select list_slice(prefix, 1, up) as prefix, up as depth, n_children, n_convs, words
  from (select *, unnest(range(0, depth + 1)) as up from counted)
),
subtrees as (
  select prefix, depth, count(*) filter (n_children = 0) as n_leaves,
         sum((n_convs - 1) * words) as saved_tokens
  from upwards group by prefix, depth
)
select c.conv_id, cast(c.depth as bigint) as depth, p.conv_id as parent_conv_id,
       cast(c.n_convs as bigint) as n_convs, cast(c.n_children as bigint) as n_children,
       cast(s.n_leaves as bigint) as n_leaves, cast(s.saved_tokens as bigint) as saved_tokens,
       sha256(coalesce(c.ends, '')) as ends_sha256
from counted c
join subtrees s on s.prefix = c.prefix and s.depth = c.depth
left join counted p on c.depth > 0 and p.depth = c.depth - 1 and p.prefix = c.above
"""
