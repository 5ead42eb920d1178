"""SQL that checks the queries of this subpackage, where SQL can express them."""

# Unsigned crc32 of a list of bytes; the table of one byte's remainders follows from the polynomial.
CRC32 = """
crc_table as (
    select [list_reduce(range(8), lambda c, i: if(c & 1 = 1, xor(c >> 1, 3988292384), c >> 1), n) for n in range(256)] as t
)
"""


def _crc32(data: str, table: str) -> str:
    return f"xor(list_reduce({data}, lambda c, b: xor({table}[(xor(c, b) & 255) + 1], c >> 8), 4294967295::bigint), 4294967295)"


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::varchar)::varchar || ':' || {value}::varchar, '-')"


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _leaf(text: str) -> str:
    parts = " || ".join(_field(name) for name in ("doc_id", "source", "lang", "n_chars", text))
    return f"sha256({parts})"


# Levels are made one after the other from numbered nodes; a proof climbs with its node's number.
MERKLE = f"""
with recursive {CRC32},
leaves as (
    select coalesce('=' || lang, '-') as key, doc_id, {_leaf("text")} as leaf,
           {_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} as lowered,
           {_crc32("[ascii(c)::bigint for c in string_split(doc_id::varchar, '')]", "t")} % 3 = 0 as touched
    from documents, crc_table
),
placed as (
    select *, row_number() over (partition by key order by doc_id nulls first, leaf) - 1 as pos from leaves
),
nodes as (
    select key, 0 as level, pos, leaf as node, count(*) over (partition by key) as size from placed
    union all
    select key, level + 1, pos // 8, sha256(string_agg(node, '' order by pos)), (any_value(size) + 7) // 8
    from nodes where size > 1 group by key, level, pos // 8
),
subroots as (
    select key, node, row_number() over (order by key) - 1 as pos, count(*) over () as size
    from nodes where size = 1
),
upper_nodes as (
    select 0 as level, pos, node, size from subroots
    union all
    select level + 1, pos // 8, sha256(string_agg(node, '' order by pos)), (any_value(size) + 7) // 8
    from upper_nodes where size > 1 group by level, pos // 8
),
runs as (
    select key, level, pos // 8 as run, list(node order by pos) as members from nodes where size > 1 group by all
    union all
    select null, level, pos // 8, list(node order by pos) from upper_nodes where size > 1 group by all
),
proofs as (
    select p.key, p.doc_id, p.leaf, p.pos as own, 0 as level, p.pos, p.key as tree, '' as proof,
           case when p.touched then p.lowered else p.leaf end as folded
    from placed p
    union all
    select f.key, f.doc_id, f.leaf, f.own, if(r.run is null, 0, f.level + 1),
           if(r.run is null, s.pos, f.pos // 8), if(r.run is null, null, f.tree),
           f.proof || coalesce(array_to_string(r.members[:f.pos % 8], '') || array_to_string(r.members[f.pos % 8 + 2:], ''), ''),
           if(r.run is null, f.folded, sha256(array_to_string(r.members[:f.pos % 8], '') || f.folded
              || array_to_string(r.members[f.pos % 8 + 2:], '')))
    from proofs f
    join subroots s on s.key = f.key
    left join runs r on r.key is not distinct from f.tree and r.level = f.level and r.run = f.pos // 8
    where f.tree is not null or r.run is not null
)
select f.doc_id, f.leaf, s.node as subroot, u.node as root, sha256(f.proof) as proof_sha256,
       f.folded as folded_root, f.folded = u.node as verified
from (select * from proofs where tree is null
      qualify row_number() over (partition by key, own order by level desc) = 1) f
join subroots s on s.key = f.key
cross join (select node from upper_nodes where size = 1) u
"""

# Near words by equal texts with one letter left out: equal to the shorter word, or equal
# to each other with the same letter's place left out.
SPELLING = f"""
with recursive {CRC32},
runs as (
    select coalesce(doc_id::varchar, '') as doc,
           translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{_UPPER}', '{_LOWER}') as run
    from documents
),
long_runs as (select doc, run, count(*) as n from runs where length(run) >= 7 group by all),
bytes as (
    select doc, run, n, flatten([if(unicode(c) < 128, [unicode(c)::bigint],
               [192 + (unicode(c)::bigint >> 6), 128 + (unicode(c)::bigint & 63)])
           for c in string_split(doc || ':' || run, '')]) as data
    from long_runs
),
hashed as (select run, n, {_crc32("data", "t")} as h from bytes, crc_table),
words as (
    select if(h % 31 = 0, left(run, (h % length(run))::int) || substring(run, (h % length(run))::int + 2), run) as word,
           sum(n)::bigint as n
    from hashed group by 1 having length(word) >= 7 and sum(n) >= 2
),
cut as (
    select word, n, i, left(word, i - 1) || substring(word, i + 1) as rest
    from (select word, n, unnest(range(1, length(word) + 1)) as i from words)
),
pairs as (
    select distinct a.word, b.word as near, b.n as near_n from cut a join cut b on a.rest = b.rest and a.i = b.i and a.word <> b.word
    union
    select distinct a.word, b.word, b.n from cut a join words b on a.rest = b.word
    union
    select distinct b.word, a.word, a.n from cut a join words b on a.rest = b.word
),
best as (
    select word, count(*) as n_near, first(near order by near_n desc, encode(near)) as near,
           first(near_n order by near_n desc, encode(near)) as near_n
    from pairs group by word
),
formed as (
    select w.word, w.n, coalesce(b.n_near, 0) as n_near, if(b.near_n >= 10 * w.n, b.near, null) as form,
           if(b.near_n >= 10 * w.n, b.near_n, null) as form_n
    from words w left join best b on b.word = w.word
),
chains as (
    select word, word as root, 0 as depth from formed
    union all
    select c.word, f.form, c.depth + 1 from chains c join formed f on f.word = c.root where f.form is not null
)
select f.word, f.form, c.root, f.n, f.n_near, f.form_n
from formed f join (select word, arg_max(root, depth) as root from chains group by word) c on c.word = f.word
"""

HOST_TRUST = f"""
with recursive split as (
    select page_id, html, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') as host,
           coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path
    from pages
),
rules(of_host, of_path, says) as (
    values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
           ('net', '/es/', 'block'), ('net', '/fr/', 'block')
),
ruled as (
    select s.*, (select arg_max(struct_pack(rule := of_host || of_path, says := says), length(of_host || of_path)) from rules
                 where (s.host = of_host or ends_with(s.host, '.' || of_host)) and starts_with(s.path, of_path)) as found
    from split s
),
seeds as (
    select host, found.says as kind, count(*) / any_value(pages) as score
    from (select host, found, count(*) over (partition by host) as pages from ruled where host <> '')
    where found is not null group by host, kind
),
named as (
    select page_id, host, unnest(list_distinct([translate(x, '{_UPPER}', '{_LOWER}') for x in regexp_extract_all(
               regexp_replace(html, '<!--.*?(?:-->|$)', ' ', 'gs'),
               '(?i)<a\\s[^<>]*?\\bhref\\s*=\\s*["'']?\\s*(?:https?:)?//([^/?#"''\\s<>]+)', 1)])) as target
    from split where host <> ''
),
links as (select host, target, count(*) as pages from named where host <> target group by host, target),
flows as (
    select 'allow' as kind, host, target as go_to, pages / sum(pages) over (partition by host) as share from links
    union all
    select 'block', target, host, pages / sum(pages) over (partition by target) from links
),
rounds as (
    select 0 as round, host, kind, score, true as goes_on from seeds
    union all
    select any_value(r.round) + 1, f.go_to, f.kind, 0.85 * sum(f.share * r.score), max(0.85 * sum(f.share * r.score)) over () > 1e-3
    from rounds r join flows f on f.kind = r.kind and f.host = r.host
    where r.goes_on and r.round < 60 group by f.go_to, f.kind
),
scores as (
    select host, coalesce(sum(score) filter (kind = 'allow'), 0) as trust, coalesce(sum(score) filter (kind = 'block'), 0) as distrust
    from rounds group by host
)
select r.page_id, r.host, r.path, r.found.rule as rule,
       coalesce(r.found.says, case when s.distrust - s.trust > 0.5 then 'block' else 'allow' end) as verdict
from ruled r left join scores s on s.host = r.host
"""
