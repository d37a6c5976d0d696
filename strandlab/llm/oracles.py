"""DuckDB SQL for the numbered queries that SQL can express."""

ORACLES: dict[str, str] = {}

#: Lower-cases A-Z only.
_FOLD = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "[^\\x{00}-\\x{2F}\\x{3A}-\\x{60}\\x{7B}-\\x{7F}]+"

ORACLES["op7_decontaminate_wu_manber"] = f"""
with items as (
  select item_id, regexp_extract_all({_FOLD}, '{_WORDS}') w from benchmark where item_id is not null and text is not null
), windows as (
  select distinct item_id, array_to_string(w[i + 1 : i + 13], ' ') win, least(len(w), 13) size
  from (select item_id, w, unnest(range(greatest(len(w) - 12, 1))) i from items where len(w) > 0)
), docs as (
  select row_number() over () rid, doc_id, coalesce(regexp_extract_all({_FOLD}, '{_WORDS}'), []) w from documents
), hits as (
  select d.rid, d.i, x.size, x.item_id
  from (select rid, size, unnest(range(greatest(len(w) - size + 1, 0))) i, w from docs, (select distinct size from windows)) d
  join windows x on x.size = d.size and x.win = array_to_string(d.w[d.i + 1 : d.i + d.size], ' ')
), words as (
  select rid, count(distinct p) n_hit from (select rid, unnest(range(i, i + size)) p from hits) group by rid
), found as (
  select rid, count(distinct item_id) n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) ids
  from hits group by rid
)
select d.doc_id, cast(len(d.w) as bigint) n_words, cast(coalesce(n_hit, 0) as bigint) n_hit, cast(coalesce(n_items, 0) as bigint) n_items,
  sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(d.w) contaminated
from docs d left join words using (rid) left join found using (rid)
"""

ORACLES["op4_voronoi_top_k"] = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) e from embeddings
  where embedding is not null and vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) score
  from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id
), ranked as (
  select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) rank, vec_id, score from scored
)
select * from ranked where rank <= 5
"""

ORACLES["op2_suffix_dedup"] = """
with d as (
  select row_number() over () rid, doc_id, hex(encode(coalesce(text, ''))) h from documents
), wins as (
  select rid, doc_id, i, substr(h, 2 * i + 1, 100) w from (select rid, doc_id, h, unnest(range(len(h) // 2 - 49)) i from d where len(h) >= 100) where doc_id is not null
), least as (
  select w, min(doc_id) first from wins group by w
), gone as (
  select rid, i from wins join least using (w) where first < doc_id
), marked as (
  select rid, i, case when i <= lag(i) over (partition by rid order by i) + 50 then 0 else 1 end new from gone
), runs as (
  select rid, min(i) s, max(i) + 50 e from (select rid, i, sum(new) over (partition by rid order by i) run from marked) group by rid, run
), cuts as (
  select rid, s, e, coalesce(lag(e) over (partition by rid order by s), 0) before from runs
), kept as (
  select d.rid, count(*) n_spans, sum(e - s) n_removed, string_agg(substr(h, 2 * before + 1, 2 * (s - before)), '' order by s) || substr(any_value(h), 2 * max(e) + 1) rest
  from cuts join d using (rid) group by d.rid
)
select d.doc_id, cast(len(h) // 2 as bigint) n_bytes, cast(coalesce(n_removed, 0) as bigint) n_removed, cast(coalesce(n_spans, 0) as bigint) n_spans, sha256(unhex(coalesce(rest, h))) kept_sha256
from d left join kept using (rid)
"""

ORACLES["op10_jaccard_adaptive_prefix"] = f"""
with recursive words as (
  select row_number() over () rid, doc_id, coalesce(regexp_extract_all({_FOLD}, '[^\\x20\\x09-\\x0D]+'), []) w from documents
), shingles as (
  select distinct rid, doc_id, array_to_string(w[i + 1 : i + 5], ' ') s from (select rid, doc_id, w, unnest(range(greatest(len(w) - 4, 1))) i from words where len(w) > 0)
), sizes as (select rid, any_value(doc_id) doc_id, count(*) n from shingles group by rid
), common as (
  select a.rid x, b.rid y, count(*) k from shingles a join shingles b on a.s = b.s and a.rid < b.rid and a.doc_id is not null and b.doc_id is not null group by all
), links as (
  select a.doc_id x, b.doc_id y from common c join sizes a on a.rid = c.x join sizes b on b.rid = c.y where 100 * k >= 75 * (a.n + b.n - k) and a.doc_id <> b.doc_id
), both_ways as (select x, y from links union select y, x from links
), reach as (
  select x, x y from (select distinct x from both_ways) union select r.x, b.y from reach r join both_ways b on r.y = b.x
), least as (select x, min(y) c from reach group by x)
select w.doc_id, cast(coalesce(s.n, 0) as bigint) n_shingles, coalesce(l.c, w.doc_id) component_id
from words w left join sizes s using (rid) left join least l on l.x = w.doc_id
"""

ORACLES["op6_stratified_shards"] = """
with polynomial as (
  select list(c order by i) t from (
    select i, list_reduce(list_prepend(i, range(8)), lambda c, k: case when c % 2 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end) c from range(256) r(i))
), d as (
  select row_number() over () rid, doc_id, source, coalesce(strlen(text), 0) + 1 size,
    list_transform(regexp_extract_all(lower(hex(encode(coalesce(text, '')))), '..'), lambda b: cast(concat('0x', b) as bigint)) bytes from documents
), crc as (
  select rid, doc_id, source, size, xor(list_reduce(list_prepend(4294967295::bigint, bytes), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::bigint) crc from d, polynomial
), keyed as (
  select *, md5(concat_ws(':', '17', cast(doc_id as varchar), cast(crc as varchar))) key, coalesce('s' || source, 'n') stratum from crc
), ranked as (
  select *, row_number() over (partition by stratum order by key, doc_id) r, count(*) over (partition by stratum) n, count(*) over () total from keyed
), placed as (
  select *, row_number() over (order by ((2 * r - 1) * 4096) // (2 * n), (2 * r - 1) / cast(2 * n as double), stratum, key, doc_id) - 1 as place from ranked
), cut as (select *, (place * 16) // total as shard from placed)
select doc_id, source, cast(size as bigint) size, crc text_crc32, 'rows' law, cast(shard as integer) shard, cast(place - (shard * total + 15) // 16 as bigint) slot, cast(null as integer) grown_shard from cut
"""


def _tree_levels(levels: int, distinct: int, share: float, errors: float) -> str:
    """One round of node names for each level of the path-template tree."""
    out = []
    for k in range(levels):
        out.append(f"""step{k} as (select *, case when len(steps) > {k} then steps[{k + 1}] end step from rows{k}
), seg{k} as (select host, node, step, sum(n) n, sum(labelled) labelled, sum(bad) bad from step{k} where step is not null group by all
), par{k} as (select host, node, sum(n) all_n, sum(bad) / nullif(sum(labelled), 0) p from seg{k} group by all
), of{k} as (
  select s.*, p.p, s.n <= {share} * p.all_n rare, count(*) filter (where s.n <= {share} * p.all_n) over (partition by s.host, s.node) > {distinct} varied
  from seg{k} s join par{k} p on p.host = s.host and p.node = s.node
), name{k} as (
  select host, node, step, case when coalesce(abs(bad / nullif(labelled, 0) - p) <= {errors} * sqrt(p * (1 - p) / nullif(labelled, 0)), true)
    then case when rare and varied then '*' else '~' end else step end as name from of{k}
), rows{k + 1} as (
  select r.host, r.template, r.n, r.labelled, r.bad, r.steps, case when r.step is null then r.node else r.node || '/' || m.name end node
  from step{k} r left join name{k} m on m.host = r.host and m.node = r.node and m.step = r.step
)""")
    return ", ".join(out)


ORACLES["op9_url_template_tree"] = f"""
with parts as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end rest from pages
), split as (
  select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) path from parts
), ruled as (
  select *, regexp_replace(path, '[0-9]+', '#', 'g') template, case
    when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
    when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
    when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/' end rule from split
), known as (
  select doc_id, max(case when coalesce(quality, 1) = 0 or coalesce(toxic, 0) = 1 then 1 else 0 end) label from labels group by doc_id
), judged as (
  select r.*, case when rule is null then label end bad from ruled r left join known k on k.doc_id = r.page_id
), counts as (
  select host, template, count(*) n, count(bad) labelled, coalesce(sum(bad), 0) bad, string_split(regexp_replace(template, '^/', ''), '/') s from judged group by host, template
), rows0 as (
  select host, template, n, labelled, bad, case when len(s) > 4 then list_append(s[1:3], array_to_string(s[4:], '/')) else s end steps, '' node from counts
), {_tree_levels(4, 12, 0.05, 2.0)}, overall as (
  select coalesce(sum(bad) / nullif(sum(labelled), 0), 0.0) overall from rows4
), verdicts as (
  select host, node, (sum(bad) + 20.0 * any_value(overall)) / (sum(labelled) + 20.0) > 0.5 rejected from rows4, overall group by host, node
)
select j.page_id, j.host, j.path, j.rule, case when j.rule in ('example.com/de/', 'net/') then 'block' when j.rule is not null then 'allow' when v.rejected then 'block' else 'allow' end verdict, r.node tree_node
from judged j join rows4 r on r.host = j.host and r.template = j.template join verdicts v on v.host = r.host and v.node = r.node
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES["op12_fill_in_middle"] = r"""
with docs as (
  select doc_id, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') w,
    sha256(concat('42:', coalesce(cast(doc_id as varchar), ''))) h from documents
), drawn as (
  select *, cast(len(w) as bigint) n, cast(concat('0x', substr(h, 1, 8)) as bigint) h1, cast(concat('0x', substr(h, 9, 8)) as bigint) h2,
    cast(concat('0x', substr(h, 17, 8)) as bigint) h3, cast(concat('0x', substr(h, 25, 8)) as bigint) h4 from docs
), formed as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) a, greatest(h1 % (n + 1), h2 % (n + 1)) b,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 50 then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end form from drawn
), cut as (
  select *, array_to_string(w[1:a], '') p, array_to_string(w[a + 1:b], '') m, array_to_string(w[b + 1:], '') s from formed
)
select doc_id, n, form, case when form <> 'plain' then cast(length(p) as bigint) end prefix_chars, case when form <> 'plain' then cast(length(m) as bigint) end middle_chars,
  sha256(case form when 'plain' then t when 'psm' then concat('<P>', p, '<S>', s, '<M>', m) else concat('<S>', s, '<P>', p, '<M>', m) end) output_sha256, sha256(concat(p, m, s)) restored_sha256
from cut
"""

ORACLES["op13_phrase_collocations"] = rf"""
with pieces as (
  select coalesce(lang, 'und') lang, unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) piece from documents
), listed as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') w from pieces
), f1 as (
  select lang, x, count(*) n from (select lang, unnest(w) x from listed) group by all
), f2 as (
  select lang, w[i] x, w[i + 1] y, count(*) a from (select lang, w, unnest(range(1, len(w))) i from listed) group by all having count(*) >= 10
), f3 as (
  select lang, w[i] x, w[i + 1] y, w[i + 2] z, count(*) a from (select lang, w, unnest(range(1, len(w) - 1)) i from listed) group by all having count(*) >= 10
), longer as (
  select lang, x, y, max(a) longest from (select lang, x, y, a from f3 union all select lang, y, z, a from f3) group by all
), cuts as (
  select f2.lang, concat(f2.x, ' ', f2.y) phrase, a, 1 k, p.n l, q.n r from f2 join f1 p on p.lang = f2.lang and p.x = f2.x join f1 q on q.lang = f2.lang and q.x = f2.y
    left join longer g on g.lang = f2.lang and g.x = f2.x and g.y = f2.y where longest is null or 100 * longest < 50 * a
  union all
  select f3.lang, concat(f3.x, ' ', f3.y, ' ', f3.z), f3.a, 1, p.n, q.a from f3 join f1 p on p.lang = f3.lang and p.x = f3.x join f2 q on q.lang = f3.lang and q.x = f3.y and q.y = f3.z
  union all
  select f3.lang, concat(f3.x, ' ', f3.y, ' ', f3.z), f3.a, 2, p.a, q.n from f3 join f2 p on p.lang = f3.lang and p.x = f3.x and p.y = f3.y join f1 q on q.lang = f3.lang and q.x = f3.z
), scored as (
  select *, cast(cast(1000000 as hugeint) * a * a // (cast(l as hugeint) * r) as bigint) score from cuts
), worst as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
), ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as "rank" from worst
)
select lang, "rank", phrase, a, l, r, cast(t.n as bigint) n, score from ranked join (select lang, sum(n) n from f1 group by lang) t using (lang) where "rank" <= 2000
"""
