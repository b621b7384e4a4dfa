"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

from tidewatch.llm.mixing import MAX_EPOCHS, SHARE, WEIGHTS
from tidewatch.llm.url_rules import DEFAULT_VERDICT, RULES

_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)

OP1 = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
w as (select doc_id, i, md5(substr(h, 2 * i - 1, 400)) as k
      from (select doc_id, h, unnest(range(1, length(h) // 2 - 198)) as i from d where length(h) >= 400)),
r as (select k from w group by 1 having count(*) > 1),
m as (select doc_id, i from w semi join r using (k)),
g as (select doc_id, i, coalesce(i - lag(i) over (partition by doc_id order by i) > 200, true)::int as new from m),
s as (select doc_id, min(i) as a, max(i) + 200 as b
      from (select doc_id, i, sum(new) over (partition by doc_id order by i) as run from g) group by doc_id, run),
p as (select d.doc_id, h, list(struct_pack(a := a, b := b) order by a) filter (a is not null) as spans
      from d left join s using (doc_id) group by all)
select doc_id, length(h) // 2 as n_bytes,
       coalesce(list_sum(list_transform(spans, lambda x: x.b - x.a)), 0)::bigint as n_removed,
       coalesce(len(spans), 0)::bigint as n_spans,
       sha256(unhex(case when spans is null then h else
           list_aggregate(list_transform(range(1, len(spans) + 2), lambda n:
               substr(h, case when n = 1 then 1 else 2 * spans[n - 1].b - 1 end,
                      case when n > len(spans) then length(h) else 2 * spans[n].a - 2 end
                      - case when n = 1 then 0 else 2 * spans[n - 1].b - 2 end)), 'string_agg', '') end)) as kept_sha256
from p
"""

OP3 = rf"""
with rules(v, rh, rp) as (values {_RULES}),
u as (select page_id, case when strpos(url, '://') > 0
             then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
p as (select row_number() over () as r, page_id,
             translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz') as host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
f as (select r, page_id, host, path, rh || rp as rule, v,
             row_number() over (partition by r order by length(rh || rp) desc, v desc) as n
      from p left join rules on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp))
select page_id, host, path, rule, coalesce(v, '{DEFAULT_VERDICT}') as verdict from f where n = 1
"""

OP6 = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v from embeddings
           where vec_id is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
e as (select vec_id, unnest(v) as x, unnest(range(len(v))) as j from v),
s as (select q.vec_id as query_id, c.vec_id, sum(q.x * c.x)::bigint as score
      from e q join e c on q.j = c.j and q.vec_id <> c.vec_id where q.vec_id % 100 = 0 group by 1, 2),
r as (select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank,
             vec_id, score from s)
select * from r where rank <= 10
"""

OP7 = """
with p as (select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
                  sha1(coalesce(html, '')) as payload_digest from pages),
r as (select payload_digest as d, max(page_id) as response from p
      where payload_bytes >= 1000 group by 1)
select page_id, payload_bytes, payload_digest,
       case when response <> page_id then 'revisit' else 'response' end as record_type,
       case when response <> page_id then response end as refers_to
from p left join r on d = payload_digest and payload_bytes >= 1000
"""

OP9 = rf"""
with docs as (select doc_id, source,
                     coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
                     md5('mix' || coalesce(doc_id::varchar, '')) as key from documents),
s0 as (select source, sum(size)::bigint as source_size from docs group by 1),
s1 as (select *, row_number() over (order by source is null, encode(source)) as position from s0),
s2 as (select *, [{', '.join(f'{float(w)}' for w in WEIGHTS)}][(position - 1) % {len(WEIGHTS)} + 1]::double as weight,
              source_size * {MAX_EPOCHS}::double as cap from s1),
s3 as (select *, cap / weight as ratio from s2),
s4 as (select *, ((sum(source_size) over ())::double * {SHARE}::double
                  - coalesce(sum(cap) over (order by ratio, position rows between unbounded preceding and 1 preceding), 0))
                 / (sum(weight) over () - coalesce(sum(weight) over
                    (order by ratio, position rows between unbounded preceding and 1 preceding), 0)) as level from s3),
s5 as (select *, max(case when level <= ratio then level end) over () as water from s4),
s6 as (select source, source_size,
              case when water is null then cap else least(cap, water * weight) end as target from s5),
s as (select *, floor(target)::bigint as budget from s6),
d as (select docs.doc_id, docs.size, s.source_size, s.target, s.budget,
             coalesce(sum(docs.size) over (partition by docs.source order by key, docs.doc_id, docs.size
                      rows between unbounded preceding and 1 preceding), 0) as before
      from docs join s on docs.source is not distinct from s.source)
select doc_id, size, source_size, target,
       (case when source_size = 0 then 0 else
        (budget // source_size) * size
        + greatest(0, least(size, budget % source_size - before)) end)::bigint as taken
from d
"""


OP10 = r"""
with recursive w as (select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) as w from documents),
s as (select distinct doc_id, case when len(w) = 1 then w[1] else w[i] || ' ' || w[i + 1] end as s
      from (select doc_id, w, unnest(range(1, greatest(len(w), 2))) as i from w where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by 1),
p as (select a.doc_id as a, b.doc_id as b, count(*) as common from s a join s b on a.s = b.s and a.doc_id < b.doc_id
      group by 1, 2),
l as (select a, b from p join n na on na.doc_id = a join n nb on nb.doc_id = b
      where 100 * common >= 80 * (na.n + nb.n - common)),
e as (select a, b from l union all select b, a from l),
r as (select doc_id as a, doc_id as b from w union select r.a, e.b from r join e on r.b = e.a)
select w.doc_id, coalesce(n, 0)::bigint as n_shingles, min(r.b) as component_id, w.doc_id = min(r.b) as kept
from w left join n using (doc_id) join r on r.a = w.doc_id group by w.doc_id, n
"""


OP11 = r"""
with p as (select lang, regexp_extract_all(x, '[^\x20\x09]+') as w from (
        select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as x from documents)),
g as (select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase, count(*) as f
      from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i
            from p, (values (1), (2), (3)) as sizes(k) where len(w) >= k) group by all),
n as (select lang, sum(f)::bigint as n from g where k = 1 group by lang),
c as (select lang, k, phrase, f as a, string_split(phrase, ' ') as w from g where k > 1 and f >= 10),
s as (select c.*, cut, array_to_string(w[:cut], ' ') as x, array_to_string(w[cut + 1:], ' ') as y
      from (select *, unnest(range(1, k)) as cut from c) c),
v as (select s.*, gl.f as l, gr.f as r, (1000000::hugeint * a * a // (gl.f::hugeint * gr.f)) as score
      from s join g gl on gl.lang = s.lang and gl.k = cut and gl.phrase = x
             join g gr on gr.lang = s.lang and gr.k = s.k - cut and gr.phrase = y),
b as (select lang, k, phrase, a, arg_min({'l': l, 'r': r}, score * 10 + cut) as cut, min(score) as score
      from v group by all),
i as (select lang, array_to_string(w[j:j + 1], ' ') as phrase, max(a) as longer
      from (select lang, w, a, unnest([1, 2]) as j from c where k = 3) group by all)
select * from (
    select lang, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank,
           phrase, a, cut.l as l, cut.r as r, n, score::bigint as score
    from b left join i using (lang, phrase) join n using (lang)
    where k = 3 or longer is null or 100 * longer < 50 * a)
where rank <= 2000
"""

OP12 = r"""
with d as (select doc_id, coalesce(text, '') as text, sha256('42:' || coalesce(doc_id::varchar, '')) as h from documents),
t as (select *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as w,
             ('0x' || substr(h, 1, 8))::ubigint as h1, ('0x' || substr(h, 9, 8))::ubigint as h2,
             ('0x' || substr(h, 17, 8))::ubigint as h3, ('0x' || substr(h, 25, 8))::ubigint as h4 from d),
c as (select *, len(w) as n, least(h1 % (len(w) + 1), h2 % (len(w) + 1))::bigint as low,
             greatest(h1 % (len(w) + 1), h2 % (len(w) + 1))::bigint as high from t),
f as (select *, case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
                     or h3 % 100 >= 50 then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end as form,
             array_to_string(w[:low], '') as prefix, array_to_string(w[low + 1:high], '') as middle,
             array_to_string(w[high + 1:], '') as suffix from c)
select doc_id, n::bigint as n, form,
       case when form <> 'plain' then length(prefix) end::bigint as prefix_chars,
       case when form <> 'plain' then length(middle) end::bigint as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(text) as restored_sha256
from f
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_suffix_dedup": OP1, "op3_url_filters": OP3, "op6_top_k": OP6, "op7_warc": OP7, "op9_mixing": OP9,
            "op10_near_duplicates": OP10, "op11_collocations": OP11, "op12_fill_in_middle": OP12}
