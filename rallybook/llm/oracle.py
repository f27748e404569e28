"""SQL for DuckDB that checks the text queries which SQL can express."""

from __future__ import annotations

from rallybook.llm.url_filter import CAPTURES_SQL, ENTRIES_SQL, HOSTS_SQL

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACED = r"[^\x20\x09-\x0D]+"
PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text: str, pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '{pattern}')"


SUFFIX_DEDUP = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as hx, strlen(coalesce(text, '')) as n from documents),
w as (select doc_id, p, substr(hx, 2 * p - 1, 100) as s from (select *, unnest(range(1, n - 48)) as p from d) x),
f as (select s, min(doc_id) as m from w group by s),
c as (select doc_id, p, lag(p) over (partition by doc_id order by p) as q from w join f using (s) where m < doc_id),
i as (select doc_id, p, sum(case when p <= q + 50 then 0 else 1 end) over (partition by doc_id order by p) as g from c),
r as (select doc_id, min(p) as a, max(p) + 49 as b from i group by doc_id, g),
k as (select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as e from r),
t as (select doc_id, sum(b - a + 1) as removed, count(*) as spans, max(b) as z,
       string_agg(substr(hx, 2 * e + 1, 2 * (a - e - 1)), '' order by a) as kept
      from k join d using (doc_id) group by doc_id)
select doc_id, n as n_bytes, cast(coalesce(removed, 0) as bigint) as n_removed, coalesce(spans, 0) as n_spans,
 sha256(unhex(coalesce(kept, '') || substr(hx, 2 * coalesce(z, 0) + 1))) as kept_sha256
from d left join t using (doc_id)
"""

NEAR_DEDUP = f"""
with recursive w as (select doc_id, {lowered("text", SPACED)} as w from documents),
s as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as g
      from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from w where len(w) > 0) x),
n as (select doc_id, count(*) as n from s group by doc_id),
l as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.g = b.g and a.doc_id <> b.doc_id
      group by 1, 2),
e as (select a, b from l join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 75 * (x.n + y.n - k)),
r as (select doc_id as a, doc_id as b from documents union select r.a, e.b from r join e on r.b = e.a),
c as (select a, min(b) as m from r group by a)
select w.doc_id, coalesce(n, 0) as n_shingles, m as component_id, w.doc_id = m as kept
from w left join n using (doc_id) join c on c.a = w.doc_id
"""

MIXING = rf"""
with d as (select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '{SPACED}')) as bigint) as size,
            md5('mix-1:' || coalesce(cast(doc_id as varchar), '')) as k from documents),
s as (select source, sum(size) as n, (row_number() over (order by source nulls last) - 1) % 3 + 1 as w
      from d group by source),
o as (select *, 3 * n as cap, sum(n) over () as total, 3 * n / w as ratio from s),
b as (select *, total - coalesce(sum(cap) over (order by ratio, source nulls last
        rows between unbounded preceding and 1 preceding), 0) as left_,
       sum(w) over (order by ratio, source nulls last rows between current row and unbounded following) as rest from o),
c as (select *, cap * rest <= w * left_ as clamped from b),
v as (select left_ as vl, rest as vr from c where not clamped order by ratio, source nulls last limit 1),
t as (select source, cast(n as bigint) as source_size,
       case when clamped then cast(cap as double) else cast(w as double) * cast(vl as double) / cast(vr as double) end as target
      from c left join v on true),
g as (select *, case when source_size > 0 then cast(round(target) as bigint) // source_size else 0 end as whole,
       case when source_size > 0 then cast(round(target) as bigint) % source_size else 0 end as more from t),
x as (select d.*, coalesce(sum(size) over (partition by source order by k, doc_id, size
        rows between unbounded preceding and 1 preceding), 0) as before from d)
select doc_id, size, source_size, target,
 cast(size * whole + least(greatest(more - before, 0), size) as bigint) as taken
from x join g on x.source is not distinct from g.source
"""

DECONTAMINATION = f"""
with i as (select cast(item_id as varchar) as item, {lowered("text", PLAIN)} as w from benchmark),
iw as (select distinct item, m, array_to_string(w[j:j + m - 1], ' ') as g
       from (select *, unnest(range(1, len(w) - m + 2)) as j
             from (select *, least(len(w), 10) as m from i where len(w) > 0) y) x),
d as (select doc_id, {lowered("text", PLAIN)} as w from documents),
dw as (select doc_id, m, j, array_to_string(w[j:j + m - 1], ' ') as g
       from (select *, unnest(range(1, len(w) - m + 2)) as j
             from d cross join (select distinct m from iw) z where len(w) >= m) x),
h as (select doc_id, j, dw.m, item from dw join iw on dw.g = iw.g and dw.m = iw.m),
n as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(j, j + m)) as p from h) x group by doc_id),
t as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
      from (select distinct doc_id, item from h where item is not null) x group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
 sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join n using (doc_id) left join t using (doc_id)
"""

URL_FILTER = rf"""
with recursive hosts as ({HOSTS_SQL.format(pages="pages")}),
e0 as (select pattern, date '1970-01-01' + n as day, listed from ({ENTRIES_SQL}) x),
e as (select lower(pattern) as pattern, day, bool_or(listed) as listed from e0 group by 1, 2),
v as (select pattern, day as since, listed, lead(day) over (partition by pattern order by day) as until from e),
c as (select page_id, url, date '1970-01-01' + n as day from ({CAPTURES_SQL.format(pages="pages")}) x),
h as (select *, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) as host,
       lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^/?#]+)', 1)) as path from c),
q as (select page_id, day, host as pattern from h
      union select page_id, day, substr(pattern, instr(pattern, '.') + 1) from q
       where instr(substr(pattern, instr(pattern, '.') + 1), '.') > 0),
p as (select * from q union select page_id, day, host || path from h where path <> ''),
f as (select page_id, count(*) as n, arg_max(p.pattern, (length(p.pattern), p.pattern)) as matched
      from p join v on p.pattern = v.pattern and listed and day >= since and (until is null or day < until)
      group by page_id)
select h.page_id, nullif(host, '') as host, h.day as fetched, coalesce(n, 0) as n_active, matched,
 matched is not null as blocked
from h left join f using (page_id)
"""

WORDS = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"

DIVERGENCE = f"""
with d as (select coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as r, text from documents),
w as (select lang, source, r, unnest({lowered("text", WORDS)}) as term from d),
k as (select lang, term, count(*) as n from w group by lang, term having count(distinct r) >= 10),
l as (select lang, count(*) as v, sum(n) as n from k group by lang),
g as (select distinct lang, source from d),
c as (select lang, source, term, count(*) as n from w semi join k using (lang, term) group by lang, source, term),
t as (select lang, source, sum(n) as n from c group by lang, source),
x as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
       1 + (1000000000 * cast(coalesce(c.n, 0) + 2 as hugeint)) // (coalesce(t.n, 0) + 2 * l.v) as p,
       1 + (1000000000 * cast(k.n + 2 as hugeint)) // (l.n + 2 * l.v) as q
      from g join k using (lang) join l using (lang) left join t using (lang, source)
       left join c using (lang, source, term)),
s as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
      from x a join x b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by 1, 2, 3),
r as (select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(value, 0) as bigint) as value
      from g a join g b on a.lang = b.lang and a.source <> b.source
       left join s on s.lang = a.lang and s.source = a.source and s.item = b.source
      union all
      select lang, source, 'term', term, cast((p - q) * (p - q) // (p + q) as bigint) from x where n > 0 and p > q)
select * from (select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as int) as rank
               from r) y
where part = 'pair' or rank <= 10
"""

HARD_NEGATIVES = """
with e as (select row_number() over () as r, vec_id as id,
            cast(case when vec_id % 7 = 0 then (label + 1) % 10 else label end as bigint) as label,
            list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
           from embeddings where label is not null and embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.r as a, a.id as anchor_id, b.r as b, b.id, a.label = b.label as same,
       cast(list_inner_product(a.v, b.v) as bigint) as score
      from e a join e b on a.r <> b.r where a.id % 100 = 0),
p as (select * from (select *, row_number() over (partition by a order by score desc, id nulls last, b) as k from s where same) x
      where k <= 5),
n as (select p.a, p.b, p.anchor_id, p.id as positive_id, s.id as negative_id, p.score as positive_score, s.score as negative_score,
       cast(row_number() over (partition by p.a, p.b order by s.score desc, s.id nulls last, s.b) as int) as rank
      from p join s on p.a = s.a and not s.same and 30 * p.score <= 100 * s.score and 100 * s.score <= 90 * p.score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 10
"""

ORACLE_SQL: dict[str, str] = {
    "op1_suffix_dedup": SUFFIX_DEDUP,
    "op2_near_dedup": NEAR_DEDUP,
    "op4_mixing": MIXING,
    "op7_decontamination": DECONTAMINATION,
    "op8_url_filter": URL_FILTER,
    "op11_divergence": DIVERGENCE,
    "op12_hard_negatives": HARD_NEGATIVES,
}
