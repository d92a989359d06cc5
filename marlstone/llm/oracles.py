"""DuckDB SQL for the rows of the queries that SQL can express, by plain joins and groups over whole tables."""

from __future__ import annotations

from . import license

# Similarity of all pairs of distinct sets that share a shingle, and reachability over the links.
OP3 = r"""
with recursive w as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') as w from documents),
s as (select doc_id, list_sort(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')] else list_distinct([array_to_string(w[i : i + 4], ' ') for i in range(1, len(w) - 3)]) end) as sh from w),
u as (select sh, min(doc_id) as rep, len(sh) as n from s where len(sh) > 0 group by sh),
e as (select rep, n, unnest(sh) as g from u),
links as (select a.rep as a, b.rep as b from e a join e b on a.g = b.g and a.rep < b.rep and a.n * 100 >= b.n * 85 and b.n * 100 >= a.n * 85 group by a.rep, b.rep, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
both_ways as (select a, b from links union all select b, a from links),
reach as (select rep as node, rep as root from u union select b, root from both_ways join reach on a = node),
comp as (select node, min(root) as component_id from reach group by node)
select s.doc_id, len(s.sh)::bigint as n_shingles, coalesce(component_id, s.doc_id) as component_id, coalesce(component_id, s.doc_id) = s.doc_id as kept from s left join u on u.sh = s.sh and len(s.sh) > 0 left join comp on comp.node = u.rep
"""

# Lines of distinct texts counted by host; 3-word windows by text.
OP4 = r"""
with d as (select doc_id, source, coalesce(text, '') as text, list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') as w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) as ls from documents),
t as (select doc_id, i, (w[i], w[i + 1], w[i + 2]) as g from d, unnest(range(1, len(w) - 1)) u(i)),
r as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as n from t) where n > 1),
rep as (select doc_id, count(distinct i + k) as n_repeat_words from r, (values (0), (1), (2)) v(k) group by doc_id),
line as (select source, text, regexp_replace(regexp_replace(lower(x), '[0-9]', '0', 'g'), '[ \t\n\x0B\f\r]+', ' ', 'g') as raw, len(list_filter(string_split_regex(x, '[ \t\n\x0B\f\r]+'), lambda y: y <> '')) as n from (select distinct source, text, ls from d), unnest(ls) u(x)),
li as (select source, text, trim(raw, ' ') as line, n from line),
often as (select source, line from li group by source, line having count(distinct text) > 20 and count(distinct text) * 1000 > 2 * (select count(*) from documents q where q.source is not distinct from li.source)),
fr as (select li.source, li.text, sum(n)::bigint as n_frequent_words from li join often o on li.source is not distinct from o.source and li.line = o.line group by li.source, li.text)
select d.doc_id, len(w)::bigint as n_words, length(regexp_replace(d.text, '[ \t\n\x0B\f\r]+', '', 'g'))::bigint as word_chars, length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
  (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words, len(w) < 50 or 100 * coalesce(n_repeat_words, 0) > 50 * len(w) as base_failed,
  coalesce(n_frequent_words, 0) as n_frequent_words, not (len(w) < 50 or 100 * coalesce(n_repeat_words, 0) > 50 * len(w)) and coalesce(n_frequent_words, 0) * 100 < len(w) * 80 as kept
from d left join rep using (doc_id) left join fr on fr.source is not distinct from d.source and fr.text = d.text
"""

_ROWS = ", ".join("(%d, '%s', %s, %d, %d, '%s')" % r for r in license.template_rows(license.PHRASES, license.TEMPLATES))
# Votes of word pairs for diagonals of the same templates.
OP7 = r"""
with tm(template, label, is_phrase, grams, t, gram) as (values """ + _ROWS + r"""),
d as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents),
v as (select doc_id, template, label, is_phrase, grams, t, p - 1 - t as diagonal from d, unnest(range(1, len(w))) u(p) join tm on gram = w[p] || ' ' || w[p + 1]),
l as (select doc_id, template, label, is_phrase, grams, diagonal, list(distinct t) as places_t from v group by all),
n as (select *, case when diagonal - lag(diagonal) over q <= 3 then 0 else 1 end as fresh from l window q as (partition by doc_id, template order by diagonal)),
s as (select *, sum(fresh) over (partition by doc_id, template order by diagonal) as span from n),
m as (select doc_id, template, label, is_phrase, grams, span, len(list_distinct(flatten(list(places_t)))) as agree, count(*) filter (is_phrase and len(places_t) = grams) as places,
  min(diagonal) filter (len(places_t) = grams) as first_at, max(diagonal) filter (len(places_t) = grams) as last_at from s group by doc_id, template, label, is_phrase, grams, span),
k as (select *, case when is_phrase then places > 0 else agree * 100.0 / grams >= case when grams < 10 then 90 else 60 end end as found from m),
g as (select doc_id, sum(places)::bigint as n_base, min(first_at) filter (is_phrase and places > 0) as first_word, max(last_at) filter (is_phrase and places > 0) as last_word,
  string_agg(distinct label, ',' order by label) filter (is_phrase and places > 0) as base_labels, string_agg(distinct label, ',' order by label) filter (found) as labels, max(least(1.0::double, agree::double / grams)) filter (found) as score from k group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_base, 0) as n_base, first_word::bigint as first_word, last_word::bigint as last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0::double) as score from d left join g using (doc_id)
"""

# Two lines within one edit share a half; the edit distance of all such pairs decides.
OP8 = r"""
with d as (select doc_id, coalesce(text, '') as text, string_split(coalesce(text, ''), chr(10)) as raw from documents),
l as (select doc_id, i, trim(regexp_replace(lower(raw[i]), '[ \t\n\x0B\f\r]+', ' ', 'g'), ' ') as line from d, unnest(range(1, len(raw) + 1)) u(i)),
f as (select line, min((doc_id, i)) as first, length(line) as n from l where line <> '' group by line),
c as (select line, first, n, left(line, n // 2) as front, right(line, n - n // 2) as back, left(line, (n - 1) // 2) as front1, right(line, n - 1 - (n - 1) // 2) as back1 from f where n >= 32),
p as (
  select a.line, b.line as other, a.first, b.first as before from c a join c b on a.n = b.n and a.front = b.front and a.line <> b.line
  union all select a.line, b.line, a.first, b.first from c a join c b on a.n = b.n and a.back = b.back and a.line <> b.line
  union all select a.line, b.line, a.first, b.first from c a join c b on a.n = b.n + 1 and a.front1 = b.front
  union all select a.line, b.line, a.first, b.first from c a join c b on a.n = b.n + 1 and a.back1 = b.back
  union all select b.line, a.line, b.first, a.first from c a join c b on a.n = b.n + 1 and a.front1 = b.front
  union all select b.line, a.line, b.first, a.first from c a join c b on a.n = b.n + 1 and a.back1 = b.back),
near as (select distinct line from p where before < first and levenshtein(line, other) <= 1),
m as (select l.doc_id, l.i, (l.doc_id, l.i) > f.first as exact, near.line is not null as near from l join f using (line) left join near using (line)),
g as (select doc_id, list(i) filter (exact or near) as gone, count(*) filter (exact) as n_exact, count(*) filter (near and not exact) as n_near from m group by doc_id)
select d.doc_id, len(raw)::bigint as n_lines, coalesce(n_exact, 0) as n_exact, coalesce(n_near, 0) as n_near,
  case when gone is null then text else coalesce(array_to_string([raw[k] for k in range(1, len(raw) + 1) if not list_contains(gone, k)], chr(10)), '') end as text
from d left join g using (doc_id)
"""

OP9 = r"""
with d as (select doc_id, regexp_replace(coalesce(text, ''), '[ \t\n\x0B\f\r]+', ' ', 'g') as norm from documents),
g as (select norm, min(doc_id) as keep_id, count(*) as group_size from d group by norm)
select d.doc_id, g.keep_id, g.group_size, d.doc_id is not distinct from g.keep_id as kept, sha256(d.norm) as text_sha256
from d join g using (norm)
"""




def _op11(k: int = 8, rounds: int = 10) -> str:
    """Distances of all vectors to all centroids, round by round."""
    near = "a{r} as materialized (select vec_id, q, arg_min(struct_pack(j, d), struct_pack(d, j)) as best from (select vec_id, x.q, j, list_sum(list_transform(range(1, 65), lambda i: (x.q[i] - c.q[i]) * (x.q[i] - c.q[i])))::bigint as d from kept x, c{r} c) group by vec_id, q)"
    mean = "c{n} as materialized (select c.j, coalesce(m.q, c.q) as q from c{r} c left join (select j, list(((s - ((s % n) + n) % n) // n)::bigint order by i) as q from (select best.j as j, i, sum(q[i])::bigint as s, count(*)::bigint as n from a{r}, unnest(range(1, 65)) u(i) group by best.j, i) group by j) m on c.j = m.j)"
    steps = [near.format(r=r) + ", " + mean.format(r=r, n=r + 1) for r in range(rounds)]
    return f"""
with kept as materialized (select vec_id, list_transform(embedding, lambda v: floor(1024 * v::double)::bigint) as q from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda v: v is not null and isfinite(v))) = 64),
c0 as materialized (select (row_number() over (order by h) - 1)::integer as j, q from (select sha256('3:' || vec_id) as h, q from kept order by h limit {k})),
{", ".join(steps)}, {near.format(r=rounds)},
t as (select best.j as j, sum(best.d)::bigint as d from a{rounds} group by best.j)
select vec_id, best.j as cluster, best.d as distance, t.d as cluster_inertia, (select sum(d)::bigint from t) as inertia, sha256(array_to_string(c.q, ',')) as centroid_sha256
from a{rounds} a join t on t.j = a.best.j join c{rounds} c on c.j = t.j
"""


# All documents that share a term with an item, scored in full.
OP12 = r"""
with d as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents),
q as (select distinct item_id, unnest(list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) as term from benchmark),
g as (select count(*) as docs, sum(len(w))::bigint as total from d where len(w) > 0),
p as (select doc_id, n, term, count(*) as tf from (select doc_id, len(w) as n, unnest(w) as term from d) where term in (select term from q) group by doc_id, n, term),
v as (select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as weight from p, g group by term, docs),
s as (select item_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total))))::bigint as score from q join v using (term) join p using (term), g group by item_id, doc_id),
r as (select item_id, row_number() over (partition by item_id order by score desc, doc_id) as rank, doc_id, score from s where score > 0)
select item_id, rank::integer as rank, doc_id, score from r where rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_minhash_near_dedup": OP3, "op4_quality_rules": OP4, "op7_license_scan": OP7, "op8_line_dedup": OP8, "op9_exact_dedup": OP9, "op11_centroid_clustering": _op11(), "op12_ranked_search": OP12}
