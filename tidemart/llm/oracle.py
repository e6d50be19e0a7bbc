"""The queries that SQL can express, as DuckDB SQL written from their definitions."""

from __future__ import annotations

from tidemart.llm import chosenpath, jaccard, licences, lines
from tidemart.llm.queries import CHECK_TURN


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _replaced(expr: str, pairs) -> str:
    for old, new in pairs:
        expr = f"replace({expr}, {_text(old)}, {_text(new)})"
    return expr


def _canonical(expr: str) -> str:
    low = f"lower(coalesce({expr}, ''))"
    notice = r"(?m)^[^a-z0-9\n]*(copyright|\(c\)|©)[^\n]*$"
    bare = f"regexp_replace({low}, {_text(notice)}, ' ', 'g')"
    words = f"trim(regexp_replace({bare}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    pairs = [(f" {a.replace(' ', '  ')} ", f" {b.replace(' ', '  ')} ") for a, b in licences.SPELLINGS]
    doubled = f"(' ' || replace({words}, ' ', '  ') || ' ')"
    return f"replace(trim({_replaced(doubled, pairs)}), '  ', ' ')"


def _licence_scan() -> str:
    known = ", ".join(f"({_text(name)}, {_text(text)})" for name, text in licences.KNOWN)
    return f"""
with known as (select sha256({_canonical('t')}) as digest, min(l) as licence from (values {known}) as k(l, t) group by 1),
units as (select doc_id, true as is_whole, {_canonical('text')} as form from documents
          union all select doc_id, false, {_canonical('line')}
          from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line from documents)),
hits as (select u.doc_id, is_whole, case when form <> '' then sha256(form) end as dig, k.licence as lic
         from units u left join known k on form <> '' and k.digest = sha256(form))
select doc_id, min(dig) filter (is_whole) as digest, min(lic) filter (is_whole) as licence,
  count(lic) filter (not is_whole) as n_notices,
  coalesce(array_to_string(list_sort(list(distinct lic) filter (not is_whole and lic is not null)), ','), '') as notices
from hits group by doc_id"""


def _line_dedup() -> str:
    return f"""
with l as (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
h as (select *, list_transform(ls, lambda x: cast('0x' || substr(md5(x), 1, 7) as bigint)) as hs from l),
e as (select *, list_filter(range(1, len(ls) + 1), lambda k: k = len(ls) or hs[k] > hs[k + 1]) as ends from h),
c as (select doc_id, ls, unnest(list_transform(range(1, len(ends) + 1),
        lambda j: {{'a': case when j > 1 then ends[j - 1] else 0 end + 1, 'b': ends[j]}})) as c from e),
t as (select doc_id, c.a as a, c.b as b, array_to_string(ls[c.a:c.b], chr(10)) as chunk from c),
f as (select *, row_number() over (partition by chunk order by doc_id, a) as nth from t),
kept as (select doc_id, string_agg(chunk, chr(10) order by a) filter (nth = 1 or b - a + 1 < {lines.LEAST_LINES}) as text,
  sum(b - a + 1) as n_lines, count(*) as n_chunks,
  coalesce(sum(b - a + 1) filter (nth > 1 and b - a + 1 >= {lines.LEAST_LINES}), 0) as gone from f group by doc_id)
select doc_id, cast(n_lines as bigint) as n_lines, n_chunks, cast(gone as bigint) as n_removed_lines,
  sha256(coalesce(text, '')) as kept_sha256 from kept"""


def _chat_format() -> str:
    pairs = [("\\", "\\\\"), ("<|", "<\\|"), ("</s>", "<\\/s>"), ("<s>", "<\\s>"), ("[INST]", "[\\INST]"), ("[/INST]", "[\\/INST]")]
    marks = len("<|turn|><|text|><|end|>\n")
    return f"""
with r as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', {_text(CHECK_TURN)} union all select -1, 1, 'assistant', {_text(CHECK_TURN)}),
o as (select *, row_number() over w as k, count(*) over (partition by conv_id) as n,
  sum(length({_replaced('role', pairs)}) + length({_replaced('text', pairs)}) + {marks}) over w as upto
  from r window w as (partition by conv_id order by turn nulls first, role, text rows unbounded preceding))
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by k)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by k) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(upto) filter (role = 'assistant' or k = n) as bigint) as formatted_chars
from o group by conv_id"""


def _centroid_clusters() -> str:
    def assigned(name: str, centroids: str) -> str:
        return f"""
{name} as (select id, v, c, d from (select k.id, k.v, s.c, cast(list_sum(list_transform(range(1, 65),
    lambda j: (k.v[j] - s.v[j]) * (k.v[j] - s.v[j]))) as bigint) as d from kept k cross join {centroids} s)
  qualify row_number() over (partition by id order by d, c) = 1)"""

    def moved(name: str, before: str, members: str) -> str:
        return f"""
{name}_sums as (select c, j, cast(sum(v[j]) as bigint) as s, count(*) as n from {members}, range(1, 65) as t(j) group by c, j),
{name} as (select b.c, coalesce(m.v, b.v) as v from {before} b left join (
  select c, list((s - ((s % n) + n) % n) // n order by j) as v from {name}_sums group by c) m using (c))"""

    steps = []
    for k in range(3):
        steps += [assigned(f"a{k}", f"c{k}"), moved(f"c{k + 1}", f"c{k}", f"a{k}")]
    return f"""
with kept as materialized (select row_number() over () as id, vec_id,
    list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v
  from embeddings where len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64 and len(embedding) = 64),
c0 as (select row_number() over (order by sha256('1:' || vec_id), v) - 1 as c, v from kept qualify c < 16),{",".join(steps)},{assigned("f", "c3")}
select k.vec_id, cast(f.c as int) as cluster, f.d as distance, cast(sum(f.d) over (partition by f.c) as bigint) as cluster_inertia,
  cast(sum(f.d) over () as bigint) as inertia, sha256(array_to_string(c3.v, ',')) as centroid_sha256
from f join kept k using (id) join c3 on c3.c = f.c"""


LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _importance_resampling() -> str:
    def words(table: str) -> str:
        text = f"translate(coalesce(text, ''), '{LETTERS}', '{LETTERS.lower()}')"
        return f"select *, regexp_extract_all({text}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as ws from {table}"

    return f"""
with d as (select row_number() over () as id, doc_id, ws from ({words("documents")})), b as ({words("benchmark")}),
places as (select list(list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)
  order by i) as tab from range(256) as t(i)),
dw as (select id, unnest(ws) as w from d), bw as (select unnest(ws) as w from b),
vocabulary as (select w, hex(encode(w)) as h from (select w from dw union select w from bw)),
hashed as (select w, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(h) // 2),
    lambda j: cast('0x' || substr(h, cast(2 * j + 1 as bigint), 2) as bigint))),
  lambda c, x: xor(c >> 8, tab[1 + (xor(c, x) & 255)])), 4294967295) % 10000 as bucket from vocabulary, places),
s as (select bucket, count(*) as n from dw join hashed using (w) group by 1),
t as (select bucket, count(*) as n from bw join hashed using (w) group by 1),
g as (select i as bucket, cast(floor(1000 * ln((coalesce(t.n, 0) + 1)::double * ((select count(*) from dw) + 10000)::double
    / ((coalesce(s.n, 0) + 1)::double * ((select count(*) from bw) + 10000)::double))) as bigint) as gain
  from range(10000) as r(i) left join s on s.bucket = i left join t on t.bucket = i),
sums as (select id, count(*) as n, cast(sum(gain) as bigint) as total from dw join hashed using (w) join g using (bucket) group by id),
scored as (select d.id, doc_id, coalesce(n, 0) as n_features, case when n is null then 0 else (total - ((total % n) + n) % n) // n end as weight,
    cast('0x' || substr(sha256('2024:' || doc_id), 1, 8) as bigint) as h from d left join sums using (id)),
final as (select *, weight + cast(floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double))) as bigint) as score from scored),
drawn as (select id, row_number() over (order by score desc, doc_id) as rank from final where n_features >= 20
  qualify rank <= 10 * (select count(*) from final where n_features >= 20) // 100)
select doc_id, n_features, weight, score, rank from final left join drawn using (id)"""


def _near_duplicates(width: int, *more: str) -> str:
    """Components of documents whose shingle sets link, all pairs that share a shingle counted."""
    return f"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{LETTERS}', '{LETTERS.lower()}'),
    '[^\\x20\\x09-\\x0D]+') as ws from documents),
s as (select doc_id, list_sort(list_distinct(case when len(ws) = 0 then [] when len(ws) < {width} then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - {width - 2}), lambda k: array_to_string(ws[k:k + {width - 1}], ' ')) end)) as sh from w),
classes as materialized (select min(doc_id) as node, sh from s where len(sh) > 0 group by sh),
e as materialized (select node, len(sh) as n, unnest(sh) as t from classes),
p as materialized (select x.node as a, y.node as b from e x join e y on x.t = y.t and x.node < y.node and 5 * x.n >= 4 * y.n and 5 * y.n >= 4 * x.n
  group by x.node, y.node, x.n, y.n having 100 * count(*) >= 80 * (x.n + y.n - count(*))),
l as materialized (select a, b from p union all select b, a from p),
reach as (select node, node as root from classes union select l.b, reach.root from reach join l on l.a = reach.node),
roots as (select sh, min(root) as root from reach join classes using (node) group by sh)
select doc_id, cast(len(s.sh) as bigint) as n_shingles, coalesce(root, doc_id) as component_id{"".join(", " + m for m in more)}
from s left join roots on roots.sh = s.sh"""


def statements() -> dict[str, str]:
    return {"op4_licence_scan": _licence_scan(), "op7_line_dedup": _line_dedup(), "op9_jaccard_join": _near_duplicates(jaccard.WIDTH),
            "op10_chat_format": _chat_format(), "op11_centroid_clusters": _centroid_clusters(),
            "op12_importance_resampling": _importance_resampling(),
            "op13_minhash_near_duplicates": _near_duplicates(chosenpath.WIDTH, "doc_id = coalesce(root, doc_id) as kept")}
