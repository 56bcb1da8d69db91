"""DuckDB SQL of the queries that SQL can express."""

_WS = r"[\t\n\x0B\f\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

_REPEATED = rf"""
with s as (select page_id, source_id, page, string_split(text, chr(10)) as ls from pages where text is not null),
l as (select page_id, source_id, page, unnest(ls) as line, unnest(range(1, len(ls) + 1)) as line_no from s),
k as (select *, regexp_replace(lower(regexp_replace(regexp_replace(line, '^{_WS}+|{_WS}+$', '', 'g'), '[ \t]+', ' ', 'g')), '[0-9]+', '0', 'g') as key
  from l where length(regexp_replace(line, '\P{{L}}+', '', 'g')) >= 10),
n as (select source_id, count(distinct page) as n_pages from pages group by 1),
f as (select k.source_id, key from k join n using (source_id) where n_pages >= 20 group by 1, 2 having count(distinct page) >= 0.25 * any_value(n_pages)),
hit as (select page_id, k.line_no from k join f using (source_id, key))"""

_LEAKS = r"""
with d as (select distinct doc_id, regexp_extract_all(replace(lower(text), 'ё', 'е'), '[\p{L}\p{N}]+') as w from documents where text is not null and doc_id is not null),
e as (select distinct item_id, regexp_extract_all(replace(lower(text), 'ё', 'е'), '[\p{L}\p{N}]+') as w from eval_items where text is not null and item_id is not null),
dg as (select doc_id, unnest(list_transform(range(1, len(w) - 10), lambda i: array_to_string(w[i:i + 11], ' '))) as g from d where len(w) >= 12),
eg as (select item_id, unnest(list_transform(range(1, len(w) - 10), lambda i: array_to_string(w[i:i + 11], ' '))) as g from e where len(w) >= 12),
leak as (select distinct doc_id, item_id from dg join eg using (g))"""

_PLACES = _LEAKS.split("dg as")[0] + """
dg as (select doc_id, unnest(range(0, len(w) - 11)) as di, unnest(list_transform(range(1, len(w) - 10), lambda i: array_to_string(w[i:i + 11], ' '))) as g from d where len(w) >= 12),
eg as (select item_id, unnest(range(0, len(w) - 11)) as ei, unnest(list_transform(range(1, len(w) - 10), lambda i: array_to_string(w[i:i + 11], ' '))) as g from e where len(w) >= 12),
m as (select doc_id, item_id, di, ei, di - row_number() over (partition by doc_id, item_id, di - ei order by di) as run from dg join eg using (g)),
r as (select doc_id, item_id, count(*) + 11 as n_words, min(di) as doc_word, min(ei) as item_word from m group by doc_id, item_id, di - ei, run)"""

SQL = {
    "p7_longest": _PLACES + " select doc_id, item_id, n_words, doc_word, item_word from r qualify row_number() over (partition by doc_id, item_id order by n_words desc, doc_word, item_word) = 1",
    "p7_found": _LEAKS + " select doc_id, item_id from leak",
    "p7_clean": _LEAKS + " select doc_id, text from documents where doc_id is null or doc_id not in (select doc_id from leak)",
    "p3_found": _REPEATED + " select distinct page_id, cast(line_no as integer) as line_no from hit",
    "p3_clean": _REPEATED
    + """,
g as (select page_id, list(line_no) as gone from hit group by 1)
select p.page_id, case when p.text is null then null
  else array_to_string(list_transform(list_filter(list_zip(string_split(p.text, chr(10)), range(1, len(string_split(p.text, chr(10))) + 1)),
    lambda x: not list_contains(coalesce(g.gone, []), x[2])), lambda x: x[1]), chr(10)) end as text,
  cast(coalesce(len(g.gone), 0) as integer) as n_removed
from pages p left join g using (page_id)""",
}
