"""DuckDB SQL of the document queries, written from the rules and not from the Spark expressions."""

from __future__ import annotations

# chunk texts, each chunk once; st(x) strips, ls(x) are the stripped lines that are not empty
_C = "with c as (select chunk_id, any_value(text) as text, any_value(doc_id) as doc_id, any_value(page) as page, any_value(block_type) as block_type from structural_chunks group by chunk_id)"


def st(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def ls(x: str) -> str:
    return rf"list_filter(list_transform(string_split({x}, chr(10)), lambda s: {st('s')}), lambda s: s <> '')"


_EXT = "case when strpos(lower(trim(coalesce(file_path, ''))), '.') > 0 then regexp_extract(lower(trim(coalesce(file_path, ''))), '([^.]*)$', 1) else '' end"
_FMT = f"case when lower(trim(coalesce(format, ''))) not in ('', 'nan') then lower(trim(format)) else {_EXT} end"
_VALID = "trim(coalesce(source_id, '')) <> '' and lower(trim(source_id)) <> 'nan' and trim(coalesce(file_path, '')) <> '' and lower(trim(file_path)) <> 'nan'"
_POLICY = f"""select *, {_EXT} as e, {_FMT} as f from registry"""
# fixed values: what each format needs and what its pages mean
_PREP = """case when f = 'pdf' or e = 'pdf' then 'none' when f = 'docx' or e = 'docx' then 'export_pdf_from_word_set_registry_to_pdf_for_page_critical_qa'
 when f = 'doc' or e = 'doc' then 'convert_binary_doc_to_docx_or_pdf_via_word_or_libreoffice_then_update_registry'
 when f = 'rtf' or e = 'rtf' then 'export_pdf_from_word_set_registry_to_pdf_same_as_docx_policy'
 when f = 'txt' or e in ('txt', 'log', 'md', 'csv') then 'none_plain_text_chunking'
 when f in ('xlsx', 'xls') or e in ('xlsx', 'xls') then 'dedicated_table_ingest_future_not_pdf_print'
 when e in ('jpg', 'jpeg', 'png', 'webp', 'heic', 'tif', 'tiff', 'bmp', 'gif') then 'ocr_pipeline_not_in_current_ingest' else 'review_manually' end"""

# one CTE per step of the block rules; t is the stripped text, n and p its lines and pipe rows
_BASE = (
    _C
    + rf""",
b as (select chunk_id, text, {st("text")} as t, {ls("text")} as l from c),
q as (select *, len(l) as n, len(list_filter(l, lambda s: starts_with(s, '|') and length(s) - length(replace(s, '|', '')) >= 2)) as p,
  regexp_matches(t, '^([*\-•]|\d+(?:\.\d+)*[.)]|[а-яА-ЯёЁa-zA-Z][.)])\s') as item,
  contains(t, '$$') or contains(t, 'assets/formulas/') or starts_with(t, '[Формула') as formula,
  {st(r"regexp_replace(t, '([а-яА-ЯёЁa-zA-Z])-\s*\n\s*([а-яА-ЯёЁa-zA-Z])', '\1\2', 'g')")} as h from b),
d as (select *, t <> '' and not regexp_matches(t, '[.:;!?)]$') and length(t) <= 220 and (regexp_matches(t, '(?i)(в|и|с|по|для|о|об|от|при|на|к)$') or regexp_matches(t, '\p{{Ll}}$')) as d_end,
  regexp_matches(t, '^[а-яёa-z(")\],]') and not item as d_start, {ls("h")} as hl,
  regexp_matches(h, '^\d{{1,3}}[.)]\s+[а-яА-ЯёЁa-zA-Z]') as point from q),
hd as (select *, not (h = '' or length(h) > 250 or len(hl) > 5 or len(list_filter(hl, lambda s: regexp_matches(s, '(?:\.{{3,}}|…|\s{{4,}})\s*\d+$') or regexp_matches(s, '(?i)(^|[^\p{{L}}\p{{N}}_])Стр\.\s*\d+$'))) > 0
    or starts_with(lower(h), 'таблица') or (length(h) < 40 and regexp_matches(h, '(?i)^(методика|страница\s*\d+|консультантплюс|источник\s*публикации|\d+)$'))
    or regexp_matches(h, '^[а-яёa-z]') or formula or starts_with(lower(h), 'где ') or starts_with(lower(h), 'в котором '))
  and ((regexp_matches(h, '\p{{Lu}}') and not regexp_matches(h, '[\p{{Ll}}\p{{Lt}}]') and length(h) < 150)
    or (not point and (regexp_matches(h, '^\d+(?:\.\d+)+\.?\s+[A-ZА-ЯЁ]') or regexp_matches(h, '(?i)^[IVXLCDM]+\.\s+[А-ЯЁA-Z]')
      or regexp_matches(h, '(?i)^(глава|раздел|приложение|часть)\s+[\dА-Яа-яЁёA-Za-z]+') or (length(h) > 10 and length(h) < 100 and not regexp_matches(h, '[.:;!?]$'))))) as header,
  case when regexp_matches(t, '^\d+(?:\.\d+)*\.?\s') then len(string_split(regexp_extract(t, '^(\d+(?:\.\d+)*)\.?\s', 1), '.'))
    when regexp_matches(t, '(?i)^[IVXLCDM]+\.\s+[А-ЯЁA-Z]') or regexp_matches(lower(t), '^(приложение|глава|раздел|часть)') then 1 end as level from d),
k as (select *, len(regexp_extract_all(t, '\d')) * 1.0 / greatest(length(t), 1) as dig, len(list_filter(l, lambda s: length(s) < 40)) * 1.0 / greatest(n, 1) as short,
  len(list_filter(l, lambda s: regexp_matches(s, '^([*\-•]|\d+(?:\.\d+)*[.)]|[а-яА-ЯёЁa-zA-Z][.)])\s'))) * 1.0 / greatest(n, 1) as items from hd),
w as (select *, case when t = '' then ['other', '0.0'] when formula then ['formula', '0.95'] when p = n and n > 1 then ['table', '0.8'] when p = n then ['table', '0.76']
  when n >= 3 and p >= greatest(3, floor(n * 0.55)) then ['table', '0.82'] when n >= 2 and p >= 2 and p >= floor(n * 0.4) then ['table', '0.78']
  when starts_with(lower(t), '[таблица]') and n > 1 and p >= greatest(2, floor((n - 1) * 0.45)) then ['table', '0.88']
  when n > 4 and short > 0.6 and dig > 0.05 and p >= 2 then ['table', '0.7'] when n > 2 and items >= 0.5 then ['list', '0.8']
  when len(regexp_extract_all(t, '\n\s*\d+\)\s+')) >= 2 then ['list', '0.75'] when header then ['header', '0.9'] when regexp_matches(t, '^\d{{1,3}}[.)]\s+[а-яА-ЯёЁa-zA-Z]') then ['paragraph', '0.8']
  when length(t) > 60 and (d_start or d_end) then ['paragraph', '0.7'] when length(t) > 60 then ['paragraph', '0.9'] else ['other', '0.5'] end as kind from k)"""
)

_BOXES = """select cast(l_orderkey as integer) as page, cast(l_linenumber as integer) as box_ord,
  case when l_linestatus = 'O' then 'isolate_formula' when l_returnflag = 'R' then 'table' else 'plain text' end as label,
  cast(l_partkey % 600 as integer) as x1, cast(l_suppkey * 37 % 800 as integer) as y1,
  cast(l_partkey % 600 + 20 + l_quantity * 8 as integer) as x2, cast(l_suppkey * 37 % 800 + 10 + l_quantity * 4 as integer) as y2 from lineitem"""
_BOXES_CONF = _BOXES.replace(" from lineitem", ", round(l_discount * 10, 2) as l_discount_10 from lineitem")
_WORDS = """select cast(l_orderkey as integer) as page, cast(l_linenumber as integer) as word_ord, cast(l_partkey * 7 % 700 as double) as cx, cast(l_suppkey * 53 % 900 as double) as cy from lineitem"""

_WS = r"[\t\n\x0B\f\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_LATIN = "".join(chr(b) for b in range(0x80, 0x100) if b != 0x98)
_CP1251 = bytes(b for b in range(0x80, 0x100) if b != 0x98).decode("cp1251")

UNREADABLE = "[ВНИМАНИЕ: СТРАНИЦА НЕЧИТАЕМА ИЗ-ЗА ПЛОХОГО КАЧЕСТВА СКАНА. ПОЖАЛУЙСТА, ОБРАТИТЕСЬ К ОРИГИНАЛУ]"
_UNREADABLE = """with t as (select cast(l_suppkey % 500 as integer) as page, l_quantity / case when l_suppkey % 3 = 0 then 100 else 50 end as conf from lineitem),
u as (select page, count(*) as n, avg(case when conf >= 0.4 then 1 else 0 end) as share from t group by 1 having n > 15 and share < 0.4)"""


def clean(x: str) -> str:
    """A page after recognition; the letters around a break are given back, and a second pass takes breaks that share a letter."""
    once = lambda t: rf"regexp_replace({t}, '([а-яА-ЯёЁa-zA-Z])-{_WS}+([а-яА-ЯёЁa-zA-Z])', '\1\2', 'g')"
    controls = rf"regexp_replace({once(once(x))}, '[\x{{FFFD}}\x00-\x08\x0B-\x1F\x7F]', ' ', 'g')"
    return rf"regexp_replace(regexp_replace({controls}, '[ \t]{{2,}}', ' ', 'g'), '^{_WS}+|{_WS}+$', '', 'g')"


def mended(token: str) -> str:
    """A token of Cyrillic read as Latin-1, put right."""
    fixed = f"translate({token}, '{_LATIN}', '{_CP1251}')"
    return rf"""case when not regexp_matches({token}, '[Ѐ-ӿ]') and regexp_matches({token}, '[À-ÿ]') and not regexp_matches({token}, '[^\x00-\x{{ff}}]')
  and not contains({token}, chr(152)) and regexp_matches({fixed}, '[Ѐ-ӿ]') then {fixed} else {token} end"""


def reads(x: str, cyrillic: str, odd: str) -> str:
    """Share of Cyrillic letters and of odd tokens."""
    letters = f"len(regexp_extract_all({x}, '[а-яА-ЯёЁa-zA-Z]'))"
    tokens = rf"regexp_extract_all({x}, '[^\t\n\x0B\f\r\x1C-\x20\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]+')"
    strange = rf"len(list_filter(list_transform({tokens}, lambda s: regexp_replace(s, '[^\p{{L}}\p{{N}}_]', '', 'g')), lambda s: length(s) >= 4 and not regexp_matches(s, '[аеёиоуыэюяAEIOUYaeiouy]')))"
    return f"""case when {letters} = 0 then 0.0 else len(regexp_extract_all({x}, '[а-яА-ЯёЁ]')) * 1.0 / {letters} end as {cyrillic},
  case when {letters} = 0 then 1.0 else {strange} * 1.0 / greatest(len({tokens}), 1) end as {odd}"""


_WORDS_OF = rf"regexp_extract_all(n0, '{_WS}+|[^\t\n\x0B\f\r\x1C-\x20\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]+')"

# kind, form, pattern: the character in front of a match is taken along and cut off, since RE2 looks neither behind nor ahead; a boundary behind a letter or digit is left to its own \b
_BEFORE = r"(?:^|[^\p{L}\p{N}_])"
_ENTITIES = (
    ("table_ref", "lower({})", rf"(?i){_BEFORE}таблиц[еуа]\s+\d+(?:\.\d+)*"),
    ("figure_ref", "lower({})", rf"(?i){_BEFORE}(?:рис\.|рисунок)\s+\d+(?:\.\d+)*"),
    ("reference", "lower({})", r"(?i)приложени[еяю]\s+[\d\.]+"),
    ("measurement", "replace({}, ',', '.')", rf"{_BEFORE}\d+(?:[\.,]\d+)?\s*(?:г/с|мг/м(?:.[\p{{L}}\p{{N}}_]|[\p{{L}}\p{{N}}_])?|т/год|ПДК|°C|кг|м³|г/м³|т/г)(?:$|[^\p{{L}}\p{{N}}_])"),
    ("normative_ref", "upper({})", r"(?i)(?:ГОСТ\s+Р?\s*\d+-\d+|СанПиН\s+\d\.\d\.\d\.\d+-\d+|ФЗ[ -]\d+)"),
)


def _inner(pattern: str) -> str:
    """The match without the characters beside it that were taken along."""
    out = rf"regexp_replace(s, '^[^\p{{L}}\p{{N}}_]', '')" if _BEFORE in pattern else "s"
    return rf"regexp_replace({out}, '[^\p{{L}}\p{{N}}_]$', '')" if pattern.endswith(r"_])") else out


def _stripped(rounds: int = 5, fraction: float = 0.5) -> str:
    """Running lines, one CTE per round; s0 holds each page's full lines and what is off its head (h) and foot (f)."""
    out = rf"""with p as (select page_id, coalesce(source_id, '') as s, page, list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '{_ENDS}'), lambda x: regexp_replace(x, '^{_WS}+|{_WS}+$', '', 'g')), lambda x: x <> '') as l from pages),
need as (select s, greatest(1, ceil(count(*) * {fraction} - 1e-12)) as need from p group by 1 having count(*) >= 3),
s0 as (select *, 0 as h, 0 as f, true as live from p)"""
    for i in range(1, 2 * rounds + 1):
        head = i <= rounds
        line = "l[h + 1]" if head else "l[len(l) - f]"
        live = "true" if i == rounds + 1 else "live"
        out += rf""",
k{i} as (select * exclude (live), case when {live} and len(l) > h + f and length({line}) between 5 and 240 then lower(regexp_replace({line}, '{_WS}+', ' ', 'g')) end as key from s{i - 1}),
b{i} as (select s, key as best from (select s, key, count(*) as n, min(page) as seen from k{i} where key is not null group by 1, 2) join need using (s)
  qualify row_number() over (partition by s order by n desc, seen) = 1 and n >= need),
s{i} as (select k.page_id, k.s, k.page, k.l, k.h + {"(k.key is not null and k.key = b.best)::int" if head else "0"} as h, k.f + {"0" if head else "(k.key is not null and k.key = b.best)::int"} as f, b.best is not null as live from k{i} k left join b{i} b on b.s = k.s)"""
    return out.replace("(k.key is not null and k.key = b.best)::int", "case when k.key = b.best then 1 else 0 end") + rf""",
t as (select x.page_id, x.source_id, x.page, x.text, e.h, e.f, regexp_split_to_array(coalesce(x.text, ''), '{_ENDS}') as raw from pages x join s{2 * rounds} e on e.page_id = x.page_id),
u as (select *, case when raw[-1] = '' then raw[:-2] else raw end as lines from t),
v as (select *, list_filter(range(1, len(lines) + 1), lambda i: regexp_replace(lines[i], '^{_WS}+|{_WS}+$', '', 'g') <> '') as full_at from u),
r as (select *, regexp_replace(array_to_string(lines[case when h > 0 then full_at[h] + 1 else 1 end:case when f > 0 then full_at[len(full_at) - f + 1] - 1 else len(lines) end], chr(10)), '^{_WS}+|{_WS}+$', '', 'g') as rest from v)
select page_id, source_id, page, case when h + f = 0 or rest = '' then text else rest end as text, h as n_head, f as n_foot from r"""


_ENDS = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"
_CELL = "regexp_matches({}, '^:?-{{3,}}:?$')"

SQL = {
    "stripped_pages": _stripped(),
    "table_matrices": _C
    + rf""", t as (select chunk_id, regexp_replace({st("text")}, '(?i)^\s*\[таблица\]\s*\n?', '') as t from c where block_type = 'table'), l as (select *, {ls("t")} as l from t),
 m as (select chunk_id, t, list_transform(l, lambda s: list_transform(string_split(substr(s, 2, length(s) - 2), '|'), lambda x: {st("x")})) as m from l
  where len(l) >= 3 and len(list_filter(l, lambda s: not (starts_with(s, '|') and ends_with(s, '|') and length(s) > 1))) = 0),
 n as (select *, len(m[2]) >= 2 and len(list_filter(m[2], lambda x: not {_CELL.format("x")})) = 0 as has_rule, list_filter(range(1, len(m[1]) + 1), lambda i: regexp_matches(m[1][i], '(?i)^col\d+$')) as pl from m),
 g as (select *, list_transform(pl, lambda i: case when m[3][i] <> '' then m[3][i] else m[1][i] end) as put from n)
 select chunk_id, cast(len(m) as integer) as n_rows, cast(list_max(list_transform(m, lambda r: len(r))) as integer) as n_columns,
 array_to_string(list_transform(m, lambda r: '|' || array_to_string(r, '|') || '|'), chr(10)) as rebuilt, has_rule,
 case when has_rule and len(m[3]) = len(m[1]) and len(put) > 0 and not (len(put) >= 2 and len(list_distinct(put)) = 1)
  then array_to_string(list_concat(['|' || array_to_string(list_transform(range(1, len(m[1]) + 1), lambda i: case when list_contains(pl, i) and m[3][i] <> '' then m[3][i] else m[1][i] end), '|') || '|', '|' || array_to_string(m[2], '|') || '|'],
   list_transform(m[4:], lambda r: '|' || array_to_string(r, '|') || '|')), chr(10)) else t end as promoted from g""",
    "document_profiles": rf"""with one as (select source_id, page, max(length(regexp_replace(coalesce(text, ''), '^{_WS}+|{_WS}+$', '', 'g'))) as chars from pages where source_id is not null group by 1, 2),
 p as (select source_id, count(page) as n, coalesce(avg(case when page <= 5 then chars end), 0.0) as r from one group by 1),
 g as (select distinct source_id, file_path, e from ({_POLICY}) where {_VALID})
 select g.source_id, e as extension, e in ('jpg', 'jpeg', 'png', 'bmp', 'tiff', 'tif') as is_image, e = 'pdf' as is_pdf, e in ('docx', 'doc', 'rtf', 'xls', 'xlsx', 'txt', 'csv') as is_office,
 case when e = 'pdf' then coalesce(n, 0) else 1 end as page_count, round(case when e = 'pdf' then coalesce(r, 0.0) else 0.0 end, 6) as text_ratio,
 e in ('docx', 'doc', 'rtf', 'xls', 'xlsx', 'txt', 'csv') or (e = 'pdf' and coalesce(r, 0.0) > 50) as has_text_layer from g left join p on p.source_id = g.source_id""",
    "parser_modes": f"select source_id, case when e = 'pdf' then 'yolo' when e = 'docx' then 'docling' else 'auto' end as mode from ({_POLICY}) where {_VALID}",
    "selected_sources": "select source_id, count(*) as n from registry where source_id is not null and not starts_with(source_id, '_') group by 1",
    "run_counters": f"""with s as (select distinct source_id from registry where {_VALID}), m as (select source_id, bool_or(status in ('ok', 'empty')) as done from manifests where source_id is not null group by 1)
 select count(*) as total, count(*) filter (m.done) as processed, count(*) filter (not m.done) as failed, count(*) filter (m.source_id is null) as skipped from s left join m on m.source_id = s.source_id""",
    "converter_failures": "select source_id, finished_at, page_count, 'no_pages' as reason from manifests where coalesce(page_count, 0) < 1",
    "envelopes": rf"""with c as (select chunk_id, any_value(doc_id) as doc_id, any_value(page) as page, any_value(block_type) as b, any_value(section_title) as s, any_value(text) as text from structural_chunks where doc_id is not null group by chunk_id),
 k as (select doc_id, count(*) as n, md5(string_agg(concat_ws('|', chunk_id, b, s, text), chr(10) order by page, cast(regexp_extract(chunk_id, ':b(\d+)$', 1) as integer), chunk_id)) as body from c group by 1),
 f as (select source_id, min(case when trim(file_path) <> '' then file_path end) as file_path from registry group by 1), g as (select f.*, {_EXT} as e from f)
 select k.doc_id as source_id, regexp_extract(file_path, '([^/\\]*)$', 1) as filename,
 case when g.source_id is null then 'heavy' when e in ('xls', 'xlsx', 'csv') then 'native_table' when e = 'txt' then 'native_txt_api' else 'heavy' end as route, cast(n as integer) as n_chunks, body from k left join g on g.source_id = k.doc_id""",
    "cleaned_pages": rf"""with p as (select page_id, {clean("translate(text, chr(61623) || chr(61607), '••')")} as t from pages)
 select page_id, array_to_string(list_transform(string_split(t, ' '), lambda s: {mended("s")}), ' ') as text from p""",
    "native_pages": rf"""with p as (select page_id, parser, text as native, case when page_id % 2 = 0 then regexp_replace(text, '[аеёиоуыэюя]', '', 'g') else text end as text, len(string_split(text, ' ')) as k from pages),
 n as (select *, regexp_replace(regexp_replace(regexp_replace(native, '[\x{{FFFD}}\x00-\x08\x0B-\x1F\x7F]', ' ', 'g'), '[ \t]{{2,}}', ' ', 'g'), '^{_WS}+|{_WS}+$', '', 'g') as n0 from p),
 m as (select *, array_to_string(list_transform({_WORDS_OF}, lambda s: {mended("s")}), '') as nt from n),
 r as (select *, {reads("coalesce(text, '')", "c", "w")}, {reads("coalesce(nt, '')", "nc", "nw")} from m),
 u as (select *, coalesce(parser = 'yolo_doctr' and k > 30 and (c < 0.35 or w > 0.55) and length(nt) > 200 and nc >= c and nw <= w, false) as used_native from r)
 select page_id, case when used_native then nt else text end as text, used_native from u""",
    "source_profiles": rf"""with one as (select source_id, page, max(length(regexp_replace(coalesce(text, ''), '^{_WS}+|{_WS}+$', '', 'g'))) as chars from pages where source_id is not null group by 1, 2),
 p as (select source_id, count(page) as page_count, coalesce(avg(case when page <= 5 then chars end), 0.0) as r from one group by 1)
 select source_id, page_count, round(r, 6) as text_ratio, r > 50 as has_text_layer from p""",
    "mojibake_tokens": rf"""with t as (select unnest(regexp_split_to_array(text, '[ \n\t]+')) as token from pages where text is not null),
 m as (select token, count(*) as n, translate(token, '{_LATIN}', '{_CP1251}') as fixed from t where not regexp_matches(token, '[Ѐ-ӿ]') and regexp_matches(token, '[À-ÿ]') group by 1)
 select token, case when not regexp_matches(token, '[^\x00-\x{{ff}}]') and not contains(token, chr(152)) and regexp_matches(fixed, '[Ѐ-ӿ]') then fixed else token end as repaired, n from m""",
    "item_pages": _C
    + rf""", t as (select doc_id as source_id, page, cast(regexp_extract(chunk_id, ':b(\d+)$', 1) as integer) as idx, array_to_string({ls("replace(text, chr(65533), ' ')")}, chr(10)) as text from c where coalesce(block_type, '') <> 'header')
 select source_id, page, string_agg(text, chr(10) || chr(10) order by idx) as text from t where text <> '' group by 1, 2""",
    "registry_valid": f"select source_id, file_path, format from registry where {_VALID}",
    "format_policy": f"""select source_id, {_PREP} not in ('convert_binary_doc_to_docx_or_pdf_via_word_or_libreoffice_then_update_registry', 'ocr_pipeline_not_in_current_ingest') as ingest_as_in_registry,
 cast(case {_PREP} when 'export_pdf_from_word_set_registry_to_pdf_for_page_critical_qa' then ['keep_docx_use_chunk_id_and_citation_only', 'run_link_qa_to_chunks_with_strategy_page_then_global']
  when 'convert_binary_doc_to_docx_or_pdf_via_word_or_libreoffice_then_update_registry' then ['libreoffice_headless_convert_if_installed']
  when 'export_pdf_from_word_set_registry_to_pdf_same_as_docx_policy' then ['keep_rtf_temporary_only_use_page_1_and_chunk_id_and_page_then_global_linking']
  when 'dedicated_table_ingest_future_not_pdf_print' then ['export_csv_per_sheet_for_prototype'] else [] end as varchar[]) as alternatives, e as extension, case when f <> '' then f when e <> '' then e else 'unknown' end as format_normalized, {_PREP} as recommended_preprocessing,
 case {_PREP} when 'none' then 'pdf_print_pages_match_pymupdf_index_usually' when 'export_pdf_from_word_set_registry_to_pdf_for_page_critical_qa' then 'pymupdf_docx_page_index_may_differ_from_word_status_bar'
  when 'convert_binary_doc_to_docx_or_pdf_via_word_or_libreoffice_then_update_registry' then 'n_a_until_converted'
  when 'export_pdf_from_word_set_registry_to_pdf_same_as_docx_policy' then 'single_pseudo_page_if_no_form_feed_split_breaks_search_and_golden_pages'
  when 'none_plain_text_chunking' then 'no_print_pages_use_chunk_or_line_offset' when 'dedicated_table_ingest_future_not_pdf_print' then 'sheet_row_range_not_print_page'
  when 'ocr_pipeline_not_in_current_ingest' then 'image_one_file_or_multipage_tiff' else 'unknown' end as page_semantics,
 e <> 'pdf' and f <> 'pdf' and (f in ('doc', 'docx', 'rtf') or e in ('doc', 'docx', 'rtf')) as optional_pdf_conversion from ({_POLICY})""",
    "policy_counts": f"select {_PREP} as recommended_preprocessing, count(*) as n from (select * from ({_POLICY}) where {_VALID}) group by 1",
    "route_decision": f"""select source_id, e as extension, case when e in ('xls', 'xlsx', 'txt', 'csv') then 'light' else 'heavy' end as route,
 case when e in ('xls', 'xlsx', 'csv') then 'native_table' when e = 'txt' then 'native_txt_api' else 'heavy' end as service_route,
 case when e in ('xls', 'xlsx', 'csv') then 'native_table' when e = 'txt' then 'native_txt_api' when e in ('docx', 'rtf') then 'native_office_api' when e = 'doc' then null else 'heavy' end as service_route_bare
 from ({_POLICY}) where {_VALID}""",
    "resume_pending": f"""select distinct source_id, file_path, format from ({_POLICY}) where {_VALID} and f in ('pdf', 'docx', 'doc', 'rtf', 'xls', 'xlsx', 'txt', 'csv', 'jpg', 'jpeg', 'png', 'bmp', 'tiff', 'tif')
 and source_id not in (select source_id from manifests where status in ('ok', 'empty') and source_id is not null)""",
    "latest_manifests": """select source_id, status, page_count, finished_at from (select *, row_number() over (partition by source_id order by (status in ('ok', 'empty')) desc, finished_at desc) as i
 from (select distinct source_id, status, page_count, finished_at from manifests)) where i = 1""",
    "patched_manifests": """select m.source_id, m.status, coalesce(p.n, m.page_count) as page_count from manifests m
 left join (select source_id, cast(count(distinct page) as integer) as n from pages where source_id is not null group by 1) p on p.source_id = m.source_id""",
    "document_list": "select distinct doc_id from structural_chunks where doc_id is not null",
    "clean_up": "select count(distinct doc_id) as n_docs, count(*) as n_chunks from structural_chunks where not starts_with(doc_id, 'API-')",
    "response_sizes": r"""select doc_id, cast(count(*) as integer) as n_chunks, arg_min(chunk_id, o) as first_chunk, arg_max(chunk_id, o) as last_chunk
 from (select distinct doc_id, chunk_id, page * 1000000 + cast(regexp_extract(chunk_id, ':b(\d+)$', 1) as bigint) as o from structural_chunks) group by 1""",
    "entity_list": _C + "," + ",\n".join(
        rf""" e{k} as (select chunk_id, text, {k} as rule, '{kind}' as type, {form.format(f"unnest(list_transform(regexp_extract_all(text, '{pattern}', 0), lambda s: {_inner(pattern)}))")} as value,
  unnest(range(1, len(regexp_extract_all(text, '{pattern}', 0)) + 1)) as k from c)""" for k, (kind, form, pattern) in enumerate(_ENTITIES))
    + " select chunk_id, cast(row_number() over (partition by chunk_id order by rule, k) - 1 as integer) as i, type, value from (" + " union all ".join(f"select chunk_id, rule, type, value, k from e{k}" for k in range(len(_ENTITIES))) + ")",
    "line_keys": _BASE + r""" select chunk_id, cast(n as integer) as n_lines, lower(regexp_replace(l[1], '\s+', ' ', 'g')) as first_key, lower(regexp_replace(l[-1], '\s+', ' ', 'g')) as last_key from b join q using (chunk_id)""".replace("from b join q using (chunk_id)", "from q"),
    "predicates": _BASE
    + rf""" select chunk_id, d_end as dangling_end, d_start as dangling_start,
 t in ('', '[Таблица]') or (not (starts_with(t, '#') or starts_with(t, '[Таблица]') or formula or regexp_matches(t, '^[(\[]?\d+(?:\.\d+)*[)\]]?$')) and len(regexp_extract_all(t, '\S+')) <= 2) as micro, formula,
 len({ls(r"regexp_replace(t, '(?i)^\s*\[таблица\]\s*\n?', '')")}) > 0 and len(list_filter({ls(r"regexp_replace(t, '(?i)^\s*\[таблица\]\s*\n?', '')")}, lambda s: not (starts_with(s, '|') and length(s) - length(replace(s, '|', '')) >= 2))) = 0 as table_fragment,
 n >= 2 and p >= greatest(2, floor(n * 0.55)) as table_block, starts_with(lower(t), '[таблица]') or (n >= 2 and p >= greatest(2, floor(n * 0.55))) as keeps_lines from d""",
    "headers": _BASE + " select chunk_id, header as is_header, cast(level as integer) as level from hd",
    "classified": _BASE
    + rf""" select chunk_id, kind[1] as block_type, case when kind[1] = 'header' then cast(level as integer) end as block_level, cast(kind[2] as double) as confidence,
 d_start as is_continuation, d_end or regexp_matches(t, '[а-яА-ЯёЁa-zA-Z]-\s*$') as is_truncated,
 cast(kind[2] as double) < 0.75 or d_end or regexp_matches(t, '[а-яА-ЯёЁa-zA-Z]-\s*$') or (regexp_matches(t, '(?i)собрание законодательства российской федерации') and regexp_matches(t, '(?i)(^|[^\p{{L}}\p{{N}}_])с\.\s*N([^\p{{L}}\p{{N}}_]|$)'))
  or (kind[1] = 'header' and point) as needs_review from w""",
    "readability": _C
    + r""" select chunk_id, round(case when len(regexp_extract_all(text, '[а-яА-ЯёЁa-zA-Z]')) = 0 then 0.0 else len(regexp_extract_all(text, '[а-яА-ЯёЁ]')) * 1.0 / len(regexp_extract_all(text, '[а-яА-ЯёЁa-zA-Z]')) end, 6) as cyr_ratio,
 round(case when len(regexp_extract_all(text, '[а-яА-ЯёЁa-zA-Z]')) = 0 then 1.0 else len(list_filter(list_transform(regexp_extract_all(text, '\S+'), lambda s: regexp_replace(s, '[^\p{L}\p{N}_]', '', 'g')), lambda s: length(s) >= 4 and not regexp_matches(s, '[аеёиоуыэюяAEIOUYaeiouy]'))) * 1.0 / greatest(len(regexp_extract_all(text, '\S+')), 1) end, 6) as weird_ratio from c""",
    "section_links": _C
    + rf""", o as (select *, cast(regexp_extract(chunk_id, ':b(\d+)$', 1) as integer) as idx, {st(r"regexp_replace(text, '\s+', ' ', 'g')")} as own from c),
 x as (select *, last_value(case when block_type = 'header' then chunk_id end ignore nulls) over (partition by doc_id order by page, idx, chunk_id rows between unbounded preceding and 1 preceding) as header_id,
  last_value(case when block_type = 'header' then own end ignore nulls) over (partition by doc_id order by page, idx, chunk_id rows between unbounded preceding and current row) as title from o)
 select chunk_id, coalesce(title, '') as title, header_id from x""",
    "word_boxes": f"""with b as ({_BOXES}), w as ({_WORDS}),
 hit as (select w.page, w.word_ord, b.box_ord, row_number() over (partition by w.page, w.word_ord order by b.label = 'isolate_formula', greatest(1, (x2 - x1) * (y2 - y1)), b.box_ord) as i
  from w join b on b.page = w.page and cx between x1 and x2 and cy between y1 and y2)
 select w.page, w.word_ord, hit.box_ord from w left join hit on hit.page = w.page and hit.word_ord = w.word_ord and i = 1""",
    "free_words": f"""with b as ({_BOXES}), w as ({_WORDS}) select page, word_ord from w
 where not exists (select 1 from b where b.page = w.page and label = 'isolate_formula' and cx between x1 and x2 and cy between y1 and y2)""",
    "box_pairs": f"""with b as ({_BOXES}), p as (select a.page, a.box_ord as a, b.box_ord as b, greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1)) as s,
  greatest(1, (a.x2 - a.x1) * (a.y2 - a.y1)) as aa, greatest(1, (b.x2 - b.x1) * (b.y2 - b.y1)) as ab from b a join b on a.page = b.page and a.box_ord < b.box_ord)
 select page, a, b, round(s * 1.0 / greatest(1, aa + ab - s), 6) as iou, round(s * 1.0 / aa, 6) as a_in_b, round(s * 1.0 / ab, 6) as b_in_a from p where s > 0""",
    "unique_formulas": f"""with recursive b as (select *, l_discount_10 as conf, row_number() over (order by page, box_ord, x1, y1, x2, y2, l_discount_10, label) as id from ({_BOXES_CONF})),
 f as (select *, greatest(1, (x2 - x1) * (y2 - y1)) as size, cast(row_number() over (partition by page order by conf desc, box_ord, x1, y1, x2, y2) as integer) as i from b where label = 'isolate_formula'),
 hit as (select p.page, p.i as first, q.i as later from f p join f q on p.page = q.page and p.i < q.i,
   lateral (select greatest(0, least(p.x2, q.x2) - greatest(p.x1, q.x1)) * greatest(0, least(p.y2, q.y2) - greatest(p.y1, q.y1)) as s) o
   where s > 0 and (s * 1.0 / (p.size + q.size - s) >= 0.45 or s * 1.0 / least(p.size, q.size) >= 0.82)),
 w as (select page, cast(1 as integer) as i, cast([1] as integer[]) as kept, (select max(i) from f) as most from (select distinct page from f)
   union all select w.page, w.i + 1, case when exists (select 1 from hit h where h.page = w.page and h.later = w.i + 1 and list_contains(w.kept, h.first)) or not exists (select 1 from f where f.page = w.page and f.i = w.i + 1) then w.kept else list_append(w.kept, w.i + 1) end, most from w where w.i < most),
 k as (select page, arg_max(kept, i) as kept from w group by 1)
 select b.page, b.box_ord, b.label from b left join f on f.id = b.id left join k on k.page = b.page
 where (f.i is null or list_contains(k.kept, f.i)) and (b.conf >= 0.25 or b.label in ('table', 'isolate_formula'))""",
    "reading_order": f"""with b as ({_BOXES}), m as (select *, (x1 + x2) / 2.0 as c, count(*) over (partition by page) as n from b),
 t as (select *, n >= 6 and sum(case when c < cast(800 as double) * cast(0.42 as double) then 1 else 0 end) over (partition by page) >= greatest(3, floor(n * 0.22)) and sum(case when c > cast(800 as double) * cast(0.58 as double) then 1 else 0 end) over (partition by page) >= greatest(3, floor(n * 0.22)) as two_columns from m)
 select page, box_ord, two_columns, cast(row_number() over (partition by page order by case when two_columns and c >= 400 then 1 else 0 end, y1, x1, box_ord) as integer) as position from t""",
    "line_gaps": f"""with w as ({_WORDS}), y as (select distinct page, round(cy, 1) as y from w), s as (select page, lead(y) over (partition by page order by y) - y as step from y),
 r as (select page, step, row_number() over (partition by page order by step) - 1 as i, count(*) over (partition by page) as n from s where step > 0.5)
 select p.page, cast(case when r.step is null then 10 else greatest(7, least(26, floor(r.step * 0.55))) end as integer) as gap from (select distinct page from y) p left join r on r.page = p.page and r.i = floor(r.n / 4)""",
    "orientations": """with s as (select cast(l_suppkey % 500 as integer) as page, cast(l_linenumber % 4 * 90 as integer) as angle, sum(length('t' || l_partkey) * (l_quantity / case when l_suppkey % 3 = 0 then 100 else 50 end) * case when l_linenumber % 4 in (2, 3) then 0.95 else 1.0 end) as score
  from lineitem where l_quantity / case when l_suppkey % 3 = 0 then 100 else 50 end > 0.4 group by 1, 2)
 select page, angle, round(score, 4) as score from (select *, row_number() over (partition by page order by score desc, angle) as i from s) where i = 1""",
    "unreadable_pages": f"{_UNREADABLE} select page, n, round(share, 6) as share from u",
    "readable_pages": f"""{_UNREADABLE} select t.page, case when any_value(u.page) is not null then '{UNREADABLE}' else min(t.text) || ' ' || max(t.text) end as text
 from (select cast(l_suppkey % 500 as integer) as page, 't' || l_partkey as text from lineitem) t left join u on u.page = t.page group by 1""",
    "formula_scales": f"""with b as ({_BOXES}), p as (select page, box_ord, x1 * 300 / 72.0 as x1, y1 * 300 / 72.0 as y1, x2 * 300 / 72.0 as x2, y2 * 300 / 72.0 as y2 from b where label = 'isolate_formula'),
 c as (select *, least(4.0, greatest(1.0, 512.0 / greatest(least(x2 - x1, y2 - y1), 1.0))) as s from p)
 select page, box_ord, round(cast(x1 as double), 4) as x1, round(cast(y1 as double), 4) as y1, round(cast(x2 as double), 4) as x2, round(cast(y2 as double), 4) as y2, round(cast(case when s <= 1.001 then 1.0 else s end as double), 4) as scale from c""",
    "skews": """select cast(l_suppkey % 500 as integer) as page, median(l_quantity % 40 - 18) as skew from lineitem where abs(l_quantity % 40 - 18) < 15 and l_quantity % 40 - 18 <> 0 group by 1 having abs(median(l_quantity % 40 - 18)) > 0.5""",
    "sheet_pages": r"""with i as (select 'ORD-' || l_orderkey as source_id, ascii(l_returnflag) as sheet_idx, l_returnflag as sheet, l_linenumber as r, '| ' || l_partkey || ' | ' || cast(l_quantity as integer) || ' | ' || l_linestatus || '\|' || l_returnflag || ' |' as line from lineitem where l_orderkey is not null)
 select source_id, cast(row_number() over (partition by source_id order by sheet_idx) as integer) as page, '# Лист: ' || sheet || chr(10) || chr(10) || '[Таблица]' || chr(10) || '| part | quantity | status |' || chr(10) || '| --- | --- | --- |' || chr(10) || string_agg(line, chr(10) order by r, line) as text
 from i group by source_id, sheet_idx, sheet""",
    "normalize_text": _C
    + rf""" select chunk_id, regexp_replace(regexp_replace(text, '(?m)^(\d{{1,3}}),\s+([а-яА-ЯёЁa-zA-Z])', '\1. \2', 'g'), '\s+([,.;:])', '\1', 'g') as normal,
 {st(r"regexp_replace(text, '\n{3,}', chr(10) || chr(10), 'g')")} as collapsed, regexp_replace(text, '\*\*([^*]*)\*\*', '\1', 'g') as unbold from c""",
}
