"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from tidemark.llm import licences

_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(column: str) -> str:
    return f"[x for x in string_split_regex({_LOW.format(column)}, '[\\x20\\x09-\\x0D]+') if x <> '']"


def _shingles(width: str) -> str:
    return f"list_distinct([array_to_string(w[i + 1:i + {width}], ' ') for i in range(0, len(w) - {width} + 1)])"


OP3 = f"""
with items as (
  select item_id, w, least(len(w), 5) as width from (select distinct item_id, {_words('text')} as w from benchmark) where len(w) > 0),
asked as (select item_id, width, {_shingles('width')} as shingles from items),
posted as (select item_id, width, len(shingles) as n, unnest(shingles) as s from asked),
docs as (select doc_id, {_words('text')} as w from documents),
found as (
  select distinct doc_id, width, unnest({_shingles('width')}) as s
  from docs, (select distinct width from items) where len(w) >= width)
select doc_id, item_id, n as n_shingles, count(*) as n_found, count(*) / n as containment
from found join posted using (width, s) group by doc_id, item_id, n having count(*) >= ceil(n * 0.8 - 1e-9)"""

OP4 = """
with recursive v as (
  select vec_id, label, embedding::double[] as e from embeddings
  where label is not null and len(embedding) > 0 and list_bool_and([coalesce(isfinite(x), false) for x in embedding])
    and list_bool_or([x <> 0 for x in embedding])),
links as (
  select a.vec_id as x, b.vec_id as y from v a join v b on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= 0.98),
reach as (select vec_id as x, vec_id as y from embeddings union select r.x, l.y from reach r join links l on r.y = l.x),
low as (select x, min(y) as component_id from reach group by x),
n as (select x, count(*) as n_links from links group by x)
select vec_id, coalesce(n_links, 0) as n_links, component_id, vec_id = component_id as kept
from embeddings join low on low.x = vec_id left join n on n.x = vec_id"""

OP5 = f"""
with recursive docs as (select doc_id, {_words('text')} as w from documents),
sets as (select doc_id, case when len(w) = 0 then [] else {_shingles('least(4, len(w))')} end as s from docs),
sizes as (select doc_id, len(s) as n from sets),
posted as (select doc_id, unnest(s) as g from sets),
common as (select a.doc_id as x, b.doc_id as y, count(*) as c from posted a join posted b using (g) where a.doc_id < b.doc_id group by all),
links as (
  select x, y from common join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * c >= 80 * (p.n + q.n - c)),
sym as (select x, y from links union select y, x from links),
reach as (select doc_id as x, doc_id as y from docs union select r.x, b.y from reach r join sym b on r.y = b.x),
low as (select x, min(y) as component_id from reach group by x)
select doc_id, n as n_shingles, component_id, doc_id = component_id as kept from sizes join low on x = doc_id"""


def _canonical(column: str) -> str:
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"
    t = f"regexp_replace({_LOW.format(column)}, {quoted(licences.COPYRIGHT_LINE)}, ' ', 'g')"
    t = f"regexp_replace(concat(' ', {t}, ' '), '[\\x00-\\x2F:-@\\[-`{{-\\x7F]+', ' ', 'g')"
    for pattern, repl in licences.EQUIVALENT:
        t = f"regexp_replace({t}, {quoted(pattern)}, {quoted(repl.replace('$', chr(92)))}, 'g')"
    return f"trim({t})"


def _op8() -> str:
    rows = ",\n".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in licences.KNOWN)
    return f"""
with known_texts(license_id, text) as (values {rows}),
known as (select {_canonical('text')} as c, min(license_id) as license_id from known_texts group by 1),
whole as (select doc_id, known.license_id from documents left join known on c = case when text is not null then {_canonical('text')} end),
lines as (select doc_id, unnest(string_split(text, chr(10))) as line from documents),
hits as (select doc_id, license_id from lines join known on c = {_canonical('line')}),
found as (select doc_id, count(*) as n, string_agg(distinct license_id, ',' order by license_id) as notices from hits group by doc_id)
select doc_id, license_id, coalesce(n, 0) as n_notice_lines, coalesce(notices, '') as notices
from whole left join found using (doc_id)"""


# CRC-32 of a list of bytes, with the table of the 256 remainders made by recursion (`t` holds it as a list)
_CRC_TABLE = """
crc_steps(i, v, k) as (
  select i, i, 0 from range(256) r(i)
  union all select i, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end, k + 1 from crc_steps where k < 8),
crc_table as (select list(v order by i) as t from crc_steps where k = 8)"""


def _crc(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of an SQL string, beside `t`."""
    at = f"range(0, strlen({text}))"
    byte = f"list_transform({at}, lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::bigint)"
    return (f"xor(list_reduce(list_prepend(4294967295::bigint, {byte}), "
            "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)")


OP11 = f"""
with recursive {_CRC_TABLE},
turns as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as i,
         {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} as turn
  from conversations where conv_id is not null),
seqs as (select conv_id, list(turn order by i) as s from turns group by conv_id),
ids as (select conv_id, conv_id - conv_id % 100 as base, {_crc('conv_id::varchar')} % 6 as h, s from seqs, crc_table),
rebuilt as (
  select a.conv_id, case when a.conv_id = a.base then a.s
                         else list_concat(coalesce(b.s, a.s[1:0])[1:a.h], a.s[a.h + 1:]) end as s
  from ids a left join seqs b on b.conv_id = a.base),
prefixes as (select conv_id, len(s) as size, d as depth, s[1:d] as p, s[1:d - 1] as up from rebuilt, unnest(range(0, len(s) + 1)) u(d)),
nodes as (
  select depth, p, any_value(up) as up, min(conv_id) as conv_id, count(*) as n_convs, bool_and(depth = size) as childless,
         coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where depth = size), '') as ends,
         case when depth = 0 then 0 else (count(*) - 1) * length(any_value(p[depth].text)) end as share
  from prefixes group by depth, p),
subtree as (
  select v.p, sum(u.share)::bigint as saved_tokens, count(*) filter (where u.childless) as n_leaves
  from nodes v join nodes u on u.p[1:v.depth] = v.p and u.depth >= v.depth group by v.p)
select v.conv_id, v.depth, parent.conv_id as parent_conv_id, v.n_convs,
       (select count(*) from nodes c where c.depth = v.depth + 1 and c.up = v.p) as n_children,
       n_leaves, saved_tokens, sha256(v.ends) as ends_sha256
from nodes v join subtree using (p) left join nodes parent on parent.depth = v.depth - 1 and parent.p = v.up"""

OP12 = f"""
with recursive {_CRC_TABLE},
runs as (
  select coalesce(doc_id::varchar, '') as id, {_LOW.format("unnest(regexp_extract_all(text, '[A-Za-z\\x{00C0}-\\x{00FF}]+'))")} as run from documents),
hashed as (select run, {_crc("(id || ':' || run)")} as h from runs, crc_table),
changed as (select case when h % 31 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word from hashed),
v as (select word, count(*) as n from changed where length(word) >= 7 group by word having count(*) >= 2),
holes as (select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest from v, unnest(range(1, length(word) + 1)) u(i)),
pairs as (
  select a.word as x, b.word as y, b.n as m from holes a join holes b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select a.word, b.word, b.n from holes a join v b on a.rest = b.word
  union select b.word, a.word, a.n from holes a join v b on a.rest = b.word),
best as (select x, count(*) as n_near, max(m) as m from pairs group by x),
forms as (
  select v.word, v.n, coalesce(n_near, 0) as n_near, case when b.m >= 10 * v.n then b.m end as form_n,
         (select min(y) from pairs p where p.x = v.word and p.m = b.m and b.m >= 10 * v.n) as form
  from v left join best b on b.x = v.word),
walk as (
  select word, word as root from forms where form is null
  union all select f.word, w.root from forms f join walk w on f.form = w.word)
select word, n, n_near, form, form_n, root from forms join walk using (word)"""

SQL = {"op12_spelling_variants": OP12, "op11_prefix_trie": OP11, "op3_decontamination": OP3, "op4_embedding_dedup": OP4, "op5_minhash_dedup": OP5, "op8_licences": _op8()}
