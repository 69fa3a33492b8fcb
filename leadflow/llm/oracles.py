"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from leadflow.llm.decontaminate import LEAST, NAME, UNITS, WINDOW
from leadflow.llm.licences import CONTAINS, RULES, SENTENCES

_RULES = {
    "short": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 15 * n_words",
}

_OP3 = rf"""
with texts as (
  select doc_id, source as host, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from documents),
windows as (
  select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2]) as times
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from texts)),
covered as (
  select doc_id, count(distinct j) as n_repeat_words
  from (select doc_id, unnest([i, i + 1, i + 2]) as j from windows where times > 1) group by doc_id),
counts as (
  select t.doc_id, host, cast(len(w) as bigint) as n_words,
         cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
         cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
         cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words, cast(len(l) as bigint) as n_lines
  from texts t left join covered c on t.doc_id = c.doc_id),
failed as (select *, {", ".join(f"({e}) as {r}" for r, e in _RULES.items())} from counts),
hosts as (
  select host, count(*) as n, {", ".join(f"count(*) filter ({r}) as {r}" for r in _RULES)} from failed group by host),
common as (
  select {", ".join(f"sum({r}) / sum(n) as {r}_m" for r in _RULES)}, avg(1 / n) as per_text, count(*) as k from hosts),
spread as (
  select {", ".join(f"sum(({r} / n - {r}_m) ** 2) / greatest(max(k) - 1, 1) - max({r}_m * (1 - {r}_m) * per_text) as {r}_v"
                    for r in _RULES)} from hosts, common),
strength as (
  select {", ".join(f"greatest({r}_m * (1 - {r}_m) / nullif(greatest({r}_v, {r}_m * (1 - {r}_m) / 1e6), 0) - 1, 0) as {r}_s"
                    for r in _RULES)} from common, spread),
verdicts as (
  select host, greatest({", ".join(f"case when {r}_m * (1 - {r}_m) > 0 then ({r} + {r}_s * {r}_m) / (n + {r}_s) else {r}_m end"
                                   for r in _RULES)}) > 0.5 as host_out
  from hosts, common, strength)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (short or repeats) as base_failed, host_out,
       not (short or repeats) and not host_out as kept
from failed f join verdicts v on f.host is not distinct from v.host
"""

_OP5 = """
with payloads as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages),
holders as (
  select payload_digest, max(page_id) as holder from payloads where payload_bytes >= 1000
  group by payload_digest having count(*) > 1)
select page_id, cast(payload_bytes as bigint) as payload_bytes, p.payload_digest,
       case when holder is not null and page_id is distinct from holder then 'revisit' else 'response' end as record_type,
       case when page_id is distinct from holder then holder end as refers_to
from payloads p left join holders h on p.payload_digest = h.payload_digest
"""

_ENDS = r"[.!?;:]+\s+|[.!?;:]+$"
_KNOWN = ", ".join(f"('{text}', '{key}')" for key, text in SENTENCES.items())
_SHORTER = " ".join(f"when name = '{b}' and '{a}' in (select name from found g where g.n = f.n) then false"
                    for a, b in CONTAINS.items())
_RULE_ROWS = ", ".join("('{}', '{}')".format(name, "," + ",(.*,)?".join(steps) + ",") for name, steps in RULES)

_OP4 = rf"""
with known(sentence, sid) as (values {_KNOWN}),
rules(name, pattern) as (values {_RULE_ROWS}),
texts as (select row_number() over () as n, doc_id, coalesce(text, '') as text from documents),
cut as (
  select n, 'line' as how, string_split_regex(text, '{_ENDS}|\n') as s from texts
  union all
  select n, 'paragraph', string_split_regex(regexp_replace(regexp_replace(text, '\n[ \t]*\n\s*', '. ', 'g'), '\n', ' ', 'g'),
                                            '{_ENDS}') from texts),
plain as (
  select n, how, i, trim(regexp_replace(lower(s[i]), '[^a-z0-9]+', ' ', 'g')) as sentence
  from (select n, how, s, unnest(range(1, len(s) + 1)) as i from cut)),
seen as (
  select n, how, count(*) as k, ',' || string_agg(sid, ',' order by i) || ',' as ids
  from plain join known using (sentence) group by n, how),
found as (select distinct n, name from seen, rules where regexp_matches(ids, pattern)),
kept as (select n, name from found f where case {_SHORTER} else true end),
counts as (select n, max(k) as k from seen group by n),
named as (select n, string_agg(name, ',' order by name) as licences from kept group by n)
select doc_id, cast(coalesce(k, 0) as bigint) as n_sentences, coalesce(licences, '') as licences
from texts left join counts using (n) left join named using (n)
"""

_UNIT_LIST = ", ".join(f"'{u}'" for u in UNITS)


def _templates(table: str, key: str) -> str:
    """Rows of words and template words with their positions."""
    joined = r"regexp_replace(coalesce(text, ''), '([0-9])[.,]([0-9])', '\1\2', 'g')"
    named = rf"regexp_replace({joined}, '([^.!?:\s]\s+)(\p{{Lu}})', '\1{NAME}\2', 'g')"
    words = rf"string_split(trim(regexp_replace(lower({named}), '[^\p{{L}}\p{{N}}{NAME}]+', ' ', 'g')), ' ')"
    return f"""
  select {key}, w, list_transform(w, lambda x, i: case
    when regexp_matches(x, '^[0-9]+$') then '<num>' when starts_with(x, '{NAME}') then '<name>'
    when x in ({_UNIT_LIST}) and i > 1 and regexp_matches(coalesce(w[i - 1], ''), '^[0-9]+$') then '<unit>' else x end) as t
  from (select {key}, {words} as w from {table})"""


def _window_rows(source: str, key: str) -> str:
    return f"""
  select {key}, i as at, w[i:i + {WINDOW - 1}] as w, t[i:i + {WINDOW - 1}] as t
  from (select {key}, w, t, unnest(range(1, len(t) - {WINDOW} + 2)) as i from {source})"""


_LITERAL = "len(list_filter(t, lambda x: x not in ('<num>', '<name>', '<unit>')))"
_OP8 = f"""
with docs as ({_templates("documents", "doc_id")}), items as ({_templates("benchmark", "item_id")}),
doc_windows as ({_window_rows("docs", "doc_id")}),
item_windows as (select * from ({_window_rows("items", "item_id")}) where 2 * {_LITERAL} >= {WINDOW}),
sizes as (select item_id, count(*) as size from item_windows group by item_id),
met as (
  select doc_id, item_id, b.at as of, a.at - b.at as shift, a.w as ours, b.w as theirs, a.t as t
  from doc_windows a join item_windows b on a.t = b.t),
slots as (
  select distinct doc_id, item_id, shift, t[j] as kind, theirs[j] as theirs, ours[j] as ours
  from (select *, unnest(range(1, {WINDOW + 1})) as j from met) where t[j] in ('<num>', '<name>', '<unit>')),
torn as (
  select distinct doc_id, item_id, shift from slots group by doc_id, item_id, shift, kind, theirs having count(*) > 1),
hits as (
  select doc_id, item_id, count(distinct of) as hits from met anti join torn using (doc_id, item_id, shift)
  group by doc_id, item_id),
leaks as (select doc_id, item_id, hits from hits join sizes using (item_id) where hits >= least({LEAST}, size)),
found as (
  select doc_id, string_agg(cast(item_id as varchar), ',' order by item_id) as item_ids, sum(hits) as n_windows
  from leaks group by doc_id)
select doc_id, n_windows is not null as contaminated, coalesce(item_ids, '') as item_ids,
       cast(coalesce(n_windows, 0) as bigint) as n_windows
from documents left join found using (doc_id)
"""

_OP12 = r"""
with texts as (
  select row_number() over () as d, coalesce(lang, 'und') as lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
pieces as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w
  from (select lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) as piece from texts)),
totals as (select lang, sum(len(w)) as n from pieces group by lang),
starts as (select lang, w, unnest(range(1, len(w) + 1)) as i from pieces),
grams as (
  select lang, w[i:i + m - 1] as g from (select lang, w, i, unnest(range(1, 6)) as m from starts) where i + m - 1 <= len(w)),
counts as (select lang, g, count(*) as f from grams group by lang, g having count(*) >= 100),
cuts as (
  select lang, g, f as a, unnest(range(1, len(g))) as k from counts where len(g) > 1),
scores as (
  select c.lang, c.g, c.a, c.k, l.f as l, r.f as r, n,
         cast((1000::hugeint * c.a * n) // (l.f::hugeint * r.f) as bigint) as score
  from cuts c join totals t on c.lang = t.lang join counts l on c.lang = l.lang and l.g = c.g[1:c.k]
  join counts r on c.lang = r.lang and r.g = c.g[c.k + 1:]),
lowest as (
  select * from scores qualify row_number() over (partition by lang, g order by score, k) = 1),
named as (select *, array_to_string(g, ' ') as phrase, len(g) as m from lowest),
apart as (
  select * from named s where not exists (
    select 1 from named b where b.lang = s.lang and b.m > s.m and 100 * b.a >= 100 * s.a
      and contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' ')))
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r,
       cast(n as bigint) as n, score
from apart qualify rank <= 2000
"""

_OP13 = r"""
with recursive texts as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
marks as (
  select doc_id as id, coalesce(max(cast(quality = 1 as int)), 0) as good, coalesce(max(cast(toxic = 1 as int)), 0) as toxic
  from labels where doc_id is not null group by doc_id),
flags as (
  select part, doc_id, cast(len(w) < 200 as int) + 2 * cast(100 * len(list_distinct(w)) < 50 * len(w) as int)
         + 4 * cast(100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text) as int)
         + 8 * cast(regexp_matches(text, '[#$%&*|]') as int)
         + 16 * cast(coalesce(doc_id > min(doc_id) over (partition by text), false) as int) as failed from texts),
counts as (
  select part, failed, count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic
  from flags left join marks on doc_id = id group by part, failed),
orders(filter_order) as (
  select '' union all
  select filter_order || x from orders, (values ('A'), ('B'), ('C'), ('D'), ('E')) f(x) where not contains(filter_order, x)),
steps as (
  select filter_order, step, cast(1 << (instr('ABCDE', filter_order[step]) - 1) as int) as bit,
         coalesce(list_sum(list_transform(range(1, step), lambda j: 1 << (instr('ABCDE', filter_order[j]) - 1))), 0)::int as before
  from (select filter_order, unnest(range(1, 6))::int as step from orders where length(filter_order) = 5)),
walked as (
  select part, filter_order, step, bit,
         sum(n) filter (failed & (before | bit) = 0) as kept,
         sum(n) filter (failed & bit > 0 and failed & before = 0) as removed,
         sum(n) filter (failed & bit > 0 and failed & before > 0) as redundant,
         sum(n) filter (failed = bit) as unique_fails,
         sum(good) filter (failed & bit > 0 and failed & before = 0) as good_lost,
         sum(toxic) filter (failed & bit > 0 and failed & before = 0) as toxic_lost
  from counts, steps group by part, filter_order, step, bit)
select part, filter_order, step, cast(coalesce(kept, 0) as bigint) as kept, cast(coalesce(removed, 0) as bigint) as removed,
       cast(coalesce(redundant, 0) as bigint) as redundant, cast(coalesce(unique_fails, 0) as bigint) as unique_fails,
       cast(coalesce(good_lost, 0) as bigint) as good_lost, cast(coalesce(toxic_lost, 0) as bigint) as toxic_lost,
       cast(sum(coalesce(removed, 0)) over (partition by part, bit) as bigint) as shapley
from walked
"""

ORACLE: dict[str, str] = {
    "op3_quality_rules": _OP3, "op4_license_scans": _OP4, "op5_warc": _OP5, "op8_decontamination": _OP8,
    "op12_collocations": _OP12, "op13_filter_audit": _OP13}
