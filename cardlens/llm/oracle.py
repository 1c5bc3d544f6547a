"""DuckDB SQL twins of the operators that SQL can express."""

from __future__ import annotations

from .chat_format import Template
from .license_rules import CONFIDENCE, build_rules
from .mixing import CELL_ROWS, MAX_REPEATS  # noqa: F401
from .queries import MIX_WEIGHTS, PROBE_CONVERSATION, URL_RULES

ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACE_WORD = r"[^\x20\x09-\x0D]+"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def license_sql() -> str:
    rows = ",\n".join(
        f"({i}, [{', '.join(_text(k) for k in r.keywords)}], {_text(r.pattern)}, {_text(r.label)}, {r.priority}, "
        f"{str(r.base).lower()}, {CONFIDENCE[r.priority]}::double)" for i, r in enumerate(build_rules()))
    spaces = "len({0}) - len(replace({0}, ' ', ''))"
    return f"""
with rules(place, keywords, pattern, label, priority, base, confidence) as (values {rows}),
docs as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as text,
         ' ' || array_to_string(regexp_extract_all({ASCII_LOWER.format("coalesce(text, '')")}, {_text(LICENSE_WORD)}), '  ')
             || ' ' as canon,
         len(regexp_extract_all({ASCII_LOWER.format("coalesce(text, '')")}, {_text(LICENSE_WORD)})) as n_words
  from documents),
tried as (
  select rid, rules.*, string_split_regex(canon, pattern) as pieces, regexp_extract_all(canon, pattern) as hits
  from docs join rules on regexp_matches(canon, pattern)
  where len(list_filter(keywords, lambda k: not contains(lower(text), k))) = 0),
hit as (
  select rid, place, label, priority, base, confidence, unnest(range(1, len(hits) + 1)) as i, pieces, hits from tried),
counted as (
  select rid, place, label, priority, base, confidence, i,
         {spaces.format("pieces[i]")} as before, {spaces.format("hits[i]")} as inside from hit),
placed as (
  select rid, place, label, priority, base, confidence,
         ((sum(before + inside) over (partition by rid, place order by i)) - inside)::bigint // 2 as start,
         (sum(before + inside) over (partition by rid, place order by i))::bigint // 2 as stop
  from counted),
kept as (
  select * from placed d where not exists (
    select 1 from placed e where e.rid = d.rid and e.start <= d.start and e.stop >= d.stop and e.priority <= d.priority
      and (e.start < d.start or e.stop > d.stop or e.priority < d.priority or e.place < d.place))),
based as (
  select rid, count(*) as n_base, min(start) as first_word, max(start) as last_word,
         string_agg(distinct label, ',' order by label) as base_labels from placed where base group by rid),
labelled as (
  select rid, string_agg(distinct label, ',' order by label) as labels
  from (select rid, label from placed where base union all select rid, label from kept) group by rid),
scored as (select rid, max(confidence) as score from kept group by rid)
select doc_id, n_words::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word,
       last_word::bigint as last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
       coalesce(score, 0.0)::double as score
from docs left join based using (rid) left join labelled using (rid) left join scored using (rid)
"""


def mixing_sql() -> str:
    weights = ", ".join(str(w) for w in MIX_WEIGHTS)
    hexnum = "('0x' || substr({}, 1, {}))::bigint"
    return f"""
with docs as (
  select row_number() over () as rid, doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_text(SPACE_WORD)}))::bigint as size
  from documents),
sources as (
  select source, sum(size)::bigint as source_size, {MAX_REPEATS} * sum(size)::bigint as cap,
         [{weights}][((row_number() over (order by source nulls last) - 1) % {len(MIX_WEIGHTS)} + 1)::int] as weight
  from docs group by source),
filled as (
  select *, ((sum(source_size) over ()) - coalesce(sum(cap) over (f rows between unbounded preceding and 1 preceding), 0))::double
          / ((sum(weight) over ()) - coalesce(sum(weight) over (f rows between unbounded preceding and 1 preceding), 0))::double as level
  from sources window f as (order by cap::double / weight, source_size)),
level as (select arg_min(level, cap::double / weight) as level from filled where level <= cap::double / weight),
targets as (
  select source, source_size, coalesce(least(cap::double, (select level from level) * weight), 0.0) as target,
         case when source_size > 0 then coalesce(least(cap::double, (select level from level) * weight), 0.0) / source_size else 0.0 end as rate,
         {hexnum.format("md5('0:' || coalesce(source, ''))", 5)} / 1048576.0::double as shift
  from sources),
placed as (
  select doc_id, source, size,
         row_number() over (partition by source order by size, md5(coalesce(doc_id::varchar, '')), doc_id nulls first) - 1 as place
  from docs)
select doc_id, size, source_size, target, (floor((place + 1) * rate + shift) - floor(place * rate + shift))::bigint * size as taken,
       placed.source, (floor((place + 1) * rate + shift) - floor(place * rate + shift))::bigint as copies
from placed join targets on placed.source is not distinct from targets.source
"""


def url_sql() -> str:
    rules = ", ".join(f"({_text(h)}, {_text(p)}, {_text(v)})" for h, p, v in URL_RULES)
    return f"""
with rules(rhost, rpath, verdict) as (values {rules}),
cut as (
  select page_id, url, case when contains(url, '://') then regexp_extract(substr(url, strpos(url, '://') + 3), '(?s)^[^?#]*') else '' end as rest
  from pages),
parts as (
  select row_number() over () as rid, page_id, {ASCII_LOWER.format("regexp_extract(coalesce(rest, ''), '(?s)^[^/]*')")} as host,
         regexp_extract(coalesce(rest, ''), '(?s)^[^/]*(.*)$', 1) as path from cut),
best as (
  select rid, arg_max(rhost || rpath, (len(rhost || rpath), verdict)) as rule, arg_max(verdict, (len(rhost || rpath), verdict)) as verdict
  from parts join rules on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath) group by rid)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from parts left join best using (rid)
"""


def chat_sql() -> str:
    t = Template()
    probe = ", ".join(f"({c}, {n}, {_text(r)}, {_text(x)})" for c, n, r, x in PROBE_CONVERSATION)
    specials = lambda col, chars: " + ".join(
        f"(len({col}) - len(replace({col}, {_text(c)}, '')))" for c in t.escapes if c in chars)
    label = "case role " + " ".join(f"when {_text(r)} then {len(n)}" for r, n in t.labels.items()) + \
        f" else 2 + len(role) + {specials('role', ''.join(t.escapes))} end"
    fixed = len(t.open) + len(t.role_end) + len(t.close)
    states = " ".join(f"when {_text(a)} || '|' || {_text(b)} then {_text(c)}" for (a, b), c in t.transitions.items())
    step = f"coalesce(case state || '|' || role {states} end, 'error')"
    return f"""
with recursive turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select * from (values {probe}) p(conv_id, turn, role, text)),
ordered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i,
         count(*) over (partition by conv_id) as n from turns),
walk as (
  select conv_id, i, n, (select {step} from (select 'start' as state, o.role as role)) as state from ordered o where i = 1
  union all
  select o.conv_id, o.i, o.n, (select {step} from (select w.state as state, o.role as role))
  from walk w join ordered o on o.conv_id is not distinct from w.conv_id and o.i = w.i + 1),
judged as (
  select conv_id, min(i) filter (state = 'error') - 1 as bad, arg_max(state, i) in ({", ".join(_text(f) for f in t.final)}) as ends, max(n) as n
  from walk group by conv_id)
select o.conv_id, count(*)::bigint as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256,
       coalesce(sum(len(text)) filter (role in ({", ".join(_text(r) for r in t.loss_roles)})), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by i) filter (role in ({", ".join(_text(r) for r in t.loss_roles)})), '')) as loss_sha256,
       sum({fixed} + {label} + len(text) + {specials("text", "".join(c for c in t.escapes if c != ":"))})::bigint as formatted_chars,
       any_value(case when bad is not null then false else ends end) as valid,
       coalesce(any_value(case when bad is not null then bad when not ends then j.n end), -1)::bigint as error_turn
from ordered o join judged j on o.conv_id is not distinct from j.conv_id group by o.conv_id
"""


# crc32 of an ASCII string by its table of 256 entries
_CRC_TABLE = """(select list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
  lambda v, i: case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end)) as crc_table)"""


def _crc32(text: str) -> str:
    return f"""xor(list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda x: ascii(x)::bigint)),
  lambda v, b: xor(v >> 8, crc_table[(xor(v, b) & 255) + 1])), 4294967295)"""


def repair_sql() -> str:
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    starts = ("''", "chr(10)", "chr(10)", "chr(10)")

    def path(state: int, edits: list) -> str:
        """State's path with edits (cost, initial, repaired row or null) behind it."""
        cost = " + ".join([f"s{state}.c", *(str(c) for c, _, _ in edits)])
        rows = "".join(f" || {starts[state] if i == 0 else 'chr(10)'} || {r}" for i, r in enumerate(r for _, _, r in edits if r))
        return f"case when s{state} is not null then {{'c': {cost}, 'a': s{state}.a || '{''.join(e for _, e, _ in edits)}', 'r': s{state}.r{rows}}} end"

    user, assistant = "'user:'", "'assistant:'"

    def best(state: int, *paths: str) -> str:
        return f"list_min([{', '.join(paths)}]) as s{state}"

    def bridges() -> str:
        i_user, i_assistant = (2, "I", user), (2, "I", assistant)
        return ", ".join(["s0", "s1", best(2, "s2", path(0, [i_user]), path(1, [i_user]), path(3, [i_user])),
                          best(3, "s3", path(2, [i_assistant]), path(0, [i_user, i_assistant]), path(1, [i_user, i_assistant]))])

    delete = (3, "D", None)
    keep = lambda initial, state: f"case when not gone and left(role, 1) = '{initial}' then {path(state, [('cut', 'K', own)])} end"
    rerole = lambda name, state: f"case when not gone then {path(state, [('2 + cut', 'R', f'{name} || body')])} end"
    own = "role || ':' || body"
    step = ", ".join([
        best(0, path(0, [delete])),
        best(1, path(1, [delete]), keep("s", 0)),
        best(2, path(2, [delete]), *[f(x, q) for q in (0, 1, 3) for f, x in ((keep, "u"), (rerole, user))]),
        best(3, path(3, [delete]), keep("a", 2), rerole(assistant, 2))])
    empty = "{'c': 0, 'a': '', 'r': ''}"
    none = "null::struct(c integer, a varchar, r varchar)"
    return f"""
with recursive crc as {_CRC_TABLE},
coded as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         {_crc32("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as kind
  from conversations, crc),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
         case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from coded, (select unnest([1, 2]) as copy) where kind <> 0 and (copy = 1 or kind = 3)),
seen as (
  select *, row_number() over (partition by conv_id, role, text order by turn nulls first) > 1 as again, rtrim(text, {white}) as trimmed
  from damaged),
placed as (
  select conv_id, turn, role, text as body, trimmed = '' as blank, trimmed <> '' and again as repeated,
         trimmed <> '' and not again and right(trimmed, 1) not in ('.', '!', '?') as truncated,
         row_number() over w as i, lag(left(role, 1)) over w || left(role, 1) not in ('su', 'ua', 'au') as illegal
  from seen window w as (partition by conv_id order by turn nulls first, role, text, again)),
judged as (select *, blank or repeated as gone, truncated::integer as cut from placed),
counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank,
         count(*) filter (repeated) as duplicate, count(*) filter (truncated) as truncated, count(*) filter (illegal) as illegal, max(i) as n
  from judged group by conv_id),
walk as (
  select conv_id, 0::bigint as i, {bridges()}
  from (select distinct conv_id, {empty}::struct(c integer, a varchar, r varchar) as s0, {none} as s1, {none} as s2, {none} as s3 from conversations)
  union all
  select conv_id, i, {bridges()}
  from (select walk.conv_id, judged.i, {step} from walk join judged on judged.conv_id is not distinct from walk.conv_id and judged.i = walk.i + 1)),
ended as (
  select walk.conv_id, list_min([s0, s3]) as best from walk left join counted on counted.conv_id is not distinct from walk.conv_id
  where i = coalesce(n, 0))
select ended.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
       coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, best.c::bigint as cost, best.a as audit,
       sha256(best.r) as repaired_sha256
from ended left join counted on counted.conv_id is not distinct from ended.conv_id
"""


def trie_sql() -> str:
    return f"""
with crc as {_CRC_TABLE},
ordered as (
  select conv_id, md5(coalesce(role, '') || chr(1) || coalesce(text, '')) as h, len(coalesce(text, '')) as chars,
         row_number() over (partition by conv_id order by turn nulls first) as i
  from conversations),
own as (select conv_id, list({{'h': h, 'n': chars}} order by i) as turns from ordered group by conv_id),
plan as (
  select c.conv_id, {_crc32("c.conv_id::varchar")} % 6 as head, c.turns as own, coalesce(b.turns, []) as base
  from crc, own c left join own b on b.conv_id = c.conv_id - c.conv_id % 100),
rebuilt as (select conv_id, list_concat(base[1:head], own[head + 1:]) as turns from plan),
entries as (
  select conv_id, d as depth, array_to_string(list_transform(turns[1:d], lambda x: x.h), '') as path, d = len(turns) as ends,
         case when d = 0 then 0 else turns[d].n end as chars
  from (select conv_id, turns, unnest(range(0, len(turns) + 1)) as d from rebuilt)),
nodes as (
  select depth, path, left(path, greatest(32 * (depth - 1), 0)::bigint) as above, min(conv_id) as conv_id, count(*) as n_convs, any_value(chars) as chars,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256
  from entries group by depth, path),
children as (select depth - 1 as depth, above as path, count(*) as n from nodes where depth > 0 group by all),
whole as (select nodes.*, coalesce(children.n, 0) as n_children from nodes left join children using (depth, path)),
subtrees as (
  select a.depth, a.path, count(*) filter (b.n_children = 0) as n_leaves, sum((b.n_convs - 1) * b.chars) as saved
  from whole a join whole b on b.depth >= a.depth and left(b.path, 32 * a.depth) = a.path group by a.depth, a.path)
select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs::bigint as n_convs, n.n_children::bigint as n_children,
       n_leaves::bigint as n_leaves, saved::bigint as saved_tokens, n.ends_sha256
from whole n join subtrees s using (depth, path) left join nodes p on p.depth = n.depth - 1 and p.path = n.above
"""


def oracle_sql() -> dict:
    return {
        "op1_license_scan": license_sql(),
        "op4_mix_sources": mixing_sql(),
        "op6_url_filter": url_sql(),
        "op9_format_chats": chat_sql(),
        "op11_structure_repair": repair_sql(),
        "op12_prefix_trie": trie_sql(),
    }
