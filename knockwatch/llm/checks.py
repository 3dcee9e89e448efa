"""Plain SQL that states a query's result, where SQL can."""

from __future__ import annotations

from knockwatch.llm.collocations import COVERED_PERCENT, MIN_COUNT, SCALE, TOP
from knockwatch.llm.conversation_repair import DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST
from knockwatch.llm.host_rules import MAX_HOST_RATE, RULES
from knockwatch.llm.mixing import MAX_EPOCHS
from knockwatch.llm.queries import OTHER_WEIGHT, QUERY_EVERY, WEIGHTS
from knockwatch.llm.vector_search import NEIGHBOURS

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({text}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATE = f"""
with d as (select row_number() over () as row, doc_id, {_WORDS.format(text=_LOWERED)} as w from documents),
b as (select item_id, {_WORDS.format(text=_LOWERED)} as w from benchmark),
windows as (
  select item_id, 10 as size, array_to_string(w[i:i + 9], ' ') as win
  from (select *, unnest(range(1, len(w) - 8)) as i from b where len(w) >= 10)
  union select item_id, len(w), array_to_string(w, ' ') from b where len(w) between 1 and 9),
sizes as (select distinct size from windows),
places as (
  select row, i, size, array_to_string(w[i:i + size - 1], ' ') as win
  from (select *, unnest(range(1, len(w) - size + 2)) as i from d, sizes where len(w) >= size)),
found as (select row, i, size, item_id from places join windows using (size, win)),
hit as (select row, count(distinct p) as n_hit from (select row, unnest(range(i, i + size)) as p from found) group by row),
items as (
  select row, count(distinct item_id) as n_items,
    array_to_string(list_sort(list(distinct cast(item_id as varchar))), ',') as ids
  from found group by row)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (row) left join items using (row)
"""


def _host_rules() -> str:
    names = list(RULES)
    flags = ", ".join(f"avg(case when {rule} then 1.0 else 0.0 end) as p_{n}" for n, rule in RULES.items())
    moments = ", ".join(f"avg(p_{n}) as m_{n}, var_pop(p_{n}) as v_{n}" for n in names)
    strength = ", ".join(
        f"case when v_{n} > 1e-12 and v_{n} < m_{n} * (1 - m_{n}) then m_{n} * (1 - m_{n}) / v_{n} - 1 else 1.0 end as s_{n}"
        for n in names
    )
    rates = ", ".join(f"(p_{n} * n + m_{n} * s_{n}) / (n + s_{n})" for n in names)
    return rf"""
with d as (
  select row_number() over () as row, doc_id, coalesce(source, '') as host, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents),
windows as (
  select row, i, array_to_string(w[i:i + 7], ' ') as win
  from (select row, w, unnest(range(1, len(w) - 6)) as i from d where len(w) >= 8)),
again as (
  select row, count(distinct p) as n_repeat_words
  from (select row, unnest(range(i, i + 8)) as p
        from (select row, i, count(*) over (partition by row, win) as n from windows) where n > 1)
  group by row),
counts as (
  select row, doc_id, host, len(w) as n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
    len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words
  from d left join again using (row)),
hosts as (select host, count(*) as n, {flags} from counts group by host),
prior as (select *, {strength} from (select {moments} from hosts)),
verdict as (select host, greatest({rates}) <= {MAX_HOST_RATE} as host_kept from hosts, prior)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  ({RULES["few_words"]}) or ({RULES["repeated_words"]}) as base_failed,
  not (({RULES["few_words"]}) or ({RULES["repeated_words"]})) and host_kept as kept
from counts join verdict using (host)
"""


def _weight(name: str) -> str:
    cases = " ".join(f"when '{k}' then {w}" for k, w in WEIGHTS[name].items())
    return f"case {name} {cases} else {OTHER_WEIGHT} end" if cases else str(OTHER_WEIGHT)


def _mixing() -> str:
    names = list(WEIGHTS)
    steps = [
        r"""d as (
  select *, 'd' || coalesce(cast(try_cast(regexp_extract(src, '([0-9]+)$', 1) as integer) % 4 as varchar), 'none') as domain,
    coalesce(src, '') as source
  from (select doc_id, text, source as src, coalesce(lang, '') as lang,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as tokens from documents))""",
        f"given0 as (select sum(tokens) as total from d)",
    ]
    for depth, name in enumerate(names, 1):
        path, parent = ", ".join(names[:depth]), ", ".join(names[: depth - 1])
        over = f"partition by {parent}" if parent else ""
        steps += [
            f"""level{depth} as (
  select {path}, {_weight(name)} as weight, sum(tokens) * {MAX_EPOCHS} as capacity from d group by {path})""",
            f"""filled{depth} as (
  select *, sum(capacity) over up as filled, coalesce(sum(weight) over after, 0) as others
  from level{depth} {"join given" + str(depth - 1) + f" using ({parent})" if parent else ", given0"}
  window up as ({over} order by capacity / weight::double, {name} rows unbounded preceding),
    after as ({over} order by capacity / weight::double, {name} rows between 1 following and unbounded following))""",
            f"""marked{depth} as (
  select *, capacity * (weight + others) <= (total - filled + capacity) * weight as whole from filled{depth})""",
            f"""given{depth} as (
  select {path}, case when whole then capacity else least(capacity, ((total - used) * weight) // open) end as total
  from (select *, coalesce(sum(capacity) filter (whole) over ({over}), 0) as used,
          coalesce(sum(weight) filter (not whole) over ({over}), 0) as open from marked{depth}))""",
        ]
    leaf = ", ".join(names)
    steps.append(
        f"""placed as (
  select doc_id, text, {leaf}, tokens, budget, case when leaf > 0 then budget // leaf else 0 end as epochs,
    case when leaf > 0 then budget % leaf else 0 end as rest
  from (select *, sum(tokens) over (partition by {leaf}) as leaf from d)
  join (select {leaf}, total as budget from given{len(names)}) using ({leaf}))"""
    )
    return f"""
with {", ".join(steps)}
select doc_id, {leaf}, tokens, cast(budget as bigint) as budget,
  cast(case when tokens = 0 then 0 when upto <= rest then epochs + 1 else epochs end as bigint) as copies
from (select *, sum(tokens) over (partition by {leaf}
    order by md5('0:' || cast(cast(epochs as bigint) as varchar) || ':' || coalesce(cast(doc_id as varchar), ''))
    rows unbounded preceding) as upto from placed)
"""


_PHRASE_WORDS = r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
    unnest(regexp_split_to_array({lowered}, '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces)""".replace("{lowered}", _LOWERED)

_COLLOCATIONS = _PHRASE_WORDS + f""",
counts as (
  select lang, m, phrase, count(*) as f from (
    select lang, m, array_to_string(w[i:i + m - 1], ' ') as phrase
    from (select lang, w, m, unnest(range(1, len(w) - m + 2)) as i from w, (values (1), (2), (3)) as sizes(m) where len(w) >= m))
  group by all),
cuts as (
  select c.lang, c.phrase, c.m, c.f as a, k,
    array_to_string(string_split(phrase, ' ')[1:k], ' ') as head, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') as tail
  from (select *, unnest(range(1, m)) as k from counts where m > 1 and f >= {MIN_COUNT}) as c),
scored as (
  select c.lang, c.phrase, c.m, c.a, c.k, h.f as l, t.f as r,
    cast(({SCALE}::hugeint * c.a * c.a) // (h.f::hugeint * t.f) as bigint) as score
  from cuts c join counts h on h.lang = c.lang and h.phrase = c.head and h.m = c.k
    join counts t on t.lang = c.lang and t.phrase = c.tail and t.m = c.m - c.k),
best as (select * from (select *, row_number() over (partition by lang, phrase, m order by score, k) as place from scored) where place = 1),
longer as (
  select lang, part, max(a) as most from (
    select lang, a, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) as part
    from best where m = 3)
  group by all),
kept as (
  select b.* from best b left join longer on longer.lang = b.lang and part = phrase and m = 2
  where most is null or 100 * most < {COVERED_PERCENT} * a)
select lang, rank, phrase, a, l, r, n, score
from (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
  join (select lang, cast(sum(f) as bigint) as n from counts where m = 1 group by lang) using (lang)
where rank <= {TOP}
"""

# crc32 of text of ASCII characters, bit by bit
_CRC = """xor(list_reduce([4294967295::bigint] || flatten(list_transform(range(1, length({s}) + 1), lambda i: [ord({s}[i])::bigint, 0, 0, 0, 0, 0, 0, 0])),
  lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))), 4294967295)"""

_REPAIR = rf"""
with recursive marked as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {_CRC.format(s="key")} % 20 as kind
  from (select *, coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as key from conversations)),
rows_ as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(case when kind = 3 then [0, 1] else [0] end) as copy
  from marked where kind <> 0),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as pos,
    row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as again,
    right(rtrim(text, E' 	
'), 1) as last
  from rows_),
flagged as (
  select conv_id, pos, turn, role, text, left(role, 1) as c,
    case when last = '' then 'blank' when again > 1 then 'duplicate' when last not in ('.', '!', '?') then 'truncated' else '' end as fault,
    lag(left(role, 1)) over (partition by conv_id order by pos) as c_before
  from placed),
sizes as (select conv_id, count(*) as n from flagged group by conv_id),
moves(st, c, st2) as (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
wanted(st, st2) as (values (0, 2), (1, 2), (2, 3), (3, 2)),
adds(st, st2, cost, more) as (
  select st, st, 0, '' from (values (0), (1), (2), (3)) as s(st)
  union all select st, st2, {INSERT_COST}, 'I' from wanted
  union all select w.st, v.st2, 2 * {INSERT_COST}, 'II' from wanted w join wanted v on v.st = w.st2),
edits(st, c, st2, cost, edit) as (
  select st, null, st, {DELETE_COST}, 'D' from (values (0), (1), (2), (3)) as s(st)
  union all select st, c, st2, 0, 'K' from moves
  union all select st, null, st2, {REROLE_COST}, 'R' from wanted),
search(conv_id, pos, st, best) as (
  select conv_id, 0::bigint, adds.st2, {{'cost': adds.cost, 'audit': adds.more}} from sizes, adds where adds.st = 0 and adds.st2 in (0, 2, 3)
  union all
  select conv_id, pos, st, min(best) from (
    select f.conv_id, f.pos, a.st2 as st,
      {{'cost': best.cost + e.cost + a.cost + case when fault = 'truncated' and edit <> 'D' then {TRUNCATED_COST} else 0 end,
        'audit': best.audit || edit || a.more}} as best
    from search s join flagged f on f.conv_id is not distinct from s.conv_id and f.pos = s.pos + 1
      join edits e on e.st = s.st and (e.c is null or e.c = f.c) and (edit = 'D' or fault not in ('blank', 'duplicate'))
      join adds a on a.st = e.st2)
  group by conv_id, pos, st),
chosen as (
  select s.conv_id, min(best) as best from search s join sizes z on z.conv_id is not distinct from s.conv_id and z.n = s.pos
  where st in (0, 3) group by s.conv_id),
letters as (select conv_id, best.audit as audit, i, best.audit[i] as edit, unnest_i as i2
  from (select *, unnest(range(1, length(best.audit) + 1)) as i, 0 as unnest_i from chosen)),
steps as (
  select conv_id, i, edit,
    sum(case when edit <> 'I' then 1 else 0 end) over (partition by conv_id order by i) as pos,
    sum(case when edit <> 'D' then 1 else 0 end) over (partition by conv_id order by i) as place,
    sum(case when edit <> 'D' then 1 else 0 end) over (partition by conv_id) as size
  from letters),
repaired as (
  select s.conv_id, string_agg(
      case when edit = 'K' then role else case when (place + size) % 2 = 1 then 'user' else 'assistant' end end
      || ':' || case when edit = 'I' then '' else text end, chr(10) order by i) as text
  from steps s left join flagged f on f.conv_id is not distinct from s.conv_id and f.pos = s.pos
  where edit <> 'D' group by s.conv_id),
counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
    count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (c_before is not null and c_before || c not in ('su', 'ua', 'au')) as illegal
  from flagged group by conv_id)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cast(best.cost as bigint), 0) as cost,
  coalesce(best.audit, '') as audit, sha256(coalesce(r.text, '')) as repaired_sha256
from (select distinct conv_id from conversations) o
  left join counts c on c.conv_id is not distinct from o.conv_id
  left join chosen b on b.conv_id is not distinct from o.conv_id
  left join repaired r on r.conv_id is not distinct from o.conv_id
"""

_NEIGHBOURS = f"""
with v as (
  select vec_id, cast(embedding as double[]) as e from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs as (
  select q.vec_id as query_id, v.vec_id, list_reduce([0::double] || list_transform(list_zip(q.e, v.e), lambda p: p[1] * p[2]), lambda a, x: a + x) as score
  from v q, v where q.vec_id % {QUERY_EVERY} = 0 and v.vec_id <> q.vec_id and len(v.e) = len(q.e))
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from pairs) where rank <= {NEIGHBOURS}
"""

CHECKS: dict[str, str] = {
    "op2_decontaminate": DECONTAMINATE,
    "op5_host_rules": _host_rules(),
    "op6_mixing": _mixing(),
    "op11_conversation_repair": _REPAIR,
    "op12_collocations": _COLLOCATIONS,
    "op13_vector_search": _NEIGHBOURS,
}
