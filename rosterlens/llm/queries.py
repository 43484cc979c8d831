"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from .additive_quant import op5_additive
from .chat_template import op2_chat
from .dart_minhash import op4_minhash
from .dialogue_repair import op11_repair
from .ego_join import op3_ego
from .html_suffix import op1_html
from .license_diag import op10_license
from .packing import op9_packing
from .pii_skipchain import op7_pii
from .residual_packing import op12_residual
from .sp_scan import op8_sentencepiece
from .toxic_crf import op6_toxicity
from .whitening import op13_whitening

QUERIES = {
    "op1_html": op1_html,
    "op2_chat": op2_chat,
    "op3_ego": op3_ego,
    "op4_minhash": op4_minhash,
    "op5_additive": op5_additive,
    "op6_toxicity": op6_toxicity,
    "op7_pii": op7_pii,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_packing": op9_packing,
    "op10_license": op10_license,
    "op11_repair": op11_repair,
    "op12_residual": op12_residual,
    "op13_whitening": op13_whitening,
}

_ESCAPES = r"len(regexp_extract_all({c}, '<\\*(/s>|s>)|\[\\*(INST\]|/INST\]|GEN\]|/GEN\])'))"



def _repair_sql() -> str:
    """Damage, faults and the cheapest edits as SQL: one step a row over the costs, edits and text of four states."""

    def go(state: str, cost: str, letter: str, text: str = "''") -> str:
        return f"case when {state}.c is not null then {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {state}.t || {text}}} end"

    def best(*options: str) -> str:
        return f"list_sort(list_filter([{', '.join(options)}], lambda x: x is not null))[1]"

    def insert(state: str, role: str) -> str:
        return go(state, "2", "I", f"chr(10) || '{role}:'")

    def row(state: str, initial: str, role: str) -> tuple[str, str]:
        keep = f"case when stays and initial = '{initial}' then {go(state, 'extra', 'K', 'chr(10) || role || chr(58) || text')} end"
        turn = f"case when stays then {go(state, '2 + extra', 'R', f"chr(10) || '{role}:' || text")} end" if role else "null"
        return keep, turn

    table = "list_transform(range(256), lambda n: list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, k: case when c & 1 = 1 then xor(3988292384::bigint, c >> 1) else c >> 1 end))"
    key = "coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')"
    code = f"xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({key}, ''), lambda x: ascii(x)::bigint)), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295::bigint)"
    user = [x for state in ("s0", "s1", "s3") for x in row(state, "u", "user")]
    return f"""
with recursive crc as (select {table} as crc),
d as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {code} % 20 as harm from conversations, crc),
r as (select conv_id, turn, case when harm = 4 then 'user' else role end as role, case harm when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
  unnest(range(case when harm = 3 then 2 else 1 end)) as copy from d where harm <> 0),
n as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from r),
o as (select *, i > min(i) over (partition by conv_id, role, text) as again, left(role, 1) as initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body from n),
f as (select *, case when body = '' then 'blank' when again then 'duplicate' when right(body, 1) not in ('.', '!', '?') then 'truncated' end as fault,
  body <> '' and not again as stays, case when body <> '' and not again and right(body, 1) not in ('.', '!', '?') then 1 else 0 end as extra,
  i > 1 and lag(initial) over (partition by conv_id order by i) || initial not in ('su', 'ua', 'au') as illegal from o),
step as (
  select distinct conv_id, 0::bigint as i, {{'c': 0::bigint, 'a': '', 't': ''}} as s0, null::struct(c bigint, a varchar, t varchar) as s1, null::struct(c bigint, a varchar, t varchar) as s2, null::struct(c bigint, a varchar, t varchar) as s3 from f
  union all
  select conv_id, i, {go('s0', '3', 'D')}, {best(go('s1', '3', 'D'), row('s0', 's', '')[0])}, {best(go('s2', '3', 'D'), *user)}, {best(go('s3', '3', 'D'), *row('s2', 'a', 'assistant'))}
  from (select conv_id, i, role, text, initial, stays, extra, s0, s1, s2, {best('s3', insert('s2', 'assistant'))} as s3 from (
    select f.conv_id, f.i, role, text, initial, stays, extra, s0, s1, {best('s2', insert('s0', 'user'), insert('s1', 'user'), insert('s3', 'user'))} as s2, s3
    from step join f on f.conv_id is not distinct from step.conv_id and f.i = step.i + 1))
),
last as (select conv_id, {best('s0', 's3', insert('s2', 'assistant'))} as found from (
  select conv_id, s0, s3, {best('s2', insert('s1', 'user'))} as s2 from (select *, max(i) over (partition by conv_id) as n from step) where i = n)),
counted as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps, count(*) filter (where fault = 'blank')::bigint as blank, count(*) filter (where fault = 'duplicate')::bigint as duplicate,
  count(*) filter (where fault = 'truncated')::bigint as truncated, count(*) filter (where illegal)::bigint as illegal from f group by 1)
select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
  coalesce(found.c, 0)::bigint as cost, coalesce(found.a, '') as audit, sha256(coalesce(substr(found.t, 2), '')) as repaired_sha256
from (select distinct conv_id from conversations) e left join counted c on c.conv_id is not distinct from e.conv_id left join last l on l.conv_id is not distinct from e.conv_id"""


ORACLE_SQL: dict[str, str] = {
    "op2_chat": f"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(22 + case when role = 'assistant' then 11 else 0 end + length(role) + length(text) + {_ESCAPES.format(c="role")} + {_ESCAPES.format(c="text")})::bigint as formatted_chars
from c group by conv_id""",
    "op11_repair": _repair_sql(),
    "op3_ego": """
with recursive v as (select vec_id, label, embedding::double[] as e from embeddings where label is not null),
links as (select a.vec_id as x, b.vec_id as y from v a join v b on a.label = b.label and a.vec_id <> b.vec_id where list_cosine_similarity(a.e, b.e) >= 0.93),
reach as (select x, y from links union select r.x, l.y from reach r join links l on r.y = l.x)
select vec_id, (select count(*) from links where x = vec_id)::bigint as n_links,
  coalesce(least(vec_id, (select min(y) from reach where x = vec_id)), vec_id) as component_id,
  vec_id = coalesce(least(vec_id, (select min(y) from reach where x = vec_id)), vec_id) as kept
from embeddings""",
}
