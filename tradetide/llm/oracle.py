"""Queries of the subpackage in DuckDB's SQL, where SQL can say them."""

from __future__ import annotations

import math

from tradetide.llm import chat, embeddings, mixing, quality, repeats, sharding, spelling

# Rows get a number of their own: ids may be null or occur more than once.
WORDS = r"""docs as (
    select row_number() over () as rid, doc_id, lang, source, coalesce(text, '') as t from documents),
split as (
    select *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') as ws from docs)"""


def covered(windows: str, size: int) -> str:
    """Words of ``split`` that windows of ``size`` words found again cover: (rid, pos)."""
    return f"""starts as (
    select rid, ws, unnest(range(1, len(ws) - {size - 2})) as i from split where len(ws) >= {size}),
windows as (select rid, i, array_to_string(ws[i:i + {size - 1}], ' ') as w from starts),
again as (select {windows}, w from windows group by all having count(*) > 1),
covered as (
    select distinct rid, unnest(range(i, i + {size})) as pos from windows join again using ({windows}{", " if windows else ""}w))"""


def quality_sql() -> str:
    values = " union all ".join(
        f"select rid, lang, source, base_failed, '{m}' as measure, {i} as nr, {str(both).lower()} as both_ways,"
        f" case when n_words >= {least} then {value} end as v from based"
        for i, (m, (value, least, both)) in enumerate(quality.MEASURES.items()))

    def quantile(q: float) -> str:
        reached = f"min(bin) filter (up_to >= ceil(rows * {q}))"
        return f"pow({quality.GAMMA}, {reached}) * {2 / (quality.GAMMA + 1)!r}"

    return f"""
with {WORDS},
{covered("rid", quality.REPEAT_WINDOW)},
lines as (
    select rid, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) as ls
    from docs),
times as (select rid, w, count(*) as n from (select rid, unnest(ws) as w from split) group by all),
tops as (select rid, count(*) as n_distinct, max(n) as n_top from times group by rid),
counted as (
    select s.rid, doc_id, lang, source, len(ws)::bigint as n_words,
        coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0)::bigint as word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
        (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
        coalesce(r.n, 0)::bigint as n_repeat_words, len(ls)::bigint as n_lines,
        (length(t) - length(regexp_replace(t, '[!-/:-@\\[-`{{-~]', '', 'g')))::bigint as n_marks,
        coalesce(n_distinct, 0)::bigint as n_distinct, coalesce(n_top, 0)::bigint as n_top
    from split s join lines using (rid) left join tops on tops.rid = s.rid
    left join (select rid, count(*) as n from covered group by rid) r on r.rid = s.rid),
based as (
    select *, n_words < {quality.LEAST_WORDS}
        or 100 * n_repeat_words > {quality.MOST_REPEATED_PERCENT} * n_words as base_failed from counted),
measured as ({values}),
levels as (
    select measure, ceil(ln(v) / {math.log(quality.GAMMA)!r})::bigint as bin, level,
        case when level >= 1 then lang end as l, case when level = 2 then source end as s
    from measured, (select unnest([0, 1, 2]) as level) where v > 0 and not base_failed),
sketch as (select measure, bin, level, l, s, count(*) as n from levels group by all),
ranked as (
    select *, sum(n) over (partition by measure, level, l, s order by bin) as up_to,
        sum(n) over (partition by measure, level, l, s) as rows from sketch),
quartiles as (
    select measure, level, l, s, max(rows) as rows, {quantile(0.25)} as low, {quantile(0.75)} as high
    from ranked group by measure, level, l, s having max(rows) >= {quality.LEAST_ROWS}),
reaches as (
    select *, {quality.DISTANCES}::double * greatest(high - low, {quality.LEAST_SPREAD}::double * high) as reach
    from quartiles),
beyond as (
    select m.rid, m.measure, m.nr, m.v > arg_max(f.high + f.reach, f.level)
        or (m.both_ways and m.v < arg_max(f.low - f.reach, f.level)) as beyond
    from measured m join reaches f on f.measure = m.measure
        and f.l is not distinct from case when f.level >= 1 then m.lang end
        and f.s is not distinct from case when f.level = 2 then m.source end
    group by m.rid, m.measure, m.nr, m.v, m.both_ways),
judged as (select rid, string_agg(measure, ',' order by nr) as failed from beyond where beyond group by rid)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed and failed is null as kept, n_lines, n_marks, n_distinct, n_top, coalesce(failed, '') as failed
from based left join judged using (rid)"""


def repeats_sql() -> str:
    return f"""
with {WORDS},
{covered("", repeats.WINDOW).replace("select , w", "select w")},
placed as (select rid, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as pos from split),
kept as (
    select rid, string_agg(word, ' ' order by pos) as k, count(*) as n
    from placed anti join covered using (rid, pos) group by rid)
select doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(n, 0))::bigint as n_removed,
    sha256(coalesce(k, '')) as kept_sha256
from split left join kept using (rid)"""


def embeddings_sql() -> str:
    """Pairs of all vectors: for small tables only."""
    return f"""
with recursive vectors as (
    select row_number() over () as rid, vec_id, embedding::double[] as v from embeddings),
usable as (
    select * from vectors where len(v) > 0
        and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(v, lambda x: x <> 0)) > 0),
links as (
    select a.rid as a, b.rid as b from usable a join usable b on a.rid <> b.rid and len(a.v) = len(b.v)
    where list_inner_product(a.v, b.v) / sqrt(list_inner_product(a.v, a.v)) / sqrt(list_inner_product(b.v, b.v))
        >= {embeddings.LEAST_COSINE}),
reached as (
    select rid, rid as other from vectors
    union select r.rid, l.b from reached r join links l on l.a = r.other),
named as (
    select r.rid, min(v.vec_id) as component_id from reached r join vectors v on v.rid = r.other group by r.rid)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id is not distinct from component_id as kept
from vectors join named using (rid) left join (select a as rid, count(*) as n from links group by a) using (rid)"""


def audit_sql() -> str:
    return f"""
with {WORDS},
marked as (
    select d.rid, d.doc_id, coalesce(d.lang, '') as part,
        len(ws) < 200 as a, 100 * len(list_distinct(ws)) < 50 * len(ws) as b,
        100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t) as c,
        regexp_matches(t, '[#$%&*|]') as d,
        exists (select 1 from docs o where o.t = d.t and o.doc_id < d.doc_id) as e
    from split d),
labelled as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
facts as (
    select part, concat(case when a then 'A' end, case when b then 'B' end, case when c then 'C' end,
            case when d then 'D' end, case when e then 'E' end) as failing,
        coalesce(good, false) as good, coalesce(toxic, false) as toxic
    from marked left join labelled using (doc_id)),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as l),
orders as (
    select a.l || b.l || c.l || d.l || e.l as filter_order
    from letters a, letters b, letters c, letters d, letters e
    where len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
combos as (select part, failing, length(failing) as many, good, toxic, count(*) as n from facts group by all),
steps as (
    select filter_order, step::int as step, substr(filter_order, step, 1) as own,
        substr(filter_order, 1, step - 1) as before from orders, (select unnest(range(1, 6)) as step)),
tried as (
    select *, contains(failing, own) as f,
        len(list_filter(string_split(failing, ''), lambda x: x <> '' and contains(before, x))) > 0 as gone
    from combos, steps)
select part, filter_order, step,
    sum(case when not f and not gone then n else 0 end)::bigint as kept,
    sum(case when f and not gone then n else 0 end)::bigint as removed,
    sum(case when f and gone then n else 0 end)::bigint as redundant,
    sum(case when failing = own then n else 0 end)::bigint as unique_fails,
    sum(case when f and not gone and good then n else 0 end)::bigint as good_lost,
    sum(case when f and not gone and toxic then n else 0 end)::bigint as toxic_lost,
    sum(case when f then n * (120 // many) else 0 end)::bigint as shapley
from tried group by all"""


def spelling_sql() -> str:
    """Near words meet by the pattern a replaced letter leaves, or by one word less a letter."""
    return f"""
with recursive {sharding.crc32_table()},
texts as (
    select row_number() over () as rid, coalesce(doc_id::varchar, '') as id,
        unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) as run from documents),
runs as (
    select id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as n
    from texts group by all),
drawn as (select run, n, {sharding.crc32_sql("id || ':' || run")} as h from runs, crc),
cut as (
    select case when h % 97 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
        else run end as word, n from drawn),
words as (
    select word, sum(n)::bigint as n from cut where length(word) >= {spelling.LEAST_LETTERS}
    group by word having sum(n) >= {spelling.LEAST_COUNT}),
places as (select word, n, unnest(range(1, length(word) + 1)) as i from words),
patterns as (select word, i, substr(word, 1, i - 1) || '_' || substr(word, i + 1) as p from places),
less as (select distinct word, substr(word, 1, i - 1) || substr(word, i + 1) as p from places),
near as (
    select a.word, b.word as other from patterns a join patterns b using (p) where a.word <> b.word
    union all select l.word, l.p from less l join words w on w.word = l.p
    union all select l.p, l.word from less l join words w on w.word = l.p),
ranked as (
    select r.word, r.other, o.n as other_n, count(*) over (partition by r.word) as n_near,
        row_number() over (partition by r.word order by o.n desc, r.other) as place
    from near r join words o on o.word = r.other),
forms as (
    select w.word, w.n, coalesce(n_near, 0)::bigint as n_near,
        case when other_n >= {spelling.TIMES} * w.n then other end as form,
        case when other_n >= {spelling.TIMES} * w.n then other_n end as form_n
    from words w left join ranked r on r.word = w.word and place = 1),
ways as (
    select word, word as last from forms
    union all select w.word, f.form from ways w join forms f on f.word = w.last where f.form is not null),
roots as (select w.word, w.last as root from ways w join forms f on f.word = w.last where f.form is null)
select word, form, root, n, n_near, form_n from forms join roots using (word)"""


def mixing_sql() -> str:
    """The schedule of one period is a recursion over its slots; lists carry what each source has had."""
    return f"""
with recursive narrow as (
    select doc_id, source, strlen(coalesce(text, '')) as bytes from documents),
numbers as (
    select doc_id, source, row_number() over (partition by source order by
        md5(concat_ws('|', coalesce(doc_id::varchar, ''), coalesce(source, ''), bytes)), doc_id nulls first, bytes) - 1 as r
    from narrow),
weights as (select source, pow(count(*), {mixing.TEMPERATURE}) as weight from narrow group by source),
totals as (
    select sum(weight) as total, count(*) as sources, greatest({mixing.PARTS}, 4 * count(*)) as period from weights),
shares as (select source, period, sources, weight / total * (period - sources) as share from weights, totals),
ranked as (
    select *, row_number() over (order by share - floor(share) desc, source nulls first) as place,
        period - sources - sum(floor(share)) over () as rest from shares),
parts as (
    select source, period, (1 + floor(share) + case when place <= rest then 1 else 0 end)::bigint as parts from ranked),
told as (
    select period, list(parts order by coalesce(source, ''), source is null) as ps,
        list(source order by coalesce(source, ''), source is null) as names from parts group by period),
slots as (
    select 0::bigint as slot, list_transform(ps, lambda p: 0::bigint) as had, 0::bigint as pick from told
    union all
    select slot + 1, list_transform(had, lambda h, j: h + (j = next_pick)::bigint), next_pick from (
        select slot, had, list_min(list_transform(ps, lambda p, i: {{
            'late': (had[i] * period >= (slot + 1) * p)::int, 'due': ((had[i] + 1) * period + p - 1) // p,
            'next': ((had[i] + 2) * period + p - 1) // p, 'i': i::bigint}})).i as next_pick
        from slots, told where slot < period)),
turns as (
    select names[pick] as source, slot - 1 as slot, row_number() over (partition by pick order by slot) - 1 as turn
    from slots, told where slot > 0),
placed as (
    select n.doc_id, n.source, n.r, n.r // {mixing.BLOCK_ROWS} as block, p.period, p.parts
    from numbers n join parts p on n.source is not distinct from p.source),
due as (
    select d.doc_id, d.source, d.r, d.block, d.block * d.period // d.parts as release,
        ((d.block + 1) * d.period + d.parts - 1) // d.parts as deadline, d.block // d.parts * d.period + t.slot as slot
    from placed d join turns t on d.source is not distinct from t.source and t.turn = d.block % d.parts)
select doc_id, source, block::bigint as block, release::bigint as release, deadline::bigint as deadline,
    slot::bigint as slot, row_number() over (order by slot, r) - 1 as position from due"""


ORACLE = {
    "op1_mixing": mixing_sql(),
    "op4_embeddings": embeddings_sql(),
    "op5_repeats": repeats_sql(),
    "op7_sharding": sharding.placed_sql(),
    "op8_chat": chat.report_sql(),
    "op10_quality": quality_sql(),
    "op11_filter_audit": audit_sql(),
    "op12_spelling": spelling_sql(),
}
