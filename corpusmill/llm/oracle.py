"""DuckDB SQL for the numbered operators' queries."""

from __future__ import annotations

from corpusmill.llm import quality_rules as q8



def _bin(top: str, below: str) -> str:
    parts = f"({q8.SCALE} * {top} // greatest({below}, 1))"
    low = f"greatest(length(bin({parts})) - {q8.BIN_BITS}, 0)::int"
    return f"(({parts} >> {low}) << {low})"


_RATE_ROWS = " union all ".join(f"select lang, source, '{r}' as rate, {_bin(top, below)} as bin from passed" for r, (top, below, _, _) in q8.RATES.items())
_FLOORS = " ".join(f"when '{r}' then {v[2]}" for r, v in q8.RATES.items())
_FITS = " and ".join(
    f"{_bin(f'c.{top}', f'c.{below}')} <= b.high_{r}" + (f" and {_bin(f'c.{top}', f'c.{below}')} >= b.low_{r}" if low else "") for r, (top, below, _, low) in q8.RATES.items()
)
_PICKS = ", ".join(f"max(case when rate = '{r}' then {s} end) as {s}_{r}" for r in q8.RATES for s in ("low", "high"))

#: Base counts of op8 as CTEs ending in ``counts``; ``{docs}`` is the input relation.
QUALITY_COUNTS = f"""
src as (select row_number() over () as rid, * from {{docs}}),
w as (select rid, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as ls from src),
win as (select rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as tri
        from (select rid, ws, unnest(range(1, len(ws) - 1)) as i from w where len(ws) >= 3)),
rep as (select rid, i from (select rid, i, count(*) over (partition by rid, tri) as n from win) where n > 1),
cov as (select rid, count(distinct p) as n from (select rid, unnest([i, i + 1, i + 2]) as p from rep) group by rid),
base as (select s.*, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars,
        length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
        (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words,
        len(ls)::bigint as _q_lines, length(coalesce(text, ''))::bigint as _q_chars
        from src s join w using (rid) left join cov c using (rid)),
counts as (select *, n_words < {q8.MIN_WORDS} or 100 * n_repeat_words > {q8.MAX_REPEAT_PERCENT} * n_words as base_failed from base),
passed as (select * from counts where not base_failed),
sk as (select lang, source, rate, bin, count(*) as n from ({_RATE_ROWS}) group by all),
own_r as (select *, sum(n) over (partition by lang, source, rate order by bin) as upto, sum(n) over (partition by lang, source, rate) as total from sk),
own as (select lang, source, rate, max(total) as total, min(case when 4 * upto >= total then bin end) as q1,
        min(case when 4 * upto >= 2 * total then bin end) as q2, min(case when 4 * upto >= 3 * total then bin end) as q3 from own_r group by all),
who_r as (select *, sum(n) over (partition by lang, rate order by bin) as upto, sum(n) over (partition by lang, rate) as total
        from (select lang, rate, bin, sum(n) as n from sk group by all)),
who as (select lang, rate, min(case when 4 * upto >= total then bin end) as q1, min(case when 4 * upto >= 2 * total then bin end) as q2,
        min(case when 4 * upto >= 3 * total then bin end) as q3 from who_r group by all),
used as (select o.lang, o.source, o.rate, (o.total * o.q1 + {q8.PRIOR} * h.q1) // (o.total + {q8.PRIOR}) as q1,
        (o.total * o.q2 + {q8.PRIOR} * h.q2) // (o.total + {q8.PRIOR}) as q2, (o.total * o.q3 + {q8.PRIOR} * h.q3) // (o.total + {q8.PRIOR}) as q3
        from own o join who h on o.lang is not distinct from h.lang and o.rate = h.rate),
lim as (select lang, source, rate, q2 + {q8.FENCE} * greatest(q3 - q1, case rate {_FLOORS} end) as high,
        q2 - {q8.FENCE} * greatest(q3 - q1, case rate {_FLOORS} end) as low from used),
bounds as (select lang, source, {_PICKS} from lim group by lang, source),
judged as (select c.*, coalesce(not base_failed and {_FITS}, false) as kept
        from counts c left join bounds b on c.lang is not distinct from b.lang and c.source is not distinct from b.source)"""

ORACLES: dict[str, str] = {
    "op4_ngram_join": """
with recursive w as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws from documents),
sh as (select distinct doc_id, case when len(ws) < 5 then array_to_string(ws, ' ') else array_to_string(ws[i : i + 4], ' ') end as g
        from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) as i from w where len(ws) > 0)),
n as (select doc_id, count(*) as n from sh group by doc_id),
idx as (select g, list(doc_id) as ds from sh group by g having count(*) > 1),
pairs as (select a, b, count(*) as both_n from (select a, unnest(ds) as b, g from (select unnest(ds) as a, ds, g from idx)) where a < b group by a, b),
links as (select a, b from pairs join n as x on a = x.doc_id join n as y on b = y.doc_id where 100 * both_n >= 75 * (x.n + y.n - both_n)),
sym as (select a, b from links union select b, a from links),
reach(d, r) as (select a, b from sym union select reach.d, sym.b from reach join sym on reach.r = sym.a),
least_r as (select d, min(r) as r from reach group by d)
select w.doc_id, coalesce(n.n, 0)::bigint as n_shingles, least(w.doc_id, coalesce(l.r, w.doc_id)) as component_id
from w left join n on w.doc_id = n.doc_id left join least_r l on l.d = w.doc_id""",
    "op5_warc": """
with p as (select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
f as (select payload_digest, min(page_id) as first from p where payload_bytes >= 100 group by payload_digest)
select page_id, payload_bytes, payload_digest, case when first is null or first = page_id then 'response' else 'revisit' end as record_type,
    case when first <> page_id then first end as refers_to
from p left join f using (payload_digest)""",
    "op8_quality_rules": f"with {QUALITY_COUNTS.format(docs='documents')} "
    "select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept from judged",
    "op12_hard_negatives": """
with e as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda c: floor(256 * c::double)::bigint) as x
        from embeddings where vec_id is not null and label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
sc as (select a.vec_id as anchor_id, r.vec_id as id, a.label = r.label as same, list_sum(list_transform(list_zip(a.x, r.x), lambda p: p[1] * p[2]))::bigint as score
        from e as a join e as r on a.vec_id <> r.vec_id where a.vec_id % 50 = 0),
pos as (select * from sc where same qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select p.anchor_id, p.id as positive_id, row_number() over (partition by p.anchor_id, p.id order by n.score desc, n.id)::int as rank, n.id as negative_id,
    p.score as positive_score, n.score as negative_score
from pos p join sc n on p.anchor_id = n.anchor_id and not n.same and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score qualify rank <= 3""",
    "op13_exact_dedup": """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size, doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))""",
}
