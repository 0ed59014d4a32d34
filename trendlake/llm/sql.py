"""SQL of the text queries that SQL can express."""

from __future__ import annotations

from trendlake.llm.quality_rules import MAX_REPEAT_PERCENT, MIN_WORDS, RULES, STEPS, WINDOW

WORD = r"[^\x20\x09-\x0D]+"
FALSE_REJECTION, ERROR = 0.02, 0.05


def rule_steps(rule) -> str:
    hits = (f"({rule.amount}::double > {cutoff!r}::double * {rule.base})::int" for cutoff in rule.cutoffs())
    return "(" + " + ".join(hits) + ")"


QUALITY_RULES = f"""
with texts as (
    select doc_id, lang, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{WORD}') as w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) as l
    from documents
), windows as (
    select doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') as key
    from (select doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) as i from texts where len(w) > {WINDOW})
), covered as (
    select doc_id, count(distinct i + j) as n_repeat_words
    from (select doc_id, i, count(*) over (partition by doc_id, key) as times from windows), range({WINDOW}) as s(j)
    where times > 1
    group by doc_id
), stats as (
    select doc_id, lang, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]')) as n_symbols, len(l) - len(list_distinct(l)) as n_dup_lines,
        coalesce(n_repeat_words, 0) as n_repeat_words, len(l) as n_lines,
        len(regexp_extract_all(t, '!')) as n_exclamations, len(regexp_extract_all(t, '\\p{{Lu}}')) as n_capitals,
        len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) as n_doubled_words
    from texts left join covered using (doc_id)
), judged as (
    select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as base_failed,
        greatest({", ".join(map(rule_steps, RULES))}) as level
    from stats
), good as (
    select lang, level from judged join (
        select doc_id from labels where quality is not null group by doc_id having min(quality) = 1
    ) using (doc_id) where not base_failed
), tests as (
    select lang, keep, count(*) as n, count(*) filter (level > keep) as k
    from good, range({STEPS}) as s(keep) group by lang, keep
), passed as (
    select lang, min(keep) as max_level from tests
    where k <= {FALSE_REJECTION} * n and list_sum(list_transform(range(0, k + 1), lambda i:
        exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
            + i * ln({FALSE_REJECTION}::double) + (n - i) * ln(1 - {FALSE_REJECTION}::double))))
        <= {ERROR}::double / (select count(distinct coalesce(lang, '')) from good)
    group by lang
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed and level <= coalesce(max_level, {STEPS}) as kept
from judged left join passed on judged.lang is not distinct from passed.lang
"""

MIXING = f"""
with sized as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) as size,
        md5(coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, ''))) as key
    from documents
), totals as (
    select source, sum(size)::bigint as source_size, 3 * sum(size)::bigint as cap,
        [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight
    from sized group by source
), rated as (
    select *, ((sum(source_size) over ()) - coalesce(sum(cap) over (order by cap / weight, source nulls last
        rows between unbounded preceding and 1 preceding), 0))::double / sum(weight) over (order by cap / weight, source nulls last
        rows between current row and unbounded following)::double as rate
    from totals
), targets as (
    select *, least(cap::double, weight * (select max(rate) from rated where rate * weight <= cap)) as target from rated
), budgets as (
    select *, case when source_size > 0 then round(target)::bigint // source_size else 0 end as whole from targets
), placed as (
    select doc_id, size, source_size, target, whole,
        round(target)::bigint - whole * source_size
            - (sum(size) over (partition by source order by key rows between unbounded preceding and current row) - size) as room
    from sized join (select source as of, * exclude (source) from budgets) on source is not distinct from of
)
select doc_id, size, source_size, target, (whole * size + greatest(0, least(size, room)))::bigint as taken from placed
"""

TOP_K = """
with whole as (
    select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v from embeddings
    where vec_id is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
    from whole q join whole c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v)
)
select query_id, rank::int as rank, vec_id, score from (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
) where rank <= 20
"""

DECONTAMINATION = r"""
with doc_words as (
    select row_number() over () as row, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
    from documents
), item_words as (
    select item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
    from benchmark
), phrases as (
    select distinct item_id, least(len(w), 10) as size, array_to_string(w[i:i + 9], ' ') as phrase
    from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from item_words where len(w) > 0)
), windows as (
    select row, size, i, array_to_string(w[i:i + size - 1], ' ') as phrase
    from (select row, w, size, unnest(range(1, len(w) - size + 2)) as i
        from doc_words, (select distinct size from phrases) where len(w) >= size)
), found as (
    select row, windows.size, i, item_id from windows join phrases using (phrase)
), hit as (
    select row, count(distinct i + j) as n_hit from (select row, i, unnest(range(0, size)) as j from found) group by row
), items as (
    select row, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids
    from found group by row
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc_words left join hit using (row) left join items using (row)
"""

SPELLING = r"""
with recursive crc_bytes as (
    select list(c order by n) as crc from (
        select n, list_reduce(list_prepend(n, range(8)), lambda c, k:
            case when c & 1 = 1 then xor(3988292384::bigint, c >> 1) else c >> 1 end) as c
        from (select unnest(range(256)) as n)
    )
), runs as (
    select coalesce(doc_id::varchar, '') || ':' || run as keyed, run, count(*) as times from (
        select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) as run from documents
    ) group by all
), summed as (
    select run, times, xor(4294967295::bigint, list_reduce(list_prepend(4294967295::bigint,
        list_transform(range(0, octet_length(encode(keyed))), lambda i: ('0x' || substr(hex(encode(keyed)), 2 * i + 1, 2))::bigint)),
        lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))) as h
    from runs, crc_bytes
), words as materialized (
    select word, sum(times)::bigint as n from (
        select times, case when h % 199 = 0 then left(run, h % length(run)) || substr(run, h % length(run) + 2) else run end as word
        from summed
    ) where length(word) >= 6 group by word having sum(times) >= 5
), holes as (
    select word, n, i, left(word, i - 1) as head, substr(word, i + 1) as tail
    from (select word, n, unnest(range(1, length(word) + 1)) as i from words)
), pairs as (
    select a.word, b.word as near, b.n as near_n from holes a join holes b
        on a.head = b.head and a.tail = b.tail and a.word <> b.word
    union select a.word, b.word, b.n from holes a join words b on a.head || a.tail = b.word
    union select b.word, a.word, a.n from holes a join words b on a.head || a.tail = b.word
), best as (
    select word, count(*) as n_near, arg_min(near, (-near_n, near)) as near, max(near_n) as near_n from pairs group by word
), forms as materialized (
    select words.word, n, coalesce(n_near, 0) as n_near, case when near_n >= 5 * n then near end as form,
        case when near_n >= 5 * n then near_n end as form_n
    from words left join best using (word)
), ways as (
    select word, word as root from forms where form is null
    union all select f.word, w.root from forms f join ways w on f.form = w.word
)
select word, form, root, n, n_near, form_n from forms join ways using (word)
"""


def _assigned(round: int) -> str:
    return f"""assigned_{round} as materialized (
    select row, part, v, arg_min(entry, d * 1024 + entry) as entry, min(d) as d from (
        select row, part, v, entry, (list_dot_product(v, v) - 2 * list_dot_product(v, c) + list_dot_product(c, c))::bigint as d
        from parts join book_{round} using (part)
    ) group by row, part, v
)"""


def _next_book(round: int) -> str:
    return f"""places_{round} as (
    select part, entry, place, sum(x)::bigint as s, count(*) as n from (
        select part, entry, unnest(range(1, len(v) + 1)) as place, unnest(v)::bigint as x from assigned_{round}
    ) group by all
), book_{round + 1} as materialized (
    select part, entry, coalesce(m, c) as c from book_{round} left join (
        select part, entry, list(((s - ((s % n) + n) % n) // n)::double order by place) as m from places_{round} group by all
    ) using (part, entry)
)"""


VECTOR_CODES = f"""
with kept as (
    select *, row_number() over (order by vec_id, whole) as row from (
        select vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::double)) as whole from embeddings
        where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    )
), parts as materialized (
    select row, part, whole[part * (len(whole) // 4) + 1:(part + 1) * (len(whole) // 4)] as v
    from kept, (select unnest(range(4)) as part)
), book_0 as materialized (
    select part, row - 1 as entry, v as c from parts where row <= 256
), {", ".join(_assigned(r) + ", " + _next_book(r) for r in range(4))}, {_assigned(4)}, digested as (
    select sha256(string_agg(array_to_string(list_transform(c, lambda x: x::bigint), ','), ',' order by part, entry)) as codebooks_sha256
    from book_4
), coded as (
    select row, string_agg(lower(lpad(to_hex(entry), 2, '0')), '' order by part) as code, sum(d)::bigint as error from assigned_4 group by row
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from kept join coded using (row), digested
"""

SQL = {
    "op1_quality_rules": QUALITY_RULES,
    "op8_mixing": MIXING,
    "op10_top_k": TOP_K,
    "op11_decontamination": DECONTAMINATION,
    "op12_spelling_variants": SPELLING,
    "op13_vector_codes": VECTOR_CODES,
}
