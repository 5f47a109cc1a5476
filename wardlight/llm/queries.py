"""The registered queries of this folder, each on its whole table, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, collocations, hard_negatives, html_text, licenses, line_dedup, near_duplicates, packing, personal_data, quality, top_k, toxicity, warc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLE[run.__name__] = sql
        return run

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op1_toxicity(spark, folder):
    documents = table(spark, folder, "documents")
    net = toxicity.fit(documents, table(spark, folder, "labels"))
    return toxicity.score_documents(documents, net)


@query(
    r"""
    with raw as (
        select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as place from documents
    ), l as (
        select *, len(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) as words,
            row_number() over (partition by doc_id order by place) as n, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') as bare
        from raw where regexp_matches(line, '[^\x20\x09-\x0D]')
    ), d as (
        select doc_id, list(bare order by n) as ls, count(*) as lines from l group by doc_id
    ), c as (
        select *, sum(words) over (partition by doc_id order by n) as upto from l
    ), w as (
        select a.doc_id, a.n, min(b.n) as last from c a join c b on a.doc_id = b.doc_id and b.n >= a.n and b.upto - a.upto + a.words >= 50 group by all
    ), x as (
        select w.doc_id, w.n, last, ls[w.n:last] as content,
            ls[last + 1:coalesce(lead(last) over (partition by w.doc_id order by w.n) - 1, lines)] as tail
        from w join d using (doc_id)
    ), t as (
        select content, tail, min((doc_id, n)) as first from x group by all
    ), runs as (
        select x.doc_id, x.n, last + max(coalesce(list_position(list_transform(range(1, least(len(x.tail), len(t.tail)) + 1),
            lambda k: x.tail[k] = t.tail[k]), false) - 1, least(len(x.tail), len(t.tail)))) as last
        from x join t on x.content = t.content and t.first < (x.doc_id, x.n) group by x.doc_id, x.n, last
    ), gone as (
        select distinct doc_id, l.place from runs join l using (doc_id) where l.n between runs.n and runs.last
    ), kept as (
        select doc_id, string_agg(line, chr(10) order by raw.place) filter (g.place is null) as text, count(g.place) as n_deleted
        from raw left join (select doc_id as gone_id, place from gone) g on raw.doc_id = g.gone_id and raw.place = g.place group by doc_id
    )
    select doc_id, case when documents.text is null then null else coalesce(kept.text, '') end as text,
        coalesce(d.lines, 0)::bigint as n_lines, coalesce(n_deleted, 0)::bigint as n_deleted
    from documents left join kept using (doc_id) left join d using (doc_id)
    """
)
def op2_line_dedup(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.delete_repeats(documents)


@query()
def op3_html_text(spark, folder):
    return html_text.extract_pages(table(spark, folder, "pages"))


@query(
    r"""
    with recursive w as (
        select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws
        from documents
    ), s as (
        select distinct doc_id, unnest(case when len(ws) >= 5
            then list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
            when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as shingle
        from w
    ), n as (
        select doc_id, count(*) as n from s group by doc_id
    ), met as (
        select a.doc_id as a, b.doc_id as b, count(*) as shared
        from s a join s b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by all
    ), link as (
        select a, b from met join n x on x.doc_id = a join n y on y.doc_id = b where 100 * shared >= 85 * (x.n + y.n - shared)
    ), reach as (
        select doc_id as a, doc_id as b from documents
        union
        select reach.a, link.b from reach join link on link.a = reach.b
    ), root as (
        select a as doc_id, min(b) as component_id from reach group by a
    )
    select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept
    from documents left join n using (doc_id) join root using (doc_id)
    """
)
def op4_near_duplicates(spark, folder):
    return near_duplicates.group_near_duplicates(table(spark, folder, "documents"))


@query(
    r"""
    with w as (
        select doc_id, coalesce(text, '') as text,
            list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws,
            list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
        from documents
    ), win as (
        select doc_id, unnest(range(1, len(ws) - 6)) as p,
            unnest(list_transform(range(1, len(ws) - 6), lambda i: array_to_string(ws[i:i + 7], ' '))) as win from w
    ), again as (
        select doc_id, p, lead(p) over (partition by doc_id order by p) as next
        from win join (select doc_id, win from win group by all having count(*) > 1) using (doc_id, win)
    ), covered as (
        select doc_id, sum(least(8, coalesce(next - p, 8)))::bigint as n_repeat_words from again group by doc_id
    ), f as (
        select doc_id, text, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars,
            len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols, len(ls)::bigint as n_lines,
            (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
            len(regexp_extract_all(text, '\p{Lu}')) as capitals, len(regexp_extract_all(text, '\p{L}')) as letters,
            len(regexp_extract_all(text, '[!?]')) as calls,
            len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) as n_stutter
        from w left join covered using (doc_id)
    ), b as (
        select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from f
    )
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        not base_failed and not (10 * n_symbols > 3 * n_words or word_chars < 2 * n_words or word_chars > 15 * n_words
            or 2 * n_dup_lines > n_lines or 10 * n_stutter > 3 * n_words or 2 * capitals > letters or 2 * calls > n_words
            or 10 * letters < 6 * word_chars) as kept
    from b
    """
)
def op5_quality(spark, folder):
    judged = quality.judge(table(spark, folder, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("row.doc_id", *counts, "base_failed", "kept")


@query()
def op6_bpe(spark, folder):
    return bpe.encode_documents(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def _license_sql() -> str:
    rows = ", ".join(f"({i}, '{t.text}', '{t.label}', {t.phrase}, {t.needed})" for i, t in enumerate(licenses.TEMPLATES))
    return rf"""
    with t(tid, text, label, phrase, needed) as (values {rows}), tg as (
        select tid, label, phrase, needed, len(string_split(text, ' ')) - 1 as grams, unnest(range(1, len(string_split(text, ' ')))) - 1 as place,
            unnest(list_transform(range(1, len(string_split(text, ' '))), lambda i: string_split(text, ' ')[i] || ' ' || string_split(text, ' ')[i + 1])) as gram
        from t
    ), w as (
        select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as ws
        from documents
    ), dg as (
        select doc_id, unnest(range(1, len(ws))) - 1 as pos, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) as gram from w
    ), votes as (
        select doc_id, tid, label, phrase, needed, grams, pos - place as diagonal, bit_or(1::bigint << place::int) as seen, min(pos) as low, max(pos) as high
        from dg join tg using (gram) group by all
    ), steps as (
        select *, coalesce(not phrase and diagonal - lag(diagonal) over a <= 3 and abs(low - lag(low) over a) <= 1.5 * grams, false) as joins
        from votes window a as (partition by doc_id, tid order by diagonal)
    ), runs as (
        select *, sum(case when joins then 0 else 1 end) over (partition by doc_id, tid order by diagonal) as run from steps
    ), merged as (
        select doc_id, tid, label, phrase, needed, grams, run, bit_or(seen) as seen, min(low) as first, max(high) + 1 as last from runs group by all
    ), judged as (
        select *, (bit_count(seen) / grams)::double as share, case when phrase then bit_count(seen) = grams
            else bit_count(seen) / grams >= 0.8 and seen & needed = needed and last - first + 1 <= 1.5 * (grams + 1) end as good
        from merged
    ), found as (
        select doc_id, count(*) filter (good and phrase) as n_base, min(first) filter (good and phrase) as first_word,
            max(first) filter (good and phrase) as last_word,
            array_to_string(list_sort(list_distinct(list(label) filter (good and phrase))), ',') as base_labels,
            array_to_string(list_sort(list_distinct(list(label) filter (good))), ',') as labels, max(share) as score
        from judged group by doc_id
    )
    select doc_id, len(ws)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word,
        last_word::bigint as last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
        coalesce(score, 0)::double as score
    from w left join found using (doc_id)
    """


@query(_license_sql())
def op8_licenses(spark, folder):
    return licenses.scan(table(spark, folder, "documents")).drop("places")


@query()
def op7_packing(spark, folder):
    return packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query(
    """
    with v as (
        select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v from embeddings
        where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), scored as (
        select q.vec_id as query_id, c.vec_id as vec_id, list_inner_product(q.v::double[], c.v::double[])::bigint as score
        from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id
    ), ranked as (
        select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored
    )
    select query_id, rank, vec_id, score from ranked where rank <= 20
    """
)
def op9_top_k(spark, folder):
    return top_k.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query(
    """
    with p as (
        select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest
        from pages
    ), f as (
        select payload_digest, min(page_id) as first from p where payload_bytes >= 100 group by payload_digest
    )
    select page_id, payload_bytes, payload_digest,
        case when page_id <> first then 'revisit' else 'response' end as record_type,
        case when page_id <> first then first end as refers_to
    from p left join f using (payload_digest)
    """
)
def op10_warc(spark, folder):
    records = warc.archive_round_trip(table(spark, folder, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _personal_sql() -> str:
    """Positions come from the pieces between matches; the plain patterns stand for the linear ones."""
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": r"[A-Z]{2}[0-9]{2}( ?[A-Z0-9]{4}){2,7}( ?[A-Z0-9]{1,3})?",
        "ssn": "[0-9]{3}-[0-9]{2}-[0-9]{4}",
        "local_phone": r"\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}",
    }
    kinds = ", ".join(
        f"({i}, '{k.name}', '(^|[^a-z])({k.words})([^a-z]|$)', {k.prior}, {k.boost}, {k.base})" for i, k in enumerate(personal_data.KINDS)
    )
    # DuckDB wants constant patterns, so each kind is a part of its own.
    parts = " union all ".join(
        f"select doc_id, text, '{name}' as kind, regexp_extract_all(text, '{p}') as ms, string_split_regex(text, '{p}') as ps from t"
        for name, p in plain.items()
    )
    near = " or ".join(
        f"(kind = '{k.name}' and regexp_matches(lower(text[greatest(1, a + 1 - {personal_data.BEFORE}):a] || ' ' || text[b + 1:b + {personal_data.AFTER}]), "
        f"'(^|[^a-z])({k.words})([^a-z]|$)'))"
        for k in personal_data.KINDS
    )
    return rf"""
    with t as (select doc_id, coalesce(text, '') as text from documents),
    k(place, kind, words, prior, boost, base) as (values {kinds}),
    p as ({parts}), u as (
        select *, unnest(range(1, len(ms) + 1)) as i from p
    ), s as (
        select doc_id, text, kind, ms[i] as s, coalesce(list_sum(list_transform(ps[1:i], lambda x: length(x))), 0)
            + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) as a, regexp_replace(ms[i], '[^0-9]', '', 'g') as d,
            replace(ms[i], ' ', '') as bare
        from u
    ), v as (
        select *, (a + length(s))::bigint as b from s where case kind
            when 'ip' then len(list_filter(string_split(s, '.'), lambda x: length(ltrim(x, '0')) > 3 or coalesce(try_cast(ltrim(x, '0') as int), 0) > 255)) = 0
            when 'card' then length(d) between 13 and 19 and list_sum(list_transform(range(1, length(d) + 1),
                lambda j: case when j % 2 = 1 then d[length(d) + 1 - j]::int else (2 * d[length(d) + 1 - j]::int) // 10 + (2 * d[length(d) + 1 - j]::int) % 10 end)) % 10 = 0
            when 'phone' then length(d) between 9 and 15
            when 'local_phone' then length(d) between 9 and 11
            when 'ssn' then s[1:3] not in ('000', '666') and s[1] <> '9' and s[5:6] <> '00' and s[8:11] <> '0000'
            when 'iban' then length(bare) between 15 and 34 and list_reduce(list_transform(string_split(bare[5:] || bare[1:4], ''),
                lambda c: case when c between '0' and '9' then c::int else ascii(c) - 55 end), lambda r, x: (case when x > 9 then r * 100 + x else r * 10 + x end) % 97, 0) = 1
            else true end
    ), g as (
        select v.*, place, base, prior + case when {near} then boost else 0 end as score from v join k using (kind)
    ), kept as (
        select * from g where base or (score >= {personal_data.LEAST} - 1e-9 and not regexp_matches(text[a:a], '^[A-Za-z0-9]$') and not regexp_matches(text[b + 1:b + 1], '^[A-Za-z0-9]$')
            and not exists (select 1 from g o where o.base and o.doc_id = g.doc_id and o.a < g.b and g.a < o.b))
    ), found as (
        select doc_id, count(*) filter (kind = 'email') as n_email, count(*) filter (kind = 'ip') as n_ip, count(*) filter (kind = 'card') as n_card,
            count(*) filter (kind = 'phone') as n_phone, string_agg(kind || ':' || a || ':' || b, ',' order by place, a) filter (base) as base_spans,
            string_agg(kind || ':' || a || ':' || b, ',' order by place, a) as spans
        from kept group by doc_id
    )
    select doc_id, coalesce(n_email, 0) as n_email, coalesce(n_ip, 0) as n_ip, coalesce(n_card, 0) as n_card, coalesce(n_phone, 0) as n_phone,
        sha256(coalesce(base_spans, '')) as base_sha256, coalesce(spans, '') as spans
    from documents left join found using (doc_id)
    """


@query(_personal_sql())
def op13_personal_data(spark, folder):
    return personal_data.span_digest(personal_data.find_personal_data(table(spark, folder, "documents")))


@query(
    """
    with v as (
        select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
            list_transform(embedding, lambda x: floor(256 * x::double)) as v
        from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), s as (
        select a.vec_id as anchor_id, c.vec_id, a.label = c.label as alike, list_inner_product(a.v, c.v)::bigint as score
        from v a join v c on a.vec_id % 100 = 0 and c.vec_id <> a.vec_id
    ), p as (
        select anchor_id, vec_id as positive_id, score as positive_score from s where alike
        qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
    )
    select anchor_id, positive_id, row_number() over w::int as rank, vec_id as negative_id, positive_score, score as negative_score
    from p join s using (anchor_id) where not alike and 80 * positive_score <= 100 * score and score <= positive_score
    window w as (partition by anchor_id, positive_id order by score desc, vec_id) qualify row_number() over w <= 5
    """
)
def op12_hard_negatives(spark, folder):
    rows = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


@query(
    r"""
    with pieces as (
        select coalesce(lang, 'und') as lang, doc_id, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
        from documents
    ), w as (
        select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') as ws from pieces
    ), n as (
        select lang, sum(len(ws))::bigint as n from w group by lang
    ), grams as (
        select lang, size, unnest(list_transform(range(1, len(ws) - size + 2), lambda i: ws[i:i + size - 1])) as ws
        from w, (select unnest(range(1, 5)) as size)
    ), f as materialized (
        select lang, ws, count(*) as f from grams group by all having count(*) >= 30
    ), c as (
        select lang, ws, f as a from f where len(ws) > 1
    ), cuts as (
        select c.lang, c.ws, a, k, l.f as l, r.f as r, (2000000::hugeint * a // (l.f + r.f))::bigint as score
        from (select *, unnest(range(1, len(ws))) as k from c) c
        join f l on l.lang = c.lang and l.ws = c.ws[1:k] join f r on r.lang = c.lang and r.ws = c.ws[k + 1:]
    ), best as (
        select * from cuts qualify row_number() over (partition by lang, ws order by score, k) = 1
    ), parts as (
        select lang, a, unnest(list_filter(flatten(list_transform(range(1, len(ws)),
            lambda i: list_transform(range(i + 1, len(ws) + 1), lambda j: ws[i:j]))), lambda x: len(x) < len(ws))) as ws
        from c where len(ws) > 2
    ), gone as (
        select c.lang, c.ws from c join parts p on p.lang = c.lang and p.ws = c.ws group by c.lang, c.ws, c.a having 100 * max(p.a) >= 80 * c.a
    ), ranked as (
        select lang, array_to_string(ws, ' ') as phrase, a, l, r, score from best anti join gone using (lang, ws)
    )
    select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
    from ranked join n using (lang) qualify rank <= 2000
    """
)
def op11_collocations(spark, folder):
    return collocations.collocations(table(spark, folder, "documents"))
