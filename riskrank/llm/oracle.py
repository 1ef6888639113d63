"""SQL for DuckDB that gives the rows of the queries of this subpackage, where SQL can."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"

ORACLE = {
    "op2_window_dedup": r"""
        with w as (
            select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents
        ), windows as (
            select doc_id, i, row_number() over (partition by array_to_string(ws[i : i + 19], ' ')
                                                 order by doc_id, i) as nth
            from (select doc_id, ws, unnest(range(1, len(ws) - 18)) as i from w)
        ), gone as (
            select distinct doc_id, unnest(range(i, i + 20)) as p from windows where nth > 1
        ), words as (
            select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as p from w
        ), left_over as (
            select doc_id, string_agg(word, ' ' order by p) as kept, count(*) as n
            from words anti join gone using (doc_id, p) group by doc_id
        )
        select doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(n, 0))::bigint as n_removed,
               sha256(coalesce(kept, '')) as kept_sha256
        from w left join left_over using (doc_id)
    """,
    "op5_streaming_exact_dedup": f"""
        with t as (select doc_id, sha256({_LOWERED}) as text_sha256, {_LOWERED} as body from documents)
        select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
               doc_id = max(doc_id) over g as kept, text_sha256
        from t window g as (partition by body)
    """,
    "op10_url_trie": f"""
        with u as (
            select page_id, coalesce(url, '') as url, strpos(coalesce(url, ''), '://') as sign from pages
        ), r as (
            select page_id, case when sign > 0 then substr(url, sign + 3) else '' end as rest from u
        ), h as (
            select page_id, rest, regexp_extract(rest, '^[^/?#]*') as raw from r
        ), p as (
            select page_id, translate(raw, '{_UPPER}', '{_UPPER.lower()}') as host,
                   regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path
            from h
        ), rules(r_host, r_path, r_verdict) as (
            values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
                   ('org', '/fr/', 'allow')
        ), fits as (
            select page_id, host, path, r_host || r_path as rule, r_verdict,
                   row_number() over (partition by page_id order by length(r_host) + length(r_path) desc) as n
            from p left join rules on (host = r_host or host like '%.' || r_host) and starts_with(path, r_path)
        )
        select page_id, host, path, rule, coalesce(r_verdict, 'allow') as verdict from fits where n = 1
    """,
    "op12_conversation_trie": """
        with crc as (
            select list(list_reduce(list_prepend(i, range(8)), lambda a, b:
                case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) order by i) as tab
            from range(256) as t(i)
        ), turns as (
            select conv_id as c, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                                      order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as w
            from conversations where conv_id is not null group by conv_id
        ), taken as (
            select c, w, c - c % 5 as base, xor(4294967295, list_reduce(
                list_prepend(4294967295, list_transform(range(1, len(c::varchar) + 1), lambda k: ord((c::varchar)[k]))),
                lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1]))) % 9 as h
            from turns, crc
        ), rebuilt as (
            select t.c, list_concat(coalesce(b.w, [])[1 : h], t.w[h + 1 :]) as r from taken t left join turns b on b.c = base
        ), members as (
            select c, unnest(range(len(r) + 1)) as d, r from rebuilt
        ), nodes as (
            select d, r[1 : d] as prefix, min(c) as conv_id, count(*) as n_convs,
                   coalesce(strlen(any_value(r[d].text)), 0) as bytes,
                   coalesce(string_agg(c::varchar, ',' order by c) filter (d = len(r)), '') as ends
            from members group by d, r[1 : d]
        ), children as (
            select d - 1 as d, prefix[1 : d - 1] as prefix, count(*) as n_children from nodes where d > 0 group by all
        ), sized as (
            select n.*, coalesce(n_children, 0) as n_children from nodes n left join children using (d, prefix)
        ), below as (
            select n.d, n.prefix, count(*) filter (x.n_children = 0) as n_leaves, sum((x.n_convs - 1) * x.bytes) as saved
            from sized n join sized x on x.d >= n.d and x.prefix[1 : n.d] = n.prefix group by n.d, n.prefix
        )
        select n.conv_id, n.d as depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, n_leaves,
               saved::bigint as saved_tokens, sha256(n.ends) as ends_sha256
        from sized n join below using (d, prefix) left join nodes p on p.d = n.d - 1 and p.prefix = n.prefix[1 : n.d - 1]
    """,
    "op13_phrase_collocations": rf"""
        with pieces as (
            select coalesce(lang, 'und') as lang,
                   unnest(regexp_split_to_array({_LOWERED}, '[.,;:!?\x0A-\x0D]')) as piece
            from documents
        ), ws as (
            select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
        ), grams as (
            select lang, 1 as size, unnest(w) as phrase from ws
            union all
            select lang, 2, unnest(list_transform(range(1, len(w)), lambda i: array_to_string(w[i : i + 1], ' '))) from ws
            union all
            select lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' ')))
            from ws
        ), f as (
            select lang, size, phrase, count(*) as f from grams group by all
        ), sums as (
            select lang, sum(f)::bigint as n from f where size = 1 group by lang
        ), candidates as (
            select lang, size, phrase, f as a, string_split(phrase, ' ') as w from f where size > 1 and f >= 10
        ), inside as (
            select lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as phrase, a as longer
            from candidates where size = 3
        ), gone as (
            select distinct lang, phrase from candidates join inside using (lang, phrase) where 100 * longer >= 50 * a
        ), cuts as (
            select lang, phrase, a, k, array_to_string(w[1:k], ' ') as head, array_to_string(w[k + 1:], ' ') as tail
            from candidates join (values (1), (2)) as cut(k) on k < size anti join gone using (lang, phrase)
        ), scored as (
            select c.lang, c.phrase, a, h.f as l, t.f as r, k,
                   (1000000::hugeint * a * a) // (h.f::hugeint * t.f) as score
            from cuts c join f h on h.lang = c.lang and h.phrase = head
            join f t on t.lang = c.lang and t.phrase = tail
        ), lowest as (
            select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
        )
        select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r,
               n, score::bigint as score
        from lowest join sums using (lang) qualify rank <= 2000
    """,
}
