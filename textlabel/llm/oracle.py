"""DuckDB SQL for the queries that SQL can express; the others are tested against brute force."""



def _moves() -> str:
    """Rows (state, initial, letters, cost, state after, roles inserted, new role) of the pattern (s?(ua)+)?: up to three insertions, then the
    edit of a turn; '-' is any other initial, '!' a turn that must go. States: 0 start, 1 s, 2 u, 3 a."""
    fits = {0: "u", 1: "u", 2: "a", 3: "u"}
    after = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    names = {"u": "user", "a": "assistant"}
    rows = []
    for start in range(4):
        state, inserted = start, []
        for n in range(4):
            for initial in "sua-!":
                some = [("D", 4, state, None)]
                if initial != "!":
                    some.append(("R", 3, after[state, fits[state]], names[fits[state]]))
                    if (state, initial) in after:
                        some.append(("K", 0, after[state, initial], ""))
                for letter, cost, to, role in some:
                    roles = "[" + ", ".join(f"'{r}:'" for r in inserted) + "]::varchar[]"
                    rows.append(f"({start}, '{initial}', '{'I' * n + letter}', {3 * n + cost}, {to}, {roles}, " + ("null" if role is None else f"'{role}'") + ")")
            inserted = [*inserted, names[fits[state]]]
            state = after[state, fits[state]]
    return ",\n            ".join(rows)


ORACLE_SQL = {
    "op2_url_filter": r"""
        with parts as (
            select page_id,
                   translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
            from pages),
        judged as (
            select *, case
                when ('.' || host) like '%.example.org' and starts_with(path, '/en/1') then 'example.org/en/1'
                when ('.' || host) like '%.example.org' and starts_with(path, '/es/') then 'example.org/es/'
                when ('.' || host) like '%.com' and starts_with(path, '/fr/') then 'com/fr/'
                when ('.' || host) like '%.com' and starts_with(path, '/de/') then 'com/de/'
                when ('.' || host) like '%.org' and starts_with(path, '/') then 'org/' end as rule
            from parts)
        select page_id, host, path, rule, case when rule in ('example.org/es/', 'example.org/en/1', 'com/de/') then 'block' else 'allow' end as verdict
        from judged""",
    "op8_top_k": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as q from embeddings
            where embedding is not null and len(embedding) > 0
              and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
        scored as (
            select a.vec_id as query_id, b.vec_id, list_inner_product(a.q, b.q)::bigint as score
            from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0),
        ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as r from scored)
        select query_id, r::int as rank, vec_id, score from ranked where r <= 5""",
    "op13_fill_middle": """
        with d as (
            select doc_id, coalesce(text, '') as text, sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents),
        e as (
            select *, length(text)::bigint as n, ('0x' || substr(h, 1, 8))::bigint as h1, ('0x' || substr(h, 9, 8))::bigint as h2,
                   ('0x' || substr(h, 17, 8))::bigint as h3, ('0x' || substr(h, 25, 8))::bigint as h4 from d),
        f as (
            select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
                   case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain'
                        when h4 % 100 < 20 then 'spm' else 'psm' end as form from e),
        g as (
            select *, substr(text, 1, a) as prefix, substr(text, a + 1, b - a) as middle, substr(text, b + 1) as suffix from f)
        select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
               sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                      else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
               sha256(text) as restored_sha256
        from g""",
    "op12_conversation_repair": r"""
        with recursive crc as (
            select list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
                   lambda c, z: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as tab),
        named as (
            select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
                   list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda x: ascii(x)::bigint) as b
            from conversations),
        kinds as (
            select conv_id, turn, role, text, xor(4294967295, list_reduce(list_concat([4294967295::bigint], b),
                   lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]))) % 20 as kind
            from named, crc),
        damaged as (
            select conv_id, turn, case when kind = 4 then 'user' else role end as role,
                   case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
                   unnest(case when kind = 3 then [0, 1] else [0] end) as copy
            from kinds where kind <> 0),
        placed as (
            select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text), copy) as i from damaged),
        seen as (
            select *, row_number() over (partition by conv_id, role, text order by i) > 1 as again,
                   not regexp_matches(text, '[^\x20\x09-\x0D]') as empty, not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') as open_end,
                   substr(role, 1, 1) as initial, lag(substr(role, 1, 1)) over (partition by conv_id order by i) as before from placed),
        marked as (
            select *, not empty and again as twice, not empty and not again and open_end as cut,
                   case when empty or again then '!' when initial in ('s', 'u', 'a') then initial else '-' end as symbol from seen),
        moves(state, symbol, letters, cost, after, inserted, new_role) as (values
            """ + _moves() + r"""),
        walk as (
            select conv_id, 0::bigint as i, 0 as state, 0::bigint as cost, '' as audit, []::varchar[] as lines from (select distinct conv_id from marked)
            union all
            select conv_id, i, state, cost, audit, lines from (
                select w.conv_id, m.i, v.after as state, w.cost + v.cost + case when m.cut and v.new_role is not null then 3 else 0 end as cost, w.audit || v.letters as audit,
                       list_concat(w.lines, v.inserted, case when v.new_role is null then [] when v.new_role = '' then [m.role || ':' || m.text] else [v.new_role || ':' || m.text] end) as lines,
                       row_number() over (partition by w.conv_id, v.after order by w.cost + v.cost + case when m.cut and v.new_role is not null then 3 else 0 end, w.audit || v.letters) as r
                from walk w join marked m on m.conv_id is not distinct from w.conv_id and m.i = w.i + 1 join moves v on v.state = w.state and v.symbol = m.symbol)
            where r = 1),
        sizes as (select conv_id, max(i) as n from marked group by conv_id),
        ended as (
            select w.conv_id, w.cost + case w.state when 1 then 6 when 2 then 3 else 0 end as cost, w.audit || case w.state when 1 then 'II' when 2 then 'I' else '' end as audit,
                   list_concat(w.lines, case w.state when 1 then ['user:', 'assistant:'] when 2 then ['assistant:'] else [] end) as lines
            from walk w join sizes s on w.conv_id is not distinct from s.conv_id and w.i = s.n),
        best as (select conv_id, cost, audit, lines from ended qualify row_number() over (partition by conv_id order by cost, audit) = 1),
        counts as (
            select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (empty) as blank, count(*) filter (twice) as duplicate,
                   count(*) filter (cut) as truncated, count(*) filter (before is not null and before || '>' || initial not in ('s>u', 'u>a', 'a>u')) as illegal
            from marked group by conv_id)
        select c.conv_id, coalesce(k.gaps, 0)::bigint as gaps, coalesce(k.blank, 0)::bigint as blank, coalesce(k.duplicate, 0)::bigint as duplicate,
               coalesce(k.truncated, 0)::bigint as truncated, coalesce(k.illegal, 0)::bigint as illegal, coalesce(b.cost, 0)::bigint as cost,
               coalesce(b.audit, '') as audit, sha256(coalesce(array_to_string(b.lines, chr(10)), '')) as repaired_sha256
        from (select distinct conv_id from conversations) c left join counts k on c.conv_id is not distinct from k.conv_id
             left join best b on c.conv_id is not distinct from b.conv_id""",
}
