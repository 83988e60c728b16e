"""SQL for the queries of book_queries, in DuckDB's dialect; the patterns that dress the tables' lines are VALUES."""

from __future__ import annotations

from . import profiles as P
from . import samples as S
from .functions.text import STOP
from .operators import pages
from .oracles import _DOC_WORDS, _ITEM_WORDS, _SCORES, _gate, _marks, _search, _strip
from .oracles import _LINES as _DOC_LINES
from .oracles import _passing
from .oracles import _words as _doc_words


def _literal(x) -> str:
    if x is None:
        return "null"
    if isinstance(x, str):
        return "'" + x.replace("'", "''") + "'"
    if isinstance(x, tuple):
        return "{'cls': " + _literal(x[0]) + ", 'text': " + _literal(x[1]) + "}"
    if isinstance(x, list):
        return "[" + ", ".join(map(_literal, x)) + "]" if x else "[]::varchar[]"
    return str(x)


def _values(rows: list, columns: str, numbered: bool = False) -> str:
    rows = [r if isinstance(r, tuple) else (r,) for r in rows]
    rows = [(i, *r) for i, r in enumerate(rows)] if numbered else rows
    return f"(values {', '.join('(' + ', '.join(map(_literal, r)) + ')' for r in rows)}) t({'ix, ' if numbered else ''}{columns})"


def _pattern(p: str) -> str:
    return "'" + _marks(p).replace("'", "''") + "'"


def _digits(x: str) -> str:
    return f"translate({x}, '{P.ARABIC_DIGITS}', '{P.ASCII_DIGITS}')"


def _number(x: str, pattern: str) -> str:
    return f"nullif({_digits(f'regexp_extract({x}, {_pattern(pattern)}, 1)')}, '')::int"


def _starts(x: str, words) -> str:
    return "(" + " or ".join(f"starts_with({x}, '{w}')" for w in words) + ")"


def _bracket(x: str) -> str:
    bare = f"regexp_replace({_strip(x)}, {_pattern(P.MARKS_BRACKET)}, '', 'g')"
    return _number(bare, P.BRACKET_NUMBER)


_PAGE = P.PageProfile()
_N = len(S.PARAGRAPHS)
_RUNS = f"""select (doc_id % 50)::int as book_id, doc_id as page, line_ix::int as para_ix, case when (doc_id + line_ix) // {_N} % 2 = 0 then list_append(runs, {{'cls': '', 'text': ' ' || line}}) else runs end as runs
    from ({_DOC_LINES}) join {_values([(r,) for *_, r in S.PARAGRAPHS], 'runs', True)} on ix = (doc_id + line_ix) % {_N}"""
_PARAGRAPHS = f"(select *, array_to_string(list_transform(runs, lambda r: r.text), '') as text from ({_RUNS}))"
_CHAPTER = [*P.CHAPTER_STARTS, *(P.AND + w for w in P.CHAPTER_STARTS)]
_HEADER_NUMBER = f"case when regexp_matches(regexp_extract(s, {_pattern(P.HEADER_NUMBER)}, 2), {_pattern(P.HEADER_REST)}) then {_number('s', P.HEADER_NUMBER)} end"
_FORMULA = f"(length(s) > 60 and regexp_matches(s, {_pattern(P.OPENING_FORMULA)}))"


def _cut(rows: str, clean: bool = True, drop: str = "", joint: str = "'|'") -> str:
    """Segments of rows (book_id, page, para_ix, sub, begins, hdr_num, header, part)."""
    part = _strip("part") if clean else "part"
    keep = f"part is not null and {part} not in ('', '{drop}')" if clean else "part is not null"
    return f"""with r as ({rows}), i as (select *, count(*) filter (begins) over (partition by book_id order by page, para_ix, sub rows unbounded preceding) seg_ix from r)
        select book_id, seg_ix::int as seg_ix, max(case when begins then hdr_num end)::int as hdr_num, max(case when begins then header end) as header,
            coalesce(array_to_string(list({part} order by page, para_ix, sub) filter ({keep}), {joint}), '') as parts, max(case when begins then page end) as page
        from i where seg_ix > 0 group by book_id, seg_ix"""


def _markers(after: bool, joint: str = "'|'") -> str:
    chars = 500 if after else 400
    join = lambda part: f"array_to_string(list_transform({part}, lambda r: r.text), '')"
    numbers = f"""select *, list_transform(runs, lambda r: case when r.cls = 'c4' then {_bracket('r.text')} end) n from {_PARAGRAPHS}"""
    at = f"select *, coalesce(list_position(list_transform(n, lambda x: x is not null), true), 0) as k from ({numbers})"
    split = f"select *, n[k] as num, {join('runs[1:k - 1]')} as before, {join('runs[k + 1:]')} as behind from ({at}) where k > 0"
    left = "" if after else f" union all select book_id, page, para_ix, 0, false, null, null, before from m where {_strip('before')} <> ''"
    rows = f"""select * from (with a as ({at}), m as ({split}) select book_id, page, para_ix, 0 as sub, false as begins, null::int as hdr_num, null::varchar as header, text as part from a where k = 0{left}
        union all select book_id, page, para_ix, 1, true, num, ({'before' if after else 'behind'})[1:{chars}], behind from m)"""
    return _cut(rows, drop=P.RULE_PART, joint=joint)


_USABLE = lambda ws: f"list_distinct(list_filter({ws}, lambda w: length(w) >= 4 and not list_contains([{', '.join(map(_literal, STOP))}], w)))"
_HALF = lambda l: f"case when len({l}) > 30 then {l}[len({l}) // 2 + 1:] else {l} end"
_IN_TEXT = f"list_filter(string_split({_search('text')}, ' '), lambda w: w <> '')"


def _anchors() -> str:
    found = lambda name: f"list_filter({name}, lambda h: h.p >= low and h.p < high)"
    at = lambda name: f"coalesce(list_max(list_transform(list_filter({name}, lambda h: h.p = page), lambda h: h.h)), 0)"
    return f"""with recursive g as (select source, row_number() over (partition by source order by doc_id) - 1 as page, w from (select source, documents.doc_id, d.w from documents join {_DOC_WORDS} d using (doc_id))),
        z as (select source, count(*) - 1 as stop from g group by source), w as (select source, page, unnest(w) word from g), df as (select source, word, count(*) df from w group by all),
        it as (select item_id, item_id // 20 as chapter, {_USABLE('ws[1:22]')} head, {_USABLE(_HALF('ws'))} tail from (select item_id, {_IN_TEXT} ws from benchmark)),
        hd as (select source, item_id, word from (select item_id, unnest(head) word from it) join df using (word)),
        tl as (select source, item_id, word from (select source, item_id, word, row_number() over (partition by source, item_id order by df, word) k from (select item_id, unnest(tail) word from it) join df using (word) where df <= 25) where k <= 6),
        hh as (select source, item_id, list({{'p': page, 'h': h}} order by page) l from (select source, item_id, page, count(*) h from hd join w using (source, word) group by all) group by all),
        th as (select source, item_id, list({{'p': page, 'h': h}} order by page) l from (select source, item_id, page, count(*) h from tl join w using (source, word) group by all) group by all),
        u as (select z.source, it.chapter, it.item_id, row_number() over c - 1 as k, stop, coalesce(a.n, 0) n_head, coalesce(b.n, 0) n_rare, coalesce(hh.l, []) hs, coalesce(th.l, []) rs, count(*) over (partition by z.source, it.chapter) n
            from it cross join z left join (select source, item_id, count(*) n from hd group by all) a on a.source = z.source and a.item_id = it.item_id left join (select source, item_id, count(*) n from tl group by all) b on b.source = z.source and b.item_id = it.item_id
            left join hh on hh.source = z.source and hh.item_id = it.item_id left join th on th.source = z.source and th.item_id = it.item_id window c as (partition by z.source, it.chapter order by it.item_id)),
        f as (select distinct source, chapter, -1::bigint as k, 0::bigint as pointer, null::bigint as num, null::bigint as page from u union all
        select source, chapter, k, case when ok then greatest(pointer, page) else pointer end, item_id, case when ok then page end from (
        select *, page is not null and ({at('hi')} >= 4 or {at('ri')} >= 2) as ok from (
        select *, coalesce(opening, case when n_rare >= 2 then list_min(list_transform(list_filter(ri, lambda h: h.h >= least(2, n_rare - 1)), lambda h: h.p)) end) as page from (
        select *, case when n_head >= 5 and len(o) > 0 and -o[1].n >= 5 and -o[1].n / n_head >= 0.35 and -o[1].n + coalesce(o[2].n, 0) >= 2 then o[1].p end as opening from (
        select *, list_sort(list_transform(hi, lambda h: {{'n': -h.h, 'p': h.p}})) as o from (
        select *, {found('hs')} as hi, {found('rs')} as ri from (
        select * exclude (high), case when low >= high then least(stop + 1, low + 12) else high end as high from (
        select *, greatest(0, least(pointer, place + 10) - 2) as low, least(stop, place + greatest(12, (stop + 1) // n + 15)) + 1 as high from (
        select u.*, f.pointer, floor(u.k * greatest(1, stop + 1) / n)::bigint as place from f join u on u.source = f.source and u.chapter = f.chapter and u.k = f.k + 1)))))))))
        select source as book_id, num, page as page_ix from f where page is not null"""


def _contained() -> str:
    html = "html"
    for plain, styled in S.STYLES:
        html = f"replace({html}, '{plain}', '{styled}')"
    opened = f"replace({html}, '<article>', '{S.CONTAINER}')"
    closed, left_open = f"replace({opened}, '</article>', '{S.CLOSED}')", f"replace({opened}, '</article>', '{S.LEFT_OPEN}')"
    return f"select page_id, case page_id % 5 when 0 then {closed} when 1 then {left_open} when 2 then {html} when 3 then '{S.CHALLENGE}' || {closed} end as html from pages"


def _entities() -> str:
    """Pieces behind an ampersand, joined with the named characters."""
    dressed = f"join {_values(S.REFERENCES_IN_TEXT, 'tail', True)} on ix = id % {len(S.REFERENCES_IN_TEXT)}"
    odd = " ".join(f"when {n} then chr({ord(c)})" for n, c in pages.odd_numbers().items())
    digits = "regexp_replace(case when x then regexp_extract(num, '^#[xX]([0-9a-fA-F]+)', 1) else regexp_extract(num, '^#([0-9]+)', 1) end, '^0+', '')"
    value = "case when length(d) > case when x then 6 else 7 end then 1114112 when d = '' then 0 when x then ('0x' || d)::bigint else d::bigint end"
    none = "n between 1 and 8 or n = 11 or n between 14 and 31 or n between 127 and 159 or n between 64976 and 65007 or n & 65534 = 65534"
    return f"""with t as (select kind, id, text || ' ' || tail as s from (select 'page' as kind, page_id as id, html as text from pages union all select 'document', doc_id, text from documents) {dressed}),
        e as (select * from {_values(list(pages.entity_names().items()), 'name, c')}),
        p as (select kind, id, i, string_split(s, '&')[i] as p from t, unnest(range(1, len(string_split(s, '&')) + 1)) u(i)),
        q as (select *, regexp_extract(p, '{pages.NUMBER}', 0) num, regexp_extract(p, {_pattern(pages.NAME)}, 0) nam, regexp_extract(p, {_pattern(pages.NAME)}, 0) as whole from p),
        r as (select *, regexp_extract(whole, '{pages.open_names()}', 0) pre, regexp_matches(num, '^#[xX]') x from q), v as (select *, {digits} as d from r), w as (select *, {value} as n from v),
        c as (select kind, id, i, case when i = 1 then p when num <> '' then (case n {odd} else case when n between 55296 and 57343 or n > 1114111 then chr(65533) when {none} then '' else chr(n::int) end end) || substr(p, length(num) + 1)
            when a.c is not null then a.c || substr(p, length(nam) + 1) when b.c is not null then b.c || substr(p, length(pre) + 1) else '&' || p end as out from w left join e a on a.name = nam left join e b on b.name = pre)
        select kind, id, length(string_agg(out, '' order by i))::int as n_chars, sha256(string_agg(out, '' order by i)) as text_sha256 from c group by kind, id"""


def _pairing() -> str:
    start = "(?s)^(.*?)(?:" + P.COMMENT_START + ")"
    quoted = lambda marks, x: f"'{marks[0]}' || {x} || '{marks[1]}'"
    sharh = f"""select a.doc_id as num, case when a.doc_id % 5 <= 1 then {quoted(S.QUOTE_OWN, "substr(a.text, 11, 60)")} when a.doc_id % 5 = 2 then {quoted(S.QUOTE_NEXT, "coalesce(substr(b.text, 21, 60), '')")}
        when a.doc_id % 5 = 3 then '{S.QUOTE_NARRATION}' else '' end || ' ' || substr(a.text, 1, 20) as sharh from documents a left join documents b on b.doc_id = a.doc_id + 1"""
    skip = f"length(regexp_extract(sharh[1:1200], '{start}', 1))"
    part = f"case when regexp_matches(sharh[1:1200], '{P.COMMENT_START}') then substr(sharh, {skip} + 1, 3000) else sharh[1:3000] end"
    listed = f"list_filter(list_transform(regexp_extract_all({part}, {_pattern(P.FRAGMENT)}, 1), lambda x: {_gate('x')}), lambda x: length(x) >= 18)[1:4]"
    return f"""with q as (select num, {listed} fs from ({sharh})), u as (select doc_id as num, {_gate('text')} form from documents),
        fr as (select num, unnest(fs) f from q), own as (select distinct num from fr join u using (num) where contains(form, f)),
        bad as (select distinct fr.num from fr join u on u.num <> fr.num and contains(form, f) where fr.num not in (select num from own) and not regexp_matches(f, {_pattern(P.NARRATION_FRAGMENT)})),
        c as (select (select count(*) from own) verified, (select count(*) from bad) wrong, (select count(*) from q) n)
        select verified, wrong, n - verified - wrong as undecided, case when verified + wrong > 0 then verified / (verified + wrong) else 1.0 end::double as rate,
            case when verified + wrong > 0 then verified / (verified + wrong) else 1.0 end >= 0.85 and wrong <= 0.05 * n as ok from c"""


_TITLES = f"""with recursive p as (select book_id, page_ix, i as line_ix, string_split(text, chr(10))[i] as line from (select (doc_id % 50)::int as book_id, (doc_id // 50)::int as page_ix, t.text || chr(10) || d.text as text from documents d join {_values([t for *_, t in S.TITLE_PAGES], 'text', True)} on ix = (doc_id % 50 + doc_id // 50) % {len(S.TITLE_PAGES)}), unnest(range(1, len(string_split(text, chr(10))) + 1)) l(i)),
    c as (select book_id, page_ix, line_ix, i as piece_ix, regexp_split_to_array(line, '[()]')[i] as piece from p, unnest(range(1, len(regexp_split_to_array(line, '[()]')) + 1)) l(i)),
    t as (select *, {_search('piece')} as form, trim(piece, '()[]،,. ') as title from c),
    k as (select book_id, page_ix, form, title, {_search('title')} as title_form, row_number() over (partition by book_id order by page_ix, line_ix, piece_ix) k from t where regexp_matches(form, {_pattern(P.CHAPTER_TITLE)}) and length(form) > 3 and length(form) < 90 and title <> ''),
    f as (select distinct book_id, 0::bigint k, null::varchar form, 0 page, 0 n, null::varchar title, null::int at_page from k union all
    select book_id, k, case when new then title_form else form end, case when new then page_ix else page end, n + new::int, case when new then title end, page_ix from (
    select k.book_id, k.k, k.page_ix, k.title, k.title_form, f.form, f.page, f.n, not (f.form is not distinct from k.form and k.page_ix - f.page < 4) as new from f join k on k.book_id = f.book_id and k.k = f.k + 1))
    select book_id, at_page as page_ix, (n - 1)::int as header_ix, title from f where title is not null"""

def _chapter_book() -> str:
    titled = f"select (doc_id % 50)::int as book_id, doc_id // 50 as page, t.text || chr(10) || d.text as text from documents d join {_values([t for *_, t in S.TITLE_PAGES], 'text', True)} on ix = (doc_id % 50 + doc_id // 50) % {len(S.TITLE_PAGES)}"
    title_words = lambda x: _doc_words(x, 1, [P.TITLE_STOP])
    found = lambda name: f"list_filter({name}, lambda h: h.p >= low and h.p < high)"
    at = lambda name: f"coalesce(list_max(list_transform(list_filter({name}, lambda h: h.p = page), lambda h: h.h)), 0)"
    hits = lambda rows: f"select book_id, ix, list({{'p': page, 'h': h}} order by page) l from (select book_id, ix, page, count(*) h from {rows} join wd using (book_id, word) group by all) group by all"
    return f"""with recursive hd0 as ({_TITLES}), pg as ({titled}), wd as (select book_id, page, unnest({_doc_words('text')}) word from pg), la as (select book_id, max(page) last_page from pg group by book_id),
        ch as (select book_id, i::int as chapter, {_literal(S.CHAPTERS)}[i] as title from (select distinct book_id from pg), unnest(range(1, {len(S.CHAPTERS) + 1})) l(i)),
        tw as (select book_id, chapter, unnest({title_words('title')}) word from ch), hw as (select book_id, header_ix, page_ix, unnest({title_words('title')}) word from hd0),
        mt as (select * from (select *, row_number() over (partition by book_id, chapter order by n desc, header_ix) r from (select book_id, chapter, header_ix, page_ix, count(*) n from tw join hw using (book_id, word) group by all)) where r = 1),
        rg as (select mt.book_id, chapter, mt.page_ix as start, min(b.page_ix) - 1 as stop from mt left join hd0 b on b.book_id = mt.book_id and b.page_ix > mt.page_ix + 1 group by all),
        kn as (select ch.book_id, ch.chapter, start, case when start is not null then coalesce(stop, last_page) end as stop, last_page from ch left join rg using (book_id, chapter) join la using (book_id)),
        fi as (select book_id, chapter, start is null as filled, coalesce(start, last_value(stop ignore nulls) over (partition by book_id order by chapter rows between unbounded preceding and 1 preceding) + 1, 0) as start,
            case when start is not null then stop else coalesce(first_value(start ignore nulls) over (partition by book_id order by chapter rows between 1 following and unbounded following) - 1, last_page) end as stop from kn),
        un as (select d.*, start, stop from (select (doc_id % 50)::int as book_id, doc_id // 50 as ix, 1 + doc_id // 250 % 4 as chapter, {_IN_TEXT} ws from documents) d join fi using (book_id, chapter) where not filled or start <= stop),
        df as (select book_id, word, count(*) df from wd group by all),
        hd as (select book_id, ix, word from (select book_id, ix, unnest({_USABLE('ws[1:22]')}) word from un) join df using (book_id, word)),
        tl as (select book_id, ix, word from (select book_id, ix, word, row_number() over (partition by book_id, ix order by df, word) r from (select book_id, ix, unnest({_USABLE(_HALF('ws'))}) word from un) join df using (book_id, word) where df <= 25) where r <= 6),
        hh as ({hits('hd')}), th as ({hits('tl')}),
        u as (select un.book_id, un.chapter, un.ix, start, stop, row_number() over c - 1 as k, count(*) over (partition by un.book_id, un.chapter) n, coalesce(a.n, 0) n_head, coalesce(b.n, 0) n_rare, coalesce(hh.l, []) hs, coalesce(th.l, []) rs
            from un left join (select book_id, ix, count(*) n from hd group by all) a using (book_id, ix) left join (select book_id, ix, count(*) n from tl group by all) b using (book_id, ix)
            left join hh using (book_id, ix) left join th using (book_id, ix) window c as (partition by un.book_id, un.chapter order by un.ix)),
        f as (select distinct book_id, chapter, -1::bigint as k, start::bigint as pointer, null::bigint as ix, null::bigint as page from u union all
        select book_id, chapter, k, case when ok then greatest(pointer, page) else pointer end, ix, case when ok then page end from (
        select *, page is not null and ({at('hi')} >= 4 or {at('ri')} >= 2) as ok from (
        select *, coalesce(opening, case when n_rare >= 2 then list_min(list_transform(list_filter(ri, lambda h: h.h >= least(2, n_rare - 1)), lambda h: h.p)) end) as page from (
        select *, case when n_head >= 5 and len(o) > 0 and -o[1].n >= 5 and -o[1].n / n_head >= 0.35 and -o[1].n + coalesce(o[2].n, 0) >= 2 then o[1].p end as opening from (
        select *, list_sort(list_transform(hi, lambda h: {{'n': -h.h, 'p': h.p}})) as o from (
        select *, {found('hs')} as hi, {found('rs')} as ri from (
        select * exclude (high), case when low >= high then least(stop + 1, low + 12) else high end as high from (
        select *, greatest(start, least(pointer, place + 10) - 2) as low, least(stop, place + greatest(12, span // n + 15)) + 1 as high from (
        select u.*, f.pointer, greatest(1, stop - start + 1) as span, start + floor(u.k * greatest(1, stop - start + 1) / n)::bigint as place from f join u on u.book_id = f.book_id and u.chapter = f.chapter and u.k = f.k + 1))))))))),
        an as (select f.book_id, ix, page, last_page, lead(page) over (partition by f.book_id order by ix) as nx from f join la using (book_id) where page is not null),
        sp as (select book_id, ix, page as low, least(page + 25, case when coalesce(nx, least(last_page, page + 6)) <= page then least(last_page, page + 1) else coalesce(nx, least(last_page, page + 6)) end) as high from an),
        tx as (select sp.book_id, ix, {_strip("string_agg(pg.text, chr(10) || chr(10) order by pg.page)")} as sharh from sp join pg on pg.book_id = sp.book_id and pg.page between low and high group by sp.book_id, ix)
        select book_id, (ix + 1)::int as num, length(sharh)::int as n_chars, sha256(sharh) as sharh_sha256 from tx where length(sharh) >= 250"""


_M = len(S.NUMBER_LINES)
_LINES = f"""(select *, {_search('text')} as s from (select doc_id, line_ix::int as line_ix, case when (doc_id + line_ix) // {_M} % 2 = 0 then text || ' ' || line else text end as text from ({_DOC_LINES}) join {_values(S.NUMBER_LINES, 'text', True)} on ix = (doc_id + line_ix) % {_M}))"""
_REST = f"case when {_number('s', P.NUMBER_PREFIX)} is not null then regexp_extract(s, {_pattern(P.NUMBER_PREFIX)}, 2) end"
_WITH_SEARCH = f"(select *, {_search('text')} as s from {_PARAGRAPHS})"
_NUMBERED = f"""select book_id, page, para_ix, 0 as sub, heads or marker is not null as begins, coalesce(marker, number) as hdr_num, case when heads then text else '' end as header, case when not heads then text end as part from (
    select *, marker is null and number is not null and ({_starts('rest', P.NARRATION_STARTS)} or length(text) < 900) as heads from (
    select * exclude (rest), {_search('rest')} as rest from (select *, {_number('s', P.UNIT_MARKER)} as marker, {_number('s', P.NUMBER_PREFIX)} as number, {_REST} as rest from {_WITH_SEARCH}))
    where not (marker is null and number is not null and coalesce({_starts('rest', _CHAPTER)}, false)))"""


def _marker_book(forced: bool) -> str:
    """Parts are joined by a character that no text has."""
    rule = " or ".join(f"(best >= {b} and best / greatest(1, n) >= {r} and best - second >= {m})" for b, r, m in P.MARKER_GLOBAL)
    parts = "string_split(parts, chr(30))"
    total = f"list_sum(list_transform({parts}, lambda x: length(x)))"
    words = lambda x: f"case when {total} > 60000 then [] else {_doc_words(x)} end"
    return f"""with g as (select *, replace(parts, chr(30), chr(10) || chr(10)) as sharh from ({_markers(False, 'chr(30)')})),
        s as (select book_id, row_number() over (partition by book_id order by seg_ix) - 1 as seg, hdr_num, sharh, {words("header")} as head, {words("header || ' ' || substr(replace(parts, chr(30), ' '), 1, 2000)")} as body from g),
        u as (select (doc_id % 50)::int as book_id, doc_id // 50 as ix, (doc_id // 50 + 1)::int as num, {_doc_words('text')} as w from documents),
        f as (select book_id, hdr_num as num, min(seg) as seg from s where hdr_num is not null group by all),
        m as (select u.book_id, u.w, h.head v, len(list_intersect(u.w, h.head)) i, len(u.w) n from u left join (select f.book_id, f.num, s.head from f join s using (book_id, seg)) h using (book_id, num) where ix < 1500),
        c as (select book_id, count(*) filter (v is not null and (i >= 4 or (n > 0 and i / n >= 0.2) or (i >= 3 and n >= 15))) agree, count(*) filter (v is not null) known from m group by book_id),
        sure as (select book_id from c where {forced} or agree > 0.6 * greatest(1, known)),
        k as (select u.book_id, u.num, f.seg, f.num - u.num as o, len(list_intersect(u.w, s.body)) as p from u join sure using (book_id) join f on f.book_id = u.book_id and f.num between u.num - 1 and u.num + 1 join s on s.book_id = f.book_id and s.seg = f.seg),
        dr as (select book_id, num, seg from (select *, row_number() over (partition by book_id, num order by case when p >= 3 then p else 0 end desc, o) r from k) where r = 1 and p >= 3),
        rest as (select u.* from u left join dr using (book_id, num) where dr.seg is null),
        sc as (select book_id, ix, seg, count(*) p from (select book_id, ix, unnest(w) x from rest) join (select book_id, seg, unnest(head) x from s) using (book_id, x) group by all),
        rk as (select *, row_number() over (partition by book_id, ix order by p desc, seg) r from sc),
        top as (select a.book_id, a.ix, a.seg, a.p best, coalesce(b.p, 0) as second from rk a left join rk b on b.book_id = a.book_id and b.ix = a.ix and b.r = 2 where a.r = 1),
        gl as (select book_id, num, seg from (select top.*, rest.num, len(rest.w) n from top join rest using (book_id, ix)) where {rule}),
        al as (select * from gl union all select * from dr)
        select book_id, num, length({_strip('sharh')})::int as n_chars, sha256({_strip('sharh')}) as sharh_sha256 from al join s using (book_id, seg) where length(sharh) >= 60"""


def _limits() -> str:
    one = lambda b: f"select '{b.slug}' as slug, count(*) as n, sum(length(sharh))::bigint as n_chars from t where length(sharh) >= {b.least_text}" + (f" and length(sharh) <= {b.most_text}" if b.most_text else "")
    return "with t as (select case when doc_id % 4 = 0 then substr(text, 1, (doc_id % 300)::int) else repeat(text, (1 + doc_id % 9)::int) end as sharh from documents) " + " union all ".join(map(one, P.BOOKS.values()))


def _numbered_book() -> str:
    cut = _NUMBERED.replace("as part from (", f"as part, case when heads then {_starts('rest', P.NARRATION_STARTS)} end as narr from (", 1)
    text = _strip(f"regexp_replace(regexp_replace(array_to_string(list_filter(parts, lambda x: {_strip('x')} <> ''), chr(10) || chr(10)), {_pattern(P.LEAD_MARKER)}, ''), {_pattern(P.RULE_LINE)}, chr(10) || chr(10), 'g')")
    listed = f"list_transform(list_filter(regexp_split_to_array(regexp_extract(array_to_string(list_concat([header], parts[1:2]), chr(10)), {_pattern(P.CROSS_REFERENCE)}, 1), '[،,\\s]+'), lambda x: x <> ''), lambda x: {_digits('x')}::int)"
    points = lambda x: f"list_transform({x}, lambda y: y.p)"
    relaxed = " or ".join(f"(best >= {b} and best / greatest(1, n) >= {r})" for b, r, _ in P.RELAXED_FILL)
    return f"""with recursive i as (select *, count(*) filter (begins) over (partition by book_id order by page, para_ix rows unbounded preceding) seg from ({cut})),
        s0 as (select book_id, seg, max(case when begins then hdr_num end) num, max(case when begins then header end) header, coalesce(list(part order by page, para_ix) filter (part is not null), []) parts, bool_or(case when begins then narr end) narr from i where seg > 0 group by book_id, seg),
        k as (select *, row_number() over (partition by book_id order by seg) k, coalesce(narr, false) or coalesce(header, '') = '' as forced from s0),
        f as (select distinct book_id, 0::bigint k, 0 as last, null::bigint as seg, false as ok from k union all
            select book_id, k, case when ok then num else last end, seg, ok from (select k.*, f.last, forced or (abs(num - f.last) <= 60 and num >= f.last - 5) as ok from f join k on k.book_id = f.book_id and k.k = f.k + 1)),
        kept as (select s0.*, num is distinct from lag(num) over (partition by book_id order by seg) as begins from s0 join f using (book_id, seg) where ok),
        run as (select *, count(*) filter (begins) over (partition by book_id order by seg rows unbounded preceding) r from kept),
        m as (select book_id, min(seg) seg, min(num) num, coalesce(arg_min(header, seg) filter (header <> ''), '') header, flatten(list(parts order by seg)) parts from run group by book_id, r),
        s as (select book_id, row_number() over (partition by book_id order by seg) - 1 as seg, num, header, parts, {text} as sharh, {_doc_words('header')} as head from m where header <> '' or coalesce(num, 0) <> 0),
        u as (select (doc_id % 50)::int as book_id, doc_id // 50 as ix, (doc_id // 50 + 1)::int as num, {_doc_words('text')} as w from documents),
        d as (select book_id, num, min(seg) as seg from s group by all),
        sw as (select book_id, seg, unnest(head) x from s), sc as (select book_id, ix, seg, count(*) p from (select book_id, ix, unnest(w) x from u) join sw using (book_id, x) group by all),
        li as (select book_id, ix, list({{'s': seg, 'p': p}} order by seg) l from sc group by all),
        z as (select u.book_id, row_number() over (partition by u.book_id order by u.ix) k, u.num, len(w) n_words, d.seg as direct, coalesce(l, []) l from u left join d on d.book_id = u.book_id and d.num = u.num left join li on li.book_id = u.book_id and li.ix = u.ix where u.book_id in (select book_id from s)),
        wi as (select distinct book_id, 0::bigint k, 0::bigint pointer, null::int num, null::bigint pick from z union all
            select book_id, k, case when direct is null then coalesce(pick, pointer) else greatest(pointer, direct) end, num, pick from (
            select *, case when direct is null and len(seen) > 0 and {_passing(P.NUMBERED_WINDOW)} then c.s end as pick from (
            select *, c.p as best, coalesce(list_max({points("list_filter(seen, lambda x: not list_contains(list_transform(tied, lambda t: t.s), x.s))")}), 0) as second from (
            select *, list_sort(list_transform(tied, lambda x: {{'d': abs(x.s - greatest(pointer, num)), 's': x.s, 'p': x.p}}))[1] as c from (
            select *, case when len(high) > 0 then high else list_filter(seen, lambda x: x.p = top) end as tied from (
            select *, list_filter(seen, lambda x: x.p >= greatest(floor(0.88::double * top), 4)) as high from (
            select *, list_max({points("seen")}) as top from (
            select z.*, pointer, list_filter(l, lambda x: x.s >= pointer - 30 and x.s < pointer + 250) as seen from wi join z on z.book_id = wi.book_id and z.k = wi.k + 1)))))))),
        own as (select book_id, num, d.seg from d join u using (book_id, num) union all select book_id, num, pick from wi where pick is not null),
        en as (select book_id, o.num, sharh from own o join s using (book_id, seg) where length(sharh) >= 40),
        mi as (select u.* from u left join en using (book_id, num) where en.sharh is null), us as (select * from s where length(sharh) >= 40),
        ky as (select book_id, num as target, min(seg) seg from us group by all),
        ed as (select book_id, seg as spot, num as src, i as p, l[i] as dst from (select *, {listed} as l from s), unnest(range(1, len(l) + 1)) t(i)),
        fw as (select book_id, num, seg from (select mi.book_id, mi.num, ky.seg, row_number() over (partition by mi.book_id, mi.num order by spot, p) r from mi join ed on ed.book_id = mi.book_id and ed.src = mi.num join ky on ky.book_id = mi.book_id and ky.target = ed.dst) where r = 1),
        rv as (select book_id, num, seg from (select mi.book_id, mi.num, ky.seg, row_number() over (partition by mi.book_id, mi.num order by fi.spot) r from mi join ed on ed.book_id = mi.book_id and ed.dst = mi.num join ky on ky.book_id = mi.book_id and ky.target = ed.src
            join (select book_id, src, min(spot) as spot from ed group by all) fi on fi.book_id = ed.book_id and fi.src = ed.src) where r = 1),
        so as (select book_id, ix, seg, count(*) p from (select book_id, ix, unnest(w) x from mi) join (select book_id, seg, unnest(head) x from us) using (book_id, x) group by all),
        rl as (select book_id, num, seg from (select so.book_id, mi.num, so.seg, p as best, len(mi.w) n, row_number() over (partition by so.book_id, so.ix order by p desc, so.seg) r from so join mi on mi.book_id = so.book_id and mi.ix = so.ix) where r = 1 and ({relaxed})),
        al as (select *, 0 o from fw union all select *, 1 from rv union all select *, 2 from rl), ch as (select book_id, num, seg from (select *, row_number() over (partition by book_id, num order by o) r from al) where r = 1),
        fin as (select book_id, num, sharh from en union all select book_id, ch.num, sharh from ch join us using (book_id, seg))
        select book_id, num, length(sharh)::int as n_chars, sha256(sharh) as sharh_sha256 from fin"""


def _plain(begins: str, number: str, header: str, keep_head: bool) -> str:
    return _cut(f"select book_id, page, para_ix, 0 as sub, coalesce({begins}, false) as begins, {number} as hdr_num, {header} as header, case when {keep_head} or not coalesce({begins}, false) then text end as part from {_WITH_SEARCH}")


ORACLES = {
    "number_trust": f"""with g as (select source, row_number() over (partition by source order by documents.doc_id) - 1 as ix, d.w from documents join {_DOC_WORDS} d using (doc_id)),
        m as (select u.source, u.w, g.w as v, len(list_intersect(u.w, g.w)) i, len(u.w) n from g u left join g on g.source = u.source and g.ix = u.ix + case when length(u.source) % 2 = 0 then 1 else 0 end where u.ix < 1500),
        c as (select source as book_id, count(*) filter (v is not null and (i >= 4 or (n > 0 and i / n >= 0.2) or (i >= 3 and n >= 15))) agree, count(*) filter (v is not null) known, count(*) filter (v is null) missing from m group by source)
        select book_id, agree, known - agree as disagree, missing, agree > 0.6 * greatest(1, known) as trusted from c""",
    "words_needed": "select l_linenumber as book_id, count(*) as n_units, count(distinct l_partkey) as n_segs, case when count(*) > 5000 and count(distinct l_partkey) < 2500 then 1 else 3 end::int as need from lineitem group by l_linenumber",
    "entry_limits": _limits(),
    "marker_book": _marker_book(False),
    "chapter_book": _chapter_book(),
    "numbered_book": _numbered_book(),
    "forced_book": _marker_book(True),
    "lenient_text": "select doc_id, sha256(replace(text, chr(65533), '')) as text_sha256 from documents",
    "book_agreement": f"""with g as (select source, row_number() over (partition by source order by documents.doc_id) - 1 as num, d.w from documents join {_DOC_WORDS} d using (doc_id)),
        m as (select b.source, u.w, g.w as v, len(list_intersect(u.w, g.w)) i, len(u.w) n from {_ITEM_WORDS} u cross join (select distinct source from documents) b left join g on g.source = b.source and g.num = u.item_id where u.item_id < 1500),
        k as (select *, v is not null as known, i >= 4 or (n > 0 and i / n >= 0.2) or (i >= 3 and n >= 15) as same from m)
        select source as book_id, count(*) filter (known and same) as agree, count(*) filter (known and not same) as disagree, count(*) filter (not known) as missing from k group by source""",
    "fill_order": """with n as (select o_orderkey num from orders), us as (select p_partkey num from part where p_size >= 40), e as (select l_orderkey src, l_partkey dst, l_linenumber pos from lineitem),
        al as (select num, num target, 0 p from n where num in (select num from us) union all select num, num + 1, 1 from n where num + 1 in (select num from us)
        union all (select num, dst, 2 from (select n.num, dst, row_number() over (partition by n.num order by pos, dst) k from n join e on n.num = e.src where dst in (select num from us)) where k = 1)
        union all (select num, min(src), 3 from n join e on n.num = e.dst where src in (select num from us) group by num) union all select num, 0, 4 from n where num % 3 = 0)
        select num, target, priority from (select num, target, p::int as priority, row_number() over (partition by num order by p) k from al) where k = 1""",
    "number_parsers": f"""select doc_id, line_ix, {_number('s', P.NUMBER_PREFIX)} as number, {_REST} as rest, {_number('s', P.UNIT_MARKER)} as marker, {_bracket('text')} as bracket, {_HEADER_NUMBER} as header, {_FORMULA} as formula,
        {_starts('s', P.NARRATION_STARTS)} as narration, {_starts('s', _CHAPTER)} as chapter, regexp_matches(s, {_pattern(P.CHAPTER_TITLE)}) and length(s) > 3 and length(s) < 90 as title from {_LINES}""",
    "commentary_texts": f"""select doc_id, {_strip(f"regexp_replace(regexp_replace(array_to_string(list_filter(parts, lambda x: {_strip('x')} <> ''), chr(10) || chr(10)), {_pattern(P.LEAD_MARKER)}, ''), {_pattern(P.RULE_LINE)}, chr(10) || chr(10), 'g')")} as text,
        array_to_string(list_filter(list_transform(parts, lambda x: {_strip('x')}), lambda x: x not in ('', '{P.RULE_PART}')), '|') as cleaned from (select doc_id, list_concat(t.parts, string_split(text, chr(10))) as parts from documents join {_values([(c,) for c in S.COMMENTS], 'parts', True)} on ix = doc_id % {len(S.COMMENTS)})""",
    "cross_references": f"""select doc_id, array_to_string(list_transform(list_filter(regexp_split_to_array(regexp_extract(array_to_string(list_concat([header], parts[1:2]), chr(10)), {_pattern(P.CROSS_REFERENCE)}, 1), '[،,\\s]+'), lambda x: x <> ''), lambda x: {_digits('x')}::int), ',') as numbers
        from (select doc_id, header, list_concat(t.parts, string_split(text, chr(10))) as parts from documents join {_values(S.REFERENCES, 'header, parts', True)} on ix = doc_id % {len(S.REFERENCES)})""",
    "second_half": f"select item_id, array_to_string({_HALF('ws')}, ' ') as words from (select item_id, {_IN_TEXT} ws from benchmark)",
    "container_text": f"""with c as (select page_id as ix, case when html is null or contains(html[1:{_PAGE.challenge_chars}], '{_PAGE.challenge}') then null when regexp_matches(html, {_pattern(_PAGE.container)}) then regexp_extract(html, {_pattern(_PAGE.container)}, 1)
            when regexp_matches(html, {_pattern(_PAGE.open_container)}) then string_split(regexp_extract(html, {_pattern(_PAGE.open_container)}, 1), '{_PAGE.open_end}')[1] else '' end as body from ({_contained()})),
        p as (select ix, regexp_extract_all(body, {_pattern(_PAGE.paragraph)}, 1) ps from c),
        r as (select ix, i - 1 as para_ix, string_split(regexp_replace(ps[i], {_pattern(_PAGE.run)}, chr(1) || '\\1' || chr(2) || '\\2' || chr(1), 'g'), chr(1)) xs from p, unnest(range(1, len(ps) + 1)) u(i)),
        x as (select ix, para_ix, i as run_ix, case when contains(xs[i], chr(2)) and split_part(xs[i], chr(2), 1) <> 'anchor' then split_part(xs[i], chr(2), 1) else '' end as cls,
            {_strip("replace(regexp_replace(case when contains(xs[i], chr(2)) then split_part(xs[i], chr(2), 2) else xs[i] end, '<[^>]+>', '', 'g'), '&amp;', '&')")} as text from r, unnest(range(1, len(xs) + 1)) u(i)),
        a as (select ix, string_agg(para_ix || ':' || cls || ':' || text, '|' order by para_ix, run_ix) as runs from x where text <> '' group by ix)
        select p.ix as page_id, len(ps)::int as n_paragraphs, runs from p left join a on a.ix = p.ix""",
    "entity_text": _entities(),
    "base_book": f"""with u as (select doc_id::int as book_id, source, line_ix::int as unit_ix, line_ix::int + 1 as num, case when line_ix % 3 > 0 then line_ix % 3 else 1 end::int as chapter_id, line as text from ({_DOC_LINES}) join documents using (doc_id))
        select book_id, unit_ix, num, chapter_id, text, source || ' ' || chapter_id as title from u""",
    "numbered_segments": _cut(_NUMBERED, clean=False),
    "header_segments": _plain(f"({_HEADER_NUMBER}) is not null", _HEADER_NUMBER, "text[1:400]", False),
    "formula_segments": _plain(_FORMULA, "null::int", "text[1:500]", True),
    "styled_segments": _plain(f"(runs[1].cls = 'c2' and length({_strip('runs[1].text')}) > 25)", "null::int", "(runs[1].text)[1:500]", True),
    "marker_segments": _markers(False),
    "marker_after_segments": _markers(True),
    "merged_segments": """with r as (select user_id book_id, event_id seg_ix, case when floor(value)::bigint % 4 <> 3 then (floor(value)::bigint % 4)::int end hdr_num, case when event_id % 3 = 0 then '' else event_type end header, event_type || event_id part, event_id // 100 as page from events),
        b as (select *, hdr_num is null or hdr_num is distinct from lag(hdr_num) over (partition by book_id order by seg_ix) as begins from r),
        i as (select *, count(*) filter (begins) over (partition by book_id order by seg_ix rows unbounded preceding) run from b),
        m as (select book_id, min(seg_ix) seg_ix, min(hdr_num) hdr_num, coalesce(arg_min(header, seg_ix) filter (header <> ''), '') as header, string_agg(part, '|' order by seg_ix) parts, arg_min(page, seg_ix) page from i group by book_id, run)
        select * from m where header <> '' or coalesce(hdr_num, 0) <> 0""",
    "chapter_titles": _TITLES,
    "relaxed_fill": f"""with {_SCORES}, z as (select top.*, len(w)::int n_words from top join {_ITEM_WORDS} using (item_id))
        select item_id, doc_id, best, n_words from z where (best >= 8 and best / greatest(1, n_words) >= 0.35) or (best >= 15 and best / greatest(1, n_words) >= 0.25)""",
    "suspects": f"select item_id, len(list_intersect(u.w, d.w))::int as shared from {_ITEM_WORDS} u join {_DOC_WORDS} d on u.item_id = d.doc_id where len(u.w) >= 10 and len(list_intersect(u.w, d.w)) < 4 and len(list_intersect(u.w, d.w)) < 0.15 * len(u.w)",
    "direct_verify": f"""with s as (select item_id, doc_id, (doc_id - item_id)::int as "offset", len(list_intersect(u.w, d.w))::int as score from {_ITEM_WORDS} u join {_DOC_WORDS} d on d.doc_id between u.item_id - 1 and u.item_id + 1)
        select item_id, doc_id, "offset", score from (select *, row_number() over (partition by item_id order by score desc, "offset") k from s where score >= 8) where k = 1""",
    "anchor_search": _anchors(),
    "gate_identical_pairs": f"""with f as (select slug, num, {_gate('text')} form from (select 'events' as slug, event_id as num, repeat('value ' || floor(value / 200)::bigint || ' ', case when event_type = 'click' then 5 else 12 end) as text from events))
        select a.slug, a.num, b.num as "next" from f a join f b on a.slug = b.slug and b.num = a.num + 1 and a.form = b.form where length(a.form) > 60 and (a.num, b.num) not in ({', '.join(map(str, P.IDENTICAL_ALLOWED))})""",
    "gate_spot_case": f"""select 'spot_case' as "check", 'all' as scope, 3::double as metric, 3::double as threshold, coalesce(contains(a, 'the') and a <> b, false) as ok
        from (select max(case when item_id = 3 then {_gate('text')} end) a, max(case when item_id = 4 then {_gate('text')} end) b from benchmark)""",
    "gate_pairing": _pairing(),
    "gate_unit_maxima": f"""with x as (select * from (values {', '.join(f"({i}, '{s}', {n}, {P.UNIT_TOLERANCE.get(s, 0)}, {s in P.UNORDERED_BOOKS})" for i, (s, n) in enumerate(P.UNIT_MAXIMA.items()))}) v(k, slug, m, t, free)),
        u as (select slug, m, t, (o_orderkey // {len(P.UNIT_MAXIMA)})::int num, o_orderpriority || ' ' || trunc(o_totalprice)::int as text from orders join x on k = o_orderkey % {len(P.UNIT_MAXIMA)} where o_orderkey // {len(P.UNIT_MAXIMA)} between 1 and m)
        select slug, count(*) as n, count(*) filter (length({_gate('text')}) < 10) as n_short, max(num) as max_num, 0::bigint as n_inversions, count(*) filter (length({_gate('text')}) < 10) = 0 and max(num) = m and count(*) >= m - t as ok from u group by slug, m, t""",
}
