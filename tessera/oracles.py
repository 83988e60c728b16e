"""SQL for the registered queries, in DuckDB's dialect over the driver's tables."""

from __future__ import annotations

from . import profiles as P
from .functions.text import STOP

_WS = r"[\t-\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _marks(pattern: str) -> str:
    """\\uXXXX as \\x{XXXX}."""
    import re

    return re.sub(r"\\u([0-9A-F]{4})", r"\\x{\1}", pattern)


def _strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{_WS}+', ''), '{_WS}+$', '')"


def _search(x: str) -> str:
    bare = f"translate(regexp_replace(translate({x}, '{P.ARABIC_DIGITS}', '{P.ASCII_DIGITS}'), '{_marks(P.MARKS_SEARCH)}', '', 'g'), '{P.LETTERS_FROM}', '{P.LETTERS_TO}')"
    return f"trim(regexp_replace(regexp_replace({bare}, '{_marks(P.NOT_SEARCHABLE)}', ' ', 'g'), ' +', ' ', 'g'))"


def _gate(x: str) -> str:
    return f"regexp_replace(translate(regexp_replace({x}, '{_marks(P.MARKS_GATE)}', '', 'g'), '{P.GATE_LETTERS_FROM}', '{P.GATE_LETTERS_TO}'), '{_WS}+', ' ', 'g')"


def _words(x: str, least: int = 4, stop=STOP) -> str:
    listed = ", ".join(f"'{w}'" for w in stop)
    return f"list_distinct(list_filter(string_split({_search(x)}, ' '), lambda w: length(w) >= {least} and not list_contains([{listed}], w)))"


def _head(n: int) -> str:
    """The first n bytes; the test data's heads are ASCII where it matters."""
    return f"html[1:{n}]"


_STATUS = f"case when html is null then 'fail' when contains({_head(2000)}, 'Just a moment') or contains({_head(3000)}, 'challenges.cloudflare.com') then 'challenge' when strlen(html) > 2000 then 'ok' else 'small' end"


def _clean(x: str) -> str:
    bare = f"regexp_replace({x}, '<[^>]+>', '', 'g')"
    for name, character in (P.ARTICLE_PAGES.entities or {}).items():
        bare = f"replace({bare}, '{name}', '{character}')"
    for character in P.INVISIBLE:
        bare = f"replace({bare}, chr({ord(character)}), '')"
    return _strip(bare)


_BODIES = """select page_id, i - 1 as para_ix, l[i] as body from (
    select page_id, regexp_extract_all(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '(?s)<p>(.*?)</p>', 1) l from pages
    where not contains(html[1:3000], 'Just a moment')) t, unnest(range(1, len(l) + 1)) u(i)"""
_PARAGRAPHS = f"select page_id, para_ix::int as para_ix, text from (select page_id, para_ix, {_strip(f'replace({_clean("body")}, chr({ord(P.GLYPH_SPACE)}), chr(32))')} as text from ({_BODIES})) where text <> ''"
_DOC_WORDS = f"(select doc_id, {_words('text')} w from documents)"
_ITEM_WORDS = f"(select item_id, {_words('text')} w from benchmark)"
_LINES = "select doc_id, i - 1 as line_ix, l[i] as line from (select doc_id, string_split(text, chr(10)) l from documents) t, unnest(range(1, len(l) + 1)) u(i)"
_ISLANDS = f"select *, count(*) filter (length(line) < 120) over (partition by doc_id order by line_ix rows unbounded preceding) as seg_ix from ({_LINES})"
_SCORES = f"""u as (select item_id, unnest(w) word from {_ITEM_WORDS}), s as (select doc_id, unnest(w) word from {_DOC_WORDS}),
    sc as (select item_id, doc_id, count(*) score from u join s using (word) group by all),
    r as (select *, row_number() over (partition by item_id order by score desc, doc_id) k from sc),
    top as (select a.item_id, a.doc_id, a.score best, coalesce(b.score, 0) as "second" from r a left join r b on a.item_id = b.item_id and b.k = 2 where a.k = 1)"""
_EDGES = "e as (select l_orderkey src, l_partkey dst, l_linenumber pos from lineitem), us as (select p_partkey num from part where p_size >= 20), n as (select o_orderkey num from orders)"
_FORWARD = "fw as (select num, dst target from (select n.num, dst, row_number() over (partition by n.num order by pos, dst) k from n join e on n.num = e.src where dst in (select num from us)) where k = 1)"
_REVERSE = "rv as (select num, min(src) target from n join e on n.num = e.dst where src in (select num from us) group by num)"
_SEARCH_TAIL = _marks(P.GLUED_TAIL).replace("(?d)", "").replace("'", "''")
_TAIL_N = f"(select count(*) n from documents where regexp_matches(regexp_replace(text, '{_WS}+$', ''), '{_SEARCH_TAIL}') and length({_gate('text')}) > 80)"
_STRAY_N = rf"(select count(*) n from documents where regexp_matches(text, '{P.STRAY_PREFIX}'))"
#: All passages of 60 characters of each item, a shorter item as one, and all pieces of that length of each document.
_PASSAGES = f"""b as (select item_id, {_gate('text')} form from benchmark), d as (select doc_id, {_gate('text')} form from documents),
    f as (select distinct item_id, substr(form, i, 60) f from (select item_id, form, unnest(range(1, greatest(length(form) - 58, 2))) i from b) where length(substr(form, i, 60)) >= 18),
    w as (select doc_id, substr(form, i, 60) f from (select doc_id, form, unnest(range(1, length(form) - 58)) i from d))"""
_ENTRIES = "(select source, doc_id::int num, text from documents where doc_id in (select doc_id from labels where quality = 1))"

_WINDOW_UNITS = f"""g as (select source, row_number() over (partition by source order by doc_id) - 1 as seg_ix, w from (select source, doc_id, {_words('text')} w from documents)),
    z as (select source, count(*) n_segs from g group by source), it as (select item_id, item_id + 1 as num, w, len(w) n_words from {_ITEM_WORDS}),
    sc as (select source, item_id, seg_ix, count(*) p from (select item_id, unnest(w) word from it) join (select source, seg_ix, unnest(w) word from g) using (word) group by all having count(*) >= 3),
    li as (select source, item_id, list({{'s': seg_ix, 'p': p}} order by seg_ix) l from sc group by all),
    u as (select z.source, row_number() over (partition by z.source order by it.item_id) k, num, n_words, n_segs, (select count(*) from it) n_units, case when num % 10 = 0 then num end as direct, coalesce(l, []) l
        from it cross join z left join li on li.source = z.source and li.item_id = it.item_id)"""


def _passing(rules) -> str:
    return "(" + " or ".join(f"(best >= {b} and best / n_words >= {r} and best - second >= {m})" for b, r, m in rules) + ")"


def _numbered_sql() -> str:
    """A recursion over a book's units, a row per unit, that carries the pointer."""
    points = lambda x: f"list_transform({x}, lambda y: y.p)"
    return f"""with recursive {_WINDOW_UNITS}, f as (select source, 0::bigint k, 0::bigint pointer, null::bigint num, null::bigint pick from z union all
        select source, k, case when direct is null then coalesce(pick, pointer) else greatest(pointer, direct) end, num, pick from (
        select *, case when direct is null and len(seen) > 0 and {_passing(P.NUMBERED_WINDOW)} then c.s end as pick from (
        select *, c.p as best, coalesce(list_max({points("list_filter(seen, lambda x: not list_contains(list_transform(tied, lambda t: t.s), x.s))")}), 0) as second from (
        select *, list_sort(list_transform(tied, lambda x: {{'d': abs(x.s - greatest(pointer, num)), 's': x.s, 'p': x.p}}))[1] as c from (
        select *, case when len(high) > 0 then high else list_filter(seen, lambda x: x.p = top) end as tied from (
        select *, list_filter(seen, lambda x: x.p >= greatest(floor(0.88::double * top), 4)) as high from (
        select *, list_max({points("seen")}) as top from (
        select u.*, pointer, list_filter(l, lambda x: x.s >= pointer - 30 and x.s < pointer + 250) as seen from f join u on u.source = f.source and u.k = f.k + 1))))))))
        select source, num, pick as seg_ix from f where pick is not null"""


def _proportional_sql(between: bool, direct: bool) -> str:
    far = "greatest(pointer - 30, place)" if between else "place"
    ends = ("least", "greatest") if between else ("", "")
    spot = lambda end: f"case when abs(pointer - place) > 400 then {end}({'pointer, ' if between else ''}{far}) else pointer end"
    units = _WINDOW_UNITS if direct else _WINDOW_UNITS.replace("case when num % 10 = 0 then num end", "null::bigint")
    return f"""with recursive {units}, f as (select source, 0::bigint k, 0::bigint pointer, null::bigint num, null::bigint pick from z union all
        select source, k, case when direct is null then coalesce(pick, pointer) else greatest(pointer, direct) end, num, pick from (
        select *, case when direct is null and len(o) > 0 and {_passing(P.MARKER_WINDOW)} then o[1].s end as pick from (
        select *, -o[1].n as best, coalesce(-o[2].n, 0) as second from (
        select *, list_sort(list_transform(list_filter(l, lambda x: x.s >= {spot(ends[0])} - 30 and x.s < {spot(ends[1])} + 400), lambda x: {{'n': -x.p, 's': x.s}})) as o from (
        select u.*, pointer, floor(u.num * n_segs / greatest(1, n_units))::bigint as place from f join u on u.source = f.source and u.k = f.k + 1)))))
        select source, num, pick as seg_ix from f where pick is not null"""


ORACLES = {
    "window_align_numbered": _numbered_sql(),
    "window_align_marker": _proportional_sql(True, True),
    "window_align_other": _proportional_sql(False, False),
    "page_status": f"select {_STATUS} as status, count(*) n from pages group by 1",
    "crawl_work": "select r::int as page from range(0, (select max(page_id) from pages) + 1) t(r) where r not in (select page_id from pages where strlen(html) > 4000)",
    "page_paragraphs": f"select page_id, para_ix::int as para_ix, body from ({_BODIES})",
    "paragraph_runs": r"""with b as (select page_id, i - 1 as para_ix, l[i] as body from (select page_id, regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '(?s)<li>(.*?)</li>', 1) l from pages) t, unnest(range(1, len(l) + 1)) u(i)),
        p as (select page_id, para_ix, string_split(regexp_replace(body, '(?s)<a href="([^"]*)">(.*?)</a>', chr(1) || '\1' || chr(2) || '\2' || chr(1), 'g'), chr(1)) l from b),
        r as (select page_id, para_ix, i - 1 as run_ix, l[i] as x from p, unnest(range(1, len(l) + 1)) u(i))
        select page_id, para_ix::int as para_ix, run_ix::int as run_ix, case when contains(x, chr(2)) then split_part(x, chr(2), 1) else '' end as cls, case when contains(x, chr(2)) then split_part(x, chr(2), 2) else x end as text
        from r where case when contains(x, chr(2)) then split_part(x, chr(2), 2) else x end <> ''""",
    "clean_text": _PARAGRAPHS,
    "page_documents": f"""with d as (select page_id % 16 as book_id, page_id, string_agg(text, chr(10) order by para_ix) as text from ({_PARAGRAPHS}) group by page_id)
        select book_id, (row_number() over (partition by book_id order by page_id) - 1)::int as page_ix, page_id, length(text)::int as n_chars, sha256(text) as text_sha256 from d where length(text) >= 50""",
    "normalize_text": f"select doc_id, {_search('text')} as form from documents",
    "gate_text": f"select doc_id, {_gate('text')} as form from documents",
    "content_words": f"select doc_id, len(w)::int as n_words, array_to_string(list_sort(w), ' ') as words from {_DOC_WORDS}",
    "doc_frequency": f"select word, count(*) df from (select unnest(w) word from {_DOC_WORDS}) group by word",
    "rare_words": f"""with d as (select doc_id, unnest(w) word from {_DOC_WORDS}), f as (select word, count(*) df from d group by word)
        select doc_id, rank::int as rank, word, df from (select doc_id, word, df, row_number() over (partition by doc_id order by df, word) as rank from d join f using (word) where df between 1 and 25) where rank <= 6""",
    "text_fragments": f"""with s as (select doc_id, text, strlen(regexp_extract(text[1:1200], '(?s)^(.*?)(?:The|And)', 1)) > 0 or starts_with(text, 'The') or starts_with(text, 'And') as hit, length(regexp_extract(text[1:1200], '(?s)^(.*?)(?:The|And)', 1)) as skip from documents),
        p as (select doc_id, substr(text, case when hit then skip + 1 else 1 end, 3000) as part from s),
        f as (select doc_id, list_filter(list_transform(regexp_extract_all(part, ',([^,.]{{18,150}})', 1), lambda x: {_gate('x')}), lambda x: length(x) >= 18)[1:4] as l from p)
        select doc_id, (i - 1)::int as ix, l[i] as fragment from f, unnest(range(1, len(l) + 1)) u(i)""",
    "segment_lines": f"select doc_id, seg_ix::int as seg_ix, count(*) n_lines, sha256(string_agg(line, chr(10) order by line_ix)) body_sha256 from ({_ISLANDS}) where seg_ix > 0 group by doc_id, seg_ix",
    "merge_adjacent": """with e as (select *, case when lag(event_type) over w is distinct from event_type then 1 else 0 end c from events window w as (partition by user_id order by event_id)),
        r as (select *, sum(c) over (partition by user_id order by event_id rows unbounded preceding) run_ix from e)
        select user_id, run_ix::int as run_ix, min(event_type) event_type, min(event_id) first_event, max(event_id) last_event, count(*) n from r group by user_id, run_ix""",
    "sequence_validate": """with recursive e as (select user_id, event_id, floor(value)::bigint n, event_id % 17 = 0 forced, row_number() over (partition by user_id order by event_id) k from events),
        f as (select user_id, k, event_id, n, forced, (forced or (abs(n) <= 20 and n >= -5)) ok, case when forced or (abs(n) <= 20 and n >= -5) then n else 0 end as last from e where k = 1
        union all select e.user_id, e.k, e.event_id, e.n, e.forced, (e.forced or (abs(e.n - f.last) <= 20 and e.n >= f.last - 5)), case when e.forced or (abs(e.n - f.last) <= 20 and e.n >= f.last - 5) then e.n else f.last end from f join e on e.user_id = f.user_id and e.k = f.k + 1)
        select user_id, event_id, n, forced from f where ok""",
    "mega_segments": f"select doc_id, 0::int as n_head, case when length(replace(text, chr(10), '')) > 60000 then 0 else len({_words("' ' || substr(replace(text, chr(10), ' '), 1, 2000)")}) end::int as n_body from documents",
    "first_wins": "select source, lang, doc_id, n_chars from (select *, row_number() over (partition by source, lang order by doc_id) k from documents) where k = 1",
    "direct_map": "select d.doc_id as num, source, quality, toxic from documents d join (select *, row_number() over (partition by doc_id order by quality) k from labels) l on d.doc_id = l.doc_id and k = 1",
    "missing_anti": "select doc_id, source from documents where doc_id not in (select doc_id from labels)",
    "membership_semi": "select doc_id, source from documents where doc_id in (select doc_id from labels)",
    "near_key": """with h as (select l_orderkey as key, count(*) lines from lineitem group by 1),
        c as (select o_orderkey, o.off as "offset", key, lines as score, row_number() over (partition by o_orderkey order by lines desc, o.off) k from orders, (values (-1), (0), (1)) o(off), h where key = o_orderkey + o.off)
        select o_orderkey, "offset", key, score from c where k = 1 and score >= 2""",
    "xref_forward": f"with {_EDGES}, {_FORWARD} select * from fw",
    "xref_reverse": f"with {_EDGES}, {_REVERSE} select * from rv",
    "priority_fill": f"""with {_EDGES}, {_FORWARD}, {_REVERSE}, al as (select num, num target, 0 priority from n where num in (select num from us) union all select num, target, 1 from fw union all select num, target, 2 from rv)
        select num, target, priority from (select *, row_number() over (partition by num order by priority) k from al) where k = 1""",
    "overlap_best_second": f'with {_SCORES} select item_id, doc_id, best, "second", best - "second" as margin from top',
    "overlap_global": f"""with {_SCORES}, z as (select top.*, len(w)::int n_words from top join {_ITEM_WORDS} using (item_id))
        select item_id, doc_id, best, n_words from z where (best >= 5 and best / greatest(1, n_words) >= 0.5) or (best >= 8 and best / greatest(1, n_words) >= 0.35) or (best >= 4 and best / greatest(1, n_words) >= 0.65)""",
    "title_match": f"""with u as (select item_id, unnest({_words('text', 1, ['the'])}) word from benchmark), s as (select doc_id, unnest({_words('string_split(text, chr(10))[1]', 1, ['the'])}) word from documents),
        sc as (select item_id, doc_id, count(*) best from u join s using (word) group by all)
        select item_id, doc_id, best from (select *, row_number() over (partition by item_id order by best desc, doc_id) k from sc) where k = 1""",
    "number_agreement": f"""with m as (select u.item_id, u.w, d.doc_id, len(list_intersect(u.w, d.w)) i, len(u.w) n from {_ITEM_WORDS} u left join {_DOC_WORDS} d on u.item_id = d.doc_id where u.item_id < 1500)
        select count(*) filter (doc_id is not null and (i >= 4 or (n > 0 and i / n >= 0.2) or (i >= 3 and n >= 15))) as agree, count(*) filter (doc_id is not null and not (i >= 4 or (n > 0 and i / n >= 0.2) or (i >= 3 and n >= 15))) as disagree, count(*) filter (doc_id is null) as missing from m""",
    "span_concat": f"""with t as (select conv_id, turn, min(role) as role, min(text) as text from conversations group by all), z as (select conv_id, max(turn) last_page from t group by 1),
        a as (select conv_id, turn, last_page, coalesce(lead(turn) over (partition by conv_id order by turn), least(last_page, turn + 2)) as nxt from t join z using (conv_id) where role = 'user'),
        s as (select conv_id, turn, turn as first, least(case when nxt <= turn then least(last_page, turn + 1) else nxt end, turn + 4) as last from a)
        select s.conv_id, s.turn, first, last, length({_strip("string_agg(t.text, chr(10) || chr(10) order by t.turn)")})::int n_chars from s join t on s.conv_id = t.conv_id and t.turn between first and last group by s.conv_id, s.turn, first, last""",
    "chapter_interpolate": """with a as (select user_id book_id, event_id // 500 chapter_id, min(event_id) low, max(event_id) high, count(*) n from events group by all),
        c as (select book_id, chapter_id, case when n % 2 = 0 then low end as s, case when n % 2 = 0 then high end as e, max(high) over (partition by book_id) last_page from a),
        f as (select book_id, chapter_id, s is null as filled, coalesce(s, last_value(e ignore nulls) over (partition by book_id order by chapter_id rows between unbounded preceding and 1 preceding) + 1, 0) as start,
            case when s is not null then e else coalesce(first_value(s ignore nulls) over (partition by book_id order by chapter_id rows between 1 following and unbounded following) - 1, last_page) end as "end" from c)
        select * from f where not filled or start <= "end" """,
    "next_header": """with h as (select book_id, page_ix, row_number() over (partition by book_id order by page_ix) - 1 as ix from (select distinct conv_id book_id, turn page_ix from conversations where role = 'user'))
        select a.book_id, a.ix::int as chapter_id, a.page_ix as start, (select b.page_ix - 1 from h b where b.book_id = a.book_id and b.ix > a.ix and b.page_ix > a.page_ix + 1 order by b.ix limit 1) as "end" from h a""",
    "gate_numbering": f"""with u as (select source slug, doc_id unit_ix, doc_id // 20 num, text from documents), d as (select *, lag(num) over (partition by slug order by unit_ix) > num as down from u),
        c as (select slug, count(*) n, count(*) filter (length({_gate("coalesce(text, '')")}) < 10) n_short, max(num) max_num, count(*) filter (down) n_inversions from d group by slug)
        select *, n_short = 0 and n >= max_num - 5 and (n_inversions = 0 or slug = 'src1') as ok from c""",
    "gate_adjacent_dups": f"""with f as (select doc_id // 2 num, {_gate('text')} form from documents)
        select 'all' as slug, a.num, a.num + 1 as "next", count(*) n from f a join f b on b.num = a.num + 1 and a.form = b.form where length(a.form) > 60 and (a.num, a.num + 1) not in ({', '.join(map(str, P.IDENTICAL_ALLOWED))}) group by a.num""",
    "gate_prefix": f"select 'stray_prefixes' as \"check\", 'all' as scope, n::double as metric, 0::double as threshold, n = 0 as ok from {_STRAY_N}",
    "gate_tail": f"select 'glued_tails' as \"check\", 'all' as scope, n::double as metric, 8::double as threshold, n <= 8 as ok from {_TAIL_N}",
    "gate_range": """with u as (select case when o_orderstatus = 'F' then 'A' when o_orderstatus = 'O' then 'N' else 'X' end slug, max(o_orderkey // 100) m from orders group by 1)
        select slug, count(*) n, min(l_partkey) least from lineitem join u on slug = l_returnflag where l_partkey > m group by slug""",
    "gate_overall": f"select 2::bigint as n_checks, ((a.n > 0)::int + (b.n > 8)::int)::bigint as n_failed, a.n = 0 and b.n <= 8 as ok from {_STRAY_N} a, {_TAIL_N} b",
    "containment_own": f"""with b as ({_BODIES}), t as (select page_id, string_agg({_gate(_clean("body"))}, ' ' order by para_ix) form from b group by page_id),
        h as (select page_id, {_gate(_clean("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"))} f from pages)
        select page_id as num from h join t using (page_id) where length(f) >= 18 and contains(form, f)""",
    "containment_foreign": f"""with {_PASSAGES} select distinct item_id, doc_id from f join w using (f) where item_id <> doc_id
        union select distinct item_id, doc_id from f join d on contains(form, f) where length(f) < 60 and item_id <> doc_id""",
    "package_entries": f"select source, count(*)::int n_entries, sha256(string_agg(num || ':' || text, chr(10) order by num, text)) entries_sha256 from {_ENTRIES} group by source",
    "package_documents": f"select source, num, sha256(text) as sharh_sha256 from {_ENTRIES}",
    "package_coverage": f"select source, count(*) n_entries, sum(length(text))::bigint n_chars from {_ENTRIES} group by source",
    "book_global": f"""with g as (select doc_id * 1000000 + seg_ix seg_ix, string_agg(line, chr(10) order by line_ix) as text from ({_ISLANDS}) where seg_ix > 0 group by doc_id, seg_ix),
        u as (select item_id, unnest(w) word from {_ITEM_WORDS}), s as (select seg_ix, unnest({_words('text')}) word from g),
        sc as (select item_id, seg_ix, count(*) best from u join s using (word) group by all),
        top as (select * from (select *, row_number() over (partition by item_id order by best desc, seg_ix) k from sc) where k = 1),
        z as (select top.*, len(w) n from top join {_ITEM_WORDS} using (item_id))
        select item_id as unit_ix, seg_ix, best, length(g.text)::int n_chars from z join g using (seg_ix) where length(g.text) >= 60 and ((best >= 5 and best / greatest(1, n) >= 0.5) or (best >= 8 and best / greatest(1, n) >= 0.35) or (best >= 4 and best / greatest(1, n) >= 0.65))""",
}
