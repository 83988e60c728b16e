"""The registered queries of this package and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import token_digests
from .common import Scratch, cut
from .embedding_dedup import near_vectors
from .exact_dedup import exact_groups
from .filter_audit import audit
from .hard_negatives import mine_negatives
from .jaccard_join import jaccard_components
from .language_id import identify
from .mixing import PASSES, mix_sources
from .pieces import piece_digests
from .repeats import remove_repeats
from .secrets import secret_report
from .token_store import read_tokens, write_tokens
from .url_filter import RULES, judge_urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_report(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_groups(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op4_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_bytes", "n_removed", F.size("lows").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = jaccard_components(_table(spark, sf_dir, "documents"), n=3, percent=90)
    return joined.select("doc_id", F.col("size").alias("n_shingles"), F.col("component").alias("component_id"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "trust", "distrust")


def op8_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Scratch(spark, "tokens") as path:
        write_tokens(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
        read = read_tokens(spark, path)
        return cut(read.select("doc_id", "start", F.col("n_ids").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = near_vectors(_table(spark, sf_dir, "embeddings"))
    return near.select("vec_id", "n_links", F.col("component").alias("component_id"), "kept")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(_table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), _table(spark, sf_dir, "labels"))


def op13_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (op1_language_id, op2_secret_scan, op3_exact_dedup, op4_repeat_removal, op5_bpe_codec, op6_jaccard_join, op7_url_filter, op8_token_planes, op9_source_mixing, op10_embedding_dedup, op11_hard_negatives, op12_filter_audit, op13_sentence_pieces)}

#: Kinds as in the scan, in patterns that RE2 reads alike: kind, pattern, least characters, group, base.
_SECRETS = (
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"\x27]?\x20*[:=]\x20*[\"\x27]?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    ("access", "AKIA[A-Z0-9]+", 20, 0, True),
    ("hex", "[0-9a-f]+", 24, 0, True),
    ("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 1, 0, False),
    ("hosting", "gh[pousr]_[A-Za-z0-9]{36,}", 40, 0, False),
)


def _secret_sql() -> str:
    """Matches between their gaps, whose lengths add up to positions."""
    parts = []
    for order, (kind, pattern, least, group, base) in enumerate(_SECRETS):
        split = f"select doc_id, string_split_regex(t, '{pattern}') gaps, regexp_extract_all(t, '{pattern}', 0) m, regexp_extract_all(t, '{pattern}', {group}) g from d where regexp_matches(t, '{pattern}')"
        lengths = f"select doc_id, list_transform(gaps, lambda x: length(x)) gaps, list_transform(m, lambda x: length(x)) m, list_transform(g, lambda x: length(x)) g from ({split})"
        listed = f"select doc_id, unnest(gaps[1:len(m)]) gap, unnest(m) size, unnest(g) part, unnest(range(len(m))) ix from ({lengths})"
        placed = f"select *, sum(gap + size) over (partition by doc_id order by ix rows unbounded preceding) as stop from ({listed})"
        parts.append(f"select doc_id, {order} o, '{kind}' kind, {base} base, stop - size as start, stop from ({placed}) where part >= {least}")
    spell = "string_agg(kind || ':' || start || ':' || stop, ',' order by start, o)"
    return f"""with d as (select doc_id, coalesce(text, '') t from documents), s as ({" union all ".join(parts)}),
        a as (select doc_id, count(*) filter (o = 0) n0, count(*) filter (o = 1) n1, count(*) filter (o = 2) n2, {spell} filter (base) b, {spell} al from s group by doc_id)
        select d.doc_id, coalesce(n0, 0) as n_assign, coalesce(n1, 0) as n_access, coalesce(n2, 0) as n_hex, sha256(coalesce(b, '')) as base_sha256, coalesce(al, '') as spans from d left join a on d.doc_id = a.doc_id"""


_SPACE = r"[^\x20\x09-\x0D]+"
_ALPHABET = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _reach(edges: str) -> str:
    """(id, node): what is reachable from each end of edges (a, b), which hold both directions; for small tables."""
    return f"reach as (select a as id, a as node from {edges} union select r.id, e.b from reach r join {edges} e on e.a = r.node)"


def _jaccard_sql(n: int, percent: int) -> str:
    shingle = " || ' ' || ".join(f"w[i + {j}]" for j in range(n))
    return rf"""with recursive d as (select doc_id, row_number() over () as r, regexp_extract_all(translate(coalesce(text, ''), {_ALPHABET}), '{_SPACE}') w from documents),
        s as (select r, doc_id, case when len(w) = 0 then [] when len(w) < {n} then [array_to_string(w, ' ')] else list_distinct(list_transform(range(1, len(w) - {n - 2}), lambda i: {shingle})) end s from d),
        g as (select r, unnest(s) x from s), z as (select r, doc_id, len(s) n from s),
        c as (select a.r a, b.r b, count(*) n from g a join g b on a.x = b.x and a.r <> b.r group by all),
        e as (select c.a, c.b from c join z x on x.r = c.a join z y on y.r = c.b where 100 * c.n >= {percent} * (x.n + y.n - c.n)),
        {_reach("e")}, named as (select id, min(doc_id) component_id from (select k.id, z.doc_id from reach k join z on z.r = k.node) group by id)
        select doc_id, n::bigint as n_shingles, coalesce(component_id, doc_id) as component_id from z left join named on id = z.r"""


def _url_sql() -> str:
    """Verdicts where no link leads from one host to another, as in these tables: a host then holds what its own pages give it."""
    fits = lambda r: f"((host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}'))"
    longest = lambda field: "case " + " ".join(f"when {fits(r)} then '{getattr(r, field)}'" for r in sorted(RULES, key=lambda r: -len(r.prefix))) + " end"
    part = lambda k: rf"regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', {k})"
    return f"""with p as (select page_id, translate({part(1)}, {_ALPHABET}) as host, {part(2)} as path from pages), r as (select *, {longest('prefix')} as rule, {longest('verdict')} as ruling from p),
        h as (select host, avg((coalesce(ruling, '') = 'allow')::int::double) trust, avg((coalesce(ruling, '') = 'block')::int::double) distrust from r where host <> '' group by host)
        select page_id, r.host, path, rule, coalesce(ruling, case when distrust >= 0.5 and distrust > trust then 'block' else 'allow' end) as verdict, coalesce(trust, 0) as trust, coalesce(distrust, 0) as distrust from r left join h on h.host = r.host"""


def _mix_sql(weights=(1, 2, 3), epochs: int = 3, seed: int = 17) -> str:
    """The mix without buckets: every source is ordered as a whole."""
    listed = f"[{', '.join(f'{w}::double' for w in weights)}]"
    passes = []
    for p in range(PASSES):
        before = "n0" if not p else f"b{p - 1}"
        able = "size > 0 and budget > 0" + ("" if not p else f" and size <= budget and key > at{p - 1}")
        budget = "rest" if not p else f"left{p - 1}"
        keep = "".join(f", at{q}, left{q}" for q in range(p))
        passes.append(f"""r{p} as (select *, case when {able} then sum(case when {able} then size else 0 end) over (partition by source order by key rows unbounded preceding) end running from (select *, {budget} as budget from {before})),
        c{p} as (select source s, min(key) filter (running > budget) as k, arg_min(budget - running + size, key) filter (running > budget) as l, max(budget) - coalesce(max(running), 0) as rest_left from r{p} group by source),
        b{p} as (select r{p}.* exclude (running, budget), case when budget <= 0 then '-infinity'::double else k end as at{p}, coalesce(l, rest_left) as left{p} from r{p} join c{p} on s is not distinct from source)""")
    taken = " or ".join("(" + (f"(at{p} is null or key < at{p})" if not p else f"(at{p} is null or key < at{p}) and at{p - 1} is not null and key > at{p - 1} and size <= left{p - 1}") + ")" for p in range(PASSES))
    return rf"""with d as (select doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '{_SPACE}')) as size from documents),
        q as (select doc_id, source, size, case when size > 0 then 1 / (1 + abs(ln(((length(text) + 1) / size) / 6.5))) else 1.0 end as q,
            (('0x' || md5('{seed}:' || coalesce(doc_id::varchar, 'null') || ':' || coalesce(md5(text), 'null'))[1:13])::bigint::double + 0.5) / 4503599627370496.0 as u from d),
        s as (select source, sum(size)::double as source_size from q group by source), w as (select *, list_extract({listed}, (row_number() over (order by source is null, source) - 1) % {len(weights)} + 1) as w, source_size * {epochs} as cap from s),
        o as (select *, sum(source_size) over () as total, sum(w) over () as ws, coalesce(sum(cap) over x, 0) as caps, coalesce(sum(w) over x, 0) as used from w window x as (order by cap / w, source is null, source rows between unbounded preceding and 1 preceding)),
        f as (select *, (total - caps) * w / (ws - used) > cap as "full" from o), t as (select source, source_size, case when "full" then cap else (total - sum(case when "full" then cap else 0 end) over ()) * w / sum(case when "full" then 0 else w end) over () end as target from f),
        e as (select *, case when source_size > 0 then least(floor(target / source_size), {epochs}) else 1 end as whole from t),
        n0 as (select doc_id, q.source, size, -ln(u) / greatest(q, 1e-6) as key, source_size, target, whole, case when source_size > 0 and whole < {epochs} then target - whole * source_size else 0 end as rest from q join e on e.source is not distinct from q.source),
        {", ".join(passes)},
        m as (select *, {taken} as more from b{PASSES - 1}), la as (select source s, min(key) as last from m where size > 0 and rest > 0 and not coalesce(more, false) and size < 2 * left{PASSES - 1} group by source)
        select doc_id, size::bigint as size, source_size::bigint as source_size, target, source, case when size = 0 then 0 else size * (whole::bigint + (coalesce(more, false) or coalesce(key = last, false))::bigint) end::bigint as taken from m left join la on s is not distinct from source"""


_NEAR_SQL = rf"""with recursive v as (select row_number() over () as r, vec_id, label, embedding::double[] x from embeddings), ok as (select * from v where label is not null and x is not null and len(list_filter(x, lambda y: y is null or not isfinite(y))) = 0 and len(list_filter(x, lambda y: y <> 0)) > 0),
    e as (select a.r a, b.r b from ok a join ok b on a.label = b.label and a.r <> b.r and list_cosine_similarity(a.x, b.x) >= 0.93), {_reach("e")},
    named as (select id, min(vec_id) as c from (select reach.id, v.vec_id from reach join v on v.r = reach.node) group by id), n as (select a, count(*) n from e group by a)
    select vec_id, coalesce(n.n, 0)::bigint as n_links, coalesce(c, vec_id) as component_id, vec_id = coalesce(c, vec_id) as kept from v left join named on id = v.r left join n on n.a = v.r"""

_NEGATIVES_SQL = """with v as (select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as l, list_transform(embedding, lambda x: floor(256 * x::double)) as q from embeddings
        where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    s as (select a.r, a.vec_id as anchor_id, b.vec_id, a.l = b.l as same, list_inner_product(a.q, b.q)::bigint as score from v a join v b on a.vec_id % 100 = 0 and a.r <> b.r),
    p as (select *, row_number() over (partition by r order by score desc, vec_id) as k from s where same qualify k <= 5)
    select p.anchor_id, p.vec_id as positive_id, (row_number() over (partition by p.r, p.k order by s.score desc, s.vec_id))::int as rank, s.vec_id as negative_id, p.score as positive_score, s.score as negative_score
        from p join s on s.r = p.r and not s.same and 80 * p.score <= 100 * s.score and s.score <= p.score qualify rank <= 5"""

#: Documents by the set of filters that they fail, then every step of every order over those sums.
_AUDIT_SQL = rf"""with l as (select doc_id, coalesce(bool_or(quality = 1), false) good, coalesce(bool_or(toxic = 1), false) toxic from labels group by doc_id),
    d as (select doc_id, coalesce(lang, '') part, coalesce(text, '') t from documents), w as (select *, regexp_extract_all(t, '{_SPACE}') w, min(doc_id) over (partition by t) lowest from d),
    m as (select part, coalesce(good, false) good, coalesce(toxic, false) toxic, (len(w) < 200)::int + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::int + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::int
        + 8 * regexp_matches(t, '[#$%&*|]')::int + 16 * coalesce(lowest < w.doc_id, false)::int as m from w left join l on l.doc_id = w.doc_id),
    g as (select part, m, count(*) n, count(*) filter (good) good, count(*) filter (toxic) toxic from m group by part, m),
    x as (select unnest(['A', 'B', 'C', 'D', 'E']) x), o as (select a.x || b.x || c.x || d.x || e.x as o from x a, x b, x c, x d, x e where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
    s as (select o, step, 1 << (ascii(o[step]) - 65) as f, list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(o[i]) - 65)))::int as p from o, (select unnest(range(1, 6)) step)),
    c as (select part, o as filter_order, step::int as step, f, coalesce(p, 0) p, sum(n) filter (m & (f | coalesce(p, 0)) = 0) kept, sum(n) filter (m & f > 0 and m & coalesce(p, 0) = 0) removed, sum(n) filter (m & f > 0 and m & coalesce(p, 0) > 0) redundant,
        sum(n) filter (m = f) alone, sum(good) filter (m & f > 0 and m & coalesce(p, 0) = 0) good_lost, sum(toxic) filter (m & f > 0 and m & coalesce(p, 0) = 0) toxic_lost from g, s group by all)
    select part, filter_order, step, coalesce(kept, 0)::bigint kept, coalesce(removed, 0)::bigint removed, coalesce(redundant, 0)::bigint redundant, coalesce(alone, 0)::bigint unique_fails, coalesce(good_lost, 0)::bigint good_lost, coalesce(toxic_lost, 0)::bigint toxic_lost,
        sum(coalesce(removed, 0)) over (partition by part, f)::bigint shapley from c"""

ORACLES = {
    "op11_hard_negatives": _NEGATIVES_SQL,
    "op12_filter_audit": _AUDIT_SQL,
    "op6_jaccard_join": _jaccard_sql(3, 90),
    "op7_url_filter": _url_sql(),
    "op9_source_mixing": _mix_sql(),
    "op10_embedding_dedup": _NEAR_SQL,
    "op2_secret_scan": _secret_sql(),
    "op3_exact_dedup": r"""
        with d as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') t from documents),
        g as (select t, min(doc_id) keep_id, count(*) group_size from d group by t)
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(d.t) as text_sha256 from d join g on d.t = g.t""",
}
