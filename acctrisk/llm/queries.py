"""Registered queries of the operators and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctrisk.llm import (
    byte_bpe, chat, classifier, jaccard, language, lines, lm, packing, repair, rules, topk, urls,
    whitening,
)
from acctrisk.llm.common import held_out, materialise, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id", 5, 0))
    scored = classifier.score(docs, classifier.fit(docs, labels))
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")


@query
def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = lm.prepare(table(spark, sf_dir, "documents"), ~held_out("doc_id", 10, 0))
    scored = lm.score(*prepared, *lm.fit(*prepared))
    return scored.withColumn("held_out", held_out("doc_id", 10, 0))


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = materialise(rules.measure(table(spark, sf_dir, "documents")))
    return rules.judge(measured, rules.fit(measured, table(spark, sf_dir, "labels")))


URL_RULES = [
    urls.Rule("allow", "org", "/"), urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"), urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
]


@query
def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is the quality label of the document that its url numbers."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", "url", F.expr("try_cast(regexp_extract(url, '/([0-9]+)', 1) as bigint)")
        .alias("item"))
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("item"), F.col("quality").alias("good"))
    return urls.judge(pages, labels, URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


ORACLE_SQL["op4_url_filters"] = r"""
with cut as (
  select page_id, try_cast(regexp_extract(url, '/([0-9]+)', 1) as bigint) as item,
         case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end rest
  from pages),
parsed as (
  select page_id, item, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') as host
  from cut),
hosts as (
  select host, count(quality) as n, coalesce(sum(quality), 0) as k,
         regexp_replace(host, ':[0-9]*$', '') as name
  from parsed left join labels on doc_id = item group by host),
leveled as (
  select host, n, k,
    case when address then '' when listed then two else regexp_extract(name, '[^.]*$') end
      as suffix,
    case when address then name when listed then regexp_extract(name, '([^.]*[.]){0,2}[^.]*$')
         else two end as domain
  from (select *, regexp_extract(name, '([^.]*[.])?[^.]*$') as two, two in (<suffixes>) as listed,
               regexp_matches(name, '^([0-9]+[.]){3}[0-9]+$') or name like '[%' as address
        from hosts)),
domains as (select domain, suffix, sum(n) as n, sum(k) as k from leveled group by all),
suffixes as (select suffix, sum(n) as n, sum(k) as k from domains group by suffix),
groups as (
  select 'host' as lv, n, k from hosts union all select 'domain', n, k from domains
  union all select 'suffix', n, k from suffixes),
sums as (
  select lv, count(*) as g, sum(n)::double as n, sum(k)::double as k, sum(n::double * n) as nn,
         sum(k::double * k / n) as kkn
  from groups where n > 0 group by lv),
spread as (
  select lv, k / n * (1 - k / n) as v,
         (kkn - k * k / n - (g - 1) * (k / n) * (1 - k / n)) / nullif(n - nn / n, 0) as b
  from sums),
strength as (
  select lv, greatest(1.0, least(10000.0, case when b is null then 1.0
    when b > 0 then v / b - 1 else 10000.0 end)) as m
  from spread),
m as (
  select coalesce(max(m) filter (where lv = 'suffix'), 1) as ms,
         coalesce(max(m) filter (where lv = 'domain'), 1) as md,
         coalesce(max(m) filter (where lv = 'host'), 1) as mh from strength),
top as (select coalesce(sum(k) / sum(n), 0.5) as p from suffixes),
suffix_means as (
  select suffix, (ms * p + k) / (ms + n) as mean from suffixes, m, top),
domain_means as (
  select domain, (md * s.mean + k) / (md + n) as mean
  from domains join suffix_means s using (suffix), m),
posterior as (
  select host, (mh * d.mean + k) / (mh + n) as good, mh + n as total
  from leveled join domain_means d using (domain), m),
bounds as (
  select host, good + 1.645 * sqrt(good * (1 - good) / (total + 1)) as upper from posterior),
judged as (
  select page_id, host, path, upper,
    case when (host = 'example.org' or host like '%.example.org') and path like '/en/1%'
           then 'example.org/en/1'
         when (host = 'example.org' or host like '%.example.org') and path like '/es/%'
           then 'example.org/es/'
         when (host = 'com' or host like '%.com') and path like '/de/%' then 'com/de/'
         when (host = 'com' or host like '%.com') and path like '/fr/%' then 'com/fr/'
         when (host = 'org' or host like '%.org') and path like '/%' then 'org/' end as rule
  from parsed join bounds using (host))
select page_id, host, path, rule,
  case when rule in ('org/', 'com/fr/') then 'allow' when rule is not null then 'block'
       when upper < 0.8 then 'block' else 'allow' end as verdict
from judged
""".replace("<suffixes>", ", ".join(f"'{x}'" for x in urls.SUFFIXES))


@query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    tokens = byte_bpe.encode(table(spark, sf_dir, "documents"), path)
    return byte_bpe.digests(byte_bpe.decode(tokens, path))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), added=True)


@query
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(~held_out("doc_id", 3, 1)))
    found = language.identify(docs, model)
    return found.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")


@query
def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


ORACLE_SQL["op8_topk"] = """
with v as (
  select vec_id, [floor(64 * x::double) for x in embedding] as e from embeddings
  where embedding is not null
        and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0),
ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank
  from scored)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""


@query
def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents")).documents.select(
        "doc_id", "n_shingles", "component_id")


ORACLE_SQL["op9_ngram_jaccard"] = r"""
with recursive cut as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w
  from documents),
spread as (
  select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from cut where len(w) > 0),
shingles as (
  select distinct doc_id, array_to_string(list_slice(w, i, i + 4), ' ') as s from spread),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
  select a.doc_id as x, b.doc_id as y, count(*) as c
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as (
  select x, y from shared join sizes p on p.doc_id = x join sizes q on q.doc_id = y
  where 100 * c >= 80 * (p.n + q.n - c)),
both_ways as (select x, y from links union all select y, x from links),
reach as (
  select x, x as y from both_ways
  union select r.x, b.y from reach r join both_ways b on b.x = r.y),
least as (select x, min(y) as component_id from reach group by x)
select doc_id, coalesce(n, 0)::bigint as n_shingles,
       coalesce(component_id, doc_id)::bigint as component_id
from documents left join sizes using (doc_id) left join least on x = doc_id
"""


@query
def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


ORACLE_SQL["op10_chat"] = r"""
with seen as (
  select distinct conv_id, role as perspective from conversations
  where role is not null and role <> 'system'),
views as (
  select c.conv_id, s.perspective, c.turn, c.role as speaker, c.text,
    case when c.role = 'system' then 'system' when c.role = s.perspective then 'assistant'
         else 'user' end as role
  from conversations c join seen s on c.conv_id is not distinct from s.conv_id),
named as (
  select *, case when role = 'user' then
    regexp_replace(coalesce(speaker, 'unknown'), '[^A-Za-z0-9_-]', '_', 'g') end as name,
    replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' as said
  from views),
made as (
  select *, '<|im_start|>' || role || coalesce(' name=' || name, '') || chr(10) as head from named)
select conv_id, perspective, turn, role, name, head || said || chr(10) as rendered,
  coalesce(sum(length(head || said) + 1) over (
    partition by conv_id, perspective
    order by turn nulls first, speaker nulls first, text nulls first
    rows between unbounded preceding and 1 preceding), 0)::bigint as start,
  length(head)::int as mask_start,
  (case when role = 'assistant' then length(said) else 0 end)::int as mask_length
from made
"""


@query
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE_SQL["op12_line_dedup"] = r"""
with rows as (
  select row_number() over () as row, doc_id, str_split(coalesce(text, ''), chr(10)) as lines
  from documents),
cut as (
  select row, doc_id, unnest(lines) as line, unnest(range(len(lines))) as place from rows),
keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from cut),
shared as (
  select key, max(doc_id) as keeper from (
    select distinct key, doc_id from keyed where length(key) >= 20)
  group by key having count(*) >= 3),
marked as (
  select k.*, s.key is not null and k.doc_id is distinct from keeper as gone
  from keyed k left join shared s on k.key = s.key)
select doc_id, count(*)::bigint as n_lines, count_if(gone)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not gone), ''))
         as kept_sha256
from marked group by row, doc_id
"""


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deviation beyond 64 bits is null here; the operator has it with 38 digits."""
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    repaired = repair.repair(repair.damage(turns))
    all_ids = turns.select(F.struct("conv_id").alias("key")).distinct()
    for part in (repaired.conversations, repair.digests(repaired.turns)):
        all_ids = all_ids.join(
            part.withColumn("key", F.struct("conv_id")).drop("conv_id"), "key", "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return all_ids.select(
        "key.conv_id", *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def _repair_sql() -> str:
    """The same by one search per dialogue, turn by turn from its end.

    s0 to s3 are the best ways on from the four states: costs, audit and the lines that are left.
    """
    follow = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}
    kept = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    def way(cost: str, letter: str, then: str, line: str | None = None) -> str:
        lines = f"list_prepend({line}, {then}.r)" if line else f"{then}.r"
        return f"{{'c': {cost} + {then}.c, 'a': '{letter}' || {then}.a, 'r': {lines}}}"

    own, best = [], []
    for p, (q, role) in follow.items():
        keep = " ".join(f"when k = '{k}' and not gone then "
                        + way("late", "K", f"s{to}", "role || ':' || text")
                        for k, to in kept[p].items())
        change = way("2 + late", "R", f"s{q}", f"'{role}:' || text")
        own.append(f"list_sort(list_filter([{way('3', 'D', f's{p}')}, case {keep} end, case when "
                   f"not gone then {change} end], lambda x: x is not null))[1] as o{p}")
        more, last = follow[q]
        twice = (f"{{'c': 4 + o{more}.c, 'a': 'II' || o{more}.a, "
                 f"'r': list_concat(['{role}:', '{last}:'], o{more}.r)}}")
        once = way("2", "I", f"o{q}", f"'{role}:'")
        best.append(f"list_sort([o{p}, {once}, {twice}])[1] as s{p}")
    end = ["{'c': 0::bigint, 'a': '', 'r': []::varchar[]}",
           "{'c': 4::bigint, 'a': 'II', 'r': ['user:', 'assistant:']}",
           "{'c': 2::bigint, 'a': 'I', 'r': ['assistant:']}",
           "{'c': 0::bigint, 'a': '', 'r': []::varchar[]}"]
    return rf"""
with recursive numbered as (
  select dense_rank() over (order by conv_id nulls first) as conv, conv_id, turn,
         coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key
  from conversations),
checked as (
  select *, xor(list_reduce(
    list_prepend(4294967295::ubigint, [ascii(x)::ubigint for x in string_split(key, '')]),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::ubigint[],
                          lambda x, y: xor(x >> 1, 3988292384::ubigint * (x & 1::ubigint)))),
    4294967295::ubigint) % 20 as fold
  from numbered),
damaged as (
  select conv, turn, case when fold = 4 then 'user' else role end as role,
         case when fold = 1 then '' when fold = 2 then regexp_replace(text, '[.!?]', '', 'g')
              else text end as text, unnest(range(case when fold = 3 then 2 else 1 end)) as copy
  from checked where fold <> 0),
placed as (
  select *, row_number() over (partition by conv order by turn nulls first, role, text) as pos,
         left(role, 1) as k,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as said
  from damaged),
marked as (
  select *, said = '' as blank, said <> '' and
         row_number() over (partition by conv, role, text order by pos) > 1 as duplicate,
         lag(k) over (partition by conv order by pos) || k as pair
  from placed),
faulty as (
  select *, blank or duplicate as gone,
         (not blank and not duplicate and right(said, 1) not in ('.', '!', '?'))::bigint as late
  from marked),
stats as (
  select conv, count(*) as n, count_if(blank)::bigint as blank,
         count_if(duplicate)::bigint as duplicate, sum(late)::bigint as truncated,
         count_if(pair not in ('su', 'ua', 'au'))::bigint as illegal,
         coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps
  from faulty group by conv),
paths as (
  select conv, n as pos, {", ".join(f"{x} as s{p}" for p, x in enumerate(end))} from stats
  union all
  select conv, pos - 1, {", ".join(best)}
  from (select conv, pos, {", ".join(own)} from paths join faulty using (conv, pos))),
done as (select conv, s0 from paths where pos = 0)
select distinct conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank,
       coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
       coalesce(illegal, 0) as illegal, coalesce(s0.c, 0) as cost, coalesce(s0.a, '') as audit,
       sha256(coalesce(array_to_string(s0.r, chr(10)), '')) as repaired_sha256
from numbered left join stats using (conv) left join done using (conv)
"""


ORACLE_SQL["op11_conversation_repair"] = _repair_sql()
