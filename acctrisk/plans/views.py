"""The input relations of the registered queries, derived from the given parquet tables.

Each view is one SQL text that Spark and the SQL check both understand; only the date functions
differ. ``{name}`` marks an input table or another view.
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from acctrisk.params import ScoringParams

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# the last order date of the given tables
PARAMS = ScoringParams(snapshot_date=date(2001, 8, 1))
SNAPSHOT = "date '2001-08-01'"

_DIALECTS = {
    "spark": {
        "CONTRACT_END": "date_add(date '2001-07-02', cast((c_custkey*37)%365 as int))",
        "MONTH": "date_format(o_orderdate, 'yyyy-MM')",
        "NL": "'\\n'",
        "CHR": "char",
    },
    "duckdb": {
        "CONTRACT_END":
            "cast(date '2001-07-02' + cast((c_custkey*37)%365 as int) as date)",
        "MONTH": "strftime(o_orderdate, '%Y-%m')",
        "NL": "chr(10)",
        "CHR": "chr",
    },
}

VIEWS = {
    "accounts_v": """
        select c_custkey as account_id, c_name as account_name,
               cast(floor(c_acctbal*10) as bigint) as arr, <CONTRACT_END> as contract_end_date,
               case c_mktsegment when 'AUTOMOBILE' then 'Starter' when 'BUILDING' then 'Growth'
                    when 'FURNITURE' then 'Scale' when 'MACHINERY' then 'Enterprise'
                    else c_mktsegment end as plan_tier,
               c_mktsegment as industry, n_name as csm_name, r_name as region
        from {customer} join {nation} on c_nationkey = n_nationkey
             join {region} on n_regionkey = r_regionkey""",
    "usage_v": """
        select o_custkey as account_id, <MONTH> as month,
               cast(sum(l_quantity) as bigint) as api_calls,
               count(*) as content_entries_created, count(distinct l_suppkey) as active_users,
               count(case when l_returnflag = 'R' then 1 end) as workflows_triggered,
               case max(o_orderkey) % 8 when 0 then 'v3.1.2' when 1 then 'v3.2.0'
                    when 2 then 'v3.4.1' when 3 then 'v4.0.0' when 4 then 'v4.1.0'
                    when 5 then 'v4.2.3' when 6 then 'v4.3.0' else 'v5.0.0' end as sdk_version
        from {orders} join {lineitem} on l_orderkey = o_orderkey
        group by o_custkey, <MONTH>""",
    "order_usage_v": """
        select o_custkey as account_id, <MONTH> as month, o_orderkey as api_calls,
               cast(floor(o_totalprice) as bigint) as content_entries_created,
               o_orderkey % 90 as active_users, o_orderkey % 7 as workflows_triggered,
               case when o_orderkey % 5 > 0 then concat('v', cast(o_orderkey % 5 as varchar(9)),
                    '.', cast(o_orderkey % 3 as varchar(9)), '.0') end as sdk_version
        from {orders}""",
    "tickets_v": """
        select o_orderkey as ticket_id, o_custkey as account_id,
               cast(o_orderdate as date) as created_date,
               concat('P', substr(o_orderpriority, 1, 1)) as priority,
               case o_orderstatus when 'O' then 'Open' when 'P' then 'Escalated'
                    else 'Closed' end as status,
               case when o_orderstatus = 'F' then cast(o_orderkey % 200 as double) end
                   as resolution_time_hours
        from {orders}""",
    "nps_v": """
        select doc_id as account_id, cast(n_chars % 11 as bigint) as score,
               text as verbatim_comment, lang
        from {documents}""",
    # stand-ins for model output that arrives as tables
    "translations_v": """
        select doc_id as account_id, doc_id as seq, concat('[', lang, '] ', text) as translated,
               lang as language
        from {documents} where lang <> 'en'""",
    "sentiments_v": """
        select doc_id as account_id, doc_id as seq,
               case when toxic = 1 then 'negative' when quality = 1 then 'positive'
                    else 'neutral' end as sentiment,
               (toxic = 1 and quality = 0) as score_contradicts,
               cast(case when toxic = 1 then 0.25 when quality = 1 then -0.15 else 0.0 end
                   as double) as risk_boost
        from {labels}""",
    # note analyses as raw JSON, some of them invalid or incomplete
    "analyses_v": """
        select doc_id as account_id, doc_id as seq,
               case when doc_id % 13 = 1 then '{{"risk_score": 1.5, "sentiment": "negative"}}'
                    when doc_id % 13 = 2 then '{{}}'
                    when doc_id % 13 = 3 then '{{"risk_score": null, "sentiment": "negative"}}'
                    when doc_id % 13 = 4 then '{{"risk_score": "0.4", "champion_status": "lost"}}'
                    when doc_id % 13 = 5 then '{{"competitor_mentions": "A", "risk_score": 0.9}}'
                    when doc_id % 13 = 6 then '{{"sentiment": 5, "risk_score": 0.9}}'
                    when doc_id % 13 = 7 then 'no JSON at all'
               else concat('{{"sentiment": "', case when toxic = 1 then 'negative'
                           when quality = 1 then 'positive' else 'neutral' end,
                   '", "risk_score": ', case when toxic = 1 then '0.85' when quality = 1
                           then '0.1' else '0.6' end,
                   ', "competitor_mentions": [', case when toxic = 1 then '"Rival", "Other"'
                           else '' end,
                   '], "champion_status": "', case when toxic = 1 and quality = 0 then 'lost'
                           when toxic = 1 then 'at_risk' else 'active' end,
                   '", "key_concerns": ["quality ', cast(quality as varchar(9)), '", "toxic ',
                   cast(toxic as varchar(9)), '"], "recommended_actions": ["call ',
                   cast(doc_id as varchar(20)), '"], "summary": "Document ',
                   cast(doc_id as varchar(20)), '"}}') end as response_json
        from {labels}""",
    "explanations_v": """
        select c_custkey as account_id, concat('Renewal of ', c_name, ' needs attention.')
               as risk_explanation
        from {customer} where c_mktsegment <> 'BUILDING'""",
    # raw relations with defects for the quality checks
    "registrations_v": """
        select o_custkey as account_id, o_orderkey as ingest_order,
               case when o_orderkey % 17 = 0 then null else c_name end as account_name,
               cast(floor(o_totalprice - 20000) as bigint) as arr,
               cast(o_orderdate as date) as contract_end_date, c_mktsegment as plan_tier
        from {orders} join {customer} on o_custkey = c_custkey""",
    "raw_usage_v": """
        select account_id, month, api_calls * 100 - 2000 as api_calls, content_entries_created,
               active_users - 2 as active_users, workflows_triggered - 1 as workflows_triggered,
               case when api_calls % 50 = 0 then 'beta' when api_calls % 51 = 0 then null
                    else sdk_version end as sdk_version
        from {usage_v}""",
    "raw_nps_v": """
        select doc_id % 400 as account_id, doc_id as seq, n_chars % 15 - 2 as score,
               case when doc_id % 9 = 0 then '' else text end as verbatim_comment
        from {documents}""",
    "notes_v": """
        select conv_id as account_id, turn as note_idx, text as raw_text
        from {conversations}""",
    # named accounts for name resolution: one per distinct part name
    "named_accounts_v": """
        select 1000 + min(p_partkey) as account_id, p_name as account_name
        from {part} group by p_name""",
    # accounts with repeated names in several spellings
    "part_accounts_v": """
        select p_partkey as account_id,
               case when p_partkey % 2 = 0 then upper(p_name) else p_name end as account_name
        from {part}""",
    # one free-text note per part, naming an account by id, by name, by a misspelt name or not
    "part_notes_v": """
        select p_partkey as note_idx, concat(
               case p_partkey % 7
                   when 0 then concat('2026-03-20 | ', p_name, ' | James O.')
                   when 1 then concat('Mar 12 - ', p_name, ' (quarterly)')
                   when 2 then concat('3/15 acct ', cast(1000 + p_partkey % 400 as varchar(9)),
                                      ' - ', p_name, ' (sic) call.')
                   when 3 then concat('4/5 ', substr(p_name, 2, 40))
                   when 4 then concat('04/03 ', upper(p_name), '.')
                   when 5 then concat('march 30 - ', substr(p_name, position(' ' in p_name) + 1, 40),
                                      ' ', substr(p_name, 1, position(' ' in p_name) - 2), ' ')
                   else 'ping without any name' end,
               <NL>, 'They run ', p_type, ' in size ', cast(p_size as varchar(9)), '.')
               as raw_text
        from {part}""",
    # text files of several notes under a banner, with separators of several lengths
    "part_files_v": """
        select p_partkey as file_no, concat('=== CSM Call Notes', <NL>, '(internal)', <NL>, <NL>,
               'Mar 12 - ', p_name, <NL>, <NL>, '---', <NL>, <NL>, '4/5 ', p_name, ' (#12', <NL>,
               'second line', <NL>, '-----', <NL>, '   ', <NL>, '---', <NL>,
               '-- two dashes stay', <NL>, p_type, <NL>, '---', <NL>, <NL>, 'last ', p_brand,
               <NL>) as value
        from {part}""",
    # a changelog of two releases per part
    "part_changelogs_v": """
        select p_partkey as file_no, concat('# Changelog', <NL>, <NL>, '### v4.',
               cast(p_size % 10 as varchar(9)), '.', cast(p_partkey % 7 as varchar(9)),
               ' — May ', cast(1 + p_size % 28 as varchar(9)), ', 2001', <NL>,
               '**Deprecations**', <NL>,
               case p_partkey % 4
                   when 0 then '- ⚠️ SDK v3.x will stop after April 30, 2002. Upgrade to v4.2.3.'
                   when 1 then concat('- 🔴 SDK v4.2.0+ changes the response envelope of ', p_name)
                   when 2 then concat('- 🔴 ', p_name, ' API sunset moved until June 1 2003')
                   else concat('- plain line about ', p_name) end, <NL>,
               '- Fixed: hole in ', p_type, ' (CVE-2001-', cast(p_partkey as varchar(20)),
               '). Update.', <NL>, '---', <NL>, '### Upcoming — v9.9.9', <NL>,
               '- 🔴 This BREAKING line still belongs to the release above', <NL>,
               '### v5.0.', cast(p_size as varchar(9)), ' - soon', <NL>, '- 🔴 ', p_brand,
               ' breaking later', <NL>) as value
        from {part}""",
    # names with a missing character, swapped words or another case
    "misspelt_v": """
        select distinct case p_partkey % 3
                   when 0 then concat(substr(p_name, position(' ' in p_name) + 1, 40), ' ',
                                      substr(p_name, 2, position(' ' in p_name) - 2))
                   when 1 then upper(p_name)
                   else concat(substr(p_name, 1, 3), substr(p_name, 5, 40)) end as query
        from {part}""",
    # entities of every note from elsewhere, partly blank
    "note_external_v": """
        select p_partkey as note_idx,
               case when p_partkey % 5 = 0 then 1000 + p_partkey end as account_id,
               case p_partkey % 4 when 0 then '' when 1 then concat('The ', p_name) end
                   as account_name,
               case when p_partkey % 3 = 0 then 'Mar 12' end as date_str,
               case when p_partkey % 2 = 0 then 'James O.' else '' end as csm_name
        from {part}""",
    # external name matches for some of the names the notes use
    "name_matches_v": """
        select distinct lower(substr(p_name, 2, 40)) as input_name,
               1000 + p_size as matched_id,
               case when p_size % 3 = 0 then 'high' when p_size % 3 = 1 then 'medium'
                    else 'low' end as confidence
        from (select p_name, min(p_size) as p_size from {part} group by p_name) as p
        where p_size <= 25""",
}


def _references(text: str) -> set[str]:
    return set(re.findall(r"(?<!\{)\{(\w+)\}", text))


def _dialect(text: str, dialect: str) -> str:
    for mark, value in _DIALECTS[dialect].items():
        text = text.replace(f"<{mark}>", value)
    return text


# path -> schema, so that repeated reads of a table skip the footer job
_SCHEMAS: dict[str, StructType] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a lazy DataFrame."""
    text = _dialect(VIEWS[name], "spark")
    inputs = {
        t: view(spark, sf_dir, t) if t in VIEWS else read_table(spark, sf_dir, t)
        for t in _references(text)
    }
    return spark.sql(text, **inputs)


def with_views(body: str, **extra: str) -> str:
    """The check SQL: ``body`` after the views and extra relations it refers to by ``{name}``."""
    texts = {**VIEWS, **extra}
    order: list[str] = []

    def need(name: str) -> None:
        if name in order or name in TABLES:
            return
        for inner in sorted(_references(texts[name])):
            need(inner)
        order.append(name)

    for name in sorted(_references(body)):
        need(name)
    names = {n: n for n in (*TABLES, *texts)}
    parts = [f"{n} as ({_dialect(texts[n], 'duckdb').format(**names)})" for n in order]
    head = "with " + ",\n".join(parts) + "\n" if parts else ""
    return head + _dialect(body, "duckdb").format(**names)
