"""The check SQL of the registered queries, written independently of the operators.

All constants that meet floating point are cast to DOUBLE, because bare literals are decimals in
the checking engine. ``RELATIONS`` holds the building blocks, ``QUERIES`` one text per query.
"""

from __future__ import annotations

from acctrisk import fixed
from acctrisk.plans.views import SNAPSHOT, with_views


def rnd(value: str, digits: int) -> str:
    return f"(round_even(({value}) * {10 ** digits}::double, 0) / {10 ** digits}::double)"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def braces(text: str) -> str:
    """Protect literal braces from the relation marks."""
    return text.replace("{", "{{").replace("}", "}}")


def listed(values) -> str:
    return ", ".join(lit(v) for v in values)


METRICS = list(fixed.USAGE_METRICS)
SCORES = [c for c, _, _, _ in fixed.SIGNALS]


# ---- signals ---------------------------------------------------------------------------------

def _decline(m: str) -> str:
    early, late = f"early_{m}", f"late_{m}"
    return (f"(case when {early} > 0 then greatest(0::double, least(1::double, "
            f"-(({late} - {early}) / {early}))) else 0::double end)")


_USAGE_SCORE = " + ".join(f"{_decline(m)} * {s}::double" for m, s in fixed.USAGE_METRICS.items())
_EARLY_LATE = ",\n".join(
    f"sum({m}) filter (rn <= 2) / 2::double as early_{m}, "
    f"sum({m}) filter (rn > n - 2) / 2::double as late_{m}" for m in METRICS)

USAGE_SIG = f"""
    select account_id,
           case when n < 3 then {fixed.SPARSE_USAGE_SCORE}::double
                else {rnd(_USAGE_SCORE, 3)} end as usage_risk_score,
           case when n >= 3 then last_api end as api_calls_latest,
           case when n >= 3 then last_users end as active_users_latest,
           case when n >= 3 then {rnd(_decline('api_calls') + ' * -100::double', 1)} + 0::double
                end as api_calls_decline_pct,
           case when n >= 3 then {rnd(_decline('active_users') + ' * -100::double', 1)} + 0::double
                end as active_users_decline_pct,
           case when n >= 3 then last_sdk end as sdk_version
    from (select account_id, any_value(n) as n, {_EARLY_LATE},
                 arg_max(api_calls, rn) as last_api, arg_max(active_users, rn) as last_users,
                 arg_max(sdk_version, rn) as last_sdk
          from (select *, row_number() over (partition by account_id order by month) as rn,
                       count(*) over (partition by account_id) as n from {{usage_v}}) as u
          group by account_id) as p"""

# The same where a month may hold many rows: its smallest and its largest row stand for it.
_MONTH_ROWS = f"""
    select account_id, month, {", ".join(
        f"case side when 0 then first_row.{m} else last_row.{m} end as {m}"
        for m in [*METRICS, "sdk_version"])},
           row_number() over (partition by account_id order by month, side) as rn,
           sum(rows) over (partition by account_id, side) as n,
           count(*) over (partition by account_id) as kept
    from (select account_id, month, count(*) as rows, min(r) as first_row, max(r) as last_row
          from (select account_id, month, {{{{{", ".join(
              f"'{m}': {m}" for m in [*METRICS, "sdk_version"])}}}}} as r
                from {{order_usage_v}}) as s
          group by account_id, month) as g, (values (0), (1)) as sides(side)
    where side = 0 or rows > 1"""
_ANY_ROWS = f"""(
    select account_id, first(total) as n, {", ".join(
        f"sum({m}) filter (rn <= 2) / 2::double as early_{m}, "
        f"sum({m}) filter (rn > kept - 2) / 2::double as late_{m}" for m in METRICS)},
           arg_max(api_calls, rn) as last_api, arg_max(active_users, rn) as last_users,
           max(case when rn = kept then sdk_version end) as last_sdk
    from (select *, max(n) over (partition by account_id) as total from ({_MONTH_ROWS}) as m) as w
    group by account_id)"""
USAGE_ANY_ROWS = USAGE_SIG[:USAGE_SIG.index("from (select account_id, any_value(n)")] + (
    f"from {_ANY_ROWS} as p")

LATEST_USAGE = """
    select account_id, arg_max(api_calls, month) as api_calls_last,
           arg_max(active_users, month) as active_users_last,
           arg_max(sdk_version, month) as sdk_version_last,
           arg_max(active_users, month) filter (active_users is not null) as active_users_known,
           arg_max(sdk_version, month) filter (sdk_version is not null) as sdk_version_known
    from {usage_v} group by account_id"""

_SDK_RISK = """case when sdk_version in ('v3.1.2', 'v3.2.0') then 0.85
             when sdk_version like 'v3%' then 0.7 when sdk_version = 'v4.0.0' then 0.25
             when sdk_version = 'v4.1.0' then 0.15 else 0 end::double"""
_SDK_TEXT = """case
    when sdk_version in ('v3.1.2', 'v3.2.0') then 'On deprecated ' || sdk_version ||
         ' (security patches end April 30, 2026); '
         || 'On oldest SDK version, maximum migration effort required'
    when sdk_version like 'v3%' then 'On deprecated ' || sdk_version ||
         ' (security patches end April 30, 2026)'
    when sdk_version = 'v4.0.0' then
         'On v4.0.0, needs upgrade for locale fix and response envelope change'
    when sdk_version = 'v4.1.0' then
         'On v4.1.0, affected by v4.2.0 response envelope breaking change'
    when sdk_version in ('v4.2.3', 'v4.3.0') then 'On current ' || sdk_version ||
         ', no immediate SDK risk'
    else '' end"""

SDK_SIG = f"""
    select account_id, {_SDK_RISK} as sdk_risk_score, sdk_version, {_SDK_TEXT} as sdk_risk_factors
    from (select account_id, sdk_version_known as sdk_version from {{latest_usage}}) as k"""

ENG_SIG = f"""
    select account_id,
           case when ratio < 0.3::double then 0.9 when ratio < 0.5::double then 0.7
                when ratio < 0.75::double then 0.4 when ratio < 1 then 0.2
                else 0.05 end::double as engagement_risk_score,
           active_users, expected_users, {rnd('ratio', 2)} as engagement_ratio,
           {rnd('arr::double / greatest(active_users, 1)::double', 0)} as arr_per_active_user
    from (select *, active_users::double / expected_users::double as ratio
          from (select account_id, active_users_known as active_users, arr,
                       case plan_tier when 'Starter' then 3 when 'Growth' then 12
                            when 'Scale' then 35 when 'Enterprise' then 80 else 10 end::bigint
                            as expected_users
                from {{latest_usage}} left join {{accounts_v}} using (account_id)) as e) as r"""

TICKET_SIG = f"""
    select account_id,
           {rnd('''hp / total * 0.3::double + op / total * 0.3::double
                + (case when hours > 0 then least(1::double, hours / 96::double)
                        else 0.3::double end) * 0.2::double
                + least(1::double, total / 15::double) * 0.2::double''', 3)} as ticket_risk_score,
           total::bigint as total_tickets, hp::bigint as p1_p2_tickets,
           op::bigint as open_escalated, {rnd('hours', 1)} as avg_resolution_hours,
           recent as recent_ticket_count
    from (select account_id, count(*)::double as total,
                 (count(*) filter (priority in ('P1', 'P2')))::double as hp,
                 (count(*) filter (status in ('Open', 'Escalated')))::double as op,
                 coalesce(avg(resolution_time_hours), 0::double) as hours,
                 count(*) filter (created_date >= {SNAPSHOT} - 90) as recent
          from {{tickets_v}} group by account_id) as t"""

_NPS_BASE = """(case when score <= 6 then 0.8::double + (6 - score) * 0.033::double
              when score <= 8 then 0.3::double + (8 - score) * 0.15::double
              else 0.1::double * (10 - score) end)"""

NPS_SIG = f"""
    select n.account_id,
           {rnd(f'''greatest(0::double, least(1::double,
                {_NPS_BASE} + coalesce(s.risk_boost, 0::double)))''', 3)} as nps_risk_score,
           score as nps_score, verbatim_comment as nps_comment,
           coalesce(t.translated, verbatim_comment) as translated_comment,
           coalesce(t.language, 'English') as detected_language,
           coalesce(s.sentiment, 'neutral') as comment_sentiment,
           coalesce(s.score_contradicts, false) as sentiment_score_mismatch
    from {{nps_v}} as n left join {{translations_v}} as t on t.account_id = n.account_id
         left join {{sentiments_v}} as s on s.account_id = n.account_id"""

# ---- note analyses ---------------------------------------------------------------------------

def _json_field(name: str, kind: str) -> tuple[str, str]:
    """(is the field unusable, its value with the default) of a JSON column j."""
    at = f"j->'$.{name}'"
    type_ = f"json_type(j, '$.{name}')"
    text = f"(j->>'$.{name}')"
    if kind == "number":
        ok = (f"{type_} in ('BIGINT', 'UBIGINT', 'DOUBLE', 'VARCHAR') and "
              f"try_cast({text} as double) between 0 and 1")
        value = f"coalesce(try_cast({text} as double), 0.5::double)"
    elif kind == "list":
        ok = f"{type_} = 'ARRAY'"
        value = f"coalesce(array_to_string(from_json({at}, '[\"VARCHAR\"]'), '<SEP>'), '')"
    else:
        ok = f"{type_} = 'VARCHAR'"
        value = f"coalesce({text}, {lit(fixed.ANALYSIS_DEFAULTS[name])})"
    return f"({type_} is not null and not coalesce({ok}, false))", value


def _analyses_sql(plain: bool = False) -> str:
    """Validated analyses, under their own or the note-signal column names."""
    kinds = {
        "sentiment": "text", "risk_score": "number", "competitor_mentions": "list",
        "champion_status": "text", "key_concerns": "list", "recommended_actions": "list",
        "summary": "text",
    }
    fields = {n: _json_field(n, k) for n, k in kinds.items()}
    bad = " or ".join(b for b, _ in fields.values())
    names = {"sentiment": "csm_sentiment", "risk_score": "csm_risk_score",
             "recommended_actions": "csm_recommended_actions", "summary": "csm_summary"}
    names = {} if plain else names
    columns = ", ".join(
        v.replace("<SEP>", "|" if plain else ", " if n == "competitor_mentions" else "; ")
        + f" as {names.get(n, n)}" for n, (_, v) in fields.items())
    empty = braces("'{}'::json")
    return f"""
        select account_id, {columns}
        from (select account_id, case when {bad} then {empty} else j end as j
              from (select account_id, case when json_valid(response_json)
                           then response_json::json else {empty} end as j
                    from {{analyses_v}}) as a) as b"""


CSM_SIG = _analyses_sql()

# ---- composite -------------------------------------------------------------------------------

_MERGED_COLUMNS = """
    a.*, datediff('day', {s}, contract_end_date)::bigint as days_until_renewal,
    coalesce(u.usage_risk_score, 0.3::double) as usage_risk_score, api_calls_latest,
    active_users_latest, api_calls_decline_pct, active_users_decline_pct, u.sdk_version,
    coalesce(t.ticket_risk_score, 0.2::double) as ticket_risk_score, total_tickets,
    p1_p2_tickets, open_escalated, avg_resolution_hours, recent_ticket_count,
    coalesce(n.nps_risk_score, 0.5::double) as nps_risk_score, nps_score, nps_comment,
    translated_comment, detected_language, comment_sentiment, sentiment_score_mismatch,
    coalesce(c.csm_risk_score, 0.3::double) as csm_risk_score, csm_sentiment,
    competitor_mentions, champion_status, key_concerns, csm_recommended_actions, csm_summary,
    coalesce(k.sdk_risk_score, 0.2::double) as sdk_risk_score, sdk_risk_factors,
    coalesce(e.engagement_risk_score, 0.3::double) as engagement_risk_score, active_users,
    expected_users, engagement_ratio, arr_per_active_user""".replace("{s}", SNAPSHOT)

MERGED = f"""
    select {_MERGED_COLUMNS}
    from {{accounts_v}} as a left join {{usage_sig}} as u on u.account_id = a.account_id
         left join {{ticket_sig}} as t on t.account_id = a.account_id
         left join {{nps_sig}} as n on n.account_id = a.account_id
         left join {{csm_sig}} as c on c.account_id = a.account_id
         left join {{sdk_sig}} as k on k.account_id = a.account_id
         left join {{eng_sig}} as e on e.account_id = a.account_id"""

IN_WINDOW = "select * from {merged} where days_until_renewal between 0 and 90"


def weighted(weights) -> str:
    return " + ".join(f"{c} * {float(w)}::double" for c, w in zip(SCORES, weights))


CURRENT = fixed.WEIGHT_CONFIGS[fixed.CURRENT_CONFIG]

_DRIVERS = ", ".join(
    f"({i}, {c}, {lit(label)})" for i, (c, _, label, _) in enumerate(fixed.SIGNALS))
_REAL = " + ".join(
    f"(case when abs({c} - {d}::double) > 0.01::double then 1 else 0 end)"
    for c, _, _, d in fixed.SIGNALS)

RISK = f"""
    select * exclude (real), case when composite_risk_score >= 0.6::double then 'High'
             when composite_risk_score >= 0.35::double then 'Medium' else 'Low' end as risk_tier,
           coalesce((select string_agg(label || ' (' || round_even(s * 100::double, 0)::bigint
                                       || '%)', '; ' order by s desc, i)
                     from (select * from (values {_DRIVERS}) as d(i, s, label)
                           order by s desc, i limit 3) as x where s > 0.3::double),
                    {lit(fixed.NO_DRIVERS)}) as top_risk_drivers,
           case when real >= 4 then 'High' when real >= 2 then 'Medium' else 'Low' end
               as confidence_level
    from (select *, {rnd(weighted(CURRENT), 3)} as composite_risk_score, {_REAL} as real
          from {{in_window}}) as m"""

# ---- data quality ----------------------------------------------------------------------------

DEDUPED = """
    select account_id, ingest_order, account_name, arr, contract_end_date, plan_tier
    from (select *, row_number() over (partition by account_id order by ingest_order) as rn
          from {registrations_v}) as r where rn = 1"""

CLEAN_USAGE = "select account_id, month, " + ", ".join(
    f"greatest({m}, 0) as {m}" for m in METRICS) + ", sdk_version from {raw_usage_v}"
CLEAN_NPS = """
    select account_id, seq, greatest(0, least(10, score)) as score, verbatim_comment
    from {raw_nps_v}"""

UNKNOWN_VALUES = f"""
    select 'accounts' as source, 'plan_tier' as field, plan_tier as value, count(*) as n_rows
    from {{accounts_v}} where coalesce(plan_tier not in ({listed(fixed.PLAN_TIERS)}), true)
    group by plan_tier
    union all
    select 'tickets', 'priority', priority, count(*) from {{tickets_v}}
    where coalesce(priority not in ({listed(fixed.PRIORITIES)}), true) group by priority
    union all
    select 'tickets', 'status', status, count(*) from {{tickets_v}}
    where coalesce(status not in ({listed(fixed.STATUSES)}), true) group by status"""


def _orphans(source: str, facts: str, accounts: str) -> str:
    return f"""
        select '{source}' as source, count(*) as n_orphans,
               coalesce((select string_agg(account_id::varchar, ', ' order by account_id)
                from (select distinct account_id from {{{facts}}}
                      where account_id not in (select account_id from {{{accounts}}})
                      order by account_id limit 5) as five), '') as smallest_ids
        from (select distinct account_id from {{{facts}}}
              where account_id not in (select account_id from {{{accounts}}})) as o"""


LATE_ACCOUNTS = f"""
    select account_id from {{accounts_v}}
    where datediff('day', {SNAPSHOT}, contract_end_date) > 90"""
ORPHANS = " union all ".join([
    _orphans("usage", "usage_v", "late_accounts"), _orphans("tickets", "tickets_v", "late_accounts"),
    _orphans("nps", "nps_v", "late_accounts")])


def _warnings(*checks: tuple[str, str, str]) -> str:
    parts = [f"case when {n} > 0 then {lit(head)} || ({n})::bigint::varchar || {lit(tail)} end"
             for n, head, tail in checks]
    return f"concat_ws(' | ', {', '.join(parts)})"


def _report(source: str, warnings: str, before: str, after: str, relation: str) -> str:
    return (f"select {lit(source)} as source, true as is_valid, '' as errors, "
            f"{warnings} as warnings, {before} as rows_before, {after} as rows_after "
            f"from {relation} as c")


_ACCOUNT_COUNTS = f"""(
    select count(*) as n, (select count(*) from {{registrations_v}}) as before,
           count(*) filter (account_name is null) as no_name, count(*) filter (arr < 0) as neg,
           count(*) filter (arr <= 0) as zero,
           count(*) filter (contract_end_date < {SNAPSHOT} - 365) as stale,
           count(*) filter (plan_tier is null or plan_tier not in ({listed(fixed.PLAN_TIERS)}))
               as plans from {{deduped}})"""
_USAGE_COUNTS = f"""(
    select count(*) as n, {", ".join(f"count(*) filter ({m} < 0) as neg_{m}" for m in METRICS)},
           count(*) filter (api_calls > 10000000) as extreme,
           count(*) filter (not coalesce(regexp_matches(sdk_version, '^v[0-9]+[.][0-9]+'), false))
               as bad_sdk,
           (select count(*) from (select account_id from {{raw_usage_v}} group by account_id
                                  having count(distinct month) < 3) as s) as sparse
    from {{raw_usage_v}})"""
_TICKET_COUNTS = f"""(
    select count(*) as n,
           count(*) filter (coalesce(priority not in ({listed(fixed.PRIORITIES)}), true)) as pr,
           count(*) filter (coalesce(status not in ({listed(fixed.STATUSES)}), true)) as st,
           count(*) filter (resolution_time_hours < 0) as neg,
           count(*) filter (resolution_time_hours > 720) as long from {{tickets_v}})"""
_NPS_COUNTS = """(
    select count(*) as n, count(*) filter (score < 0 or score > 10) as outside,
           count(*) - count(distinct account_id) as dupes,
           count(*) filter (verbatim_comment = '') as empty from {raw_nps_v})"""

_CROSS = " union all ".join(
    f"select source || ' (cross-ref)', true, '', n_orphans::varchar || ' account IDs in ' || source"
    f" || ' not found in accounts.csv: [' || smallest_ids || ']...', 0::bigint, 0::bigint "
    f"from ({_orphans(source, facts, 'deduped')}) as x where n_orphans > 0"
    for source, facts in
    [("usage", "raw_usage_v"), ("tickets", "tickets_v"), ("nps", "raw_nps_v")])

REPORT = " union all ".join([
    _report("accounts.csv", _warnings(
        ("before - n", "Duplicate account IDs found: ", " rows. Keeping first occurrence."),
        ("no_name", "", " accounts missing account_name"),
        ("neg", "", " accounts have negative ARR. Setting to 0."),
        ("zero", "", " accounts have zero ARR (free tier?)"),
        ("stale", "", " accounts have contract_end_date > 1 year in the past (stale data)"),
        ("plans", "Unknown plan tiers: ", " rows"),
    ), "before", "n", _ACCOUNT_COUNTS),
    _report("usage_metrics.csv", _warnings(
        *[(f"neg_{m}", "", f" rows have negative {m}. Clamping to 0.") for m in METRICS],
        ("extreme", "", " rows have api_calls > 10M (potential data entry error)"),
        ("bad_sdk", "", " rows have invalid SDK version format"),
        ("sparse", "", " accounts have < 3 months of data (trends may be unreliable)"),
    ), "n", "n", _USAGE_COUNTS),
    _report("support_tickets.csv", _warnings(
        ("pr", "Unknown priority values: ", " rows"), ("st", "Unknown status values: ", " rows"),
        ("neg", "", " tickets have negative resolution time"),
        ("long", "", " tickets have resolution > 30 days (data quality issue?)"),
    ), "n", "n", _TICKET_COUNTS),
    _report("nps_responses.csv", _warnings(
        ("outside", "", " NPS scores outside 0-10 range. Clamping."),
        ("dupes", "", " duplicate NPS responses. Using latest per account."),
        ("empty", "", " NPS responses have no comment"),
    ), "n", "n", _NPS_COUNTS),
    _CROSS,
])

# The validated run: the scoring relations over the repaired inputs, no translations and no
# sentiments.
_CLEAN_ACCOUNTS = "select * replace (greatest(arr, 0) as arr) from {accounts_v}"


def _revised(text: str, **marks: str) -> str:
    for old, new in marks.items():
        text = text.replace("{" + old + "}", "{" + new + "}")
    return text


_VALIDATED = {
    "usage_v": "clean_usage", "nps_v": "clean_nps", "accounts_v": "clean_accounts",
    "translations_v": "no_translations", "sentiments_v": "no_sentiments",
    "latest_usage": "v_latest", "usage_sig": "v_usage", "nps_sig": "v_nps", "sdk_sig": "v_sdk",
    "eng_sig": "v_eng", "merged": "v_merged", "in_window": "v_window",
}

# Scores from the tickets alone, the other signals at their defaults.
_TICKETS_MERGED = f"""
    select a.*, datediff('day', {SNAPSHOT}, contract_end_date)::bigint as days_until_renewal,
           coalesce(t.ticket_risk_score, 0.2::double) as ticket_risk_score, total_tickets,
           p1_p2_tickets, open_escalated, avg_resolution_hours, recent_ticket_count,
           0.3::double as usage_risk_score, 0.5::double as nps_risk_score,
           0.3::double as csm_risk_score, 0.2::double as sdk_risk_score,
           0.3::double as engagement_risk_score
    from {{accounts_v}} as a left join {{ticket_sig}} as t on t.account_id = a.account_id"""

# ---- insights --------------------------------------------------------------------------------

_AT_RISK = "risk_tier in ('High', 'Medium')"


def pct(value: str) -> str:
    return f"round_even({value} * 100::double, 0)::bigint::varchar"


def _detail(pattern: tuple, *values: str) -> str:
    parts = pattern[2].split("{}")
    out = [lit(parts[0])]
    for value, text in zip(values, parts[1:], strict=True):
        out += [value, lit(text)]
    return f"{lit(pattern[1])} as insight_type, {' || '.join(out)} as insight_detail"


def _silent_churn(limit: float) -> str:
    return f"""
        select account_id, account_name, nps_score, usage_risk_score,
               {_detail(fixed.SILENT_CHURN, "nps_score::varchar", pct("usage_risk_score"))}
        from {{risk}} where nps_score >= 7 and usage_risk_score >= {limit}::double"""


SDK_CASCADE = f"""
    select account_id, account_name, sdk_version, total_tickets, p1_p2_tickets,
           {_detail(fixed.SDK_CASCADE, "sdk_version", "coalesce(total_tickets, 0)::varchar",
                    "coalesce(p1_p2_tickets, 0)::varchar")}
    from {{risk}} where sdk_version like 'v3%'"""
CHAMPION = f"""
    select account_id, account_name, champion_status, csm_summary,
           {_detail(fixed.CHAMPION_RISK, "champion_status", "coalesce(csm_summary, 'N/A')")}
    from {{risk}} where champion_status in ('at_risk', 'lost')"""
CONTRADICTION = f"""
    select account_id, account_name, nps_score,
           {_detail(fixed.NPS_CONTRADICTION, "coalesce(nps_score, 0)::varchar",
                    "substr(coalesce(nps_comment, ''), 1, 100)")}
    from {{risk}} where sentiment_score_mismatch"""
ALL_INSIGHTS = " union all ".join(
    f"select {lit(p[0])} as category, account_id, insight_type from ({text}) as x"
    for p, text in [
        (fixed.SILENT_CHURN, _silent_churn(0.4)), (fixed.SDK_CASCADE, SDK_CASCADE),
        (fixed.CHAMPION_RISK, CHAMPION), (fixed.NPS_CONTRADICTION, CONTRADICTION)])

SDK_DISTRIBUTION = f"""
    select sdk_version, count(*) as n_accounts, count(*) filter ({_AT_RISK}) as n_at_risk
    from {{risk}} where sdk_version is not null group by sdk_version"""
NPS_BUCKETS = """
    select count(*) filter (nps_score <= 6) as detractors,
           count(*) filter (nps_score between 7 and 8) as passives,
           count(*) filter (nps_score >= 9) as promoters from {risk}"""
INDUSTRY = f"""
    select industry, count(*) as n_at_risk, sum(arr)::bigint as total_arr
    from {{risk}} where {_AT_RISK} group by industry"""
TIERS = """
    select count(*) as n_accounts, count(*) filter (risk_tier = 'High') as n_high,
           count(*) filter (risk_tier = 'Medium') as n_medium,
           count(*) filter (risk_tier = 'Low') as n_low from {risk}"""
TOP15 = f"""
    select row_number() over (order by composite_risk_score desc, account_id) as rank,
           account_id, composite_risk_score,
           '- ' || account_name || ' (ID:' || account_id || '): Risk='
           || {pct("composite_risk_score")} || '% [' || risk_tier || '], ARR=$'
           || format('{{{{:,}}}}', arr) || ', Plan=' || coalesce(plan_tier, '?') || ', SDK='
           || coalesce(sdk_version, '?') || ', NPS=' || coalesce(nps_score::varchar, 'N/A')
           || ', Usage Decline Risk=' || {pct("usage_risk_score")} || '%, Tickets='
           || coalesce(total_tickets, 0) || ' (' || coalesce(p1_p2_tickets, 0)
           || ' P1/P2), Competitors=' || coalesce(competitor_mentions, 'none') || ', Champion='
           || coalesce(champion_status, 'unknown') || ', Renewal in ' || days_until_renewal
           || ' days. CSM: ' || coalesce(csm_summary, 'No notes') as line
    from {{risk}} order by composite_risk_score desc, account_id limit 15"""
DIGEST = f"""
    select 1::bigint as section, 0::double as weight,
           'Total accounts analyzed: ' || n_accounts as line from ({TIERS}) as t
    union all select 2, 0, 'Risk distribution: High=' || n_high || ', Medium=' || n_medium
           || ', Low=' || n_low from ({TIERS}) as t
    union all select 3, 0, '=== TOP 15 AT-RISK ACCOUNTS ==='
    union all select 4, -rank, line from ({TOP15}) as t
    union all select 5, 0, '=== SDK VERSION DISTRIBUTION ==='
    union all select 6, n_accounts, '- ' || sdk_version || ': ' || n_accounts || ' accounts ('
           || n_at_risk || ' at-risk)' from ({SDK_DISTRIBUTION}) as t
    union all select 7, 0, '=== NPS SCORE DISTRIBUTION ==='
    union all select 8, 0, 'Detractors (0-6): ' || detractors || ', Passives (7-8): ' || passives
           || ', Promoters (9-10): ' || promoters from ({NPS_BUCKETS}) as t
    union all select 9, 0, '=== INDUSTRY RISK BREAKDOWN ==='
    union all select 10, 0, '- ' || industry || ': ' || n_at_risk
           || ' at-risk accounts, total ARR=$' || format('{{{{:,}}}}', total_arr)
           from ({INDUSTRY}) as t"""

SUMMARY = f"""
    select count(*) as total_accounts_analyzed,
           count(*) filter (risk_tier = 'High') as high_risk_count,
           count(*) filter (risk_tier = 'Medium') as medium_risk_count,
           count(*) filter (risk_tier = 'Low') as low_risk_count,
           coalesce(sum(arr) filter ({_AT_RISK}), 0)::bigint as total_arr_at_risk,
           coalesce(sum(arr) filter (risk_tier = 'High'), 0)::bigint as high_risk_arr,
           {rnd("sum(round_even(composite_risk_score * 1000, 0)::bigint)::double"
                " / count(*)::double / 1000::double", 3)} as avg_risk_score,
           {rnd("median(composite_risk_score)", 3)} as median_risk_score
    from {{risk}}"""

_COUNTS = f"select category, count(*) as n_accounts from ({ALL_INSIGHTS}) as i group by category"
INSIGHT_COUNTS = f"""
    select category, coalesce(n_accounts, 0) as n_accounts
    from (values {", ".join(f"({lit(p[0])})" for p in (
        fixed.SILENT_CHURN, fixed.SDK_CASCADE, fixed.CHAMPION_RISK, fixed.NPS_CONTRADICTION))})
         as c(category) left join ({_COUNTS}) as n using (category)"""

# ---- back-test -------------------------------------------------------------------------------

TRUTH = """
    select *, coalesce(csm_sentiment = 'negative', false)
              or length(coalesce(competitor_mentions, '')) > 0
              or coalesce(champion_status = 'lost', false) or coalesce(nps_score, 5) <= 3
              or (coalesce(sdk_version like 'v3%', false) and coalesce(total_tickets, 0) > 5)
              as expected_high,
           coalesce(csm_sentiment, 'positive') = 'positive'
              and length(coalesce(competitor_mentions, '')) = 0
              and coalesce(champion_status, 'active') = 'active'
              and coalesce(nps_score, 5) >= 9 as expected_low
    from {risk}"""


def _metrics(configs) -> str:
    scored = " union all ".join(
        f"select {i} as place, {lit(name)} as config, account_id, expected_high, expected_low, "
        f"composite_risk_score, {weighted(w)} as score from {{truth}}" for i, (name, w) in enumerate(configs.items()))
    return f"""
        select config, place,
               {rnd("coalesce(avg(score) filter (expected_high)"
                    " - avg(score) filter (expected_low), 0::double)", 4)} as separation,
               {rnd("count(*) filter (expected_high and rn <= k)::double / any_value(k)", 4)}
                   as precision_at_k,
               {rnd("coalesce(count(*) filter (expected_high and score >= 0.6::double)::double"
                    " / nullif(count(*) filter (expected_high), 0), 0::double)", 4)} as recall,
               {rnd("coalesce(avg(score) filter (expected_high), 0::double)", 4)}
                   as avg_high_score,
               {rnd("coalesce(avg(score) filter (expected_low), 0::double)", 4)} as avg_low_score,
               count(*) filter (expected_high) as n_expected_high,
               count(*) filter (expected_low) as n_expected_low
        from (select *, row_number() over (partition by config
                        order by score desc, composite_risk_score desc, account_id) as rn,
                     greatest(1, count(*) filter (expected_high) over (partition by config)) as k
              from ({scored}) as s) as r
        group by config, place"""


METRICS_ALL = _metrics(fixed.WEIGHT_CONFIGS)
METRICS_CURRENT = _metrics({fixed.CURRENT_CONFIG: CURRENT})
VERDICT = f"""
    select (select config from {{metrics}} order by separation desc, place limit 1) as best_config,
           floor(rk)::bigint as current_rank, rk <= 2 as is_optimal
    from (select config, rank() over (order by separation desc)
                 + (count(*) over (partition by separation) - 1) / 2::double as rk
          from {{metrics}}) as r where config = {lit(fixed.CURRENT_CONFIG)}"""

# ---- exports ---------------------------------------------------------------------------------

EXPLAINED = f"""
    select r.*, case when {_AT_RISK} and x.risk_explanation is not null then x.risk_explanation
                else {lit(fixed.LOW_RISK_EXPLANATION)} end as risk_explanation
    from {{risk}} as r left join {{explanations_v}} as x on x.account_id = r.account_id"""


def _json_pairs(*pairs: tuple[str, str]) -> str:
    parts = [f"{lit(braces(chr(34) + name + chr(34) + ':'))} || {value}" for name, value in pairs]
    return "'{{' || " + " || ',' || ".join(parts) + " || '}}'"


def _text(value: str) -> str:
    return f"coalesce('\"' || {value} || '\"', 'null')"


def _number(value: str) -> str:
    return f"coalesce({value}::varchar, 'null')"


PAYLOAD = f"""
    select account_id, {_json_pairs(
        ("account_id", _number("account_id")), ("account_name", _text("account_name")),
        ("contract_end_date", _text("contract_end_date::varchar")), ("arr", _number("arr")),
        ("sdk_version", _text("sdk_version")), ("nps_score", _number("nps_score")),
        ("risk_tier", _text("risk_tier")), ("total_tickets", _number("total_tickets")))}
        as payload
    from {{risk}} where {_AT_RISK}"""

_SUMMARY_COLUMNS = [
    "total_accounts_analyzed", "high_risk_count", "medium_risk_count", "low_risk_count",
    "total_arr_at_risk", "high_risk_arr", "avg_risk_score", "median_risk_score"]
_CATEGORY_COUNTS = [
    (p[0], f"(select count(*) from ({ALL_INSIGHTS}) as i where category = {lit(p[0])})::varchar")
    for p in (fixed.SILENT_CHURN, fixed.SDK_CASCADE, fixed.CHAMPION_RISK, fixed.NPS_CONTRADICTION)]
INSIGHTS_REPORT = f"""
    select {_json_pairs(
        ("summary", _json_pairs(*[(c, f"{c}::varchar") for c in _SUMMARY_COLUMNS])),
        ("llm_insights", "'" + '""' + "'"),
        ("structured_insight_counts", _json_pairs(*_CATEGORY_COUNTS)))} as report
    from ({SUMMARY}) as s"""

# ---- notes and names -------------------------------------------------------------------------

_TRIMMED = "regexp_replace(regexp_replace({}, '^[\\s]+', ''), '[\\s]+$', '')"


def trimmed(text: str) -> str:
    return _TRIMMED.replace("{}", text)


def _split_notes(block: str) -> str:
    """Notes of the part files; ``block`` is what becomes of a trimmed block b."""
    return f"""
        select file_no, row_number() over (partition by file_no order by place) as note_idx,
               b as raw_text
        from (select file_no, place, {block} as b
              from (select file_no, generate_subscripts(parts, 1) as place,
                           {trimmed("unnest(parts)")} as b
                    from (select file_no, string_split_regex(value, '\\n---+\\n') as parts
                          from {{part_files_v}}) as s) as t) as u
        where b <> '' and not starts_with(b, '=== CSM')"""


_KEEP = trimmed(
    "case when starts_with(b, '=== CSM') then "
    "regexp_replace(b, '^=== CSM[^\\n]*(\\n[^\\n]+)*(\\n\\s*\\n|$)', '') else b end")

NOTE_IDS = f"""
    select note_idx, try_cast(nullif(regexp_extract(
               raw_text, {lit(braces(fixed.NOTE_ID_PATTERN))}, 1), '') as bigint) as account_id
    from {{part_notes_v}}"""


def _note_name(pattern: str) -> str:
    name = trimmed(f"regexp_extract(line, {lit(braces('(?i)' + pattern))}, 1)")
    for tail in (r"[.]+$", r"\s*\(sic\).*", r"(?i)\s+call\b.*"):
        name = f"regexp_replace({name}, {lit(tail)}, '')"
    return f"case when length({name}) > 3 then {name} end"


NOTE_NAMES = f"""
    select note_idx,
           coalesce({", ".join(_note_name(p) for p in fixed.NOTE_NAME_PATTERNS)}, '')
               as account_name
    from (select note_idx, string_split(raw_text, chr(10))[1] as line from {{part_notes_v}}) as n"""

FOUND_NOTES = """
    select note_idx, raw_text, account_id, account_name
    from {part_notes_v} join {note_ids} using (note_idx) join {note_names} using (note_idx)"""

_MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
_AFFECTED = "list_transform(regexp_extract_all({t}, '{p}', 1), lambda v: 'v' || v)"


def _flagged(marks: str) -> str:
    """Trimmed texts after one of the marks, as a list."""
    return (f"list_transform(regexp_extract_all(body, '[{marks}]\\s*(.+?)(?:\\n|$)', 1), "
            f"lambda t: {trimmed('t')})")


def _versions(prefix: str) -> str:
    pattern = prefix + r"(\d+\.\w+(?:\.\w+)?)"
    return (f"array_to_string(list_transform(regexp_extract_all(t, {lit(pattern)}, 1), "
            "lambda v: 'v' || v), '|')")


_CHANGELOG_ENTRIES = f"""list_concat(
    list_transform({_flagged("⚠️🔴")}, lambda t: {{{{
        'category': case when lower(t) like '%deprecat%' or lower(t) like '%sunset%'
                         then 'deprecation' else 'breaking_change' end,
        'description': t, 'affected_versions': {_versions("(?:SDK|v)")},
        'deadline': regexp_extract(t, '(?i)(?:before|by|after|until)\\s+((?:{_MONTHS})'
                    || '\\s+\\d+,?\\s*\\d{{{{4}}}})', 1)}}}}),
    list_transform(list_transform(
        regexp_extract_all(body, '(?:Patched|Fixed|CVE).*?(?:CVE-[\\d-]+).*?(?:\\n|$)'),
        lambda t: {trimmed("t")}), lambda t: {{{{
        'category': 'security', 'description': t, 'affected_versions': '', 'deadline': ''}}}}),
    list_transform(list_filter({_flagged("🔴")}, lambda t: lower(t) like '%breaking%'
                               or lower(t) like '%changes the response%'), lambda t: {{{{
        'category': 'breaking_change', 'description': t, 'affected_versions': {_versions("v")},
        'deadline': ''}}}}))"""

CHANGELOG = f"""
    select file_no, release_no, entry_no - 1 as entry_no, version, date, e.category,
           e.description, e.affected_versions, e.deadline
    from (select file_no, release_no, version, date, unnest(entries) as e,
                 generate_subscripts(entries, 1) as entry_no
          from (select file_no, release_no, version, date, {_CHANGELOG_ENTRIES} as entries
                from (select file_no, release_no,
                             'v' || regexp_extract(part, '^([\\d.]+)', 1) as version,
                             regexp_extract(part, '^[\\d.]+\\s*[-—–]\\s*([^\\n]+)', 1) as date,
                             substr(part, position(chr(10) in part)) as body
                      from (select file_no, unnest(parts[2:]) as part,
                                   generate_subscripts(parts[2:], 1) as release_no
                            from (select file_no, string_split(value, '### v') as parts
                                  from {{part_changelogs_v}}) as s) as p) as r) as l) as x"""


def _entities(external: str) -> str:
    return f"""
        select n.note_idx, raw_text, coalesce(x.account_id, n.account_id) as account_id,
               coalesce(nullif(x.account_name, ''), n.account_name) as account_name,
               coalesce(x.date_str, '') as date_str, coalesce(x.csm_name, '') as csm_name
        from {{found_notes}} as n left join {external} as x on x.note_idx = n.note_idx"""


NAME_LOOKUP = """
    select lower(account_name) as name_key, max(account_id) as account_id,
           arg_max(account_name, account_id) as account_name,
           arg_min(account_name, account_id) as first_name, min(account_id) as first_order
    from {part_accounts_v} group by 1"""

# Longest common subsequence by one pass over the characters of a, keeping the row of lengths
# for the prefixes of b: each new row is the running maximum of its candidates.
_LCS = """list_reduce(list_prepend(list_transform(range(length(b) + 1), lambda z: 0::bigint),
        list_transform(string_split(a, ''), lambda c: [ascii(c)::bigint])),
    lambda old, c: list_prepend(0::bigint, list_transform(range(1, length(b) + 1), lambda j:
        list_max(list_transform(range(1, j + 1), lambda i: greatest(old[i + 1],
            case when ascii(b[i]) = c[1] then old[i] + 1 else 0 end))))))[-1]"""


def _sorted_words(name: str) -> str:
    return (f"array_to_string(list_sort(list_filter(string_split_regex(lower({name}), '\\s+'), "
            "lambda w: w <> '')), ' ')")


def _fuzzy(queries: str) -> str:
    return f"""
        select query, account_name as match_name, account_id, score
        from (select *, row_number() over (partition by query order by score desc, account_id)
                        as rn
              from (select query, account_name, account_id,
                           200::double * {_LCS} / (length(a) + length(b)) as score
                    from (select query, account_name, account_id, {_sorted_words("query")} as a,
                                 {_sorted_words("account_name")} as b
                          from {queries} as q, {{named_accounts_v}} as n
                          where length(query) >= 3) as p) as s) as r
        where rn = 1 and score >= 65"""


TIERS_1_2 = """
    select n.note_idx, n.raw_text, n.account_id as own_id, n.account_name as own_name,
           i.account_id as by_id, i.account_name as id_name, e.account_id as exact_id,
           e.account_name as exact_name, m.account_id as ext_id, m.account_name as ext_name
    from {found_notes} as n left join {named_accounts_v} as i on i.account_id = n.account_id
         left join {named_accounts_v} as e on lower(e.account_name) = lower(n.account_name)
         left join (select input_name, account_id, account_name
                    from (select *, row_number() over (partition by input_name
                                    order by confidence, account_id) as rn
                          from {name_matches_v} join {named_accounts_v}
                               on account_id = matched_id
                          where confidence in ('high', 'medium')) as v where rn = 1) as m
              on m.input_name = n.account_name"""
OPEN_NAMES = """
    select distinct own_name as query from {tiers_1_2}
    where by_id is null and exact_id is null and ext_id is null and own_name <> ''"""
RECONCILED = """
    select note_idx, raw_text,
           coalesce(by_id, exact_id, ext_id, f.account_id, own_id) as account_id,
           case when by_id is not null then id_name when exact_id is not null then exact_name
                when ext_id is not null then ext_name
                else coalesce(f.match_name, own_name) end as account_name,
           case when by_id is not null then 'id' when exact_id is not null then 'exact'
                when ext_id is not null then 'external' when f.account_id is not null then 'fuzzy'
                else 'none' end as match_method
    from {tiers_1_2} left join {fuzzy_open} as f on f.query = own_name"""


def _by_account(notes: str, accounts: str) -> str:
    return f"""
        select t.account_id, coalesce(a.account_name, 'Account ' || t.account_id) as account_name,
               segment, n_notes, notes_text
        from (select account_id, segment, count(*) as n_notes,
                     string_agg(raw_text, chr(10) || chr(10) order by rn) as notes_text
              from (select *, (rn - 1) // 1000 as segment
                    from (select *, row_number() over (partition by account_id
                                        order by note_idx, raw_text) as rn
                          from {notes} where account_id is not null) as o) as s
              group by account_id, segment) as t
             left join {accounts} as a on a.account_id = t.account_id"""


RELATIONS = {
    "note_ids": NOTE_IDS,
    "changelog": CHANGELOG,
    "note_names": NOTE_NAMES,
    "found_notes": FOUND_NOTES,
    "tiers_1_2": TIERS_1_2,
    "tiers_strict": """
    select * replace (case when complete then ext_id end as ext_id,
                      case when complete then ext_name end as ext_name)
    from {tiers_1_2}, (
        select count(*) = 0 as complete from {tiers_1_2}
        where by_id is null and exact_id is null and own_name <> ''
              and own_name not in (select input_name from {name_matches_v})) as c""",
    "open_strict": OPEN_NAMES.replace("{tiers_1_2}", "{tiers_strict}"),
    "fuzzy_strict": _fuzzy("{open_strict}"),
    "reconciled_strict": RECONCILED.replace("{tiers_1_2}", "{tiers_strict}").replace(
        "{fuzzy_open}", "{fuzzy_strict}"),
    "open_names": OPEN_NAMES,
    "fuzzy_open": _fuzzy("{open_names}"),
    "reconciled": RECONCILED,
    "usage_sig": USAGE_SIG,
    "latest_usage": LATEST_USAGE,
    "sdk_sig": SDK_SIG,
    "eng_sig": ENG_SIG,
    "ticket_sig": TICKET_SIG,
    "nps_sig": NPS_SIG,
    "csm_sig": CSM_SIG,
    "merged": MERGED,
    "in_window": IN_WINDOW,
    "risk": RISK,
    "deduped": DEDUPED,
    "clean_usage": CLEAN_USAGE,
    "clean_nps": CLEAN_NPS,
    "clean_accounts": _CLEAN_ACCOUNTS,
    "no_translations": "select * from {translations_v} where false",
    "no_sentiments": "select * from {sentiments_v} where false",
    "v_latest": _revised(LATEST_USAGE, **_VALIDATED),
    "v_usage": _revised(USAGE_SIG, **_VALIDATED),
    "v_nps": _revised(NPS_SIG, **_VALIDATED),
    "v_sdk": _revised(SDK_SIG, **_VALIDATED),
    "v_eng": _revised(ENG_SIG, **_VALIDATED),
    "v_merged": _revised(MERGED, **_VALIDATED),
    "v_window": _revised(IN_WINDOW, **_VALIDATED),
    "v_risk": _revised(RISK, **_VALIDATED),
    "t_merged": _TICKETS_MERGED,
    "t_window": _revised(IN_WINDOW, merged="t_merged"),
    "t_risk": _revised(RISK, in_window="t_window"),
    "late_accounts": LATE_ACCOUNTS,
    "truth": TRUTH,
    "metrics": METRICS_ALL,
    "explained": EXPLAINED,
}

QUERIES = {
    "load_accounts": "select * from {accounts_v}",
    "load_usage": "select * from {raw_usage_v}",
    "load_tickets": """
        select ticket_id::varchar as ticket_id, * exclude (ticket_id) from {tickets_v}""",
    "load_nps": "select account_id, score, verbatim_comment from {raw_nps_v}",
    "load_notes": "select raw_text, account_id, account_name from {found_notes}",
    "load_conversation_notes": f"""
        select raw_text, try_cast(nullif(regexp_extract(
                   raw_text, {lit(braces(fixed.NOTE_ID_PATTERN))}, 1), '') as bigint) as account_id
        from (select {trimmed("raw_text")} as raw_text from {{notes_v}}) as n
        where raw_text <> '' and not starts_with(raw_text, '=== CSM')""",
    "load_changelog": """
        select version, date, category, description, affected_versions, deadline
        from {changelog}""",
    "split_notes": _split_notes("b"),
    "split_notes_keep_banner_note": _split_notes(_KEEP),
    "note_account_id": "select * from {note_ids}",
    "note_account_name": "select * from {note_names}",
    "parse_changelog": CHANGELOG,
    "note_entities": _entities("{note_external_v}"),
    "note_entities_unaligned": """
        select *, '' as date_str, '' as csm_name from {found_notes}""",
    "name_lookup": NAME_LOOKUP,
    "fuzzy_match": _fuzzy("{misspelt_v}"),
    "reconcile_notes_strict": "select * from {reconciled_strict}",
    "reconcile_notes": "select * from {reconciled}",
    "reconcile_by_id": """
        select note_idx, account_id, account_name from {reconciled} where match_method = 'id'""",
    "reconcile_exact": """
        select note_idx, account_id, account_name from {reconciled} where match_method = 'exact'""",
    "reconcile_annotated": """
        select note_idx, account_id, account_name from {reconciled}
        where match_method = 'external'""",
    "reconcile_rate": """
        select count(account_id) as n_matched, count(*) as n_notes,
               count(account_id)::double / count(*) as match_rate from {reconciled}""",
    "notes_by_account": _by_account("{notes_v}", "{accounts_v}"),
    "reconciled_notes_by_account": _by_account("{reconciled}", "{named_accounts_v}"),
    "usage_signals": "select * from {usage_sig}",
    "usage_signals_any_rows": USAGE_ANY_ROWS,
    "latest_usage": "select * from {latest_usage}",
    "sdk_risk": "select * from {sdk_sig}",
    "engagement_signals": "select * from {eng_sig}",
    "ticket_signals": "select * from {ticket_sig}",
    "nps_signals": "select * from {nps_sig}",
    "csm_signals": "select * from {csm_sig}",
    "merged_signals": "select * from {merged}",
    "merged_stand_alone": "select * from {merged}",
    "risk_scores": "select * from {risk}",
    "renewal_window": f"""
        select * from (select *, datediff('day', {SNAPSHOT}, contract_end_date)::bigint
                                 as days_until_renewal from {{accounts_v}}) as a
        where days_until_renewal between 0 and 90""",
    "composite_risk": "select account_id, composite_risk_score, risk_tier from {risk}",
    "risk_ranking": """
        select account_id, account_name, composite_risk_score, risk_tier from {risk}
        order by composite_risk_score desc, account_id""",
    "top_drivers": "select account_id, top_risk_drivers from {risk}",
    "confidence": "select account_id, confidence_level from {risk}",
    "risk_summary": SUMMARY,
    "tickets_only_risk": "select * from {t_risk}",
    "dq_dedupe_accounts": "select * from {deduped}",
    "dq_duplicate_ids": """
        select account_id, count(*) - 1 as surplus_rows from {registrations_v}
        group by account_id having count(*) > 1""",
    "dq_clamp_arr": "select account_id, greatest(arr, 0) as arr from {accounts_v}",
    "dq_clamp_usage": "select * from {clean_usage}",
    "dq_clamp_nps": "select * from {clean_nps}",
    "dq_unknown_values": UNKNOWN_VALUES,
    "dq_sparse_accounts": """
        select account_id, count(distinct month) as n_months from {usage_v}
        group by account_id having count(distinct month) < 3""",
    "dq_orphan_ids": ORPHANS,
    "dq_report": REPORT,
    "validated_risk": """
        select account_id, arr, composite_risk_score, risk_tier, top_risk_drivers from {v_risk}""",
    "pipeline_counters": """
        select 'sdk_accounts' as counter, count(*) as n from {sdk_sig}
        union all select 'v3_accounts', count(*) from {sdk_sig} where sdk_version like 'v3%'
        union all select 'nps_rows', count(*) from {nps_sig}
        union all select 'translated_comments', count(*) from {nps_sig}
                  where detected_language <> 'English'""",
    "insight_silent_churn": _silent_churn(0.2),
    "insight_sdk_cascade": SDK_CASCADE,
    "insight_champion": CHAMPION,
    "insight_contradiction": CONTRADICTION,
    "all_insights": ALL_INSIGHTS,
    "insight_counts": INSIGHT_COUNTS,
    "sdk_distribution": SDK_DISTRIBUTION,
    "nps_buckets": NPS_BUCKETS,
    "industry_risk": INDUSTRY,
    "top15_digest": TOP15,
    "dataset_digest": DIGEST,
    "digest_text": f"""
        select string_agg(case when section in (3, 5, 7, 9) then chr(10) || line else line end,
                          chr(10) order by section, weight desc, line) as digest
        from ({DIGEST}) as d""",
    "ground_truth": "select account_id, expected_high, expected_low from {truth}",
    "weight_metrics": f"select * exclude (place) from ({METRICS_CURRENT}) as m",
    "weight_sensitivity": "select * exclude (place) from {metrics}",
    "weight_verdict": VERDICT,
    "report_filter": f"""
        select account_id, risk_tier, plan_tier, arr from {{risk}}
        where {_AT_RISK} and plan_tier in ('Starter', 'Scale') and arr >= 10000""",
    "report_tier_counts": "select risk_tier, count(*) as n_accounts from {risk} group by risk_tier",
    "report_arr_by_tier": """
        select risk_tier, sum(arr)::bigint as total_arr from {risk} group by risk_tier""",
    "report_risk_map": """
        select account_name, risk_tier, composite_risk_score, arr, plan_tier, days_until_renewal,
               top_risk_drivers from {risk}""",
    "report_account": """
        select * from {risk} where account_name = 'Customer#000000003'
        order by composite_risk_score desc, account_id limit 1""",
    "report_signal_breakdown": " union all ".join(
        f"select account_id, {lit(label)} as signal, {c} as score from {{risk}}"
        for c, label in zip(SCORES, fixed.BREAKDOWN_LABELS)),
    "report_heatmap": f"""
        select account_id, account_name, {", ".join(SCORES)} from {{risk}} where {_AT_RISK}
        order by composite_risk_score desc, account_id limit 20""",
    "report_sdk_tier": """
        select sdk_version, risk_tier, count(*) as n_accounts from {risk}
        where sdk_version is not null group by sdk_version, risk_tier""",
    "report_plan_tier": """
        select plan_tier, risk_tier, count(*) as n_accounts from {risk}
        where plan_tier is not null group by plan_tier, risk_tier""",
    "report_top20": """
        select row_number() over (order by composite_risk_score desc, account_id) as rank,
               account_name, composite_risk_score, risk_tier, arr, days_until_renewal,
               sdk_version, top_risk_drivers
        from {risk} order by composite_risk_score desc, account_id limit 20""",
    "annotation_defaults": _analyses_sql(plain=True),
    "nps_translation": """
        select n.account_id, score, coalesce(translated, verbatim_comment) as translated_comment,
               coalesce(language, 'English') as detected_language
        from {nps_v} as n left join {translations_v} as t on t.account_id = n.account_id""",
    "nps_annotation_requests": """
        select n.account_id, score, coalesce(nullif(translated, ''), verbatim_comment) as comment
        from {nps_v} as n left join {translations_v} as t on t.account_id = n.account_id
        where length(trim(coalesce(nullif(translated, ''), verbatim_comment), ' ')) > 5""",
    "non_latin_comments": braces("""
        select account_id, verbatim_comment from <nps_v>
        where regexp_matches(verbatim_comment, '[^\\x{0}-\\x{7F}]')""").replace(
            "<nps_v>", "{nps_v}"),
    "batch_annotate": """
        select account_id, note_idx, n_words,
               case when n_words > 20 then 'long' else 'short' end as mood
        from (select account_id, note_idx,
                     len(list_filter(string_split_regex(raw_text, '\\s+'), lambda x: x <> ''))
                     as n_words from {notes_v}) as w""",
    "briefing_payload": PAYLOAD,
    "explanations": "select account_id, risk_tier, risk_explanation from {explained}",
    "export_risk_scored": f"select {', '.join(fixed.EXPORT_COLUMNS)} from {{explained}}",
    "export_detailed_signals": "select * exclude (risk_explanation) from {explained}",
    "account_briefings": """
        select account_id, account_name, risk_tier, composite_risk_score as risk_score, arr,
               risk_explanation as explanation from {explained}""",
    "insights_summary": INSIGHTS_REPORT,
}


# The same results from the stored accounts.
QUERIES |= {
    "stored_filter": QUERIES["report_filter"],
    "stored_tier_counts": QUERIES["report_tier_counts"],
    "stored_heatmap": QUERIES["report_heatmap"],
    "stored_export": QUERIES["export_risk_scored"],
}


def all_sql() -> dict[str, str]:
    return {name: with_views(text, **RELATIONS) for name, text in QUERIES.items()}
