"""DuckDB SQL for the queries that it can express."""

WORD = r"[^\x20\x09-\x0D]"


def _bounded(rho: str) -> str:
    return f"(1 / least(0.2, greatest(0.01, {rho})) - 1)"


def _strength(groups: str, n: str, failed: str) -> str:
    """The strength of a beta prior fitted by moments to (n, failed) of groups, as a scalar query."""
    rho = "coalesce(case when spread * free > 0 then (npp - total * mean * mean - own * spread) / (spread * free) end, 0)"
    return f"""(
        select {_bounded(rho)} from (select *, mean * (1 - mean) as spread, total - nn / total - own as free from (
            select sum({n})::double as total, sum({failed}) / sum({n})::double as mean, count(*) - 1 as own,
                sum({n} * {n})::double as nn, sum({failed} * {failed} / {n}::double) as npp
            from {groups} where {n} > 0)))"""


def _strength_around(groups: str, mean: str) -> str:
    """The same around each group's own expected rate."""
    spread = f"{mean} * (1 - {mean})"
    return f"""(
        select {_bounded("coalesce(case when most > 0 then more / most end, 0)")} from (
            select sum(n * (b / n::double - {mean}) ** 2 - {spread}) as more, sum((n - 1) * {spread}) as most
            from {groups} where n > 0))"""


OP10 = rf"""
with numbered as (select row_number() over () as r, doc_id, source, coalesce(text, '') as text from documents),
words as (select *, regexp_extract_all(text, '{WORD}+') as ws,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) as lines from numbered),
spots as (select r, unnest(range(1, greatest(len(ws) - 1, 1))) as i, ws from words),
windows as (select r, i, count(*) over (partition by r, ws[i], ws[i + 1], ws[i + 2]) as times from spots),
covered as (select r, count(distinct i + k) as n_repeat_words
    from windows, (values (0), (1), (2)) as three(k) where times > 1 group by r),
signals as (select r, doc_id, source, len(ws)::bigint as n_words,
    coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, len(lines) as n_lines,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words from words left join covered using (r)),
judged as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    100 * n_symbols > 10 * word_chars or 100 * n_dup_lines > 30 * n_lines as soft_failed from signals),
hosts as (select source, count(*) as n, count(*) filter (base_failed or soft_failed) as f from judged group by source),
prior as (select sum(f) / sum(n)::double as mean, {_strength("hosts", "n", "f")} as strength from hosts),
rates as (select source, n + strength as total, (f + mean * strength) / (n + strength) as rate from hosts, prior),
verdicts as (select source, rate - 2 * sqrt(rate * (1 - rate) / (total + 1)) > 0.5 as bad from rates)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed and not (bad and soft_failed) as kept
from judged join verdicts on judged.source is not distinct from verdicts.source
"""

_UNESCAPED = "paragraph"
for _mark, _character in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&#x27;", "''"), ("&amp;", "&")):
    _UNESCAPED = f"replace({_UNESCAPED}, '{_mark}', '{_character}')"

OP9 = rf"""
with parsed as (select page_id, html,
    case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
named as (select page_id, html, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path,
    regexp_extract(html, '(?s)</h1>\s*<p>(?:<b>)?(.*?)</?(?:br|p)\b', 1) as paragraph from parsed),
rated as (select doc_id, max((toxic = 1 or quality = 0)::int) as bad from labels
    where (toxic = 1 or quality = 0) is not null group by doc_id),
lines as (select trim(split_part(text, chr(10), 1)) as line, (avg(bad) > 0.5)::int as bad
    from documents join rated using (doc_id) group by 1 having line <> ''),
outcomes as (select host, count(bad) as n, coalesce(sum(bad), 0) as b
    from named left join lines on trim({_UNESCAPED}) = line group by host),
labelled as (select *, regexp_replace(host, ':[0-9]*$', '') as name from outcomes),
two as (select *, array_to_string(string_split(name, '.')[-2:], '.') as last_two from labelled),
hosts as (select *, last_two in ('ac.uk', 'co.jp', 'co.uk', 'com.au', 'com.br', 'gov.uk', 'org.uk') as deep from two),
placed as (select host, n, b, case when deep then array_to_string(string_split(name, '.')[-3:], '.') else last_two end as domain,
    case when deep then last_two else string_split(name, '.')[-1] end as suffix from hosts),
suffixes as (select suffix, sum(n) as n, sum(b) as b from placed group by suffix),
suffix_rates as (select suffix, (b + mean * s) / (n + s) as suffix_rate from suffixes,
    (select coalesce((select sum(b) / nullif(sum(n), 0)::double from suffixes), 0) as mean, {_strength("suffixes", "n", "b")} as s)),
domains as (select domain, suffix_rate, sum(n) as n, sum(b) as b
    from placed join suffix_rates using (suffix) group by domain, suffix_rate, suffix),
domain_rates as (select domain, (b + suffix_rate * d) / (n + d) as domain_rate
    from domains, (select {_strength_around("domains", "suffix_rate")} as d)),
rated_hosts as (select host, n, b, domain_rate from placed join domain_rates using (domain)),
host_rates as (select host, n + h as total, (b + domain_rate * h) / (n + h) as rate
    from rated_hosts, (select {_strength_around("rated_hosts", "domain_rate")} as h)),
verdicts as (select host, rate - 1.64 * sqrt(rate * (1 - rate) / (total + 1)) > 0.5 as blocked from host_rates),
rules as (select * from (values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) as listed(verdict, rule_host, rule_path)),
fitting as (select page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) as rule,
    max_by(verdict, length(rule_host || rule_path)) as verdict
    from named, rules where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path) group by page_id)
select page_id, host, path, rule, coalesce(verdict, case when blocked then 'block' else 'allow' end) as verdict
from named left join verdicts using (host) left join fitting using (page_id)
"""

ORACLES: dict[str, str] = {"op9_host_reputation": OP9, "op10_host_rules": OP10}
