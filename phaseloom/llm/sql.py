"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from phaseloom.llm import chat, fim, mixing

OP2 = r"""WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256 FROM t WINDOW w AS (PARTITION BY t)"""


def op3() -> str:
    escaped = "replace({0}, chr(9243), chr(9243) || '0')"
    for c in chat.CONTROLS:
        escaped = f"replace({escaped}, '{c}', '{c[0]}' || chr(9243) || '1{c[1:]}')"
    return f"""WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
UNION ALL SELECT -1, k, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(k, role)),
t AS (SELECT *, CASE WHEN role = 'assistant' THEN 7 + length({escaped.format("text")}) ELSE 14 + length({escaped.format("role")}) + length({escaped.format("text")}) END AS n FROM r)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256, CAST(sum(n) AS BIGINT) AS formatted_chars, CAST(0 AS BIGINT) AS n_attachments, CAST(0 AS BIGINT) AS expanded_tokens FROM t GROUP BY conv_id"""


def _cases(column: str, weights: dict[str, int]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {w}" for k, w in weights.items()) + " ELSE 1 END" if weights else "1"


def _fill(name: str, source: str, parent: str, key: str) -> str:
    by = f"PARTITION BY {parent}" if parent else ""
    order = f"{by} ORDER BY CAST(cap AS DOUBLE) / w, {key}"
    return f"""{name}1 AS (SELECT *, coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c, sum(w) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rw FROM ({source})),
{name}2 AS (SELECT *, cap * rw <= (budget - c) * w AS filled FROM {name}1),
{name}3 AS (SELECT *, sum(CASE WHEN filled THEN cap ELSE 0 END) OVER ({by}) AS fc, sum(CASE WHEN filled THEN 0 ELSE w END) OVER ({by}) AS fw FROM {name}2),
{name} AS (SELECT *, CASE WHEN filled THEN cap ELSE ((budget - fc) * w) // greatest(fw, 1) END AS alloc FROM {name}3)"""


def op5(m: mixing.Mixture) -> str:
    num, den = m.share
    domains = f"SELECT *, least({num} * sum(supply) OVER () // {den}, sum(cap) OVER ()) AS budget FROM (SELECT domain, sum(cap) AS cap, sum(supply) AS supply, {_cases('domain', m.domain_weights)} AS w FROM leaf GROUP BY domain)"
    langs = f"SELECT l.domain, l.lang, l.cap, {_cases('lang', m.lang_weights)} AS w, doms.alloc AS budget FROM (SELECT domain, lang, sum(cap) AS cap FROM leaf GROUP BY domain, lang) l JOIN doms ON doms.domain = l.domain"
    sources = f"SELECT leaf.*, {_cases('source', m.source_weights)} AS w, langs.alloc AS budget FROM leaf JOIN langs ON langs.domain = leaf.domain AND langs.lang = leaf.lang"
    return f"""WITH r AS (SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang, CAST((coalesce(strlen(text), 0) + 3) // 4 AS BIGINT) AS n_tokens FROM documents),
d AS (SELECT *, {m.domain_sql} AS domain FROM r),
leaf AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS supply, CAST({m.max_epochs} * sum(n_tokens) AS BIGINT) AS cap FROM d GROUP BY domain, lang, source),
{_fill("doms", domains, "", "domain")},
{_fill("langs", langs, "domain", "lang")},
{_fill("srcs", sources, "domain, lang", "source")},
p AS (SELECT domain, lang, source, CASE WHEN supply > 0 THEN alloc // supply ELSE 0 END AS whole, CASE WHEN supply > 0 THEN alloc % supply ELSE 0 END AS part FROM srcs),
k AS (SELECT d.*, whole, part, md5('{m.seed}:' || whole || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM d JOIN p ON p.domain = d.domain AND p.lang = d.lang AND p.source = d.source),
c AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key) AS upto FROM k)
SELECT doc_id, domain, lang, source, n_tokens, CAST(unnest(range(CAST(whole + CASE WHEN part > 0 AND upto <= part THEN 1 ELSE 0 END AS BIGINT))) AS INT) AS epoch FROM c"""


def op7(rules: list[tuple[str, str, str]]) -> str:
    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    return f"""WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r AS (SELECT * FROM (VALUES {values}) t(verdict, h, p)),
m AS (SELECT page_id, max_by(h || p, length(h || p)) AS rule, max_by(r.verdict, length(h || p)) AS verdict FROM u JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT u.page_id, host, path, m.rule, coalesce(m.verdict, 'allow') AS verdict FROM u LEFT JOIN m ON m.page_id = u.page_id"""


def op13(f: fim.Fim) -> str:
    marked = " OR ".join(f"contains(text, '{m}')" for m in (f.prefix, f.suffix, f.middle))
    part = lambda a, b: f"array_to_string(list_slice(u, {a} + 1, {b}), '')"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('{f.seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(text, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS u, {", ".join(f"CAST('0x' || substr(h, {8 * k + 1}, 8) AS BIGINT) AS h{k + 1}" for k in range(4))} FROM d),
n AS (SELECT *, len(u) AS n, CASE WHEN text = '' OR {marked} OR h3 % 100 >= {f.percent} THEN 'plain' WHEN h4 % 100 < {f.spm_percent} THEN 'spm' ELSE 'psm' END AS form FROM u),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM n),
p AS (SELECT *, {part("0", "a")} AS p, {part("a", "b")} AS m, {part("b", "n")} AS s FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{f.prefix}' || p || '{f.suffix}' || s || '{f.middle}' || m ELSE '{f.suffix}' || s || '{f.prefix}' || p || '{f.middle}' || m END) AS output_sha256, sha256(text) AS restored_sha256 FROM p"""
