"""Fragments of DuckDB SQL for the oracle: the normalisation functions and blocking keys, written independently of the operators."""

from __future__ import annotations

from ..functions import vocabulary as V
from .entities import CTES


def words(items) -> str:
    return ", ".join("'" + x.replace("'", "''") + "'" for x in items)


def punct(x: str) -> str:
    return rf"regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}_\s\x{{85}}\p{{Z}}]', ' ', 'g')"


def alpha(x: str) -> str:
    return rf"regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}_]', '', 'g')"


def toks(x: str) -> str:
    return rf"list_filter(string_split_regex({x}, '\s+'), lambda t: t <> '')"


def no_legal(t: str) -> str:
    kept = f"list_filter({t}, lambda t: lower(t) NOT IN ({words(V.LEGAL)}))"
    return f"CASE WHEN len({kept}) > 0 THEN {kept} ELSE {t} END"


def standard(t: str) -> str:
    cases = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in V.ADDRESS.items())
    return f"list_transform({t}, lambda t: CASE lower(t) {cases} ELSE lower(t) END)"


def domain(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '^(https?://)?(www\.)?', '', 'i'), '\.(com|org|net|in|co|io|biz|info|us|gov|edu|ai|app|tech)\b', '', 'gi')"


def prefix(c: str) -> str:
    up = f"upper(trim(coalesce({c}, '')))"
    return f"CASE WHEN {up} = '' OR {up} IN ({words(V.NO_COUNTRY)}) THEN 'GLOBAL' ELSE {up} END"


def grams(x: str, n: int) -> str:
    return f"CASE WHEN length({x}) = 0 THEN [] WHEN length({x}) < {n} THEN [{x}] ELSE list_distinct(list_transform(range(1, length({x}) - {n} + 2), lambda i: substring({x}, i, {n}))) END"


def jaccard(a: str, b: str) -> str:
    union = f"len(list_distinct(list_concat({a}, {b})))"
    return f"CASE WHEN len({a}) > 0 AND len({b}) > 0 THEN len(list_intersect(list_distinct({a}), list_distinct({b})))::DOUBLE / {union} ELSE 0.0 END"


def keyed(source: str, out: str, variant: str = "serve") -> str:
    """CTEs that end in ``out (entity_id, pos, key_pos, block_key)``; key_pos ascends from 0."""
    train = variant == "train"
    known = (lambda x: f"CASE WHEN lower(trim({x})) IN ('nan', 'null', 'none') THEN '' ELSE trim({x}) END") if train else (lambda x: x)
    name, addr = known("coalesce(business_name, '')"), known("coalesce(business_address, '')")
    has = " OR ".join(f"contains(low, '{d}')" for d in (".com", ".in", ".org", ".net"))
    least = 4 if variant == "v4" else 3
    two = "len(t) >= 2" if variant == "v4" else f"len(t) >= 2 AND (t[1] NOT IN ({words(V.STOPWORDS)}) OR t[2] NOT IN ({words(V.STOPWORDS)}))"
    parts = [
        "CASE WHEN length(al) >= 4 THEN ['alpha:' || al] ELSE [] END",
        "CASE WHEN length(al) >= 6 THEN ['pfx6:' || substring(al, 1, 6)] ELSE [] END",
        "CASE WHEN length(al) >= 8 THEN ['pfx8:' || substring(al, 1, 8)] ELSE [] END",
        rf"list_transform(list_filter(t, lambda x: length(x) >= 4 AND x NOT IN ({words(V.STOPWORDS)}) AND NOT regexp_full_match(x, '\p{{Nd}}+')), lambda x: 'tok:' || x)",
        f"CASE WHEN {two} THEN ['2tok:' || t[1] || '_' || t[2]] ELSE [] END",
    ]
    if variant != "v4":
        parts.append(f"CASE WHEN ({has}) AND length(dal) >= 6 THEN ['dom6:' || substring(dal, 1, 6)] ELSE [] END")
    if train:
        parts.append(f"CASE WHEN ({has}) THEN list_transform(list_filter({toks(punct('dom'))}, lambda x: length(x) >= 4 AND x NOT IN ({words(V.STOPWORDS)})), lambda x: 'tok:' || x) ELSE [] END")
        parts.append(r"list_transform(regexp_extract_all(ap, '\b\d{5,6}\b'), lambda x: 'zip:' || x)")
    parts.append("CASE WHEN len(nums) > 0 AND len(street) > 0 THEN ['anum:' || nums[1] || '_' || street[1]] ELSE [] END")
    listed = " || ".join(f"({p})" for p in parts)
    return rf"""
{out}_a AS (SELECT entity_id, pos, {prefix('country')} AS c, lower({name}) AS low, {alpha(name)} AS al, {no_legal(toks(punct(name)))} AS t, {domain(f'lower({name})')} AS dom, {punct(addr)} AS ap FROM {source}),
{out}_b AS (SELECT *, {alpha('dom')} AS dal, regexp_extract_all(ap, '\b\d+\b') AS nums,
  list_filter({standard(toks('ap'))}, lambda x: NOT regexp_full_match(x, '\p{{Nd}}+') AND length(x) >= {least} AND x NOT IN ({words(V.STOPWORDS)})) AS street FROM {out}_a),
{out}_k AS (SELECT entity_id, pos, c, {'list_distinct' if train else ''}({listed}) AS ks FROM {out}_b),
{out} AS (SELECT entity_id, pos, CAST(i - 1 AS INT) AS key_pos, c || '|' || ks[i] AS block_key FROM (SELECT *, unnest(range(1, len(ks) + 1)) AS i FROM {out}_k))"""


def met(cap: int, variant: str = "serve") -> str:
    """CTEs that end in ``met``: all meetings on active keys."""
    keep = f"< {cap}" if variant != "train" else f"<= {cap}"
    return f"""
{keyed('s1', 'qk', variant)},
{keyed('pool', 'pk', variant)},
active AS (SELECT block_key, count(*) AS bucket_len FROM pk GROUP BY block_key HAVING count(*) {keep}),
met AS (SELECT q.entity_id AS s1_id, p.entity_id AS noisy_id, q.key_pos AS s1_key_pos, p.pos AS noisy_pos, p.key_pos AS noisy_key_pos, block_key, bucket_len
        FROM pk p JOIN active USING (block_key) JOIN qk q USING (block_key))"""


def weight(key: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in V.KEY_WEIGHTS.items())
    return rf"CASE regexp_extract({key}, '\|([a-z0-9]+):', 1) {cases} ELSE 0.5 END"


def sql(body: str, *ctes: str) -> str:
    return f"WITH {', '.join(x.strip() for x in (CTES, *ctes))} {body}"
