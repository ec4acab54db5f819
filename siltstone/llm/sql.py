"""SQL of the queries that SQL can express, for an independent engine on the same tables.

p2_found: ties of records without a time fall to the smallest id here; learned
currency comes before that in the operator.  p2_currency has both.
"""

from __future__ import annotations

from siltstone.llm import catalog as C


def _list(names: tuple[str, ...]) -> str:
    return ", ".join("'" + n.replace("'", "''") + "'" for n in names)


def _key(x: str) -> str:
    bare = rf"regexp_replace(regexp_replace(trim({x}, ' ' || chr(9) || chr(10) || chr(13)), '^[a-zA-Z][a-zA-Z0-9+.-]*://', ''), '(?i)(/+skill\.md)?/*$', '')"
    return f"nullif(array_to_string(list_transform(regexp_split_to_array({bare}, '/+'), lambda p, i: CASE WHEN i <= 3 THEN lower(p) ELSE p END), '/'), '')"


def _micros(x: str) -> str:
    t = f"trim({x}, ' ' || chr(9) || chr(10) || chr(13))"
    return (
        rf"CASE WHEN regexp_full_match({t}, '\d{{9,11}}') THEN TRY_CAST({t} AS BIGINT) * 1000000 "
        rf"WHEN regexp_full_match({t}, '\d{{8}}T\d{{6}}Z') THEN epoch_us(try_strptime({t}, '%Y%m%dT%H%M%SZ')) "
        rf"WHEN regexp_full_match({t}, '\d{{4}}-\d{{2}}-\d{{2}}[T ]\d{{2}}:\d{{2}}:\d{{2}}(\.\d+)?(Z|[+-]\d{{2}}:\d{{2}})?') "
        rf"THEN epoch_us(TRY_CAST(CASE WHEN regexp_matches({t}, '(Z|[+-]\d{{2}}:\d{{2}})$') THEN replace({t}, 'Z', '+00:00') ELSE {t} || '+00:00' END AS TIMESTAMPTZ)) END"
    )


P1 = f"""WITH RECURSIVE links AS (
    SELECT 'i ' || {_key('id')} AS x, 'i ' || {_key('dedup.near_duplicate_of')} AS y FROM skills
    UNION SELECT 'i ' || {_key('id')}, 'c ' || lower(trim(dedup.cluster)) FROM skills WHERE lower(trim(dedup.cluster)) NOT IN ('', {_list(C.NO_CLUSTER)})
    UNION SELECT 'i ' || {_key('skill_id')}, 'i ' || {_key('canonical_id')} FROM skill_metadata),
  e AS (SELECT x, y FROM links WHERE x <> y UNION SELECT y, x FROM links WHERE x <> y),
  r AS (SELECT x, x AS y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
  s AS (SELECT DISTINCT id, 'i ' || {_key('id')} AS k FROM skills),
  g AS (SELECT s.id, min(o.id) AS group_id, max(o.id) AS last FROM s JOIN r ON s.k = r.x JOIN s o ON o.k = r.y GROUP BY s.id)
SELECT group_id, id AS skill_id FROM g WHERE group_id <> last"""

_TIER = "CASE regexp_replace(lower(coalesce(trust_tier, '')), '[^a-z]+', '', 'g') " + " ".join(
    f"WHEN '{t.replace('-', '')}' THEN {i}" for i, t in enumerate(C.TIERS)
) + f" ELSE {len(C.TIERS)} END"


def _usable(column: str, stand_ins: tuple[str, ...]) -> str:
    plain = rf"regexp_replace(lower(trim({column}, ' ' || chr(9) || chr(10) || chr(13))), '\s+', ' ', 'g')"
    bare = rf"regexp_replace(regexp_replace({plain}, '^[(\[<]+', ''), '[)\]>.…]+$', '')"
    return rf"coalesce(regexp_matches({plain}, '[\p{{L}}\p{{N}}]') AND {plain} NOT IN ({_list(stand_ins)}) AND {bare} NOT IN ({_list(stand_ins)}), false)"


_STRIPPED = r"regexp_replace(regexp_replace(trim(description, ' ' || chr(9) || chr(10) || chr(13)), '\s+', ' ', 'g'), '(\s*(\[truncated\]|…|\.))+$', '')"
P2 = f"""WITH seen AS (SELECT id AS skill_id, max({_micros('first_seen')}) AS ts FROM skills GROUP BY id),
  m AS (SELECT DISTINCT skill_id, {_key('canonical_id')} AS g, {_TIER} AS tier, description, license, security, install_npx FROM skill_metadata WHERE canonical_id IS NOT NULL),
  k AS (SELECT m.*, ts, CASE WHEN {_usable('description', C.NO_DESCRIPTION)} THEN {_STRIPPED} END AS d FROM m LEFT JOIN seen USING (skill_id)
    WHERE g IN (SELECT g FROM m GROUP BY g HAVING count(DISTINCT skill_id) > 1)),
  u AS (SELECT g, skill_id, tier, ts, 'description' AS field_name FROM k WHERE d IS NOT NULL AND NOT EXISTS (SELECT 1 FROM k o WHERE o.g = k.g AND length(o.d) > length(k.d) AND starts_with(o.d, k.d))
    UNION ALL SELECT g, skill_id, tier, ts, 'license' FROM k WHERE {_usable('license', C.NO_LICENSE)}
    UNION ALL SELECT g, skill_id, tier, ts, 'security' FROM k WHERE {_usable('security', C.NO_SCAN)}
    UNION ALL SELECT g, skill_id, tier, ts, 'install_npx' FROM k WHERE {_usable('install_npx', C.STAND_INS)})
SELECT g AS canonical_id, field_name, skill_id FROM (SELECT *, row_number() OVER (PARTITION BY g, field_name ORDER BY tier, ts DESC NULLS LAST, skill_id) AS rn FROM u) WHERE rn = 1"""

# values by their last time in each group, one after the other; majority precedences; among untimed records only, the value with the fewest after it
P2_CURRENCY = f"""WITH seen AS (SELECT id AS skill_id, max({_micros('last_changed')}) AS ts FROM skills GROUP BY id),
  m AS (SELECT DISTINCT skill_id, {_key('canonical_id')} AS g, license, security FROM skill_metadata WHERE canonical_id IS NOT NULL),
  k AS (SELECT m.*, ts FROM m LEFT JOIN seen USING (skill_id) WHERE g IN (SELECT g FROM m GROUP BY g HAVING count(DISTINCT skill_id) > 1)),
  u AS (SELECT g, 'license' AS f, skill_id, ts, lower(trim(license)) AS v FROM k WHERE {_usable('license', C.NO_LICENSE)} UNION ALL SELECT g, 'security', skill_id, ts, lower(trim(security)) FROM k WHERE {_usable('security', C.NO_SCAN)}),
  l AS (SELECT g, f, v, max(ts) AS ts FROM u WHERE ts IS NOT NULL GROUP BY 1, 2, 3),
  s AS (SELECT f, v AS a, lead(v) OVER w AS b, ts, lead(ts) OVER w AS then_ts FROM l WINDOW w AS (PARTITION BY g, f ORDER BY ts, v)),
  c AS (SELECT f, a, b, count(*) AS n FROM s WHERE then_ts > ts GROUP BY 1, 2, 3),
  p AS (SELECT x.f, x.a, x.b FROM c x LEFT JOIN c y ON x.f = y.f AND x.a = y.b AND x.b = y.a WHERE x.n > coalesce(y.n, 0)),
  o AS (SELECT DISTINCT g, f, v FROM u WHERE (g, f) NOT IN (SELECT (g, f) FROM u WHERE ts IS NOT NULL)),
  e AS (SELECT x.g, x.f, x.v AS a, y.v AS b FROM o x JOIN p ON p.f = x.f AND p.a = x.v JOIN o y ON y.g = x.g AND y.f = x.f AND y.v = p.b),
  r AS (SELECT u.*, coalesce(n_after, 0) AS n_after, coalesce(n_before, 0) AS n_before FROM u LEFT JOIN (SELECT g, f, a AS v, count(*) AS n_after FROM e GROUP BY 1, 2, 3) USING (g, f, v) LEFT JOIN (SELECT g, f, b AS v, count(*) AS n_before FROM e GROUP BY 1, 2, 3) USING (g, f, v))
SELECT g AS canonical_id, f AS field_name, skill_id, n_after + n_before > 0 AS inferred FROM (SELECT *, row_number() OVER (PARTITION BY g, f ORDER BY ts DESC NULLS LAST, n_after, n_before DESC, skill_id) AS rn FROM r) WHERE rn = 1"""

_NEAR = r"""m AS (SELECT DISTINCT skill_id, description FROM skill_metadata), w AS (SELECT skill_id, regexp_extract_all(lower(description), '[\p{L}\p{N}]+') AS w FROM m),
  t AS (SELECT skill_id, len(w) AS n, unnest(w) AS word FROM w WHERE len(w) >= 8), e AS (SELECT *, row_number() OVER (PARTITION BY skill_id, word) AS k FROM t),
  near AS (SELECT a.skill_id AS a, b.skill_id AS b FROM e a JOIN e b ON a.word = b.word AND a.k = b.k AND a.skill_id < b.skill_id GROUP BY a.skill_id, b.skill_id, a.n, b.n
    HAVING count(*) * 10 >= 7 * (a.n + b.n - count(*)))"""
P4 = f"WITH {_NEAR} SELECT a AS skill_id_1, b AS skill_id_2 FROM near"

P3 = f"""WITH {_NEAR}, crawls AS (SELECT lower(head_sha) AS sha, min(epoch_us(crawled_at)) AS ts FROM crawl_state WHERE head_sha IS NOT NULL GROUP BY 1),
  arrived AS (SELECT id AS skill_id, min(coalesce(c.ts, {_micros('first_seen')})) AS ts FROM skills LEFT JOIN crawls c ON lower(source.commit) = c.sha GROUP BY id),
  h AS (SELECT DISTINCT skill_id, nullif(regexp_replace(lower(trim(content_hash)), '^sha256:', ''), '') AS h, ts FROM skill_metadata JOIN arrived USING (skill_id))
SELECT a.skill_id FROM h a JOIN h b ON a.h = b.h AND b.ts < a.ts
UNION SELECT CASE WHEN x.ts < y.ts THEN y.skill_id ELSE x.skill_id END FROM near JOIN arrived x ON near.a = x.skill_id JOIN arrived y ON near.b = y.skill_id WHERE x.ts <> y.ts"""

SQL = {"p1_found": P1, "p2_found": P2, "p2_currency": P2_CURRENCY, "p3_found": P3, "p4_found": P4}
