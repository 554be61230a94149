"""The catalog queries in DuckDB's SQL."""

from __future__ import annotations

from vitrina.functions import rules

_ABBR = "MAP {" + ", ".join(f"'{a}': '{b}'" for a, b in rules.ABBREVIATIONS.items()) + "}"
_CATEGORY = "CASE " + " ".join(f"WHEN regexp_matches(nombre_limpio, '(^|[^A-Za-z])(?:{'|'.join(k)})') THEN '{c}'" for c, k in rules.CATEGORIES) + f" ELSE '{rules.OTHER}' END"
_NAMES = rf"""
WITH raw AS (SELECT p_partkey AS ref, p_brand AS marca, (['FILT', 'AMOR TRAS IZ', 'JGO', 'ACEIT 10W30', 'LLANTA 185/65R15', 'GORRA', 'BATERIA', 'PTAL', 'MOT'])[p_partkey % 9 + 1]
    || '  ' || upper(p_name) || ' ' || p_type || ' ' || (p_size % 5 + 1) || 'LX' || (p_size % 12 + 1) || 'UND' AS nombre FROM part),
clean AS (SELECT ref, marca, regexp_replace(regexp_replace(regexp_replace(regexp_replace(upper(trim(nombre)), '\s+', ' ', 'g'), '\bDELANTEROANTERO\b', 'DELANTERO', 'g'), '\bUNID\b', 'UND', 'g'), '\bJGO\b', 'JUEGO', 'g') AS c FROM raw),
full_ AS (SELECT ref, marca, array_to_string(list_transform(string_split(c, ' '), lambda t: coalesce({_ABBR}[t], t)), ' ') AS f FROM clean),
sized AS (SELECT *, trim(regexp_extract(f, '(?i)\b\d+L?\s?X\s?\d+\s?(?:UN[DI]{{0,2}})?\b', 0)) AS pack, regexp_extract(f, '(?i)\b(\d+(?:[.,]\d+)?)\s?L(?:X|\b)', 1) AS v FROM full_),
norm AS (SELECT ref, marca, pack, CASE WHEN v <> '' THEN upper(v) || 'L' ELSE '' END AS litraje,
  CASE WHEN v <> '' THEN trim(regexp_replace(f, '(?i)\b(\d+(?:[.,]\d+)?\s?L)\s?X\s?\d+\s?(?:UN[DI]{{0,2}})?\b', '\1')) ELSE f END AS nombre_limpio FROM sized)
"""
_POOL = """
WITH pool AS (SELECT user_id || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS ref, event_id AS pos, CASE WHEN event_id % 17 = 0 THEN 'ftp://x/' ELSE 'http://x/' END || (event_id % 23) AS link,
  CASE WHEN event_id % 5 = 0 THEN '' ELSE 't' || (event_id % 13) END AS thumb, CAST(300 + event_id % 700 AS INTEGER) AS width, CAST(350 + event_id * 7 % 1300 AS INTEGER) AS height,
  CASE WHEN event_id % 11 = 0 THEN 'WWW.Shutterstock.com' ELSE 'img.example.org' END AS host, event_id % 100 / 100.0 AS bg_score FROM events)
"""
_FUNNEL = """
WITH o AS (SELECT o_custkey AS ref, count(*) AS n_cse, count(*) FILTER (o_orderstatus = 'F') AS n_kept, count(*) FILTER (o_orderstatus = 'F' AND o_totalprice > 200000) AS n_sel FROM orders GROUP BY 1),
g AS (SELECT c_custkey AS ref, coalesce(n_cse, 0) AS n_cse, coalesce(n_kept, 0) AS n_prefiltro, coalesce(n_sel, 0) > 0 AS seleccionada FROM customer LEFT JOIN o ON c_custkey = o.ref),
f AS (SELECT ref, n_cse, n_prefiltro, n_prefiltro AS n_evaluadas, seleccionada, CASE WHEN n_prefiltro = 0 THEN '-' ELSE (['alta', 'media', 'baja'])[ref % 3 + 1] END AS confianza,
  CASE WHEN n_prefiltro = 0 THEN '-' ELSE coalesce(nullif(concat_ws(', ', CASE WHEN NOT seleccionada THEN 'sin_imagen' END, CASE WHEN ref % 3 = 0 THEN 'necesita_fallback' END, CASE WHEN ref % 5 = 0 THEN 'revisar_marca' END), ''), '-') END AS flags FROM g)
"""
_WIDE = """
WITH pool AS (SELECT user_id % 50 AS ref, event_id AS pos, CASE WHEN event_id % 6 = 0 THEN 'https://http2.mlstatic.com/D_' || (event_id % 40) || '-O.jpg' WHEN event_id % 6 = 1 THEN 'https://a.example/wp-content/uploads/i' || (event_id % 30) || '-300x200.png'
    ELSE CASE WHEN event_id % 17 = 0 THEN 'ftp://x/' ELSE 'http://x/' END || (event_id % 223) END AS link,
  CASE WHEN event_id % 5 = 0 THEN '' ELSE 't' || (event_id % 131) END AS thumb, CAST(250 + event_id % 700 AS INTEGER) AS width, CAST(250 + event_id * 7 % 1300 AS INTEGER) AS height,
  CASE WHEN event_id % 11 = 0 THEN 'WWW.Shutterstock.com' ELSE 'img.example.org' END AS host, event_id % 100 / 100.0 AS bg_score, CASE WHEN event_id % 9 <> 0 THEN event_id % 16 * 4369 END AS phash FROM events),
measured AS (SELECT 'https://http2.mlstatic.com/D_' || i || '-F.jpg' AS l, CAST(200 + i * 30 AS INTEGER) AS w, CAST(500 + i * 60 AS INTEGER) AS h FROM range(40) t(i)
  UNION ALL SELECT 'https://a.example/wp-content/uploads/i' || i || '.png', 900, CAST(300 + i * 40 AS INTEGER) FROM range(30) t(i)),
big AS (SELECT * FROM measured WHERE least(w, h) >= 400 AND greatest(w, h)::DOUBLE / greatest(least(w, h), 1) <= 3),
tried AS (SELECT pool.*, l, w, h, l IS NOT NULL AND NOT starts_with(link, 'ftp') AND least(width, height) < 400 AS recovered
  FROM pool LEFT JOIN big ON l = CASE WHEN contains(link, 'mlstatic.com') THEN replace(link, '-O.jpg', '-F.jpg') WHEN contains(link, 'wp-content') THEN replace(link, '-300x200', '') END),
hard AS (SELECT ref, pos, thumb, host, bg_score, phash, recovered, CASE WHEN recovered THEN l ELSE link END AS link, CASE WHEN recovered THEN w ELSE width END AS width, CASE WHEN recovered THEN h ELSE height END AS height,
  CASE WHEN NOT starts_with(link, 'http') THEN 'url_invalido ' || link[1:40] WHEN recovered THEN NULL WHEN least(width, height) < 400 THEN 'resolucion_baja ' || width || 'x' || height
  WHEN greatest(width, height)::DOUBLE / greatest(least(width, height), 1) > 3 THEN 'aspect_ratio_extremo ' || width || 'x' || height WHEN contains(lower(host), 'shutterstock.com') THEN 'dominio_bloqueado ' || host END AS reason FROM tried)
"""
_JUDGED = """
WITH p AS (SELECT p_partkey AS ref, p_partkey % 6 AS n, CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 4 <> 3 THEN p_partkey % 7 END AS wanted, CASE WHEN p_partkey % 11 = 0 THEN [] ELSE list_filter([p_partkey % 9, p_partkey % 5, 1], lambda x: x BETWEEN 1 AND p_partkey % 6) END AS good,
  CASE WHEN p_partkey % 11 = 0 THEN 'baja' ELSE (['alta', 'media', 'baja'])[p_partkey % 3 + 1] END AS confianza FROM part),
j AS (SELECT *, CASE WHEN wanted BETWEEN 1 AND n THEN wanted WHEN wanted IS NOT NULL THEN good[1] END AS pick FROM p),
v AS (SELECT ref, CAST(CASE WHEN ref % 11 = 0 THEN 0 ELSE n END AS INTEGER) AS n_evaluadas, confianza, CAST(pick AS INTEGER) AS seleccion_imagen, 'http://x/' || ref || '/' || pick AS link, array_to_string(list_transform(good, lambda i: 'http://x/' || ref || '/' || i), ', ') AS ranking,
  concat_ws(', ', CASE WHEN pick IS NULL THEN 'sin_imagen' END, CASE WHEN pick IS NULL OR confianza = 'baja' THEN 'necesita_fallback' END, CASE WHEN pick <= 4 AND (ref + pick) % 3 = 1 THEN 'revisar_marca' END, CASE WHEN pick = 1 AND ref % 2 = 0 THEN 'descarga_thumbnail' END) AS flags FROM j)
"""
_LEDGER = """
WITH l AS (SELECT ts, event_type AS kind, (['gemini-2.5-flash', 'gemini-2.5-pro', 'unknown'])[user_id % 3 + 1] AS model, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM l WHERE kind = 'view' GROUP BY 1),
s AS (SELECT CAST(sum(n) AS BIGINT) AS calls, CAST(sum(greatest(n - 50, 0)) AS BIGINT) AS billable FROM d),
m AS (SELECT model, count(*) AS calls, CAST(sum(k * 997) AS BIGINT) AS i, CAST(sum(CASE WHEN k % 5 > 0 THEN k * 101 ELSE 0 END + k * 13) AS BIGINT) AS o FROM l WHERE kind = 'click' GROUP BY 1),
r AS (SELECT 'CSE' AS servicio, calls AS llamadas, CAST(NULL AS BIGINT) AS tokens_entrada, CAST(NULL AS BIGINT) AS tokens_salida, round_even(billable / 1000.0 * 5, 4) AS costo_usd, billable || ' facturables tras 50 gratis/dia' AS nota FROM s
  UNION ALL SELECT model, calls, i, o, round_even((i * a + o * b) / 1e6, 4), 'salida incluye thinking tokens' FROM m LEFT JOIN (VALUES ('gemini-2.5-flash', 0.30::DOUBLE, 2.50::DOUBLE), ('gemini-2.5-pro', 1.25, 10.0)) x(name, a, b) ON model = name)
"""
#: The ladder unrolled: what rungs 2 and 3 add to the pool of each part, and what its verdicts are.
_LADDER = """
WITH a AS (SELECT p_partkey AS ref, p_brand AS marca, p_partkey % 2 = 0 AS even, p_partkey % 5 AS k, CASE WHEN p_partkey % 2 = 0 THEN [p_partkey % 5 + 1] ELSE [] END AS pool FROM part),
b AS (SELECT *, list_concat(pool, list_filter([k + 1, k + 2], lambda x: NOT list_contains(pool, x))) AS pool2 FROM a),
c AS (SELECT *, len(pool2) - len(pool) AS new2, CASE WHEN even THEN len(pool2) ELSE 0 END AS kept2 FROM b),
d AS (SELECT *, CASE WHEN kept2 = 0 THEN 'prefiltro_vacio' WHEN kept2 + ref % 3 >= 4 THEN 'resuelto' ELSE 'sigue_pendiente' END AS out2, CASE WHEN kept2 > 0 THEN [list_min(pool2)] ELSE [] END AS bad FROM c),
e AS (SELECT *, list_filter(list_concat(pool2, list_filter([k + 1, k + 2, k + 3], lambda x: NOT list_contains(pool2, x))), lambda x: NOT list_contains(bad, x)) AS usable3, len(list_filter(pool2, lambda x: NOT list_contains(bad, x))) AS before3 FROM d),
f AS (SELECT *, len(usable3) - before3 AS new3, CASE WHEN even THEN len(usable3) ELSE 0 END AS kept3 FROM e),
g AS (SELECT *, CASE WHEN new3 = 0 THEN 'sin_candidatos_nuevos' WHEN kept3 = 0 THEN 'prefiltro_vacio' WHEN kept3 + ref % 3 >= 4 THEN 'resuelto' ELSE 'sigue_pendiente' END AS out3 FROM f),
log AS (SELECT ref, CAST(2 AS INTEGER) AS rung, new2 AS n_new, kept2 AS n_kept, out2 AS outcome FROM g UNION ALL SELECT ref, 3, new3, kept3, out3 FROM g WHERE out2 <> 'resuelto')
"""


def oracle_sql() -> dict[str, str]:
    return {
        "prototype_queries": _NAMES + r"""SELECT ref, regexp_extract(nombre, '(?i)(\d+(?:[.,]\d+)?)\s*(L|LT|LTS|ML|GAL)\b', 1) || upper(regexp_extract(nombre, '(?i)(\d+(?:[.,]\d+)?)\s*(L|LT|LTS|ML|GAL)\b', 2)) AS presentation,
  trim(regexp_replace(regexp_replace(nombre, '(?i)X\s*\d+\s*UN[DI]*', '', 'g'), '\s+', ' ', 'g')) AS clean, '"' || marca || '" ' || nombre || ' product with reference "' || ref || '" white background' AS fallback FROM raw""",
        "prototype_pool": """WITH f AS (SELECT user_id % 50 AS ref, CAST(event_id % 4 AS INTEGER) AS tier, event_id AS pos, CASE WHEN event_id % 29 = 0 THEN '' ELSE 'u' || (event_id * event_id % (10 + user_id % 50)) END AS url FROM events),
  d AS (SELECT * FROM f WHERE url <> '' QUALIFY row_number() OVER (PARTITION BY ref, url ORDER BY tier, pos) = 1),
  n AS (SELECT ref, count(*) FILTER (tier <= 1) AS a, count(*) FILTER (tier <= 2) AS b FROM d GROUP BY ref)
  SELECT ref, url, tier, CAST(row_number() OVER (PARTITION BY ref ORDER BY tier, pos) AS INTEGER) AS rank FROM d JOIN n USING (ref) WHERE tier <= 1 OR (tier = 2 AND a < 10) OR (tier = 3 AND b < 10) QUALIFY rank <= 20""",
        "prototype_reasons": f"""WITH r AS (SELECT page_id, (['renault', 'castrol', 'der'])[page_id % 3 + 1] AS brand, 250 + page_id * 37 % 900 AS w, 280 + page_id * 53 % 700 AS h, CASE WHEN page_id % 13 = 0 THEN 'www.alamy.com' ELSE 'a.example' END AS domain,
  'total renault ' || CASE WHEN page_id % 5 = 0 THEN 'mobil castrol ' ELSE ' ' END || lower(coalesce(url, '')) AS t FROM pages),
  x AS (SELECT *, list_filter({list(rules.PROTOTYPE_RIVALS)}, lambda b: b <> brand AND contains(t, b)) AS rivals FROM r)
  SELECT page_id, CASE WHEN least(w, h) < 300 THEN 'low_res ' || w || 'x' || h WHEN NOT w::DOUBLE / h BETWEEN 0.6 AND 1.7 THEN 'bad_aspect_ratio' WHEN contains(domain, 'alamy.com') THEN 'bad_domain ' || domain
  WHEN NOT contains(t, brand) THEN 'brand_not_in_text' WHEN len(rivals) >= 2 THEN 'multi_rival_brand ' || array_to_string(rivals, ', ') END AS reason FROM x""",
        "prototype_winners": """WITH t AS (SELECT conv_id AS ref, turn, max(length(text)) AS n FROM conversations GROUP BY ALL),
  q AS (SELECT ref, turn, n, row_number() OVER (PARTITION BY ref ORDER BY n % 2 = 0, n % 4 = 0, -(n % 100), turn) AS k FROM t WHERE n % 5 <> 0 AND n % 7 <> 0)
  SELECT ref, any_value(w) AS winner, any_value(a) AS alternatives FROM (SELECT DISTINCT ref FROM t) LEFT JOIN (SELECT ref, 'u' || arg_min(turn, k) FILTER (n % 3 <> 0) AS w, coalesce(string_agg('u' || turn, ';' ORDER BY k) FILTER (k IN (2, 3)), '') AS a FROM q GROUP BY ref) USING (ref) GROUP BY ref""".replace("any_value(a) AS", "coalesce(any_value(a), '') AS"),
        "image_scores": """WITH p AS (SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1.0::DOUBLE ELSE 0.0 END) AS e FROM embeddings),
  m AS (SELECT vec_id, list_avg(list_transform([1, 5, 8, 33, 40, 57, 61, 64], lambda i: e[i])) AS w,
    list_avg(list_concat(e[1:24], e[41:64], list_filter(e, lambda x, i: (i - 1) % 8 < 3), list_filter(e, lambda x, i: (i - 1) % 8 > 4))) AS b FROM p)
  SELECT vec_id, round_even(0.7 * w + 0.3 * (1 - least(sqrt(w * (1 - w)) * 255 / 128, 1)), 3) AS bg_score, round_even(b, 2) AS bg_white, sqrt(b * (1 - b)) * 255 < 18 AS bg_mono FROM m""",
        "daily_calls_stream": "SELECT CAST(ts AS DATE) AS day, event_type AS kind, count(*) AS n FROM events GROUP BY ALL",
        "read_through_cap": """WITH r AS (SELECT o_orderkey AS row_id, o_orderkey % 7 <> 0 AS ok FROM orders)
  SELECT row_id, ok, CASE WHEN ok THEN 'v' || row_id END AS value, CASE WHEN NOT ok THEN 'gone' END AS error FROM r QUALIFY coalesce(sum(ok::INT) OVER (ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 100""",
        "normalize_names": _NAMES + r"""SELECT ref, nombre_limpio, pack, litraje, pack <> '' AND litraje = '' AS pack_ambiguo, upper(regexp_extract(nombre_limpio, '(?i)\b\d{1,2}W-?\d{2}\b', 0)) AS viscosidad,
  upper(regexp_extract(nombre_limpio, '(?i)\b\d{3}/\d{2}R\d{2}\b', 0)) AS medida_llanta, regexp_extract(nombre_limpio, '\b([A-Z]{1,4}\d{0,2}(?:-[A-Z]{1,4}\d{0,2})*)\s*$', 1) AS vehiculo_code_raw,
  CASE WHEN NOT contains(nombre_limpio, upper(trim(marca))) THEN nombre_limpio || ' ' || upper(trim(marca)) ELSE nombre_limpio END AS termino_busqueda FROM norm""",
        "classify_first_match": _NAMES + f"SELECT ref, {_CATEGORY} AS categoria, CASE WHEN {_CATEGORY} IN ('merchandising', 'emblemas') THEN 'exact_brand' ELSE 'baseline' END AS cse_profile FROM norm",
        "category_coverage": _NAMES + f"SELECT {_CATEGORY} AS categoria, count(*) AS n FROM norm GROUP BY 1",
        "strip_accents_docs": "SELECT doc_id, strip_accents(text) AS plain FROM documents",
        "presentation_rules": _NAMES + f""", c AS (SELECT ref, marca, {_CATEGORY} AS categoria FROM norm) SELECT ref, categoria, CAST((MAP {{{", ".join(f"'{k}': {len(v)}" for k, v in rules.PRESENTATIONS.items())}}})[categoria] AS INTEGER) AS n,
  CASE WHEN categoria IN ('merchandising', 'emblemas') THEN marca END AS exact FROM c""",
        "coverage_summary": _NAMES + f", c AS (SELECT {_CATEGORY} AS c FROM norm) SELECT count(*) AS n, count(DISTINCT c) AS categories, count(*) FILTER (c = '{rules.OTHER}') AS backlog FROM c",
        "backlog": _NAMES + f"SELECT ref, nombre_limpio FROM norm WHERE {_CATEGORY} = '{rules.OTHER}'",
        "search_requests": _NAMES + f""", c AS (SELECT ref, CASE WHEN {_CATEGORY} IN ('merchandising', 'emblemas') THEN 'exactTerms=' || marca || '&' ELSE '' END AS e, CASE WHEN ref % 2 = 0 THEN 'gl=co&hl=es&' ELSE '' END AS g FROM norm)
  SELECT ref, e || g || 'imgType=photo&num=10&searchType=image' AS params, e || g || 'imgType=photo&num=10&searchType=image&start=11' AS paged, false AS same_key FROM c""",
        "recovered_reasons": _WIDE + "SELECT pos, link, width, height, recovered, reason FROM hard",
        "prefilter_full": _WIDE + """, size AS (SELECT ref, count(*) AS n_input FROM pool GROUP BY ref),
  g AS (SELECT ref, list({'pos': pos, 'link': link, 'thumb': thumb} ORDER BY pos) AS rows FROM pool GROUP BY ref),
  k AS (SELECT ref, unnest(list_transform(list_reduce(rows, lambda acc, x: CASE WHEN len(list_filter(acc, lambda k: k.link = x.link OR (x.thumb <> '' AND k.thumb = x.thumb))) > 0 THEN acc ELSE list_append(acc, x) END, []::STRUCT(pos BIGINT, link VARCHAR, thumb VARCHAR)[]), lambda x: x.pos)) AS pos FROM g),
  h AS (SELECT hard.* FROM hard JOIN k USING (ref, pos)), ok AS (SELECT * FROM h WHERE reason IS NULL),
  v AS (SELECT ref, list({'pos': pos, 'h': coalesce(phash, -1)} ORDER BY width * height DESC, pos) AS rows FROM ok GROUP BY ref),
  w AS (SELECT ref, unnest(list_transform(list_reduce(rows, lambda acc, x: CASE WHEN len(list_filter(acc, lambda k: k.h >= 0 AND x.h >= 0 AND bit_count(xor(k.h, x.h)) <= 4)) > 0 THEN acc ELSE list_append(acc, x) END, []::STRUCT(pos BIGINT, h BIGINT)[]), lambda x: x.pos)) AS pos FROM v),
  r AS (SELECT ok.*, row_number() OVER (PARTITION BY ref ORDER BY bg_score DESC, width * height DESC, pos) AS place, pos % 4 <> 0 AS alive FROM ok JOIN w USING (ref, pos)),
  t AS (SELECT *, sum(alive::INT) OVER (PARTITION BY ref ORDER BY place) AS n FROM r),
  told AS (SELECT ref, pos, CASE WHEN n - alive::INT >= 6 THEN 'trimmed' WHEN alive THEN 'kept' ELSE 'unreachable' END AS status, NULL AS reason, place, n FROM t
    UNION ALL SELECT ref, pos, 'dropped', 'duplicado_visual', NULL, NULL FROM ok ANTI JOIN w USING (ref, pos) UNION ALL SELECT ref, pos, 'dropped', reason, NULL, NULL FROM h WHERE reason IS NOT NULL
    UNION ALL SELECT ref, pos, 'dropped', 'duplicado_url', NULL, NULL FROM pool ANTI JOIN k USING (ref, pos))
  SELECT ref, pos, n_input, status, reason, CAST(CASE WHEN status = 'kept' THEN n ELSE place END AS INTEGER) AS rank FROM told JOIN size USING (ref)""",
        "shortlist": _WIDE + """, g AS (SELECT ref, list({'pos': pos, 'h': phash} ORDER BY pos) AS rows FROM pool WHERE phash IS NOT NULL GROUP BY ref),
  w AS (SELECT ref, unnest(list_transform(list_reduce(rows, lambda acc, x: CASE WHEN len(list_filter(acc, lambda k: bit_count(xor(k.h, x.h)) <= 4)) > 0 THEN acc ELSE list_append(acc, x) END, []::STRUCT(pos BIGINT, h BIGINT)[]), lambda x: x.pos)) AS pos FROM g)
  SELECT ref, pos, CAST(row_number() OVER (PARTITION BY ref ORDER BY bg_score DESC, width * height DESC, pos) AS INTEGER) AS rank FROM pool JOIN w USING (ref, pos) QUALIFY rank <= 6""",
        "verdict_flags": _JUDGED + "SELECT * FROM v",
        "condemned_links": _JUDGED + "SELECT DISTINCT ref, 'http://x/' || ref || '/' || i AS link FROM j, (SELECT unnest([1, 2, 3, 4]) AS i) WHERE ref % 11 <> 0 AND i <= n AND (ref % (i + 2) = 0 OR (ref + i) % 3 = 2)",
        "wide_output": _NAMES + _JUDGED.replace("\nWITH p AS", ", p AS") + f""", c AS (SELECT ref, marca, {_CATEGORY} AS categoria, CASE WHEN NOT contains(nombre_limpio, upper(trim(marca))) THEN nombre_limpio || ' ' || upper(trim(marca)) ELSE nombre_limpio END AS termino_busqueda FROM norm)
  SELECT c.ref, marca, CASE WHEN categoria IN ('merchandising', 'emblemas') THEN 'exact_brand' ELSE 'baseline' END AS cse_profile, coalesce(v.link, '') AS imagen_url, CASE WHEN c.ref % 10 = 0 THEN 'images/' || c.ref || '.jpg' ELSE '' END AS imagen_local, categoria, termino_busqueda,
    CASE WHEN categoria IN ('merchandising', 'emblemas') THEN 'exact_brand' ELSE 'baseline' END AS perfil_cse_usado, CASE WHEN v.ref IS NULL THEN '' ELSE CAST(v.ref % 3 + 1 AS VARCHAR) END AS intento_cse, coalesce('q' || v.ref, '') AS query_cse, CASE WHEN v.ref IS NULL THEN '' ELSE '1' END AS pasadas_gemini,
    coalesce(CAST(v.ref % 4 AS VARCHAR), '') AS reintentos_api_gemini, coalesce(v.confianza, '') AS confianza, coalesce(v.flags, '') AS flags, '' AS razon_gemini FROM c LEFT JOIN v ON c.ref = v.ref AND v.ref % 3 <> 1""",
        "cost_report": _LEDGER + "SELECT * FROM r",
        "cost_total": _LEDGER + "SELECT round(sum(costo_usd), 4) AS total_usd, CAST(sum(llamadas) FILTER (servicio = 'CSE') AS BIGINT) AS searches, CAST(sum(llamadas) FILTER (servicio <> 'CSE') AS BIGINT) AS model_calls FROM r",
        "funnel_counts": _FUNNEL + "SELECT 'confianza' AS what, confianza AS value, count(*) AS n FROM f GROUP BY ALL UNION ALL SELECT 'flags', value, count(*) FROM (SELECT unnest(string_split(flags, ', ')) AS value FROM f WHERE flags <> '-') GROUP BY ALL",
        "fallback_ladder": _LADDER + "SELECT ref, rung, n_new, n_kept, CASE outcome WHEN 'resuelto' THEN '-' WHEN 'sigue_pendiente' THEN 'sin_imagen' END AS flags, outcome FROM log",
        "fallback_verdicts": _NAMES + _LADDER.replace("\nWITH a AS", ", a AS").replace("p_brand AS marca, ", "") + """SELECT ref, CAST((kept2 > 0)::INT + (out2 <> 'resuelto' AND kept3 > 0)::INT AS INTEGER) AS passes, CAST(CASE WHEN out2 = 'resuelto' THEN 2 ELSE 3 END AS INTEGER) AS rung, CASE WHEN out2 = 'resuelto' THEN ref || ' ' || marca ELSE nombre_limpio END AS query,
  CASE WHEN kept2 = 0 THEN NULL WHEN out2 = 'resuelto' THEN '' ELSE 'sin_imagen' END AS flags, array_to_string(list_transform(list_sort(list_concat(bad, CASE WHEN out2 <> 'resuelto' AND kept3 > 0 THEN [list_min(usable3)] ELSE [] END)), lambda x: 'http://x/' || x), ', ') AS condemned FROM g JOIN norm USING (ref)""",
        "fallback_ladder_capped": _LADDER + """, each AS (SELECT ref, rung, outcome, outcome IN ('resuelto', 'sigue_pendiente') AS call, row_number() OVER w AS nth, coalesce(sum((outcome IN ('resuelto', 'sigue_pendiente'))::INT) OVER (ORDER BY ref, rung ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS calls FROM log WINDOW w AS (ORDER BY ref, rung)),
  stop AS (SELECT min(nth) FILTER (call AND calls >= 2) AS at FROM each),
  cut AS (SELECT ref, rung, CASE WHEN call AND calls >= 2 THEN 'omitido_cap_gemini' ELSE outcome END AS outcome FROM each),
  whole AS (SELECT ref, rung, outcome, row_number() OVER (ORDER BY ref, rung) AS nth FROM cut c WHERE NOT EXISTS (SELECT 1 FROM cut x WHERE x.ref = c.ref AND x.rung < c.rung AND x.outcome = 'omitido_cap_gemini'))
  SELECT ref, rung, CASE WHEN nth <= 8 THEN outcome ELSE 'omitido_cap_cse' END AS outcome FROM whole w WHERE nth <= 8 OR NOT EXISTS (SELECT 1 FROM whole x WHERE x.ref = w.ref AND x.rung < w.rung AND x.nth > 8)""",
        "fallback_rescued": _LADDER + "SELECT count(*) FILTER (outcome = 'resuelto') AS rescued, count(DISTINCT ref) AS tried FROM log",
        "build_queries": _NAMES + r"""SELECT ref, rung, CASE rung WHEN 1 THEN '"' || ref || '" "' || marca || '"' WHEN 2 THEN ref || ' ' || marca ELSE nombre_limpio END AS query,
  coalesce(nullif(regexp_replace(trim(marca), '[^A-Za-z0-9._-]+', '_', 'g'), ''), 'unknown') AS safe FROM norm, (SELECT unnest([1, 2, 3]) AS rung)""",
        "hard_filter_reasons": _POOL + """SELECT pos, CASE WHEN NOT (starts_with(link, 'http://') OR starts_with(link, 'https://')) THEN 'url_invalido' WHEN least(width, height) < 400 THEN 'resolucion_baja'
  WHEN greatest(width, height)::DOUBLE / greatest(least(width, height), 1) > 3 THEN 'aspect_ratio_extremo' WHEN contains(lower(host), 'shutterstock.com') THEN 'dominio_bloqueado' END AS reason FROM pool""",
        "upscale_urls": "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'https://http2.mlstatic.com/D_' || page_id || '-F.jpg' ELSE 'https://a.example/wp-content/uploads/i' || page_id || '.png' END AS big FROM pages",
        "greedy_url_dedup": _POOL + """, g AS (SELECT ref, list({'pos': pos, 'link': link, 'thumb': thumb} ORDER BY pos) AS rows FROM pool GROUP BY ref),
  k AS (SELECT ref, list_reduce(rows, lambda acc, x: CASE WHEN len(list_filter(acc, lambda k: k.link = x.link OR (x.thumb <> '' AND k.thumb = x.thumb))) > 0 THEN acc ELSE list_append(acc, x) END, []::STRUCT(pos BIGINT, link VARCHAR, thumb VARCHAR)[]) AS kept FROM g)
  SELECT ref, unnest(list_transform(kept, lambda x: x.pos)) AS pos FROM k""",
        "greedy_hash_dedup": """WITH h AS (SELECT CAST(floor(vec_id / 100) AS BIGINT) AS ref, vec_id AS pos, array_to_string(list_transform(embedding[1:16], lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '') AS h FROM embeddings),
  g AS (SELECT ref, list({'pos': pos, 'h': h} ORDER BY pos) AS rows FROM h GROUP BY ref),
  k AS (SELECT ref, list_reduce(rows, lambda acc, x: CASE WHEN len(list_filter(acc, lambda k: hamming(k.h, x.h) <= 4)) > 0 THEN acc ELSE list_append(acc, x) END, []::STRUCT(pos BIGINT, h VARCHAR)[]) AS kept FROM g)
  SELECT ref, unnest(list_transform(kept, lambda x: x.pos)) AS pos FROM k""",
        "rank_topk": _POOL + "SELECT ref, pos, CAST(row_number() OVER (PARTITION BY ref ORDER BY bg_score DESC, width * height DESC, pos) AS INTEGER) AS rank FROM pool QUALIFY rank <= 6",
        "pool_merge_exclude": _POOL + """, base AS (SELECT ref, pos, link FROM pool WHERE pos % 2 = 0), extra AS (SELECT * FROM (SELECT ref, pos, link FROM pool WHERE pos % 2 = 1) e WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.ref = e.ref AND b.link = e.link)),
  merged AS (SELECT * FROM base UNION ALL SELECT ref, pos + coalesce((SELECT max(b.pos) + 1 FROM base b WHERE b.ref = extra.ref), 0), link FROM extra)
  SELECT ref, count(*) AS n, CAST(sum(pos) AS BIGINT) AS places FROM merged m WHERE NOT EXISTS (SELECT 1 FROM pool p WHERE p.pos % 10 = 3 AND p.ref = m.ref AND p.link = m.link) GROUP BY ref""",
        "budget_cap": """WITH r AS (SELECT o_orderkey AS row_id, NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) AS miss FROM orders)
  SELECT row_id, miss FROM r QUALIFY NOT miss OR sum(miss::INT) OVER (ORDER BY row_id) <= 100""",
        "cost_by_day": "WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1) SELECT CAST(sum(n) AS BIGINT) AS calls, CAST(sum(greatest(n - 100, 0)) AS BIGINT) AS billable, round_even(sum(greatest(n - 100, 0)) / 1000.0 * 5, 4) AS cost_usd FROM d",
        "cost_by_model": """WITH u AS (SELECT event_type AS model, count(*) AS calls, CAST(sum(k) AS BIGINT) AS tokens_in, CAST(sum(2 * k + 1) AS BIGINT) AS tokens_out FROM (SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY 1)
  SELECT model, calls, tokens_in, tokens_out, round(round_even((tokens_in * i + tokens_out * o) / 1e6, 4), 2) AS cost_usd FROM u LEFT JOIN (VALUES ('click', 300.0::DOUBLE, 2500.0::DOUBLE), ('view', 1250.0, 10000.0)) p(m, i, o) ON model = m""",
        "retry_report": "WITH e AS (SELECT CASE event_type WHEN 'error' THEN 'cse_retry' WHEN 'signup' THEN 'gemini_retry' END AS kind, CAST(json_extract_string(props, '$.k') AS INTEGER) % 7 AS k FROM events) SELECT kind, 'e' || k AS error, count(*) AS n FROM e WHERE k > 0 AND kind IS NOT NULL GROUP BY ALL",
        "funnel": _FUNNEL + "SELECT * FROM f",
        "funnel_summary": _FUNNEL + """SELECT count(*) AS productos, CAST(sum(seleccionada::INT) AS BIGINT) AS con_imagen, CAST(count(*) - sum(seleccionada::INT) AS BIGINT) AS sin_imagen, round_even(sum(seleccionada::INT)::DOUBLE / count(*), 3) AS tasa_exito,
  count(*) FILTER (n_cse = 0) AS perdidos_pool_cse_vacio, count(*) FILTER (n_cse > 0 AND n_prefiltro = 0) AS perdidos_prefiltro_vacio, count(*) FILTER (n_prefiltro > 0 AND NOT seleccionada) AS perdidos_gemini_descarto FROM f""",
        "image_hash_distances": "SELECT vec_id, true AS near FROM embeddings",
        "parse_candidates": "SELECT page_id, CAST(pos AS INTEGER) AS pos, url AS link, '' AS title, CAST(page_id % 900 AS INTEGER) AS width, CAST(NULL AS INTEGER) AS height FROM pages, (SELECT unnest([0, 1]) AS pos)",
        "parse_other_source": "SELECT page_id, CAST(pos AS INTEGER) AS pos, url AS image_url, CAST(NULL AS VARCHAR) AS thumbnail_url, url AS page_url, '' AS title, CAST(page_id % 900 AS INTEGER) AS width, CAST(0 AS INTEGER) AS height, 's' AS source_site FROM pages, (SELECT unnest([0, 1]) AS pos) WHERE page_id % 3 > 0",
        "resolve_selection": """WITH t AS (SELECT conv_id, list(CAST(length(text) % 9 AS INTEGER) ORDER BY turn, length(text)) AS r FROM conversations GROUP BY conv_id)
  SELECT conv_id, CAST(CASE WHEN conv_id % 7 BETWEEN 1 AND len(r) THEN conv_id % 7 ELSE list_filter(r, lambda x: x BETWEEN 1 AND len(r))[1] END AS INTEGER) AS pick FROM t""",
    }
