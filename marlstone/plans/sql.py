"""DuckDB SQL with the same rows as the registered queries."""

from __future__ import annotations

from marlstone.operators import applications, knowledge
from marlstone.sources import dictionaries

INV = """
inv AS (
  SELECT o_orderkey AS id,
         CASE WHEN o_orderkey % 3 <> 0 THEN 'o-' || o_orderkey END AS slug,
         CASE WHEN o_orderkey % 5 = 0 THEN 'https://example.invalid/v/' || o_orderkey END AS liga_web,
         CASE WHEN o_orderkey % 4 = 1 THEN '' WHEN o_orderkey % 4 > 1 THEN c_name END AS titulo,
         c_mktsegment AS marca, o_orderpriority AS modelo, CAST(year(o_orderdate) AS INTEGER) AS autoano,
         o_totalprice AS precio, o_orderstatus AS transmision, c_mktsegment AS combustible,
         o_orderpriority AS carroceria, n_name AS ubicacion, o_orderstatus AS garantia,
         CASE WHEN o_orderkey % 2 = 0 THEN 'M' || (o_orderkey % 16) END AS motor,
         CASE WHEN o_orderkey % 9 = 0 THEN ['p1', 'p' || o_orderkey] END AS promociones, 'https://example.invalid/i/' || o_orderkey AS feature_image_url,
         list_transform(generate_series(1, o_orderkey % 3 + 1), lambda i: 'e' || i) AS galeria_exterior, CAST([] AS VARCHAR[]) AS galeria_interior,
         CAST(o_orderkey % 8 AS INTEGER) AS cilindros, c_name AS descripcion,
         CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey * 1.5::DOUBLE END AS kilometraje,
         CASE WHEN o_orderkey % 6 = 0 THEN 0.0::DOUBLE WHEN o_orderkey % 6 <> 1 THEN o_totalprice * 0.25::DOUBLE END AS enganchemin,
         o_totalprice * 0.5::DOUBLE AS enganche_recomendado,
         CASE WHEN o_orderkey % 6 <> 2 THEN o_totalprice * 0.03125::DOUBLE END AS mensualidad_minima,
         o_totalprice * 0.0625::DOUBLE AS mensualidad_recomendada, 60 AS plazomax,
         o_orderkey % 9 = 0 AS con_oferta, CASE WHEN o_orderkey % 9 = 0 THEN o_totalprice * 0.875::DOUBLE END AS oferta,
         o_orderstatus <> 'F' AS exhibicion_inventario, o_orderstatus = 'P' AS separado
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
), live AS (SELECT * FROM inv WHERE exhibicion_inventario AND NOT separado AND precio IS NOT NULL)
"""


def money(x: str) -> str:
    return f"(CASE WHEN {x} < 0 THEN '-' ELSE '' END || '$' || format('{{:,}}', CAST(round(abs({x})) AS BIGINT)))"


def shown(x: str) -> str:
    return f"CASE WHEN {x} <> 0 THEN {money(x)} END"


KM = "coalesce(regexp_replace(format('{:,.3f}', kilometraje), '\\.?0+$', '') || ' km', 'No disponible')"
TITLE = "coalesce(nullif(titulo, ''), concat_ws(' ', marca, modelo, CAST(autoano AS VARCHAR)))"
URL = "coalesce(nullif(liga_web, ''), CASE WHEN slug <> '' THEN 'https://example.invalid/autos/' || slug END)"
CARD = f"""id, {TITLE} AS titulo, marca, modelo, autoano AS ano, {money("precio")} AS precio, precio AS precio_numerico,
  transmision, combustible, carroceria, ubicacion, {KM} AS kilometraje, garantia, {shown("enganchemin")} AS enganche_minimo,
  {shown("mensualidad_minima")} AS mensualidad_desde, {URL} AS url"""
TRUE_PRICE, TRUE_YEAR = "CASE WHEN precio <> 0 THEN precio END", "CASE WHEN autoano <> 0 THEN autoano END"
SUMMARY = f"""count(*) AS total, min({TRUE_PRICE}) AS precio_minimo, max({TRUE_PRICE}) AS precio_maximo, avg({TRUE_PRICE}) AS precio_promedio,
  min({TRUE_YEAR}) AS ano_desde, max({TRUE_YEAR}) AS ano_hasta"""


def search(where: str, limit: int) -> str:
    return f"WITH {INV}, top AS (SELECT * FROM live WHERE {where} ORDER BY precio NULLS LAST, id LIMIT {limit}) SELECT {CARD} FROM top"


def quotes(months: int, rate: float) -> str:
    r = f"({rate}::DOUBLE / 100 / 12)"
    grown = f"pow(1 + {r}, {months}::DOUBLE)"
    if rate:
        pay = f"financed * {r} * {grown} / nullif({grown} - 1, 0)"
    else:
        pay = f"financed / nullif({months}::DOUBLE, 0)"
    half = lambda x: money(f"floor({x} + 0.5)")
    return f"""WITH a AS (SELECT o_orderkey, CASE WHEN o_totalprice < 1000 THEN o_totalprice * 1000 ELSE o_totalprice END AS price FROM orders),
b AS (SELECT *, price * 20.0::DOUBLE / 100 AS down_payment, price - price * 20.0::DOUBLE / 100 AS financed FROM a),
c AS (SELECT *, {pay} AS monthly FROM b),
e AS (SELECT *, monthly * {months}::DOUBLE + down_payment AS total FROM c)
SELECT o_orderkey, {money("price")} AS precio_vehiculo, down_payment, financed, monthly, total, total - price AS cost,
  {money("down_payment")} AS enganche, {money("financed")} AS monto_a_financiar, {half("monthly")} AS mensualidad_estimada,
  {half("total")} AS total_a_pagar, {half("(total - price)")} AS costo_financiamiento, '{rate:g}%' AS tasa_anual FROM e"""


KNOW = """
know AS (
  SELECT doc_id AS id, lang AS category, substring(text, 1, 80) AS title, text AS content, n_chars AS priority,
         doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0) AS is_active
  FROM documents
)"""
TYPED = """
typed AS (
  SELECT c_custkey, CASE c_custkey % 6
    WHEN 0 THEN '  ' || lower(c_mktsegment) || ' '
    WHEN 1 THEN substring(lower(c_mktsegment), 1, 3) || 'x' || substring(lower(c_mktsegment), 4, 20)
    WHEN 2 THEN substring(lower(c_mktsegment), 2, 4) || substring(lower(c_mktsegment), 7, 20)
    WHEN 3 THEN (['autos', 'automovil', 'casa', 'maquina', 'obra'])[c_custkey % 5 + 1]
    WHEN 4 THEN upper(c_mktsegment)
    ELSE 'zz' || lower(c_mktsegment) || 'zz' END AS term
  FROM customer
), dict(k, v) AS (VALUES ('autos', 'AUTOMOBILE'), ('automovil', 'AUTOMOBILE'), ('casa', 'HOUSEHOLD'), ('maquina', 'MACHINERY'), ('obra', 'BUILDING')),
cand AS (SELECT DISTINCT c_mktsegment AS candidate FROM customer),
near AS (
  SELECT term, arg_min(candidate, (dist, candidate)) AS from_near, CAST(min(dist) AS INTEGER) AS distance
  FROM (SELECT DISTINCT term, candidate, levenshtein(lower(term), lower(candidate)) AS dist FROM typed, cand) WHERE dist <= 2 GROUP BY term
)"""


def cascade(names: dict[str, list[str]]) -> str:
    forms = dictionaries.by_form(names)
    # DuckDB counts bytes, so each accented letter becomes a byte that no term has
    one_byte = lambda c: f"translate(lower({c}), 'áéíóúñ', '!@#$%^')"
    quoted = lambda v: "'" + v.replace("'", "''") + "'"
    return f"""forms AS (SELECT [{", ".join(map(quoted, sorted(forms)))}] AS fs, [{", ".join(map(quoted, names))}] AS ns),
form AS (SELECT c_custkey, c_acctbal, fs[c_custkey * 7 % len(fs) + 1] AS f FROM customer, forms),
typed AS (SELECT c_custkey, c_acctbal, CASE c_custkey % 4 WHEN 0 THEN f WHEN 1 THEN ' ' || upper(f) || '  ' WHEN 2 THEN substring(f, 1, 2) || 'x' || substring(f, 3, 40) ELSE f || ' zzz' END AS term FROM form),
dict(k, v) AS (VALUES {", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in forms.items())}),
cand AS (SELECT DISTINCT ns[p_partkey * 2 % len(ns) // 2 * 2 + 1] AS candidate FROM part, forms),
near AS (SELECT term, arg_min(candidate, (dist, candidate)) AS from_near
  FROM (SELECT DISTINCT term, candidate, levenshtein({one_byte("term")}, {one_byte("candidate")}) AS dist FROM typed, cand) WHERE dist <= 2 GROUP BY term),
found AS (SELECT c_custkey, c_acctbal, typed.term, coalesce(v, candidate, from_near, typed.term) AS corrected,
  v IS NOT NULL OR (candidate IS NULL AND from_near IS NOT NULL) AS was_corrected, coalesce(v, candidate, from_near) IS NULL AS unmatched
  FROM typed LEFT JOIN dict ON lower(trim(typed.term)) = k LEFT JOIN cand ON lower(trim(typed.term)) = lower(candidate) LEFT JOIN near ON near.term = typed.term)"""


#: Documents that a kind of application needs, as in the registered query.
NEEDED = {"1-URGENT": ("AF",), "2-HIGH": ("AF", "NO"), "3-MEDIUM": ("AF", "NO", "RF"), "4-NOT SPECIFIED": ("AF", "NO", "RF", "NF"), "5-LOW": ("XX", "NO")}
LEADS = """
prof AS (SELECT CAST(c_custkey AS VARCHAR) AS phone FROM customer WHERE c_mktsegment = 'BUILDING'),
lead AS (SELECT CAST(event_id AS VARCHAR) AS id, event_type AS nombre, CAST(user_id AS VARCHAR) AS telefono, event_type <> 'signup' AS atendido, ts AS created_at FROM events),
req AS (SELECT c_name AS nombre, CAST(c_custkey AS VARCHAR) AS telefono, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_custkey || '@example.invalid' END AS email, c_mktsegment AS vehiculo_interes, CAST(NULL AS VARCHAR) AS comentarios FROM customer)"""
HIT = " OR ".join(f"lower({c}) LIKE '%{w}%'" for w in ("¿the", "thation", "licensed?") for c in ("title", "content"))

PAYLOAD = f"""WITH {INV}, a AS (
  SELECT c_custkey AS request_id, c_custkey || '@example.invalid' AS "to", c_name AS nombre_cliente, CAST(c_custkey % 50 AS DOUBLE) AS pct, c_custkey % 6 * 12 AS months, 0.0125::DOUBLE AS r, i.*
  FROM customer c JOIN (SELECT * FROM inv WHERE id IN (SELECT id FROM inv GROUP BY id HAVING count(*) = 1)) i ON c_custkey = id
), b AS (SELECT *, precio * pct / 100 AS down, precio - precio * pct / 100 AS financed, pow(1 + 15.0::DOUBLE / 100 / 12, months) AS grown FROM a),
m AS (SELECT *, financed * (15.0::DOUBLE / 100 / 12) * grown / nullif(grown - 1, 0) AS monthly FROM b)"""

#: Status changes: the allowed ones, applications, and each one's two changes.
CHANGES = f"""
ok(s, t) AS (VALUES {", ".join(f"('{s}', '{t}')" for s, ts in applications.ALLOWED.items() for t in ts)}),
names AS (SELECT [{", ".join(f"'{s}'" for s in applications.STATUSES)}] AS ns),
app AS (SELECT CAST(o_orderkey AS VARCHAR) AS application_id, CAST(o_custkey AS VARCHAR) AS user_id, o_orderpriority AS kind, ns[o_orderkey % 9 + 1] AS status FROM orders, names),
ch AS (SELECT CAST(c_custkey * 11 AS VARCHAR) AS application_id, ns[(c_custkey * 11 + 1) % 9 + 1] AS n1, ns[c_custkey % 9 + 1] AS n2, 'nota ' || c_custkey AS nota FROM customer, names),
one AS (SELECT ch.*, app.status AS given, app.application_id IS NOT NULL AS known, o.t IS NOT NULL AS fits1, CASE WHEN o.t IS NOT NULL THEN n1 ELSE app.status END AS s1
  FROM ch LEFT JOIN app ON app.application_id = ch.application_id LEFT JOIN ok o ON o.s = app.status AND o.t = n1),
two AS (SELECT one.*, o.t IS NOT NULL AS fits2, CASE WHEN o.t IS NOT NULL THEN n2 ELSE s1 END AS s2 FROM one LEFT JOIN ok o ON o.s = s1 AND o.t = n2)"""

ORACLE_SQL = {
    "inventory_search_total": f"WITH {INV}, f AS (SELECT * FROM live WHERE marca ILIKE '%build%' AND precio >= 2000 AND autoano <= 1997) SELECT id, {TITLE} AS titulo, {money('precio')} AS precio, (SELECT count(*) FROM f) AS total FROM (SELECT * FROM f ORDER BY precio, id LIMIT 5)",
    "inventory_search_layout": search("marca = 'BUILDING' AND autoano BETWEEN 1995 AND 1998 AND precio BETWEEN 100000 AND 300000", 50),
    "inventory_search_offers": search("con_oferta AND kilometraje <= 9000", 20),
    "alternatives_newest": f"WITH {INV}, top AS (SELECT * FROM live WHERE NOT marca ILIKE '%auto%' AND precio BETWEEN 300000 * 0.8::DOUBLE AND 300000 * 1.2::DOUBLE ORDER BY autoano DESC NULLS LAST, precio, id LIMIT 5) SELECT {CARD} FROM top",
    "search_messages": f"""WITH {INV}, {TYPED.strip()},
r AS (SELECT c_custkey AS request_id, CASE WHEN c_custkey % 7 <> 0 THEN CASE WHEN c_custkey % 4 = 3 THEN term || '?!zz' WHEN c_custkey % 9 = 0 THEN 'il' ELSE trim(term) END END AS marca,
  CASE WHEN c_custkey % 3 <> 0 THEN 300.0::DOUBLE + c_custkey % 250 END AS precio_minimo, CASE WHEN c_custkey % 3 <> 1 THEN 450000.0::DOUBLE - (c_custkey % 500) * 900 END AS precio_maximo FROM typed),
nr AS (SELECT marca, arg_min(candidate, (dist, candidate)) AS from_near FROM (SELECT DISTINCT marca, candidate, levenshtein(lower(marca), lower(candidate)) AS dist FROM r, cand WHERE marca IS NOT NULL) WHERE dist <= 2 GROUP BY marca),
c AS (SELECT r.*, CASE WHEN precio_minimo < 1000 THEN precio_minimo * 1000 ELSE precio_minimo END AS low, CASE WHEN precio_maximo < 1000 THEN precio_maximo * 1000 ELSE precio_maximo END AS high,
  coalesce(v, candidate, from_near, r.marca) AS corrected, v IS NOT NULL OR (candidate IS NULL AND from_near IS NOT NULL) AS was_corrected, r.marca IS NOT NULL AND coalesce(v, candidate, from_near) IS NULL AS unmatched
  FROM r LEFT JOIN dict ON lower(trim(r.marca)) = k LEFT JOIN cand ON lower(trim(r.marca)) = lower(candidate) LEFT JOIN nr ON nr.marca = r.marca),
m AS (SELECT c.*, EXISTS (SELECT 1 FROM live WHERE (c.corrected IS NULL OR contains(lower(live.marca), lower(c.corrected))) AND (low IS NULL OR precio >= low) AND (high IS NULL OR precio <= high)) AS met FROM c)
SELECT request_id, concat_ws('; ', CASE WHEN was_corrected THEN 'marca: ' || marca || ' → ' || corrected END, CASE WHEN low <> precio_minimo THEN 'precio_minimo: ' || precio_minimo || ' → ' || low END, CASE WHEN high <> precio_maximo THEN 'precio_maximo: ' || precio_maximo || ' → ' || high END) AS corrections,
  CASE WHEN NOT met THEN CASE WHEN unmatched THEN 'Nothing is known of ' || marca || '; there are ' || (SELECT string_agg(candidate, ', ' ORDER BY candidate) FROM cand) || '.' ELSE 'Nothing meets these conditions; try wider ones.' END END AS message FROM m""",
    "lead_append": f"""WITH {LEADS} SELECT nombre, telefono, nullif(email, '') AS email, vehiculo_interes, comentarios, 'chat_widget' AS source, false AS atendido FROM req
WHERE telefono NOT IN (SELECT phone FROM prof) AND telefono NOT IN (SELECT telefono FROM lead WHERE NOT atendido)""",
    "lead_intake_stream": f"""WITH {LEADS}, e AS (SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS telefono, ts, event_type = 'purchase' AS answered FROM events),
b AS (SELECT *, coalesce(NOT lag(answered) OVER w AND ts - lag(ts) OVER w < INTERVAL 30 DAY, false) AS is_open FROM e WINDOW w AS (PARTITION BY telefono ORDER BY ts, id))
SELECT id, telefono, CASE WHEN telefono IN (SELECT phone FROM prof) THEN 'perfil' WHEN answered THEN CASE WHEN is_open THEN 'respondido' ELSE 'sin_lead' END WHEN is_open THEN 'lead_abierto' ELSE 'nuevo' END AS status FROM b""",
    "quote_outbox": f"""WITH {INV}, r AS (SELECT c_custkey AS request_id, c_custkey * 11 IN (SELECT id FROM inv GROUP BY id HAVING count(*) = 1) AS there FROM customer),
o AS (SELECT request_id, CASE WHEN NOT there THEN 1 WHEN request_id % 35 = 0 THEN 3 WHEN request_id % 5 = 0 THEN 2 ELSE 1 END AS intento, there AND request_id % 35 <> 0 AS enviado, there FROM r)
SELECT request_id, intento, enviado, CASE WHEN NOT there THEN 'sin_vehiculo' WHEN NOT enviado THEN 'ocupado' END AS motivo, CAST(enviado AS BIGINT) AS veces FROM o""",
    "application_update": f"""WITH {CHANGES} SELECT app.application_id, user_id, kind, CASE WHEN fits1 OR fits2 THEN s2 ELSE status END AS status, CASE WHEN fits1 OR fits2 THEN nota END AS notas
FROM app LEFT JOIN two ON two.application_id = app.application_id""",
    "application_changes": f"""WITH {CHANGES} SELECT application_id, 1 AS seq, n1 AS nuevo_status, nota AS notas, CASE WHEN NOT known THEN 'desconocida' WHEN fits1 THEN 'aplicado' ELSE 'no_permitido' END AS outcome, s1 AS status FROM two
UNION ALL SELECT application_id, 2, n2, nota, CASE WHEN NOT known THEN 'desconocida' WHEN fits2 THEN 'aplicado' ELSE 'no_permitido' END, CASE WHEN known THEN s2 END FROM two""",
    "application_documents": f"""WITH {CHANGES}, need(kind, document) AS (VALUES {", ".join(f"('{k}', '{v}')" for k, docs in NEEDED.items() for v in docs)}),
held AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS application_id, l_returnflag || l_linestatus AS document FROM lineitem),
m AS (SELECT app.application_id, app.kind, count(held.document) AS presentes, count(need.document) AS requeridos, coalesce(string_agg(need.document, '|' ORDER BY need.document) FILTER (held.document IS NULL), '') AS faltantes
  FROM app LEFT JOIN need ON need.kind = app.kind LEFT JOIN held ON held.application_id = app.application_id AND held.document = need.document GROUP BY app.application_id, app.kind)
SELECT *, CASE WHEN presentes = requeridos THEN 'completo' WHEN presentes > 0 THEN 'parcial' ELSE 'ninguno' END AS estado FROM m""",
    "status_intervals": """WITH l AS (SELECT user_id AS key, ts, arg_max(event_type, event_id) AS status FROM events GROUP BY user_id, ts),
b AS (SELECT *, lag(status) OVER w AS before, row_number() OVER w AS n FROM l WINDOW w AS (PARTITION BY key ORDER BY ts))
SELECT key, status, ts AS valid_from, lead(ts) OVER (PARTITION BY key ORDER BY ts) AS valid_to FROM b WHERE n = 1 OR status IS DISTINCT FROM before""",
    "status_as_of": """WITH c AS (SELECT user_id AS key, ts, arg_max(event_type, event_id) AS status FROM events GROUP BY user_id, ts)
SELECT e.event_id, e.user_id + 1 AS key, e.ts AS at, c.status, c.ts AS since FROM events e ASOF LEFT JOIN c ON e.user_id + 1 = c.key AND e.ts >= c.ts""",
    "base_filter": f"WITH {INV} SELECT id, marca, precio FROM live",
    "inventory_search": search("marca ILIKE '%machin%' AND precio >= 50000", 5),
    "inventory_search_all_filters": search("marca ILIKE '%build%' AND modelo ILIKE '%urgent%' AND carroceria ILIKE '%1-%' AND transmision ILIKE '%o%' AND combustible ILIKE '%ing%' AND autoano BETWEEN 1996 AND 2000 AND precio BETWEEN 2000 AND 400000", 20),
    "inventory_search_literal_wildcards": search("contains(lower(modelo), '4_not%')", 10),
    "inventory_search_literal_found": f"WITH {INV}, top AS (SELECT * FROM (SELECT * REPLACE (CASE WHEN id % 50 = 0 THEN modelo || '_5%' ELSE modelo END AS modelo) FROM live) WHERE contains(lower(modelo), 'd_5%') ORDER BY precio NULLS LAST, id LIMIT 10) SELECT {CARD} FROM top",
    "inventory_search_truthiness": search("true", 5),
    "inventory_detail": f"WITH {INV} SELECT {CARD}, cilindros, descripcion, {shown('enganche_recomendado')} AS enganche_recomendado, {shown('mensualidad_recomendada')} AS mensualidad_recomendada, {shown('oferta')} AS precio_oferta, plazomax AS plazo_maximo, con_oferta, motor, feature_image_url, array_to_string(promociones, '|') AS promociones, array_to_string(galeria_exterior, '|') AS galeria_exterior, array_to_string(galeria_interior, '|') AS galeria_interior FROM inv",
    "single_row_guard": f"WITH {INV}, k AS (SELECT id, modelo, modelo || '/' || CAST(trunc(precio) AS BIGINT) AS key FROM inv) SELECT id, modelo FROM k WHERE key IN (SELECT key FROM k GROUP BY key HAVING count(*) = 1)",
    "compare_in_list": f"WITH {INV} SELECT {CARD}, motor, cilindros, kilometraje AS kilometraje_numerico FROM inv WHERE id IN (7, 3, 3, 12)",
    "compare_at_least_two": f"""WITH {INV}, a AS (SELECT DISTINCT c_custkey AS request_id, unnest([c_custkey, c_custkey * 7, c_custkey * 1000]) AS want FROM customer),
f AS (SELECT request_id, inv.* FROM a JOIN inv ON want = id)
SELECT request_id, {CARD}, motor, cilindros, kilometraje AS kilometraje_numerico FROM f WHERE request_id IN (SELECT request_id FROM f GROUP BY request_id HAVING count(*) >= 2)""",
    "detail_id_before_slug": f"""WITH {INV}, a AS (SELECT c_custkey AS request_id, CASE WHEN c_custkey % 4 < 2 THEN c_custkey END AS want, CASE WHEN c_custkey % 2 = 0 THEN 'o-' || (c_custkey * 2) END AS want_slug FROM customer),
f AS (SELECT request_id, id AS item_id, {TITLE} AS titulo, {money("precio")} AS precio FROM a JOIN inv ON CASE WHEN want IS NOT NULL THEN id = want ELSE slug = want_slug END)
SELECT a.request_id, item_id, titulo, precio FROM a LEFT JOIN (SELECT * FROM f WHERE request_id IN (SELECT request_id FROM f GROUP BY request_id HAVING count(*) = 1)) f ON a.request_id = f.request_id""",
    "inventory_search_json": f"""WITH {INV}, top AS (SELECT * FROM live WHERE marca ILIKE '%build%' AND precio >= 50000 ORDER BY precio NULLS LAST, id LIMIT 50), card AS (SELECT {CARD} FROM top)
SELECT CAST(json_object('id', id, 'titulo', titulo, 'marca', marca, 'modelo', modelo, 'ano', ano, 'precio', precio, 'kilometraje', kilometraje, 'garantia', garantia, 'enganche_minimo', enganche_minimo, 'url', url) AS VARCHAR) AS value FROM card""",
    "alternatives_band": search("NOT marca ILIKE '%auto%' AND precio BETWEEN 300000 * 0.8::DOUBLE AND 300000 * 1.2::DOUBLE", 5),
    "inventory_stats_summary": f"WITH {INV} SELECT {SUMMARY} FROM live",
    "inventory_brand_counts": f"WITH {INV} SELECT marca, count(*) AS cantidad FROM live WHERE marca <> '' GROUP BY marca",
    "inventory_stats_nested": f"""WITH {INV}, s AS (SELECT {SUMMARY} FROM live), b AS (SELECT marca, count(*) AS cantidad FROM live WHERE marca <> '' GROUP BY marca)
SELECT total AS total_vehiculos, {money("precio_minimo")} AS minimo, {money("precio_maximo")} AS maximo, {money("precio_promedio")} AS promedio, ano_desde AS desde, ano_hasta AS hasta,
  CAST(row_number() OVER (ORDER BY cantidad DESC, marca) - 1 AS INTEGER) AS posicion, marca, cantidad FROM s, b""",
    "distinct_terms": "SELECT DISTINCT p_brand AS candidate FROM part WHERE p_brand IS NOT NULL",
    "suggest_terms_topn": "SELECT DISTINCT p_name AS candidate FROM part WHERE p_name IS NOT NULL ORDER BY 1 LIMIT 10",
    "amount_normalize_price": "SELECT p_partkey, CASE WHEN p_retailprice < 1000 THEN p_retailprice * 1000 ELSE p_retailprice END AS value, p_retailprice < 1000 AS changed FROM part",
    "amount_normalize_down": "WITH v AS (SELECT DISTINCT l_quantity * 25 AS given FROM lineitem) SELECT given, CASE WHEN given <= 100 THEN given WHEN given < 1000 THEN given * 1000 ELSE given END AS value, given <= 100 AS is_percent, given > 100 AND given < 1000 AS changed FROM v",
    "money_format": f"SELECT c_custkey, {money('c_acctbal')} AS shown, CAST(NULL AS VARCHAR) AS zero FROM customer",
    "km_format": f"WITH {INV} SELECT id, {KM} AS shown FROM inv",
    "title_fallback": f"WITH {INV} SELECT id, {TITLE} AS shown FROM inv",
    "url_fallback": f"WITH {INV} SELECT id, {URL} AS shown FROM inv",
    "finance_quote": quotes(48, 15.0),
    "finance_zero_rate": quotes(36, 0.0),
    "finance_zero_term": quotes(0, 15.0),
    "quote_payload_json": f"""{PAYLOAD}
SELECT request_id, CAST(json_merge_patch('{{}}', json_object('to', "to", 'subject', 'Cotización: ' || {TITLE}, 'type', 'cotizacion', 'data', json_object('nombre_cliente', nombre_cliente,
  'vehiculo', json_object('titulo', {TITLE}, 'marca', marca, 'modelo', modelo, 'ano', autoano, 'precio', {money("precio")}, 'url', coalesce({URL}, '')),
  'financiamiento', json_object('enganche_porcentaje', pct, 'enganche', {money("down")}, 'monto_a_financiar', {money("financed")}, 'tasa_anual', '15%', 'plazo_meses', months, 'mensualidad_estimada', {money("floor(monthly + 0.5)")})))) AS VARCHAR) AS value
FROM m""",
    "quote_payload": f"""{PAYLOAD}
SELECT request_id, "to", 'Cotización: ' || {TITLE} AS subject, 'cotizacion' AS type, nombre_cliente, {TITLE} AS titulo, marca, modelo, autoano AS ano, coalesce({URL}, '') AS url, {money("precio")} AS precio,
  pct AS enganche_porcentaje, {money("down")} AS enganche, {money("financed")} AS monto_a_financiar, '15%' AS tasa_anual, CAST(months AS INTEGER) AS plazo_meses, {money("floor(monthly + 0.5)")} AS mensualidad_estimada FROM m""",
    "term_dictionary": f"WITH {TYPED} SELECT c_custkey, term, v AS from_dictionary FROM typed LEFT JOIN dict ON lower(trim(term)) = k",
    "term_exact": f"WITH {TYPED} SELECT c_custkey, term, candidate AS from_value FROM typed LEFT JOIN cand ON lower(trim(term)) = lower(candidate)",
    "term_fuzzy": f"WITH {TYPED} SELECT c_custkey, term, from_near, distance FROM typed LEFT JOIN near USING (term)",
    "term_cascade": f"""WITH {TYPED} SELECT c_custkey, typed.term, coalesce(v, candidate, from_near, typed.term) AS corrected,
  v IS NOT NULL OR (candidate IS NULL AND from_near IS NOT NULL) AS was_corrected, coalesce(v, candidate, from_near) IS NULL AS unmatched
FROM typed LEFT JOIN dict ON lower(trim(typed.term)) = k LEFT JOIN cand ON lower(trim(typed.term)) = lower(candidate) LEFT JOIN near ON near.term = typed.term""",
    "term_cascade_brands": f"WITH {cascade(dictionaries.BRANDS)} SELECT c_custkey, term, corrected, was_corrected, unmatched FROM found",
    "term_cascade_models": f"WITH {cascade(dictionaries.MODELS)} SELECT c_custkey, term, corrected, was_corrected, unmatched FROM found",
    "correction_log": f"""WITH {cascade(dictionaries.BRANDS)} SELECT c_custkey, concat_ws('; ', CASE WHEN was_corrected THEN 'marca: ' || term || ' → ' || corrected END,
  CASE WHEN c_acctbal < 1000 THEN 'precio_maximo: ' || c_acctbal || ' → ' || (c_acctbal * 1000) END) AS log, CASE WHEN unmatched THEN 'Nothing is known of ' || term || '.' END AS message FROM found""",
    "tokenize": r"SELECT item_id, array_to_string(list_filter(regexp_split_to_array(lower(text), '\s+'), lambda t: length(t) > 2), '|') AS tokens FROM benchmark",
    "knowledge_search": f"WITH {KNOW} SELECT id, category AS categoria, title AS titulo, content AS contenido FROM know WHERE is_active AND ({HIT}) ORDER BY priority DESC NULLS FIRST, id LIMIT 5",
    "knowledge_search_category": f"WITH {KNOW} SELECT id, 'politica' AS categoria, title AS titulo, content AS contenido FROM know WHERE is_active AND category = 'en' ORDER BY priority DESC NULLS FIRST, id LIMIT 5",
    "knowledge_search_many": f"""WITH {KNOW}, q AS (SELECT min(p_partkey) AS question_id, p_name AS question FROM part GROUP BY p_name),
t AS (SELECT DISTINCT question_id, unnest(list_filter(regexp_split_to_array(lower(question), '\\s+'), lambda t: length(t) > 2)) AS token FROM q),
h AS (SELECT DISTINCT question_id, id, priority FROM t JOIN know ON is_active AND (contains(lower(title), token) OR contains(lower(content), token))),
r AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY priority DESC NULLS FIRST, id) AS rank FROM h)
SELECT question_id, CAST(rank AS INTEGER) AS rank, id FROM r WHERE rank <= 5""",
    "knowledge_index_deep": f"""WITH {KNOW}, q AS (SELECT min(p_partkey) AS question_id, p_name AS question FROM part GROUP BY p_name),
t AS (SELECT DISTINCT question_id, unnest(list_filter(regexp_split_to_array(lower(question), '\\s+'), lambda t: length(t) > 2)) AS token FROM q),
h AS (SELECT DISTINCT question_id, id, priority FROM t JOIN know ON is_active AND (contains(lower(title), token) OR contains(lower(content), token))),
r AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY priority DESC NULLS FIRST, id) AS rank FROM h)
SELECT question_id, CAST(rank AS INTEGER) AS rank, id FROM r WHERE rank <= 20""",
    "knowledge_topics_folded": f"""WITH {KNOW}, k AS (SELECT id, is_active, CASE WHEN id % 2 = 0 THEN 'politica' ELSE 'servicio' END AS category, (['DEVOLUCIÓN ', 'devolución ', 'Devolucion ', 'Intercámbio ', 'otro '])[id % 5 + 1] || id AS titulo FROM know),
t(tema, cat, word) AS (VALUES ('devoluciones', 'politica', 'devolucion'), ('intercambio', 'servicio', 'intercambio'))
SELECT tema, id, titulo FROM k JOIN t ON category = cat AND contains(strip_accents(lower(titulo)), word) WHERE is_active""",
    "term_folded": """WITH a AS (SELECT c_custkey, translate(c_mktsegment, 'AEIOU', 'ÁÉÍÓÚ') AS t, c_mktsegment FROM customer)
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN t ELSE lower(t) END AS term, c_mktsegment AS from_value FROM a""",
    "term_table_fresh": """SELECT term, sum(n)::BIGINT AS n FROM (SELECT p_brand AS term, CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE 1 END AS n FROM part WHERE p_brand IS NOT NULL) GROUP BY term HAVING sum(n) > 0""",
    "person_found": r"""WITH p AS (SELECT c_custkey AS k, c_name, lpad(CAST(c_custkey AS VARCHAR), 10, '5') AS tel, lower(replace(c_name, '#', '.')) || '@example.invalid' AS mail,
  list_aggregate(list_sort(list_filter(regexp_split_to_array(lower(c_name), '[\s,.#]+'), lambda w: w <> '')), 'string_agg', ' ') AS nm FROM customer),
a AS (SELECT k, CASE WHEN k % 5 = 0 THEN k + 1 END AS id, CASE WHEN k % 5 = 1 THEN tel END AS tel, CASE WHEN k % 5 < 3 THEN mail END AS mail,
  CASE WHEN k % 5 > 1 THEN CASE WHEN k % 2 = 0 THEN list_aggregate(list_sort(list_filter(regexp_split_to_array('customer, ' || regexp_extract(c_name, '#0*(.*)', 1), '[\s,.#]+'), lambda w: w <> '')), 'string_agg', ' ') ELSE nm END END AS nm FROM p),
m AS (
  SELECT a.k AS request_id, p.k AS person_id, 'id' AS por, 100 AS puntos FROM a JOIN p ON a.id = p.k
  UNION ALL SELECT a.k, p.k, 'telefono', 40 FROM a JOIN p ON a.tel = p.tel
  UNION ALL SELECT a.k, p.k, 'email', 40 FROM a JOIN p ON a.mail = p.mail
  UNION ALL SELECT a.k, p.k, 'nombre', 20 FROM a JOIN p ON a.nm = p.nm
  UNION ALL SELECT a.k, p.k, 'nombre_parecido', 10 FROM a JOIN p ON a.nm <> p.nm AND abs(length(a.nm) - length(p.nm)) <= 2 AND levenshtein(a.nm, p.nm) <= 2),
s AS (SELECT request_id, person_id, CAST(sum(puntos) AS BIGINT) AS puntos, string_agg(por, ',' ORDER BY por) AS evidencia FROM m GROUP BY request_id, person_id)
SELECT *, CAST(row_number() OVER (PARTITION BY request_id ORDER BY puntos DESC, person_id) AS INTEGER) AS rank FROM s QUALIFY rank <= 3""",
    "knowledge_search_wordless": f"""WITH {KNOW}, q AS (SELECT p_partkey AS question_id, CASE p_partkey % 3 WHEN 0 THEN 'a de' WHEN 1 THEN p_name END AS question FROM part),
w AS (SELECT question_id, coalesce(list_filter(regexp_split_to_array(lower(question), '\\s+'), lambda t: length(t) > 2), []) AS ts FROM q),
h AS (SELECT DISTINCT question_id, id, priority FROM (SELECT question_id, unnest(ts) AS token FROM w) JOIN know ON is_active AND (contains(lower(title), token) OR contains(lower(content), token))
  UNION ALL SELECT question_id, id, priority FROM (SELECT question_id FROM w WHERE len(ts) = 0), (SELECT id, priority FROM know WHERE is_active ORDER BY priority DESC NULLS FIRST, id LIMIT 3)),
r AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY priority DESC NULLS FIRST, id) AS rank FROM h)
SELECT question_id, CAST(rank AS INTEGER) AS rank, id FROM r WHERE rank <= 3""",
    "knowledge_topics": f"""WITH {KNOW}, k AS (SELECT id, is_active, (['general', 'garantia', 'financiamiento', 'proceso', 'politica', 'servicio'])[id % 6 + 1] AS category,
  (['Horario ', 'sobre ', 'Contacto ', 'Documentos ', 'COMPRA ', 'Devolucion ', 'Intercambio ', 'Otro '])[id // 6 % 8 + 1] || title AS titulo FROM know),
t(tema, cat, pat) AS (VALUES {", ".join(f"('{n}', '{c}', '{p}')" for n, (c, p) in knowledge.TOPICS.items())})
SELECT tema, id, titulo FROM k JOIN t ON category = cat AND titulo ILIKE pat WHERE is_active""",
    "knowledge_topic": f"WITH {KNOW} SELECT id, title AS titulo, content AS contenido FROM know WHERE is_active AND category = 'fr' AND title ILIKE '%le%'",
    "knowledge_faq": f"WITH {KNOW} SELECT id, title AS pregunta, content AS respuesta FROM know WHERE is_active AND category = 'en' AND contains(lower(content), 'licensed') ORDER BY priority DESC NULLS FIRST, id LIMIT 10",
    "lead_status": f"""WITH {LEADS} SELECT telefono, CASE WHEN telefono IN (SELECT phone FROM prof) THEN 'perfil'
  WHEN telefono IN (SELECT telefono FROM lead WHERE NOT atendido) THEN 'lead_abierto' ELSE 'nuevo' END AS status FROM req""",
    "lead_insert_set": f"""WITH {LEADS} SELECT nombre, telefono, nullif(email, '') AS email, vehiculo_interes, comentarios, 'chat_widget' AS source FROM req
WHERE telefono NOT IN (SELECT phone FROM prof) AND telefono NOT IN (SELECT telefono FROM lead WHERE NOT atendido)""",
    "latest_open_lead": f"""WITH {LEADS}, n AS (SELECT *, row_number() OVER (PARTITION BY telefono ORDER BY created_at DESC NULLS FIRST, id) AS n FROM lead WHERE NOT atendido)
SELECT telefono, id, nombre, created_at FROM n WHERE n = 1""",
}
