"""Certificates, landed documents and responses derived from the given tables.

One SQL text serves Spark and DuckDB; only the tokens below differ. Nothing is
left out of a table: every order, or every document, becomes a certificate.
All people, ids and codes are invented.
"""

from __future__ import annotations

import datetime as dt
import re

AS_OF = dt.date(2001, 8, 1)
# A limit above the rows that one task is let order.
LARGE_LIMIT, ORDERED_ROWS = 7_000, 500
PROCESSED_AT = dt.datetime(2001, 8, 2, 12, 0, 0)
PROCESSED_BEFORE = "TIMESTAMP '2000-01-01 00:00:00'"

_ORDERS_BASE = """
base AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS received,
         o_orderstatus AS state, o_orderpriority AS grade, '' AS body
  FROM orders
)"""

# Whole texts of the corpus as certificate bodies.
_DOCUMENTS_BASE = """
base AS (
  SELECT doc_id AS k, doc_id * 13 + 7 AS c,
         CAST(DATE '2001-06-20' + CAST(doc_id % 60 AS INT) AS TIMESTAMP) AS received,
         CASE lang WHEN 'en' THEN 'F' WHEN 'fr' THEN 'O' ELSE 'P' END AS state,
         CASE doc_id % 5 WHEN 0 THEN '1-URGENT' WHEN 1 THEN '2-HIGH' WHEN 2 THEN '3-MEDIUM'
                         WHEN 3 THEN '4-NOT SPECIFIED' ELSE '5-LOW' END AS grade,
         text AS body
  FROM documents
)"""

_DERIVED = """
facts AS (
  SELECT *,
    k % 9 AS kind,
    CASE k % 9 WHEN 0 THEN 'modelo' WHEN 1 THEN 'habitat' WHEN 2 THEN 'cuprum'
               WHEN 3 THEN 'capital' WHEN 4 THEN 'provida' WHEN 5 THEN 'planvital'
               WHEN 6 THEN 'uno' WHEN 7 THEN 'andina' ELSE 'habitat' END AS issuer,
    CAST(1 + c % 99 AS @S) || '.' || lpad(CAST(c % 1000 AS @S), 3, '0') || '.'
      || lpad(CAST(k % 1000 AS @S), 3, '0') || '-'
      || CASE WHEN k % 11 = 10 THEN 'K' ELSE CAST(k % 11 AS @S) END AS id,
    CASE k % 9
      WHEN 0 THEN 'm' || CAST(k AS @S) || 'x' || CAST(c AS @S)
      WHEN 2 THEN CAST(k AS @S) || '00' || CAST(c AS @S)
      WHEN 3 THEN CASE WHEN grade = '5-LOW' THEN 'a' ELSE 'A' END || lpad(CAST(k % 10000 AS @S), 4, '0')
                  || '-B' || lpad(CAST(c % 10000 AS @S), 4, '0')
                  || '-C' || lpad(CAST(k // 10000 AS @S), 4, '0') || '-DEFG1-7'
      WHEN 4 THEN '12.' || CAST(k AS @S) || '.' || CAST(c AS @S)
      WHEN 5 THEN CAST(k AS @S) || '-' || CAST(c AS @S)
      WHEN 6 THEN 'u' || CAST(k AS @S) || '|' || CAST(c AS @S)
      WHEN 7 THEN 'n' || CAST(k AS @S)
      ELSE lpad(CAST(k AS @S), 8, '0') || '-a1b2-c3d4-e5f6-' || lpad(CAST(c AS @S), 12, '0')
    END AS code
  FROM base
),
papers AS (
  SELECT *,
    CASE WHEN kind = 8 THEN 'Portal www.AFPHabitat.cl'
         ELSE 'Señores' || chr(10) || 'A.F.P. ' || upper(issuer) || ' S.A.' END || chr(10)
    || CASE c % 10 WHEN 3 THEN 'Liquidación de remuneraciones'
                   WHEN 5 THEN 'Certificado de las cotizaciones'
                   WHEN 7 THEN 'CERTIFICADO  de  COTIZACIONES'
                   ELSE 'Certificado de cotizaciones' END || chr(10)
    || CASE WHEN c % 10 = 8 THEN 'Sin identificación' ELSE 'RUT ' || id END || chr(10)
    || CASE k % 9 WHEN 0 THEN 'Folio interno: ' WHEN 2 THEN 'FOLIO  Nº CU' WHEN 3 THEN 'Certificación: '
                  WHEN 4 THEN 'Certificado: ' WHEN 5 THEN 'Folio ' WHEN 6 THEN 'Certificación Nº: '
                  WHEN 7 THEN 'Folio: ' ELSE 'Código ' END || code || chr(10)
    || body || chr(10) || 'Emitido para ' || CAST(c AS @S) AS paper
  FROM facts
),
copies AS (
  SELECT *,
    CASE grade WHEN '1-URGENT' THEN paper
               WHEN '2-HIGH' THEN replace(replace(paper, 'RUT ', 'R.U.T. '), ' re ', ' RE ')
               WHEN '3-MEDIUM' THEN replace(paper, chr(10) || 'Emitido para ' || CAST(c AS @S), '')
               WHEN '4-NOT SPECIFIED' THEN replace(paper, 'Emitido', 'Copia del emisor' || chr(10) || 'Emitido')
               ELSE paper || chr(10) END AS copy,
    CASE k % 9
      WHEN 0 THEN id || ':' || code
      WHEN 2 THEN id || ':' || code
      WHEN 3 THEN replace(code, '-', ':')
      WHEN 4 THEN replace(code, '.', '') || '-' || replace(replace(id, '.', ''), '-', '')
      WHEN 5 THEN replace(code, '-', '') || ':' || replace(replace(id, '.', ''), '-', '')
      WHEN 6 THEN replace(replace(id, '.', ''), '-', '') || ':' || code
      ELSE code END AS asked
  FROM papers
),
certificates AS (
  SELECT k AS DOC_IDN,
    CASE WHEN state = 'P' AND grade = '5-LOW' THEN NULL
         WHEN state = 'F' AND grade = '4-NOT SPECIFIED' THEN 'doc://lost/' || CAST(k AS @S)
         WHEN state = 'O' AND grade = '2-HIGH' THEN 'doc://' || CAST(k - k % 50 AS @S)
         ELSE 'doc://' || CAST(k AS @S) END AS LINK,
    CAST(received AS DATE) AS PERIODO_PRODUCCION,
    received AS FECHA_INGRESO
  FROM base
),
landed_documents AS (
  SELECT 'doc://' || CAST(k AS @S) AS link,
    CASE WHEN state = 'O' AND grade = '3-MEDIUM' THEN 404 ELSE 200 END AS http_status,
    CASE WHEN state = 'P' AND grade = '1-URGENT' THEN NULL ELSE paper END AS text,
    CASE kind WHEN 2 THEN NULL ELSE 'Informe ' || CAST(kind AS @S) END AS creator,
    CASE kind WHEN 0 THEN 'Powered By Crystal' WHEN 1 THEN 'iText1.3.1 by lowagie' WHEN 2 THEN 'null'
              WHEN 3 THEN 'PDFsharp 1.50' WHEN 4 THEN 'ITEXT 2.1.7' WHEN 5 THEN 'Telerik  Reporting'
              WHEN 6 THEN '' WHEN 7 THEN 'iText' ELSE NULL END AS producer,
    'D:' || CAST(k AS @S) AS creation_date,
    CASE WHEN c % 2 = 0 THEN NULL ELSE 'D:' || CAST(c AS @S) END AS mod_date,
    received AS landed_at
  FROM papers
  UNION ALL
  SELECT 'doc://' || CAST(k AS @S), 500, 'A.F.P. anterior', 'viejo', 'viejo', '', '',
    TIMESTAMP '1990-01-01 00:00:00'
  FROM papers
  UNION ALL
  SELECT 'https://www.afphabitat.cl/copia/' || CAST(k AS @S),
    CASE WHEN grade = '3-MEDIUM' AND state = 'O' THEN 403 ELSE 200 END,
    CASE WHEN grade = '4-NOT SPECIFIED' AND state = 'O' THEN NULL ELSE copy END,
    NULL, NULL, NULL, NULL, received
  FROM copies WHERE issuer = 'habitat'
),
issuer_responses AS (
  SELECT issuer AS afp, asked AS request_key,
    CASE WHEN state = 'P' AND issuer IN ('modelo', 'cuprum', 'capital') THEN 500 ELSE 200 END AS http_status,
    CASE issuer
      WHEN 'habitat' THEN '{"resultado":'
        || CASE state WHEN 'F' THEN '0' WHEN 'O' THEN CASE WHEN c % 2 = 0 THEN '0.0' ELSE 'false' END
                      ELSE CASE c % 5 WHEN 0 THEN '"0"' WHEN 1 THEN '1' WHEN 2 THEN 'null' WHEN 3 THEN 'true'
                                      ELSE '[0]' END END
        || ',"mensaje":"/copia/' || CAST(k AS @S) || '"}'
      WHEN 'uno' THEN CASE state
        WHEN 'F' THEN '{"codigo":"0","data":{"bytes":"' || @B64(copy) || '"}}'
        WHEN 'O' THEN CASE c % 4 WHEN 0 THEN '{"codigo":"0"}' WHEN 1 THEN '{"codigo":"0","data":null}'
                                 WHEN 2 THEN '{"codigo":"0","data":{}}' ELSE '{"codigo":"0","data":{"bytes":7}}' END
        ELSE CASE c % 3 WHEN 0 THEN '{"codigo":0,"data":{"bytes":""}}' WHEN 1 THEN 'no es json'
                        ELSE '{"codigo":"1"}' END END
      WHEN 'planvital' THEN CASE state
        WHEN 'F' THEN '{"valid":true,"data":"' || @B64(copy) || '"}'
        WHEN 'O' THEN CASE c % 5 WHEN 0 THEN '{"valid":"false","data":"QU*JD"}' WHEN 1 THEN '{"valid":1,"data":"QUJ"}'
                                 WHEN 2 THEN '{"valid":[0],"data":null}' WHEN 3 THEN '{"valid":{"a":1}}'
                                 ELSE '{"valid":2.5,"data":"QUI="}' END
        ELSE CASE c % 6 WHEN 0 THEN '{"valid":false}' WHEN 1 THEN '{"valid":0}' WHEN 2 THEN '{"valid":""}'
                        WHEN 3 THEN '{"valid":null}' WHEN 4 THEN '{"valid":[]}' ELSE '[1]' END END
      WHEN 'provida' THEN CASE WHEN state = 'P' THEN '' ELSE 'archivo' END
      ELSE 'archivo' END AS body,
    CASE WHEN issuer IN ('habitat', 'uno', 'planvital') THEN NULL
         WHEN state = 'O' AND grade = '1-URGENT' THEN NULL ELSE copy END AS document_text,
    received AS landed_at
  FROM copies WHERE issuer <> 'andina'
  UNION ALL
  SELECT issuer, asked, 503, '', 'respuesta anterior', TIMESTAMP '1990-01-01 00:00:00'
  FROM copies WHERE issuer <> 'andina'
)"""

PROCESSED = f"""
processed AS (
  SELECT l_orderkey AS DOC_IDN FROM lineitem WHERE l_shipdate < {PROCESSED_BEFORE}
)"""

LANDED_FILES = """
landed_files AS (
  SELECT url || CASE WHEN page_id % 4 = 1 THEN '.crdownload' ELSE '' END AS path,
         substring(url, 1, 12) AS site,
         TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 HOUR * (page_id % 97) AS modificationTime
  FROM pages
),
seen_files AS (SELECT url AS path FROM pages WHERE url LIKE '%page=%')"""


def _render(sql: str, string_type: str, b64: str) -> str:
    sql = re.sub(r"@B64\((\w+)\)", lambda m: b64.format(m.group(1)), sql)
    return sql.replace("@S", string_type)


def _bases(base: str) -> str:
    return {"orders": _ORDERS_BASE, "documents": _DOCUMENTS_BASE}[base]


def spark_ctes(base: str = "orders") -> str:
    sql = "WITH " + ",".join([_bases(base), _DERIVED, PROCESSED, LANDED_FILES])
    sql = sql.replace("k // 10000", "k div 10000").replace(
        "INTERVAL 1 HOUR * (page_id % 97)", "make_interval(0, 0, 0, 0, CAST(page_id % 97 AS INT))"
    )
    # Spark breaks base64 into lines; JSON text may hold no raw line break.
    return _render(sql, "STRING", "replace(replace(base64(CAST({0} AS BINARY)), chr(13), ''), chr(10), '')")


def duckdb_ctes(base: str = "orders") -> str:
    sql = "WITH " + ",".join([_bases(base), _DERIVED, PROCESSED, LANDED_FILES])
    return _render(sql, "VARCHAR", "to_base64(encode({0}))")
