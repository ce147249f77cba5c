"""The same results in DuckDB SQL, written apart from the Spark operators."""

from __future__ import annotations

from . import fixtures as X
from .queries import ALWAYS, CUTOFF, OPTIONS

# Fixed values, written out here so that a wrong pattern in the engine shows.
_SPACE = r"[\s\x0b\x1c-\x1f]"
_ISSUER_LINE = r"\nA\.?F\.?P\.? +(\w+)"
_ISSUER_SITE = r"afphabitat\.cl"
_SITE = "https://www.afphabitat.cl"
_SITE_ISSUER = "habitat"
_RUT_PATTERN = r"\d{1,2}(?:\.\d{3}){2}-[\dkK]"
_CERTIFICATE = r"certificado(?:\s+\w+){0,2}\s+cotizaciones"
# Issuer: code pattern, producer pattern, site.
_RULES = {
    "modelo": (r"Folio.*:\s+([a-z\d]+)", "Powered By Crystal", ""),
    "habitat": (r"([a-z\d]{8}-(?:[a-z\d]{4}-){3}[a-z\d]{12})", "iText1.3.1", _SITE),
    "cuprum": (r"FOLIO\s+N.?\s+CU(\d+)", "null", ""),
    "capital": (r"certificacion:\s+([a-z|\d|-]+)", "PDFsharp", ""),
    "provida": (r"certificado:\s+([\d|\.]+)", "iText", ""),
    "planvital": (r"Folio\s+([\d-]+)", "Telerik Reporting", ""),
    "uno": (r"Certificacion\s+N.?:\s+([a-z|\d]+)", "Powered By Crystal", ""),
}

_STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S')"


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _re2(pattern: str) -> str:
    return pattern.replace(r"\s", _SPACE)


def _fold(text: str) -> str:
    """Accents off, then ASCII only. The derived texts hold one more case: º."""
    return f"regexp_replace(strip_accents(replace({text}, 'º', 'o')), '[^\\x00-\\x7F]', '', 'g')"


def _extract(text: str, pattern: str, group: int = 1) -> str:
    return f"coalesce(regexp_extract({text}, {_literal(_re2(pattern))}, {group}, 'i'), '')"


def _afp(text: str) -> str:
    named = f"lower({_extract(text, _ISSUER_LINE)})"
    site = f"regexp_matches({text}, {_literal(_ISSUER_SITE)}, 'i')"
    return f"CASE WHEN {named} <> '' THEN {named} WHEN {site} THEN '{_SITE_ISSUER}' ELSE '' END"


def _rut(text: str) -> str:
    return f"coalesce(regexp_extract({text}, {_literal(_RUT_PATTERN)}, 0), '')"


def _cert(text: str) -> str:
    return f"coalesce(regexp_matches({text}, {_literal(_re2(_CERTIFICATE))}, 'i'), false)"


def _codver(afp: str, text: str) -> str:
    branches = " ".join(f"WHEN '{afp_}' THEN {_extract(text, rule[0])}" for afp_, rule in _RULES.items())
    return f"CASE {afp} {branches} ELSE '' END"


def _producer(afp: str, producer: str) -> str:
    branches = " ".join(
        f"WHEN '{afp_}' THEN regexp_matches({producer}, {_literal(rule[1])}, 'i')" for afp_, rule in _RULES.items()
    )
    return f"CASE {afp} {branches} END"


def _l11(rut: str) -> str:
    plain = f"replace({rut}, '.', '')"
    return (
        f"CASE WHEN {rut} = '' THEN '' WHEN length({plain}) < 11 "
        f"THEN repeat('0', 11 - length({plain})) || {plain} ELSE {plain} END"
    )


def _plain_rut(rut: str) -> str:
    return f"regexp_replace({rut}, '[.-]', '', 'g')"


_CAPITAL = "^([A-Z0-9]{5})-([A-Z0-9]{5})-([A-Z0-9]{5})-([A-Z0-9]{5})-([0-9])"
_CAPITAL_PARTS = " || ':' || ".join(f"regexp_extract(codver, '{_CAPITAL}', {n})" for n in range(1, 6))
_REQUEST_KEY = f"""CASE afp
  WHEN 'habitat' THEN codver
  WHEN 'modelo' THEN rut || ':' || codver
  WHEN 'cuprum' THEN rut || ':' || replace(codver, 'CU', '')
  WHEN 'provida' THEN replace(codver, '.', '') || '-' || {_plain_rut('rut')}
  WHEN 'uno' THEN {_plain_rut('rut')} || ':' || codver
  WHEN 'planvital' THEN replace(codver, '-', '') || ':' || {_plain_rut('rut')}
  WHEN 'capital' THEN CASE WHEN regexp_matches(codver, '{_CAPITAL}') THEN {_CAPITAL_PARTS} END
END"""

# Candidates.
_SOURCE = """
source AS (
  SELECT CAST(DOC_IDN AS BIGINT) AS doc_idn, LINK AS link,
         PERIODO_PRODUCCION AS periodo, FECHA_INGRESO AS ingreso
  FROM certificates
),
ids AS (SELECT DISTINCT CAST(DOC_IDN AS BIGINT) AS doc_idn FROM processed)"""
_SOURCE_COLUMNS = (
    "doc_idn, link, CAST(periodo AS VARCHAR) AS periodo_produccion, "
    f"{_STAMP.format('ingreso')} AS fecha_ingreso"
)
_RECENT = f"ingreso >= TIMESTAMP '{CUTOFF.isoformat()} 00:00:00'"

# Documents and the fields in them.
_DOCS = f"""
landed AS (
  SELECT * FROM landed_documents
  QUALIFY row_number() OVER (PARTITION BY link ORDER BY landed_at DESC) = 1
),
links AS (SELECT DISTINCT link FROM source WHERE link IS NOT NULL),
obtained AS (
  SELECT links.link, coalesce(http_status = 200, false) AS obtained,
         CASE WHEN http_status = 200 THEN text END AS text,
         CASE WHEN http_status = 200 THEN creator END AS creator,
         CASE WHEN http_status = 200 THEN producer END AS producer,
         CASE WHEN http_status = 200 THEN creation_date END AS creation_date,
         CASE WHEN http_status = 200 THEN mod_date END AS mod_date
  FROM links LEFT JOIN landed ON links.link = landed.link
),
read_text AS (
  SELECT link, obtained, {_fold('text')} AS text,
         coalesce(creator, '') AS metadata_creator, coalesce(producer, '') AS metadata_producer,
         coalesce(creation_date, '') AS metadata_creadate, coalesce(mod_date, '') AS metadata_moddate
  FROM obtained
),
named AS (
  SELECT *, {_afp('text')} AS afp, {_cert('text')} AS es_cert_cot, {_rut('text')} AS rut FROM read_text
),
coded AS (
  SELECT *, {_codver('afp', 'text')} AS codver, {_l11('rut')} AS rut_l11,
         {_producer('afp', 'metadata_producer')} AS es_metadata
  FROM named
),
gate AS (
  SELECT *, es_cert_cot AND afp <> '' AND rut <> '' AND codver <> '' AS gated FROM coded
),
asked_for AS (
  SELECT *, CASE WHEN gated THEN {_REQUEST_KEY} END AS request_key FROM gate
)"""

# Verdicts on responses. TRY_CAST gives NULL for a body that is not JSON.
_ZERO = "json_type(j, '$.resultado') IN ('UBIGINT', 'BIGINT', 'DOUBLE') AND TRY_CAST(j ->> '$.resultado' AS DOUBLE) = 0"
_HABITAT_OK = (
    f"coalesce(CASE WHEN json_type(j, '$.resultado') = 'BOOLEAN' THEN (j ->> '$.resultado') = 'false' "
    f"ELSE {_ZERO} END, false)"
)
_UNO_OK = "coalesce(json_type(j, '$.codigo') = 'VARCHAR' AND (j ->> '$.codigo') = '0', false)"
_PLANVITAL_OK = """coalesce(CASE json_type(j, '$.valid')
  WHEN 'BOOLEAN' THEN (j ->> '$.valid') = 'true'
  WHEN 'VARCHAR' THEN (j ->> '$.valid') <> ''
  WHEN 'ARRAY' THEN json_array_length(j, '$.valid') > 0
  WHEN 'OBJECT' THEN len(json_keys(j, '$.valid')) > 0
  WHEN 'NULL' THEN false
  ELSE TRY_CAST(j ->> '$.valid' AS DOUBLE) <> 0 END, false)"""


def _text_at(path: str, inside: str) -> str:
    """Text at a path of an object at ``inside``: '' if absent, NULL if not text."""
    return (
        f"CASE WHEN json_type(j, '{inside}') = 'OBJECT' AND json_type(j, '{path}') IS NULL THEN '' "
        f"WHEN json_type(j, '{path}') = 'VARCHAR' THEN j ->> '{path}' END"
    )


_UNO_PAYLOAD = (
    "CASE WHEN json_type(j) = 'OBJECT' AND json_type(j, '$.data') IS NULL THEN '' "
    f"ELSE {_text_at('$.data.bytes', '$.data')} END"
)
_PLANVITAL_PAYLOAD = _text_at("$.data", "$")
_CLEAN = "regexp_replace(payload, '[^A-Za-z0-9+/=]', '', 'g')"
_DECODED = f"CASE WHEN length({_CLEAN}) % 4 = 0 THEN decode(from_base64({_CLEAN})) END"

_COPIES = f"""
answers AS (
  SELECT *, CASE WHEN afp IN ('habitat', 'uno', 'planvital') THEN TRY_CAST(body AS JSON) END AS j
  FROM issuer_responses
  QUALIFY row_number() OVER (PARTITION BY afp, request_key ORDER BY landed_at DESC) = 1
),
judged AS (
  SELECT *,
    CASE WHEN afp = 'habitat' AND {_HABITAT_OK}
         THEN '{_SITE}' || ({_text_at('$.mensaje', '$')}) END AS url,
    CASE WHEN afp = 'uno' AND {_UNO_OK} THEN {_UNO_PAYLOAD}
         WHEN afp = 'planvital' AND {_PLANVITAL_OK} THEN {_PLANVITAL_PAYLOAD} END AS payload
  FROM answers WHERE http_status = 200
),
followed AS (
  SELECT judged.afp, judged.request_key,
         CASE WHEN landed.http_status = 200 THEN landed.text END AS copy_text
  FROM judged LEFT JOIN landed ON judged.url = landed.link
  WHERE judged.afp = 'habitat'
),
issuer_copies AS (
  SELECT afp, request_key, copy_text FROM followed
  UNION ALL
  SELECT afp, request_key,
    CASE WHEN afp IN ('uno', 'planvital') THEN {_DECODED}
         WHEN afp = 'provida' AND length(body) = 0 THEN NULL
         ELSE document_text END
  FROM judged WHERE afp <> 'habitat'
),
verified AS (
  SELECT asked_for.*, {_fold('issuer_copies.copy_text')} AS copy_text
  FROM asked_for LEFT JOIN issuer_copies
    ON asked_for.afp = issuer_copies.afp AND asked_for.request_key = issuer_copies.request_key
)"""


def _diff(table: str, key: str, verified: str, original: str) -> str:
    """Lines one by one, numbered per copy, and what has no partner."""
    end = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e]"
    lines = (
        "CASE WHEN {0} = '' THEN []::VARCHAR[] ELSE "
        f"regexp_split_to_array(regexp_replace({{0}}, '({end})$', ''), '{end}') END"
    )
    side = """
      SELECT {key}, '{sign}' AS sign, {n} AS side, unnest({lines}) AS line,
             generate_subscripts({lines}, 1) AS pos
      FROM {table} WHERE {verified} <> {original}"""
    sides = " UNION ALL ".join(
        side.format(key=key, sign=sign, n=n, lines=lines.format(text), table=table, verified=verified, original=original)
        for n, (sign, text) in enumerate((("-", verified), ("+", original)))
    )
    return f"""
diff_lines AS ({sides}),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY {key}, side, line ORDER BY pos) AS nth FROM diff_lines
),
unpaired AS (
  SELECT a.* FROM numbered a
  WHERE NOT EXISTS (
    SELECT 1 FROM numbered b
    WHERE a.{key} = b.{key} AND a.line = b.line AND a.nth = b.nth AND a.side <> b.side)
),
reports AS (
  SELECT {key}, string_agg(sign || ' ' || line, ' | ' ORDER BY pos, side) AS report FROM unpaired GROUP BY {key}
)"""


_AUDITED = (
    _diff("verified", "link", "copy_text", "text")
    + """,
outcome AS (
  SELECT verified.*,
    CASE WHEN NOT obtained THEN 'error_origen' WHEN NOT gated THEN ''
         WHEN copy_text IS NULL THEN 'error' ELSE 'ok' END AS res_afp,
    copy_text <> text AND gated AS es_dif,
    coalesce(report, '') AS res_dif
  FROM verified LEFT JOIN reports ON verified.link = reports.link
)"""
)


def _with(base: str, *parts: str) -> str:
    return ",".join([X.duckdb_ctes(base), *[p.strip("\n") for p in parts if p]])


def _source(select: str) -> str:
    return f"{_with('orders', _SOURCE)} SELECT {select}"


def _fields(select: str, base: str = "documents", where: str = "true") -> str:
    parts = f"""
folded AS (SELECT k, {_fold('paper')} AS text FROM papers),
named AS (SELECT k, text, {_afp('text')} AS afp, {_rut('text')} AS rut, {_cert('text')} AS es_cert_cot FROM folded),
coded AS (SELECT *, {_codver('afp', 'text')} AS codver FROM named)"""
    return f"{_with(base, parts)} SELECT {select} FROM coded WHERE {where}"


def _key(name: str) -> str:
    return _fields(f"k, {_REQUEST_KEY} AS request_key", "orders", f"afp = '{name}' AND rut <> '' AND codver <> ''")


def _documents(select: str, base: str = "orders") -> str:
    return f"{_with(base, _SOURCE, _DOCS)} SELECT {select}"


def _responses(name: str, expression: str) -> str:
    return (
        f"{_with('orders')}, r AS (SELECT *, TRY_CAST(body AS JSON) AS j FROM issuer_responses WHERE afp = '{name}')"
        f" SELECT request_key, http_status, {expression} FROM r"
    )


def _decoded(name: str, payload: str) -> str:
    return (
        f"{_with('orders')}, r AS (SELECT *, TRY_CAST(body AS JSON) AS j FROM issuer_responses WHERE afp = '{name}'),"
        f" p AS (SELECT *, {payload} AS payload FROM r)"
        f" SELECT request_key, http_status, {_DECODED} AS decoded FROM p"
    )


def _line_diff(base: str) -> str:
    texts = f"texts AS (SELECT k, {_fold('copy')} AS v, {_fold('paper')} AS o FROM copies)"
    return (
        f"{_with(base, texts, _diff('texts', 'k', 'v', 'o'))} "
        "SELECT texts.k, v <> o AS es_dif, coalesce(report, '') AS res_dif "
        "FROM texts LEFT JOIN reports ON texts.k = reports.k"
    )


_PROCESSED_AT = f"'{X.PROCESSED_AT:%Y-%m-%d %H:%M:%S}' AS FECHA_PROCESO"
_BASE_COLUMNS = f"""b.doc_idn AS DOC_IDN, b.link AS LINK, CAST(b.periodo AS VARCHAR) AS PERIODO_PRODUCCION,
  {_STAMP.format('b.ingreso')} AS FECHA_INGRESO"""


def _audit(base: str, where: str, tail: str = "", select: str | None = None) -> str:
    batch = f"batch AS (SELECT * FROM source WHERE {where} {tail})"
    rows = f"""result AS (SELECT {_BASE_COLUMNS},
      coalesce(metadata_creator, '') AS METADATA_CREATOR, coalesce(metadata_producer, '') AS METADATA_PRODUCER,
      coalesce(metadata_creadate, '') AS METADATA_CREADATE, coalesce(metadata_moddate, '') AS METADATA_MODDATE,
      es_metadata AS ES_METADATA, coalesce(afp, '') AS AFP, coalesce(es_cert_cot, false) AS ES_CERT_COT,
      coalesce(codver, '') AS CODVER, coalesce(rut, '') AS RUT, coalesce(rut_l11, '') AS RUT_L11,
      coalesce(res_afp, 'error_origen') AS RES_AFP,
      CASE WHEN gated THEN es_dif END AS ES_DIF, coalesce(res_dif, '') AS RES_DIF, {_PROCESSED_AT}
      FROM batch b LEFT JOIN outcome ON b.link = outcome.link)"""
    parts = [_SOURCE, batch, _DOCS, _COPIES, _AUDITED, rows]
    return f"{_with(base, *parts)} {select or 'SELECT * FROM result'}"


def _reasons(base: str) -> str:
    """Why each document has its outcome, decided from the tables step by step."""
    issuers = ", ".join(map(_literal, _RULES))
    return f"""{_with(base, _SOURCE, _DOCS, _COPIES, _AUDITED)}
    SELECT b.doc_idn AS DOC_IDN, b.link AS LINK, coalesce(o.afp, '') AS AFP, coalesce(o.res_afp, 'error_origen') AS RES_AFP,
      CASE WHEN b.link IS NULL THEN 'no_link'
      WHEN l.link IS NULL THEN 'not_landed'
      WHEN l.http_status IS DISTINCT FROM 200 THEN 'document_status'
      WHEN l.text IS NULL THEN 'unreadable_text'
      WHEN NOT o.es_cert_cot THEN 'not_certificate'
      WHEN o.afp = '' THEN 'no_issuer'
      WHEN o.afp NOT IN ({issuers}) THEN 'unknown_issuer'
      WHEN o.rut = '' THEN 'no_rut'
      WHEN o.codver = '' THEN 'no_code'
      WHEN o.request_key IS NULL THEN 'malformed_code'
      WHEN r.afp IS NULL THEN 'no_response'
      WHEN r.http_status IS DISTINCT FROM 200 THEN 'response_status'
      WHEN r.afp IN ('habitat', 'uno', 'planvital') AND j IS NULL THEN 'malformed_answer'
      WHEN (r.afp = 'habitat' AND NOT {_HABITAT_OK}) OR (r.afp = 'uno' AND NOT {_UNO_OK})
        OR (r.afp = 'planvital' AND NOT {_PLANVITAL_OK}) THEN 'refused'
      WHEN r.afp = 'provida' AND length(r.body) = 0 THEN 'empty_answer'
      WHEN r.afp = 'habitat' AND judged.url IS NULL THEN 'no_copy_path'
      WHEN r.afp = 'habitat' AND site.link IS NULL THEN 'copy_not_landed'
      WHEN r.afp = 'habitat' AND site.http_status IS DISTINCT FROM 200 THEN 'copy_status'
      WHEN r.afp IN ('uno', 'planvital') AND ({_DECODED}) IS NULL THEN 'malformed_payload'
      WHEN o.copy_text IS NULL THEN 'unreadable_copy'
      WHEN o.copy_text <> o.text THEN 'different' ELSE 'same' END AS REASON
    FROM source b LEFT JOIN landed l ON b.link = l.link LEFT JOIN outcome o ON b.link = o.link
      LEFT JOIN (SELECT afp, request_key, http_status, body FROM answers) r ON o.afp = r.afp AND o.request_key = r.request_key
      LEFT JOIN (SELECT afp, request_key, url, payload, j FROM judged) judged ON o.afp = judged.afp AND o.request_key = judged.request_key
      LEFT JOIN landed site ON judged.url = site.link
    WHERE b.doc_idn IS NOT NULL"""


def _diagnostics(select: str) -> str:
    return _source(f"{select} FROM source")


_TOTALS = f"count(*) AS total_source, count(*) FILTER ({_RECENT}) AS recent_source"
_MATCHED = f"""count(*) FILTER ({_RECENT} AND doc_idn IN (SELECT doc_idn FROM ids)) AS already_processed,
  count(*) FILTER ({_RECENT} AND doc_idn NOT IN (SELECT doc_idn FROM ids)) AS pending_after_dedup"""
_RANGE = f"{_STAMP.format('min(ingreso)')} AS min_fecha_ingreso, {_STAMP.format('max(ingreso)')} AS max_fecha_ingreso"
_CUTOFF = f"'{CUTOFF.isoformat()}' AS cutoff_date, count(*) FILTER (doc_idn IS NULL) AS null_ids"
_UNMATCHED = "CAST(NULL AS BIGINT) AS already_processed, CAST(NULL AS BIGINT) AS pending_after_dedup"
_NOT_DONE = "doc_idn IS NOT NULL AND doc_idn NOT IN (SELECT doc_idn FROM ids)"
_FILES = """SELECT {0} max_by(path, (modificationTime, path)) AS path,
  strftime(max(modificationTime), '%Y-%m-%d %H:%M:%S') AS modificationTime
  FROM landed_files
  WHERE NOT suffix(path, '.crdownload') AND path NOT IN (SELECT path FROM seen_files) {1}"""
_RULE_VALUES = ", ".join(
    f"({', '.join(map(_literal, (afp_, *rule)))})" for afp_, rule in _RULES.items()
)

ORACLES: dict[str, str] = {
    "s1_table_scan": f"""{_with('orders')} SELECT DOC_IDN, LINK, CAST(PERIODO_PRODUCCION AS VARCHAR) AS PERIODO_PRODUCCION,
      {_STAMP.format('FECHA_INGRESO')} AS FECHA_INGRESO FROM certificates""",
    "s3_processed_ids": f"{_with('orders')} SELECT CAST(DOC_IDN AS BIGINT) AS doc_idn FROM processed",
    "s4_document_acquisition": _documents(
        """s.doc_idn, s.link, CASE WHEN coalesce(o.obtained, false) THEN '' ELSE 'error_origen' END AS res_afp,
        o.text, o.producer FROM source s LEFT JOIN obtained o ON s.link = o.link"""
    ),
    "s5_newest_landed_file": f"{_with('orders')} {_FILES.format('', '')}",
    "s5_newest_landed_file_per_site": f"{_with('orders')} {_FILES.format('site,', 'GROUP BY site')}",
    "p1_source_normalization": _source(f"{_SOURCE_COLUMNS} FROM source"),
    # Ids as text, periods as six digits, times as text; some don't convert.
    "p1_source_normalization_of_text": f"""{_with('orders', _SOURCE)}
      SELECT CASE WHEN doc_idn % 7 = 0 THEN NULL ELSE doc_idn END AS doc_idn, link,
        CAST(date_trunc('month', periodo) AS DATE)::VARCHAR AS periodo_produccion,
        CASE WHEN doc_idn % 5 = 0 THEN NULL ELSE {_STAMP.format('ingreso')} END AS fecha_ingreso FROM source""",
    "p2_lookback_window": _source(f"{_SOURCE_COLUMNS} FROM source WHERE {_RECENT}"),
    "p3_required_fields_gate": _documents("link, gated, request_key FROM asked_for"),
    "p4_base_result": _source(
        f"""{_BASE_COLUMNS}, '' AS METADATA_CREATOR, '' AS METADATA_PRODUCER, '' AS METADATA_CREADATE,
        '' AS METADATA_MODDATE, CAST(NULL AS BOOLEAN) AS ES_METADATA, '' AS AFP, false AS ES_CERT_COT,
        '' AS CODVER, '' AS RUT, '' AS RUT_L11, '' AS RES_AFP, CAST(NULL AS BOOLEAN) AS ES_DIF,
        '' AS RES_DIF, {_PROCESSED_AT} FROM source b"""
    ),
    "p5_processing_timestamp": _source(f"doc_idn AS DOC_IDN, {_PROCESSED_AT} FROM source"),
    "j1_pending_documents": _source(
        f"{_SOURCE_COLUMNS} FROM source s WHERE NOT EXISTS (SELECT 1 FROM ids WHERE ids.doc_idn = s.doc_idn)"
    ),
    "j1_pending_documents_by_index": _source(
        f"{_SOURCE_COLUMNS} FROM source s WHERE doc_idn IS NULL OR doc_idn NOT IN (SELECT doc_idn FROM ids WHERE doc_idn IS NOT NULL)"
    ),
    "j2_already_processed_documents": _source(
        f"{_SOURCE_COLUMNS} FROM source WHERE doc_idn IN (SELECT doc_idn FROM ids)"
    ),
    "j3_issuer_rule_lookup": (
        _fields("k, coded.afp, codver_pattern, producer_pattern, domain", "orders").replace(
            "FROM coded WHERE",
            f"FROM coded LEFT JOIN (VALUES {_RULE_VALUES}) r(afp, codver_pattern, producer_pattern, domain) "
            "ON coded.afp = r.afp WHERE",
        )
    ),
    "j4_verified_document_lookup": (
        f"{_with('orders', _SOURCE, _DOCS, _COPIES)} SELECT link, afp, request_key, copy_text FROM verified WHERE gated"
    ),
    "j5_followed_copy_lookup": (
        f"{_with('orders', _SOURCE, _DOCS, _COPIES)} SELECT afp, request_key, copy_text FROM followed"
    ),
    "a1_distinct_processed_ids": _source("doc_idn FROM ids"),
    "a2_source_counts": _diagnostics(f"{_TOTALS}, {_MATCHED}"),
    "a3_ingest_range": _diagnostics(_RANGE),
    "a4_zero_candidate_diagnostics": _diagnostics(
        f"{_TOTALS}, {_CUTOFF}, {_RANGE}, {_MATCHED}, 'done' AS dedup_state"
    ),
    "a4_diagnostics_filter_off": _diagnostics(
        f"{_TOTALS}, {_CUTOFF}, {_RANGE}, {_UNMATCHED}, 'filter_off' AS dedup_state"
    ),
    "a4_diagnostics_no_target": _diagnostics(
        f"{_TOTALS}, {_CUTOFF}, {_RANGE}, {_UNMATCHED}, 'no_target' AS dedup_state"
    ),
    "t1_first_documents_by_id": _source(
        f"{_SOURCE_COLUMNS} FROM source ORDER BY source.doc_idn NULLS FIRST LIMIT {OPTIONS.row_limit}"
    ),
    "t1_many_documents_by_id": _source(
        f"{_SOURCE_COLUMNS} FROM source ORDER BY source.doc_idn NULLS FIRST, ingreso NULLS FIRST, link NULLS FIRST,"
        f" periodo NULLS FIRST LIMIT {X.LARGE_LIMIT}"
    ),
    "t1_no_limit": _source(f"{_SOURCE_COLUMNS} FROM source"),
    "f1_text_folding": f"SELECT doc_id, {_fold('text')} AS folded FROM documents",
    "f2_issuer_detection": _fields("k, afp"),
    "f3_rut_extraction": _fields("k, rut"),
    "f4_codver_extraction": _fields("k, afp, codver"),
    "f5_certificate_classifier": _fields("k, es_cert_cot"),
    "f6_producer_check": _documents("link, afp, metadata_producer, es_metadata FROM coded"),
    "f7_rut_l11": _fields(f"k, rut, {_l11('rut')} AS rut_l11", "orders"),
    "f8_metadata_cleaning": f"""{_with('orders')} SELECT link, {_STAMP.format('landed_at')} AS landed_at,
      coalesce(creator, '') AS metadata_creator, coalesce(text, '') AS metadata_producer,
      '' AS metadata_creadate, coalesce(mod_date, '') AS metadata_moddate FROM landed_documents""",
    "f9_text_inequality": f"{_with('documents')} SELECT k, {_fold('copy')} <> {_fold('paper')} AS es_dif FROM copies",
    "f10_line_diff": _line_diff("documents"),
    "f10_line_diff_short_texts": _line_diff("orders"),
    "f11_provida_request_key": _key("provida"),
    "f12_uno_request_key": _key("uno"),
    "f13_planvital_request_key": _key("planvital"),
    "f14_habitat_modelo_cuprum_request_keys": _fields(
        f"k, afp, {_REQUEST_KEY} AS request_key",
        "orders",
        "afp IN ('habitat', 'modelo', 'cuprum') AND rut <> '' AND codver <> ''",
    ),
    "f15_capital_code_split": _fields(
        ", ".join(["k", *[f"regexp_extract(codver, '{_CAPITAL}', {n}) AS p{n}" for n in range(1, 6)]])
        + f", {_REQUEST_KEY} AS request_key",
        "orders",
        "afp = 'capital' AND codver <> ''",
    ),
    "r1_status_gate": f"""{_with('orders')} SELECT afp, request_key, http_status,
      coalesce(http_status = 200, false) AS accepted FROM issuer_responses""",
    "r2_habitat_verdict": _responses("habitat", f"{_HABITAT_OK} AS accepted"),
    "r3_provida_verdict": _responses("provida", "coalesce(length(body) > 0, false) AS accepted"),
    "r4_uno_verdict": _responses("uno", f"{_UNO_OK} AS accepted"),
    "r5_planvital_verdict": _responses("planvital", f"{_PLANVITAL_OK} AS accepted"),
    "r6_uno_payload": _responses("uno", f"{_UNO_PAYLOAD} AS payload"),
    "r6_planvital_payload": _responses("planvital", f"{_PLANVITAL_PAYLOAD} AS payload"),
    "r7_base64_decode": _decoded("planvital", _PLANVITAL_PAYLOAD),
    "r7_base64_decode_uno": _decoded("uno", _UNO_PAYLOAD),
    "r8_audit_status": _audit(
        "orders",
        "doc_idn IS NOT NULL",
        select="SELECT RES_AFP, ES_DIF, ES_CERT_COT, count(*) AS documents FROM result GROUP BY ALL",
    ),
    "r8_outcome_reasons": _reasons("orders"),
    "r8_outcome_reasons_of_documents": _reasons("documents"),
    "certificate_audit": _audit(
        "orders", f"ingreso >= DATE '{ALWAYS}' AND {_NOT_DONE}", f"ORDER BY doc_idn NULLS FIRST LIMIT {OPTIONS.row_limit}"
    ),
    "certificate_run_batch": _audit(
        "orders", f"ingreso >= DATE '{ALWAYS}' AND {_NOT_DONE}", f"ORDER BY doc_idn NULLS FIRST LIMIT {OPTIONS.row_limit}"
    ),
    "certificate_audit_recent": _audit("orders", f"{_RECENT} AND {_NOT_DONE}"),
    "certificate_audit_everything": _audit("orders", "doc_idn IS NOT NULL"),
    "document_audit_everything": _audit("documents", "doc_idn IS NOT NULL"),
}
