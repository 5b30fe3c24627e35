"""The same queries, written independently in SQL for DuckDB over the given tables."""

from __future__ import annotations

_TYPE = "^^<http://www.w3.org/2001/XMLSchema#string>"
_DOC = "'1-'||CAST(CASE WHEN doc_id%5=0 THEN doc_id+1 ELSE doc_id END AS VARCHAR)"
_PAGE = "'1-'||CAST(CASE WHEN page_id%5=0 THEN page_id+1 ELSE page_id END AS VARCHAR)"
_HOLDER = "'2-'||CAST(l_orderkey AS VARCHAR)||'-'||CAST(l_linenumber AS VARCHAR)"
_BREAK = "chr(92)||'n'"

# Inputs: the recipes of FIXTURES.md.
_INPUTS = f"""
kg_organization AS (
  SELECT {_DOC} AS sub, 'organization-name' AS pred,
    '"'||CASE WHEN doc_id%3=0 THEN chr(39) ELSE ' ' END||replace(text,chr(10),{_BREAK})
    ||CASE WHEN doc_id%2=0 THEN '  Ltd.' ELSE ', Inc' END||'"' AS obj FROM documents
  UNION ALL SELECT {_DOC}, 'HeadquartersAddress', '"'||replace(text,chr(10),{_BREAK})||{_BREAK}
    ||'NATION_'||CAST(doc_id%25 AS VARCHAR)||{_BREAK}||'"{_TYPE}' FROM documents
  UNION ALL SELECT {_DOC}, 'HeadquartersAddress', '"'||replace(reverse(text),chr(10),{_BREAK})||{_BREAK}
    ||'NATION_'||CAST(doc_id%25 AS VARCHAR)||{_BREAK}||'"{_TYPE}' FROM documents WHERE doc_id%11=0
  UNION ALL SELECT {_DOC}, 'isDomiciledIn', '<http://geo.example/'||CAST(doc_id%25 AS VARCHAR)||'/>'
    FROM documents WHERE doc_id%7<>0
  UNION ALL SELECT {_DOC}, 'isIncorporatedIn', '<http://geo.example/'||CAST((doc_id+3)%25 AS VARCHAR)||'/>'
    FROM documents WHERE doc_id%4=0
  UNION ALL SELECT {_DOC}, 'hasPrimaryEconomicSector', '<https://kg.example/4-'||CAST(doc_id%6 AS VARCHAR)||'>'
    FROM documents
  UNION ALL SELECT {_DOC}, 'hasPrimaryBusinessSector', '<https://kg.example/4-'||CAST((doc_id+1)%6 AS VARCHAR)||'>'
    FROM documents WHERE doc_id%3=0
  UNION ALL SELECT {_PAGE}, 'hasURL', '<'||url||'>' FROM pages
  UNION ALL SELECT {_PAGE}, 'hasURL', '<http:///'||CAST(page_id AS VARCHAR)||'.a/b>' FROM pages WHERE page_id%13=0
  UNION ALL SELECT {_PAGE}, 'hasURL', '<http://a/b///'||CAST(page_id AS VARCHAR)||'>' FROM pages WHERE page_id%17=0
  UNION ALL SELECT DISTINCT '1-'||CAST(l_suppkey AS VARCHAR), 'hasOrganizationPrimaryQuote',
    '<https://kg.example/1-8'||CAST(l_partkey AS VARCHAR)||'>' FROM lineitem),
kg_quote AS (
  SELECT '1-8'||CAST(p_partkey AS VARCHAR) AS sub, 'hasExchangeTicker' AS pred,
    '"'||upper(replace(p_name,' ','.'))||'"' AS obj FROM part
  UNION ALL SELECT '1-8'||CAST(p_partkey AS VARCHAR), 'hasExchangeCode', '"'||p_brand||'"{_TYPE}' FROM part),
kg_industry AS (
  SELECT '4-'||CAST(row_number() OVER (ORDER BY p_type)-1 AS VARCHAR) AS sub, 'label' AS pred, '"'||p_type||'"' AS obj
  FROM (SELECT DISTINCT p_type FROM part)),
kg_person AS (
  SELECT '1-3'||CAST(c_custkey AS VARCHAR) AS sub, 'family-name' AS pred, '"'||c_mktsegment||'"' AS obj FROM customer
  UNION ALL SELECT '1-3'||CAST(c_custkey AS VARCHAR), 'family-name', '"Alt"' FROM customer WHERE c_custkey%50=0
  UNION ALL SELECT '1-3'||CAST(c_custkey AS VARCHAR), 'given-name', '"'||replace(c_name,'#',' # ')||'"' FROM customer
  UNION ALL SELECT {_HOLDER}, 'hasHolder', '<https://kg.example/1-3'||CAST(o_custkey AS VARCHAR)||'>'
    FROM lineitem JOIN orders ON l_orderkey=o_orderkey
  UNION ALL SELECT {_HOLDER}, CASE WHEN l_returnflag='R' THEN 'isTenureIn' ELSE 'isPositionIn' END,
    '<https://kg.example/1-'||CAST(l_suppkey AS VARCHAR)||'>' FROM lineitem),
kg_triples AS (
  SELECT * FROM kg_organization UNION ALL SELECT * FROM kg_quote
  UNION ALL SELECT * FROM kg_industry UNION ALL SELECT * FROM kg_person),
kg_lines AS (
  SELECT '<https://kg.example/'||sub||'> <http://kg.example/ontology/ns#'||pred||'> '||obj||' .' AS line
  FROM kg_triples),
geo_map AS (
  SELECT '<http://geo.example/'||CAST(n_nationkey AS VARCHAR)||'/>' AS g, n_name AS origin,
    CASE WHEN n_nationkey%9=0 THEN '' ELSE r_name END AS new FROM nation JOIN region ON n_regionkey=r_regionkey),
exchange_map AS (
  SELECT DISTINCT p_brand AS origin, 'EX'||CAST(CAST(substr(p_brand,7) AS INT)%7 AS VARCHAR) AS new
  FROM part WHERE CAST(substr(p_brand,7) AS INT)%5<>0),
industry_map AS (
  SELECT origin, new FROM (VALUES ('STANDARD','Real Estate'),('ECONOMY','Retail'),('MEDIUM','Retail'),
    ('PROMO','Services'),('SMALL','Services')) t(origin,new)),
blocklist AS (
  SELECT '1-3'||CAST(c_custkey AS VARCHAR) AS sub, 'Alt' AS obj FROM customer
  WHERE c_custkey%50=0 AND c_custkey%100<>0)"""

_SPACE = r"[ \t\n\x0B\f\r]+"


def _literal(x: str) -> str:
    return f"""trim(split_part({x},'^^',1),'"')"""


def _id(x: str) -> str:
    return f"regexp_extract({x}, '([^/]*)[^/]$', 1)"


def _host(x: str) -> str:
    return f"string_split(string_split(substr({x},2,length({x})-2),'//')[-1],'/')[1]"


_SECTORS = "('hasPrimaryIndustryGroup','hasPrimaryBusinessSector','hasPrimaryEconomicSector')"

# Intermediate and final relations of the composite pipelines.
_DERIVED = rf"""
names AS (SELECT sub, {_literal('obj')} AS obj FROM kg_organization WHERE pred='organization-name'),
addresses AS (SELECT sub, {_literal('obj')} AS obj FROM kg_organization WHERE pred='HeadquartersAddress'),
hosts AS (SELECT sub, {_host('obj')} AS obj FROM kg_organization WHERE pred='hasURL'),
sectors AS (SELECT sub, {_id('obj')} AS obj FROM kg_organization WHERE pred IN {_SECTORS}),
raw_name AS (
  SELECT DISTINCT sub, 'organization-name' AS pred, obj AS origin,
    strip_accents(replace(regexp_replace(regexp_replace(
      replace(replace(trim(obj,' '),',',' '),'.',''),'{_SPACE}',' ','g'),'^''|''$','','g'),'ß','ss')) AS obj
  FROM names),
name_count AS (SELECT *, count(*) OVER (PARTITION BY sub) AS c FROM raw_name),
company_name AS (SELECT sub, pred, origin, obj FROM name_count WHERE c=1),
company_name_conflict AS (SELECT sub, pred, origin, obj FROM name_count WHERE c>1),
clean_addresses AS (
  SELECT DISTINCT sub, regexp_replace(rtrim(replace(obj,{_BREAK},' ')),'{_SPACE}',' ','g') AS obj FROM addresses),
company_address AS (
  SELECT sub, 'HeadquartersAddress' AS pred, obj FROM clean_addresses a
  WHERE length(obj) = (SELECT max(length(obj)) FROM clean_addresses b WHERE b.sub=a.sub)),
company_url AS (
  SELECT sub, 'hasURL' AS pred, obj FROM (SELECT DISTINCT * FROM hosts)
  QUALIFY rank() OVER (PARTITION BY sub ORDER BY length(obj) DESC)=1),
company_country AS (
  SELECT DISTINCT o.sub, 'hasCountry' AS pred, m.new AS obj, m.origin FROM kg_organization o
  JOIN geo_map m ON o.obj=m.g WHERE o.pred IN ('isDomiciledIn','isIncorporatedIn')),
company_country_from_address AS (
  SELECT DISTINCT a.sub, 'isDomiciledInFromAddress' AS pred, m.new AS obj, m.origin FROM addresses a
  JOIN geo_map m ON string_split(a.obj,{_BREAK})[-2]=m.origin
  WHERE m.new<>'' AND a.sub NOT IN (SELECT sub FROM kg_organization WHERE pred='isDomiciledIn')),
company_country_all AS (
  SELECT * FROM company_country UNION ALL SELECT * FROM company_country_from_address),
quoted AS (
  SELECT DISTINCT sub, {_id('obj')} AS q FROM kg_organization WHERE pred='hasOrganizationPrimaryQuote'),
tickers AS (SELECT DISTINCT sub AS q, {_literal('obj')} AS ticker FROM kg_quote WHERE pred='hasExchangeTicker'),
listings AS (
  SELECT DISTINCT c.sub AS q, m.new AS ex_code, t.ticker FROM kg_quote c
  JOIN exchange_map m ON {_literal('c.obj')}=m.origin JOIN tickers t ON t.q=c.sub WHERE c.pred='hasExchangeCode'),
company_exchange AS (
  SELECT sub, 'hasExchange' AS pred, ex_code||'$'||ticker AS obj FROM listings JOIN quoted USING (q)),
mapped_industry AS (
  SELECT DISTINCT s.sub, m.origin, m.new AS obj FROM sectors s JOIN kg_industry i ON i.sub=s.obj
  JOIN industry_map m ON m.origin={_literal('i.obj')} WHERE i.pred='label'),
industry_count AS (SELECT sub, count(DISTINCT obj) AS c FROM mapped_industry GROUP BY sub),
company_industry AS (
  SELECT DISTINCT sub, 'hasIndustry' AS pred, obj FROM mapped_industry JOIN industry_count USING (sub)
  WHERE c=1 OR obj='Real Estate'),
all_family AS (SELECT sub, {_literal('obj')} AS obj FROM kg_person WHERE pred='family-name'),
person_family_name AS (
  SELECT DISTINCT sub, 'family-name' AS pred, obj FROM all_family
  WHERE (sub,obj) NOT IN (SELECT (sub,obj) FROM blocklist)),
person_given_name AS (
  SELECT DISTINCT sub, 'given-name' AS pred, {_literal('obj')} AS obj FROM kg_person WHERE pred='given-name'),
holders AS (SELECT DISTINCT sub AS h, {_id('obj')} AS p FROM kg_person WHERE pred='hasHolder'),
positions AS (SELECT DISTINCT sub AS h, {_id('obj')} AS sub FROM kg_person WHERE pred IN ('isTenureIn','isPositionIn')),
company_employee AS (
  SELECT DISTINCT o.sub, 'hasEmployee' AS pred, regexp_replace(f.obj||' '||g.obj,'{_SPACE}',' ','g') AS obj
  FROM positions o JOIN holders h USING (h) JOIN person_family_name f ON f.sub=h.p
  JOIN person_given_name g ON g.sub=h.p),
attributes AS (
  SELECT sub, pred, obj FROM company_name UNION ALL SELECT sub, pred, obj FROM company_address
  UNION ALL SELECT sub, pred, obj FROM company_url UNION ALL SELECT sub, pred, obj FROM company_employee),
listed_lines AS (
  SELECT line, regexp_extract(line, '<https://kg.example/(.+)>\s<(.*?)>\s.*?\s\.', 1) AS subject,
    regexp_extract(line, '<https://kg.example/(.+)>\s<(.*?)>\s.*?\s\.', 2) AS pred FROM kg_lines
  WHERE regexp_matches(line, '<https://kg.example/(.+)>\s<(.*?)>\s.*?\s\.'))"""

_ALL_COUNTRIES = "SELECT sub FROM company_country_all WHERE obj IN ('AMERICA','EUROPE')"

_SELECTS = {
    # Scans and sources
    "scan_lines": "SELECT line AS value FROM kg_lines",
    "parse_triples": "SELECT sub, pred, obj FROM kg_triples",
    "scan_map2": "SELECT origin, new FROM exchange_map",
    "scan_map3": "SELECT g, origin, new FROM geo_map",
    "scan_table": "SELECT sub, pred, obj FROM kg_quote WHERE pred='hasExchangeTicker'",
    "scan_parquet": "SELECT * FROM customer",
    "scan_nt_regex": "SELECT line AS value FROM listed_lines WHERE line LIKE '<https://kg.example/1-%'",
    "ingest_triples": "SELECT sub, pred, obj FROM kg_triples",
    "ingest_new_version": "SELECT sub, pred, obj FROM kg_organization",
    # Sinks
    "sink_table_overwrite": "SELECT sub, pred, obj FROM company_url",
    "sink_table_append": "SELECT sub, pred, obj, origin FROM company_country_all",
    "sink_csv": "SELECT * FROM customer",
    "sink_parquet": "SELECT * FROM customer",
    "sink_stats_tsv": "SELECT 'http://kg.example/ontology/ns#'||pred AS pred, count(*) AS n FROM kg_triples GROUP BY 1",
    # Scalar functions
    "literal_value": "SELECT sub, obj FROM addresses",
    "iri_id": f"SELECT sub, obj FROM sectors UNION ALL SELECT sub, {_id('obj')} FROM kg_organization "
    "WHERE pred='hasOrganizationPrimaryQuote'",
    "ascii_fold": "SELECT sub, strip_accents(replace(obj,'ß','ss')) AS obj FROM kg_organization "
    "WHERE pred='organization-name'",
    "clean_name": "SELECT sub, translate(obj,',.',' ') AS obj FROM names",
    "clean_address": f"SELECT sub, rtrim(replace(obj,{_BREAK},' ')) AS obj FROM addresses",
    "address_country": f"SELECT sub, string_split(obj,{_BREAK})[-2] AS obj FROM addresses",
    "url_host": "SELECT sub, obj FROM hosts",
    "url_host_strict": "SELECT sub, nullif(regexp_extract(obj, '^<[a-z]+://([^/>]+)', 1), '') AS obj FROM kg_organization "
    "WHERE pred='hasURL'",
    "trim_space": "SELECT sub, trim(obj,' ') AS obj FROM names",
    "collapse_ws": f"SELECT sub, regexp_replace(obj,'{_SPACE}',' ','g') AS obj FROM names",
    "strip_apostrophe": "SELECT sub, regexp_replace(obj,'^''|''$','','g') AS obj FROM names",
    "str_length": "SELECT sub, obj, length(obj) AS len FROM hosts",
    "concat_sep": "SELECT q AS sub, ticker AS obj, q||'$'||ticker AS joined FROM tickers",
    "const_pred": "SELECT sub, 'hasName' AS pred, obj FROM names",
    "project_rename": "SELECT sub AS company, obj AS ind FROM sectors",
    "multiply_const": "SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT)*21 AS steps FROM customer",
    "regex_group": "SELECT subject, pred FROM listed_lines",
    # Filters
    "filter_pred_eq": "SELECT sub, pred, obj FROM kg_organization WHERE pred='HeadquartersAddress'",
    "filter_pred_any": f"SELECT sub, pred, obj FROM kg_organization WHERE pred IN {_SECTORS}",
    "filter_not_empty": "SELECT g, origin, new FROM geo_map WHERE new<>''",
    "filter_count": "SELECT o.sub, o.obj, c.n FROM names o JOIN "
    "(SELECT sub, count(*) AS n FROM names GROUP BY sub HAVING count(*)=1) c ON o.sub=c.sub",
    "filter_and": "SELECT m.*, c.n FROM mapped_industry m JOIN "
    "(SELECT sub, count(*) AS n FROM mapped_industry GROUP BY sub) c ON m.sub=c.sub WHERE n>1 AND obj='Real Estate'",
    "filter_rank1": "SELECT sub, obj, length(obj) AS len, CAST(1 AS BIGINT) AS rank FROM addresses a "
    "WHERE length(obj)=(SELECT max(length(obj)) FROM addresses b WHERE b.sub=a.sub)",
    "exclude_pairs": "SELECT f.sub, f.obj FROM all_family f "
    "WHERE NOT EXISTS (SELECT 1 FROM blocklist b WHERE b.sub=f.sub AND b.obj=f.obj)",
    # Joins
    "join_map": f"SELECT sub, m.origin, m.new FROM kg_quote k JOIN exchange_map m ON m.origin={_literal('k.obj')} "
    "WHERE k.pred='hasExchangeCode'",
    "join_entity": "SELECT h, sub, p FROM positions JOIN holders USING (h)",
    "join_two_attrs": "SELECT h.h, h.p, f.obj AS family, g.obj AS given FROM holders h "
    "JOIN (SELECT DISTINCT sub, obj FROM all_family) f ON f.sub=h.p JOIN person_given_name g ON g.sub=h.p",
    "join_back_count": "SELECT h.sub, h.obj, c.n FROM hosts h JOIN (SELECT sub, count(*) AS n FROM hosts GROUP BY sub) c "
    "ON c.sub=h.sub",
    "join_anti": "SELECT sub, obj FROM kg_organization a WHERE pred='HeadquartersAddress' AND NOT EXISTS "
    "(SELECT 1 FROM kg_organization d WHERE d.pred='isDomiciledIn' AND d.sub=a.sub)",
    "join_anti_filtered": "SELECT sub, obj FROM kg_organization WHERE pred='HeadquartersAddress' "
    "AND sub NOT IN (SELECT sub FROM kg_organization WHERE pred='isDomiciledIn')",
    "join_semi_filtered": f"SELECT sub, {_id('obj')} AS obj FROM kg_person WHERE pred IN ('isTenureIn','isPositionIn') "
    f"AND {_id('obj')} IN (SELECT sub FROM kg_organization WHERE pred='hasURL')",
    # Aggregation and distinct
    "count_by_key": "SELECT sub, count(*) AS n FROM kg_organization GROUP BY sub",
    "count_distinct_values": "SELECT sub, count(*) AS n FROM (SELECT DISTINCT sub, obj FROM kg_organization) GROUP BY sub",
    "distinct_rows": "SELECT DISTINCT sub, obj FROM sectors",
    "predicate_count": "SELECT pred, count(*) AS n FROM kg_triples GROUP BY pred",
    # Windows and set operations
    "rank_longest": "SELECT sub, obj, length(obj) AS len, 1+(SELECT count(*) FROM hosts b "
    "WHERE b.sub=a.sub AND length(b.obj)>length(a.obj)) AS rank FROM hosts a",
    "top1_per_key": "SELECT sub, obj FROM company_url",
    "union_by_name": "SELECT sub, pred, obj, origin FROM company_country_all",
    # Composite pipelines
    **{
        name: f"SELECT * FROM {name}"
        for name in (
            "company_exchange",
            "company_name",
            "company_name_conflict",
            "company_address",
            "company_country",
            "company_country_from_address",
            "company_country_all",
            "company_industry",
            "company_url",
            "person_family_name",
            "person_given_name",
            "company_employee",
        )
    },
    "predicate_stats": "SELECT 'http://kg.example/ontology/ns#'||pred AS pred, count(*) AS n FROM kg_triples GROUP BY 1",
    "predicate_stats_by_dump": "SELECT source, 'http://kg.example/ontology/ns#'||pred AS pred, count(*) AS n FROM ("
    "SELECT 'organization' AS source, pred FROM kg_organization UNION ALL SELECT 'quote', pred FROM kg_quote "
    "UNION ALL SELECT 'person', pred FROM kg_person) GROUP BY ALL",
    "stored_predicate_stats": "SELECT dump AS source, 'http://kg.example/ontology/ns#'||pred AS pred, n FROM ("
    "SELECT 'person' AS dump, pred, count(*) AS n FROM kg_person GROUP BY pred UNION ALL "
    "SELECT 'quote', pred, count(*) FROM kg_quote GROUP BY pred UNION ALL "
    "SELECT 'organization', pred, count(*) FROM kg_organization GROUP BY pred)",
    **{f"{name}_by_subject": f"SELECT * FROM {name}" for name in ("company_name", "company_address", "company_url")},
    "employee_steps": "SELECT c_custkey AS id, c_mktsegment||' '||c_name AS name, "
    "CAST(c_nationkey AS BIGINT)*21 AS steps_to_desk FROM customer",
    "listed_company_graph": "SELECT * FROM (SELECT * FROM attributes UNION ALL SELECT sub, pred, obj "
    "FROM company_country_all) WHERE sub IN (SELECT sub FROM company_exchange)",
    "listed_company_graph_by_country": "SELECT * FROM attributes WHERE sub IN (SELECT sub FROM company_exchange) "
    f"AND sub IN ({_ALL_COUNTRIES})",
    "listed_company_graph_by_size": "SELECT sub, pred, obj FROM (SELECT * FROM attributes UNION ALL "
    "SELECT sub, pred, obj FROM company_country_all) WHERE sub IN (SELECT sub FROM company_exchange "
    "GROUP BY sub ORDER BY md5(sub), sub LIMIT 40)",
    "listed_company_graph_stored": "SELECT sub, pred, obj FROM (SELECT * FROM attributes UNION ALL "
    "SELECT sub, pred, obj FROM company_country_all) WHERE sub IN (SELECT sub FROM company_exchange)",
    "changed_subjects": "SELECT DISTINCT sub FROM (SELECT sub, pred, CAST(substr(sub,3) AS BIGINT) AS n FROM kg_organization) "
    "WHERE n%6=0 OR (n%7=0 AND pred='isDomiciledIn') OR (n%10=3 AND pred='HeadquartersAddress')",
    "company_address_changes": "SELECT sub, pred, obj FROM company_address",
}

ORACLE = {name: f"WITH {_INPUTS},{_DERIVED}\n{select}" for name, select in _SELECTS.items()}
