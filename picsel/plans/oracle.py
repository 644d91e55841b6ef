"""DuckDB SQL oracles: the stand-in views and every operator written independently as plain SQL.

The strings run on DuckDB with the supplied tables registered as views. They share the stand-in view
definitions with ``picsel.sources.standins`` (same rules, written in SQL).
"""

from __future__ import annotations

import re

from picsel import constants as K

SEED = K.DEFAULT_DRAW_SEED
DATASET_ID = "picsel-check"
INSERTION_TS = 1611532800.0
INSERTION_TS_TEXT = "1.6115328E9"  # as Spark writes this double
SEARCH_DATE = "2021-01-25"


def _wiki(k: str) -> str:
    return (f"CASE {k} % 4 WHEN 0 THEN 'enwiki' WHEN 1 THEN 'arwiki' WHEN 2 THEN 'frwiki' "
            f"ELSE 'kowiki' END")


def _item(k: str) -> str:
    return f"('Q' || CAST(CAST(FLOOR({k} / 4) AS BIGINT) AS VARCHAR))"


def _s(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def _md5_bigint(*parts: str) -> str:
    joined = " || '|' || ".join(parts)
    return f"(('0x' || substr(md5({joined}), 1, 15))::BIGINT)"


def _sql_list(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


_VALID_IMAGE = " AND ".join(
    f"NOT contains(lower(image), '{s}')" for s in dict.fromkeys(K.INVALID_IMAGE_SUBSTRINGS))

_NUMERIC_ID = ("CASE WHEN json_valid(instanceof) THEN "
               "TRY_CAST(json_extract_string(instanceof, '$.\"numeric-id\"') AS BIGINT) END")

VIEWS = f"""
page_v AS (
  SELECT {_wiki('o_orderkey')} AS wiki_db, '2021-01' AS snapshot, o_orderkey AS page_id,
         'Page_' || {_s('o_orderkey')} AS page_title,
         CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS page_namespace,
         CASE WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS page_is_redirect,
         CAST(o_totalprice AS DOUBLE) AS page_len
  FROM orders
  UNION ALL
  SELECT 'commonswiki', '2021-01', p_partkey, 'File_' || {_s('p_partkey')} || '.jpg', 6,
         CASE WHEN p_type = 'PROMO' THEN 1 ELSE 0 END, CAST(p_size AS DOUBLE)
  FROM part
),
imagelinks_v AS (
  SELECT {_wiki('l_orderkey')} AS wiki_db, '2021-01' AS snapshot, l_orderkey AS il_from,
         'File_' || {_s('l_partkey')} || '.jpg' AS il_to, 0 AS il_from_namespace
  FROM lineitem
),
page_props_v AS (
  SELECT {_wiki('l_orderkey')} AS wiki_db, '2021-01' AS snapshot, l_orderkey AS pp_page,
         CASE WHEN l_linenumber = 1 AND l_returnflag = 'A' THEN 'page_image'
              WHEN l_linenumber = 1 AND l_returnflag = 'N' THEN 'page_image_free' ELSE 'defaultsort' END AS pp_propname,
         'File_' || {_s('CAST((FLOOR(l_orderkey / 4) + l_partkey % 2) % 200 AS BIGINT)')} || '.jpg' AS pp_value
  FROM lineitem
),
item_page_link_v AS (
  SELECT '2021-01-25' AS snapshot, {_item('o_orderkey')} AS item_id, o_orderkey AS page_id,
         0 AS page_namespace, {_wiki('o_orderkey')} AS wiki_db
  FROM orders
),
categorylinks_v AS (
  SELECT 'commonswiki' AS wiki_db, '2021-01' AS snapshot, p_partkey AS cl_from,
         'Category_' || {_s('p_partkey % 50')} AS cl_to,
         CASE WHEN p_size < 5 THEN 'subcat' ELSE 'file' END AS cl_type
  FROM part
),
placeholder_category_v AS (
  SELECT * FROM (VALUES ('1', 'Category_7'), ('2', 'Category_13')) t(id, title)
),
item_keys AS (SELECT DISTINCT CAST(FLOOR(o_orderkey / 4) AS BIGINT) AS k FROM orders),
claims_v AS (
  SELECT 'Q' || {_s('k')} AS item_id, 'P18' AS property,
         '"' || CASE WHEN k % 35 = 0 THEN 'Flag of ' || {_s('k')} || '.jpg'
                     WHEN k % 10 = 0 THEN 'File_' || {_s('k % 200')} || '.jpg'
                     ELSE 'Photo ' || {_s('k')} || '.jpg' END || '"' AS value
  FROM item_keys WHERE k % 5 = 0
  UNION ALL
  SELECT 'Q' || {_s('k')}, 'P373', '"Category ' || {_s('k % 50')} || '"' FROM item_keys WHERE k % 3 = 0
  UNION ALL
  SELECT 'Q' || {_s('k')}, 'P31',
         '{{"entity-type":"item","numeric-id":' || {_s('n')} || ',"id":"Q' || {_s('n')} || '"}}'
  FROM (SELECT k, CASE WHEN k % 11 = 0 THEN 577 WHEN k % 13 = 0 THEN 4167410
                       WHEN k % 17 = 0 THEN 101352 ELSE 5 END AS n FROM item_keys)
),
labels_v AS (
  SELECT 'Q' || {_s('k')} AS item_id, lang, 'Label ' || {_s('k')} || ' ' || lang AS label
  FROM item_keys, (VALUES ('en'), ('ar'), ('fr'), ('ko')) l(lang)
  WHERE lang <> 'ko' OR k % 7 <> 0
)"""

POOL = f"""
articles AS (SELECT * FROM page_v WHERE page_namespace = 0 AND page_is_redirect = 0),
wiki_size AS (SELECT wiki_db, COUNT(*) AS wiki_size FROM articles GROUP BY wiki_db),
thresholds AS (
  SELECT wiki_db, wiki_size,
         CASE WHEN wiki_size >= {K.ICON_BASE_SIZE}
              THEN (LOG10(wiki_size / {K.ICON_BASE_SIZE}.0) + 1) * {K.ICON_THRESHOLD}.0
              ELSE GREATEST(wiki_size / {K.ICON_BASE_SIZE}.0 * {K.ICON_THRESHOLD}.0,
                            {K.ICON_THRESHOLD}.0 / {K.ICON_LIMIT}.0) END AS threshold
  FROM wiki_size
),
icons AS (
  SELECT il.wiki_db, il.il_to, COUNT(il.il_to) AS n_links, MAX(t.threshold) AS threshold
  FROM imagelinks_v il JOIN thresholds t ON t.wiki_db = il.wiki_db
  WHERE il.il_from_namespace = 0 AND il.il_to NOT LIKE '%"%' AND il.il_to NOT LIKE '%,%'
  GROUP BY il.wiki_db, il.il_to
  HAVING COUNT(il.il_to) > MAX(t.threshold)
),
with_images AS (
  SELECT DISTINCT il.wiki_db, il.il_from AS page_id FROM imagelinks_v il
  WHERE il.il_from_namespace = 0
    AND NOT EXISTS (SELECT 1 FROM icons i WHERE i.wiki_db = il.wiki_db AND i.il_to = il.il_to)
),
with_lead AS (
  SELECT DISTINCT wiki_db, pp_page AS page_id FROM page_props_v
  WHERE pp_propname IN ('page_image', 'page_image_free')
),
illustrated AS (SELECT wiki_db, page_id FROM with_images UNION SELECT wiki_db, page_id FROM with_lead),
unill AS (
  SELECT a.wiki_db, l.item_id, a.page_id, a.page_title, a.page_len
  FROM articles a JOIN item_page_link_v l ON l.wiki_db = a.wiki_db AND l.page_id = a.page_id
  WHERE l.page_namespace = 0
    AND NOT EXISTS (SELECT 1 FROM illustrated i WHERE i.wiki_db = a.wiki_db AND i.page_id = a.page_id)
),
item_props AS (
  SELECT item_id AS id,
         MAX(CASE WHEN property = 'P18' THEN value END) AS hasimage,
         MAX(CASE WHEN property = 'P373' THEN replace(replace(value, '"', ''), ' ', '_') END) AS commonscategory,
         MAX(CASE WHEN property = 'P31' THEN value END) AS instanceof
  FROM claims_v WHERE property IN ('P18', 'P31', 'P373') GROUP BY item_id
),
needed AS (SELECT DISTINCT wiki_db, item_id, regexp_extract(wiki_db, '^(.+?)wiki', 1) AS lang FROM unill),
claims AS (
  SELECT n.wiki_db, n.item_id AS id, lb.label AS label_val, p.hasimage, p.commonscategory, p.instanceof
  FROM needed n JOIN labels_v lb ON lb.item_id = n.item_id AND lb.lang = n.lang
  JOIN item_props p ON p.id = n.item_id
),
commons_files AS (
  SELECT page_id, page_title FROM page_v
  WHERE wiki_db = 'commonswiki' AND page_namespace = 6 AND page_is_redirect = 0
),
placeholders AS (
  SELECT cl.cl_from, cl.cl_to, cl.cl_type, f.page_title
  FROM categorylinks_v cl JOIN commons_files f ON f.page_id = cl.cl_from
  JOIN placeholder_category_v pc ON pc.title = cl.cl_to
  WHERE cl.wiki_db = 'commonswiki'
),
cat_files AS (
  SELECT cl.cl_to, f.page_title
  FROM categorylinks_v cl JOIN commons_files f ON f.page_id = cl.cl_from
  WHERE cl.wiki_db = 'commonswiki' AND cl.cl_type = 'file'
    AND EXISTS (SELECT 1 FROM claims c WHERE c.commonscategory = cl.cl_to)
    AND NOT EXISTS (SELECT 1 FROM placeholders ph WHERE ph.page_title = f.page_title)
),
cat_stats AS (
  SELECT cl_to, COUNT(*) AS n_category_images,
         COUNT(CASE WHEN contains(page_title, '.') THEN 1 END) AS n_dotted_images
  FROM cat_files GROUP BY cl_to
),
cat_numbered AS (
  SELECT cl_to, page_title,
         ROW_NUMBER() OVER (PARTITION BY cl_to
                            ORDER BY page_title) - 1 AS idx
  FROM cat_files WHERE contains(page_title, '.')
),
item_leads AS (
  SELECT l.item_id, pp.wiki_db AS src_wiki, pp.pp_value AS image
  FROM item_page_link_v l JOIN page_props_v pp ON pp.wiki_db = l.wiki_db AND pp.pp_page = l.page_id
  WHERE l.page_namespace = 0 AND pp.pp_propname IN ('page_image', 'page_image_free')
    AND EXISTS (SELECT 1 FROM commons_files f WHERE f.page_title = pp.pp_value)
    AND NOT EXISTS (SELECT 1 FROM placeholders ph WHERE ph.page_title = pp.pp_value)
),
leads AS (
  SELECT u.wiki_db, u.item_id, u.page_id, il.src_wiki, il.image
  FROM unill u JOIN item_leads il ON il.item_id = u.item_id
  WHERE il.src_wiki <> u.wiki_db
),
pool_pages AS (
  SELECT u.wiki_db, u.item_id, u.page_id, u.page_title, u.page_len,
         c.label_val, c.hasimage, c.commonscategory, c.instanceof
  FROM unill u LEFT JOIN claims c ON c.wiki_db = u.wiki_db AND c.id = u.item_id
),
pool_rows AS (
  SELECT p.wiki_db, p.item_id, p.page_id, p.page_title, p.page_len, l.lan_images, l.n_lan_images,
         p.label_val, p.hasimage, p.commonscategory, p.instanceof, s.n_category_images
  FROM pool_pages p
  LEFT JOIN (SELECT wiki_db, page_id, COUNT(*) AS n_lan_images,
                    array_to_string(list_sort(list(src_wiki || ': ' || image)), ';') AS lan_images
             FROM leads GROUP BY wiki_db, page_id) l
    ON l.wiki_db = p.wiki_db AND l.page_id = p.page_id
  LEFT JOIN cat_stats s ON s.cl_to = p.commonscategory
)"""

SELECTION = f"""
eligible AS (
  SELECT * FROM pool_pages
  WHERE NOT COALESCE({_NUMERIC_ID} IN ({', '.join(str(x) for x in K.EXCLUDED_INSTANCE_NUMERIC_IDS)}), FALSE)
),
by_wiki AS (
  SELECT l.wiki_db, l.page_id, l.image, COUNT(*) AS n_wikis, list_sort(list(l.src_wiki)) AS wikis
  FROM leads l
  WHERE EXISTS (SELECT 1 FROM eligible e WHERE e.wiki_db = l.wiki_db AND e.page_id = l.page_id)
    AND NOT contains(l.image, ' ') AND length(l.image) > 0 AND {_VALID_IMAGE}
  GROUP BY l.wiki_db, l.page_id, l.image
),
wiki_cands AS (
  SELECT wiki_db, page_id, image, CAST(2.0 AS DOUBLE) + CAST(rn - 1 AS DOUBLE) / 10.0 AS rating,
         '{K.NOTE_WIKIPEDIA_PREFIX}' || array_to_string(wikis, ', ') AS note
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY wiki_db, page_id ORDER BY n_wikis DESC, image) AS rn
        FROM by_wiki)
  WHERE rn <= {K.TOP_K}
),
item_cands AS (
  SELECT wiki_db, page_id, substring(hasimage, 2, GREATEST(length(hasimage) - 2, 0)) AS image,
         CAST(1.0 AS DOUBLE) AS rating, '{K.NOTE_WIKIDATA}' AS note
  FROM eligible WHERE hasimage IS NOT NULL AND NOT contains(lower(hasimage), 'flag')
),
draws AS (
  SELECT wiki_db, page_id, cl_to, n_dotted_images, unnest(range(0, LEAST(n_category_images, {K.TOP_K}))) AS draw
  FROM (SELECT e.wiki_db, e.page_id, s.cl_to, s.n_dotted_images, s.n_category_images
        FROM eligible e JOIN cat_stats s ON s.cl_to = e.commonscategory
        WHERE s.n_dotted_images > 0)
),
cat_cands AS (
  SELECT DISTINCT d.wiki_db, d.page_id, n.page_title AS image, CAST(3.0 AS DOUBLE) AS rating,
         '{K.NOTE_COMMONS}' AS note
  FROM (SELECT wiki_db, page_id, cl_to,
               {_md5_bigint('wiki_db', _s('page_id'), _s('draw'), repr(SEED).replace('"', "'"))} % n_dotted_images AS idx
        FROM draws) d
  JOIN cat_numbered n ON n.cl_to = d.cl_to AND n.idx = d.idx
),
merged AS (
  SELECT wiki_db, page_id, image, MIN(rating) AS rating, arg_min(note, rating) AS note
  FROM (SELECT * FROM cat_cands UNION ALL SELECT * FROM wiki_cands UNION ALL SELECT * FROM item_cands)
  GROUP BY wiki_db, page_id, image
),
top AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY wiki_db, page_id ORDER BY rating, image) - 1 AS rank FROM merged)
  WHERE rank < {K.TOP_K}
)"""

_CONF = ("CASE CAST(FLOOR(t.rating) AS INTEGER) WHEN 1 THEN 'high' WHEN 2 THEN 'medium' "
         "WHEN 3 THEN 'low' END")
_SOURCE = ("CASE WHEN starts_with(t.note, 'image was in the Wikidata item') THEN 'wikidata' "
           "WHEN starts_with(t.note, 'image was found in the following Wikis:') THEN 'wikipedia' "
           "WHEN starts_with(t.note, 'image was found in the Commons category') THEN 'commons' END")
_FOUND_ON = ("CASE WHEN t.note IS NULL THEN NULL ELSE string_split(regexp_replace("
             "regexp_extract(t.note, 'Wikis:\\s+([^\\r\\n]*)[\\r\\n]?$', 1), '\\s+', '', 'g'), ',') END")
_INSTANCE_ID = ("CASE WHEN p.instanceof IS NULL THEN NULL WHEN json_valid(p.instanceof) "
                "THEN json_extract_string(p.instanceof, '$.id') END")

PRODUCTION = f"""
prod_rows AS (
  SELECT p.wiki_db AS wiki, {_s('p.page_id')} AS page_id, p.page_title, t.image AS image_id,
         {_CONF} AS confidence_rating, {_SOURCE} AS source, {_INSTANCE_ID} AS instance_of,
         {_FOUND_ON} AS found_on
  FROM pool_pages p LEFT JOIN top t ON t.wiki_db = p.wiki_db AND t.page_id = p.page_id
),
prod AS (
  SELECT *, NOT COALESCE(instance_of IN ({_sql_list(K.NON_ARTICLE_QIDS)}), FALSE) AS is_article_page,
         '{DATASET_ID}' AS dataset_id, CAST({INSERTION_TS} AS DOUBLE) AS insertion_ts, '2021-01' AS snapshot
  FROM prod_rows
),
raw AS (
  SELECT {_s('p.page_id')} AS pandas_idx, p.item_id, {_s('p.page_id')} AS page_id, p.page_title,
         (SELECT COUNT(*) FROM top t WHERE t.wiki_db = p.wiki_db AND t.page_id = p.page_id) AS n_candidates,
         p.instanceof AS instance_of, p.wiki_db, '2021-01' AS snapshot
  FROM pool_pages p
)"""

# raw_v from documents: the same rules as StandIns.raw_from_documents, parsed back from the JSON text.
_DOC_ENTRIES = {
    1: ("1", K.NOTE_WIKIDATA),
    2: ("2.1", "image was found in the following ' || CASE doc_id % 4 WHEN 1 THEN 'Wikis: ruwiki,\\n itwiki' WHEN 2 THEN 'Wikis: ruwiki, itwiki\\n' "
               "WHEN 3 THEN 'Wikis:\\n ruwiki, itwiki' ELSE 'Wikis: ruwiki, itwiki' END || '"),
    3: ("3", K.NOTE_COMMONS),
}


def _doc_entry(i: int) -> str:
    rating, note = _DOC_ENTRIES[i]
    return (f"'{{\"image\": \"File_' || {_s(f'doc_id * 3 + {i}')} || '.jpg\", \"rating\": {rating}, "
            f"\"note\": \"{note}\"}}'")


DOC_RAW = f"""
raw_docs AS (
  SELECT {_s('doc_id')} AS pandas_idx, 'Q' || {_s('doc_id')} AS item_id, {_s('doc_id')} AS page_id,
         'Doc_' || {_s('doc_id')} AS page_title,
         CASE doc_id % 5 WHEN 0 THEN NULL
              WHEN 1 THEN '[' || {_doc_entry(1)} || ']'
              WHEN 2 THEN '[' || {_doc_entry(1)} || ', ' || {_doc_entry(2)} || ']'
              WHEN 3 THEN '[' || {_doc_entry(1)} || ', ' || {_doc_entry(2)} || ', ' || {_doc_entry(3)} || ']'
              ELSE 'top_candidates' END AS top_candidates,
         CASE doc_id % 7 WHEN 0 THEN '{{"entity-type":"item","numeric-id":577,"id":"Q577"}}'
              WHEN 1 THEN '{{"entity-type":"item","numeric-id":101352,"id":"Q101352"}}'
              WHEN 2 THEN 'not json' END AS instance_of,
         lang || 'wiki' AS wiki_db, '2021-01' AS snapshot
  FROM documents
),
docs_exploded AS (
  SELECT r.wiki_db, r.page_id, r.page_title, r.instance_of, e.image, e.rating, e.note
  FROM raw_docs r,
       unnest(CAST(CAST(CASE WHEN json_valid(r.top_candidates) THEN r.top_candidates END AS JSON)
                   AS STRUCT(image VARCHAR, note VARCHAR, rating DOUBLE)[])) AS u(e)
  WHERE r.top_candidates IS NOT NULL
),
docs_prod_rows AS (
  SELECT wiki_db AS wiki, page_id, page_title, image AS image_id,
         {_CONF.replace('t.', '')} AS confidence_rating, {_SOURCE.replace('t.', '')} AS source,
         instance_of, {_FOUND_ON.replace('t.', '')} AS found_on
  FROM docs_exploded
  UNION ALL
  SELECT wiki_db, page_id, page_title, NULL, NULL, NULL, instance_of, NULL
  FROM raw_docs WHERE top_candidates IS NULL
),
docs_prod AS (
  SELECT wiki, page_id, page_title, image_id, confidence_rating, source,
         CASE WHEN instance_of IS NULL THEN NULL WHEN json_valid(instance_of)
              THEN json_extract_string(instance_of, '$.id') END AS instance_of, found_on
  FROM docs_prod_rows
),
docs_prod_full AS (
  SELECT *, NOT COALESCE(instance_of IN ({_sql_list(K.NON_ARTICLE_QIDS)}), FALSE) AS is_article_page,
         '{DATASET_ID}' AS dataset_id, CAST({INSERTION_TS} AS DOUBLE) AS insertion_ts, '2021-01' AS snapshot
  FROM docs_prod
)"""


FILE_PAGES = """
file_pages AS (
  SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) AS s, lang
  FROM part, (VALUES ('en'), ('ar'), ('fr'), ('ko')) l(lang)
),
page_values AS (
  SELECT k AS file_key, lang AS language,
         CASE k % 4 WHEN 1 THEN 'About ' || s || ' in ' || lang WHEN 2 THEN 'Last ' || s || ' & ' || lang
                    WHEN 3 THEN CASE WHEN lang = 'en' THEN 'Plain ' || s END END AS description,
         CASE WHEN k % 3 = 0 THEN 'Caption ' || s END AS caption,
         CASE WHEN k % 5 = 0 THEN '["thing ' || CAST(k % 7 AS VARCHAR) || '","thing ' || CAST(k % 3 AS VARCHAR) || '"]' ELSE '[]' END AS depicts,
         CASE WHEN k % 5 = 0 THEN 'CC0' END AS licence
  FROM file_pages
)"""


def json_text(column: str) -> str:
    """A list column as JSON text."""
    return f"CASE WHEN {column} IS NULL THEN NULL ELSE CAST(to_json({column}) AS VARCHAR) END"


def with_ctes(*blocks: str, query: str) -> str:
    body = ",".join(b.strip().rstrip(",") for b in blocks)
    # every shared step is computed once
    body = re.sub(r"(?m)^(\w+) AS \(", r"\1 AS MATERIALIZED (", body)
    return f"WITH {body}\n{query}"


def pipeline(query: str, *more: str) -> str:
    """A query over the full CTE chain (views, pool, selection, production)."""
    return with_ctes(VIEWS, POOL, SELECTION, PRODUCTION, *more, query=query)


def pool_only(query: str) -> str:
    return with_ctes(VIEWS, POOL, query=query)


def docs(query: str) -> str:
    return with_ctes(DOC_RAW, query=query)
