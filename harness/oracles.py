"""The same results as SQL for the check engine, written apart from the operators."""

from __future__ import annotations

from harness.workload import AS_OF, DIM, POSTINGS_SQL, RAW_PAGES_SQL

NOW = f"TIMESTAMP '{AS_OF}'"
WORDS = r"[^\p{L}\p{N}_]"


def found(text: str, pattern: str) -> str:
    """A pattern test; the boundary is spelled out, as the engine's own is ASCII."""
    spelled = "|".join(_spell(part) for part in _branches(pattern)).replace("'", "''")
    return f"regexp_matches({text}, '{spelled}')"


def _branches(pattern: str) -> list[str]:
    return pattern.split("|") if "(" not in pattern else [pattern]


def _spell(part: str) -> str:
    if part.startswith(r"\b"):
        part = rf"(^|{WORDS})" + part[2:]
    if part.endswith(r"\b"):
        part = part[:-2] + rf"($|{WORDS})"
    return part


def points(*cases: tuple[str, int], default: int = 0) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {p}" for c, p in cases) + f" ELSE {default} END"


def chars(*codes: int) -> str:
    return " || ".join(f"chr({c})" for c in codes)


NBSP_AND_BREAKS = chars(10, 13, 9, 160)
BLANKS = chars(
    32, 9, 10, 11, 12, 13, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2008, 0x2009,
    0x200A, 0x2028, 0x2029, 0x205F, 0x3000,
)


def stripped(text: str) -> str:
    return f"translate(regexp_replace({text}, '<[^>]*>', ' ', 'g'), {NBSP_AND_BREAKS}, '    ')"


def phrases(text: str, *words: str) -> str:
    tests = ["contains({}, '{}')".format(text, w.replace("'", "''")) for w in words]
    return "(" + " OR ".join(tests) + ")"


# --- Fixed values: skill tags and their patterns, in tag order, apart from the package's ---
SKILL_PATTERNS = (
    ("python", r"\bpython\b"), ("sql", r"\bsql\b"), ("pyspark", r"\bpyspark\b"), ("scala", r"\bscala\b"),
    ("spark", r"\bspark\b"), ("aws", r"\baws\b|amazon\s?web\s?services"), ("S3", r"\bs3\b|amazon\s?s3"),
    ("Lambda", r"\blambda\b"), ("ECR", r"\becr\b"), ("Athena", r"\bathena\b"), ("dbt", r"\bdbt\b"),
    ("snowflake", r"\bsnowflake\b"), ("airflow", r"\bairflow\b"), ("pandas", r"\bpandas\b"),
    ("streamlit", r"\bstreamlit\b"), ("fastapi", r"\bfastapi|fast\s?api\b"), ("git", r"\bgit\b"),
    ("github_actions", r"github\s?actions"), ("cicd", r"ci/cd|continuous\s?integration|continuous\s?delivery"),
    ("docker", r"\bdocker\b"), ("kubernetes", r"kubernetes|\bk8s\b"), ("terraform", r"\bterraform\b"),
    ("architecture_medaillon", r"architecture\s?m[ée]daillon|medallion\s?architecture"),
    ("etl", r"\betl\b|extract\s?transform\s?load"), ("elt", r"\belt\b|extract\s?load\s?transform"),
)
SKILL_LIST = "[" + ", ".join(f"CASE WHEN {found('search_text', p)} THEN '{tag}' END" for tag, p in SKILL_PATTERNS) + "]"
# --- Fixed values: phrases, patterns and labels below are those the rules must have ---
ETHICAL = ("impact", "green", "environnement", "transition", "coopérative", "scic", "scop", "ess")

DESCRIBED = """
described AS (
  SELECT * REPLACE (CASE WHEN source_name IN ('Adzuna', 'Jooble')
                         THEN regexp_replace(replace(description, '&nbsp;', ' '), '\\.\\.\\.\\s*$', '')
                         ELSE replace(description, '&nbsp;', ' ') END AS description)
  FROM postings)"""

CHAIN = [
    f"postings AS ({POSTINGS_SQL})",
    f"""normalised AS (
  SELECT *, coalesce(try_cast(created_at AS TIMESTAMP), {NOW}) AS published_at,
         trim(regexp_replace(location, '\\(?[0-9]{{2,5}}\\)?|-', '', 'g'), ' ') AS location_clean,
         md5(concat_ws(chr(31), title, company_name, description)) AS digest
  FROM postings)""",
    """by_id AS (
  SELECT * FROM normalised QUALIFY row_number() OVER (
    PARTITION BY job_id, source_name
    ORDER BY published_at DESC NULLS LAST, url ASC NULLS LAST, digest, doc_id) = 1)""",
    """printed AS (
  SELECT *, sha256(concat_ws('||', lower(translate(trim(title, ' '), '–—―', '---')),
                             lower(translate(trim(company_name, ' '), '–—―', '---')),
                             lower(trim(location_clean, ' ')))) AS fingerprint
  FROM normalised)""",
    """by_fingerprint AS (
  SELECT * FROM printed WHERE doc_id IN (SELECT doc_id FROM by_id) QUALIFY row_number() OVER (
    PARTITION BY fingerprint
    ORDER BY published_at DESC NULLS LAST, source_name ASC NULLS LAST, job_id ASC NULLS LAST) = 1)""",
    DESCRIBED,
    f"""searchable AS (
  SELECT *, {stripped('description')} AS description_clean,
         lower(concat_ws(' ', title, {stripped('description')})) AS search_text
  FROM described)""",
    f"""measured AS (
  SELECT s.*, n.published_at, n.location_clean,
         coalesce(
           CAST(try_cast(nullif(regexp_extract(lower(description_clean), '(\\d+)\\s*(?:ans?|ann[ée]es?)', 1), '') AS FLOAT) AS DOUBLE),
           try_cast(nullif(regexp_extract(lower(description_clean), '(\\d+)\\s*mois', 1), '') AS FLOAT) / 12.0::DOUBLE
         ) AS any_years,
         list_filter({SKILL_LIST}, lambda x: x IS NOT NULL) AS extracted_skills,
         regexp_replace(regexp_extract(concat_ws(' | ', salary_info, description_clean),
                        '(\\d{{2}}\\s?\\d{{3}}|\\d{{2}}k|\\d{{5}})', 1), '\\s', '', 'g') AS salary_text
  FROM searchable s JOIN (SELECT doc_id, published_at, location_clean FROM normalised) n USING (doc_id))""",
    f"""amounts AS (
  SELECT *, CASE WHEN any_years <= 15 THEN any_years END AS exp_min_required,
         CASE WHEN salary_text LIKE '%k' THEN try_cast(replace(salary_text, 'k', '') AS INTEGER) * 1000
              ELSE try_cast(salary_text AS INTEGER) END AS amount
  FROM measured)""",
    f"""featured AS (
  SELECT *, CASE WHEN amount BETWEEN 25000 AND 180000 THEN CAST(amount AS INTEGER) END AS salary_min_numeric,
         {phrases('search_text', 'junior', 'débutant', 'jeune diplômé')} AS is_junior,
         {phrases('search_text', 'senior', 'expert', 'lead', 'confirmé')} AS is_senior,
         {phrases('search_text', 'alternance', 'stage', 'support', 'technicien', 'helpdesk')} AS is_red_flag,
         {phrases('search_text', *ETHICAL)} OR {phrases('lower(company_name)', *ETHICAL)} AS is_ethical,
         regexp_matches(search_text, 'télétravail|remote|home\\s?office|full\\s?remote|distanciel') AS is_remote,
         CASE source_name WHEN 'France Travail' THEN 1.0::DOUBLE WHEN 'Adzuna' THEN 0.75::DOUBLE
              WHEN 'Jooble' THEN 0.75::DOUBLE WHEN 'JSearch' THEN 1.0::DOUBLE ELSE 0.8::DOUBLE END AS data_quality_score,
         CAST({NOW} AS DATE) AS ingestion_date,
         lower(title) AS l_title, lower(description) AS l_desc, lower(company_name) AS l_company,
         lower(title) || lower(description) AS l_both
  FROM amounts)""",
]

RULE_SQL = {
    "score_junior": points((f"is_junior OR {found('l_title', r'\b(junior|débutant)\b')}", 30)),
    "score_seniority": points(
        (found("l_title", r"\b(directeur|principal)\b"), -100),
        (found("l_title", r"\b(lead)\b"), -50),
        (found("l_title", r"\b(senior|expert|confirmé|experimenté)\b"), -40),
        (phrases("l_desc", "expérience significative", "solide expérience", "expérience confirmée",
                 "plusieurs années d'expérience"), -15),
    ),
    "score_veto_intern": points((
        found("l_title", r"\b(stage|internship|alternance|apprentissage)\b")
        + f" OR ({found('l_desc', r'\bgratification\b')} AND {found('l_desc', r'\bstagiaire\b')})", -100,
    )),
    "score_years": points(("exp_min_required > 5", -50), ("exp_min_required > 2", -20)),
    "score_ethics": points(
        (found("l_company", r"\b(banque|finance|assurance|mutuelle|comptable)\b"), -15),
        (
            found("l_both", r"\b(banque|finance|mutuelle)\b")
            + f" OR {found('l_desc', r'\bcomptable\b')}"
            + f" OR ({found('l_desc', r'\bassurance\b')}"
            + f" AND NOT {found('l_desc', r"\bassurance\s+(de|que|d'être|d'avoir)\b")})"
            + f" OR ({found('l_desc', r'\bdéfense\b')}"
            + f" AND NOT {found('l_desc', r'(quartier|paris|situé à|siège à)\s+la\s+défense')})", -15,
        ),
        (found("l_both", r"\b(armement|missile|defense|militaire)\b"), -60),
        default=5,
    ),
    "score_impact": points(
        (phrases("l_desc", "b corp", "b-corp", "société à mission", "économie sociale"), 30),
        (phrases("l_desc", "décarbonation", "écologie", "climat"), 15),
    ),
    "score_training": points((
        phrases("l_desc", "budget formation", "mentorat", "pairing", "pair programming")
        + " AND NOT "
        + found("l_desc", r"(encadrer|coacher|former|management|pilotage|accompagnement d[ee]s?)\s+juniors?"), 15,
    )),
    "score_os": points((phrases("l_desc", "open source", "contribution", "contributeur"), 20)),
    "score_status": points(("l_desc LIKE '%technicien%'", -15)),
    "score_remote": points(("is_remote", 15)),
    "score_freshness": points((f"date_sub('day', published_at, {NOW}) <= 2", 10)),
    "p_tech_skills": " + ".join((
        points(("list_contains(extracted_skills, 'python')", 15)),
        points(("list_contains(extracted_skills, 'dbt') AND list_contains(extracted_skills, 'spark')", 15)),
        points((
            "list_contains(extracted_skills, 'dbt') AND "
            + phrases("array_to_string(extracted_skills, ',')", "snowflake", "bigquery", "airflow"), 15)),
        points(("list_contains(extracted_skills, 'aws') OR list_contains(extracted_skills, 'S3')"
                " OR list_contains(extracted_skills, 'Lambda')", 12)),
    )),
}
RULE_COLUMNS = ",\n         ".join(f"{sql} AS {name}" for name, sql in RULE_SQL.items())

SHOW_POSITIVE = ", ".join(f"CASE WHEN {c} THEN '{label}' END" for c, label in (
    ("score_junior > 0 AND score_seniority >= 0", "🌱 Junior Friendly"),
    ("score_impact > 0", "🌍 Impact Positif"),
    ("score_training > 0 AND score_seniority >= 0", "🎓 Mentorat/Formation"),
    ("score_os > 0", "💻 Open Source"),
    ("score_remote > 0", "🏠 Télétravail"),
    ("p_tech_skills > 40", "🚀 Stack intéressante"),
))
SHOW_NEGATIVE = ", ".join(f"CASE WHEN {c} THEN '{label}' END" for c, label in (
    ("score_veto_intern < 0", "🚫 Stage/Alternance"),
    ("score_seniority <= -50", "⚠️ Offre pour séniors"),
    ("score_seniority BETWEEN -49 AND -15", "⚖️ Expérience requise"),
    ("score_ethics < 0", "🏦 Secteur Sensible"),
    ("score_years < 0", "⏳ > 2 ans exp."),
))
COSINE = """list_dot_product(e.embedding::DOUBLE[], p.v) /
            (sqrt(list_dot_product(e.embedding::DOUBLE[], e.embedding::DOUBLE[])) * sqrt(list_dot_product(p.v, p.v)))"""
PROFILE = "(SELECT embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = 0) p"

CHAIN += [
    f"ruled AS (SELECT *, {RULE_COLUMNS} FROM featured)",
    f"""totalled AS (
  SELECT *, CAST(20 + {' + '.join(RULE_SQL)} AS INTEGER) AS raw_rule_score,
         concat_ws(' | ', {SHOW_POSITIVE}) AS positive_labels,
         concat_ws(' | ', {SHOW_NEGATIVE}) AS negative_labels
  FROM ruled)""",
    f"""cosines AS (
  SELECT e.vec_id, {COSINE} AS cosine FROM embeddings e, {PROFILE} WHERE len(e.embedding) = {DIM})""",
    """silver AS (
  SELECT t.*, c.cosine FROM totalled t JOIN cosines c USING (vec_id)
  WHERE doc_id IN (SELECT doc_id FROM by_fingerprint))""",
    """by_url AS (
  SELECT * FROM silver QUALIFY row_number() OVER (
    PARTITION BY coalesce(url, job_id)
    ORDER BY published_at DESC NULLS LAST, source_name ASC NULLS LAST, job_id ASC NULLS LAST) = 1)""",
    """clamped AS (
  SELECT *, coalesce(cosine * 100, 0) AS raw_nlp_score,
         least(greatest(raw_rule_score, 0), 100) AS rules_score,
         least(greatest(coalesce(cosine * 100, 0), 0), 100) AS nlp
  FROM by_url)""",
    """gold AS (
  SELECT *, round(nlp) AS semantic_score,
         round((rules_score::DOUBLE * 0.5::DOUBLE + nlp * 0.5::DOUBLE) * data_quality_score) AS matching_score
  FROM clamped)""",
    f"""ranked AS (
  SELECT title, company_name, location_clean AS city, salary_min_numeric AS salary_min,
         array_to_string(extracted_skills, ',') AS skills, extracted_skills,
         trim(description, {BLANKS}) AS description, published_at,
         matching_score, semantic_score, rules_score, positive_labels, negative_labels,
         url AS original_url, source_name AS platform, ingestion_date
  FROM gold WHERE matching_score >= 40)""",
    f"""shown AS (
  SELECT * EXCLUDE (extracted_skills) REPLACE (
           strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at,
           CAST(ingestion_date AS VARCHAR) AS ingestion_date)
  FROM ranked)""",
    """displayed AS (
  SELECT * REPLACE (
           CAST(coalesce(matching_score, 0) AS INTEGER) AS matching_score,
           CAST(coalesce(semantic_score, 0) AS INTEGER) AS semantic_score,
           CAST(coalesce(rules_score, 0) AS INTEGER) AS rules_score,
           CAST(coalesce(salary_min, 0) AS INTEGER) AS salary_min,
           coalesce(original_url, '') AS original_url,
           array_to_string(extracted_skills, ', ') AS skills)
  FROM ranked)""",
]
PRELUDE = "WITH " + ",\n".join(part.strip() for part in CHAIN) + "\n"

# All batches together, repeated rows twice.
BATCHES = """, came AS (
  SELECT * REPLACE (CASE WHEN doc_id % 17 <> 0 THEN job_id END AS job_id)
  FROM printed, (VALUES (1), (2)) AS copies(copy)
  WHERE copy = 1 OR doc_id % 3 < 2 AND doc_id % 5 = 0 AND doc_id % 17 <> 0)
"""

PAGES = f"""WITH raw AS ({RAW_PAGES_SQL}),
shaped AS (
  SELECT *, CASE source WHEN 'adzuna' THEN 'results' WHEN 'france_travail' THEN 'resultats'
                        WHEN 'jooble' THEN 'jobs' ELSE 'data' END AS key,
         CASE source WHEN 'adzuna' THEN 'count' WHEN 'france_travail' THEN 'nbResultats'
                     WHEN 'jooble' THEN 'totalCount' END AS total_key
  FROM raw),
parsed AS (
  SELECT *, json_valid(payload) AS is_json,
         CASE WHEN json_valid(payload) THEN json_extract(payload, '$.' || key) END AS listed,
         CASE WHEN json_valid(payload) AND total_key IS NOT NULL
              THEN TRY_CAST(json_extract_string(payload, '$.' || total_key) AS BIGINT) END AS total
  FROM shaped),
judged AS (
  SELECT *, CASE WHEN NOT is_json THEN 'not a JSON object'
                 WHEN listed IS NOT NULL AND json_type(listed) <> 'ARRAY' THEN 'results is not a list' END AS problem,
         CASE WHEN listed IS NULL OR json_type(listed) <> 'ARRAY' THEN []
              WHEN source = 'jsearch' THEN json_extract_string(listed, '$[*].job_id')
              ELSE json_extract_string(listed, '$[*].id') END AS id_list
  FROM parsed),
good AS (
  SELECT *, CASE WHEN total IS NOT NULL THEN total
                 WHEN source IN ('adzuna', 'france_travail') THEN 0
                 ELSE len(id_list) END AS n
  FROM judged WHERE problem IS NULL)
"""

STORED = """job_id, source_name, url, data_quality_score, title, company_name, description,
  salary_min_numeric, is_junior, is_senior, is_red_flag, is_ethical, is_remote,
  strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at,
  array_to_string(extracted_skills, ',') AS extracted_skills,
  round(exp_min_required, 6) AS exp_min_required,
  64 AS dim, CAST(ingestion_date AS VARCHAR) AS ingestion_date"""

CREATED = "nullif(created_at, 'n/a')"
STAGED = {
    "Adzuna": f"""SELECT job_id, title, company_name, description, location,
        CAST(try_cast(salary_info AS DOUBLE) AS VARCHAR) AS salary_info, {CREATED} AS created_at, url, source_name
        FROM postings WHERE source_name = 'Adzuna'""",
    "France Travail": f"""SELECT job_id, title, coalesce(company_name, 'Non renseigné') AS company_name, description,
        location, CASE WHEN salary_info IS NOT NULL
                       THEN CAST(json_object('libelle', salary_info, 'minimum', 38000, 'autre', '45k') AS VARCHAR) END AS salary_info,
        {CREATED} AS created_at, url, source_name
        FROM postings WHERE source_name = 'France Travail'""",
    "JSearch": f"""SELECT job_id, title, company_name, description, concat_ws(', ', location, 'FR') AS location,
        CAST(NULL AS VARCHAR) AS salary_info, {CREATED} AS created_at, url, source_name
        FROM postings WHERE source_name = 'JSearch'""",
    "Jooble": f"""SELECT job_id, title, company_name, description, location, salary_info,
        {CREATED} AS created_at, url, source_name FROM postings WHERE source_name = 'Jooble'""",
}


def embedded(source: str, key: str, text: str) -> str:
    """Signed word counts per bucket, scaled to length 1, from ``source``."""
    return f"""words AS (
  SELECT {key} AS k, unnest(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+')) AS w FROM {source}),
crc_table AS (
  SELECT list(crc ORDER BY n) AS steps FROM (
    SELECT n, list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n) AS crc
    FROM range(256) t(n))),
word_bytes AS (
  SELECT w, list_transform(range(1, strlen(w) + 1), lambda i: CAST('0x' || substr(hex(w), 2 * i - 1, 2) AS BIGINT)) AS bs
  FROM (SELECT DISTINCT w FROM words)),
word_crcs AS (
  SELECT w, xor(list_reduce(bs, lambda c, b: xor(c // 256, steps[xor(c % 256, b) + 1]), 4294967295), 4294967295) AS h
  FROM word_bytes, crc_table),
hashed AS (SELECT k, h FROM words JOIN word_crcs USING (w)),
counts AS (SELECT k, (h // 2) % {DIM} AS bucket, CAST(sum(1 - 2 * (h % 2)) AS DOUBLE) AS c FROM hashed GROUP BY ALL),
weights AS (
  SELECT k, bucket, CAST(CAST(c / sqrt(sum(c * c) OVER (PARTITION BY k)) AS FLOAT) AS DOUBLE) AS weight
  FROM counts WHERE c <> 0)"""


def labels_cut(column: str, count: int) -> str:
    return f"array_to_string(list_slice(string_split({column}, ' | '), 1, {count}), ',')"


def band(column: str) -> str:
    return (f"CASE WHEN {column} >= 80 THEN '🟢' WHEN {column} >= 60 THEN '🟡' ELSE '🔴' END"
            f" || ' ' || {column} || '%' AS {column.replace('_score', '_visual')}")


VISUALS = ", ".join(band(c).rpartition(" AS ")[0] for c in ("matching_score", "semantic_score", "rules_score"))
VISUALS_TEXT = f"concat_ws(chr(31), {VISUALS})"


def euros(column: str) -> str:
    return f"CASE WHEN {column} > 0 THEN replace(format('{{:,}}', {column}), ',', ' ') || ' €' ELSE 'N/A' END"


def check(name: str, column: str, severity: str, failing: str, source: str) -> str:
    return (f"SELECT '{name}' AS \"check\", '{column}' AS \"column\", '{severity}' AS severity,"
            f" count(*) FILTER (WHERE {failing}) AS failing FROM {source}")


BEST_FIRST = """ORDER BY matching_score DESC NULLS LAST, published_at DESC NULLS LAST, platform NULLS LAST,
  original_url NULLS LAST, title NULLS LAST, company_name NULLS LAST, city NULLS LAST, md5(description) NULLS LAST"""


def rule_select(*names: str) -> str:
    return PRELUDE + f"SELECT doc_id, {', '.join(names)} FROM ruled"


SOURCE_LIST = "('Adzuna', 'France Travail', 'Jooble', 'JSearch')"

ORACLES = {
    "stage_adzuna": PRELUDE + STAGED["Adzuna"],
    "stage_france_travail": PRELUDE + STAGED["France Travail"],
    "stage_jsearch": PRELUDE + STAGED["JSearch"],
    "stage_jooble": PRELUDE + STAGED["Jooble"],
    "union_sources": PRELUDE + " UNION ALL ".join(STAGED.values()),
    "source_counts": PRELUDE + "SELECT source_name, count(*) AS postings FROM postings GROUP BY 1",
    "envelope_normalize": PAGES + """SELECT block, source, keyword, run, page, CAST(n AS BIGINT) AS count,
        coalesce(array_to_string(id_list, ','), '') AS ids FROM good""",
    "payload_quarantine": PAGES + "SELECT block, source, page, problem FROM judged WHERE problem IS NOT NULL",
    "assemble_pages": PAGES + """, placed AS (
  SELECT *, row_number() OVER (PARTITION BY source, keyword, run ORDER BY page) AS place,
         max(CASE WHEN page = 1 THEN CAST(n AS BIGINT) END) OVER (PARTITION BY source, keyword, run) AS total_of_run
  FROM good WHERE len(id_list) > 0)
SELECT source, keyword, run, page, total_of_run AS count, array_to_string(id_list, ',') AS ids
FROM placed WHERE place = page""",
    "ingest_chain": """WITH d AS (SELECT *, (doc_id // 40) % 4 AS kind FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS job_id, CAST(NULL AS VARCHAR) AS title,
       CASE WHEN kind = 1 THEN 'Non renseigné' END AS company_name, text AS description,
       CASE WHEN kind = 3 THEN '' END AS location, CAST(NULL AS VARCHAR) AS salary_info,
       CAST(NULL AS VARCHAR) AS created_at, CAST(NULL AS VARCHAR) AS url,
       CASE kind WHEN 0 THEN 'Adzuna' WHEN 1 THEN 'France Travail' WHEN 2 THEN 'Jooble' ELSE 'JSearch' END AS source_name
FROM d""",
    "rejected_payloads": f"""SELECT
  CASE source WHEN 'adzuna' THEN 'Adzuna' WHEN 'france_travail' THEN 'France Travail'
              WHEN 'jooble' THEN 'Jooble' ELSE 'JSearch' END AS source_name,
  CASE WHEN payload = 'oops' THEN 'not a JSON object' ELSE 'fields of another kind' END AS problem, payload
FROM ({RAW_PAGES_SQL}) WHERE payload = 'oops' OR payload LIKE '%"results":"not_a_list"%'""",
    "stage_multiline": PRELUDE + " UNION ALL ".join(STAGED.values()),
    "bronze_keys": PRELUDE + """SELECT source_name, 'Data Engineer ' || ((doc_id // 200) % 5) AS keyword,
        'data_engineer_' || ((doc_id // 200) % 5) || '_000000' AS file_key, '2024-01-31T00:00:00' AS ingested_at,
        CAST(count(*) AS INTEGER) AS results FROM postings GROUP BY source_name, doc_id // 200""",
    "profile_load": """SELECT CAST(vec_id AS VARCHAR) AS profile_id, 'profile "' || label || '", of many' AS description,
        CAST(len(embedding) AS INTEGER) AS dim, round(list_sum(embedding::DOUBLE[]), 4) AS vector_sum FROM embeddings""",
    "profile_build": f"""WITH {embedded('documents', 'doc_id', 'text')}
SELECT CAST(doc_id AS VARCHAR) AS profile_id,
       md5(trim(translate(text, chr(13) || chr(10), '  '), {BLANKS})) AS description_md5,
       {DIM} AS dim, round(coalesce(a.weight, 0), 6) AS first_weight, round(coalesce(z.weight, 0), 6) AS last_weight
FROM documents d
LEFT JOIN weights a ON a.k = d.doc_id AND a.bucket = 0
LEFT JOIN weights z ON z.k = d.doc_id AND z.bucket = {DIM - 1}""",
    "silver_table": PRELUDE + f"SELECT {STORED}, location_clean FROM silver",
    "silver_staging": PRELUDE + f"SELECT {STORED}, location_clean AS job_location FROM silver",
    "run_log": f"""SELECT CAST(doc_id AS VARCHAR) AS run_id, strftime({NOW}, '%Y-%m-%d %H:%M:%S') AS run_at,
        CASE WHEN doc_id % 4 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status, source AS source_name,
        CAST(n_chars AS BIGINT) AS records_count, text AS error_message FROM documents""",
    "latest_run": """SELECT event_type AS status, CAST(ts AS VARCHAR) AS last_run,
        CAST(trunc(value) AS BIGINT) AS count
        FROM events ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC LIMIT 1""",
    "entity_clean": PRELUDE + "SELECT doc_id, replace(description, '&nbsp;', ' ') AS description FROM postings",
    "ellipsis_strip": PRELUDE + """SELECT doc_id, source_name, CASE WHEN source_name IN ('Adzuna', 'Jooble')
        THEN regexp_replace(description, '\\.\\.\\.\\s*$', '') ELSE description END AS description FROM postings""",
    "parse_published": PRELUDE + """SELECT doc_id, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at
        FROM normalised""",
    "location_clean": PRELUDE + "SELECT doc_id, location_clean FROM normalised",
    "strip_html": f"SELECT page_id, {stripped('html')} AS body FROM pages",
    "search_text": PRELUDE + "SELECT doc_id, search_text FROM searchable",
    "experience_extract": PRELUDE + "SELECT doc_id, round(exp_min_required, 6) AS exp_min_required FROM amounts",
    "skill_tags": PRELUDE + """SELECT doc_id, array_to_string(extracted_skills, ',') AS extracted_skills
        FROM measured""",
    "salary_extract": PRELUDE + "SELECT doc_id, salary_min_numeric FROM featured",
    "posting_flags": PRELUDE + """SELECT doc_id, is_junior, is_senior, is_red_flag, is_ethical, is_remote
        FROM featured""",
    "quality_weight": PRELUDE + """, named AS (
  SELECT doc_id, CASE WHEN doc_id % 5 = 4 THEN 'Elsewhere' ELSE source_name END AS source_name FROM postings)
SELECT doc_id, source_name, CAST(CASE WHEN source_name IN ('France Travail', 'JSearch') THEN 1.0
  WHEN source_name IN ('Adzuna', 'Jooble') THEN 0.75 ELSE 0.8 END AS DOUBLE) AS data_quality_score FROM named""",
    "fingerprint": PRELUDE + "SELECT doc_id, fingerprint FROM printed",
    "embed_text": PRELUDE + ", " + embedded(
        "described", "doc_id", "concat_ws(' ', title, description)"
    ) + "\nSELECT k AS doc_id, CAST(bucket AS INTEGER) AS bucket, round(weight, 6) AS weight FROM weights",
    "dedup_by_id": PRELUDE + "SELECT doc_id, job_id, source_name, md5(description) AS text FROM by_id",
    "dedup_by_fingerprint": PRELUDE + """SELECT doc_id, job_id, source_name, title, md5(description) AS text
        FROM by_fingerprint""",
    "dedup_by_url": PRELUDE + """SELECT doc_id, job_id, url, md5(description) AS text FROM normalised
  JOIN cosines USING (vec_id) QUALIFY row_number() OVER (
    PARTITION BY coalesce(url, job_id)
    ORDER BY published_at DESC NULLS LAST, source_name NULLS LAST, job_id NULLS LAST, digest, doc_id) = 1""",
    "merge_by_id": PRELUDE + BATCHES + """SELECT doc_id, job_id, source_name, md5(description) AS text FROM came
  QUALIFY job_id IS NULL OR row_number() OVER (
    PARTITION BY job_id, source_name
    ORDER BY published_at DESC NULLS LAST, url NULLS LAST, digest, doc_id) = 1""",
    "merge_by_fingerprint": PRELUDE + BATCHES + """SELECT doc_id, title, company_name, md5(description) AS text FROM came
  QUALIFY row_number() OVER (
    PARTITION BY fingerprint
    ORDER BY published_at DESC NULLS LAST, source_name NULLS LAST, job_id NULLS LAST, url NULLS LAST, digest, doc_id) = 1""",
    "merge_by_url": PRELUDE + BATCHES + """SELECT doc_id, job_id, url, md5(description) AS text FROM came
  QUALIFY coalesce(url, job_id) IS NULL OR row_number() OVER (
    PARTITION BY coalesce(url, job_id)
    ORDER BY published_at DESC NULLS LAST, source_name NULLS LAST, job_id NULLS LAST, digest, doc_id) = 1""",
    "valid_vectors": """SELECT vec_id FROM (
        SELECT vec_id, CASE WHEN vec_id % 11 = 5 THEN NULL WHEN vec_id % 7 = 3 THEN embedding[1:63]
                       ELSE embedding END AS e FROM embeddings) WHERE e IS NOT NULL AND len(e) = 64""",
    "cosine_similarity": PRELUDE + "SELECT vec_id, round(cosine, 6) AS cosine FROM cosines",
    "cosine_explode": PRELUDE + "SELECT vec_id, round(cosine, 6) AS cosine FROM cosines",
    "profile_matches": """WITH unit AS (
  SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS size
  FROM embeddings WHERE len(embedding) = 64
), pairs AS (
  SELECT p.vec_id AS profile_id, q.vec_id AS posting_id, round(list_dot_product(p.v, q.v) / (p.size * q.size), 9) AS cosine
  FROM unit p, unit q WHERE p.vec_id % 100 = 0 AND p.size > 0 AND q.size > 0
)
SELECT profile_id, rank, posting_id, round(cosine, 6) AS cosine FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY profile_id ORDER BY cosine DESC, posting_id) AS INTEGER) AS rank FROM pairs
) WHERE rank <= 10""",
    "rule_experience": rule_select("score_junior", "score_seniority", "score_veto_intern", "score_years"),
    "rule_ethics": rule_select("score_ethics", "score_impact"),
    "rule_culture": rule_select("score_training", "score_os", "score_status", "score_remote"),
    "rule_freshness": rule_select("score_freshness"),
    "rule_skills": rule_select("p_tech_skills"),
    "rule_pillars": rule_select("job_id", *RULE_SQL),
    "rule_total": PRELUDE + "SELECT doc_id, raw_rule_score FROM totalled",
    "labels": PRELUDE + "SELECT doc_id, positive_labels, negative_labels FROM totalled",
    "gold_scored": PRELUDE + """SELECT job_id, source_name, url, title, positive_labels, negative_labels,
        raw_rule_score, round(raw_nlp_score, 4) AS raw_nlp_score, rules_score, semantic_score, matching_score
        FROM gold""",
    "ranking_view": PRELUDE + "SELECT * FROM shown ORDER BY matching_score DESC, ingestion_date DESC",
    "top_n": PRELUDE + f"SELECT * FROM shown {BEST_FIRST} LIMIT 200",
    "search_filter": PRELUDE + """SELECT title, platform, original_url, matching_score FROM ranked
        WHERE matching_score >= 45""",
    "fresh_only": PRELUDE + f"""SELECT title, platform, original_url,
        strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at FROM ranked
        WHERE published_at >= {NOW} - INTERVAL 24 HOURS""",
    "search_any_column": PRELUDE + "SELECT * FROM shown WHERE " + " OR ".join(
        f"coalesce(regexp_matches(CAST({c} AS VARCHAR), '(?i)SNOWFLAKE|B.corp|confirmÉ'), false)"
        for c in ("title", "company_name", "city", "salary_min", "skills", "description", "published_at",
                  "matching_score", "semantic_score", "rules_score", "positive_labels", "negative_labels",
                  "original_url", "platform", "ingestion_date")
    ),
    "display_clean": PRELUDE + f"""SELECT * EXCLUDE (extracted_skills) REPLACE (
        strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at,
        strftime(CAST(ingestion_date AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS ingestion_date),
        {euros('salary_min')} AS salary_visual FROM displayed""",
    "score_bands": PRELUDE + f"""SELECT title, platform, original_url, {band('matching_score')},
        {band('semantic_score')}, {band('rules_score')} FROM displayed""",
    "top_3": PRELUDE + f"""SELECT title, platform, matching_score,
        published_at >= {NOW} - INTERVAL 24 HOURS AS is_new,
        CASE WHEN length(title) > 45 THEN left(title, 45) || '...' ELSE title END AS title_short,
        {labels_cut('positive_labels', 2)} AS top_positive, {labels_cut('negative_labels', 1)} AS top_negative
        FROM ranked {BEST_FIRST} LIMIT 3""",
    "filtered_top_3": PRELUDE + f""", filtered AS (
  SELECT title, company_name, platform, published_at, original_url, city, description,
         matching_score, {euros('salary_min')} AS salary_visual, {band('matching_score')},
         concat_ws(chr(31), title, company_name, city, salary_min, skills, description,
           strftime(published_at, '%Y-%m-%d %H:%M:%S'), matching_score, semantic_score, rules_score, positive_labels,
           negative_labels, original_url, platform, ingestion_date, {euros('salary_min')}, {VISUALS}) AS displayed
  FROM displayed WHERE matching_score >= 40 AND published_at >= {NOW} - INTERVAL 24 HOURS)
SELECT title, platform, matching_score, matching_visual, salary_visual, true AS is_new FROM filtered
WHERE regexp_matches(displayed, '(?i)n/a|junior') {BEST_FIRST} LIMIT 3""",
    "search_displayed": PRELUDE + f"""SELECT title, platform, original_url, {band('matching_score')},
        {euros('salary_min')} AS salary_visual FROM displayed WHERE matching_score >= 30 AND (
          {euros('salary_min')} = 'N/A' OR lower(coalesce(title, '')) = 'n/a' OR lower(coalesce(description, '')) = 'n/a'
          OR contains({VISUALS_TEXT}, '🟡 6'))""",
    "kpi_summary": PRELUDE + f"""SELECT count(*) AS postings,
        count(*) FILTER (WHERE published_at >= {NOW} - INTERVAL 24 HOURS) AS new_postings,
        CAST(trunc(avg(CAST(matching_score AS INTEGER))) AS INTEGER) AS avg_matching_score FROM ranked""",
    "kpi_avg_salary": PRELUDE + f""", mean AS (
  SELECT CAST(trunc(avg(salary_min) FILTER (WHERE salary_min > 0)) AS INTEGER) AS avg_salary FROM ranked)
SELECT avg_salary, {euros('avg_salary')} AS avg_salary_text FROM mean""",
    "dq_not_null": PRELUDE + " UNION ALL ".join(
        check("not_null", c, s, f"{c} IS NULL", "postings")
        for c, s in (("job_id", "error"), ("title", "warn"), ("company_name", "warn"), ("url", "warn"),
                     ("location", "warn"))
    ),
    "dq_unique": PRELUDE + "SELECT job_id, count(*) AS rows FROM postings GROUP BY 1 HAVING count(*) > 1",
    "dq_accepted_values": check(
        "accepted_values", "source_name", "error",
        f"(CASE WHEN doc_id % 3 = 0 THEN 'Jooble' ELSE source END) NOT IN {SOURCE_LIST}", "documents"),
    "dq_ranges": " UNION ALL ".join((
        check("range", "value", "error", "value < 0 OR value > 30", "events"),
        check("range", "quality", "error", "quality < 0 OR quality > 1", "labels"),
        check("range", "toxic", "error", "toxic < 0 OR toxic > 0", "labels"),
    )),
    "dq_blank": PRELUDE + check(
        "not_blank", "url", "warn", "url IS NULL OR (doc_id // 4) % 9 = 2", "postings"),
    "dq_failing_rows": f"""WITH rows AS (
  SELECT doc_id, company_name, vec_id, CASE WHEN doc_id % 23 = 4 THEN 'Elsewhere' ELSE source_name END AS source_name,
         CASE WHEN doc_id % 19 <> 3 THEN job_id END AS job_id, CASE WHEN (doc_id // 4) % 9 = 2 THEN '  ' ELSE url END AS url
  FROM ({POSTINGS_SQL})
), marked AS (
  SELECT doc_id,
         CASE WHEN job_id IS NULL THEN 'not_null(job_id)' END AS e1,
         CASE WHEN company_name IS NULL THEN 'not_null(company_name)' END AS w1,
         CASE WHEN source_name NOT IN {SOURCE_LIST} THEN 'accepted_values(source_name)' END AS e2,
         CASE WHEN url IS NULL OR trim(url) = '' THEN 'not_blank(url)' END AS w2,
         CASE WHEN vec_id NOT BETWEEN 0 AND 400 THEN 'range(vec_id)' END AS w3,
         CASE WHEN job_id IS NOT NULL AND count(*) OVER (PARTITION BY job_id) > 1 THEN 'unique(job_id)' END AS e3
  FROM rows
)
SELECT doc_id, concat_ws(',', e1, w1, e2, w2, w3, e3) AS failed, concat_ws(',', e1, e2, e3) AS errors
FROM marked WHERE concat_ws(',', e1, w1, e2, w2, w3, e3) <> ''""",
    "dq_silver": PRELUDE + " UNION ALL ".join([
        *[check("not_null", c, s, f"{c} IS NULL", "silver") for c, s in (
            ("job_id", "error"), ("published_at", "error"), ("title", "warn"), ("company_name", "warn"), ("url", "warn"))],
        check("accepted_values", "source_name", "error", f"source_name NOT IN {SOURCE_LIST}", "silver"),
        check("unique", "job_id", "error", "true",
              "(SELECT job_id FROM silver WHERE job_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"),
    ]),
    "dq_staging": PRELUDE + " UNION ALL ".join([
        *[check("not_null", c, s, f"{c} IS NULL", "silver") for c, s in (
            ("job_id", "error"), ("title", "warn"), ("company_name", "warn"), ("url", "warn"), ("description", "warn"),
            ("published_at", "error"), ("ingestion_date", "error"))],
        check("accepted_values", "source_name", "error", f"source_name NOT IN {SOURCE_LIST}", "silver"),
        check("unique", "job_id", "error", "true",
              "(SELECT job_id FROM silver WHERE job_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"),
    ]),
    "dq_ranking": PRELUDE + " UNION ALL ".join([
        *[check("not_null", c, s, f"{c} IS NULL", "ranked") for c, s in (
            ("title", "warn"), ("company_name", "warn"), ("matching_score", "error"), ("published_at", "error"),
            ("ingestion_date", "error"))],
        check("accepted_values", "platform", "error", f"platform NOT IN {SOURCE_LIST}", "ranked"),
    ]),
    "dq_report": PRELUDE + " UNION ALL ".join([
        *[check("not_null", c, s, f"{c} IS NULL", "gold") for c, s in (
            ("job_id", "error"), ("matching_score", "error"), ("title", "warn"), ("url", "warn"),
            ("published_at", "error"), ("data_quality_score", "error"), ("ingestion_date", "error"))],
        check("accepted_values", "source_name", "error", f"source_name NOT IN {SOURCE_LIST}", "gold"),
        *[check("range", c, "error", f"{c} < 0 OR {c} > {top}", "gold") for c, top in (
            ("matching_score", 100), ("rules_score", 100), ("semantic_score", 100), ("data_quality_score", 1))],
        check("not_blank", "url", "warn", "url IS NULL OR trim(url, ' ') = ''", "gold"),
        check("unique", "job_id", "error", "true",
              "(SELECT job_id FROM gold WHERE job_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"),
    ]),
}
