"""DuckDB twins of the queries that SQL can express."""

MIXING = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3, 1, 2][((row_number() OVER (ORDER BY source IS NULL, source COLLATE "binary") - 1) % 3 + 1)::INT] AS weight
  FROM sized GROUP BY source),
levels(round, level) AS (
  SELECT 0, 0.0::DOUBLE
  UNION ALL
  SELECT round + 1, raised FROM (
    SELECT l.round, l.level,
      (SELECT (1.5::DOUBLE * sum(source_size)::DOUBLE
               - 2 * sum(CASE WHEN l.level * weight >= 2 * source_size THEN source_size ELSE 0 END))
              / nullif(sum(CASE WHEN l.level * weight >= 2 * source_size THEN 0 ELSE weight END), 0) FROM sources) AS raised
    FROM levels l)
  WHERE raised > level),
targets AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, (SELECT max(level) FROM levels) * weight) AS target,
         ('0x' || substr(md5('0:' || coalesce(source, 'null')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS shift
  FROM sources),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size,
      ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT, doc_id) AS rank
  FROM sized)
SELECT r.doc_id, r.size, t.source_size, t.target,
       (floor(r.rank * e + shift) - floor((r.rank - 1) * e + shift))::BIGINT * r.size AS taken
FROM ranked r
JOIN (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS e FROM targets) t
  ON r.source IS NOT DISTINCT FROM t.source
"""

_ASSIGN = (
    r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"""
    r"""[aA][pP][iI]_?[kK][eE][yY]))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)
_SECRETS = {
    "assign": (_ASSIGN, 2, 6),
    "access": ("AKIA[A-Z0-9]+", 0, 20),
    "hex": ("[0-9a-f]+", 0, 24),
    "private_key": ("-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 0),
    "github": ("gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    "slack": ("xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    "google": ("AIza[0-9A-Za-z_-]{35}", 0, 0),
    "jwt": (r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 0),
}
_MATCHES = " UNION ALL ".join(
    f"""SELECT row, {k} AS place, '{kind}' AS kind, {least} AS least,
           unnest(list_zip(range(1, len(gaps)), list_transform(whole, lambda x: len(x)),
                           list_transform(part, lambda x: len(x)), list_transform(gaps[:-2], lambda x: len(x)))) AS m
    FROM (SELECT row, regexp_extract_all(text, '{pattern}', 0) AS whole, regexp_extract_all(text, '{pattern}', {group}) AS part,
                 string_split_regex(text, '{pattern}') AS gaps FROM texts)"""
    for k, (kind, (pattern, group, least)) in enumerate(_SECRETS.items())
)
SECRETS = f"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
matches AS ({_MATCHES}),
placed AS (
  SELECT row, place, kind, m[2]::BIGINT AS size, m[3] AS given, least,
         (sum(m[4] + m[2]) OVER (PARTITION BY row, kind ORDER BY m[1]))::BIGINT AS finish FROM matches),
kept AS (SELECT row, place, kind, finish - size AS start, kind || ':' || (finish - size) || ':' || finish AS span
         FROM placed WHERE given >= least),
found AS (
  SELECT row, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS k,
         count(*) FILTER (kind = 'hex') AS h,
         string_agg(span, ',' ORDER BY start, place) FILTER (place < 3) AS base,
         string_agg(span, ',' ORDER BY start, place) AS spans
  FROM kept GROUP BY row)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(k, 0)::BIGINT AS n_access, coalesce(h, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN found USING (row)
"""

EXACT = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY text ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(text) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)
WINDOW same AS (PARTITION BY text)
"""

_TERMS = (
    """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), """
    r"""'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
)
LEXICAL = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS terms FROM documents),
items AS (SELECT row_number() OVER () AS item, item_id, {_TERMS} AS terms FROM benchmark),
totals AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM docs),
asked AS (SELECT item, term, count(*) AS times FROM (SELECT item, unnest(terms) AS term FROM items) GROUP BY ALL),
held AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM docs) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM held, totals GROUP BY term, n_docs),
norms AS (SELECT row, doc_id, 25 + (75 * len(terms)::BIGINT * n_docs) // n_terms AS m FROM docs, totals),
scored AS (
  SELECT item, row, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN norms USING (row)
  GROUP BY item, row),
ranked AS (
  SELECT item, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored JOIN docs USING (row) WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked JOIN items USING (item) WHERE rank <= 10
"""
