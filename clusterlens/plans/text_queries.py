"""Registered log, file, script and document queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scripts import PARALLEL_PATTERNS
from ..operators import docs as D
from ..operators import files as Fi
from ..operators import logs as L
from ..sources.fixtures import METRICS_AS_OF, READ_ROOTS, Tables
from .oracle_fixtures import with_fixtures as W
from .registry import query


@query("tail_lines", W("""
WITH c AS (SELECT path, count(*) AS n_lines FROM log_lines GROUP BY path)
SELECT path, lineno, line, from_end, n_lines FROM (
  SELECT *, row_number() OVER (PARTITION BY path ORDER BY lineno DESC) AS from_end FROM log_lines) JOIN c USING (path)
WHERE from_end <= 100""", "log_lines"))
def q_tail_lines(spark, sf_dir):
    """Last 100 lines of every log file, with each file's line count."""
    return L.tail_lines(Tables(spark, sf_dir).log_lines, 100)


@query("grep_lines", W("""
WITH l AS (SELECT path, lineno, line FROM log_lines),
h AS (SELECT path, lineno FROM l WHERE regexp_matches(line, '(?i)the')),
k AS (SELECT path, lineno FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY lineno) AS r FROM h) WHERE r <= 50),
w AS (SELECT path, lineno + d AS lineno, max(CASE WHEN d = 0 THEN 1 ELSE 0 END) AS is_match
      FROM k CROSS JOIN (SELECT unnest(range(-1, 2)) AS d) GROUP BY ALL),
c AS (SELECT path, count(*) FILTER (WHERE regexp_matches(line, '(?i)the')) AS n_matches FROM l GROUP BY path)
SELECT w.path, w.lineno, substr(l.line, 1, 2000) AS line, CASE WHEN is_match = 1 THEN 'match' ELSE 'context' END AS kind, c.n_matches, 'ok' AS status
FROM w JOIN l USING (path, lineno) JOIN c USING (path)
UNION ALL
SELECT path, NULL, NULL, NULL, n_matches, 'no_match' FROM c WHERE n_matches = 0""", "log_lines"))
def q_grep_lines(spark, sf_dir):
    """Lines matching /the/i in every log file, ±1 line of context, first 50 matches per file, exact counts."""
    return L.grep_lines(Tables(spark, sf_dir).log_lines, "the", context=1, max_matches=50)


_RESOLVE = """replace(replace(replace(replace(replace(replace(replace(replace(raw, '%%', chr(0)),
    '%j', split_part(split_part(job_id, '_', 1), '.', 1)), '%J', split_part(split_part(job_id, '_', 1), '.', 1)),
    '%A', split_part(split_part(job_id, '_', 1), '.', 1)), '%x', coalesce(nullif(job_name, ''), 'job')),
    '%u', coalesce(user_name, '')), '%a', CASE WHEN contains(job_id, '_') THEN string_split(job_id, '_')[-1] ELSE '0' END), chr(0), '%')"""


def log_tail_ctes(jobs_src: str, n: int) -> str:
    """CTE chain (names ``lt_*``) ending in ``lt_out(job_id, label, path, lineno, line, from_end, status)``."""
    return f"""lt_p AS (
  SELECT job_id, job_name, user_name, work_dir, 0 AS ord, 'StdErr' AS label, stderr AS raw FROM {jobs_src}
  UNION ALL SELECT job_id, job_name, user_name, work_dir, 1, 'StdOut', stdout FROM {jobs_src}),
lt_u AS (SELECT job_id, ord, label, work_dir, {_RESOLVE} AS r FROM lt_p WHERE raw IS NOT NULL AND raw != '' AND raw != '/dev/null'),
lt_u2 AS (SELECT job_id, ord, label, CASE WHEN NOT starts_with(r, '/') AND coalesce(work_dir, '') != ''
                                     THEN concat(regexp_replace(work_dir, '/+$', ''), '/', r) ELSE r END AS path FROM lt_u),
lt_fp AS (SELECT job_id, path, arg_min(label, ord) AS label FROM lt_u2 GROUP BY job_id, path),
lt_wanted AS (SELECT DISTINCT path FROM lt_fp),
lt_found AS (SELECT DISTINCT path FROM log_lines WHERE path IN (SELECT path FROM lt_wanted)),
lt_t AS (SELECT * FROM (SELECT path, lineno, line, row_number() OVER (PARTITION BY path ORDER BY lineno DESC) AS from_end
                     FROM log_lines WHERE path IN (SELECT path FROM lt_wanted)) WHERE from_end <= {n}),
lt_out AS (
SELECT lt_fp.job_id, lt_fp.label, lt_fp.path, lt_t.lineno, lt_t.line, lt_t.from_end, 'ok' AS status FROM lt_fp JOIN lt_t USING (path)
UNION ALL
SELECT job_id, label, path, NULL, NULL, NULL, 'file_not_found' FROM lt_fp WHERE path NOT IN (SELECT path FROM lt_found)
UNION ALL
SELECT job_id, NULL, NULL, NULL, NULL, NULL,
       CASE WHEN coalesce(stdout, '') = '' AND coalesce(stderr, '') = '' THEN 'no_paths' ELSE 'no_usable_file' END
FROM {jobs_src} WHERE job_id NOT IN (SELECT job_id FROM lt_fp))"""


@query("job_log_tail", W("WITH " + log_tail_ctes("jobs", 100) + "\nSELECT * FROM lt_out", "jobs", "log_lines"))
def q_job_log_tail(spark, sf_dir):
    """Last 100 lines of the StdErr then StdOut file of every job (patterns resolved, each file once)."""
    t = Tables(spark, sf_dir)
    return L.job_log_tail(t.jobs, t.log_lines, 100)


def _distinct_ordered(expr: str) -> str:
    # first occurrence order: keep element i when it does not appear before i
    return (f"list_filter({expr}, lambda x, i: list_position({expr}, x) = i)")


_PATHS = _distinct_ordered(r"""list_transform(regexp_extract_all(script, '(^|[^A-Za-z0-9_-])(/work/[^\s''"()|;<>,=]+)', 2), lambda p: rtrim(p, '.,:'))""")


@query("file_status", W(f"""
WITH req AS (SELECT DISTINCT unnest({_PATHS}) AS requested FROM scripts),
d AS (SELECT DISTINCT path AS parent_path FROM files WHERE kind = 'd')
SELECT r.requested, r.requested AS path, f.kind, f.size, f.owner, f.mtime,
       CASE WHEN f.kind IS NOT NULL THEN 'ok' WHEN d.parent_path IS NOT NULL THEN 'absent_parent_exists' ELSE 'absent_parent_missing' END AS status
FROM req r LEFT JOIN files f ON f.path = r.requested
LEFT JOIN d ON d.parent_path = regexp_extract(r.requested, '^(.*)/[^/]*$', 1)""", "scripts", "files"))
def q_file_status(spark, sf_dir):
    """Status of every path named in a batch script (present, or absent with the parent's state)."""
    t = Tables(spark, sf_dir)
    paths = t.scripts.select(F.explode(Fi.S.script_paths("script", READ_ROOTS, None)).alias("path")).distinct()
    return Fi.file_status(paths, t.files, READ_ROOTS)


@query("dir_listing", W("""
WITH e AS (SELECT parent, name, kind, CASE WHEN kind = 'd' THEN NULL ELSE size END AS size, mtime, owner FROM files),
t AS (SELECT parent, count(*) AS n_entries FROM e GROUP BY parent)
SELECT *, 'ok' AS status FROM (SELECT *, row_number() OVER (PARTITION BY parent ORDER BY mtime DESC, name) AS rank FROM e) JOIN t USING (parent)
WHERE rank <= 10""", "files"))
def q_dir_listing(spark, sf_dir):
    """Ten most recently modified entries of every directory, with entry totals."""
    return Fi.dir_listing(Tables(spark, sf_dir).files, sort="mtime", top=10)


_MECH = "concat_ws(',', " + ", ".join(
    f"CASE WHEN regexp_matches(coalesce(script, ''), '(?i)' || '{rx.replace(chr(39), chr(39) * 2)}') THEN '{label}' END"
    for label, rx in PARALLEL_PATTERNS) + ")"
_MODULES = r"""flatten(list_transform(regexp_extract_all(script, '(?m)^\s*module\s+(?:load|add)\s+(.+)$', 1),
    lambda ln: list_filter(regexp_split_to_array(trim(ln), '\s+'), lambda t: t != '' AND NOT starts_with(t, '-'))))"""


@query("tail_lines_requested", W("""
WITH w AS (SELECT DISTINCT path FROM (SELECT path FROM files UNION ALL SELECT path FROM log_lines UNION ALL SELECT concat('/work/logs/none', r_regionkey, '.log') FROM region)),
n AS (SELECT path, count(*) AS n_lines FROM log_lines GROUP BY path),
k AS (SELECT path, max(kind) AS kind FROM files GROUP BY path),
t AS (SELECT path, lineno, line, row_number() OVER (PARTITION BY path ORDER BY lineno DESC) AS from_end FROM log_lines QUALIFY from_end <= 2)
SELECT w.path, t.lineno, t.line, t.from_end, coalesce(n.n_lines, 0) AS n_lines,
       CASE WHEN t.path IS NOT NULL THEN 'ok' WHEN k.kind = 'f' THEN 'empty' WHEN k.kind IS NOT NULL THEN 'not_a_file' ELSE 'file_not_found' END AS status
FROM w LEFT JOIN t USING (path) LEFT JOIN n USING (path) LEFT JOIN k USING (path)""", "files", "log_lines"))
def q_tail_lines_requested(spark, sf_dir):
    """Last 2 lines of every log file, file and directory of the inventory and some paths that are nowhere, with a status."""
    t = Tables(spark, sf_dir)
    nowhere = t.raw("region").select(F.concat(F.lit("/work/logs/none"), F.col("r_regionkey").cast("string"), F.lit(".log")).alias("path"))
    wanted = t.files.select("path").unionByName(t.log_lines.select("path")).unionByName(nowhere)
    return L.tail_lines(t.log_lines, 2, wanted=wanted, files=t.files)


@query("job_logs_requested", W("WITH mine AS (SELECT * FROM jobs WHERE job_id IN (SELECT job_id FROM job_requests)),\n" + log_tail_ctes("mine", 5) + """,
u AS (SELECT DISTINCT job_id FROM job_requests WHERE job_id NOT IN (SELECT job_id FROM jobs))
SELECT * FROM lt_out UNION ALL SELECT job_id, NULL, NULL, NULL, NULL, NULL,
  CASE WHEN regexp_matches(replace(replace(job_id, '_', ''), '.', ''), '^[A-Za-z0-9]+$') THEN 'unknown_key' ELSE 'invalid_key' END FROM u""", "jobs", "log_lines", "job_requests"))
def q_job_logs_requested(spark, sf_dir):
    """Last 5 lines of the files of every requested job, with a status for jobs that are unknown or without files."""
    t = Tables(spark, sf_dir)
    return L.job_log_tail(t.jobs, t.log_lines, 5, ids=t.job_requests)


@query("script_facts", W(f"""
SELECT j.job_id, length(s.script) AS script_chars, array_to_string({_MODULES}, ',') AS modules,
       array_to_string({_PATHS}[1:8], ',') AS paths, CASE WHEN s.script IS NULL THEN -1 ELSE len({_PATHS}) END AS n_paths, {_MECH} AS mechanisms,
       CASE WHEN coalesce(j.batch_flag, 1) = 0 THEN 'interactive' WHEN s.script IS NULL THEN 'unavailable' ELSE 'ok' END AS status
FROM jobs j LEFT JOIN scripts s USING (job_id)""", "jobs", "scripts"))
def q_script_facts(spark, sf_dir):
    """Modules, referenced paths and parallelism found in the script of every job."""
    t = Tables(spark, sf_dir)
    df = Fi.script_facts(t.jobs, t.scripts, READ_ROOTS)
    return df.select("job_id", "script_chars", F.array_join("modules", ",").alias("modules"), F.array_join("paths", ",").alias("paths"), "n_paths",
                     F.array_join("mechanisms", ",").alias("mechanisms"), "status")


@query("join_file_check", W(f"""
WITH p AS (SELECT job_id, unnest({_PATHS}) AS path, unnest(range(1, len({_PATHS}) + 1)) AS pos FROM scripts)
SELECT p.job_id, p.pos, p.path, CASE WHEN f.kind IS NULL THEN 'ABSENT' ELSE 'OK' END AS "check",
       CASE WHEN f.kind = 'd' THEN 'dir' ELSE CAST(f.size AS VARCHAR) END AS detail
FROM p LEFT JOIN files f USING (path) WHERE p.pos <= 5""", "scripts", "files"))
def q_join_file_check(spark, sf_dir):
    """OK / ABSENT check of the first 5 paths named in every script."""
    t = Tables(spark, sf_dir)
    return Fi.file_check(t.scripts, t.files, READ_ROOTS, 5)


_DOC_JSON = "to_json(struct_pack(idx := idx, doc_id := doc_id, level := level, host := host, event_type := event_type, message := message, value := value, props := props))::VARCHAR"


def _line(n: int) -> str:
    return f"substr(coalesce(nullif(trim(message), ''), {_DOC_JSON}), 1, {n})"


@query("doc_search", W(f"""
WITH m AS (SELECT * FROM docs WHERE level = 'ERROR')
SELECT idx, doc_id, ts, {_line(300)} AS line, row_number() OVER (ORDER BY value DESC NULLS LAST, doc_id) AS rank,
       (SELECT count(*) FROM m) AS total, 'ok' AS status
FROM m QUALIFY rank <= 10""", "docs"))
def q_doc_search(spark, sf_dir):
    """ERROR documents: exact total and the 10 with the highest value."""
    return D.doc_search(Tables(spark, sf_dir).docs, "level = 'ERROR'", top=10, sort_field="value")


@query("terms_agg", W("""
WITH m AS (SELECT * FROM docs WHERE level = 'ERROR'),
b AS (SELECT CAST(host AS VARCHAR) AS value, count(*) AS n FROM m WHERE host IS NOT NULL GROUP BY ALL),
r AS (SELECT *, row_number() OVER (ORDER BY n DESC, value) AS rank FROM b QUALIFY rank <= 10)
SELECT value, n, rank, CAST((SELECT count(host) FROM m) - (SELECT sum(n) FROM r) AS BIGINT) AS other, (SELECT count(*) FROM m) AS total, 'ok' AS status FROM r""", "docs"))
def q_terms_agg(spark, sf_dir):
    """Top 10 hosts of ERROR documents, with the rest and the exact total."""
    return D.terms_agg(Tables(spark, sf_dir).docs, "host", "level = 'ERROR'", top=10)


@query("recent_docs", W(f"""
WITH m AS (SELECT * FROM docs WHERE ts >= TIMESTAMP '{METRICS_AS_OF}' - INTERVAL 10080 MINUTE AND level = 'ERROR')
SELECT idx, doc_id, substr(CAST(ts AS VARCHAR), 1, 19) AS ts19, {_line(260)} AS line,
       row_number() OVER (ORDER BY ts DESC, doc_id DESC) AS rank, (SELECT count(*) FROM m) AS total, 'ok' AS status
FROM m QUALIFY rank <= 50""", "docs"))
def q_recent_docs(spark, sf_dir):
    """The 50 newest ERROR documents of the last 7 days, with the exact total."""
    return D.recent_docs(Tables(spark, sf_dir).docs, METRICS_AS_OF, minutes=10080, predicate="level = 'ERROR'", top=50)


@query("index_catalog", W("""
WITH per AS (SELECT idx, count(*) AS docs,
                    sum(coalesce(strlen(idx), 0) + coalesce(strlen(level), 0) + coalesce(strlen(host), 0) + coalesce(strlen(event_type), 0)
                        + coalesce(strlen(message), 0) + coalesce(strlen(props), 0)) AS bytes,
                    regexp_matches(idx, '^(?:logs-2024-01-1.)$') AS visible
             FROM docs WHERE regexp_matches(idx, '^(?:logs-.*)$') GROUP BY idx)
SELECT idx, docs, CAST(bytes AS BIGINT) AS bytes, row_number() OVER (ORDER BY idx) AS rank,
       (SELECT count(*) FILTER (WHERE visible) FROM per) AS n_visible, (SELECT count(*) FILTER (WHERE NOT visible) FROM per) AS n_hidden, 'ok' AS status
FROM per WHERE visible QUALIFY rank <= 200""", "docs"))
def q_index_catalog(spark, sf_dir):
    """Indices matching logs-*: documents and bytes of the allowed ones, count of the hidden ones."""
    return D.index_catalog(Tables(spark, sf_dir).docs, "logs-*", allowed=["logs-2024-01-1?"])


# JSON payloads of the documents, nested, with awkward names, disagreeing types and one that is no JSON.
ATTRS = (
    '{"a:b":1,"tags":["x","y"],"when":"noon"}',
    '{"a:b":"one","items":[{"n":1,"f":0.5},{"n":2}]}',
    '{"o":{"p":{"q d":true}},"e":{},"z":null,"none":[]}',
    "not json{",
    None,
)


def _attrs(docs):
    """The documents with ``attrs``: one of ``ATTRS`` in turn, and else a payload of the document's own number."""
    own = F.concat(F.lit('{"v":'), F.col("doc_id").cast("string"), F.lit(',"nest":[[1],["s"]],"tags":[2.5]}'))
    turn = F.col("doc_id") % (len(ATTRS) + 2)
    picked = own
    for k, text in enumerate(ATTRS):
        picked = F.when(turn == k, F.lit(text)).otherwise(picked)
    return docs.withColumn("attrs", picked)


_ATTRS_SQL = ("CASE doc_id % 7 " + " ".join(f"WHEN {k} THEN {'NULL' if text is None else chr(39) + text + chr(39)}" for k, text in enumerate(ATTRS))
              + """ ELSE concat('{"v":', doc_id, ',"nest":[[1],["s"]],"tags":[2.5]}') END""")
_PLAIN = {"doc_id": "long", "ts": "date", "level": "string", "host": "string", "event_type": "string", "message": "string", "value": "double"}


def _catalog_sql(by: str) -> str:
    """``by``: 'idx' or nothing."""
    key, keys, using = (f"{by}, ", f"GROUP BY {by}", f"JOIN t USING ({by})") if by else ("", "", "CROSS JOIN t")
    plain = " UNION ALL ".join(f"SELECT {key}'{c}' AS field, '{t}' AS type, count({c}) AS n_docs FROM d {keys}" for c, t in _PLAIN.items())
    order = f"PARTITION BY {by} ORDER BY field" if by else "ORDER BY field"
    part = f"PARTITION BY {by}" if by else ""
    return f"""
WITH d AS (SELECT *, {_ATTRS_SQL} AS attrs FROM docs),
j AS (SELECT idx, doc_id, 'props' AS head, props AS text FROM d WHERE json_valid(props) UNION ALL SELECT idx, doc_id, 'attrs', attrs FROM d WHERE json_valid(attrs)),
x AS (SELECT j.idx, j.doc_id, concat(head, replace(substr(regexp_replace(fullkey, '\\[[0-9]+\\]', '', 'g'), 2), '"', '')) AS field,
        CASE WHEN type IN ('BIGINT', 'UBIGINT') THEN 'long' WHEN type = 'DOUBLE' THEN 'double' WHEN type = 'VARCHAR' THEN 'string'
             WHEN type = 'BOOLEAN' THEN 'boolean' WHEN type = 'OBJECT' THEN 'object' END AS type
      FROM j, json_tree(j.text) WHERE type NOT IN ('ARRAY', 'NULL') AND (type != 'OBJECT' OR value = '{{}}')),
f AS ({plain}
  UNION ALL SELECT {key}field, string_agg(DISTINCT type, '|' ORDER BY type), count(DISTINCT doc_id) FROM x GROUP BY {key}field),
t AS (SELECT {key}count(*) AS n_docs_total, count(*) FILTER (WHERE (props IS NOT NULL AND NOT json_valid(props)) OR (attrs IS NOT NULL AND NOT json_valid(attrs))) AS n_unreadable
      FROM d {keys})
SELECT f.*, contains(type, '|') AS conflict, row_number() OVER ({order}) AS rank, count(*) OVER ({part}) AS n_fields, n_docs_total, n_unreadable
FROM f {using} QUALIFY rank <= 200"""


@query("field_catalog", W(_catalog_sql("idx"), "docs"))
def q_field_catalog(spark, sf_dir):
    """Leaf fields and types of every index, JSON payloads included, with documents per field and type conflicts."""
    return D.field_catalog(_attrs(Tables(spark, sf_dir).docs), ["props", "attrs"])


@query("field_union", W(_catalog_sql(""), "docs"))
def q_field_union(spark, sf_dir):
    """The same over all indices together: the union of their mappings."""
    return D.field_catalog(_attrs(Tables(spark, sf_dir).docs), ["props", "attrs"], by=())


#: name → (comparison tree, the same in DuckDB).
LENIENT = {
    "number_on_text": ({"field": "level", "eq": 5}, "level = '5'"),
    "text_on_number": ({"field": "value", "gt": "abc"}, "FALSE"),
    "number_as_text": ({"field": "value", "ge": "50"}, "value >= 50"),
    "no_date": ({"field": "ts", "ge": "not a date"}, "FALSE"),
    "date_as_text": ({"field": "ts", "lt": "2024-01-10"}, "ts < TIMESTAMP '2024-01-10'"),
    "inside_json": ({"field": "props.k", "lt": 20}, "TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) < 20"),
    "unknown_field": ({"field": "nothing", "eq": 1}, "FALSE"),
    "negated": ({"not": {"field": "doc_id", "eq": "x1"}}, "TRUE"),
    "tree": ({"all": [{"field": "host", "in": ["node1", 2, "node3"]}, {"any": [{"field": "level", "like": "ERR*"}, {"field": "value", "lt": 5}]}, {"not": {"field": "message", "eq": ""}}]},
             "host IN ('node1', '2', 'node3') AND (level LIKE 'ERR%' OR value < 5) AND message != ''"),
    "exists": ({"all": [{"field": "props.k", "exists": True}, {"field": "props.none", "exists": False}]}, "json_extract_string(props, '$.k') IS NOT NULL"),
}


@query("lenient_predicate", W("\nUNION ALL ".join(
    f"SELECT idx, '{name}' AS predicate, count(*) FILTER (WHERE {sql}) AS n FROM docs GROUP BY idx" for name, (_, sql) in LENIENT.items()), "docs"))
def q_lenient_predicate(spark, sf_dir):
    """Documents of every index that match each of some comparison trees; what cannot be compared does not match."""
    docs = Tables(spark, sf_dir).docs
    counts = [F.struct(F.lit(name).alias("predicate"), F.col(name).alias("n")) for name in LENIENT]
    per = docs.groupBy("idx").agg(*[F.count_if(D.lenient(docs, tree)).alias(name) for name, (tree, _) in LENIENT.items()])
    return per.select("idx", F.explode(F.array(*counts)).alias("c")).select("idx", "c.*")


#: Requested index lists, each with the statuses it must get, over an allowlist.
SCOPES = ("logs-2024-01-0*,logs-2024-01-2*", "logs-2024-01-03,audit-2024", "logs-2024-01-0*,logs-2024-02-01", "logs-2099-*", "Logs;", "logs-2024-01-15")
SCOPE_ALLOWED = ("logs-2024-01-*", "logs-20[0-9]9-*", "logs-2024-02-*")


def _scope_sql(k: int, kind: str) -> str:
    scope = SCOPES[k]
    glob = "regexp_matches(idx, '^(?:" + "|".join(g.replace("*", ".*").replace("?", ".") for g in scope.split(",")) + ")$')"
    own = f"(SELECT * FROM docs WHERE {glob} AND level = 'ERROR')"
    refused = {1: "not_allowed", 4: "invalid_index"}.get(k)
    if refused:
        return f"SELECT {k} AS request, '{kind}' AS operator, NULL AS key, NULL AS n, NULL AS rank, 0 AS total, '{refused}' AS status"
    shown = {"search": "SELECT CAST(doc_id AS VARCHAR) AS key, NULL AS n, row_number() OVER (ORDER BY doc_id) AS rank FROM own QUALIFY rank <= 5",
             "terms": "SELECT host AS key, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, host) AS rank FROM own GROUP BY host QUALIFY rank <= 5",
             "recent": f"SELECT CAST(doc_id AS VARCHAR) AS key, NULL AS n, row_number() OVER (ORDER BY ts DESC, doc_id DESC) AS rank FROM own WHERE ts >= TIMESTAMP '{METRICS_AS_OF}' - INTERVAL 40320 MINUTE QUALIFY rank <= 5"}[kind]
    counted = "own" if kind != "recent" else f"(SELECT * FROM own WHERE ts >= TIMESTAMP '{METRICS_AS_OF}' - INTERVAL 40320 MINUTE)"
    return f"""SELECT * FROM (WITH own AS {own}, shown AS ({shown})
  SELECT {k} AS request, '{kind}' AS operator, key, n, rank, (SELECT count(*) FROM {counted}) AS total, 'ok' AS status FROM shown
  UNION ALL SELECT {k}, '{kind}', NULL, NULL, NULL, 0, CASE WHEN (SELECT count(*) FROM docs WHERE {glob}) = 0 THEN 'unknown_index' ELSE 'no_match' END
  WHERE (SELECT count(*) FROM {counted}) = 0)"""


@query("index_scope", W("SELECT request, operator, CAST(key AS VARCHAR) AS key, CAST(n AS BIGINT) AS n, CAST(rank AS BIGINT) AS rank, CAST(total AS BIGINT) AS total, status FROM (\n"
                        + "\nUNION ALL ".join(_scope_sql(k, kind) for k in range(len(SCOPES)) for kind in ("search", "terms", "recent")) + ")", "docs"))
def q_index_scope(spark, sf_dir):
    """Search, terms and recent documents of requested index lists under an allowlist, with a status where there are none."""
    docs, out = Tables(spark, sf_dir).docs, []
    error, none = {"field": "level", "eq": "ERROR"}, F.lit(None).cast("bigint").alias("n")
    for k, scope in enumerate(SCOPES):
        where = {"index": scope, "allowed": SCOPE_ALLOWED}
        found = {
            "search": D.doc_search(docs, error, 5, **where).select(F.col("doc_id").cast("string").alias("key"), none, "rank", "total", "status"),
            "terms": D.terms_agg(docs, "host", error, 5, **where).select(F.col("value").alias("key"), "n", "rank", "total", "status"),
            "recent": D.recent_docs(docs, METRICS_AS_OF, 40320, error, 5, **where).select(F.col("doc_id").cast("string").alias("key"), none, "rank", "total", "status"),
        }
        out += [df.select(F.lit(k).alias("request"), F.lit(name).alias("operator"), "*") for name, df in found.items()]
    whole = out[0]
    for df in out[1:]:
        whole = whole.unionByName(df)
    return whole
