"""DuckDB oracle SQL for the registered queries.

Each statement runs on the pre-registered driver views and computes the
same result as ``catalog.QUERIES[name]`` by brute force (the near-duplicate
oracle is the unfiltered bag self-join; components use a recursive CTE; the
leader oracle is a sequential walk in id order).  Column names and types
follow the Spark results.
"""

from __future__ import annotations

from corpusmill.functions.text import JS_WS, PY_WS
from corpusmill.operators.sequences import SEQ_TOKEN_PATTERN
from corpusmill.operators.tokenize import CODE_TOKEN_PATTERN


def _q(s: str) -> str:
    return s.replace("'", "''")


P = _q(CODE_TOKEN_PATTERN)
SP = _q(SEQ_TOKEN_PATTERN)

FILES = """files AS (
  SELECT doc_id, 'own' || CAST(doc_id % 7 AS VARCHAR) || '_' || source || '-' || CAST(doc_id AS VARCHAR) || '.py' AS filename,
         text AS content, source AS project, lang
  FROM documents)"""

TOKS = f"""toks AS (SELECT doc_id, source AS project, regexp_extract_all(text, '{P}') AS tokens FROM documents)"""

BAG = """bag AS (
  SELECT doc_id, token, count(*) AS cnt
  FROM (SELECT doc_id, unnest(tokens) AS token FROM toks) GROUP BY doc_id, token)"""

PAIRS = """tot AS (SELECT doc_id, count(*) AS k, sum(cnt) AS n FROM bag GROUP BY doc_id HAVING sum(cnt) >= 20),
b AS (SELECT bag.* FROM bag JOIN tot USING (doc_id)),
ov AS (SELECT a.doc_id AS id1, c.doc_id AS id2, count(*) AS ko, sum(least(a.cnt, c.cnt)) AS mo
       FROM b a JOIN b c ON a.token = c.token AND a.doc_id < c.doc_id GROUP BY a.doc_id, c.doc_id),
sims AS (SELECT id1, id2, mo::DOUBLE / (t1.n + t2.n - mo) AS jaccard, ko::DOUBLE / (t1.k + t2.k - ko) AS key_jaccard
         FROM ov JOIN tot t1 ON t1.doc_id = id1 JOIN tot t2 ON t2.doc_id = id2),
pairs AS (SELECT * FROM sims WHERE key_jaccard >= 0.5 AND jaccard >= 0.5)"""

COMPONENTS = """edges AS (SELECT id1 AS a, id2 AS b FROM pairs UNION ALL SELECT id2, id1 FROM pairs),
reach(node, lbl) AS (SELECT a, a FROM edges UNION SELECT e.b, r.lbl FROM reach r JOIN edges e ON r.node = e.a),
comp AS (SELECT node, min(lbl) AS cluster_id FROM reach GROUP BY node),
sizes AS (SELECT cluster_id, count(*) AS size FROM comp GROUP BY cluster_id)"""

LEADER = """edges AS (SELECT id1 AS a, id2 AS b FROM pairs UNION ALL SELECT id2, id1 FROM pairs),
nodes AS (SELECT node, row_number() OVER (ORDER BY node) AS rn FROM (SELECT DISTINCT a AS node FROM edges)),
earlier AS (SELECT n.node, n.rn, coalesce(list(e.b) FILTER (WHERE e.b < n.node), []) AS prev
            FROM nodes n JOIN edges e ON e.a = n.node GROUP BY n.node, n.rn),
walk(rn, leaders) AS (
  SELECT 0, []::BIGINT[]
  UNION ALL
  SELECT w.rn + 1, CASE WHEN list_has_any(x.prev, w.leaders) THEN w.leaders ELSE list_append(w.leaders, x.node) END
  FROM walk w JOIN earlier x ON x.rn = w.rn + 1),
leaders AS (SELECT unnest(leaders) AS leader FROM walk WHERE rn = (SELECT max(rn) FROM nodes)),
lp AS (SELECT min(e.a) AS leader, e.b AS duplicate FROM edges e JOIN leaders l ON l.leader = e.a
       WHERE e.a < e.b AND e.b NOT IN (SELECT leader FROM leaders) GROUP BY e.b)"""

REPO = """repo AS (SELECT filename, regexp_extract(filename, '^(.*)-[^-]*$', 1) AS repo_key FROM files),
repo2 AS (SELECT filename, repo_key, regexp_replace(repo_key, '^([^_]*)_', '\\1/') AS repo_name FROM repo)"""

SPLIT = REPO + """,
keys AS (SELECT DISTINCT repo_key FROM repo),
ranked AS (SELECT repo_key, row_number() OVER (ORDER BY md5('42:' || repo_key), repo_key) - 1 AS rk,
                  count(*) OVER () AS nrep FROM keys),
sets AS (SELECT repo_key, CASE WHEN rk < floor(0.1 * nrep) THEN 'test'
                              WHEN rk < floor(0.1 * nrep) + floor(0.1 * nrep) THEN 'validation'
                              ELSE 'train' END AS set FROM ranked),
split AS (SELECT s.set, r.repo_name, r.filename FROM repo2 r JOIN sets s USING (repo_key))"""

TASKS = SPLIT + """,
tf AS (SELECT s.set, f.filename, f.doc_id, string_split(f.content, chr(10)) AS l
       FROM split s JOIN files f USING (filename) WHERE s.set IN ('validation', 'test')),
tnb AS (SELECT *, list_filter(range(0, len(l)), lambda i: regexp_matches(l[i + 1], '[^$JS]')) AS nb FROM tf),
tk AS (SELECT *, CASE WHEN len(nb) = 0 THEN 0 ELSE greatest(1, least(5, floor(0.2::DOUBLE * len(nb))))::INTEGER END AS k FROM tnb),
tsm AS (SELECT set, filename, doc_id, l,
               unnest(list_slice(list_sort(list_transform(nb, lambda i: {'r': md5('42:' || filename || ':' || CAST(i AS VARCHAR)), 'i': i})), 1, k)) AS c
        FROM tk),
tl AS (SELECT set, filename, doc_id, l, CAST(c.i AS INTEGER) AS line, l[c.i + 1] AS ln FROM tsm),
tc AS (SELECT *, regexp_extract_all(ln, '.') AS cps FROM tl),
ts AS (SELECT set, filename, doc_id, l, line, ln,
              CAST(list_sort(list_transform(list_filter(range(0, len(cps)), lambda p: regexp_matches(cps[p + 1], '[^$JS]')),
                   lambda p: {'r': md5('42:' || filename || ':' || CAST(line AS VARCHAR) || ':' || CAST(p AS VARCHAR)), 'p': p}))[1].p AS INTEGER) AS start
       FROM tc),
tasks AS (SELECT set, filename, doc_id, line, start,
                 array_to_string(l[1:line], chr(10)) || CASE WHEN line > 0 THEN chr(10) ELSE '' END || substring(ln, 1, start) AS leftContext,
                 regexp_replace(substring(ln, start + 1), '^[$JS]+|[$JS]+$', '', 'g') AS groundTruth,
                 array_to_string(l[line + 2:len(l)], chr(10)) AS rightContext
          FROM ts)"""

PREDS = TASKS + """,
preds AS (SELECT doc_id * 1000 + line AS example_id,
                 CASE doc_id % 4 WHEN 0 THEN groundTruth
                                 WHEN 1 THEN substring(groundTruth, 1, length(groundTruth) - 1)
                                 WHEN 2 THEN groundTruth || '</s>x'
                                 ELSE groundTruth || '{' END AS pred,
                 groundTruth AS gold, leftContext
          FROM tasks)"""

SEQS = f"""seqs AS (
  SELECT doc_id, '<s> ' || array_to_string(list_transform(
           list_filter(string_split_regex(text, '\\r\\n|\\n|\\r'), lambda x: regexp_matches(x, '[^$JS]')),
           lambda x: x || ' </s> '), '') || ' </s>' AS seq
  FROM documents),
stoks AS (
  SELECT doc_id, seq, array_to_string(list_filter(string_split_regex(seq, '[$PY]+'), lambda x: x <> '')[2:], ' ') AS data
  FROM seqs),
stok AS (SELECT doc_id, data, list_filter(regexp_extract_all(data, '{SP}'), lambda t: t <> 'Ġ') AS tokens FROM stoks)"""

WINDOWS = SEQS + """,
wst AS (SELECT doc_id, tokens, CASE WHEN len(tokens) < 997 THEN [0] ELSE range(0, len(tokens) - 997 + 1, 897) END AS starts FROM stok),
win AS (SELECT doc_id, tokens, unnest(starts) AS window_start, unnest(range(0, len(starts))) AS window_index FROM wst)"""

LOG = """log AS (
  SELECT user_id % 4 AS run, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 7 AS INTEGER) AS epoch,
         ts, event_id, value AS loss
  FROM events),
tlog AS (
  SELECT run, epoch,
         row_number() OVER (PARTITION BY run ORDER BY ts, event_id) AS step,
         row_number() OVER (PARTITION BY run, epoch ORDER BY ts, event_id) AS epoch_step, loss
  FROM log)"""

EPOCHS = """ep AS (
  SELECT CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS epoch, round(avg(value), 2) AS acc
  FROM events GROUP BY 1),
epochs AS (SELECT epoch, 'epoch-' || CAST(epoch AS VARCHAR) AS model, acc FROM ep)"""


def _w(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


def normal(pred: str, gold: str) -> str:
    """Predictions (p) and truths (g) with single blanks."""
    one = lambda x: f"array_to_string(list_filter(string_split_regex({x}, '[$PY]+'), lambda x: x <> ''), ' ')"
    return f"nrm AS (SELECT {one(pred)} AS p, {one(gold)} AS g FROM preds)"


# the longest common subsequence as the longest increasing chain of places that match, each new place
# replacing the least chain end that is not before it
LCS = """places AS (SELECT p, g, flatten(list_transform(pc, lambda c: list_filter(range(len(gc), 0, -1), lambda j: gc[j] = c))) AS js
           FROM (SELECT DISTINCT p, g, string_split(p, '') AS pc, string_split(g, '') AS gc FROM nrm)),
lcs AS (SELECT p, g, len(list_reduce(list_prepend([]::BIGINT[], list_transform(js, lambda j: [j])), lambda ends, j: list_concat(
            list_filter(ends, lambda e: e < j[1]), j, list_filter(ends, lambda e: e >= j[1])[2:]))) AS l FROM places)"""
RATIO = """CASE WHEN length(p) = 0 OR length(g) = 0 THEN 0
                ELSE CAST(round_even(100.0::DOUBLE * (2 * l) / (length(p) + length(g)), 0) AS INTEGER) END"""

OCC = """occ AS (SELECT doc_id, unnest(tokens) AS token, unnest(range(0, len(tokens))) AS pos FROM stok),
firsts AS (SELECT token, min({'d': doc_id, 'p': pos}) AS fs FROM occ GROUP BY token)"""

VOCAB = SEQS + ",\n" + OCC


def dict_ids(rows: str) -> str:
    """CTEs dict (token, tid) and coded (k, ids): ids of the token lists ``toks`` of ``rows`` by key ``k``."""
    return f"""specials(token, tid) AS (VALUES ('<s>', 0), ('<pad>', 1), ('</s>', 2), ('<unk>', 3), ('<decoder-only>', 4)),
dict AS (SELECT token, tid FROM specials UNION ALL
         SELECT token, tid FROM (SELECT token, row_number() OVER (ORDER BY fs.d, fs.p) + 4 AS tid FROM firsts)
         WHERE token NOT IN (SELECT token FROM specials)),
coded AS (SELECT k, string_agg(CAST(coalesce(tid, 3) AS VARCHAR), ',' ORDER BY pos) AS ids
          FROM (SELECT k, unnest(toks) AS token, unnest(range(0, len(toks))) AS pos FROM {rows}) LEFT JOIN dict USING (token)
          GROUP BY k)"""


ORACLE_SQL: dict[str, str] = {
    "tokenize_regex": _w(TOKS) + """SELECT doc_id, CAST(len(tokens) AS INTEGER) AS n_tokens,
        CAST(len(list_distinct(tokens)) AS INTEGER) AS n_distinct, tokens[1] AS first_token, tokens[-1] AS last_token FROM toks""",
    "tokenize_validity": _w(TOKS) + """SELECT count(*) AS total_files, count(*) FILTER (len(tokens) > 0) AS valid_files FROM toks""",
    "only_identifiers": f"""SELECT doc_id, CAST(len(list_filter(regexp_extract_all(text, '{P}'), lambda t: regexp_matches(t, '^[A-Za-z_]'))) AS INTEGER) AS n_identifiers FROM documents""",
    "batch_assignment": _w(FILES) + """SELECT filename, CAST((row_number() OVER (ORDER BY filename) - 1) % 8 + 1 AS INTEGER) AS batch FROM files""",
    "token_bag": _w(TOKS, BAG) + "SELECT doc_id, token, cnt FROM bag",
    "doc_totals": _w(TOKS) + "SELECT doc_id, CAST(len(tokens) AS INTEGER) AS n, CAST(len(list_distinct(tokens)) AS INTEGER) AS k FROM toks",
    "min_token_filter": _w(TOKS) + "SELECT doc_id FROM toks WHERE len(tokens) >= 20",
    "index_size": _w(TOKS) + "SELECT project, count(*) AS files FROM toks WHERE len(tokens) >= 20 GROUP BY ROLLUP (project)",
    "near_dup_pairs": _w(TOKS, BAG, PAIRS) + "SELECT id1, id2, jaccard, key_jaccard FROM pairs",
    "near_dup_edges": _w(TOKS, BAG, PAIRS, """bagkey AS (SELECT doc_id, list(token || chr(1) || CAST(cnt AS VARCHAR) ORDER BY token) AS bk FROM b GROUP BY doc_id),
reps AS (SELECT bk, min(doc_id) AS rep FROM bagkey GROUP BY bk),
members AS (SELECT k.doc_id, r.rep FROM bagkey k JOIN reps r USING (bk))""") + """
        SELECT id1 AS src, id2 AS dst FROM pairs WHERE id1 IN (SELECT rep FROM reps) AND id2 IN (SELECT rep FROM reps)
        UNION ALL SELECT rep AS src, doc_id AS dst FROM members WHERE doc_id <> rep""",
    "pair_similarity": _w(TOKS, BAG, """t AS (SELECT doc_id, count(*) AS k, sum(cnt) AS n FROM bag GROUP BY doc_id),
nx AS (SELECT doc_id AS id1, lead(doc_id) OVER (ORDER BY doc_id) AS id2 FROM t),
o AS (SELECT id1, id2, count(*) AS ko, sum(least(a.cnt, c.cnt)) AS mo FROM nx JOIN bag a ON a.doc_id = id1 JOIN bag c
      ON c.doc_id = id2 AND a.token = c.token GROUP BY id1, id2)""") + """
        SELECT nx.id1, nx.id2, coalesce(ko, 0)::DOUBLE / (t1.k + t2.k - coalesce(ko, 0)) AS key_jaccard,
               coalesce(mo, 0)::DOUBLE / (t1.n + t2.n - coalesce(mo, 0)) AS jaccard
        FROM nx JOIN t t1 ON t1.doc_id = nx.id1 JOIN t t2 ON t2.doc_id = nx.id2 LEFT JOIN o ON o.id1 = nx.id1""",
    "pairs_by_project": _w(TOKS, BAG, PAIRS) + """SELECT CASE WHEN d1.source = d2.source THEN 'within' ELSE 'across' END AS scope,
        count(*) AS pairs FROM pairs JOIN documents d1 ON d1.doc_id = id1 JOIN documents d2 ON d2.doc_id = id2 GROUP BY 1""",
    "leader_pairs": _w(TOKS, BAG, PAIRS, LEADER) + "SELECT leader, duplicate FROM lp",
    "symmetric_edges": _w(TOKS, BAG, PAIRS) + "SELECT id1 AS src, id2 AS dst FROM pairs UNION SELECT id2, id1 FROM pairs",
    "clone_clusters": _w(TOKS, BAG, PAIRS, COMPONENTS) + "SELECT node, cluster_id FROM comp",
    "cluster_lists": _w(TOKS, BAG, PAIRS, COMPONENTS) + """SELECT c.cluster_id, s.size, c.node AS member
        FROM comp c JOIN sizes s USING (cluster_id)""",
    "cluster_sizes": _w(TOKS, BAG, PAIRS, COMPONENTS) + "SELECT cluster_id, size FROM sizes",
    "cluster_summary": _w(TOKS, BAG, PAIRS, COMPONENTS, """hl AS (SELECT list(size ORDER BY size) AS l, count(*) AS n FROM sizes),
hm AS (SELECT l, n, CASE WHEN n > 2 THEN n // 2 ELSE 0 END AS mid FROM hl)""") + """
        SELECT CAST(sum(size) AS BIGINT) AS cloned_files, count(*) AS clusters, sum(size)::DOUBLE / count(*) AS avg_factor,
               CAST(median(size) AS DOUBLE) AS median_factor,
               (SELECT CAST(CASE WHEN n % 2 = 0 THEN (l[mid + 1] + l[mid + 2]) // 2 ELSE l[mid + 1] END AS DOUBLE) FROM hm) AS median_compat
        FROM sizes""",
    "removal_counts": _w(TOKS, BAG, PAIRS, COMPONENTS) + "SELECT count(*) AS clusters, CAST(sum(size - 1) AS BIGINT) AS removed FROM sizes",
    "dedup_keep_first": _w(FILES, TOKS, BAG, PAIRS, COMPONENTS) + """SELECT doc_id, filename FROM files
        WHERE doc_id NOT IN (SELECT node FROM comp WHERE node <> cluster_id)""",
    "dedup_leader": _w(FILES, TOKS, BAG, PAIRS, LEADER) + """SELECT doc_id, filename FROM files
        WHERE doc_id NOT IN (SELECT duplicate FROM lp)""",
    "repo_names": _w(FILES, REPO) + "SELECT filename, repo_key, repo_name FROM repo2",
    "split_by_repo": _w(FILES, SPLIT) + "SELECT set, repo_name, filename FROM split",
    "split_leakage": _w(FILES, SPLIT) + """SELECT 'repos_in_several_sets' AS "check", count(*) FILTER (WHERE n_sets > 1) AS violations
        FROM (SELECT repo_name, count(DISTINCT set) AS n_sets FROM split GROUP BY repo_name)
        UNION ALL SELECT 'unassigned_files', count(*) FROM files WHERE filename NOT IN (SELECT filename FROM split)""",
    "files_by_repo": _w(FILES, REPO) + "SELECT repo_key, repo_name, count(*) AS files FROM repo2 GROUP BY repo_key, repo_name",
    "split_summary": _w(FILES, SPLIT) + "SELECT set, count(DISTINCT repo_name) AS repositories, count(*) AS files FROM split GROUP BY set",
    "nonblank_line_positions": """SELECT doc_id, CAST(len(l) AS INTEGER) AS n_lines, CAST(len(nb) AS INTEGER) AS n_nonblank,
        CAST(nb[1] AS INTEGER) AS first_nonblank
        FROM (SELECT doc_id, l, list_filter(range(0, len(l)), lambda i: regexp_matches(l[i + 1], '[^$JS]')) AS nb
              FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))""",
    "candidate_starts": """SELECT doc_id, line_no, CAST(len(st) AS INTEGER) AS n_starts, CAST(st[1] AS INTEGER) AS first_start,
        CAST(st[-1] AS INTEGER) AS last_start
        FROM (SELECT doc_id, line_no, list_filter(range(0, len(cps)), lambda p: regexp_matches(cps[p + 1], '[^$JS]')) AS st
              FROM (SELECT doc_id, line_no, regexp_extract_all(line, '.') AS cps
                    FROM (SELECT doc_id, unnest(l) AS line, CAST(unnest(range(0, len(l))) AS INTEGER) AS line_no
                          FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))))
        WHERE len(st) > 0""",
    "sample_lines": _w(FILES) + """SELECT filename, CAST(c.i AS INTEGER) AS line FROM (
        SELECT filename, unnest(list_slice(list_sort(list_transform(nb, lambda i: {'r': md5('42:' || filename || ':' || CAST(i AS VARCHAR)), 'i': i})), 1, k)) AS c
        FROM (SELECT filename, nb, CASE WHEN len(nb) = 0 THEN 0 ELSE greatest(1, least(5, floor(0.2::DOUBLE * len(nb))))::INTEGER END AS k
              FROM (SELECT filename, list_filter(range(0, len(l)), lambda i: regexp_matches(l[i + 1], '[^$JS]')) AS nb
                    FROM (SELECT filename, string_split(content, chr(10)) AS l FROM files))))""",
    "line_completion_tasks": _w(FILES, TASKS) + """SELECT set, filename, line, start, groundTruth,
        md5(leftContext) AS left_md5, md5(rightContext) AS right_md5,
        CAST(length(leftContext) AS INTEGER) AS left_len, CAST(length(rightContext) AS INTEGER) AS right_len FROM tasks""",
    "task_statistics": _w(FILES, TASKS) + """SELECT f.set, f.fileCount, coalesce(t.taskCount, 0) AS taskCount
        FROM (SELECT set, count(*) AS fileCount FROM split WHERE set IN ('validation', 'test') GROUP BY set) f
        LEFT JOIN (SELECT set, count(*) AS taskCount FROM tasks GROUP BY set) t USING (set)""",
    "train_sequences": _w(SEQS) + "SELECT doc_id, CAST(length(seq) AS INTEGER) AS seq_len, md5(seq) AS seq_md5 FROM seqs",
    "normalise_ws": """SELECT doc_id, CAST(length(nw) AS INTEGER) AS norm_len, md5(nw) AS norm_md5
        FROM (SELECT doc_id, array_to_string(list_filter(string_split_regex(text, '[$PY]+'), lambda x: x <> ''), ' ') AS nw FROM documents)""",
    "unicode_words": """SELECT doc_id, CAST(length(nw) AS INTEGER) AS norm_len, md5(nw) AS norm_md5,
        CAST(len(list_filter(string_split(js, chr(10)), lambda x: regexp_matches(x, '[^\\s\\x0b]'))) AS INTEGER) AS n_nonblank,
        CAST(length(regexp_replace(py, '^[\\s\\x0b]+|[\\s\\x0b]+$', '', 'g')) AS INTEGER) AS python_len,
        CAST(length(regexp_replace(js, '^[\\s\\x0b]+|[\\s\\x0b]+$', '', 'g')) AS INTEGER) AS script_len
        FROM (SELECT *, array_to_string(list_filter(string_split_regex(py, '[\\s\\x0b]+'), lambda x: x <> ''), ' ') AS nw
              FROM (SELECT doc_id, translate(text, '.e', '  ') AS py, translate(text, '.', ' ') AS js FROM documents))""",
    "sequence_tokens": _w(SEQS) + "SELECT doc_id, CAST(len(tokens) AS INTEGER) AS n_tokens, md5(data) AS data_md5 FROM stok",
    "eol_marker": """SELECT doc_id, md5(replace(replace(text, chr(10), '<EOL>'), '<EOL>', '</s>')) AS eol_md5 FROM documents""",
    "train_windows": _w(WINDOWS) + """SELECT doc_id, CAST(window_index AS INTEGER) AS window_index, CAST(window_start AS INTEGER) AS window_start,
        CAST(3 + len(tokens[window_start + 1:window_start + 997]) AS INTEGER) AS window_len,
        tokens[window_start + 1] AS first_token,
        CASE WHEN len(tokens[window_start + 1:window_start + 997]) = 0 THEN '</s>'
             ELSE tokens[least(len(tokens), window_start + 997)] END AS last_token
        FROM win""",
    "window_counts": _w(SEQS) + """SELECT doc_id, CAST(CASE WHEN len(tokens) < 997 THEN 1 ELSE (len(tokens) - 997) // 897 + 1 END AS BIGINT) AS windows FROM stok""",
    "padded_windows": _w(WINDOWS, OCC, dict_ids("(SELECT (doc_id, window_index) AS k, tokens[window_start + 1:window_start + 997] AS toks FROM win)")) + """
        SELECT doc_id, CAST(window_index AS INTEGER) AS window_index,
        CAST(3 + len(tokens[window_start + 1:window_start + 997]) AS INTEGER) AS n_real, 1000 AS n_ids,
        CAST(3 + len(tokens[window_start + 1:window_start + 997]) AS INTEGER) AS non_pad,
        CAST(3 + len(tokens[window_start + 1:window_start + 997]) AS INTEGER) AS cut_len,
        md5('0,4,2' || coalesce(',' || ids, '') || repeat(',1', 997 - len(tokens[window_start + 1:window_start + 997]))) AS ids_md5
        FROM win LEFT JOIN coded ON k = (doc_id, window_index)""",
    "vocab_encode": _w(VOCAB) + "SELECT token, row_number() OVER (ORDER BY fs.d, fs.p) - 1 AS token_id FROM firsts",
    "validation_features": _w(SEQS, OCC, FILES, PREDS, f"""lasts AS (SELECT example_id AS k, gold, all_toks[greatest(len(all_toks) - 932, 1):] AS toks
            FROM (SELECT example_id, gold, list_filter(regexp_extract_all(array_to_string(list_filter(string_split_regex(
                replace(leftContext, chr(10), ' </s> ') || ' </s>', '[$PY]+'), lambda x: x <> ''), ' '), '{SP}'), lambda t: t <> 'Ġ') AS all_toks
                FROM preds))""", dict_ids("lasts")) + """
        SELECT lasts.k AS example_id, CAST(3 + len(toks) AS INTEGER) AS n_real, 936 AS n_ids,
        md5('0,4,2' || coalesce(',' || ids, '') || repeat(',1', 933 - len(toks))) AS ids_md5, md5(gold) AS truth_md5
        FROM lasts LEFT JOIN coded USING (k)""",
    "truncated_features": _w(SEQS, OCC, FILES, PREDS, f"""lasts AS (SELECT example_id AS k, all_toks[greatest(len(all_toks) - 932, 1):] AS toks
            FROM (SELECT example_id, list_filter(regexp_extract_all(leftContext, '{SP}'), lambda t: t <> 'Ġ') AS all_toks FROM preds))""",
            dict_ids("lasts")) + """
        SELECT lasts.k AS example_id, CAST(3 + len(toks) AS INTEGER) AS n_real,
        md5('0,4,2' || coalesce(',' || ids, '') || repeat(',1', 933 - len(toks))) AS ids_md5
        FROM lasts LEFT JOIN coded USING (k)""",
    "padding_stats": _w(WINDOWS) + """SELECT CAST((row_number() OVER (ORDER BY doc_id, window_index) - 1) // 8 AS BIGINT) AS batch,
        CAST(3 + len(tokens[window_start + 1:window_start + 997]) AS INTEGER) AS nr FROM win""",
    "cut_predictions": _w(FILES, PREDS) + """SELECT example_id, split_part(pred, '</s>', 1) AS cut_none,
        split_part(CASE WHEN instr(pred, '{') > 0 THEN substring(pred, 1, instr(pred, '{') - 1) ELSE pred END, '</s>', 1) AS cut_exclusive,
        split_part(CASE WHEN instr(pred, '{') > 0 THEN substring(pred, 1, instr(pred, '{')) ELSE pred END, '</s>', 1) AS cut_inclusive
        FROM preds""",
    "normalise_literals": """SELECT doc_id, regexp_replace(
          replace(replace(replace(replace(replace(replace(
            '<string:' || text || '> = <NUM_LIT> + <STR_LIT> + <char_LIT:' || CAST(doc_id AS VARCHAR) || '>',
            '<string', '<STR_LIT'), '<number', '<NUM_LIT'), '<char', '<CHAR_LIT'), '<NUM_LIT>', '0'), '<STR_LIT>', ''), '<CHAR_LIT>', ''),
          '<(STR|NUM|CHAR)_LIT:(.*?)>', '\\2', 'gs') AS normalised FROM documents""",
    "exact_match": _w(FILES, PREDS) + """SELECT round(avg(CASE WHEN list_filter(string_split_regex(split_part(pred, '</s>', 1), '[$PY]+'), lambda x: x <> '')
                                    = list_filter(string_split_regex(gold, '[$PY]+'), lambda x: x <> '') THEN 1 ELSE 0 END) * 100, 2) AS exact_match
        FROM preds""",
    "edit_similarity_native": _w(FILES, PREDS, """nrm AS (SELECT array_to_string(list_filter(string_split_regex(split_part(pred, '</s>', 1), '[$PY]+'), lambda x: x <> ''), ' ') AS p,
                array_to_string(list_filter(string_split_regex(gold, '[$PY]+'), lambda x: x <> ''), ' ') AS g FROM preds)""") + """
        SELECT round(avg(CASE WHEN length(p) = 0 OR length(g) = 0 THEN 0
                              ELSE CAST(round_even(100.0::DOUBLE * (length(p) + length(g) - levenshtein(p, g)) / (length(p) + length(g)), 0) AS INTEGER) END), 2)
               AS edit_similarity FROM nrm""",
    "edit_similarity": _w(FILES, PREDS, normal("split_part(pred, '</s>', 1)", "gold"), LCS) + f"""
        SELECT round(avg({RATIO}), 2) AS edit_similarity FROM nrm JOIN lcs USING (p, g)""",
    "older_scores": _w(FILES, PREDS, normal(
        "split_part(CASE WHEN instr(pred, '{') > 0 THEN substring('0' || pred, 1, instr(pred, '{')) ELSE '0' || pred END, '</s>', 1)",
        "'0' || gold"), LCS) + f"""
        SELECT round(avg(CASE WHEN p = g THEN 1 ELSE 0 END) * 100, 2) AS exact_match, round(avg({RATIO}), 2) AS edit_similarity
        FROM nrm JOIN lcs USING (p, g)""",
    "window_totals": _w(SEQS) + """SELECT count(*) AS lines,
        CAST(sum(CASE WHEN len(tokens) < 997 THEN 1 ELSE (len(tokens) - 997) // 897 + 1 END) AS BIGINT) AS windows FROM stok""",
    "zip_rows": _w(FILES, PREDS) + """SELECT row_number() OVER (ORDER BY example_id) - 1 AS row_index, example_id, example_id AS gold_id FROM preds""",
    "seeded_shuffle": "SELECT doc_id, md5('42:' || CAST(doc_id AS VARCHAR)) AS shuffle_key FROM documents",
    "fixed_batches": _w(FILES, PREDS) + """SELECT example_id, row_index, row_index // 8 AS batch
        FROM (SELECT example_id, row_number() OVER (ORDER BY example_id) - 1 AS row_index FROM preds)""",
    "batch_counts": _w(FILES, PREDS) + """SELECT count(*) AS examples, CAST(ceil(count(*) / 8) AS BIGINT) AS batches,
        CAST(ceil(count(*) / 4) AS BIGINT) AS batches_accum2 FROM preds""",
    "top_repositories": """SELECT c_name AS repo, c_mktsegment AS lang, c_acctbal AS stars FROM customer
        WHERE c_mktsegment = 'AUTOMOBILE' ORDER BY c_acctbal DESC, c_name LIMIT 100""",
    "drop_rows": _w(FILES) + "SELECT filename FROM files ORDER BY filename OFFSET 5",
    "number_rows": _w(FILES) + "SELECT filename, row_number() OVER (ORDER BY filename) - 1 AS row_index FROM files",
    "preview": _w(FILES, PREDS) + "SELECT example_id, gold FROM preds ORDER BY example_id LIMIT 5",
    "trailing_mean_loss": _w(LOG) + """SELECT run, epoch, epoch_step, step, trailing_loss FROM (
        SELECT run, epoch, epoch_step, step,
               round(avg(loss) OVER (PARTITION BY run ORDER BY step ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), 4) AS trailing_loss
        FROM tlog) WHERE epoch_step % 100 = 0""",
    "best_checkpoint": _w(EPOCHS) + """SELECT epoch, model, acc,
        acc > coalesce(max(acc) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS is_best FROM epochs""",
    "running_totals": _w(LOG) + """SELECT run, epoch, step,
        round(sum(loss) OVER (PARTITION BY run, epoch ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS running_loss,
        count(*) OVER (PARTITION BY run, epoch ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS examples FROM tlog""",
}
ORACLE_SQL["padding_stats"] = ORACLE_SQL["padding_stats"].replace(
    "SELECT CAST((row_number()", "SELECT batch, max(nr) AS max_len, count(*) AS rows FROM (SELECT CAST((row_number()") + ") GROUP BY batch"

ORACLE_SQL.update({
    "token_docs_roundtrip": _w(FILES, TOKS) + """SELECT f.filename || ':' || f.project AS id, CAST(len(t.tokens) AS INTEGER) AS n_tokens
        FROM files f JOIN toks t USING (doc_id)""",
    "stream_token_index": _w(FILES, TOKS) + """SELECT f.filename, CAST(len(t.tokens) AS INTEGER) AS n,
        CAST(len(list_distinct(t.tokens)) AS INTEGER) AS k FROM files f JOIN toks t USING (doc_id) WHERE len(t.tokens) >= 20""",
    "split_roundtrip": _w(FILES, SPLIT) + "SELECT set, repo_name, filename FROM split",
    "tasks_roundtrip": _w(FILES, TASKS) + """SELECT set, groundTruth, md5(leftContext) AS left_md5, md5(rightContext) AS right_md5 FROM tasks""",
    "clusters_roundtrip": _w(TOKS, BAG, PAIRS, COMPONENTS) + "SELECT cluster_id, node AS member FROM comp",
    "clusters_document": _w(TOKS, BAG, PAIRS, COMPONENTS) + """SELECT dense_rank() OVER (ORDER BY cluster_id) - 1 AS cluster_index,
        concat('f["', node, '"],\\.py') AS member FROM comp""",
    "sequences_roundtrip": _w(SEQS) + "SELECT md5(data) AS source_md5, CAST(length(data) AS INTEGER) AS source_len FROM stoks",
    "nonblank_lines": """SELECT value FROM (SELECT unnest(string_split(text, chr(10))) AS value FROM documents)
        WHERE regexp_matches(value, '[^$JS]')""",
    "predictions_sink": _w(FILES, PREDS) + """SELECT regexp_replace(pred, '^[$PY]+|[$PY]+$', '', 'g') AS value FROM preds""",
})
# the statements name the white space of the two languages inside character classes
ORACLE_SQL.update({k: v.replace("$PY", PY_WS).replace("$JS", JS_WS) for k, v in ORACLE_SQL.items()})
