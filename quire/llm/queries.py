"""Queries ``opN_<name>`` over the given tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.llm import common as C
from quire.llm import (byte_bpe, centroids, decontaminate, fertility, html_layout, language_id, line_dedup, near_dedup, quotes,
                       spot_signatures, token_files, url_filter, whitening)

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS_SQL = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+')"


def shingles_sql(src: str, key: str, width: int) -> str:
    """Distinct ``width``-word shingles per key; a shorter text is one shingle."""
    return f"""SELECT DISTINCT {key}, array_to_string(w[i:i + {width - 1}], ' ') AS s
      FROM (SELECT {key}, w, unnest(range(1, greatest(len(w) - {width - 1}, 1) + 1)) AS i
            FROM (SELECT {key}, {WORDS_SQL} AS w FROM {src}) WHERE len(w) > 0)"""


@query("op1_minhash_near_dedup", sql=f"""
WITH RECURSIVE sh AS MATERIALIZED ({shingles_sql('documents', 'doc_id', 4)}),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
          FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
edges AS MATERIALIZED (SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
          WHERE 100 * common >= 80 * (na.n + nb.n - common)),
reach AS (SELECT doc_id AS root, doc_id FROM documents
          UNION SELECT root, b FROM reach JOIN edges ON a = doc_id),
comp AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN comp c ON c.doc_id = d.doc_id""")
def op1_minhash_near_dedup(spark, sf_dir):
    """Near-duplicate classes of all documents, four-word shingles, similarity 0.8."""
    return near_dedup.near_duplicates(C.table(spark, sf_dir, "documents"), width=4, percent=80)


@query("op2_byte_bpe")
def op2_byte_bpe(spark, sf_dir):
    """Byte-level BPE of every document, encoded and decoded back."""
    rows = byte_bpe.decode(byte_bpe.encode(C.table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op3_token_files")
def op3_token_files(spark, sf_dir):
    """Ids of every document written to the binary files and read back."""
    path = token_files.scratch(spark)
    token_files.write(C.table(spark, sf_dir, "documents"), path, end_id=2)
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op4_fertility_rules")
def op4_fertility_rules(spark, sf_dir):
    """Base counts and vocabulary measures of every document, with verdicts."""
    return fertility.rules(C.table(spark, sf_dir, "documents"))


@query("op8_line_chunk_dedup", sql=rf"""
WITH l AS MATERIALIZED (SELECT doc_id, h, i, lines[i + 1] AS line, len(regexp_extract_all(lines[i + 1], '[^\x20\x09-\x0D]+')) AS w, len(lines) AS n
           FROM (SELECT doc_id, h, lines, unnest(range(0, len(lines))) AS i
                 FROM (SELECT doc_id, md5(text) AS h, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL))),
p AS (SELECT *, lead(i) OVER (PARTITION BY doc_id, h ORDER BY i) AS j FROM l WHERE w > 0),
d AS (SELECT doc_id, md5(text) AS h, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
u AS MATERIALIZED (SELECT doc_id, h, i AS pos, j - i + 1 AS size, array_to_string(lines[i + 1:j + 1], chr(10)) AS body FROM p JOIN d USING (doc_id, h) WHERE j IS NOT NULL
     UNION ALL SELECT doc_id, h, i, 1, line FROM l WHERE w >= 50),
f AS (SELECT *, first_value(doc_id) OVER b AS fd, first_value(h) OVER b AS fh, first_value(pos) OVER b AS fp
      FROM u WINDOW b AS (PARTITION BY body ORDER BY doc_id, h, pos)),
g AS MATERIALIZED (SELECT DISTINCT doc_id, h, unnest(range(CASE WHEN doc_id = fd AND h = fh THEN greatest(pos, fp + size) ELSE pos END, pos + size)) AS i
      FROM f WHERE NOT (doc_id = fd AND h = fh AND pos = fp)),
t AS (SELECT l.doc_id, count(g.i) AS n_lines_removed, string_agg(line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL) AS kept, max(n) AS n_lines
      FROM l LEFT JOIN g ON g.doc_id = l.doc_id AND g.h = l.h AND g.i = l.i GROUP BY l.doc_id),
r AS (SELECT doc_id, count(*) AS runs FROM g a WHERE NOT EXISTS (SELECT 1 FROM g b WHERE b.doc_id = a.doc_id AND b.h = a.h AND b.i = a.i - 1) GROUP BY doc_id)
SELECT doc_id, CASE WHEN text IS NOT NULL THEN coalesce(kept, '') END AS text, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
       CAST(coalesce(runs, 0) AS BIGINT) AS n_runs_removed, CAST(coalesce(n_lines_removed, 0) AS BIGINT) AS n_lines_removed
FROM documents LEFT JOIN t USING (doc_id) LEFT JOIN r USING (doc_id)""")
def op8_line_chunk_dedup(spark, sf_dir):
    """Every document without the passages that stand earlier in the corpus."""
    out = line_dedup.dedup_lines(C.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", "n_lines", "n_runs_removed", "n_lines_removed")


@query("op6_benchmark_containment", sql=f"""
WITH d AS MATERIALIZED ({shingles_sql('documents', 'doc_id', 5)}),
b AS MATERIALIZED ({shingles_sql('benchmark', 'item_id', 5)}),
n AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id)
SELECT doc_id, item_id, n_item, n_found, n_found / n_item AS containment
FROM (SELECT doc_id, item_id, count(*) AS n_found FROM d JOIN b USING (s) GROUP BY ALL) JOIN n USING (item_id)
WHERE 100 * n_found >= 80 * n_item""")
def op6_benchmark_containment(spark, sf_dir):
    """Every document that holds a benchmark item, with the item."""
    return decontaminate.contained_items(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))


URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
JUNK = "[%*#$&|]{3}"
_RULES_SQL = "(VALUES " + ", ".join(f"('{v}', '{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for v, r in URL_RULES) + ") r(v, rule, rh, rp)"


@query("op5_bloom_cascade_urls", sql=rf"""
WITH u AS (SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
bad AS (SELECT DISTINCT host || path AS key FROM p WHERE host <> '' AND len(regexp_extract_all(html, '{JUNK}')) >= 5),
best AS (SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(v, length(rule)) AS v
         FROM p, {_RULES_SQL} WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id),
j AS (SELECT page_id, host, path, host <> '' AND host || path IN (SELECT key FROM bad) AS listed FROM p)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed
FROM j LEFT JOIN best USING (page_id)""")
def op5_bloom_cascade_urls(spark, sf_dir):
    """Verdict on every page URL. The list holds the keys (host and path) of
    pages with five or more runs of junk symbols in their markup."""
    pages = C.table(spark, sf_dir, "pages")
    host, path = url_filter.host_and_path(F.col("url"))
    listed = pages.where(F.regexp_count("html", F.lit(JUNK)) >= 5).select(F.when(host != "", F.concat(host, path)).alias("key"))
    return url_filter.judged(pages, listed, URL_RULES)


_TURN_SQL = "SELECT conv_id, turn, min(text) AS text FROM conversations GROUP BY conv_id, turn"
_NORM_SQL = r"trim(regexp_replace(lower({}), '\s+', ' ', 'g'), ' ')"


def _mail_view(c):
    """The conversations as mail: each turn quotes the turn before it, which
    in its turn quoted the one before that. Every third turn quotes, below its
    own text, the turn before the last once more on its own; every other third
    one six words out of the middle of the last."""
    turns = c.groupBy("conv_id", "turn").agg(F.min("text").alias("text"))
    back = lambda n, name: turns.select("conv_id", (F.col("turn") + n).alias("turn"), F.col("text").alias(name))
    quote = lambda col, mark: F.concat(F.lit(mark), F.regexp_replace(col, "\n", "\n" + mark), F.lit("\n"))
    m = c.join(back(1, "one"), ["conv_id", "turn"], "left").join(back(2, "two"), ["conv_id", "turn"], "left")
    words = F.regexp_extract_all("one", F.lit(r"\S+"), 0)
    below = (F.when((F.col("turn") % 3 == 2) & F.col("two").isNotNull(), F.concat(F.lit("\n"), quote("two", "> ")))
             .when((F.col("turn") % 3 == 1) & (F.size(words) >= 8), F.concat(F.lit("\n> "), F.array_join(F.slice(words, 3, 6), " "), F.lit("\n"))))
    return m.select("conv_id", "turn", "role", F.concat(F.coalesce(quote("two", ">> "), F.lit("")), F.coalesce(quote("one", "> "), F.lit("")),
                                                        F.lit("\n"), F.coalesce("text", F.lit("")), F.coalesce(below, F.lit(""))).alias("text"))


@query("op9_quote_links", sql=rf"""
WITH RECURSIVE turns AS MATERIALIZED ({_TURN_SQL}),
mail AS MATERIALIZED (
  SELECT c.conv_id, c.turn, min(c.role) AS role,
         min(coalesce('>> ' || replace(b.text, chr(10), chr(10) || '>> ') || chr(10), '')
          || coalesce('> ' || replace(a.text, chr(10), chr(10) || '> ') || chr(10), '') || chr(10) || coalesce(c.text, '')
          || CASE WHEN c.turn % 3 = 2 AND b.text IS NOT NULL THEN chr(10) || '> ' || replace(b.text, chr(10), chr(10) || '> ') || chr(10)
                  WHEN c.turn % 3 = 1 AND len(regexp_extract_all(a.text, '\S+')) >= 8
                  THEN chr(10) || '> ' || array_to_string(regexp_extract_all(a.text, '\S+')[3:8], ' ') || chr(10) ELSE '' END) AS text
  FROM conversations c LEFT JOIN turns a ON a.conv_id = c.conv_id AND a.turn = c.turn - 1
  LEFT JOIN turns b ON b.conv_id = c.conv_id AND b.turn = c.turn - 2 GROUP BY c.conv_id, c.turn),
ln AS (SELECT conv_id, turn, i, lines[i] AS x, regexp_extract(lines[i], '^(?:[ \t]*>)+', 0) AS marks
       FROM (SELECT conv_id, turn, lines, unnest(range(1, len(lines) + 1)) AS i
             FROM (SELECT conv_id, turn, string_split(text, chr(10)) AS lines FROM mail))),
lv AS (SELECT conv_id, turn, i, length(replace(replace(marks, ' ', ''), chr(9), '')) AS level,
              CASE WHEN marks = '' THEN x ELSE regexp_replace(substr(x, length(marks) + 1), '^ ', '') END AS body FROM ln),
lk AS (SELECT * FROM (SELECT *, lead(level) OVER (PARTITION BY conv_id, turn ORDER BY i) AS nx FROM lv)
       WHERE NOT (regexp_matches(body, '(?i)\bwrote:\s*$') AND coalesce(nx > level, false))),
rn AS (SELECT *, sum(CASE WHEN level = pv THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id, turn ORDER BY i) AS run
       FROM (SELECT *, lag(level) OVER (PARTITION BY conv_id, turn ORDER BY i) AS pv FROM lk)),
ps AS MATERIALIZED (SELECT conv_id, turn, run, any_value(level) AS level, string_agg(body, chr(10) ORDER BY i) AS body FROM rn GROUP BY ALL),
own AS MATERIALIZED (SELECT conv_id, turn, regexp_replace(string_agg(body, chr(10) ORDER BY run), '^(?:[ \t]*\n)+|(?:\n[ \t]*)+$', '', 'g') AS own
       FROM ps WHERE level = 0 GROUP BY ALL),
units AS (SELECT conv_id, u, min(turn) AS source FROM (
            SELECT conv_id, turn, {_NORM_SQL.format('own')} AS u FROM own
            UNION ALL SELECT conv_id, turn, {_NORM_SQL.format('y')} FROM (SELECT conv_id, turn, unnest(regexp_split_to_array(own, '\n[ \t]*\n')) AS y FROM own)
            UNION ALL SELECT conv_id, turn, {_NORM_SQL.format('y')} FROM (SELECT conv_id, turn, unnest(string_split(own, chr(10))) AS y FROM own))
          WHERE u <> '' GROUP BY ALL),
quotes AS (SELECT conv_id, turn, run, level, u, min(rank) AS rank FROM (
            SELECT conv_id, turn, run, level, 0 AS rank, {_NORM_SQL.format('body')} AS u FROM ps WHERE level > 0
            UNION ALL SELECT conv_id, turn, run, level, 1, {_NORM_SQL.format('y')}
            FROM (SELECT conv_id, turn, run, level, unnest(string_split(body, chr(10))) AS y FROM ps WHERE level > 0))
          WHERE u <> '' GROUP BY ALL),
exact AS MATERIALIZED (SELECT q.conv_id, q.turn, q.run, q.level, min(rank) AS rank, arg_min(source, rank * 1000000000 - source) AS source
          FROM quotes q JOIN units s ON s.conv_id = q.conv_id AND s.u = q.u AND source < q.turn GROUP BY ALL),
missed AS (SELECT conv_id, turn, run, level, {_NORM_SQL.format('body')} AS u FROM ps WHERE level > 0
           AND NOT EXISTS (SELECT 1 FROM exact x WHERE x.conv_id = ps.conv_id AND x.turn = ps.turn AND x.run = ps.run)),
partial AS (SELECT m.conv_id, m.turn, m.run, m.level, 2 AS rank, min(o.turn) AS source FROM missed m
            JOIN own o ON o.conv_id = m.conv_id AND o.turn < m.turn AND contains(' ' || {_NORM_SQL.format('own')} || ' ', ' ' || u || ' ')
            WHERE len(string_split(u, ' ')) >= 4 GROUP BY ALL),
links AS MATERIALIZED (SELECT * FROM exact UNION ALL SELECT * FROM partial),
up AS (SELECT conv_id, turn, arg_min(source, rank * 1000000000 - source) AS parent FROM links WHERE level = 1 GROUP BY ALL),
walk AS (SELECT conv_id, turn, parent AS anc, CAST(1 AS BIGINT) AS depth FROM up
         UNION ALL SELECT w.conv_id, w.turn, u.parent, w.depth + 1 FROM walk w JOIN up u ON u.conv_id = w.conv_id AND u.turn = w.anc),
ends AS (SELECT conv_id, turn, arg_max(anc, depth) AS root, max(depth) AS depth FROM walk GROUP BY ALL),
nq AS (SELECT conv_id, turn, count(*) AS n FROM ps WHERE level > 0 AND {_NORM_SQL.format('body')} <> '' GROUP BY ALL),
nl AS (SELECT conv_id, turn, count(*) AS n FROM links GROUP BY ALL)
SELECT m.conv_id AS thread, m.turn AS msg, m.role, coalesce(o.own, '') AS own_text, coalesce(nq.n, 0) AS n_quotes, coalesce(nl.n, 0) AS n_linked,
       up.parent, coalesce(e.root, m.turn) AS root, coalesce(e.depth, 0) AS depth,
       '<|' || coalesce(m.role, 'user') || '|>' || chr(10) || coalesce(o.own, '') || chr(10) || '<|end|>' || chr(10) AS chat
FROM mail m LEFT JOIN own o USING (conv_id, turn) LEFT JOIN nq USING (conv_id, turn) LEFT JOIN nl USING (conv_id, turn)
LEFT JOIN up USING (conv_id, turn) LEFT JOIN ends e USING (conv_id, turn)""")
def op9_quote_links(spark, sf_dir):
    """Conversations read as mail with nested quotes, linked back and stripped."""
    return quotes.formatted(_mail_view(C.table(spark, sf_dir, "conversations")), "conv_id", "turn", "role", "text")


@query("op10_html_layout")
def op10_html_layout(spark, sf_dir):
    """Rendered visible text of every page."""
    return html_layout.extracted(C.table(spark, sf_dir, "pages"))


@query("op7_byte_gru_language")
def op7_byte_gru_language(spark, sf_dir):
    """Language of every document."""
    return language_id.predicted(C.table(spark, sf_dir, "documents"))


@query("op11_spot_signatures", sql=rf"""
WITH d AS MATERIALIZED (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
e AS MATERIALIZED (SELECT doc_id, n, substr(text, 1, n - n // 3) || substr(following, 1, n // 3) AS edited, next_id
      FROM (SELECT *, coalesce(lead(text) OVER w, first_value(text) OVER w) AS following, coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_id
            FROM d WINDOW w AS (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))),
t AS (SELECT 0 AS kind, doc_id, text FROM d UNION ALL SELECT 1, doc_id, edited FROM e),
ws AS MATERIALIZED (SELECT kind, doc_id, list_filter(list_transform(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+'),
             lambda x: rtrim(x, '.,;:!?')), lambda x: x <> '') AS w FROM t),
df AS MATERIALIZED (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(list_distinct(w)) AS word FROM ws JOIN d USING (doc_id) WHERE kind = 0) GROUP BY ALL),
large AS (SELECT lang FROM (SELECT lang, count(*) AS c FROM d GROUP BY lang) WHERE c * 100 >= (SELECT count(*) FROM d)),
anchors AS MATERIALIZED (
  SELECT word FROM (SELECT word FROM df GROUP BY word ORDER BY sum(n) DESC, word LIMIT 24)
  UNION SELECT word FROM (SELECT word, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS r FROM df JOIN large USING (lang)) WHERE r <= 24),
pos AS (SELECT kind, doc_id, i, w[i] AS word FROM (SELECT kind, doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM ws)),
marked AS MATERIALIZED (SELECT p.*, a.word IS NOT NULL AS common FROM pos p LEFT JOIN anchors a ON a.word = p.word),
body AS MATERIALIZED (SELECT kind, doc_id, list(word ORDER BY i) AS content FROM marked WHERE NOT common GROUP BY ALL),
spot AS (SELECT m.kind, m.doc_id, m.word || ' ' || content[k + 1] || ' ' || content[k + 2] || ' ' || content[k + 3] AS s, len(content) - k AS reach
         FROM (SELECT *, count(*) FILTER (WHERE NOT common) OVER (PARTITION BY kind, doc_id ORDER BY i) AS k FROM marked) m
         JOIN body USING (kind, doc_id) WHERE common),
whole AS (SELECT kind, doc_id, list_sort(list(DISTINCT substr(md5(s), 1, 8))) AS sigs FROM spot WHERE reach >= 3 GROUP BY ALL),
prints AS MATERIALIZED (SELECT kind, doc_id, CASE WHEN len(w) = 0 THEN [] ELSE coalesce(sigs, [substr(md5(array_to_string(w, ' ')), 1, 8)]) END AS sigs
           FROM ws LEFT JOIN whole USING (kind, doc_id)),
j AS (SELECT e.doc_id, n, edited, o.sigs AS own, c.sigs AS changed, f.sigs AS following
      FROM e JOIN prints o ON o.kind = 0 AND o.doc_id = e.doc_id JOIN prints c ON c.kind = 1 AND c.doc_id = e.doc_id
      JOIN prints f ON f.kind = 0 AND f.doc_id = e.next_id)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, array_to_string(own, '') AS fingerprint, array_to_string(changed, '') AS edited_fingerprint,
       CASE WHEN len(own) = 0 OR len(changed) = 0 THEN CAST(len(own) = len(changed) AS DOUBLE)
            ELSE len(list_intersect(own, changed)) / (len(own) + len(changed) - len(list_intersect(own, changed))) END AS near_edited,
       CASE WHEN len(own) = 0 OR len(following) = 0 THEN CAST(len(own) = len(following) AS DOUBLE)
            ELSE len(list_intersect(own, following)) / (len(own) + len(following) - len(list_intersect(own, following))) END AS near_next
FROM j""")
def op11_spot_signatures(spark, sf_dir):
    """SpotSigs of every document and of its edited text, and their likeness."""
    return spot_signatures.edited_fingerprints(C.table(spark, sf_dir, "documents"))


@query("op12_exact_whitening")
def op12_exact_whitening(spark, sf_dir):
    """Every embedding along the largest components of the exact scatter."""
    return whitening.whitened(C.table(spark, sf_dir, "embeddings"))


def _kmeans_sql(dim: int, clusters: int, rounds: int, scale: int, seed: int) -> str:
    """Rounds of k-means one after another, over (vector, component) rows."""
    parts = [f"""v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda c: CAST(floor({scale} * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
      WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
x AS MATERIALIZED (SELECT vec_id, i, x[i] AS x FROM (SELECT vec_id, x, unnest(range(1, {dim + 1})) AS i FROM v)),
c0 AS MATERIALIZED (SELECT k, i, c[i] AS c FROM (SELECT k, c, unnest(range(1, {dim + 1})) AS i FROM (
      SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS k, x AS c FROM v ORDER BY k LIMIT {clusters})))"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, arg_min(k, dist * {clusters} + k) AS k, min(dist) AS dist
      FROM (SELECT vec_id, k, CAST(sum((x - c) * (x - c)) AS BIGINT) AS dist FROM x JOIN c{r} USING (i) GROUP BY ALL) GROUP BY vec_id)""")
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (SELECT k, i, coalesce(m, c) AS c FROM c{r} LEFT JOIN (
      SELECT k, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m FROM a{r} JOIN x USING (vec_id) GROUP BY k, i) USING (k, i))""")
    return f"""WITH {", ".join(parts)},
sums AS (SELECT k, sum(dist) AS s FROM a{rounds} GROUP BY k),
names AS (SELECT k, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS "cluster", dist AS distance, CAST(s AS BIGINT) AS cluster_inertia, CAST((SELECT sum(s) FROM sums) AS BIGINT) AS inertia,
       h AS centroid_sha256 FROM a{rounds} JOIN sums USING (k) JOIN names USING (k)"""


@query("op13_incremental_centroids", sql=_kmeans_sql(64, 8, 10, 1024, 3))
def op13_incremental_centroids(spark, sf_dir):
    """Every embedding's cluster after ten rounds of exact k-means."""
    return centroids.clustered(C.table(spark, sf_dir, "embeddings"))
