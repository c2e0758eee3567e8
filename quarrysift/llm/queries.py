"""The queries of this subpackage: thin calls of its operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontam, langid, licenses, neardup, prefixtrie, quality, tokenfiles, topk, toxicity, veccodes, warc
from .common import fold, prepare, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

VOCABULARY = "byte_bpe_50k.json"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            prepare(spark)
            return function(spark, folder)

        QUERIES[function.__name__] = run
        if sql is not None:
            SQL[function.__name__] = sql
        return run

    return register


@query()
def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Encode and decode every document; digests of ids and decoded text."""
    return bpe.round_trip(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


@query()
def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Write every document's ids in sequence files and read them back."""
    docs = table(spark, folder, "documents")
    manifest = tokenfiles.write_sequences(docs, public_tokenizers.path(VOCABULARY))
    return tokenfiles.read_documents(manifest, docs.schema["doc_id"].dataType)


@query()
def op10_langid(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from three of four parts."""
    docs = table(spark, folder, "documents")
    network = langid.fit(docs.where(~_held_out(4, 2)), "text", "lang")
    found = langid.identify(docs, network)
    return found.select("doc_id", _held_out(4, 2).alias("held_out"), "lang_pred", "score")


def _held_out(parts: int, left_out: int) -> Column:
    return F.coalesce(fold("doc_id", parts) == left_out, F.lit(False))


@query()
def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The quality of every document, learned from two of three parts of the labels."""
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").where(~_held_out(3, 1))
    found = quality.score(docs, quality.fit(docs, labels))
    return found.select(
        "doc_id", _held_out(3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query()
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of every document, learned from three of four parts of the labels."""
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").where(~_held_out(4, 2))
    found = toxicity.score(docs, toxicity.fit(docs, labels))
    return found.select(
        "doc_id",
        _held_out(4, 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )


@query()
def op9_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate documents on three-word shingles at 0.85."""
    return neardup.deduplicate(table(spark, folder, "documents"), width=3, percent=85)


# Words are numbered per text; a window is ten of an item's words in a row.
SQL_CONTAMINATION = r"""
WITH dw AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
iw AS (
  SELECT item_id::VARCHAR AS item, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
win AS (
  SELECT item, n, array_to_string(ws[i:i + n - 1], ' ') AS key
  FROM (SELECT item, ws, least(len(ws), 10) AS n, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM iw WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
pos AS (
  SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS key
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM dw CROSS JOIN sizes WHERE len(ws) >= n)),
hit AS (SELECT pos.doc_id, pos.i, pos.n, win.item FROM pos JOIN win ON pos.n = win.n AND pos.key = win.key),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
own AS (SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS items
        FROM hit GROUP BY doc_id)
SELECT dw.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN cov USING (doc_id) LEFT JOIN own USING (doc_id)"""


@query(SQL_CONTAMINATION)
def op6_decontam(spark: SparkSession, folder: str) -> DataFrame:
    """Windows of ten benchmark words in the documents."""
    return decontam.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query(
    """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS n, sha256(h) AS digest FROM p),
f AS (SELECT digest, min(page_id) AS least FROM d WHERE n >= 100 GROUP BY digest)
SELECT page_id, n AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN least IS NOT NULL AND page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN least IS NOT NULL AND page_id <> least THEN least END AS refers_to
FROM d LEFT JOIN f ON f.digest = d.digest"""
)
def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    """A WARC record per page, written and read back."""
    return warc.round_trip(table(spark, folder, "pages"))


@query(
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
           WHERE embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20"""
)
def op3_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The twenty best vectors for every twentieth one."""
    vectors = table(spark, folder, "embeddings")
    return topk.search(vectors, vectors.where("vec_id % 20 = 0"))


def _chat_sql() -> str:
    """Costs to go backwards over the turns, then the states forwards; the moves are a table of values."""

    def quoted(value: str) -> str:
        return "'" + value.replace("\n", "\\n") + "'"

    moves = [
        f"({code}, {a}, {b}, {m.cost}, '{m.action}', '{m.role}', '{','.join(m.inserted)}', {quoted(chat.rendered(m, '', a > 0))})"
        for code, table_of in enumerate(chat.MOVES)
        for a, row in enumerate(table_of)
        for b, m in enumerate(row)
        if m is not None
    ]
    ends = [f"({s}, {chat.END_COSTS[s]}, {quoted(chat.ending(s))})" for s in range(1, chat.STATES)]
    codes = " ".join(f"WHEN '{role}' THEN {k}" for k, role in enumerate(chat.ROLES))
    return f"""
WITH RECURSIVE move(code, a, b, cost, action, new_role, inserted, prefix) AS (VALUES {", ".join(moves)}),
ending(s, cost, rest) AS (VALUES {", ".join(ends)}),
t AS (SELECT conv_id, turn, coalesce(text, '') AS text, CASE lower(trim(role)) {codes} ELSE {len(chat.ROLES)} END AS code,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, count(*) OVER (PARTITION BY conv_id) AS n
      FROM conversations),
back(conv_id, i, s, togo) AS (
  SELECT DISTINCT conv_id, n, s, cost FROM t CROSS JOIN ending
  UNION ALL
  SELECT back.conv_id, back.i - 1, move.a, min(move.cost + togo) FROM back
  JOIN t ON t.conv_id = back.conv_id AND t.i = back.i JOIN move ON move.code = t.code AND move.b = back.s
  GROUP BY back.conv_id, back.i, move.a),
forth(conv_id, i, s) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 0 FROM t
  UNION ALL
  SELECT f.conv_id, f.i + 1, arg_min(move.b, (move.cost + togo) * 10 + move.b) FROM forth f
  JOIN t ON t.conv_id = f.conv_id AND t.i = f.i + 1 JOIN move ON move.code = t.code AND move.a = f.s
  JOIN back ON back.conv_id = f.conv_id AND back.i = f.i + 1 AND back.s = move.b
  GROUP BY f.conv_id, f.i)
SELECT t.conv_id, t.turn, t.i - 1 AS seq, action, new_role, inserted,
       concat(replace(prefix, '\\n', chr(10)), text, CASE WHEN t.i = n THEN replace(rest, '\\n', chr(10)) ELSE '' END) AS piece
FROM t JOIN forth x ON x.conv_id = t.conv_id AND x.i = t.i - 1 JOIN forth y ON y.conv_id = t.conv_id AND y.i = t.i
JOIN move ON move.code = t.code AND move.a = x.s AND move.b = y.s JOIN ending ON ending.s = y.s"""


@query(_chat_sql())
def op1_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation with its roles repaired, turn by turn in the ChatML form."""
    found = chat.format_chats(table(spark, folder, "conversations"))
    return found.withColumn("inserted", F.array_join("inserted", ","))


def _codes_sql(rounds: int = veccodes.ROUNDS) -> str:
    """Every round is two tables: the parts with their nearest entries, and the entries moved."""
    near = """SELECT p.vec_id, p.k, p.x, arg_min(c.j, c.d * 16 + c.j) AS j, min(c.d) AS d FROM (
  SELECT p.vec_id, p.k, c.j, list_sum(list_transform(list_zip(p.x, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
  FROM p JOIN {books} c ON p.k = c.k) c JOIN p ON p.vec_id = c.vec_id AND p.k = c.k GROUP BY p.vec_id, p.k, p.x"""
    steps = []
    for r in range(rounds):
        steps.append(f"a{r} AS MATERIALIZED ({near.format(books=f'c{r}')})")
        steps.append(f"""m{r} AS MATERIALIZED (SELECT k, j, list(m ORDER BY i) AS c FROM (
  SELECT k, j, i, floor(sum(x[i])::DOUBLE / count(*))::BIGINT AS m FROM (SELECT k, j, x, unnest(range(1, len(x) + 1)) AS i FROM a{r})
  GROUP BY k, j, i) GROUP BY k, j)""")
        steps.append(f"""c{r + 1} AS MATERIALIZED (SELECT c{r}.k, c{r}.j, coalesce(m{r}.c, c{r}.c) AS c
  FROM c{r} LEFT JOIN m{r} ON c{r}.k = m{r}.k AND c{r}.j = m{r}.j)""")
    return f"""
WITH v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, k, e[k * (len(e) // 8) + 1:(k + 1) * (len(e) // 8)] AS x FROM (SELECT *, unnest(range(8)) AS k FROM v)),
c0 AS MATERIALIZED (SELECT k, n - 1 AS j, x AS c FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY vec_id) AS n FROM p) WHERE n <= 16),
{", ".join(steps)},
last AS MATERIALIZED ({near.format(books=f"c{rounds}")}),
own AS (SELECT vec_id, string_agg(printf('%02x', j), '' ORDER BY k) AS code, sum(d)::BIGINT AS error FROM last GROUP BY vec_id),
whole AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY k, j)) AS codebooks_sha256 FROM c{rounds})
SELECT own.vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM own JOIN v ON own.vec_id = v.vec_id CROSS JOIN whole"""


@query(_codes_sql())
def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Eight-part codes of all vectors, with codebooks of sixteen entries learned on all of them."""
    return veccodes.compress(table(spark, folder, "embeddings"))


# The CRC-32 of an id's digits, bit by bit; a prefix is the text of its turns with their lengths.
SQL_PREFIX_TRIE = """
WITH RECURSIVE bits(c, k, crc) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 4294967295::BIGINT FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL
  SELECT c, k + 1, xor(y >> 1, CASE WHEN y % 2 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END)
  FROM (SELECT c, k, CASE WHEN k % 8 = 0 THEN xor(crc, ascii(substr(c::VARCHAR, (k // 8 + 1)::INT, 1))::BIGINT) ELSE crc END AS y
        FROM bits WHERE k < 8 * length(c::VARCHAR))),
conv AS (SELECT c, c - c % 5 AS base, xor(crc, 4294967295::BIGINT) % 9 AS h FROM bits WHERE k = 8 * length(c::VARCHAR)),
own AS (SELECT conv_id, i, strlen(x) AS b, concat(strlen(r), ':', b, ':', r, x) AS turn FROM (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    sha256(concat(strlen(coalesce(role, '')), ':', role, text))) AS i FROM conversations WHERE conv_id IS NOT NULL)),
heads AS (SELECT c, any_value(h) AS h, count(own.conv_id) AS n FROM conv LEFT JOIN own ON own.conv_id = base AND i <= h GROUP BY c),
whole AS (
  SELECT c, i AS d, turn, b FROM conv JOIN own ON own.conv_id = base AND i <= h
  UNION ALL
  SELECT c, i - h + n, turn, b FROM heads JOIN own ON own.conv_id = c AND i > h),
path AS (
  SELECT w.c, w.d, any_value(w.b) AS b, string_agg(v.turn, '' ORDER BY v.d) AS p,
         coalesce(string_agg(v.turn, '' ORDER BY v.d) FILTER (WHERE v.d < w.d), '') AS up
  FROM whole w JOIN whole v ON v.c = w.c AND v.d <= w.d GROUP BY w.c, w.d
  UNION ALL SELECT c, 0, 0, '', NULL FROM conv),
size AS (SELECT c, max(d) AS n FROM path GROUP BY c),
node AS (SELECT p, d, any_value(up) AS up, any_value(b) AS b, min(path.c) AS c, count(*) AS n,
                coalesce(string_agg(path.c::VARCHAR, ',' ORDER BY path.c) FILTER (WHERE d = size.n), '') AS ends
         FROM path JOIN size ON path.c = size.c GROUP BY p, d),
child AS (SELECT up, count(*) AS n FROM node WHERE d > 0 GROUP BY up),
below AS (SELECT path.p, sum((node.n - 1) * node.b)::BIGINT AS saved, count(*) FILTER (WHERE child.n IS NULL) AS leaves
          FROM node LEFT JOIN child ON child.up = node.p JOIN path ON path.c = node.c AND path.d <= node.d GROUP BY path.p)
SELECT node.c AS conv_id, node.d AS depth, top.c AS parent_conv_id, node.n AS n_convs, coalesce(child.n, 0) AS n_children,
       leaves AS n_leaves, saved AS saved_tokens, sha256(node.ends) AS ends_sha256
FROM node JOIN below ON below.p = node.p LEFT JOIN child ON child.up = node.p LEFT JOIN node top ON top.p = node.up"""


@query(SQL_PREFIX_TRIE)
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """All prefixes of the conversations rebuilt with the heads of every fifth one."""
    turns = table(spark, folder, "conversations")
    return prefixtrie.prefix_trie(turns, lambda c: c - c % 5, lambda c: F.crc32(c.cast("string")) % 9, most=8)


def _licenses_sql() -> str:
    """Grams as texts of words; diagonals are merged as in the operator."""
    rows = [(label, text, "false") for label, text in licenses.TEMPLATES] + [(label, text, "true") for label, text in licenses.PHRASES]
    values = ", ".join(f"({n}, '{label}', {exact}, '{text}')" for n, (label, text, exact) in enumerate(rows))

    def words(column: str) -> str:
        low = f"translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        return rf"list_filter(string_split_regex({low}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

    return f"""
WITH template(tid, label, exact, text) AS (VALUES {values}),
tw AS (SELECT tid, label, exact, ws, len(ws) AS n, least(len(ws), {licenses.GRAM}) AS m FROM (SELECT tid, label, exact, {words("text")} AS ws FROM template)),
tg AS (SELECT tid, label, exact, n, m, q, array_to_string(ws[q + 1:q + m], ' ') AS g FROM (SELECT *, unnest(range(n - m + 1)) AS q FROM tw)),
dw AS (SELECT doc_id, {words("text")} AS ws FROM documents),
dg AS (SELECT doc_id, m, p, array_to_string(ws[p + 1:p + m], ' ') AS g
       FROM (SELECT doc_id, ws, m, unnest(range(greatest(len(ws) - m + 1, 0))) AS p FROM dw CROSS JOIN (SELECT DISTINCT m FROM tw))),
vote AS (SELECT DISTINCT doc_id, tid, label, exact, n, tg.m, p - q AS d, q FROM dg JOIN tg ON dg.m = tg.m AND dg.g = tg.g),
base AS (SELECT doc_id, label, d, 1::DOUBLE AS share FROM vote WHERE exact GROUP BY doc_id, tid, label, n, m, d HAVING count(*) = n - m + 1),
gap AS (SELECT *, coalesce(d - lag(d) OVER (PARTITION BY doc_id, tid ORDER BY d) > least({licenses.NEAR}, n // 4), false) AS apart FROM vote WHERE NOT exact),
island AS (SELECT *, sum(apart::INT) OVER (PARTITION BY doc_id, tid ORDER BY d RANGE UNBOUNDED PRECEDING) AS part FROM gap),
covered AS (SELECT doc_id, tid, label, n, part, count(DISTINCT w) AS c FROM (
  SELECT doc_id, tid, label, n, part, unnest(range(q, q + m)) AS w FROM island) GROUP BY doc_id, tid, label, n, part),
found AS (SELECT doc_id, label, d, share FROM base
          UNION ALL SELECT doc_id, label, NULL, c / n FROM covered WHERE c * 100 >= n * {licenses.LEAST_COVER}),
own AS (SELECT doc_id, count(d) AS n_base, min(d) AS first_word, max(d) AS last_word, max(share) AS score,
               coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE d IS NOT NULL), '') AS base_labels,
               string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM found GROUP BY doc_id)
SELECT dw.doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM dw LEFT JOIN own ON own.doc_id = dw.doc_id"""


@query(_licenses_sql())
def op11_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and notices in all documents."""
    return licenses.scan_licenses(table(spark, folder, "documents"))
