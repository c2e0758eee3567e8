"""Every query by name, each beside the SQL that must give the same rows.

The tables stand in for a source tree and its index: ``documents`` are files,
``embeddings`` their vectors, ``pages`` markup files, ``conversations`` chunks,
``benchmark`` new files, ``labels`` marks on files, ``part`` model scores.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import globs, text, vectors
from ..functions.languages import language_of
from ..operators import chunking, embedding, ranking, rules, stats, structural
from ..operators.diff import diff
from ..operators.search import SearchSpec, report, search, top
from ..schema import LISTING
from ..session import scratch_dir, ship_package
from ..sources import codefiles, corpus, tree
from ..sources.selection import Selection
from ..sources.storage import Storage
from .index import Index

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        @functools.wraps(function)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            return function(spark, folder)

        QUERIES[function.__name__] = run
        if sql is not None:
            SQL[function.__name__] = sql
        return run

    return register


# The tables in the roles they play


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def doc_path() -> Column:
    return F.concat(F.col("source"), F.lit("/"), F.col("lang"), F.lit("/doc_"), F.col("doc_id"), F.lit(".txt"))


def doc_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as a file table with ``doc_id`` and ``lang`` kept beside it."""
    docs = table(spark, folder, "documents")
    return docs.select(
        "doc_id",
        "lang",
        doc_path().alias("file_path"),
        F.octet_length("text").cast("bigint").alias("length"),
        F.col("text").cast("binary").alias("content"),
        F.lit(None).cast("bigint").alias("mtime_us"),
        F.lit(None).cast("string").alias("error"),
    )


# Extensions by language and length, so that documents look like a source tree.
EXTENSIONS = {
    "en": ("py", "md"),
    "fr": ("rs", "toml"),
    "de": ("go", "xyz"),
    "es": ("inc", "txt"),
}


def code_path() -> Column:
    ext = F.lit("txt")
    for lang, (long, short) in EXTENSIONS.items():
        by_length = F.when(F.col("n_chars") > 1500, long).otherwise(short)
        ext = F.when(F.col("lang") == lang, by_length).otherwise(ext)
    return F.concat(F.col("source"), F.lit("/doc_"), F.col("doc_id"), F.lit("."), ext)


def stored_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """The chunk table: one chunk per document that has a vector."""
    docs = table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"),
        doc_path().alias("file_path"),
        F.col("lang").alias("language"),
        F.col("text").alias("content"),
        F.lit(1).alias("start_line"),
        F.size(F.split("text", "\n", -1)).alias("end_line"),
    )
    stored = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return docs.join(stored, "id")


def first_vector(spark: SparkSession, folder: str) -> list[float]:
    """The query vector: the one stored under id 0."""
    return table(spark, folder, "embeddings").where("vec_id = 0").first()["embedding"]


SQL_PATH = "concat(source, '/', lang, '/doc_', doc_id, '.txt')"
SQL_CODE_PATH = """concat(source, '/doc_', doc_id, '.', CASE lang
WHEN 'en' THEN if(n_chars > 1500, 'py', 'md') WHEN 'fr' THEN if(n_chars > 1500, 'rs', 'toml')
WHEN 'de' THEN if(n_chars > 1500, 'go', 'xyz') WHEN 'es' THEN if(n_chars > 1500, 'inc', 'txt')
ELSE 'txt' END)"""
SQL_CHUNKS = f"""
c AS (SELECT d.doc_id AS id, {SQL_PATH} AS file_path, d.lang AS language, d.text AS content,
             1 AS start_line, len(string_split(d.text, chr(10))) AS end_line, e.embedding
      FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id),
q AS (SELECT embedding FROM embeddings WHERE vec_id = 0),
r AS (SELECT c.*, list_distance(c.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS distance
      FROM c CROSS JOIN q)"""


def _knn_sql(where: str, page: str) -> str:
    return f"""WITH {SQL_CHUNKS}
SELECT id, file_path, language, round(1 - distance * distance / 2, 6) AS score
FROM r {where} ORDER BY distance, id {page}"""


def _knn(spark: SparkSession, folder: str, **spec) -> DataFrame:
    chunks = stored_chunks(spark, folder).select("id", "file_path", "language", "embedding")
    page = top(chunks, SearchSpec(first_vector(spark, folder), **spec))
    return page.select("id", "file_path", "language", F.round("score", 6).alias("score"))


# Search


@query(_knn_sql("", "LIMIT 10"))
def knn(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest chunks."""
    return _knn(spark, folder, limit=10)


@query(
    """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
d AS (SELECT q.vec_id AS query_id, v.vec_id AS id, list_distance(v.e, q.e) AS distance FROM v CROSS JOIN v q WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM d)
SELECT query_id, rank::INT AS rank, id, round(1 - distance * distance / 2, 6) AS score FROM r WHERE rank <= 10"""
)
def knn_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest vectors for every fiftieth one, against all."""
    rows = table(spark, folder, "embeddings").withColumnRenamed("vec_id", "id")
    wanted = rows.where("id % 50 = 0").withColumnRenamed("id", "query_id")
    found = vectors.nearest_batch(rows, wanted, 10)
    return found.select("query_id", "rank", "id", F.round("score", 6).alias("score"))


@query(_knn_sql("WHERE language = 'fr'", "LIMIT 5 OFFSET 3"))
def knn_lang(spark: SparkSession, folder: str) -> DataFrame:
    """The second page within one language."""
    return _knn(spark, folder, limit=5, offset=3, languages=["fr"])


@query(_knn_sql("WHERE language IN ('de', 'fr')", "LIMIT 7 OFFSET 2"))
def knn_multi(spark: SparkSession, folder: str) -> DataFrame:
    """Several languages in one pass; a language named twice counts once."""
    return _knn(spark, folder, limit=7, offset=2, languages=["de", "fr", "de"])


@query(
    _knn_sql(
        "WHERE language IN ('es', 'en') AND (file_path GLOB 'src1*' OR file_path GLOB '*/es/*')",
        "LIMIT 10",
    )
)
def knn_path(spark: SparkSession, folder: str) -> DataFrame:
    """Path globs and languages together."""
    return _knn(spark, folder, limit=10, languages=["es", "en"], paths=["src1*", "*/es/*"])


@query(_knn_sql("WHERE file_path GLOB 'src1[2-5]/??/doc_*[02468].txt'", "LIMIT 20 OFFSET 1"))
def knn_path_classes(spark: SparkSession, folder: str) -> DataFrame:
    """A path glob with classes and single-character wildcards, no language."""
    return _knn(spark, folder, limit=20, offset=1, paths=["src1[2-5]/??/doc_*[02468].txt"])


@query(
    f"""WITH {SQL_CHUNKS}
SELECT file_path, language, content, start_line::INT AS start_line, end_line::INT AS end_line,
       round(1 - distance * distance / 2, 6) AS score
FROM r WHERE language IN ('en', 'fr') ORDER BY distance, id LIMIT 8 OFFSET 2"""
)
def search_page(spark: SparkSession, folder: str) -> DataFrame:
    """The six result columns, text fetched for the winners only."""
    spec = SearchSpec(first_vector(spark, folder), 8, 2, languages=["en", "fr"])
    found = search(stored_chunks(spark, folder), spec)
    return found.withColumn("score", F.round("score", 6))


@query(
    f"""WITH {SQL_CHUNKS},
n AS (SELECT file_path, language, start_line, end_line, 1 - distance * distance / 2 AS score,
             row_number() OVER (ORDER BY distance, id) AS rank FROM r QUALIFY rank <= 10)
SELECT rank::INT AS rank, printf('--- Result %d (score: %.3f) ---', rank, score) AS heading,
       printf('File: %s:%d-%d [%s]', file_path, start_line, end_line, language) AS place FROM n"""
)
def search_report(spark: SparkSession, folder: str) -> DataFrame:
    """Ranked headings and places as printed."""
    spec = SearchSpec(first_vector(spark, folder), 10)
    return report(search(stored_chunks(spark, folder), spec, ranked=True)).drop("content")


LETTERS = "abcdefghijklmnopqrstuvwxyz"
QUERY_TEXT = "the quick search of the index"


def _letters_sql(value: str) -> str:
    counts = ", ".join(
        f"(length(lower({value})) - length(replace(lower({value}), '{c}', '')))::DOUBLE"
        for c in LETTERS
    )
    return f"[{counts}]"


SQL_UNIT = (
    "list_transform({v}, lambda x: x / greatest(sqrt(list_sum("
    "list_transform({v}, lambda y: y * y))), 1e-9))"
)


def _embedded_sql(source: str, value: str) -> str:
    """CTEs ``v`` (source rows with 32-bit vectors ``e``) and ``qv``."""
    return f"""
v0 AS (SELECT *, {_letters_sql(value)} AS l FROM {source}),
v AS (SELECT * EXCLUDE (l), {SQL_UNIT.format(v="l")}::FLOAT[]::DOUBLE[] AS e FROM v0),
q0 AS (SELECT {_letters_sql(f"'{QUERY_TEXT}'")} AS l),
qv AS (SELECT {SQL_UNIT.format(v="l")}::FLOAT[]::DOUBLE[] AS e FROM q0)"""


@query(
    f"""WITH {_embedded_sql("documents", "text")}
SELECT doc_id, round(1 - pow(list_distance(v.e, qv.e), 2) / 2, 6) AS score
FROM v CROSS JOIN qv ORDER BY list_distance(v.e, qv.e), doc_id LIMIT 10"""
)
def text_search(spark: SparkSession, folder: str) -> DataFrame:
    """Query text and documents through the same embedder, then the nearest ten."""
    embedder = embedding.LetterEmbedder()
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    rows = embedding.embed_texts(docs, embedder, "text").select("id", "embedding")
    wanted = embedding.embed_query(spark, embedder, QUERY_TEXT)
    page = top(rows, SearchSpec(wanted, 10))
    return page.select(F.col("id").alias("doc_id"), F.round("score", 6).alias("score"))


@query(
    f"""WITH {_embedded_sql("documents", "text")}
SELECT doc_id, unnest(range(26))::INT AS dim, round(unnest(e), 5) AS weight FROM v"""
)
def embed_letters(spark: SparkSession, folder: str) -> DataFrame:
    """Document vectors, one row per component."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rows = embedding.embed_texts(docs, embedding.LetterEmbedder(), "text")
    return rows.select(
        "doc_id", F.posexplode(F.col("embedding").cast("array<double>")).alias("dim", "weight")
    ).withColumn("weight", F.round("weight", 5))


@query(
    f"""WITH t AS (SELECT conv_id, turn, text FROM conversations),
{_embedded_sql("t", "text")}
SELECT dim, count(*) AS n_rows, count(DISTINCT text) AS n_embedded, round(sum(e[dim + 1]), 2) AS total
FROM v, unnest(range(26)) u(dim) GROUP BY dim"""
)
def embed_memo(spark: SparkSession, folder: str) -> DataFrame:
    """Equal texts are embedded once and every row gets its vector, all 26 components."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    target = scratch_dir(spark, "vectors")
    done = embedding.embed_once(
        embedding.with_text_key(rows, "text"), embedding.LetterEmbedder(), "text", None, target
    )
    made = spark.read.schema(embedding.CACHE_SCHEMA).parquet(target)
    parts = F.posexplode(F.col("embedding").cast("array<double>")).alias("dim", "weight")
    whole = done.select(F.lit(1).alias("row"), F.lit(0).alias("text"), parts)
    once = made.select(F.lit(0).alias("row"), F.lit(1).alias("text"), parts).withColumn("weight", F.lit(0.0))
    sums = whole.unionByName(once).groupBy(F.col("dim").cast("bigint").alias("dim"))
    return sums.agg(
        F.sum("row").alias("n_rows"), F.sum("text").alias("n_embedded"), F.round(F.sum("weight"), 2).alias("total")
    )


# File selection


def _rx(pattern: str, column: str = "file_path") -> str:
    return f"regexp_matches({column}, '{pattern}')"


@query(
    f"""WITH f AS (SELECT {SQL_PATH} AS file_path, strlen(text) AS length FROM documents)
SELECT file_path, length FROM f
WHERE ({_rx("^src1[^/]*/")} OR {_rx("[05]\\.txt$")})
  AND NOT {_rx("^[^/]+/es/")} AND NOT {_rx("^src7/")} AND length <= 5000"""
)
def files_selected(spark: SparkSession, folder: str) -> DataFrame:
    """Include globs, exclude globs that close directories, and the size cap."""
    rules = Selection(["src1*/**", "**/*[05].txt"], ["**/es", "src7/**"], 5000, False)
    return corpus.select_files(doc_files(spark, folder), rules).select("file_path", "length")


IGNORE_FILES = [
    ("", "# generated\nsrc3/\n/src4/de\n*_11.txt\nfr/\n!src5/fr/\n"),
    ("src1", "de/\n*7.txt\n!doc_17.txt\n"),
    ("src5/fr", "doc_*5.txt\n/doc_65.txt\n"),
    ("src6", "*.txt\n!en/*.txt\n"),
]


@query(
    f"""WITH f AS (SELECT {SQL_PATH} AS file_path FROM documents)
SELECT file_path FROM f
WHERE NOT {_rx("^src3/")} AND NOT {_rx("^src4/de/")}
  AND NOT ({_rx("_11\\.txt$")} AND NOT {_rx("^src6/en/")})
  AND NOT ({_rx("/fr/")} AND NOT {_rx("^src5/")})
  AND NOT {_rx("^src1/de/")}
  AND NOT ({_rx("^src1/.*7\\.txt$")} AND NOT {_rx("/doc_17\\.txt$")})
  AND NOT {_rx("^src5/fr/doc_[^/]*5\\.txt$")}
  AND NOT ({_rx("^src6/")} AND NOT {_rx("^src6/en/")})"""
)
def files_ignored(spark: SparkSession, folder: str) -> DataFrame:
    """Nested ignore files with negation and closed directories."""
    rules = spark.createDataFrame(IGNORE_FILES, "dir string, rules string")
    everything = Selection((), ())
    return corpus.select_files(doc_files(spark, folder), everything, rules).select("file_path")


@query("SELECT doc_id, strlen(text) AS length FROM documents WHERE strlen(text) <= 5000")
def size_cap(spark: SparkSession, folder: str) -> DataFrame:
    rules = Selection((), (), 5000, False)
    files = doc_files(spark, folder)
    return files.where(rules.file_column(F.col("file_path"), F.col("length"))).select(
        "doc_id", "length"
    )


@query(
    f"""WITH f AS (SELECT {SQL_PATH} AS file_path, strlen(text) AS length, md5(text) AS digest FROM documents)
SELECT * FROM f WHERE file_path LIKE 'src1%' AND file_path LIKE '%.txt' AND length <= 2000"""
)
def tree_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents written as a tree, walked and read back by the data source, which opens what is wanted."""
    base = tree.mounted(scratch_dir(spark, "tree"))
    tree.write_files(doc_files(spark, folder), base)
    walk = tree.walk(spark, base, Selection())
    listing, result = scratch_dir(spark, "listing"), scratch_dir(spark, "tree-files")
    codefiles.save_listing(walk.files, listing)
    files = codefiles.open_files(spark, base, listing, ["src1"], [".txt"], 2000)
    # The digests are stored, and the tree goes; the driver only removes what tasks have left of it.
    files.select("file_path", "length", F.md5("content").alias("digest")).write.parquet(result)
    tree.empty_dirs(spark.read.schema(LISTING).parquet(listing), base)
    for left in (base, listing):
        Storage(spark, left).delete()
    walk.release()
    return spark.read.parquet(result)


@query(
    r"""SELECT lang, count(*) AS n_files, sum(length(text))::BIGINT AS n_chars FROM documents
WHERE regexp_matches(text, '[^\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]')
GROUP BY lang"""
)
def readable_files(spark: SparkSession, folder: str) -> DataFrame:
    """Decodable files that are not blank."""
    rows = chunking.readable(doc_files(spark, folder))
    return rows.groupBy("lang").agg(
        F.count("*").alias("n_files"), F.sum(F.length("content")).alias("n_chars")
    )


SQL_LANGUAGE = """CASE regexp_extract(file_path, '\\.([^./]+)$', 1) WHEN 'py' THEN 'python'
WHEN 'rs' THEN 'rust' WHEN 'go' THEN 'go' WHEN 'md' THEN 'markdown' WHEN 'toml' THEN 'toml'
WHEN 'inc' THEN 'php' ELSE 'text' END"""


@query(
    f"""WITH f AS (SELECT doc_id, {SQL_CODE_PATH} AS file_path FROM documents)
SELECT doc_id, file_path, concat('.', regexp_extract(file_path, '\\.([^./]+)$', 1)) AS suffix,
       {SQL_LANGUAGE} AS language FROM f"""
)
def file_languages(spark: SparkSession, folder: str) -> DataFrame:
    """Override first, then the extension table, then text."""
    docs = table(spark, folder, "documents").select("doc_id", code_path().alias("file_path"))
    return docs.withColumns(
        {
            "suffix": text.path_suffix(F.col("file_path")),
            "language": language_of(F.col("file_path"), {"inc": "php"}),
        }
    )


SEARCH_GLOBS = ["src1*", "*/es/*", "src?/*", "*doc_1[0-4]*", "src1[02468]/en/doc_*.txt", "*.md"]


@query(
    f"""WITH f AS (SELECT {SQL_PATH} AS file_path FROM documents),
g AS (SELECT unnest({SEARCH_GLOBS!r}) AS pattern)
SELECT pattern, count(*) FILTER (file_path GLOB pattern) AS n_files FROM f, g GROUP BY pattern"""
)
def search_globs(spark: SparkSession, folder: str) -> DataFrame:
    """Files per path glob in the dialect of search, in one scan."""
    files = table(spark, folder, "documents").select(doc_path().alias("file_path"))
    return _count_globs(files, SEARCH_GLOBS, lambda g: globs.search_glob(F.col("file_path"), [g]))


def _count_globs(files: DataFrame, patterns: list[str], test: Callable[[str], Column]) -> DataFrame:
    counts = files.agg(*[F.count_if(test(g)).alias(f"n{i}") for i, g in enumerate(patterns)])
    pairs = F.array(
        *[F.struct(F.lit(g).alias("pattern"), F.col(f"n{i}").alias("n_files")) for i, g in enumerate(patterns)]
    )
    return counts.select(F.inline(pairs))


PATH_GLOBS = {
    "src1/**": "^src1/",
    "**/es/*": "^(.*/)?es/[^/]*$",
    "*/doc_1.txt": "^[^/]*/doc_1\\.txt$",
    "**/doc_?{1,5}.txt": "^(.*/)?doc_[^/](1|5)\\.txt$",
    "src[!1]/**/*.txt": "^src[^1/]/(.*/)?[^/]*\\.txt$",
}


@query(
    f"""WITH f AS (SELECT {SQL_PATH} AS file_path FROM documents)
"""
    + " UNION ALL ".join(
        f"SELECT '{g}' AS pattern, count(*) FILTER ({_rx(r)}) AS n_files FROM f"
        for g, r in PATH_GLOBS.items()
    )
)
def path_globs(spark: SparkSession, folder: str) -> DataFrame:
    """Files per path glob in the dialect of include patterns and grep."""
    files = table(spark, folder, "documents").select(doc_path().alias("file_path"))
    return _count_globs(files, list(PATH_GLOBS), lambda g: globs.path_glob(F.col("file_path"), [g]))


# Statistics


@query(
    """SELECT coalesce(nullif(concat('.', regexp_extract(regexp_extract(url, '[^/]*$'),
       '^.+\\.([^./]+)$', 1)), '.'), '(no ext)') AS ext, count(*) AS cnt FROM pages GROUP BY 1"""
)
def ext_hist(spark: SparkSession, folder: str) -> DataFrame:
    """Files per extension."""
    return stats.by_extension(table(spark, folder, "pages"), "url")


def _turns(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations").select(
        F.concat(F.lit("conv_"), "conv_id").alias("file_path"), F.col("role").alias("language")
    )


@query("SELECT count(*) AS total_chunks, count(DISTINCT conv_id) AS total_files FROM conversations")
def status_total(spark: SparkSession, folder: str) -> DataFrame:
    return stats.totals(_turns(spark, folder))


@query("SELECT role AS language, count(*) AS cnt FROM conversations GROUP BY role")
def status_lang(spark: SparkSession, folder: str) -> DataFrame:
    return stats.by_language(_turns(spark, folder))


@query(
    f"""WITH f AS (SELECT {SQL_PATH} AS file_path, lang FROM documents),
g AS (SELECT lang, count(*) AS cnt, count(DISTINCT file_path) AS files FROM f GROUP BY lang)
SELECT sum(cnt)::BIGINT AS total_chunks, sum(files)::BIGINT AS total_files,
       string_agg(concat(lang, '=', cnt), ',' ORDER BY lang) AS languages FROM g"""
)
def status_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The one-row status, its language map as text."""
    files = doc_files(spark, folder).select("file_path", F.col("lang").alias("language"))
    pairs = F.array_sort(
        F.transform(F.map_entries("languages"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    )
    return stats.summary(stats.partial_counts(files)).withColumn("languages", F.array_join(pairs, ","))


# Chunks


@query(
    """WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)
SELECT doc_id, i::INT AS line_no, regexp_replace(l[i], '\\r+$', '') AS line
FROM l, unnest(range(1, len(l) + 1)) u(i)"""
)
def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every line with its number."""
    docs = table(spark, folder, "documents")
    rows = docs.select("doc_id", F.posexplode(text.lines_of(F.col("text"))).alias("i", "line"))
    return rows.select("doc_id", (F.col("i") + 1).alias("line_no"), "line")


@query(
    """WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
n AS (SELECT doc_id, i, length(l[i]) + 1 AS n FROM l, unnest(range(1, len(l) + 1)) u(i))
SELECT doc_id, i::INT AS line_no, coalesce(sum(n) OVER (PARTITION BY doc_id ORDER BY i
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS char_offset FROM n"""
)
def line_starts(spark: SparkSession, folder: str) -> DataFrame:
    """Character offset of every line."""
    docs = table(spark, folder, "documents")
    return docs.select(
        "doc_id", F.posexplode(text.line_offsets(F.col("text"))).alias("i", "char_offset")
    ).select("doc_id", (F.col("i") + 1).alias("line_no"), "char_offset")


def _chunks_sql(source: str, definition: str | None = None) -> str:
    """CTE ``k``: the default splitter over ``source`` (doc_id, lang, text).

    Lines that match ``definition`` start a definition of the language.
    """
    mark = "1 + after_blank::INT"
    if definition:
        mark = f"CASE WHEN regexp_matches(line, '{definition}') THEN 3 ELSE {mark} END"
    space = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
    cut = r"(?s).{1,850}\z|.{0,849}[ \t\n\r\f\v]|.{1,850}"
    return f"""
s0 AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM {source}),
s1 AS (SELECT doc_id, i, l[i] AS line, i > 1 AND trim(l[i - 1], {space}) = '' AS after_blank
       FROM s0, unnest(range(1, len(l) + 1)) u(i)),
s2 AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off FROM s1),
s3 AS (SELECT doc_id, off, regexp_extract_all(concat(line, chr(10)), '{cut}') AS cuts
       FROM s2 WHERE length(line) + 1 > 850),
s4 AS (SELECT doc_id, off, j, length(cuts[j]) AS n FROM s3, unnest(range(1, len(cuts) + 1)) u(j)),
s5 AS (SELECT doc_id, j, (off + coalesce(sum(n) OVER (PARTITION BY doc_id, off ORDER BY j
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS off FROM s4),
place AS (SELECT doc_id, off, mark, row_number() OVER (PARTITION BY doc_id ORDER BY off) AS i
          FROM (SELECT doc_id, off, {mark} AS mark FROM s2
                UNION ALL SELECT doc_id, off, 0 FROM s5 WHERE j > 1)),
total AS (SELECT doc_id, length(text) AS n FROM {source}),
step AS (SELECT a.doc_id, a.i,
                arg_max(b.i, (CASE WHEN b.off - a.off >= 250 THEN b.mark ELSE -1 END) * 1000000 + b.i)
                  AS nxt
         FROM place a JOIN total t ON t.doc_id = a.doc_id
         JOIN place b ON b.doc_id = a.doc_id AND b.i > a.i AND b.off - a.off <= 850
         WHERE t.n - a.off > 850 GROUP BY ALL),
chain AS (WITH RECURSIVE w AS (
            SELECT doc_id, 1::BIGINT AS i FROM {source}
            UNION ALL SELECT w.doc_id, step.nxt FROM w JOIN step USING (doc_id, i))
          SELECT * FROM w),
body AS (SELECT doc_id, i, lag(i) OVER o AS before, lead(i) OVER o AS following
         FROM chain WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
span AS (SELECT b.doc_id, b.i, any_value(coalesce(z.off, t.n)) AS stop,
                least(any_value(p.off), coalesce(min(y.off), any_value(p.off))) AS start
         FROM body b JOIN total t ON t.doc_id = b.doc_id
         JOIN place p ON p.doc_id = b.doc_id AND p.i = b.i
         LEFT JOIN place z ON z.doc_id = b.doc_id AND z.i = b.following
         LEFT JOIN place y ON y.doc_id = b.doc_id AND y.i > b.before AND y.i < b.i
                          AND p.off - y.off <= 150
         GROUP BY b.doc_id, b.i),
raw AS (SELECT x.doc_id, d.lang, d.text, start, substr(d.text, (start + 1)::BIGINT, (stop - start)::BIGINT) AS piece
        FROM span x JOIN {source} d ON d.doc_id = x.doc_id),
k AS (SELECT doc_id, lang, trim(piece, {space}) AS content,
             start + length(piece) - length(ltrim(piece, {space})) AS start_char,
             length(text) - length(replace(text, chr(10), '')) AS newlines,
             1 + length(left(text, (start + length(piece) - length(ltrim(piece, {space})))::BIGINT))
               - length(replace(left(text, (start + length(piece) - length(ltrim(piece, {space})))::BIGINT),
                                chr(10), '')) AS start_line
      FROM raw WHERE trim(piece, {space}) <> '')"""


@query(
    f"""WITH {_chunks_sql("documents")}
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY start_char) - 1)::INT AS chunk_no,
       start_char::INT AS start_char, start_line::INT AS start_line,
       (start_line + length(content) - length(replace(content, chr(10), '')))::INT AS end_line,
       content FROM k"""
)
def chunk_default(spark: SparkSession, folder: str) -> DataFrame:
    """Every chunk the default splitter makes of the documents."""
    texts = table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("file_path"),
        F.lit("text").alias("language"),
        F.col("text").alias("content"),
    )
    return chunking.chunk_files(texts).select(
        F.col("file_path").cast("bigint").alias("doc_id"),
        "chunk_no",
        F.col("start.char_offset").alias("start_char"),
        F.col("start.line").alias("start_line"),
        F.col("end.line").alias("end_line"),
        "content",
    )


# Lines that begin with a vowel are written as definitions, so that there are many.
SQL_CODE_TEXTS = "t AS (SELECT doc_id, lang, regexp_replace(text, '(^|\\n)([AEIO])', '\\1def \\2', 'g') AS text FROM documents)"


@query(
    f"""WITH {SQL_CODE_TEXTS}, {_chunks_sql("t", "^def [A-Z]")}
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY start_char) - 1)::INT AS chunk_no,
       start_char::INT AS start_char, start_line::INT AS start_line, content FROM k"""
)
def chunk_code(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks of texts in a programming language, which may start at its definitions."""
    texts = table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("file_path"),
        F.lit("python").alias("language"),
        F.regexp_replace("text", r"(^|\n)([AEIO])", "$1def $2").alias("content"),
    )
    return chunking.chunk_files(texts).select(
        F.col("file_path").cast("bigint").alias("doc_id"),
        "chunk_no",
        F.col("start.char_offset").alias("start_char"),
        F.col("start.line").alias("start_line"),
        "content",
    )


def _custom_rest_sql() -> str:
    """Default chunks of the documents that no custom chunker takes."""
    return f"""WITH d AS (SELECT doc_id, lang, text, {SQL_CODE_PATH} AS p FROM documents), t AS (SELECT * FROM d WHERE p NOT LIKE '%.toml' AND p NOT LIKE '%.rs'),
{_chunks_sql("t")} SELECT p AS file_path, 'text' AS language, (row_number() OVER (PARTITION BY p ORDER BY start_char) - 1)::INT AS chunk_no,
       start_line::INT AS line_no, content FROM k JOIN (SELECT doc_id, p FROM t) w ON w.doc_id = k.doc_id"""


def line_chunker(path, content: str) -> tuple[str | None, list[chunking.Chunk]]:
    """A custom chunker: every line that is not empty, in a language of its own."""
    chunks, offset, size = [], 0, 0
    for number, line in enumerate(content.split("\n"), 1):
        if line:
            start = chunking.Position(size, offset, number, 0)
            end = chunking.Position(size + len(line.encode()), offset + len(line), number, len(line))
            chunks.append(chunking.Chunk(line, start, end))
        offset, size = offset + len(line) + 1, size + len(line.encode()) + 1
    return ("lines" if path.suffix == ".toml" else None), chunks


@query(
    f"""WITH f AS (SELECT doc_id, {SQL_CODE_PATH} AS p, string_split(text, chr(10)) AS l FROM documents)
SELECT p AS file_path, CASE WHEN p LIKE '%.toml' THEN 'lines' ELSE 'rust' END AS language,
       (row_number() OVER (PARTITION BY p ORDER BY i) - 1)::INT AS chunk_no, i::INT AS line_no, l[i] AS content
FROM f, unnest(range(1, len(l) + 1)) u(i) WHERE (p LIKE '%.toml' OR p LIKE '%.rs') AND l[i] <> ''
UNION ALL
SELECT file_path, language, chunk_no, line_no, content FROM ({_custom_rest_sql()})"""
)
def chunk_custom(spark: SparkSession, folder: str) -> DataFrame:
    """All documents by a table function: a user's chunker for two suffixes, the default one for the rest.

    For one suffix the chunker also names the language. The rest is taken for plain text.
    """
    function = chunking.chunk_function({".toml": line_chunker, ".rs": line_chunker})
    path = code_path()
    language = F.when(path.endswith(".rs"), "rust").otherwise("text")
    files = table(spark, folder, "documents").select(
        path.alias("file_path"), language.alias("language"), F.col("text").alias("content")
    )
    return chunking.lateral_chunks(files, function).select(
        "file_path", "language", "chunk_no", F.col("start.line").alias("line_no"), "content"
    )


@query(
    f"""WITH {_chunks_sql("documents")},
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY start_char) - 1 AS chunk_no FROM k),
{_embedded_sql("n", "content")}
SELECT v.doc_id, v.chunk_no::INT AS chunk_no, v.lang AS language, v.start_line::INT AS start_line,
       round(1 - pow(list_distance(v.e, qv.e), 2) / 2, 6) AS score
FROM v CROSS JOIN qv WHERE v.lang IN ('en', 'fr')
ORDER BY list_distance(v.e, qv.e), doc_id * 100000 + chunk_no LIMIT 10"""
)
def chunk_search(spark: SparkSession, folder: str) -> DataFrame:
    """From text to result: split, embed, search within two languages."""
    texts = table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("file_path"),
        F.col("lang").alias("language"),
        F.col("text").alias("content"),
    )
    embedder = embedding.LetterEmbedder()
    chunks = chunking.chunk_files(texts.where(F.col("language").isin("en", "fr")))
    rows = embedding.embed_texts(chunks, embedder, "content").select(
        (F.col("file_path").cast("bigint") * 100000 + F.col("chunk_no")).alias("id"),
        F.col("file_path"),
        "language",
        "chunk_no",
        F.col("start.line").alias("start_line"),
        "embedding",
    )
    wanted = embedding.embed_query(spark, embedder, QUERY_TEXT)
    page = top(rows, SearchSpec(wanted, 10, languages=["en", "fr"]))
    return page.select(
        F.col("file_path").cast("bigint").alias("doc_id"),
        "chunk_no",
        "language",
        "start_line",
        F.round("score", 6).alias("score"),
    )


@query(
    """WITH s AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents WHERE trim(text) <> ''),
l AS (SELECT doc_id, i, l[i] AS line FROM s, unnest(range(1, len(l) + 1)) u(i)),
h AS (SELECT *, sum(CASE WHEN regexp_matches(line, '^[A-D]') THEN 1 ELSE 0 END)
             OVER (PARTITION BY doc_id ORDER BY i) AS section FROM l),
g AS (SELECT doc_id, section, min(i) AS start_line, max(i) AS end_line,
             regexp_replace(regexp_replace(string_agg(line, chr(10) ORDER BY i), '^\\s+', ''), '\\s+$', '') AS body
      FROM h WHERE section > 0 GROUP BY doc_id, section)
SELECT doc_id, section::INT AS section, start_line::INT AS start_line, end_line::INT AS end_line,
       length(body)::BIGINT AS n_chars, md5(body) AS digest FROM g WHERE body <> ''
UNION ALL
SELECT doc_id, 1, 1, len(l)::INT, length(text)::BIGINT, md5(text) FROM s
WHERE doc_id NOT IN (SELECT doc_id FROM g)"""
)
def sections(spark: SparkSession, folder: str) -> DataFrame:
    """Section chunks of every document; one without a header is one chunk."""
    docs = table(spark, folder, "documents").where(text.is_not_blank(F.col("text")))
    files = docs.select(F.col("doc_id").cast("string").alias("file_path"), F.col("text").alias("content"))
    return chunking.section_chunks(files, "^[A-D]").select(
        F.col("file_path").cast("bigint").alias("doc_id"),
        "section",
        "start_line",
        "end_line",
        F.length("content").cast("bigint").alias("n_chars"),
        F.md5(F.col("content").cast("binary")).alias("digest"),
    )


# Snapshots and the index

SQL_SNAPSHOTS = """
o AS (SELECT doc_id, text FROM documents),
n AS (SELECT d.doc_id, CASE WHEN l.quality = 0 THEN lower(d.text) ELSE d.text END AS text
      FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
      WHERE coalesce(l.toxic, 0) = 0
      UNION ALL SELECT -1 - item_id, text FROM benchmark)"""

SQL_ACTIONS = f"""WITH {SQL_SNAPSHOTS},
a AS (SELECT CASE WHEN n.doc_id IS NULL THEN 'delete' WHEN o.doc_id IS NULL THEN 'add'
             WHEN o.text <> n.text THEN 'reprocess' ELSE 'unchanged' END AS action
      FROM o FULL OUTER JOIN n ON o.doc_id = n.doc_id)"""


def snapshots(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Documents before and after an edit: some removed, some rewritten, some added."""
    docs = doc_files(spark, folder)
    labels = table(spark, folder, "labels")
    text_now = F.when(F.col("quality") == 0, F.lower(F.col("content").cast("string")).cast("binary"))
    edited = (
        docs.join(labels, "doc_id", "left")
        .where(F.coalesce("toxic", F.lit(0)) == 0)
        .withColumn("content", F.coalesce(text_now, "content"))
    )
    added = table(spark, folder, "benchmark").select(
        (F.lit(-1) - F.col("item_id")).alias("doc_id"),
        F.lit("en").alias("lang"),
        F.concat(F.lit("items/"), "item_id", F.lit(".txt")).alias("file_path"),
        F.col("text").cast("binary").alias("content"),
    )
    columns = ["doc_id", "lang", "file_path", "content"]
    return docs.select(*columns), edited.select(*columns).unionByName(added)


def _marked(files: DataFrame) -> DataFrame:
    return files.select("doc_id", F.sha2("content", 256).alias("fingerprint"))


@query(f"{SQL_ACTIONS} SELECT action, count(*) AS cnt FROM a GROUP BY action")
def snapshot_diff(spark: SparkSession, folder: str) -> DataFrame:
    """What happened to each file between two snapshots, counted."""
    old, new = snapshots(spark, folder)
    return diff(_marked(old), _marked(new), "doc_id").groupBy("action").agg(F.count("*").alias("cnt"))


@query(
    f"""{SQL_ACTIONS} SELECT count(*) FILTER (action <> 'delete') AS num_execution_starts,
count(*) FILTER (action = 'add') AS num_adds, count(*) FILTER (action = 'delete') AS num_deletes,
count(*) FILTER (action = 'reprocess') AS num_reprocesses,
count(*) FILTER (action = 'unchanged') AS num_unchanged, 0::BIGINT AS num_errors FROM a"""
)
def refresh_counters(spark: SparkSession, folder: str) -> DataFrame:
    """The counters of a refresh as one row."""
    old, new = snapshots(spark, folder)
    return stats.action_counters(diff(_marked(old), _marked(new), "doc_id"))


@query(
    f"""WITH {SQL_SNAPSHOTS}, t AS (SELECT doc_id, '' AS lang, text FROM n), {_chunks_sql("t")},
{_embedded_sql("k", "content")}
SELECT CASE WHEN doc_id < 0 THEN 'items' ELSE 'documents' END AS origin, count(*) AS n_chunks,
       count(*) AS n_ids, count(DISTINCT doc_id) AS n_files, sum(length(content))::BIGINT AS n_chars,
       sum(start_line)::BIGINT AS sum_line, round(sum(e[1]), 2) AS sum_a, round(sum(e[26]), 2) AS sum_z
FROM v GROUP BY 1"""
)
def index_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Build an index, refresh it with the edited files and read what is live: texts, ids and vectors."""
    index = Index(spark, scratch_dir(spark, "index"), embedding.LetterEmbedder())
    for files in snapshots(spark, folder):
        index.refresh(corpus.from_table(files))
    origin = F.when(F.col("file_path").startswith("items/"), "items").otherwise("documents")

    def total(k: int) -> Column:
        return F.round(F.sum(F.get("embedding", F.lit(k)).cast("double")), 2)

    return (
        index.chunks()
        .groupBy(origin.alias("origin"))
        .agg(
            F.count("*").alias("n_chunks"),
            F.countDistinct("file_path", "id").alias("n_ids"),
            F.countDistinct("file_path").alias("n_files"),
            F.sum(F.length("content")).alias("n_chars"),
            F.sum("start_line").alias("sum_line"),
            total(0).alias("sum_a"),
            total(25).alias("sum_z"),
        )
    )


# Structural matching


def _page_files(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select(
        F.concat(F.lit("page_"), "page_id", F.lit(".html")).alias("file_path"), "html"
    )
    return corpus.from_table(pages, "file_path", "html")


SQL_PAGE_TEXT = r"regexp_replace(html, '<!--(?:[^-]|-[^-]|--[^>])*-->', ' ', 'g')"


@query(
    rf"""WITH m AS (SELECT page_id, unnest(regexp_extract_all({SQL_PAGE_TEXT},
'<\s*a\s+href\s*=("[^"]*")\s*>', 1)) AS url FROM pages)
SELECT concat('page_', page_id, '.html') AS path, url, count(*) AS n FROM m GROUP BY ALL"""
)
def grep_links(spark: SparkSession, folder: str) -> DataFrame:
    """Link targets captured from markup."""
    found = structural.grep(_page_files(spark, folder), r"<a href=\URL>", ["HTML"]).matches
    return found.groupBy("path", F.element_at("captures", F.lit("URL")).alias("url")).agg(
        F.count("*").alias("n")
    )


@query(
    r"""WITH m AS (SELECT page_id, unnest(regexp_extract_all(html, '\w+\(\s*\w*\s*\)\s*;')) AS c FROM pages)
SELECT concat('page_', page_id, '.html') AS path, regexp_extract(c, '^\w+') AS name,
       regexp_extract(c, '\(\s*(\w*)', 1) AS args FROM m"""
)
def grep_calls(spark: SparkSession, folder: str) -> DataFrame:
    """Calls with their arguments, a run of siblings between paired brackets."""
    found = structural.grep(_page_files(spark, folder), r"\NAME(\(ARGS*\));").matches
    return found.select(
        "path",
        F.element_at("captures", F.lit("NAME")).alias("name"),
        F.element_at("captures", F.lit("ARGS")).alias("args"),
    )


# Documents read as data files: words, numbers, double-quoted strings, brackets.
SQL_TOKENS = r"""
t AS (SELECT doc_id, regexp_extract_all(text,
       '"(?:\\.|[^"\\\n])*"|[\p{L}\p{M}_][\p{L}\p{M}\p{N}_]*|[0-9][\p{L}\p{M}\p{N}_.]*|'
       || '->|=>|::|:=|\.\.\.|===|!==|[=!<>]=|&&|\|\||<<|>>|[-+*/%&|^]=|\*\*|[^\s]') AS l
      FROM documents)"""


@query(
    rf"""WITH {SQL_TOKENS}
SELECT doc_id, count(*) AS n FROM t, unnest(range(1, len(l))) u(i)
WHERE l[i] = 'of' AND l[i + 1] = 'the' AND i + 2 <= len(l)
  AND regexp_matches(l[i + 2], '^[\p{{L}}0-9_"]') AND l[i + 2] <> '"' GROUP BY doc_id"""
)
def grep_phrase(spark: SparkSession, folder: str) -> DataFrame:
    """Two literal words and the node after them."""
    found = _grep_documents(spark, folder, r"of the \WORD").matches
    return found.groupBy(_doc_id()).agg(F.count("*").alias("n"))


def _grep_documents(spark: SparkSession, folder: str, pattern: str) -> structural.GrepRun:
    return structural.grep(doc_files(spark, folder), pattern, overrides={"txt": "json"})


def _doc_id() -> Column:
    return F.regexp_extract("path", r"doc_(\d+)\.", 1).cast("bigint").alias("doc_id")


@query(
    """WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
h AS (SELECT doc_id, i, l[i] AS line, (length(l[i]) - length(replace(l[i], '@', '')))::INT AS hits
      FROM l, unnest(range(1, len(l) + 1)) u(i) WHERE contains(l[i], '@')),
m AS (SELECT doc_id, i, line, unnest(range(hits)) AS x FROM h),
w AS (SELECT *, max(i) OVER (PARTITION BY doc_id) AS last FROM m)
SELECT doc_id, i::INT AS start_line,
       concat(lpad(i::VARCHAR, length(last::VARCHAR)::INT, ' '), '| ', line) AS block FROM w"""
)
def grep_render(spark: SparkSession, folder: str) -> DataFrame:
    """Matched lines with the gutter they are printed with."""
    found = structural.render(_grep_documents(spark, folder, "@").matches)
    return found.select(_doc_id(), "start_line", "block")


@query(
    f"""WITH f AS (SELECT {SQL_CODE_PATH} AS file_path FROM documents)
SELECT DISTINCT {SQL_LANGUAGE} AS language FROM f
WHERE {SQL_LANGUAGE} NOT IN ('text', 'markdown')"""
)
def grep_warnings(spark: SparkSession, folder: str) -> DataFrame:
    """One warning per language met that cannot take the pattern."""
    docs = table(spark, folder, "documents").select(code_path().alias("file_path"), "text")
    files = corpus.from_table(docs, "file_path", "text")
    run = structural.grep(files, r"def \NAME \{{ return", overrides={"inc": "php"})
    return run.language_warnings.select("language")


# Model ranking, with parts as scores: brand is the model, type and kind are the task


def _scores(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_brand").alias("model_name"),
        F.concat("p_type", F.lit("-"), F.split_part("p_name", F.lit(" "), F.lit(2))).alias("task_name"),
        # Whole numbers add up to the same total in any order.
        F.round(F.col("p_retailprice") * 10).alias("score"),
        (F.col("p_size") > 48).alias("is_public"),
    )


GENERAL_STAND_IN = ["ECONOMY-ring", "ECONOMY-bolt", "SMALL-rod"]
CODE_STAND_IN = ["SMALL-widget", "ECONOMY-gear"]
SQL_MERGED = f"""
s AS (SELECT p_brand AS model_name, concat(p_type, '-', split_part(p_name, ' ', 2)) AS task_name,
             round(p_retailprice * 10) AS score, p_size > 48 AS is_public FROM part),
g AS (SELECT model_name, avg(score) AS score_general FROM s
      WHERE task_name IN ({str(GENERAL_STAND_IN)[1:-1]}) GROUP BY model_name),
c AS (SELECT model_name, avg(score) AS score_code FROM s
      WHERE task_name IN ({str(CODE_STAND_IN)[1:-1]}) GROUP BY model_name),
m AS (SELECT coalesce(g.model_name, c.model_name) AS model_name, score_general, score_code
      FROM g FULL OUTER JOIN c ON g.model_name = c.model_name
      WHERE coalesce(g.model_name, c.model_name) IN (SELECT model_name FROM s WHERE is_public))"""


def _merged(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.merged_scores(_scores(spark, folder), GENERAL_STAND_IN, CODE_STAND_IN)


@query(
    f"""WITH {SQL_MERGED} SELECT model_name, round(score_general, 4) AS score_general,
round(score_code, 4) AS score_code FROM m"""
)
def rank_merged(spark: SparkSession, folder: str) -> DataFrame:
    """Both group means of every public model."""
    return _merged(spark, folder).select(
        "model_name",
        F.round("score_general", 4).alias("score_general"),
        F.round("score_code", 4).alias("score_code"),
    )


def _sized(models: DataFrame) -> DataFrame:
    """A size for each stand-in model, from its number."""
    number = F.regexp_extract("model_name", r"\d+", 0).cast("double")
    return models.withColumn("size_mb", number * number)


SQL_TIER = """CASE WHEN size_mb < 50 THEN 'Micro (< 50M)' WHEN size_mb < 150 THEN 'Small (< 150M)'
WHEN size_mb < 500 THEN 'Medium (< 500M)' ELSE 'Large (> 500M)' END"""


@query(
    f"""WITH {SQL_MERGED},
b AS (SELECT *, pow(regexp_extract(model_name, '\\d+')::DOUBLE, 2) AS size_mb FROM m
      ORDER BY greatest(score_general, score_code) DESC NULLS LAST, model_name LIMIT 1000),
t AS (SELECT *, {SQL_TIER} AS tier FROM b),
r AS (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY score_code DESC NULLS LAST, model_name)
             AS rank FROM t)
SELECT tier, rank::INT AS rank, model_name, round(score_code, 4) AS score_code FROM r WHERE rank <= 8"""
)
def rank_tiers(spark: SparkSession, folder: str) -> DataFrame:
    """Best models overall, then the best of each size tier."""
    models = _sized(ranking.best(_merged(spark, folder)))
    tiers = models.withColumn("tier", ranking.size_tier(F.col("size_mb")))
    return ranking.per_tier(tiers).select(
        "tier", "rank", "model_name", F.round("score_code", 4).alias("score_code")
    )


@query(
    """WITH a AS (SELECT p_partkey, p_size::DOUBLE * 5 AS size_mb, CASE WHEN p_type = 'ECONOMY'
THEN 'Encoder' WHEN p_type = 'SMALL' THEN 'Decoder' ELSE 'Unknown' END AS architecture FROM part)
SELECT p_partkey, CASE architecture WHEN 'Encoder' THEN CASE WHEN size_mb < 50 THEN 'Very Fast'
WHEN size_mb < 200 THEN 'Fast' ELSE 'Moderate' END WHEN 'Decoder' THEN 'Slow (Decoder)'
ELSE 'Unknown' END AS cpu_speed FROM a"""
)
def rank_speed(spark: SparkSession, folder: str) -> DataFrame:
    """Speed labels from architecture and size."""
    kind = (
        F.when(F.col("p_type") == "ECONOMY", "Encoder")
        .when(F.col("p_type") == "SMALL", "Decoder")
        .otherwise("Unknown")
    )
    size = F.col("p_size").cast("double") * 5
    return table(spark, folder, "part").select(
        "p_partkey", ranking.cpu_speed(kind, size).alias("cpu_speed")
    )


@query(
    """SELECT p_partkey, CASE WHEN p_size < 20 THEN p_size * 1000.0 ELSE p_size * 1.0 END AS size_mb,
CASE WHEN p_type = 'ECONOMY' THEN 'Encoder' WHEN p_type = 'SMALL' THEN 'Decoder' ELSE 'Unknown' END
AS architecture FROM part"""
)
def rank_tags(spark: SparkSession, folder: str) -> DataFrame:
    """Size and architecture read from tags."""
    unit = F.when(F.col("p_size") < 20, "B").otherwise("M")
    kind = (
        F.when(F.col("p_type") == "ECONOMY", "BERT")
        .when(F.col("p_type") == "SMALL", "causal-lm")
        .otherwise("other")
    )
    tags = F.array("p_name", kind, F.concat(F.col("p_size").cast("string"), unit))
    return table(spark, folder, "part").select(
        "p_partkey",
        ranking.size_from_tags(tags).alias("size_mb"),
        ranking.architecture_from_tags(tags).alias("architecture"),
    )


def _metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Tags for each stand-in model, taken from its smallest part."""
    kind = F.when(F.col("p_type") == "ECONOMY", "BERT").otherwise("causal-lm")
    size = F.concat(F.col("p_size").cast("string"), F.lit("M"))
    tags = F.min_by(F.array(kind, size), "p_partkey")
    return table(spark, folder, "part").groupBy(F.col("p_brand").alias("model_name")).agg(
        tags.alias("tags")
    )


@query(
    f"""WITH {SQL_MERGED},
k AS (SELECT p_brand AS model_name, min_by(p_size, p_partkey)::DOUBLE AS size_mb,
             CASE WHEN min_by(p_type, p_partkey) = 'ECONOMY' THEN 'Encoder' ELSE 'Decoder' END
               AS architecture FROM part GROUP BY p_brand)
SELECT m.model_name, size_mb, architecture, {SQL_TIER} AS tier,
       CASE WHEN architecture = 'Decoder' THEN 'Slow (Decoder)'
            WHEN size_mb < 50 THEN 'Very Fast' ELSE 'Fast' END AS cpu_speed
FROM m LEFT JOIN k ON k.model_name = m.model_name"""
)
def rank_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Size, architecture, tier and speed filled in from metadata."""
    rows = ranking.with_lookups(_merged(spark, folder), _metadata(spark, folder))
    return rows.select("model_name", "size_mb", "architecture", "tier", "cpu_speed")


@query(
    f"""WITH {SQL_MERGED}
SELECT model_name FROM m ORDER BY greatest(score_general, score_code) DESC NULLS LAST, model_name
LIMIT 100"""
)
def rank_missing(spark: SparkSession, folder: str) -> DataFrame:
    """The best models that still lack a size or an architecture."""
    return ranking.needing_metadata(ranking.best(_merged(spark, folder)))


# Scores of which some are missing, as NULL and as NaN


def _holed_scores(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey") % 7
    hole = F.when(key == 0, F.lit(None).cast("double")).when(key < 4, F.lit(float("nan")))
    score = F.when(key < 4, hole).otherwise(F.round(F.col("p_retailprice") * 10))
    return table(spark, folder, "part").select(
        F.concat("p_brand", F.lit("/"), F.col("p_partkey") % 3).alias("model_name"),
        F.concat("p_type", F.lit("-"), F.split_part("p_name", F.lit(" "), F.lit(2))).alias("task_name"),
        score.alias("score"),
        F.lit(True).alias("is_public"),
    )


SQL_HOLED = f"""
s AS (SELECT concat(p_brand, '/', p_partkey % 3) AS model_name, concat(p_type, '-', split_part(p_name, ' ', 2)) AS task_name,
             CASE WHEN p_partkey % 7 >= 4 THEN round(p_retailprice * 10) END AS score FROM part),
m AS (SELECT model_name, avg(score) FILTER (task_name IN ({str(GENERAL_STAND_IN)[1:-1]})) AS score_general,
             avg(score) FILTER (task_name IN ({str(CODE_STAND_IN)[1:-1]})) AS score_code
      FROM s WHERE task_name IN ({str(GENERAL_STAND_IN + CODE_STAND_IN)[1:-1]}) GROUP BY model_name)"""


@query(
    f"""WITH {SQL_HOLED}
SELECT row_number() OVER (ORDER BY greatest(score_general, score_code) DESC NULLS LAST, model_name)::INT AS rank,
       model_name, round(score_general, 4) AS score_general, round(score_code, 4) AS score_code,
       round(greatest(score_general, score_code), 4) AS max_score FROM m"""
)
def rank_nan(spark: SparkSession, folder: str) -> DataFrame:
    """Ranking where many scores are missing: they count in no mean and come last."""
    merged = ranking.merged_scores(_holed_scores(spark, folder), GENERAL_STAND_IN, CODE_STAND_IN)
    rows = ranking.best(merged)
    order = Window.orderBy(F.desc_nulls_last("max_score"), "model_name")
    return rows.select(
        F.row_number().over(order).alias("rank"),
        "model_name",
        *[F.round(c, 4).alias(c) for c in ("score_general", "score_code", "max_score")],
    )


# Models by their real names, given to parts in turn

MODEL_NAMES = [*ranking.KNOWN_ARCHITECTURES, "someone/unknown-model"]
SQL_NAMES = f"""
names AS (SELECT unnest({MODEL_NAMES}) AS name, unnest(range({len(MODEL_NAMES)})) AS i),
size AS (SELECT unnest({list(ranking.KNOWN_SIZES)}) AS name, unnest({list(ranking.KNOWN_SIZES.values())})::DOUBLE AS size_mb),
kind AS (SELECT unnest({list(ranking.KNOWN_ARCHITECTURES)}) AS name, unnest({list(ranking.KNOWN_ARCHITECTURES.values())}) AS architecture)"""


def _named(spark: SparkSession, folder: str) -> DataFrame:
    place = (F.col("p_partkey") % len(MODEL_NAMES)).cast("int")
    return table(spark, folder, "part").withColumn("model_name", F.get(F.array(*map(F.lit, MODEL_NAMES)), place))


@query(
    f"""WITH {SQL_NAMES}
SELECT p_partkey, names.name AS model_name, size_mb, coalesce(architecture, 'Unknown') AS architecture,
       CASE WHEN size_mb IS NULL THEN 'Unknown' ELSE {SQL_TIER} END AS tier,
       CASE WHEN architecture = 'Cloud API' THEN 'Cloud' WHEN architecture = 'Decoder' THEN 'Slow (Decoder)'
            WHEN architecture IS NULL THEN 'Unknown' WHEN size_mb IS NULL THEN 'Fast (Encoder)'
            WHEN size_mb < 50 THEN 'Very Fast' WHEN size_mb < 200 THEN 'Fast' ELSE 'Moderate' END AS cpu_speed
FROM part JOIN names ON i = p_partkey % {len(MODEL_NAMES)} LEFT JOIN size ON size.name = names.name
LEFT JOIN kind ON kind.name = names.name"""
)
def rank_known(spark: SparkSession, folder: str) -> DataFrame:
    """Size, architecture, tier and speed of models in the known tables."""
    rows = ranking.with_lookups(_named(spark, folder).select("p_partkey", "model_name"))
    return rows.select("p_partkey", "model_name", "size_mb", "architecture", "tier", "cpu_speed")


@query(
    f"""WITH {SQL_NAMES},
m AS (SELECT names.name, avg(round(p_retailprice * 10)) FILTER (p_type = 'SMALL') AS g,
             avg(round(p_retailprice * 10)) FILTER (p_type = 'ECONOMY') AS c
      FROM part JOIN names ON i = p_partkey % {len(MODEL_NAMES)} GROUP BY 1),
f AS (SELECT unnest({ranking.FAMILY}) AS name, unnest(range({len(ranking.FAMILY)})) AS position)
SELECT position::INT AS position, f.name AS model_name, coalesce(printf('%.4f', c), 'N/A') AS code_score,
       coalesce(printf('%.4f', g), 'N/A') AS general_score, size_mb
FROM f LEFT JOIN m ON m.name = f.name LEFT JOIN size ON size.name = f.name"""
)
def rank_family(spark: SparkSession, folder: str) -> DataFrame:
    """The fixed family, with scores or without."""
    scores = _named(spark, folder).select(
        "model_name",
        F.col("p_type").alias("task_name"),
        F.round(F.col("p_retailprice") * 10).alias("score"),
        F.lit(True).alias("is_public"),
    )
    merged = ranking.merged_scores(scores, ["SMALL"], ["ECONOMY"])
    return ranking.family(merged).select("position", "model_name", "code_score", "general_score", "size_mb")


PARAM_MODELS = [
    "nomic-ai/CodeRankEmbed", "nomic-ai/nomic-embed-text-v1.5", "nomic-ai/nomic-embed-text-v1x",
    "Snowflake/snowflake-arctic-embed-xs", "Snowflake/snowflake-arctic-embed-", "cohere/embed-english-light-v3.0",
    "voyage/voyage-code-3", "gemini/text-embedding-004", "nvidia_nim/nvidia/nv-embed", "other/model",
]


def _params_sql() -> str:
    def text(pairs: dict) -> str:
        return "'" + ",".join(f"{k}={v}" for k, v in pairs.items()) + "'"

    return ", ".join(
        f"({n}, '{e[0]}', '{e[1]}', {text(e[2])}, {text(e[3])})" for n, e in enumerate(embedding.RECOMMENDED_PARAMS)
    )


# Every second part is one of a service, and every eleventh names a model of its own.
SQL_PROVIDER = "CASE WHEN {} % 2 = 0 THEN 'litellm' ELSE 'sentence-transformers' END"


@query(
    f"""WITH n AS (SELECT unnest({PARAM_MODELS}) AS model, unnest(range({len(PARAM_MODELS)})) AS i),
r AS (SELECT p_partkey, coalesce(model, concat('part/', p_size)) AS model, {SQL_PROVIDER.format('p_size')} AS provider
      FROM part LEFT JOIN n ON i = p_partkey % {len(PARAM_MODELS) + 1}),
rules(ordinal, provider, pattern, indexing, query) AS (VALUES {_params_sql()} UNION ALL
  SELECT 1000 + min(p_partkey), {SQL_PROVIDER.format('p_partkey')} AS v, concat('part/', p_partkey % 997, '[0-9]?') AS x,
         concat('brand=', arg_min(p_brand, p_partkey)), '' FROM part GROUP BY v, x),
h AS (SELECT m.provider, m.model, arg_min(indexing, ordinal) AS indexing, arg_min(query, ordinal) AS query
      FROM (SELECT DISTINCT provider, model FROM r) m JOIN rules ON rules.provider = m.provider
      WHERE regexp_full_match(m.model, pattern) GROUP BY ALL)
SELECT p_partkey, r.provider, r.model, indexing, query
FROM r LEFT JOIN h ON h.provider = r.provider AND h.model = r.model"""
)
def embed_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """Recommended parameters of models by a rule table that grows with the parts."""

    def provider(number: str) -> Column:
        return F.when(F.col(number) % 2 == 0, "litellm").otherwise("sentence-transformers")

    parts = table(spark, folder, "part")
    place = (F.col("p_partkey") % (len(PARAM_MODELS) + 1)).cast("int")
    own = F.concat(F.lit("part/"), F.col("p_size"))
    rows = parts.select(
        "p_partkey",
        F.coalesce(F.get(F.array(*map(F.lit, PARAM_MODELS)), place), own).alias("model"),
        provider("p_size").alias("provider"),
    )
    pattern = F.concat(F.lit("part/"), F.col("p_partkey") % 997, F.lit("[0-9]?"))
    more = parts.groupBy(provider("p_partkey").alias("provider"), pattern.alias("pattern")).agg(
        (F.min("p_partkey") + 1000).alias("ordinal"),
        F.create_map(F.lit("brand"), F.min_by("p_brand", "p_partkey")).alias("indexing"),
        F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")).alias("query"),
    )
    named = rules.match_patterns(
        rows, embedding.recommended_rules(spark).unionByName(more), by="provider", value="model"
    )

    def shown(side: str) -> Column:
        pairs = F.transform(F.map_entries(F.col("rule")[side]), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
        return F.array_join(pairs, ",").alias(side)

    return named.select("p_partkey", "provider", "model", shown("indexing"), shown("query"))


@query(
    """SELECT CASE WHEN e.vec_id % 3 = 0 THEN 'missing' WHEN e.vec_id % 3 = 1 THEN 'short' ELSE 'whole' END AS kind,
count(*) AS n, count(*) FILTER (e.vec_id % 3 < 2) AS without_distance FROM embeddings e GROUP BY 1"""
)
def knn_null_guard(spark: SparkSession, folder: str) -> DataFrame:
    """How many stored vectors have no distance to the query, by what is wrong with them."""
    kind = F.when(F.col("vec_id") % 3 == 0, "missing").when(F.col("vec_id") % 3 == 1, "short").otherwise("whole")
    broken = F.when(kind == "whole", F.col("embedding")).when(kind == "short", F.slice("embedding", 1, 5))
    wanted = F.array(*map(F.lit, first_vector(spark, folder)))
    rows = table(spark, folder, "embeddings").select(kind.alias("kind"), vectors.l2_distance(broken, wanted).alias("d"))
    return rows.groupBy("kind").agg(F.count("*").alias("n"), F.count_if(F.col("d").isNull()).alias("without_distance"))


# Labels and small conversions as columns


@query(
    f"""WITH f AS (SELECT doc_id, {SQL_PATH} AS p FROM documents),
m AS (SELECT concat('src', p_partkey * 7 % 23, CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN '/en'
             ELSE concat('/fr/doc_', p_partkey, '.txt') END) AS source,
             concat('/mnt/', p_partkey) AS target, p_partkey * 7919 % 100003 AS ordinal FROM part),
h AS (SELECT p, arg_min(concat(target, substr(p, length(source) + 1)), ordinal) AS moved
      FROM (SELECT DISTINCT p FROM f) JOIN m ON p = source OR starts_with(p, concat(source, '/')) GROUP BY p)
SELECT doc_id, substr(md5(f.p), 1, 12) AS short_id, coalesce(moved, f.p) AS shown FROM f LEFT JOIN h ON h.p = f.p"""
)
def path_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Short ids and path prefixes mapped by a rule table that grows with the parts."""
    below = (
        F.when(F.col("p_partkey") % 3 == 0, "")
        .when(F.col("p_partkey") % 3 == 1, "/en")
        .otherwise(F.concat(F.lit("/fr/doc_"), "p_partkey", F.lit(".txt")))
    )
    moves = table(spark, folder, "part").select(
        F.concat(F.lit("src"), F.col("p_partkey") * 7 % 23, below).alias("source"),
        F.concat(F.lit("/mnt/"), "p_partkey").alias("target"),
        (F.col("p_partkey") * 7919 % 100003).alias("ordinal"),
    )
    files = doc_files(spark, folder).select("doc_id", "file_path")
    return rules.map_prefixes(files, moves).select("doc_id", text.short_id(F.col("file_path")).alias("short_id"), "shown")


@query("SELECT event_type, max(epoch_us(ts)) AS last_us FROM events GROUP BY event_type")
def mtime_micros(spark: SparkSession, folder: str) -> DataFrame:
    """Latest time per group in microseconds."""
    return table(spark, folder, "events").groupBy("event_type").agg(
        F.max(text.epoch_micros(F.col("ts"))).alias("last_us")
    )


@query(
    """SELECT o_orderkey, round(CASE WHEN o_orderstatus = 'O' THEN least(o_custkey / 1000.0 + 0.1, 10.0)
WHEN o_orderstatus = 'F' THEN least(least(0.5 * pow(2.0, left(o_orderpriority, 1)::INT), 10.0) + 0.1, 10.0) END, 6)
AS delay FROM orders"""
)
def retry_delays(spark: SparkSession, folder: str) -> DataFrame:
    """Waiting times read from service messages, with back-off where none is named."""
    message = (
        F.when(
            F.col("o_orderstatus") == "O",
            F.concat(F.lit("Rate limit: please try again in "), "o_custkey", F.lit("ms")),
        )
        .when(F.col("o_orderstatus") == "F", "RATE LIMIT reached")
        .otherwise("bad request")
    )
    attempt = F.substring("o_orderpriority", 1, 1).cast("int")
    return table(spark, folder, "orders").select(
        "o_orderkey", F.round(text.rate_limit_delay(message, attempt), 6).alias("delay")
    )
