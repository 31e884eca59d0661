"""Queries by name over the tables of a folder, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusforge.functions import text as T
from corpusforge.functions.numeric import band_shape, permutations, span_lengths
from corpusforge.operators import dialogs as D
from corpusforge.operators import html as H
from corpusforge.operators import near_dup as N
from corpusforge.operators import packing as K
from corpusforge.operators import records as R
from corpusforge.operators import vectors as V
from corpusforge.operators.ordering import spread, with_index
from corpusforge.operators.pairs import next_jaccard

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# SQL fragments -------------------------------------------------------------------------------------------------

_WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
_TOK = f"list_filter(string_split_regex(text, '{_WS}+'), lambda w: w <> '')"
_STRIP = f"regexp_replace(%s, '^{_WS}+|{_WS}+$', '', 'g')"


def _quoted(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def _any(column: str, words) -> str:
    return f"list_bool_or(list_transform({_quoted(words)}, lambda p: contains({column}, p)))"


_PROBES = [
    (-1, "  one page 404 Not Found", "'  one page 404 Not Found'"),
    (-2, "a long tail" + " " * 9 + "x" + "." * 8 + "…" * 7 + "\n", "'a long tail         x........' || repeat(chr(8230), 7) || chr(10)"),
    (-3, " a ", "' a '"),
    (-4, "Login\n" + "a line of more than fifty characters that is kept in the page\n" + "please enable JavaScript in your browser. It is needed for this page", "'Login' || chr(10) || 'a line of more than fifty characters that is kept in the page' || chr(10) || 'please enable JavaScript in your browser. It is needed for this page'"),
]
_RAW = "(SELECT doc_id, source, lang, text FROM documents" + "".join(f" UNION ALL SELECT {i}, 'probe', 'en', {sql}" for i, _, sql in _PROBES) + ")"
_FOLD = f"regexp_replace(regexp_replace(replace(%s, chr(8230), '.'), '{_WS}{{6,}}', '   ', 'g'), '\\.{{6,}}', '...', 'g')"


def _probed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents and a few more rows with markers, long runs and short texts, which the tables do not hold."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text"))
    rows = F.array(*[F.struct(F.lit(i).cast("long").alias("doc_id"), F.lit("probe").alias("source"), F.lit("en").alias("lang"), F.lit(t).alias("text")) for i, t, _ in _PROBES])
    return docs.unionByName(spark.range(1).select(F.inline(rows)))


def _documents(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", *more))


# Filters and cleaning ------------------------------------------------------------------------------------------


@query(f"SELECT doc_id, c AS text FROM (SELECT doc_id, {_FOLD % (_STRIP % 'text')} AS c, {_any('text', T.markers())} AS bad FROM {_RAW}) WHERE NOT bad AND length(c) >= 3")
def p4_clean_documents(spark, sf_dir):
    return T.clean_documents(_probed(spark, sf_dir)).select("doc_id", "text")


@query(f"SELECT marker, count(*)::BIGINT AS n FROM (SELECT text, unnest({_quoted(T.markers())}) AS marker FROM {_RAW}) WHERE contains(text, marker) GROUP BY 1")
def f1_reject_audit(spark, sf_dir):
    held = F.array_compact(F.array(*[F.when(F.col("text").contains(m), F.lit(m)) for m in T.markers()]))
    return _probed(spark, sf_dir).select(F.explode(held).alias("marker")).groupBy("marker").agg(F.count(F.lit(1)).alias("n"))


_LINE = T.SNAPSHOT_EXTRA + T.markers()


@query(f"SELECT doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda l: length(l) > 50 AND NOT {_any('l', _LINE)}), chr(10)) AS text FROM {_RAW}")
def f3_line_filter(spark, sf_dir):
    return _probed(spark, sf_dir).select("doc_id", T.keep_lines(F.col("text"), 50, _LINE).alias("text"))


@query("SELECT doc_id FROM documents WHERE NOT (contains(lower('<s>' || text || '</s>'), 'the of') OR contains(lower('<s>' || text || '</s>'), 'de la '))")
def f4_exam_reject(spark, sf_dir):
    wrapped = F.lower(F.concat(F.lit("<s>"), "text", F.lit("</s>")))
    return table(spark, sf_dir, "documents").where(~T.contains_any(wrapped, ["the of", "de la "])).select("doc_id")


@query(f"SELECT doc_id, len(list_distinct(w)) / len(w) AS ratio FROM (SELECT doc_id, {_TOK} AS w FROM documents) WHERE len(w) > 0 AND len(list_distinct(w)) / len(w) < 0.5")
def f6_unique_ratio(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.unique_ratio(F.col("text")).alias("ratio")).where("ratio < 0.5")


_Q = _any("text", ["'", '"', "http", "\n", "[", "]", "/", "`"])


@query(f"SELECT conv_id, turn FROM conversations WHERE NOT coalesce({_Q} OR regexp_matches(text, '[^\\x00-\\x7f]') OR regexp_matches(text, '[0-9]') OR length(text) < 20 OR length(text) > 200, true) AND NOT coalesce(contains(text, '------'), true)")
def f8_question_filter(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "conversations").where(~T.question_rejected(t) & ~T.answer_rejected(t)).select("conv_id", "turn")


@query("SELECT doc_id, regexp_matches(text, '[\\x{00C0}-\\x{024F}]') AS latin, regexp_matches(text, '[\\x{0B80}-\\x{0BFF}]') AS tamil, regexp_matches(text, '[\\x{4E00}-\\x{9FFF}\\x{3400}-\\x{4DBF}\\x{20000}-\\x{2EBEF}]') AS han FROM documents")
def f10_script_detect(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", T.in_range(t, [(0xC0, 0x24F)]).alias("latin"), T.in_range(t, T.TAMIL).alias("tamil"), T.in_range(t, T.HAN).alias("han"))


_PREFIX = f"substr({_STRIP % "regexp_replace(regexp_replace(lower(substr(text, 1, 20)), '[^a-z ]+', ' ', 'g'), ' {2,}', ' ', 'g')"}, 1, 10)"


@query(f"""WITH k AS (SELECT conv_id, {_PREFIX} AS key, lag({_PREFIX}) OVER w AS prev, last_value({_PREFIX}) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last, row_number() OVER w AS n FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, bool_or(key = CASE WHEN n = 1 THEN last ELSE prev END) AS echo FROM k GROUP BY 1""")
def f11_chat_echo(spark, sf_dir):
    return D.gather(table(spark, sf_dir, "conversations")).select("conv_id", D.echoes(F.col("chat")).alias("echo"))


@query(f"SELECT conv_id, lower(to_json(list(struct_pack(role := role, content := text) ORDER BY turn, role, text))) LIKE '%the of%' AS hit FROM conversations GROUP BY 1")
def f12_serialized_phrase(spark, sf_dir):
    chat = F.transform("chat", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content")))
    return D.gather(table(spark, sf_dir, "conversations")).select("conv_id", F.lower(F.to_json(chat)).contains("the of").alias("hit"))


@query("SELECT d.doc_id FROM documents d LEFT JOIN labels l USING (doc_id) WHERE NOT (coalesce(l.toxic, 0) <> 0) AND l.quality IS NOT NULL")
def f13_quality_flags(spark, sf_dir):
    d, l = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return d.join(l, "doc_id", "left").where((F.coalesce("toxic", F.lit(0)) == 0) & F.col("quality").isNotNull()).select("doc_id")


@query("SELECT conv_id FROM (SELECT conv_id, count(*) AS n, arg_max(length(text), turn) AS last FROM conversations GROUP BY 1) WHERE NOT (n = 2 AND last < 100)")
def f15_short_answers(spark, sf_dir):
    return D.gather(table(spark, sf_dir, "conversations")).where(~((F.size("chat") == 2) & (F.length(F.element_at("chat", -1)["text"]) < 100))).select("conv_id")


@query(f"SELECT doc_id, coalesce({_any('text', T.META_PHRASES)}, false) AS meta, coalesce({_any('text', T.LEXICON)}, false) AS lexicon, len({_TOK}) < 2000 AND len({_TOK}) > 0 AS bounded FROM documents")
def f16_f18_pair_filters(spark, sf_dir):
    t = F.col("text")
    n = F.size(T.tokens(t))
    return table(spark, sf_dir, "documents").select("doc_id", T.contains_any(t, T.META_PHRASES).alias("meta"), T.contains_any(t, T.LEXICON).alias("lexicon"), ((n < 2000) & (n > 0)).alias("bounded"))


@query("""WITH c AS (SELECT DISTINCT source FROM documents), a AS (SELECT source FROM c WHERE source LIKE 'src1%' UNION SELECT source FROM c WHERE source IN ('src2', 'src3'))
SELECT source, 'listed' AS kind FROM a UNION ALL SELECT source, 'other' FROM (SELECT source FROM c EXCEPT SELECT source FROM a) WHERE NOT contains(source, '5') UNION ALL SELECT source, 'pinned' FROM (SELECT source FROM a INTERSECT SELECT unnest(['src1', 'src2', 'src9']))""")
def f21_source_select(spark, sf_dir):
    names = table(spark, sf_dir, "documents").select("source").distinct()
    listed = names.where(F.col("source").startswith("src1")).union(names.where(F.col("source").isin("src2", "src3"))).distinct()
    other = names.join(listed, "source", "left_anti").where(~F.col("source").contains("5"))
    pinned = listed.where(F.col("source").isin("src1", "src2", "src9"))
    return listed.withColumn("kind", F.lit("listed")).unionByName(other.withColumn("kind", F.lit("other"))).unionByName(pinned.withColumn("kind", F.lit("pinned")))


# Fields, projections -------------------------------------------------------------------------------------------


@query("SELECT n_nationkey, coalesce(n_comment, 'None') || chr(10) || chr(10) || n_name AS text FROM (SELECT n_nationkey, n_name, CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE 'c' || n_nationkey END AS n_comment FROM nation)")
def p5_fields_to_text(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 5 != 0, F.concat(F.lit("c"), "n_nationkey")).alias("body"), F.lit(1).alias("other"), F.col("n_name").alias("title"))
    record = F.to_json(F.struct("body", "other", "title"), {"ignoreNullFields": "false"})
    return rows.select("n_nationkey", R.fields_to_text(record).alias("text"))


@query("SELECT n_nationkey, 'n name: ' || n_name || chr(10) || 'n regionkey: ' || n_regionkey AS text FROM nation")
def p7_flatten_record(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", R.flatten_record(F.to_json(F.struct("n_name", "n_regionkey"))).alias("text"))


def _chunk_sql(size: int, wrap: str) -> str:
    tok = _TOK.replace("text", wrap, 1)
    return f"SELECT doc_id, k::INTEGER AS pos, array_to_string(w[k * {size} + 1 : (k + 1) * {size}], ' ') AS chunk FROM (SELECT doc_id, w, unnest(range((len(w) + {size} - 1) // {size})) AS k FROM (SELECT doc_id, {tok} AS w FROM documents))"


def _chunked(spark, sf_dir, size: int, before: str, after: str) -> DataFrame:
    wrapped = F.concat(F.lit(before), "text", F.lit(after))
    return _documents(spark, sf_dir).select("doc_id", F.posexplode(T.chunks(wrapped, size)).alias("pos", "chunk"))


@query(_chunk_sql(500, "'<s>' || text || '</s>'"))
def p9_g1_chunk500(spark, sf_dir):
    return _chunked(spark, sf_dir, 500, "<s>", "</s>")


@query(_chunk_sql(2500, "text || '</s>'"))
def g1_chunk2500(spark, sf_dir):
    return _chunked(spark, sf_dir, 2500, "", "</s>")


_PAIRS = [("the ", "teh "), (" of", " fo"), ("teh", "eth"), ("and", "&")]


def _chain_sql(column: str, pairs) -> str:
    for a, b in pairs:
        column = f"replace({column}, '{a}', '{b}')"
    return column


@query(f"SELECT doc_id, {_chain_sql('text', _PAIRS)} AS swapped, {_chain_sql("'Kode kode opkode ' || text", T.CODE_SPELLINGS)} AS spelled FROM documents")
def p10_replace_chain(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.replace_chain(F.col("text"), _PAIRS).alias("swapped"), T.replace_chain(F.concat(F.lit("Kode kode opkode "), "text"), T.CODE_SPELLINGS).alias("spelled"))


@query(f"SELECT doc_id, regexp_replace(regexp_replace(lower({_STRIP % 'text'}), '\\p{{Nd}}', '0', 'g'), '[\\p{{P}}\\p{{C}}\\p{{S}}]+', '', 'g') AS text FROM {_RAW}")
def p11_normalize(spark, sf_dir):
    return _probed(spark, sf_dir).select("doc_id", T.normalize_line(F.col("text")).alias("text"))


@query("SELECT doc_id, translate(text, '!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~', '') AS text FROM documents")
def p12_remove_punctuation(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.remove_punctuation(F.col("text")).alias("text"))


@query(f"SELECT conv_id, turn, substr(t, 1, greatest(length(t) - 13, 0)) AS text FROM (SELECT conv_id, turn, {_STRIP % "string_split('a<|transcribe|> ' || text || ' <|endoftext|>', '<|transcribe|>')[2]"} AS t FROM conversations)")
def p14_marker_split(spark, sf_dir):
    tagged = F.concat(F.lit("a<|transcribe|> "), "text", F.lit(" <|endoftext|>"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.after_marker(tagged, "<|transcribe|>", 13).alias("text"))


@query("SELECT doc_id, l[-1] AS last, array_to_string(l[1 : len(l) - 1], chr(10)) AS rest FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)")
def p15_last_line(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.last_line(F.col("text")).alias("last"), T.but_last_line(F.col("text")).alias("rest"))


@query(f"SELECT conv_id, turn, '. ' || {_STRIP % "regexp_replace(translate(text, '!''\"', '.'), ' {2,}', ' ', 'g')"} AS speech, CASE WHEN text LIKE '%. ' THEN text WHEN text LIKE '%.' THEN text || ' ' ELSE text || '. ' END AS ref, octet_length(encode(text))::BIGINT AS n_bytes, length(text) BETWEEN 3 AND 200 AS bounded FROM conversations")
def p16_tts_clean(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.speech_text(t).alias("speech"), T.with_stop(t).alias("ref"), F.octet_length(t).cast("long").alias("n_bytes"), F.length(t).between(3, 200).alias("bounded"))


@query()
def p20_html_paragraphs(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", H.html_paragraphs(F.col("html")).alias("text"))


@query()
def p21_html_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", H.html_text(F.col("html")).alias("text"))


# Hashes and near duplicates ------------------------------------------------------------------------------------

_SHA = "(('0x' || substr(h, 7, 2) || substr(h, 5, 2) || substr(h, 3, 2) || substr(h, 1, 2))::UBIGINT)"


@query(f"SELECT doc_id, md5(text) AS md5, sha256(text) AS sha256, {_SHA}::BIGINT AS sha1_32 FROM (SELECT doc_id, text, sha1(text) AS h FROM documents)")
def h1_hashes(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(t).alias("md5"), F.sha2(t, 256).alias("sha256"), T.sha1_low(t, 32).cast("long").alias("sha1_32"))


@query()
def h4_xxh3(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", *[T.xxh3(t, n).alias(f"xxh3_{n}") for n in (16, 32, 64, 128)])


_CHARS = "list_distinct(CASE WHEN length(%s) < 8 THEN [%s] ELSE list_transform(range(1, length(%s) - 6), lambda i: substr(%s, i, 8)) END)"
_A, _B = (_CHARS.replace("%s", x) for x in ("a", "b"))


@query(f"SELECT doc_id, len(list_intersect(x, y)) / greatest(len(list_distinct(list_concat(x, y))), 1) AS jaccard FROM (SELECT doc_id, {_A} AS x, {_B} AS y FROM (SELECT doc_id, text AS a, lead(text) OVER (PARTITION BY source ORDER BY doc_id) AS b FROM documents) WHERE b IS NOT NULL)")
def h7_jaccard_pairs(spark, sf_dir):
    return next_jaccard(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), "source", 8)


_SPLIT = r"string_split_regex(text, '[^\p{L}\p{N}_]')"
_GRAMS = "list_distinct(CASE WHEN len(w) < 5 THEN [] ELSE list_transform(range(1, len(w) - 3), lambda i: lower(array_to_string(w[i : i + 4], ' '))) END)"


@query(f"SELECT doc_id, len({_GRAMS})::BIGINT AS n FROM (SELECT doc_id, {_SPLIT} AS w FROM documents)")
def d1_shingle_counts(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", F.size(T.ngrams(T.shingle_tokens(F.col("text")))).cast("long").alias("n"))


def _perm_sql(k: int, a: int, b: int) -> str:
    return f"min((((h * {a} + {b}) % 18446744073709551616) % 2305843009213693951) % 4294967296) AS m{k}"


def _sigs_sql(min_length: int = 5, num_perm: int = 256) -> str:
    """Common table expressions up to ``s(doc_id, sig)``: all minima of every document."""
    least = _GRAMS.replace("len(w) < 5 THEN []", f"len(w) < {min_length} THEN [] WHEN len(w) < 5 THEN [lower(array_to_string(w, ' '))]")
    minima = ", ".join(_perm_sql(k, int(a), int(b)) for k, (a, b) in enumerate(zip(*permutations(num_perm))))
    return f"g AS (SELECT doc_id, unnest({least}) AS g FROM (SELECT doc_id, {_SPLIT} AS w FROM documents)), h AS MATERIALIZED (SELECT doc_id, {_SHA}::HUGEINT AS h FROM (SELECT doc_id, sha1(g) AS h FROM g)), m AS (SELECT doc_id, {minima} FROM h GROUP BY 1), s AS (SELECT doc_id, [{", ".join(f"coalesce(m{k}, 4294967295)::BIGINT" for k in range(num_perm))}] AS sig FROM documents LEFT JOIN m USING (doc_id))"


def _edges_sql(threshold: float, min_length: int = 5) -> str:
    """As ``_sigs_sql``, then ``e(u, v)``: edges of the bands that the threshold asks for."""
    bands, rows = band_shape(threshold, 256)
    return f"{_sigs_sql(min_length)}, k AS (SELECT doc_id, band, sig[band * {rows} + 1 : (band + 1) * {rows}] AS key FROM s, range({bands}) r(band)), e AS (SELECT DISTINCT u, v FROM (SELECT doc_id AS u, min(doc_id) OVER (PARTITION BY band, key) AS v FROM k) WHERE u <> v)"


def _clusters_sql(threshold: float, rest: str) -> str:
    """The query ``rest`` over ``c(doc_id, cluster)``; clusters by the least id that a walk over edges reaches."""
    return f"WITH RECURSIVE {_edges_sql(threshold, 1)}, b AS (SELECT u, v FROM e UNION SELECT v, u FROM e), walk AS (SELECT u AS doc_id, u AS cluster FROM b UNION SELECT b.u, walk.cluster FROM walk JOIN b ON b.v = walk.doc_id), c AS (SELECT d.doc_id, coalesce(min(cluster), d.doc_id) AS cluster FROM documents d LEFT JOIN walk USING (doc_id) GROUP BY d.doc_id) {rest}"


@query(_clusters_sql(0.7, "SELECT s.doc_id, md5(array_to_string(sig, ',')) AS sig FROM s JOIN c USING (doc_id)"))
def d2_minhash_sig256(spark, sf_dir):
    """All 256 minima of every document, as a digest."""
    return N.signatures(_documents(spark, sf_dir), min_length=1).select("doc_id", F.md5(F.array_join(F.col("sig").cast("array<string>"), ",")).alias("sig"))


@query(_clusters_sql(0.7, "SELECT DISTINCT u, v FROM e JOIN c ON c.doc_id = u"))
def d4_lsh_edges(spark, sf_dir):
    return N.bucket_edges(N.signatures(_documents(spark, sf_dir), min_length=1), *band_shape(0.7, 256))


@query(_clusters_sql(0.95, "SELECT doc_id FROM c WHERE cluster = doc_id"))
def d6_minhash_dedup_095(spark, sf_dir):
    return N.representatives(N.cluster(_documents(spark, sf_dir), 0.95, min_length=1))


@query(_clusters_sql(0.7, "SELECT doc_id FROM c WHERE cluster = doc_id"))
def d6_minhash_dedup_070(spark, sf_dir):
    return N.representatives(N.cluster(_documents(spark, sf_dir), 0.7, min_length=1))


@query(_clusters_sql(0.7, "SELECT cluster, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS members FROM c GROUP BY 1 HAVING count(*) > 1"))
def d7_duplicate_report(spark, sf_dir):
    return N.report(N.cluster(_documents(spark, sf_dir), 0.7, min_length=1)).select("cluster", F.array_join("members", ",").alias("members"))


@query(_clusters_sql(0.7, "SELECT doc_id, cluster, n_chars FROM c JOIN documents USING (doc_id) WHERE cluster IN (SELECT cluster FROM c GROUP BY 1 HAVING count(*) > 1)"))
def d13_k4_cluster_rows(spark, sf_dir):
    """Rows of clusters of several documents, with the cluster that each belongs to."""
    docs = _documents(spark, sf_dir, "n_chars")
    return N.cluster_rows(docs, N.cluster(docs, 0.7, min_length=1)).select("doc_id", "cluster", "n_chars")


@query(_clusters_sql(0.95, "SELECT doc_id FROM c WHERE cluster <> doc_id"))
def d12_missing_ids(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    return docs.select("doc_id").join(N.representatives(N.cluster(docs, 0.95, min_length=1)), "doc_id", "left_anti")


_HOST = "regexp_extract(url, '^[a-z]+://([^/]+)', 1)"


@query(f"SELECT page_id, host FROM (SELECT page_id, html, {_HOST} AS host, row_number() OVER (PARTITION BY {_HOST} ORDER BY page_id) AS n FROM pages) WHERE n = 1 AND len(list_filter(string_split(html, chr(10)), lambda l: length(l) > 50)) > 0")
def d9_url_first_wins(spark, sf_dir):
    host = F.regexp_extract("url", "^[a-z]+://([^/]+)", 1)
    pages = table(spark, sf_dir, "pages")
    first = pages.groupBy(host.alias("host")).agg(F.min("page_id").alias("page_id"))
    return pages.join(first, "page_id").where(T.keep_lines(F.col("html")) != "").select("page_id", "host")


_CAPS = [("user", 40), ("assistant", 90)]


@query("""WITH q AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY role, lower(text) ORDER BY conv_id, turn) AS k FROM conversations WHERE role IN ('user', 'assistant') AND length(text) >= 20),
f AS (SELECT *, row_number() OVER (ORDER BY CASE role WHEN 'user' THEN 0 ELSE 1 END, conv_id, turn) AS r, count(*) FILTER (role = 'user') OVER () AS users FROM q WHERE k = 1),
u AS (SELECT * FROM f WHERE role = 'user' AND r <= 40), a AS (SELECT *, row_number() OVER (ORDER BY conv_id, turn) AS i FROM f WHERE role = 'assistant')
SELECT conv_id, turn, role FROM u UNION ALL SELECT conv_id, turn, role FROM a WHERE i <= 90 - (SELECT count(*) FROM u)""")
def d10_l2_capped_dedup(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").where(F.length("text") >= 20)
    taken, total = None, 0
    for role, cap in _CAPS:
        own = c.where(F.col("role") == role).groupBy(F.lower("text").alias("_q")).agg(F.min(F.struct("conv_id", "turn")).alias("m")).select("m.conv_id", "m.turn", F.lit(role).alias("role"))
        own = own.orderBy("conv_id", "turn").limit(cap - total)  # the cumulative cap is the feature
        total += own.count()
        taken = own if taken is None else taken.unionByName(own)
    return taken


_COS = "(SELECT a.vec_id AS i, b.vec_id AS j FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.4)"


@query(f"SELECT i, j FROM {_COS}")
def d11_cosine_edges_040(spark, sf_dir):
    return V.cosine_edges(table(spark, sf_dir, "embeddings"), 0.4)


@query()
def d11_cosine_leaders_040(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return V.leaders(vectors, V.cosine_edges(vectors, 0.4))


# Joins, counts, order ------------------------------------------------------------------------------------------


@query("WITH c AS (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn, role, text) - 1 AS i FROM conversations), e AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS i FROM embeddings) SELECT conv_id, turn, vec_id FROM c JOIN e USING (i)")
def j1_zip_speakers(spark, sf_dir):
    c = with_index(table(spark, sf_dir, "conversations"), ["conv_id", "turn", "role", "text"], "i").select("conv_id", "turn", "i")
    e = with_index(table(spark, sf_dir, "embeddings").select("vec_id"), ["vec_id"], "i")
    return c.join(e, "i").select("conv_id", "turn", "vec_id")


@query("SELECT p_partkey, list_filter(list_transform(string_split(p_name, ' '), lambda w, i: chr(64 + i::INTEGER) || '. ' || w), lambda l: contains(l, substr(p_name, 1, 3)))[1] AS choice FROM part")
def j7_choice_lookup(spark, sf_dir):
    lines = F.transform(F.split("p_name", " "), lambda w, i: F.concat(F.char(i + 65), F.lit(". "), w))
    return table(spark, sf_dir, "part").select("p_partkey", F.get(F.filter(lines, lambda x: x.contains(F.substring("p_name", 1, 3))), F.lit(0)).alias("choice"))


@query(f"SELECT source, sum(len({_TOK}))::BIGINT AS words, count(*)::BIGINT AS docs, (sum(len({_TOK})) // 128 * 128)::BIGINT AS packed FROM documents GROUP BY 1")
def a1_token_count(spark, sf_dir):
    n = F.sum(F.size(T.tokens(F.col("text")))).cast("long")
    counted = table(spark, sf_dir, "documents").groupBy("source").agg(n.alias("words"), F.count(F.lit(1)).alias("docs"))
    return counted.withColumn("packed", F.col("words") - F.col("words") % 128)


@query(f"SELECT lang, sum(len({_TOK}))::BIGINT AS words, sum(length(text))::BIGINT AS chars, sum(octet_length(encode(text)))::BIGINT AS bytes, sum(length(text)) / sum(len({_TOK})) AS ratio FROM documents GROUP BY 1")
def a3_compare_tokenizers(spark, sf_dir):
    words, chars, size = F.sum(F.size(T.tokens(F.col("text")))).cast("long"), F.sum(F.length("text")).cast("long"), F.sum(F.octet_length("text")).cast("long")
    return table(spark, sf_dir, "documents").groupBy("lang").agg(words.alias("words"), chars.alias("chars"), size.alias("bytes"), (chars / words).alias("ratio"))


@query(f"SELECT 'raw' AS stage, count(*)::BIGINT AS docs, sum(octet_length(encode(text)))::BIGINT AS bytes FROM {_RAW} UNION ALL SELECT 'clean', count(*)::BIGINT, sum(octet_length(encode(c)))::BIGINT FROM (SELECT {_FOLD % (_STRIP % 'text')} AS c, {_any('text', T.markers())} AS bad FROM {_RAW}) WHERE NOT bad AND length(c) >= 3")
def a9_stage_sizes(spark, sf_dir):
    raw = _probed(spark, sf_dir)
    c = T.clean_documents(raw.select("text"))
    return raw.select(F.lit("raw").alias("stage"), "text").unionByName(c.withColumn("stage", F.lit("clean"))).groupBy("stage").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.octet_length("text")).cast("long").alias("bytes"))


@query("SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM documents) WHERE i <= floor(n * 0.1)")
def l1_head_10pct(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    placed = with_index(d, ["doc_id"], "i", ["source"])
    sizes = d.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return placed.join(sizes, "source").where(F.col("i") <= F.floor(F.col("n") * 0.1)).select("doc_id", "source")


@query("SELECT conv_id, turn FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY md5('7:' || conv_id || ':' || turn), turn) AS k FROM conversations) WHERE k <= 2")
def l3_seeded_sample(spark, sf_dir):
    key = F.md5(F.concat_ws(":", F.lit("7"), F.col("conv_id").cast("string"), F.col("turn").cast("string")))
    w = Window.partitionBy("conv_id").orderBy("_key", "turn")
    return table(spark, sf_dir, "conversations").withColumn("_key", key).withColumn("k", F.row_number().over(w)).where("k <= 2").select("conv_id", "turn")


@query("SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) // 300)::BIGINT AS part FROM documents")
def w6_split_files(spark, sf_dir):
    return with_index(table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"]).select("doc_id", F.floor(F.col("idx") / 300).alias("part"))


@query("SELECT doc_id, ntile(7) OVER (ORDER BY doc_id)::BIGINT - 1 AS chunk FROM documents")
def w7_balanced_chunks(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id")
    n, k = d.count(), 7
    size, more = divmod(n, k)
    i = F.col("idx")
    chunk = F.when(i < more * (size + 1), F.floor(i / (size + 1))).otherwise(more + F.floor((i - more * (size + 1)) / max(size, 1)))
    return with_index(d, ["doc_id"]).select("doc_id", chunk.cast("long").alias("chunk"))


@query("SELECT doc_id, (i // (n // 7))::BIGINT AS slice FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents) WHERE i < n // 7 * 7")
def w8_slices(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id")
    each = max(d.count() // 7, 1)
    return with_index(d, ["doc_id"]).where(F.col("idx") < each * 7).select("doc_id", F.floor(F.col("idx") / each).alias("slice"))


@query("WITH r AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS rank, count(*) OVER () AS n FROM (SELECT DISTINCT source FROM documents)) SELECT doc_id, rank::BIGINT AS rank FROM documents d JOIN r ON d.source IS NOT DISTINCT FROM r.source UNION ALL SELECT doc_id, n::BIGINT FROM documents d JOIN r ON d.source IS NOT DISTINCT FROM r.source WHERE rank = 0")
def u4_union_all_dup(spark, sf_dir):
    """All sources in order, the first named twice, as a list of files may."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    named = with_index(d.select("source").distinct(), ["source"], "rank")
    listed = named.unionByName(named.where("rank = 0").withColumn("rank", F.lit(named.count()).cast("long")))
    return d.join(F.broadcast(listed.withColumnRenamed("source", "_s")), F.col("source").eqNullSafe(F.col("_s"))).select("doc_id", "rank")


@query("SELECT event_id, list_filter(json_keys(props), lambda k: suffix(k, 'k') OR suffix(k, 'e'))[1] AS key FROM events")
def n4_first_key(spark, sf_dir):
    keys = F.filter(F.json_object_keys("props"), lambda k: k.endswith("k") | k.endswith("e"))
    return table(spark, sf_dir, "events").select("event_id", F.get(keys, F.lit(0)).alias("key"))


@query("SELECT event_id, array_to_string(list_transform(list_sort(json_keys(props)), lambda k: k || '. ' || json_extract_string(props, '$.\"' || k || '\"')), chr(10)) AS text FROM events")
def n5_map_lines(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", R.map_lines(F.col("props")).alias("text"))


# Conversations and templates -----------------------------------------------------------------------------------

_CHAT = "(SELECT conv_id, list(struct_pack(turn := turn, role := role, text := text) ORDER BY turn, role, text) AS chat FROM conversations GROUP BY 1)"


@query(f"SELECT conv_id, k::INTEGER AS k, chat[2 * k + 1].text AS q, chat[2 * k + 2].text AS a FROM (SELECT conv_id, chat, unnest(range(len(chat) // 2)) AS k FROM {_CHAT})")
def n8_turn_pairs(spark, sf_dir):
    return D.gather(table(spark, sf_dir, "conversations")).select("conv_id", F.explode(D.turn_pairs(F.col("chat"))).alias("p")).select("conv_id", "p.*")


@query("SELECT conv_id, count(*)::BIGINT AS n FROM (SELECT *, sum(CASE WHEN t IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn, role, t NULLS FIRST ROWS UNBOUNDED PRECEDING) AS z FROM (SELECT conv_id, turn, role, CASE WHEN (conv_id + turn) % 3 = 0 THEN NULL ELSE text END AS t FROM conversations)) WHERE z = 0 GROUP BY 1")
def n9_cut_at_null(spark, sf_dir):
    holed = table(spark, sf_dir, "conversations").withColumn("text", F.when((F.col("conv_id") + F.col("turn")) % 3 != 0, F.col("text")))
    kept = D.gather(holed).select("conv_id", F.size(D.until_null(F.col("chat"))).cast("long").alias("n"))
    return kept.where("n > 0")


def _both_ways(a: Column, b: Column, first: str, second: str) -> Column:
    ok = (F.size(T.tokens(a)) < 2000) & (F.size(T.tokens(b)) < 2000) & ~T.contains_any(a, T.META_PHRASES) & ~T.contains_any(b, T.LEXICON)
    return F.explode(F.array_compact(F.array(F.when(ok, F.concat(F.lit(f"{first} to {second}: "), a, F.lit(" "), b)), F.when(ok, F.concat(F.lit(f"{second} to {first}: "), b, F.lit(" "), a)))))


@query(f"SELECT conv_id, unnest(['question to answer: ' || q || ' ' || a, 'answer to question: ' || a || ' ' || q]) AS text FROM (SELECT conv_id, chat[2 * k + 1].text AS q, chat[2 * k + 2].text AS a FROM (SELECT conv_id, chat, unnest(range(len(chat) // 2)) AS k FROM {_CHAT})) WHERE len({_TOK.replace('text', 'q', 1)}) < 2000 AND len({_TOK.replace('text', 'a', 1)}) < 2000 AND NOT {_any('q', T.META_PHRASES)} AND NOT {_any('a', T.LEXICON)}")
def g2_bidirectional_pairs(spark, sf_dir):
    p = n8_turn_pairs(spark, sf_dir)
    return p.select("conv_id", _both_ways(F.col("q"), F.col("a"), "question", "answer").alias("text"))


@query(f"SELECT conv_id, array_to_string(list_transform(chat, lambda t: CASE WHEN t.role = 'assistant' THEN '<bot>: ' ELSE '<manusia>: ' END || t.text), chr(10)) AS text FROM (SELECT conv_id, chat[1 : len(chat) - len(chat) % 2] AS chat FROM {_CHAT})")
def i2_render_roles(spark, sf_dir):
    return D.gather(table(spark, sf_dir, "conversations")).select("conv_id", D.markup(D.even(D.until_null(F.col("chat")))).alias("text"))


_MARK = f"(SELECT conv_id, array_to_string(list_transform(chat, lambda t: CASE WHEN t.role = 'assistant' THEN '<bot>: ' ELSE '<manusia>: ' END || t.text), chr(10)) AS text FROM {_CHAT})"


@query(f"SELECT conv_id, len(p)::BIGINT * 2 AS n_turns, array_to_string(list_transform(p, lambda x: {_STRIP % "string_split(x, '<bot>:')[1]"} || ' | ' || {_STRIP % "string_split(x, '<bot>:')[2]"}), ' || ') AS text FROM (SELECT conv_id, list_filter(string_split(text, '<manusia>:'), lambda p: len(string_split(p, '<bot>:')) = 2) AS p FROM {_MARK} WHERE contains(text, '<bot>:'))")
def i1_parse_tagged(spark, sf_dir):
    tagged = D.gather(table(spark, sf_dir, "conversations")).select("conv_id", D.parse_markup(D.markup(F.col("chat"))).alias("t")).where("t IS NOT NULL")
    pairs = F.transform(F.filter("t", lambda x, i: i % 2 == 0), lambda x, i: F.concat(x["content"], F.lit(" | "), F.get("t", 2 * i + 1)["content"]))
    return tagged.select("conv_id", F.size("t").cast("long").alias("n_turns"), F.array_join(pairs, " || ").alias("text"))


@query(f"SELECT conv_id, chat[len(chat)].text AS question, to_json(list_transform(chat[1 : len(chat) - 1], lambda t: {{'role': t.role, 'content': [{{'type': 'text', 'text': t.text}}]}})) AS prompt FROM {_CHAT} WHERE len(chat) > 1")
def i3_assemble(spark, sf_dir):
    chat = D.gather(table(spark, sf_dir, "conversations")).where(F.size("chat") > 1)
    prompt = F.transform(F.slice("chat", F.lit(1), F.size("chat") - 1), lambda t: F.struct(t["role"].alias("role"), F.array(F.struct(F.lit("text").alias("type"), t["text"].alias("text"))).alias("content")))
    return chat.select("conv_id", F.element_at("chat", -1)["text"].alias("question"), F.to_json(prompt).alias("prompt"))


@query("""SELECT p_partkey, unnest([n || ' ' || t, n || chr(10) || t, n || t, n || chr(10) || 'A. ' || b || chr(10) || 'B. ' || t || chr(10) || 'Jawapan: A', n || ' ' || b || chr(10) || t]) AS text FROM (SELECT p_partkey, p_name AS n, p_type AS t, p_brand AS b FROM part) WHERE n IS NOT NULL AND t IS NOT NULL""")
def i4_templates(spark, sf_dir):
    n, t, b = F.col("p_name"), F.col("p_type"), F.col("p_brand")
    choice = F.concat(n, F.lit("\nA. "), b, F.lit("\nB. "), t, F.lit("\nJawapan: A"))
    forms = F.array(F.concat_ws(" ", n, t), F.concat_ws("\n", n, t), F.concat(n, t), choice, F.concat(n, F.lit(" "), b, F.lit("\n"), t))
    return table(spark, sf_dir, "part").dropna(subset=["p_name", "p_type"]).select("p_partkey", F.explode(forms).alias("text"))


# Packing -------------------------------------------------------------------------------------------------------


def _pack_sql(size: int, key: str) -> str:
    return f"WITH t AS (SELECT *, {key} AS part FROM (SELECT doc_id, source, text, row_number() OVER (ORDER BY doc_id) - 1 AS rn FROM documents)), e AS (SELECT part, doc_id, unnest(w) AS w, unnest(range(len(w))) AS i FROM (SELECT part, doc_id, {_TOK} AS w FROM t)), o AS (SELECT part, w, row_number() OVER (PARTITION BY part ORDER BY doc_id, i) - 1 AS pos FROM e) SELECT part, (pos // {size})::BIGINT AS block, string_agg(w, ' ' ORDER BY pos) AS text FROM o GROUP BY part, pos // {size} HAVING count(*) = {size}"


def _packed(d: DataFrame, size: int, tokens: Column | None = None, is_arranged: bool = False) -> DataFrame:
    return K.pack(d, T.tokens(F.col("text")) if tokens is None else tokens, size, ["part"], ["doc_id"], is_arranged, words=True).select("part", "block", F.array_join("tokens", " ").alias("text"))


@query(_pack_sql(128, "source"))
def t2_pack_blocks(spark, sf_dir):
    return _packed(table(spark, sf_dir, "documents").withColumn("part", F.col("source")), 128)


@query(_pack_sql(128, "rn // 100"))
def t3_pack_batches(spark, sf_dir):
    # rows that are numbered in their order are in order of their batches
    return _packed(with_index(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"]).withColumn("part", F.floor(F.col("idx") / 100)), 128, is_arranged=True)


@query(_pack_sql(span_lengths(512)[0], "0::BIGINT"))
def t4_pack_t5(spark, sf_dir):
    return _packed(table(spark, sf_dir, "documents").withColumn("part", F.lit(0).cast("long")), span_lengths(512)[0])


@query(f"SELECT sum(n // 128 * 128)::BIGINT AS tokens, sum(n // 128)::BIGINT AS blocks FROM (SELECT source, sum(len({_TOK})) AS n FROM documents GROUP BY 1)")
def a2_total_tokens(spark, sf_dir):
    per = table(spark, sf_dir, "documents").groupBy("source").agg(F.sum(F.size(T.tokens(F.col("text")))).alias("n"))
    blocks = F.sum(F.floor(F.col("n") / 128))
    return per.agg((blocks * 128).cast("long").alias("tokens"), blocks.cast("long").alias("blocks"))


@query()
def e1_pipeline(spark, sf_dir):
    """Clean, drop near duplicates, filter, chunk and pack."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    unique = docs.join(N.representatives(N.cluster(spread(docs.select("doc_id", "text")), 0.95, min_length=1)), "doc_id", "left_semi")
    # Cleaned where the tokens are made, which is once: a filter would be done before the shuffle, and once more to sample it.
    kept = T.let(T.clean(F.col("text")), lambda t: F.when(~T.contains_any(F.lower(t), T.EXAM_PHRASES), T.tokens(F.concat(F.lit("<s>"), t, F.lit("</s>")))))
    return _packed(unique.withColumn("part", F.col("source")), 128, kept)
