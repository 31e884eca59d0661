"""Queries over templates, transcripts, tokenizers, recipes and further record operators, beside those of ``catalogue``."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusforge.functions import text as T
from corpusforge.operators import dialogs as D
from corpusforge.operators import records as R
from corpusforge.operators import templates as I
from corpusforge.operators import vectors as V
from corpusforge.operators.ordering import with_index
from corpusforge.operators.packing import arranged
from corpusforge.plans.catalogue import _CHAT, _TOK, _any, query, table
from corpusforge.plans.recipes import RECIPES, blocks, combine

_PART = "(SELECT p_partkey, p_name AS n, p_type AS t, p_brand AS b FROM part)"
_PAIR = f"(SELECT conv_id, k, chat[2 * k + 1].text AS q, chat[2 * k + 2].text AS a FROM (SELECT conv_id, chat, unnest(range(len(chat) // 2)) AS k FROM {_CHAT}))"


def _pairs(spark, sf_dir):
    return D.gather(table(spark, sf_dir, "conversations")).select("conv_id", F.explode(D.turn_pairs(F.col("chat"))).alias("p")).select("conv_id", F.col("p.k").cast("long").alias("k"), "p.q", "p.a")


def _words_of(column: str) -> str:
    return _TOK.replace("text", column, 1)


@query(f"SELECT conv_id, k, coalesce({_any('lower(q)', T.CLOSING_PHRASES)} OR length(q) < 10 OR length(a) < 10 OR least(len(list_distinct({_words_of('q')})) / len({_words_of('q')}), len(list_distinct({_words_of('a')})) / len({_words_of('a')})) < 0.5, true) AS bad FROM {_PAIR}")
def f7_transcript_reject(spark, sf_dir):
    return _pairs(spark, sf_dir).select("conv_id", "k", T.transcript_rejected(F.col("q"), F.col("a")).alias("bad"))


@query("SELECT doc_id, contains(text, '```') AS fence, contains(text, 'Request unsuccessful') AS failed FROM documents WHERE text IS NOT NULL")
def f5_f14_f1b_marks(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").where(t.isNotNull()).select("doc_id", T.has_fence(t).alias("fence"), T.contains_any(t, T.FAILED_REQUEST).alias("failed"))


@query(f"SELECT conv_id, chat[2].text || ' ' || chat[4].text AS text FROM {_CHAT} WHERE len(chat) = 4")
def f20_i5_paired_lists(spark, sf_dir):
    chat = D.gather(table(spark, sf_dir, "conversations")).select("conv_id", F.transform("chat", lambda t: t["text"]).alias("w"))
    both = chat.select("conv_id", I.paired_lists(F.slice("w", 1, 2), F.slice("w", F.lit(3), F.size("w"))).alias("text"))
    return both.where("text IS NOT NULL")


@query("SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS name, CASE WHEN contains(url, 'news') THEN 'news' WHEN contains(url, 'blog') THEN 'blog' ELSE 'other' END AS route, '/data/' || regexp_extract(url, '([^/]*)$', 1) AS moved FROM pages")
def f22_p19_k14_paths(spark, sf_dir):
    u = F.col("url")
    route = F.when(u.contains("news"), "news").when(u.contains("blog"), "blog").otherwise("other")
    return table(spark, sf_dir, "pages").select("page_id", T.base_name(u).alias("name"), route.alias("route"), T.rebased("/data", T.base_name(u)).alias("moved"))


@query("SELECT event_id, json_extract_string(r, '$.r.result') AS text FROM (SELECT event_id, '{\"r\": {\"responseCode\": ' || CASE event_type WHEN 'click' THEN 200 ELSE 404 END || ', \"result\": \"' || event_type || '\"}}' AS r FROM events) WHERE json_extract(r, '$.r.responseCode')::INTEGER = 200")
def f23_n1_i4d_nested_result(spark, sf_dir):
    code = F.when(F.col("event_type") == "click", 200).otherwise(404)
    record = F.to_json(F.struct(F.struct(code.alias("responseCode"), F.col("event_type").alias("result")).alias("r")))
    rows = table(spark, sf_dir, "events").select("event_id", record.alias("r"))
    return rows.where(I.nested(F.col("r"), "r", "responseCode").cast("int") == 200).select("event_id", I.nested(F.col("r"), "r", "result").alias("text"))


@query("SELECT vec_id, NOT list_bool_or(list_transform(embedding, lambda s: s::DOUBLE <= -0.25)) AS accepted FROM embeddings")
def f26_score_gate(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", T.scores_accepted(F.col("embedding").cast("array<double>"), -0.25).alias("accepted"))


@query("SELECT p_partkey, 'p name: ' || array_to_string(string_split(p_name, ' '), chr(10)) || chr(10) || 'p type: ' || p_type AS text FROM part")
def f27_p7_flatten_lists(spark, sf_dir):
    record = F.to_json(F.struct(F.split("p_name", " ").alias("p_name"), F.lit("x").alias("short"), "p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", R.flatten_record(record, 3).alias("text"))


@query(f"SELECT p_partkey, n || chr(10) || chr(10) || b AS titled, coalesce(nullif(b, 'Brand#11'), '') AS brand, n || chr(10) || t || chr(10) || b AS lines, n || chr(10) || 'Jawapan: ' || t AS exam, n || chr(10) || t || chr(10) || b || chr(10) || chr(10) || 'Jawapan: ' || t AS objective FROM {_PART}")
def p6_n2_i4c_i4k_forms(spark, sf_dir):
    n, t, b = F.col("p_name"), F.col("p_type"), F.col("p_brand")
    return table(spark, sf_dir, "part").select("p_partkey", T.titled(n, b).alias("titled"), F.coalesce(F.nullif(b, F.lit("Brand#11")), F.lit("")).alias("brand"), I.by_lines(n, t, b).alias("lines"), I.exam(n, t).alias("exam"), I.exam_of_objective(n, t, b, t).alias("objective"))


@query(f"SELECT p_partkey, unnest([h || t, h || 'Jawapan: ' || t]) AS text FROM (SELECT p_partkey, t, n || chr(10) || t || chr(10) || 'A. ' || b || chr(10) || 'B. ' || t || chr(10) AS h FROM {_PART})")
def i4h_choice_forms(spark, sf_dir):
    n, t, b = F.col("p_name"), F.col("p_type"), F.col("p_brand")
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(I.choice_forms(n, t, F.create_map(F.lit("A"), b, F.lit("B"), t), t)).alias("text"))


@query(f"SELECT p_partkey, n || chr(10) || chr(10) || q || chr(10) || 'A. ' || n || chr(10) || 'B. ' || t || chr(10) || 'C. ' || b || chr(10) || 'D. ' || q || chr(10) || 'Jawapan: ' || b AS text FROM (SELECT *, unnest([t, b]) AS q FROM {_PART})")
def i4i_g4_n6_paragraph_questions(spark, sf_dir):
    n, t, b = F.col("p_name"), F.col("p_type"), F.col("p_brand")
    asked = F.array(*[F.struct(q.alias("question"), n.alias("A"), t.alias("B"), b.alias("C"), q.alias("D"), b.alias("answer")) for q in (t, b)]).cast(I.QUESTIONS)
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(I.paragraph_questions(n, asked)).alias("text"))


@query("WITH p AS (SELECT p_partkey, p_name, string_split(p_name, ' ') AS w FROM part), c AS (SELECT *, list_transform(w, lambda x, i: chr(64 + i::INTEGER) || '. ' || x) AS l FROM p) SELECT p_partkey, 'Jawab soalan berikut.' || chr(10) || p_name || chr(10) || chr(10) || array_to_string(l, chr(10)) || chr(10) || 'Jawapan: ' || coalesce(string_split(list_filter(l, lambda x: contains(x, w[2]))[1], '.')[1], 'None') AS text FROM c")
def i4l_j7_numbered_exam(spark, sf_dir):
    w = F.split("p_name", " ")
    lines = F.array_join(F.transform(w, lambda x, i: F.concat(F.char(i + 65), F.lit(". "), x)), "\n\n")
    return table(spark, sf_dir, "part").select("p_partkey", I.numbered_exam(F.concat(F.col("p_partkey").cast("string"), F.lit(") "), "p_name"), lines, F.concat(F.lit(" "), F.get(w, F.lit(1)))).alias("text"))


@query(f"SELECT conv_id, k, 'below is the text from pseudolabel youtube videos in Malay and English,' || chr(10) || chr(10) || 'Malay:' || chr(10) || q || chr(10) || chr(10) || 'English:' || chr(10) || a AS transcript, CASE WHEN length(q) > 0 AND length(a) > 0 AND len({_words_of('q')}) < 2000 AND len({_words_of('a')}) < 2000 AND NOT {_any('a', T.LEXICON)} THEN 'Kelantanese to Standard Malay: ' || q || ' ' || a END AS dialect FROM {_PAIR}")
def i6_g3_transcript_dialect(spark, sf_dir):
    q, a = F.col("q"), F.col("a")
    return _pairs(spark, sf_dir).select("conv_id", "k", I.transcript(q, a).alias("transcript"), I.dialect("Kelantanese", q, a).alias("dialect"))


@query("SELECT doc_id, source, n AS docs FROM documents JOIN (SELECT source AS s, count(*) AS n FROM documents GROUP BY 1) ON source IS NOT DISTINCT FROM s")
def j8_count_lookup(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    counts = d.groupBy(F.col("source").alias("_s")).agg(F.count(F.lit(1)).alias("docs"))
    return d.join(counts, F.col("source").eqNullSafe(F.col("_s"))).select("doc_id", "source", "docs")


@query()
def d11_j2_cosine_singletons_040(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return V.singletons(vectors, V.cosine_edges(vectors, 0.4))


@query("SELECT vec_id, greatest(0.2 / sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) / len(embedding)), 1) AS gain FROM embeddings")
def h11_rms_gain(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", T.rms_gain(F.col("embedding").cast("array<double>"), 0.2).alias("gain"))


@query(f"SELECT conv_id, k, floor(1000 / octet_length(encode(q)) * octet_length(encode(a)))::BIGINT AS frames FROM {_PAIR} WHERE octet_length(encode(q)) > 0")
def h11_speech_frames(spark, sf_dir):
    return _pairs(spark, sf_dir).where(F.octet_length("q") > 0).select("conv_id", "k", T.speech_frames(F.lit(1000), F.col("q"), F.col("a")).alias("frames"))


@query("SELECT source, printf('%.2f MB', sum(octet_length(encode(text))) / 1048576.0) AS size FROM documents GROUP BY 1")
def h12_source_sizes(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source").agg(T.megabytes(F.sum(F.octet_length("text"))).alias("size"))


@query("SELECT source, ((row_number() OVER (ORDER BY regexp_extract(source, '([0-9]+)$', 1)::BIGINT NULLS FIRST, source NULLS FIRST) - 1) // 3)::BIGINT AS batch FROM (SELECT DISTINCT source FROM documents)")
def l4_l7_numbered_batches(spark, sf_dir):
    names = table(spark, sf_dir, "documents").select("source").distinct().withColumn("n", F.regexp_extract("source", "([0-9]+)$", 1).try_cast("long"))
    return with_index(names, ["n", "source"], "i").select("source", F.floor(F.col("i") / 3).alias("batch"))


@query(f"SELECT doc_id, array_to_string(w, ' ') AS input_ids, array_to_string(list_transform(w, lambda x: 0), ' ') AS token_type_ids, array_to_string(list_transform(w, lambda x: 1), ' ') AS attention_mask FROM (SELECT doc_id, list_transform({_TOK}, lambda x: length(x)) AS w FROM documents)")
def t7_model_columns(spark, sf_dir):
    """Model columns, with the lengths of words for ids, each shown as one string."""
    from corpusforge.operators.tokenizers import model_columns

    ids = table(spark, sf_dir, "documents").select("doc_id", F.transform(T.tokens(F.col("text")), lambda w: F.length(w)).alias("ids"))
    columns = ids.select("doc_id", *model_columns(F.col("ids")))
    return columns.select("doc_id", *[F.array_join(F.col(c).cast("array<string>"), " ").alias(c) for c in ("input_ids", "token_type_ids", "attention_mask")])


@query()
def e2_recipe_blocks(spark, sf_dir):
    """The chunks and blocks of one family's recipe."""
    recipe = RECIPES["llama-v1"]
    docs = arranged(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), ["source"], ["doc_id"])
    return blocks(combine(docs, recipe), recipe, is_arranged=True).select("source", "block", F.array_join("tokens", " ").alias("text"))
