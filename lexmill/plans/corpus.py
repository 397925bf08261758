"""Tagging, mixing and deduplicating documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import query
from ..functions import text as X
from ..operators import chunks, dedupe, models, relational as R, spans as S, taggers
from ..operators.mix import Condition, MixSpec, Replacement, mix, recipe, redacted
from ..session import read_dealt

WS = r"[ \t\n\x0B\f\r]"
WORDS = rf"list_filter(string_split_regex(text, '{WS}+'), lambda x: x <> '')"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return read_dealt(spark, path) if name in ("documents", "pages") else spark.read.parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the language as the score that a classifier would give."""
    return read(spark, sf_dir, "documents").withColumn("english", S.whole(F.col("text"), (F.col("lang") == "en").cast("double")))


@query(f"""SELECT source, count(*) AS documents, sum(len({WORDS}))::BIGINT AS tokens, sum(length(text))::BIGINT AS characters,
  sum(octet_length(encode(text)))::BIGINT AS bytes FROM documents GROUP BY source""")
def size_stats_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.size_stats(read(spark, sf_dir, "documents"), ["source"])


@query(f"""SELECT count(*) AS documents, sum(len({WORDS}))::BIGINT AS tokens, sum(length(text))::BIGINT AS characters,
  sum(octet_length(encode(text)))::BIGINT AS bytes, 1::BIGINT AS shards FROM documents""")
def size_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = F.regexp_extract(F.col("_metadata.file_path"), r"documents\.parquet", 0).alias("file")
    return R.size_stats(read_dealt(spark, f"{sf_dir}/documents.parquet", F.col("text"), file), file_col="file")


def _filter(spark: SparkSession, sf_dir: str, **rules) -> DataFrame:
    return mix(documents(spark, sf_dir), recipe("q", duplicate=False, **rules)).select("doc_id", "source")


@query("SELECT doc_id, source FROM documents WHERE NOT length(text) <= 100")
def length_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filter(spark, sf_dir, chars=100)


@query("SELECT doc_id, source FROM documents WHERE NOT length(text) <= 700")
def length_filter_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filter(spark, sf_dir, chars=700)


@query(f"SELECT doc_id, source FROM documents WHERE NOT len({WORDS}) <= 20")
def token_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filter(spark, sf_dir, tokens=20)


@query("SELECT doc_id, source FROM documents WHERE lang = 'en'")
def language_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filter(spark, sf_dir, english=True)


@query(f"SELECT doc_id, source FROM documents WHERE lang = 'en' AND length(text) > 100 AND len({WORDS}) > 20")
def mix_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filter(spark, sf_dir, english=True, chars=100, tokens=20)


@query("SELECT doc_id, source FROM documents WHERE lang = 'en' AND NOT starts_with(source, 'src1')")
def mix_include(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = MixSpec("q", exclude=(Condition("metadata", "source", "startswith", "src1"),), include=(Condition("attributes", "english", ">", 0.5),))
    return mix(documents(spark, sf_dir), spec).select("doc_id", "source")


@query("SELECT d.doc_id, d.source FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.quality IS NULL OR NOT l.quality <= 0.0001")
def quality_label_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = F.when(F.col("quality").isNotNull(), S.whole(F.col("text"), F.col("quality").cast("double")))
    docs = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left").withColumn("quality", score)
    return mix(docs, recipe("q", duplicate=False, quality=True)).select("doc_id", "source")


def _redact(kind: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        name = f"pii_{kind}"
        docs = mix(read(spark, sf_dir, "documents"), MixSpec("q", replace=(Replacement(name, f"<{kind}>", 0.1),)))
        return docs.select("doc_id", "text")

    return run


def _redact_sql(kind: str) -> str:
    return f"SELECT doc_id, regexp_replace(text, '{taggers.PII[kind]}', '<{kind}>', 'g') AS text FROM documents"


for _name, _kind in (("pii_email_replace", "EMAIL_ADDRESS"), ("pii_phone_replace", "PHONE_NUMBER"), ("pii_ip_replace", "IP_ADDRESS")):
    _run = _redact(_kind)
    _run.__name__ = _name
    query(_redact_sql(_kind))(_run)


@query(f"""SELECT doc_id, len(regexp_extract_all(text, '{taggers.PII["EMAIL_ADDRESS"]}'))::BIGINT AS emails, len(regexp_extract_all(text, '{taggers.PII["IP_ADDRESS"]}'))::BIGINT AS addresses FROM documents""")
def pii_span_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = taggers.tag(read(spark, sf_dir, "documents"), ["pii_EMAIL_ADDRESS", "pii_IP_ADDRESS"])
    return tagged.select("doc_id", F.size(F.col("attributes")["pii_EMAIL_ADDRESS"]).cast("long").alias("emails"), F.size(F.col("attributes")["pii_IP_ADDRESS"]).cast("long").alias("addresses"))


#: Lines that the test corpus repeats.
BOILERPLATE = ["All rights reserved.", "Licensed under the Apache License, Version 2.0.", "Click here to subscribe.", "Read more"]


@query(f"""WITH p AS (SELECT doc_id, unnest(regexp_extract_all(text, '([^\\n]*\\n|[^\\n]+)')) AS line, generate_subscripts(regexp_extract_all(text, '([^\\n]*\\n|[^\\n]+)'), 1) AS k FROM documents)
  SELECT d.doc_id, coalesce(string_agg(line, '' ORDER BY k) FILTER (WHERE regexp_replace(line, '^{WS}+|{WS}+$', '', 'g') NOT IN ({", ".join(f"'{x}'" for x in BOILERPLATE)})), '') AS text
  FROM documents d LEFT JOIN p USING (doc_id) GROUP BY d.doc_id""")
def line_blocklist_remove(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("lines_found", S.of_lines(F.col("text"), BOILERPLATE))
    return mix(docs, MixSpec("q", replace=(Replacement("lines_found", "", 0.1),))).select("doc_id", "text")


@query("""WITH t AS (SELECT doc_id, '  12 ' || chr(10) || text || chr(10) || '[[Page 7]]' AS text FROM documents), p AS (SELECT doc_id, unnest(regexp_extract_all(text, '([^\\n]*\\n|[^\\n]+)')) AS line, generate_subscripts(regexp_extract_all(text, '([^\\n]*\\n|[^\\n]+)'), 1) AS k FROM t)
  SELECT doc_id, string_agg(line, '' ORDER BY k) FILTER (WHERE NOT regexp_matches(line, '^\\s*\\d+\\s*$') AND NOT regexp_matches(line, '^\\s*\\[\\[Page [0-9]+\\]\\]\\s*$')) AS text FROM p GROUP BY doc_id""")
def page_line_remove(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("text", F.concat(F.lit("  12 \n"), "text", F.lit("\n[[Page 7]]")))
    return mix(docs, MixSpec("q", replace=(Replacement("page_numbers", "", 0.1), Replacement("page_regulations", "", 0.1)))).select("doc_id", "text")


@query("SELECT doc_id, replace(replace(replace(text, '. ', '.  '), chr(10), chr(10) || chr(10)), chr(10) || chr(10), chr(10)) AS once, replace(replace(text, '. ', '.  '), '  ', ' ') AS spaced FROM documents")
def double_newline_and_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = F.replace(F.col("text"), F.lit(". "), F.lit(".  "))
    docs = read(spark, sf_dir, "documents").select("doc_id", F.replace(wide, F.lit("\n"), F.lit("\n\n")).alias("text"), wide.alias("spaced"))
    docs = mix(docs, MixSpec("q", replace=(Replacement("double_newline", "\n", 0.1),))).withColumnRenamed("text", "once")
    return mix(docs, MixSpec("q", replace=(Replacement("double_space", " ", 0.1),)), "spaced").select("doc_id", "once", "spaced")


@query("SELECT doc_id, (doc_id > min(doc_id) OVER (PARTITION BY text))::DOUBLE AS score FROM documents")
def exact_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.exact_duplicates(read(spark, sf_dir, "documents"))


@query(f"""WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents), g AS (SELECT doc_id, array_to_string(ws[k:k + 19], ' ') AS gram FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS k FROM w WHERE len(ws) >= 20)),
  f AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY gram) < doc_id AS seen FROM g)
  SELECT doc_id, count(*) AS n_ngrams, round(avg(seen::INT), 9) AS overlap FROM f GROUP BY doc_id""")
def ngram_dedupe_20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.ngram_overlap(read(spark, sf_dir, "documents"), 20).withColumn("overlap", F.round("overlap", 9))


@query(f"""WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS paragraph FROM documents),
  w AS (SELECT doc_id, paragraph, {WORDS} AS ws FROM p), g AS (SELECT doc_id, paragraph, array_to_string(ws[k:k + 19], ' ') AS gram FROM (SELECT doc_id, paragraph, ws, unnest(range(1, len(ws) - 18)) AS k FROM w WHERE len(ws) >= 20)),
  f AS (SELECT doc_id, paragraph, (doc_id, paragraph) > min((doc_id, paragraph)) OVER (PARTITION BY gram) AS seen FROM g)
  SELECT doc_id, paragraph::INT AS paragraph, round(avg(seen::INT), 9) AS overlap FROM f GROUP BY doc_id, paragraph HAVING avg(seen::INT) >= 0.5""")
def paragraph_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedupe.paragraph_overlap(read(spark, sf_dir, "documents"), 20)
    return found.filter("overlap >= 0.5").withColumn("overlap", F.round("overlap", 9))


@query(f"""WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS paragraph FROM documents),
  w AS (SELECT doc_id, paragraph, {WORDS} AS ws FROM p), g AS (SELECT doc_id, paragraph, array_to_string(ws[k:k + 19], ' ') AS gram FROM (SELECT doc_id, paragraph, ws, unnest(range(1, len(ws) - 18)) AS k FROM w WHERE len(ws) >= 20)),
  f AS (SELECT doc_id, paragraph, (doc_id, paragraph) > min((doc_id, paragraph)) OVER (PARTITION BY gram) AS seen FROM g),
  o AS (SELECT doc_id, paragraph, avg(seen::INT) AS overlap FROM f GROUP BY doc_id, paragraph HAVING avg(seen::INT) >= 0.5)
  SELECT d.doc_id, round(sum(o.overlap * length(p.text)) / any_value(length(d.text)), 6) AS coverage FROM o JOIN p USING (doc_id, paragraph) JOIN documents d USING (doc_id) GROUP BY d.doc_id""")
def duplicate_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = dedupe.duplicate_spans(docs)
    return docs.join(found, "doc_id").select("doc_id", F.round(S.coverage(F.col("spans"), F.col("text")), 6).alias("coverage"))


@query("""SELECT doc_id, list_max(list_transform(string_split(text, chr(10)), lambda x: length(x)))::BIGINT AS max_line_length, round((length(text) - len(string_split(text, chr(10))) + 1) / len(string_split(text, chr(10))), 6) AS avg_line_length,
  round(length(regexp_replace(text, '[^A-Za-z0-9]', '', 'g')) / length(text), 6) AS alnum_prop FROM documents""")
def code_line_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = taggers.code_stats(F.col("text"))
    return read(spark, sf_dir, "documents").select("doc_id", stats["max_line_length"].alias("max_line_length"), F.round(stats["avg_line_length"], 6).alias("avg_line_length"), F.round(stats["alnum_prop"], 6).alias("alnum_prop"))


@query(f"""WITH w AS (SELECT doc_id, {WORDS} AS ws, list_filter(string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13)) <> '') AS ls FROM documents)
  SELECT doc_id, len(ws)::BIGINT AS word_count, round(coalesce(list_median(list_transform(ws, lambda x: length(x))), 0), 6) AS median_word_length,
  len(list_intersect(['the','be','to','of','and','that','have','with'], ws))::BIGINT AS required_words, round(coalesce(len(list_filter(ws, lambda x: regexp_matches(x, '[A-Za-z]'))) / len(ws), 0), 6) AS alpha_word_fraction,
  round(1 - len(list_distinct(ls)) / len(ls), 6) AS duplicate_line_fraction FROM w""")
def gopher_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = taggers.gopher_basic(F.col("text"))
    rounded = lambda n: F.round(g[n], 6).alias(n)
    return read(spark, sf_dir, "documents").select("doc_id", g["word_count"].alias("word_count"), rounded("median_word_length"), g["required_words"].alias("required_words"), rounded("alpha_word_fraction"), rounded("duplicate_line_fraction"))


@query()
def language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document by a model of four fifths of them; the others are held out."""
    docs = read(spark, sf_dir, "documents").withColumn("held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    model = models.train(docs.filter("not held_out"), "lang")
    return models.predicted(docs, model).select("doc_id", "lang", "held_out", "predicted", F.round("predicted_score", 6).alias("score"))


@query()
def language_model_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filter for English by a model's score, for this query alone, trained on four fifths of the documents."""
    docs = read(spark, sf_dir, "documents").withColumn("held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    model = models.train(docs.filter("not held_out"), "lang")
    with taggers.registered(english=models.class_tagger(model, "en")):
        return mix(docs, recipe("q", english=True, duplicate=False)).select("doc_id", "lang", "held_out")


@query()
def toxic_model_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences that a model of toxic documents takes for likely toxic are cut, those of the held out documents too; removed counts their characters."""
    docs = read(spark, sf_dir, "documents")
    labels = read(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = docs.join(labels, "doc_id").filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    model = models.train(known, "toxic", balanced=True)
    with taggers.registered(toxic_sentence=models.sentence_tagger(model, 1)):
        spec = MixSpec("q", replace=(Replacement("toxic_sentence", "", 0.5),))
        cut = mix(docs, spec).select("doc_id", F.col("text").alias("kept"))
    return docs.select("doc_id", F.length("text").alias("size")).join(cut, "doc_id").select("doc_id", "kept", (F.col("size") - F.length("kept")).alias("removed"))


@query()
def gopher_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = taggers.gopher_repeats(read(spark, sf_dir, "documents"))
    return docs.filter(taggers.gopher_keeps(taggers.gopher_basic(F.col("text")), F.col("repeats"))).select("doc_id")


@query("SELECT doc_id, contains(text, '{') AS curly, contains(lower(text), 'lorem ipsum') AS lorem, contains(lower(text), 'javascript') AS script FROM documents")
def c4_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return read(spark, sf_dir, "documents").select("doc_id", taggers.curly_brace(t).alias("curly"), taggers.lorem_ipsum(t).alias("lorem"), taggers.javascript(t).alias("script"))


@query()
def longest_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", taggers.repetitions(F.col("text")).alias("words"))


@query(f"""WITH w AS (SELECT doc_id, unnest({WORDS.replace("text", "lower(text)")}) AS word FROM documents), c AS (SELECT word, count(*)::DOUBLE AS n FROM w GROUP BY word), k AS (SELECT * FROM c WHERE n > 2), t AS (SELECT sum(n) AS total, count(*) AS kinds FROM k),
  s AS (SELECT doc_id, avg(coalesce(log2(k.n) - log2(total), log2(sqrt(kinds) + 1) - log2(total))) AS p FROM w LEFT JOIN k USING (word) CROSS JOIN t GROUP BY doc_id)
  SELECT d.doc_id, round(coalesce(s.p, 0), 5) AS logprob FROM documents d LEFT JOIN s USING (doc_id)""")
def unigram_log_probability(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    counts = docs.select(F.explode(X.words(F.lower("text"))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("count")).filter("count > 2")
    return taggers.mean_log_probability(docs, taggers.unigram_table(counts)).withColumn("logprob", F.round("logprob", 5))


@query()
def paragraph_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", F.explode(chunks.paragraph_chunks(F.col("text"))).alias("s")).select("doc_id", "s.kind", "s.start", "s.end", "s.score")


@query()
def paragraph_reflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks are found once and all four kinds of span taken from them."""
    docs = read(spark, sf_dir, "documents").withColumn("_chunks", S.apart(chunks.paragraph_chunks(F.col("text"))))
    for name in chunks.KINDS:
        docs = docs.withColumn(name, chunks.of_kind(F.col("_chunks"), name))
    return mix(docs, recipe("q", duplicate=False, edits=(Replacement("paragraph_chunk", "", max_score=0.1), Replacement("terminal_newline", "", 0.1), Replacement("terminal_newline_with_space", " ", 0.1), Replacement("paragraph_terminal_newline", "\n\n", 0.1)))).select("doc_id", "text")


@query(f"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '{taggers.PII["EMAIL_ADDRESS"]}', '<EMAIL_ADDRESS>', 'g'), '{taggers.PII["PHONE_NUMBER"]}', '<PHONE_NUMBER>', 'g'), '{taggers.PII["IP_ADDRESS"]}', '<IP_ADDRESS>', 'g') AS text
  FROM documents WHERE lang = 'en' AND length(text) > 100 AND len({WORDS}) > 20""")
def mix_and_redact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The open-crawl recipe as far as native taggers go, with personal data replaced kind by kind."""
    return redacted(mix(documents(spark, sf_dir), recipe("q", english=True, chars=100, tokens=20, duplicate=False)), "EPI").select("doc_id", "text")


def tag_filter_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: tag, filter, redact and size by source; one shuffle, of partial sums."""
    kept = mix(documents(spark, sf_dir), recipe("q", english=True, chars=100, tokens=20, duplicate=False))
    return R.size_stats(redacted(kept, "EPI"), ["source"])


query(f"""WITH m AS (SELECT source, regexp_replace(regexp_replace(regexp_replace(text, '{taggers.PII["EMAIL_ADDRESS"]}', '<EMAIL_ADDRESS>', 'g'), '{taggers.PII["PHONE_NUMBER"]}', '<PHONE_NUMBER>', 'g'), '{taggers.PII["IP_ADDRESS"]}', '<IP_ADDRESS>', 'g') AS text
  FROM documents WHERE lang = 'en' AND length(text) > 100 AND len({WORDS}) > 20)
  SELECT source, count(*) AS documents, sum(len({WORDS}))::BIGINT AS tokens, sum(length(text))::BIGINT AS characters, sum(octet_length(encode(text)))::BIGINT AS bytes FROM m GROUP BY source""")(tag_filter_size)
