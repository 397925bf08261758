"""Joins, aggregations, orders and layout over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import query
from .corpus import read
from ..functions import licenses as L
from ..functions import urls as U
from ..operators import dedupe, layout, relational as R, threads, tokenize
from ..sources import documents as D
from ..sources import files


@query("SELECT d.doc_id, d.text AS old_text, lower(d.text) AS new_text FROM documents d WHERE d.lang = 'en'")
def version_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return R.version_join(docs, docs.filter("lang = 'en'").withColumn("text", F.lower("text")), "doc_id")


@query("SELECT doc_id, source FROM documents WHERE lang <> 'en'")
def missing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return R.missing_from(docs, docs.filter("lang = 'en'"), "doc_id").select("doc_id", "source")


@query("SELECT doc_id, CASE WHEN lang = 'en' THEN 'new' ELSE 'old' END AS version FROM documents")
def merge_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return R.merged(docs.select("doc_id", F.lit("old").alias("version")), docs.filter("lang = 'en'").select("doc_id", F.lit("new").alias("version")), "doc_id")


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def semi_join_on_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = read(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return R.on_list(read(spark, sf_dir, "orders"), listed, "o_custkey").select("o_orderkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def anti_join_skip_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers who never ordered: all orders are the list."""
    seen = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return R.not_on_list(read(spark, sf_dir, "customer"), seen, "c_custkey").select("c_custkey")


@query("SELECT DISTINCT CASE WHEN length(doc_id::VARCHAR) < 6 THEN lpad(doc_id::VARCHAR, 6, '0') ELSE doc_id::VARCHAR END AS item FROM documents WHERE lang IN ('en', 'fr')")
def licensed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    uris = read(spark, sf_dir, "documents").select(F.col("lang").alias("license"), F.concat(F.lit("http://x/item/"), F.col("doc_id").cast("string")).alias("uri"))
    return R.licensed_items(uris, ["en", "fr"])


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'new' ELSE source END AS file FROM documents")
def index_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index holds all ids but every sixth, which come with the new ones, as do some that it has."""
    docs = read(spark, sf_dir, "documents")
    old, new = docs.filter("doc_id % 6 <> 0").select("doc_id", F.col("source").alias("file")), docs.filter("doc_id % 2 = 0").select("doc_id", F.lit("new").alias("file"))
    return R.upsert(old, new, "doc_id", "file").select("doc_id", "file")


@query("SELECT lang, count(*) AS missing FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY lang")
def missing_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.missing_by(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), "doc_id", "lang")


@query("SELECT doc_id, (doc_id // 37)::INT AS shard FROM documents WHERE doc_id % 37 < 30")
def range_shard_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id")
    shards = docs.select(F.expr("cast(doc_id div 37 as int)").alias("shard")).distinct().withColumn("start", F.col("shard").cast("long") * 37).withColumn("end", F.col("start") + 29)
    return R.range_lookup(docs, shards, "doc_id")


@query("""WITH s AS (SELECT doc_id AS start, 'shard' || doc_id AS shard FROM documents WHERE doc_id % 41 = 7) SELECT d.doc_id, s.shard FROM documents d ASOF LEFT JOIN s ON d.doc_id >= s.start""")
def as_of_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id")
    starts = docs.filter("doc_id % 41 = 7").select(F.col("doc_id").alias("start"), F.concat(F.lit("shard"), F.col("doc_id").cast("string")).alias("shard"))
    return R.as_of(docs, starts, "doc_id")


@query("SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def language_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.histogram(read(spark, sf_dir, "documents"), "lang")


@query("SELECT n_regionkey, list(n_name ORDER BY n_name) AS n_names FROM nation GROUP BY n_regionkey")
def group_to_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.listed_by(read(spark, sf_dir, "nation"), "n_regionkey", "n_name")


@query("""WITH s AS (SELECT source, lang, sum(length(text)) AS size, min(doc_id) AS first FROM documents GROUP BY source, lang), b AS (SELECT source, lang FROM s WHERE size > 0 QUALIFY row_number() OVER (PARTITION BY source ORDER BY size DESC, first) = 1)
  SELECT doc_id, source, lang FROM documents SEMI JOIN b USING (source, lang)""")
def largest_edition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.largest_edition(read(spark, sf_dir, "documents"), "source", "lang", "text", "doc_id").select("doc_id", "source", "lang")


@query("SELECT doc_id, source, lang FROM documents QUALIFY row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) = 1")
def drop_duplicates_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.keep_first(read(spark, sf_dir, "documents").select("doc_id", "source", "lang"), ["source", "lang"], ["doc_id"])


@query("SELECT page_id, url FROM pages QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id) = 1")
def url_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.keep_first(read(spark, sf_dir, "pages").select("page_id", "url"), ["url"], ["page_id"])


HOSTS = ["ththre.example.com", "www.therha.example.com", "thther.example.org"]


@query("""WITH p AS (SELECT page_id, regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//([^/?#]*)', 1) AS host FROM pages)
  SELECT page_id FROM p WHERE host IN ('ththre.example.com', 'www.ththre.example.com', 'www.therha.example.com', 'therha.example.com', 'thther.example.org', 'www.thther.example.org')""")
def url_host_allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.on_hosts(read(spark, sf_dir, "pages"), spark.createDataFrame([(h,) for h in HOSTS], "host string")).select("page_id")


@query(f"""WITH p AS (SELECT page_id, regexp_replace(url, '/(en|fr)/', '/tag/') AS url FROM pages), q AS (SELECT page_id, regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//([^/?#]*)', 1) AS host, regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?(?://[^/?#]*)?([^?#]*)', 1) AS path FROM p)
  SELECT page_id FROM q WHERE host NOT IN ('youtu.be', 'youtube.com', 'www.youtube.com') AND path <> '/' AND NOT regexp_matches(path, '{"|".join(U.BLOCKED_PATHS)}')""")
def url_path_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").withColumn("url", F.regexp_replace("url", "/(en|fr)/", "/tag/"))
    return pages.filter(U.is_article(F.col("url"))).select("page_id")


@query("""SELECT conv_id::VARCHAR AS id, string_agg(text, chr(10) ORDER BY turn) AS text, list(DISTINCT role ORDER BY role) AS roles FROM conversations GROUP BY conv_id""")
def conversation_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("t"), F.sort_array(F.collect_set("role")).alias("roles"))
    return turns.select(F.col("conv_id").cast("string").alias("id"), F.array_join(F.transform("t", lambda x: x.text), "\n").alias("text"), "roles")


@query("""WITH q AS (SELECT conv_id, text FROM conversations WHERE turn = 0), a AS (SELECT conv_id, turn, text, (turn * 7 + conv_id) % 5 AS score, turn = 3 AS accepted FROM conversations WHERE turn > 0)
  SELECT q.conv_id::VARCHAR AS id, concat_ws(chr(10), 'T' || q.conv_id, q.text, string_agg(a.text, chr(10) ORDER BY a.accepted DESC, a.score DESC, a.turn)) AS text FROM q LEFT JOIN a USING (conv_id) GROUP BY q.conv_id, q.text""")
def thread_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations")
    ident = F.when(F.col("turn") == 0, F.col("conv_id")).otherwise(1_000_000 + F.col("conv_id") * 1000 + F.col("turn"))
    posts = turns.select(
        ident.alias("id"), F.when(F.col("turn") == 0, 1).otherwise(2).alias("kind"), F.col("conv_id").alias("parent_id"), (1_000_000 + F.col("conv_id") * 1000 + 3).alias("accepted_id"),
        F.concat(F.lit("T"), F.col("conv_id").cast("string")).alias("title"), F.col("text").alias("body"), ((F.col("turn") * 7 + F.col("conv_id")) % 5).alias("score"),
        F.timestamp_seconds(F.col("turn")).alias("date"), F.lit("CC BY-SA 4.0").alias("license"),
    )
    comments = spark.createDataFrame([], "post_id long, id long, author string, text string, date timestamp, license string")
    authors = turns.select(ident.alias("post_id"), F.array("role").alias("authors"))
    return threads.assemble(posts, comments, authors, "example.com").select("id", "text")


@query("""SELECT l_orderkey, list(l_linenumber::BIGINT ORDER BY (l_returnflag = 'R') DESC, l_quantity DESC, l_linenumber) AS best FROM lineitem GROUP BY l_orderkey""")
def vote_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem")
    answer = F.struct(F.col("l_linenumber").cast("long").alias("n"), (F.col("l_returnflag") == "R").alias("accepted"), F.col("l_quantity").alias("score"))
    return lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(answer)).alias("a")).select("l_orderkey", F.transform(threads.vote_sorted(F.col("a")), lambda x: x.n).alias("best"))


@query("SELECT source, max_by(doc_id, (n_chars, doc_id)) AS best FROM documents GROUP BY source")
def argmax_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").groupBy("source").agg(F.max_by("doc_id", F.struct("n_chars", "doc_id")).alias("best"))


@query("SELECT source, doc_id, lang FROM documents WHERE lang IN ('en', 'de', 'fr') QUALIFY row_number() OVER (PARTITION BY source ORDER BY CASE lang WHEN 'de' THEN 0 WHEN 'fr' THEN 1 ELSE 2 END, doc_id) = 1")
def best_by_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.when(F.col("lang") == "de", 0).when(F.col("lang") == "fr", 1).when(F.col("lang") == "en", 2)
    return R.best_by_rank(read(spark, sf_dir, "documents").select("source", "doc_id", "lang"), "source", rank, "doc_id")


@query("SELECT doc_id, ((coalesce(sum(n_chars) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) // 100000)::INT AS shard FROM documents")
def shard_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.even_shards(read(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id", F.col("n_chars"), 100_000).select("doc_id", "shard")


@query("""WITH RECURSIVE o AS (SELECT doc_id, n_chars, row_number() OVER (ORDER BY doc_id) AS rn FROM documents), g AS (
  SELECT doc_id, rn, CASE WHEN n_chars >= 100000 THEN 1 ELSE 0 END AS shard, CASE WHEN n_chars >= 100000 THEN 0 ELSE n_chars END AS held FROM o WHERE rn = 1
  UNION ALL SELECT o.doc_id, o.rn, CASE WHEN g.held + o.n_chars >= 100000 THEN g.shard + 1 ELSE g.shard END, CASE WHEN g.held + o.n_chars >= 100000 THEN 0 ELSE g.held + o.n_chars END FROM g JOIN o ON o.rn = g.rn + 1)
  SELECT doc_id, shard::INT AS shard FROM g""")
def greedy_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.greedy_shards(read(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id", F.col("n_chars"), 100_000).select("doc_id", "shard")


@query("""WITH s AS (SELECT doc_id, 'f' || (doc_id // 100) AS file, ((coalesce(sum(n_chars) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) // 100000)::INT AS shard FROM documents),
  f AS (SELECT shard, file, min(doc_id) AS pos FROM s GROUP BY shard, file) SELECT s.shard, min(s.doc_id) AS first_id, max(s.doc_id) AS last_id, count(*) AS rows, any_value(x.files) AS files
  FROM s JOIN (SELECT shard, list(file ORDER BY pos) AS files FROM f GROUP BY shard) x USING (shard) GROUP BY s.shard""")
def compaction_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "n_chars", F.concat(F.lit("f"), F.expr("cast(doc_id div 100 as string)")).alias("file"))
    return layout.compacted(docs, "doc_id", F.col("n_chars"), 100_000, "file", "doc_id")[1].drop("first_at", "last_at")


@query("SELECT doc_id, ((coalesce(sum(n_chars) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) // 100000)::INT AS shard FROM documents")
def compaction_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "n_chars", F.concat(F.lit("f"), F.expr("cast(doc_id div 100 as string)")).alias("file"))
    rows, shards = layout.compacted(docs, "doc_id", F.col("n_chars"), 100_000, "file", "doc_id")
    return layout.replay(docs, shards, "doc_id", "file", "doc_id").select("doc_id", "shard")


@query("SELECT doc_id, lpad((doc_id // 100)::VARCHAR, 5, '0') AS shard FROM documents")
def id_to_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("/x/documents/"), layout.shard_name(F.expr("doc_id div 100"), "a.jsonl.gz")).alias("file"))
    return layout.shard_of_ids(docs, "doc_id", "file")


@query("""WITH f AS (SELECT DISTINCT doc_id // 100 AS shard, source FROM documents), n AS (SELECT shard, count(*) AS files FROM f GROUP BY shard)
  SELECT (SELECT max(doc_id // 100) + 1 FROM documents)::INT AS next, (SELECT round(avg(files), 6) FROM n) AS mean""")
def next_shard_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next free number, and how many source files went into a shard on average."""
    docs = read(spark, sf_dir, "documents").select(layout.shard_name(F.expr("doc_id div 100"), "a.jsonl.gz").alias("file"), "source")
    per_shard = docs.distinct().groupBy("file").agg(F.count(F.lit(1)).alias("files"))
    return per_shard.agg(layout.next_shard(per_shard, "file").alias("next"), F.round(F.avg("files"), 6).alias("mean"))


@query("SELECT source, lpad((row_number() OVER (ORDER BY lang, source) - 1)::VARCHAR, 5, '0') AS number, lang FROM (SELECT DISTINCT source, lang FROM documents)")
def shard_renumber(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.renumbered(read(spark, sf_dir, "documents").select("source", "lang").distinct(), "lang", "source").select("source", "lang", "number")


@query("WITH b AS (SELECT doc_id // 10 AS batch, sum(n_chars) AS size FROM documents GROUP BY 1) SELECT batch FROM b QUALIFY coalesce(sum(size) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) <= 1000000")
def data_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = read(spark, sf_dir, "documents").groupBy(F.expr("doc_id div 10").alias("batch")).agg(F.sum("n_chars").alias("size"))
    return R.within_budget(batches, "batch", "size", 1_000_000).select("batch")


@query("SELECT doc_id // 64 AS batch, list(doc_id ORDER BY doc_id) AS ids FROM documents GROUP BY 1")
def batches_of_64(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").groupBy(F.expr("doc_id div 64").alias("batch")).agg(F.sort_array(F.collect_list("doc_id")).alias("ids"))


@query("SELECT doc_id, source, 'a' AS part FROM documents WHERE lang = 'en' UNION ALL SELECT doc_id, NULL, 'b' FROM documents WHERE lang = 'fr'")
def union_of_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return docs.filter("lang = 'en'").select("doc_id", "source", F.lit("a").alias("part")).unionByName(docs.filter("lang = 'fr'").select("doc_id", F.lit("b").alias("part")), allowMissingColumns=True)


@query("SELECT DISTINCT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def id_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id").subtract(read(spark, sf_dir, "labels").select("doc_id"))


@query("SELECT doc_id::VARCHAR AS id, text, source, '2024-01-01' AS added FROM documents")
def document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.formatted(read(spark, sf_dir, "documents").withColumnRenamed("source", "s"), F.col("doc_id"), F.col("text"), "x", F.lit("2024-01-01"), license=F.lit(L.PERMISSIVE["PD"]), origin=F.col("s"))
    return rows.select("id", "text", F.col("metadata.origin").alias("source"), "added")


@query("SELECT text FROM documents")
def keep_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.keep_features(read(spark, sf_dir, "documents"))


@query("SELECT url, (row_number() OVER (ORDER BY url) - 1)::INT AS idx FROM (SELECT DISTINCT url FROM pages)")
def page_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.page_list(read(spark, sf_dir, "pages"))


@query("WITH RECURSIVE r(page) AS (SELECT 1::BIGINT UNION SELECT t.x FROM r JOIN (SELECT doc_id AS page, (doc_id * 2) % 97 AS x FROM documents UNION ALL SELECT doc_id, (doc_id + 5) % 89 FROM documents) t USING (page)) SELECT page FROM r")
def crawl_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    links = docs.select(F.col("doc_id").alias("page"), F.explode(F.array((F.col("doc_id") * 2) % 97, (F.col("doc_id") + 5) % 89)).alias("to")).distinct()
    return files.crawl(spark.createDataFrame([(1,)], "page long"), links)


#: The pattern without looking ahead; where spaces stand before a space and a word, the text is parted first.
@query(r"""WITH p AS (SELECT unnest(string_split(regexp_replace(text, '( +)( [^\s])', '\1' || chr(1) || '\2', 'g'), chr(1))) AS part FROM documents)
  SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(part, '(?i:\x27(?:s|t|re|ve|m|ll|d))|[^\r\n\pL\pN]?\pL+|\pN{1,3}| ?[^\s\pL\pN]+[\r\n]*|\s*[\r\n]+|\s+')) AS word FROM p) GROUP BY word HAVING count(*) >= 2""")
def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize.word_counts(read(spark, sf_dir, "documents"), least=2)


@query()
def encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of a vocabulary of the public tokenizers, which must be installed, and whether they decode to the text."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = tokenize.decoded(tokenize.encoded(read(spark, sf_dir, "documents").select("doc_id", "text"), path, offsets=False), path)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), (F.col("decoded") == F.col("text")).alias("same"))
