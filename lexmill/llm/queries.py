"""The registered queries of the operators: thin digests over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_dealt
from .bpe import bpe_digest
from .hnsw import near_vectors
from .media import SIGNATURES, payload_digest
from .namejoin import name_digest
from .neardup import near_duplicates
from .packing import Capacity, pack
from .pii import pii_digest
from .sharding import interleave
from .templates import article_texts
from .tokens import section_tokens
from .toxicity import toxicity_digest
from .urlrules import UrlRule, judge_urls
from .whitening import whiten

#: Capacities that all bind. A whole sequence in one piece would cost 1,024 squared, so that pieces have 800 tokens at most.
BOUNDED = Capacity(tokens=1024, documents=6, cost=800 * 800, weights=(1.0, 0.5, 0.5), piece=800)
RULES = (
    UrlRule("allow", "org"),
    UrlRule("block", "example.org", "/es/"),
    UrlRule("block", "example.org", "/en/1"),
    UrlRule("allow", "com", "/fr/"),
    UrlRule("block", "com", "/de/"),
)


def vocabulary(name: str) -> str:
    """Where a vocabulary file is; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_dealt(spark, f"{sf_dir}/{name}.parquet")


def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload_digest(table(spark, sf_dir, "documents")).drop("embedded", "carved")


def media_embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The media that every stored text holds, by type, offset, length and the checksum of what is carved. No SQL can say that, so that it stands beside op1."""
    return payload_digest(table(spark, sf_dir, "documents")).select("doc_id", "payload_sha256", "n_embedded", "embedded", "carved")


def packing_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packing where all three capacities bind: 1,024 tokens, 6 documents, and an attention cost of two thirds of a whole sequence's square."""
    return pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), BOUNDED)


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = interleave(table(spark, sf_dir, "documents"), shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digest(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per line of every document; a token across a line's end counts where most of its bytes are."""
    return section_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), rule="most")


def op8_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), Capacity())


def op11_name_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return name_digest(table(spark, sf_dir, "clients"), table(spark, sf_dir, "vendors"), most=1)


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return article_texts(table(spark, sf_dir, "pages"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deviations are long here; one beyond that is null."""
    return whiten(table(spark, sf_dir, "embeddings"), components=8).withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


QUERIES = {f.__name__: f for f in (op1_media, op2_minhash, op3_sharding, op4_toxicity, op5_bpe, op6_url_filters, op7_token_counts, op8_hnsw, op9_pii, op10_packing, op11_name_join, op12_html_extraction, op13_whitening)}

#: Queries beside the ten, one per operator at most.
BESIDE = {f.__name__: f for f in (media_embedded, packing_bounded)}

#: CRC-32 in SQL, byte by byte: a table of 256 remainders, then a fold over the bytes of a hex string.
CRC_TABLE = "SELECT list_transform(range(256), lambda i: list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END)) AS t"


def _bytes(hexed: str) -> str:
    return f"list_transform(range(1, length({hexed}), 2), lambda k: ('0x' || substr({hexed}, k, 2))::BIGINT)"


def _crc(hexed: str) -> str:
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {_bytes(hexed)}), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295::BIGINT)::BIGINT"


def _little(number: str) -> str:
    """Four bytes of a number, the lowest first, in hex."""
    return " || ".join(f"printf('%02X', (({number}) >> {8 * k}) & 255)" for k in range(4))


def _magic() -> list[str]:
    """Magic bytes as the SQL writes bytes: two digits and a full stop each."""
    return sorted({"".join(f"{b:02X}." for b in magic) for magic, *_ in SIGNATURES})


#: Header of a binary grey or colour map. It and PDF are the only formats of the list that UTF-8 text without NUL characters can hold (up to 16 MB); the SQL of op1 takes none to lie inside another.
PNM = r"P[56][ \t\r\n]+([0-9]{1,10})[ \t\r\n]+([0-9]{1,10})[ \t\r\n]+([0-9]{1,10})[ \t\r\n]"

def _plain(name: str) -> str:
    """A to Z in lower case, without white space."""
    return f"translate(regexp_replace({name}, '[\\x20\\x09-\\x0D]', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _without(name: str) -> str:
    """All that one deletion leaves."""
    return f"list_transform(range(1, length({name}) + 1), lambda k: substr({name}, 1, k - 1) || substr({name}, k + 1))"


ORACLE_SQL: dict[str, str] = {
    "op1_media": f"""
WITH remainders AS ({CRC_TABLE}), raw AS (
  SELECT doc_id, coalesce(text, '') AS txt, hex(encode(coalesce(text, ''))) AS h FROM documents
), padded AS (
  SELECT doc_id, txt, string_split_regex(txt, '{PNM}') AS pieces, regexp_extract_all(txt, '{PNM}') AS heads, length(h) // 2 AS n_bytes, h || repeat('00', CASE WHEN h = '' THEN 64 ELSE (64 - (length(h) // 2) % 64) % 64 END) AS p FROM raw
), stored AS (
  SELECT *, regexp_replace(p, '(..)', '\\1.', 'g') AS b,
    list_transform(range(1, len(heads) + 1), lambda k: {{
      'start': list_sum(list_transform(pieces[:k], lambda x: octet_length(encode(x)))) + list_sum(list_transform(heads[:k], lambda x: octet_length(encode(x)))),
      'need': CASE WHEN regexp_extract(heads[k], '{PNM}', 3)::DOUBLE BETWEEN 1 AND 65535 THEN regexp_extract(heads[k], '{PNM}', 1)::DOUBLE * regexp_extract(heads[k], '{PNM}', 2)::DOUBLE
        * CASE WHEN heads[k][2] = '6' THEN 3 ELSE 1 END * CASE WHEN regexp_extract(heads[k], '{PNM}', 3)::DOUBLE > 255 THEN 2 ELSE 1 END ELSE 0 END}}) AS maps,
    length(p) // 2 AS n, {_bytes("p")} AS samples, '52494646' || {_little("36 + length(p) // 2")} || '57415645666D74201000000001000100401F0000401F0000' || '01000800' || '64617461' || {_little("length(p) // 2")} || p AS m FROM padded
)
SELECT doc_id, n_bytes::BIGINT AS n_bytes, n::BIGINT AS payload_bytes, sha256(unhex(p)) AS payload_sha256, {_crc("right(p, 128)")} AS tail_crc32, (length(m) // 2)::BIGINT AS media_bytes, sha256(unhex(m)) AS media_sha256,
       'audio/wav' AS media_type, 'audio/wav' <> 'text/plain' AS corrected,
       {" + ".join(f"(length(b) - length(replace(b, '{m}', ''))) // {len(m)}" for m in _magic())} AS n_magic,
       (len(list_filter(string_split(txt, '%PDF-')[2:], lambda x: regexp_matches(x, '^[0-9](?s:.)*startxref(?s:.)*%%EOF'))) + len(list_filter(maps, lambda x: x.need > 0 AND x.need <= n - x.start)))::BIGINT AS n_embedded,
       'samples=' || n || ';sum=' || list_sum(samples) || ';max=' || list_max(samples) || ';kinds=' || len(list_distinct(samples)) AS feature
FROM stored, remainders
""",
    "op2_minhash": """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]) ELSE w END)) AS s FROM words
), classes AS (
  SELECT s, min(doc_id) AS c, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s
), grams AS (
  SELECT c, n, unnest(s) AS g FROM classes
), links AS (
  SELECT a.c AS x, b.c AS y FROM grams a JOIN grams b ON a.g = b.g AND a.c < b.c AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), paths AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  SELECT c, c AS r FROM classes UNION SELECT reach.c, paths.y FROM reach JOIN paths ON reach.r = paths.x
), least AS (
  SELECT c, min(r) AS component_id FROM reach GROUP BY c
)
SELECT doc_id, len(sets.s)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(component_id, doc_id) = doc_id AS kept
FROM sets LEFT JOIN classes USING (s) LEFT JOIN least USING (c)
""",
    "op3_sharding": f"""
WITH remainders AS ({CRC_TABLE}), raw AS (
  SELECT doc_id, source, hex(encode(coalesce(text, ''))) AS h FROM documents
), sized AS (
  SELECT doc_id, source, coalesce('+' || source, '-') AS stratum, length(h) // 2 + 16 AS size, md5('interleave-1:' || coalesce(doc_id::VARCHAR, '')) AS key, {_crc("h")} AS text_crc32 FROM raw, remainders
), ranked AS (
  SELECT *, (2 * (row_number() OVER (PARTITION BY stratum ORDER BY key, doc_id, text_crc32, size) - 1) + 1) / (2 * count(*) OVER (PARTITION BY stratum)) AS fraction FROM sized
), placed AS (
  SELECT *, row_number() OVER (ORDER BY fraction, stratum, key, doc_id, text_crc32, size) - 1 AS position, count(*) OVER () AS n FROM ranked
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, (position * 40 // n)::INT AS shard, (position - ((position * 40 // n) * n + 39) // 40)::BIGINT AS slot, NULL::INT AS grown_shard, source FROM placed
""",
    "op6_url_filters": """
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), rules(action, rule_host, rule_path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), hits AS (
  SELECT page_id, host, path, rule_host || rule_path AS rule, action,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC NULLS LAST, rule_host || rule_path) AS rn
  FROM parts LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM hits WHERE rn = 1
""",
    "op11_name_join": f"""
WITH remainders AS ({CRC_TABLE}), hashed AS (
  SELECT vendor_id, name, length(name) AS n, {_crc("hex(encode(vendor_id::VARCHAR))")} AS h FROM vendors, remainders
), misspelt AS (
  SELECT vendor_id, CASE WHEN h % 2 = 0 AND n >= 2
    THEN substr(name, 1, h % greatest(n - 1, 1)) || substr(name, h % greatest(n - 1, 1) + 2, 1) || substr(name, h % greatest(n - 1, 1) + 1, 1) || substr(name, h % greatest(n - 1, 1) + 3) ELSE name END AS name FROM hashed
), own AS (
  SELECT vendor_id, {_plain("name")} AS v FROM misspelt WHERE {_plain("name")} <> ''
), others AS (
  SELECT client_id, {_crc("hex(encode(client_id::VARCHAR))")} AS crc, {_plain("name")} AS c FROM clients, remainders WHERE {_plain("name")} <> ''
), pairs AS (
  SELECT v, c, CASE WHEN v = c THEN 0 ELSE 1 END AS distance FROM (SELECT DISTINCT v FROM own) JOIN (SELECT DISTINCT c FROM others) ON abs(length(v) - length(c)) <= 1
  WHERE v = c
    OR length(v) = length(c) + 1 AND list_contains({_without("v")}, c) OR length(c) = length(v) + 1 AND list_contains({_without("c")}, v)
    OR length(v) = length(c) AND (len(list_filter(range(1, length(v) + 1), lambda k: substr(v, k, 1) <> substr(c, k, 1))) = 1
      OR list_contains(list_transform(range(1, length(v)), lambda k: substr(v, 1, k - 1) || substr(v, k + 1, 1) || substr(v, k, 1) || substr(v, k + 2)), c))
)
SELECT vendor_id, distance::INT AS distance, count(*)::BIGINT AS n_clients, min(client_id) AS first_client_id, sum(crc)::BIGINT AS clients_crc
FROM own JOIN pairs USING (v) JOIN others USING (c) GROUP BY vendor_id, distance
""",
    "op12_html_extraction": r"""
WITH articles AS (
  SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '<br>', ' ', 'g') AS a FROM pages
), plain AS (
  SELECT page_id, url, list_transform(string_split_regex(a, '</?(p|h1)>'), lambda b: regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(b, '<[^>]*>', '', 'g'), '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g')) AS b FROM articles
), blocks AS (
  SELECT page_id, url, array_to_string(list_filter(list_transform(b, lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> ''), chr(10) || chr(10)) AS text FROM plain
)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM blocks
""",
    "op8_hnsw": """
WITH RECURSIVE good AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding) AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT vec_id AS c, vec_id AS r FROM embeddings UNION SELECT reach.c, links.y FROM reach JOIN links ON reach.r = links.x
), least AS (
  SELECT c, min(r) AS component_id FROM reach GROUP BY c
), counts AS (
  SELECT x, count(*) AS n FROM links GROUP BY x
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, component_id = vec_id AS kept FROM embeddings LEFT JOIN counts ON x = vec_id JOIN least ON c = vec_id
""",
}
