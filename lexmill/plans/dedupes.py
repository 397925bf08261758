"""Tag, deduplicate and mix in one flow: what n-grams say of documents reaches their filters and edits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import query
from .corpus import WORDS, read
from ..functions import text as X
from ..operators import dedupe, spans as S, taggers
from ..operators.bloom import BloomSpec, BloomState
from ..operators.grams import gram_rows
from ..operators.mix import MixSpec, Replacement, mix, recipe, redacted
from ..session import scratch


def _grams(n: int, rows: str = "documents", key: str = "doc_id") -> str:
    """SQL of the n-grams of rows: key and gram."""
    return f"SELECT {key}, array_to_string(ws[k:k + {n - 1}], ' ') AS gram FROM (SELECT {key}, ws, unnest(range(1, len(ws) - {n - 2})) AS k FROM (SELECT {key}, {WORDS} AS ws FROM {rows}) WHERE len(ws) >= {n})"


@query(f"""WITH g AS ({_grams(5, key="doc_id, lang")}),
  f AS (SELECT doc_id, lang, bool_or(lang = 'en') OVER (PARTITION BY gram) OR min(CASE WHEN lang <> 'en' THEN doc_id END) OVER (PARTITION BY gram) < doc_id AS seen FROM g)
  SELECT doc_id, count(*) AS n_ngrams, avg(seen::INT) >= 0.5 AS duplicate FROM f WHERE lang <> 'en' GROUP BY doc_id""")
def bloom_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run that knows the n-grams of the first by a Bloom filter: other languages after English. The filter is made for as many n-grams as there are words."""
    docs = read(spark, sf_dir, "documents")
    items = docs.agg(F.sum(X.word_count(F.col("text")))).first()[0] or 1
    state = BloomState(spark, scratch(spark, "bloom"), BloomSpec(items, 0.001))
    state.add(gram_rows(docs.filter("lang = 'en'"), 5))  # of the first run nothing else is asked
    found = dedupe.bloom_overlap(docs.filter("lang <> 'en'"), state, 5, read_only=True)
    return found.select("doc_id", "n_ngrams", (F.col("overlap") >= 0.5).alias("duplicate"))


_REDACTED = "text"
for _kind in ("EMAIL_ADDRESS", "PHONE_NUMBER", "IP_ADDRESS"):
    _REDACTED = f"regexp_replace({_REDACTED}, '{taggers.PII[_kind]}', '<{_kind}>', 'g')"


@query(f"""WITH g AS ({_grams(20)}), f AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY gram) < doc_id AS seen FROM g), o AS (SELECT doc_id, avg(seen::INT) AS overlap FROM f GROUP BY doc_id)
  SELECT doc_id, {_REDACTED} AS text FROM documents LEFT JOIN o USING (doc_id) WHERE NOT coalesce(overlap >= 0.9, FALSE) AND length(text) > 100 AND len({WORDS}) > 20""")
def dedupe_and_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flow of a corpus: overlap of 20-grams as an attribute, then a recipe that drops duplicates and short texts and redacts the rest."""
    docs = read(spark, sf_dir, "documents")
    tagged = dedupe.with_overlap(docs, dedupe.ngram_overlap(docs, 20))
    return redacted(mix(tagged, recipe("q", chars=100, tokens=20)), "EPI").select("doc_id", "text")


@query(f"""WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS paragraph FROM documents), g AS ({_grams(20, "p", "doc_id, paragraph")}),
  f AS (SELECT doc_id, paragraph, (doc_id, paragraph) > min((doc_id, paragraph)) OVER (PARTITION BY gram) AS seen FROM g), o AS (SELECT doc_id, paragraph, avg(seen::INT) AS overlap FROM f GROUP BY doc_id, paragraph)
  SELECT doc_id, string_agg(CASE WHEN overlap >= 0.8 THEN '' ELSE text END, chr(10) ORDER BY paragraph) AS text FROM p LEFT JOIN o USING (doc_id, paragraph) GROUP BY doc_id""")
def duplicate_spans_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs of which four fifths were met before are cut, by the rule of the recipes."""
    docs = read(spark, sf_dir, "documents")
    tagged = docs.join(dedupe.duplicate_spans(docs, 0.5).withColumnRenamed("spans", "duplicate_paragraphs"), "doc_id", "left")
    return mix(tagged, MixSpec("q", replace=(Replacement("duplicate_paragraphs", "", 0.8),))).select("doc_id", "text")


@query()
def repeated_passages_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is covered by 20-grams of earlier documents is cut, whatever its lines; documents of which it is nine tenths go."""
    docs = read(spark, sf_dir, "documents")
    tagged = docs.join(dedupe.overlap_spans(docs, 20).withColumnRenamed("spans", "repeated"), "doc_id", "left")
    covered = F.coalesce(S.coverage(F.col("repeated"), F.col("text")), F.lit(0.0))
    kept = mix(tagged.filter(covered < 0.9), MixSpec("q", replace=(Replacement("repeated", "", 0.8),)))
    return kept.select("doc_id", "text")
