"""The queries of this package over the test tables, and the SQL that checks those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.collocations import collocations
from riskloom.llm.common import table
from riskloom.llm.decontaminate import contamination
from riskloom.llm.embedding_dedup import links
from riskloom.llm.html_text import extract
from riskloom.llm.language_model import score
from riskloom.llm.line_dedup import kept_lines
from riskloom.llm.packing import pack_documents
from riskloom.llm.pii import personal_data
from riskloom.llm.quality import classify
from riskloom.llm.ranked_search import search
from riskloom.llm.simhash import near_duplicates
from riskloom.llm.substring_dedup import dedup_substrings
from riskloom.llm.warc import archive

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run
    return register


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_LINES = rf"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
keyed AS (SELECT *, trim({_LOWER.format("line")}, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)) AS k FROM lines),
repeated AS (SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1),
marked AS (SELECT keyed.*, first IS NOT NULL AND doc_id > first AS gone FROM keyed LEFT JOIN repeated USING (k))
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


@query("op3_line_dedup", _LINES)
def line_dedup(spark, folder):
    return kept_lines(table(spark, folder, "documents")).drop("kept_text")


@query("op9_simhash")
def simhash(spark, folder):
    return near_duplicates(table(spark, folder, "documents"))


_WORDS = "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_CONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT DISTINCT item_id, {_WORDS} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS k
            FROM (SELECT *, unnest(range(1, greatest(0, len(w) - 9 + 9 * (len(w) < 10)::INT) + 1)) AS s FROM b WHERE len(w) > 0)
            WHERE s = 1 OR s + 9 <= len(w)),
lengths AS (SELECT DISTINCT n FROM windows),
spots AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS k
          FROM (SELECT doc_id, w, n, unnest(range(1, greatest(0, len(w) - n + 1) + 1)) AS s FROM d, lengths)),
hits AS (SELECT doc_id, item_id, n, s FROM spots JOIN windows USING (n, k)),
covered AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n_hit
            FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(i, ',' ORDER BY i) AS items
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)"""


@query("op7_decontaminate", _CONTAMINATION)
def decontaminate(spark, folder):
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256)).drop("items")


@query("op5_best_fit_packing")
def best_fit_packing(spark, folder):
    return pack_documents(table(spark, folder, "documents"))


@query("op2_pii")
def pii(spark, folder):
    return personal_data(table(spark, folder, "documents")).drop("found")


@query("op1_html_text")
def html_text(spark, folder):
    return extract(table(spark, folder, "pages"))


_ARCHIVE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, '')))::BIGINT AS n FROM pages),
r AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS first FROM p)
SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first = page_id THEN NULL ELSE first END AS refers_to
FROM r"""


@query("op4_warc", _ARCHIVE)
def warc(spark, folder):
    found = archive(table(spark, folder, "pages"))
    return found.select(F.col("row_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


_LINKS = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id AS n, vec_id AS c FROM embeddings UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.n),
least AS (SELECT n AS vec_id, min(c) AS component_id FROM reach GROUP BY n),
counts AS (SELECT a AS vec_id, count(*) AS k FROM links GROUP BY a)
SELECT vec_id, coalesce(k, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN counts USING (vec_id)"""


@query("op6_embedding_dedup", _LINKS)
def embedding_dedup(spark, folder):
    return links(table(spark, folder, "embeddings"))


@query("op8_language_model")
def language_model(spark, folder):
    return score(table(spark, folder, "documents"))


@query("op10_quality")
def quality(spark, folder):
    return classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


_PASSAGES = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
spots AS (SELECT doc_id, s, array_to_string(w[s:s + 12], ' ') AS k
          FROM (SELECT doc_id, w, unnest(range(1, greatest(0, len(w) - 12) + 1)) AS s FROM d)),
least AS (SELECT k, min(doc_id) AS first FROM spots GROUP BY k HAVING count(DISTINCT doc_id) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS p FROM spots JOIN least USING (k) WHERE doc_id > first),
kept AS (SELECT doc_id, count(*)::BIGINT AS n, string_agg(word, ' ' ORDER BY p) AS t
         FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN gone USING (doc_id, p)
         GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


@query("op12_substring_dedup", _PASSAGES)
def substring_dedup(spark, folder):
    return dedup_substrings(table(spark, folder, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


_RANKED = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS w FROM documents),
every AS (SELECT count(*)::BIGINT AS docs, sum(len(w))::BIGINT AS words FROM d WHERE len(w) > 0),
asked AS (SELECT item_id, text, term, count(*)::BIGINT AS q
          FROM (SELECT item_id, text, unnest({_WORDS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
tf AS (SELECT row, doc_id, n, term, count(*)::BIGINT AS tf
       FROM (SELECT row, doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM d) SEMI JOIN asked USING (term) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
            FROM tf, every GROUP BY term, docs),
scores AS (SELECT item_id, text, row, doc_id,
                  sum(q * weight * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * docs) // words)))))::BIGINT AS score
           FROM asked JOIN tf USING (term) JOIN weights USING (term), every GROUP BY item_id, text, row, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id)::INTEGER AS rank
           FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20"""


@query("op13_ranked_search", _RANKED)
def ranked_search(spark, folder):
    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


_COLLOCATIONS = f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS p
                FROM documents),
spoken AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
grams AS (SELECT lang, n, array_to_string(w[s:s + n - 1], ' ') AS phrase
          FROM (SELECT lang, w, n, unnest(range(1, greatest(0, len(w) - n + 1) + 1)) AS s FROM spoken, (VALUES (1), (2), (3)) v(n))),
f AS (SELECT lang, n, phrase, count(*)::BIGINT AS a FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE n = 1 GROUP BY lang),
whole AS (SELECT * FROM f WHERE n > 1 AND a >= 10),
cuts AS (SELECT lang, phrase, n, a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS first,
                array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS rest
         FROM (SELECT *, unnest(range(1, n)) AS k FROM whole)),
scored AS (SELECT c.lang, c.phrase, c.n, c.a, c.k, x.a AS l, y.a AS r,
                  ((1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a))::BIGINT AS score
           FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.first JOIN f y ON y.lang = c.lang AND y.phrase = c.rest),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, phrase, max(longer) AS longer
           FROM (SELECT lang, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS phrase,
                        a AS longer FROM whole WHERE n = 3) GROUP BY ALL),
kept AS (SELECT w.* FROM weakest w LEFT JOIN inside i ON w.n = 2 AND w.lang = i.lang AND w.phrase = i.phrase
         WHERE longer IS NULL OR 100 * longer < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, t.n, score FROM ranked JOIN total t USING (lang) WHERE rank <= 2000"""


@query("op11_collocations", _COLLOCATIONS)
def phrase_collocations(spark, folder):
    return collocations(table(spark, folder, "documents"))
