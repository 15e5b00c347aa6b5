"""One named query per operator over the driver's tables, with check SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorqc.llm import bpe, conversation_repair, lexical_search, line_dedup, ngram_join, packing, pii, quality, suffix_dedup, topk, toxicity, unigram, warc
from sensorqc.llm.base import table
from sensorqc.session import work_dir

#: Key of the surrogates in the named queries; a real run passes its own secret.
PII_KEY = b"sensorqc-named-query-key"

#: Vocabulary files, by their public names.
WORD_TOKENIZER = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


OP1_SQL = r"""
WITH listed(lang, words) AS (VALUES
  ('en', string_split('the of and to in a is that for it was on are as with be', ' ')),
  ('de', string_split('der die und in den von zu das mit sich des auf für ist im dem', ' ')),
  ('fr', string_split('de la le et les des en un du une que est pour qui dans par', ' ')),
  ('es', string_split('de la que el en y a los del se las por un para con una', ' '))),
split_words AS (
  SELECT doc_id, coalesce(lang_key, 'other') AS lang_key, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS lines
  FROM (SELECT *, CASE WHEN lang IN ('en', 'de', 'fr', 'es') THEN lang END AS lang_key FROM documents)),
grams AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM split_words)),
twice AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
repeated AS (SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM twice, range(0, 5) r(j) GROUP BY doc_id),
base AS (
  SELECT s.doc_id, lang_key, text, w, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM split_words s LEFT JOIN repeated USING (doc_id)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base),
classed AS (
  SELECT *, [length(regexp_replace(text, '[^ \t-\r]', '', 'g')), length(regexp_replace(text, '[^a-z]', '', 'g')), length(regexp_replace(text, '[^A-Z]', '', 'g')),
             length(regexp_replace(text, '[^0-9]', '', 'g')), n_symbols, length(regexp_replace(text, '[^.,;:!?''"()\-]', '', 'g')),
             length(regexp_replace(regexp_replace(text, '[a-zA-Z]', '', 'g'), '\P{L}', '', 'g'))] AS classes
  FROM judged),
counted AS (SELECT * EXCLUDE (text, classes), list_append(classes, length(text) - list_sum(classes)::BIGINT) AS chars FROM classed),
spoken AS (
  SELECT c.doc_id, l.lang AS k, lang_key, n_words, base_failed,
         list_transform(words, lambda x: len(list_filter(w, lambda y: y = x OR y = upper(x[1]) || x[2:]))) AS cw
  FROM counted c, listed l),
bins AS (SELECT *, list_append(cw, n_words - list_sum(cw)) AS common, list_sum(cw)::BIGINT AS n_common FROM spoken),
char_ref AS (SELECT lang_key, i, sum(chars[i]) AS r FROM counted, range(1, 9) t(i) WHERE NOT base_failed GROUP BY ALL),
word_ref AS (SELECT k, i, sum(common[i]) AS r FROM bins, range(1, 18) t(i) WHERE NOT base_failed AND k = lang_key GROUP BY ALL),
size_ref AS (SELECT lang_key, sum(n_words) AS ref_words FROM counted WHERE NOT base_failed GROUP BY lang_key HAVING sum(n_words) >= 2000),
share_ref AS (SELECT k, sum(r) FILTER (i < 17) AS rc, sum(r) AS rn FROM word_ref GROUP BY k),
char_dist AS (
  SELECT doc_id, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / m) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / m) ELSE 0 END) / 2, 0)) AS d
  FROM (SELECT *, (p + q) / 2 AS m FROM (SELECT doc_id, chars[i] / list_sum(chars) AS p, r / sum(r) OVER (PARTITION BY doc_id) AS q FROM counted JOIN size_ref USING (lang_key) JOIN char_ref USING (lang_key) WHERE word_chars >= 200))
  GROUP BY doc_id),
word_dist AS (
  SELECT doc_id, k, k = lang_key AS own, round(sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / m) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / m) ELSE 0 END) / 2, 0)), 6) AS d
  FROM (SELECT *, (p + q) / 2 AS m FROM (SELECT doc_id, k, lang_key, common[i] / n_words AS p, r / sum(r) OVER (PARTITION BY doc_id, k) AS q FROM bins JOIN word_ref USING (k) WHERE n_words >= 60 AND k IN (SELECT lang_key FROM size_ref)))
  GROUP BY doc_id, k, lang_key),
near AS (SELECT doc_id, max(d) FILTER (own) AS mine, min(d) FILTER (NOT own) AS other FROM word_dist GROUP BY doc_id),
share_dist AS (
  SELECT doc_id, CASE WHEN p < q THEN round(sqrt(greatest((CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + q * log2(2 * q / (p + q))
      + (1 - p) * log2(2 * (1 - p) / (2 - p - q)) + (1 - q) * log2(2 * (1 - q) / (2 - p - q))) / 2, 0)), 6) ELSE 0 END AS d
  FROM (SELECT doc_id, n_common / n_words AS p, rc / rn AS q FROM bins JOIN share_ref USING (k) JOIN size_ref USING (lang_key) WHERE k = lang_key AND n_words >= 60)),
told AS (
  SELECT c.*, round(h.d, 6) AS char_distance, mine AS word_distance, s.d AS share_distance, CASE WHEN mine IS NOT NULL THEN coalesce(other, 1) END AS other_distance
  FROM counted c LEFT JOIN char_dist h USING (doc_id) LEFT JOIN near n USING (doc_id) LEFT JOIN share_dist s USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(char_distance, 0) <= 0.30 AND coalesce(word_distance, 0) <= 0.42 AND coalesce(share_distance, 0) <= 0.20
         AND coalesce(other_distance >= word_distance - 0.02, true) AS kept, char_distance, word_distance, share_distance, other_distance
FROM told
"""


@query("op1_quality_divergence", OP1_SQL)
def op1_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the divergence verdict of all documents."""
    return quality.judge(table(spark, sf_dir, "documents"))


OP3_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.r AS query, q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON c.r <> q.r AND len(c.e) = len(q.e) WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id ASC NULLS LAST)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query("op3_exact_topk", OP3_SQL)
def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best vectors of every fiftieth vector."""
    cfg = topk.SearchSettings()
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", cfg.scale)
    return topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"), cfg)


@query("op4_sentencepiece")
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, and whether decoding gives the text back."""
    model = unigram.Model.load(tokenizer_file(PIECE_MODEL))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = unigram.decode(unigram.encode(docs, model), model)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


@query("op5_warc")
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through WARC archives and the splittable reader."""
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    records = warc.read_warc(warc.write_warc(pages, work_dir(spark, "warc")), payloads=False)
    return records.select(F.col("record_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


@query("op6_ngram_jaccard_join")
def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: four-word shingles, Jaccard 0.85."""
    out = ngram_join.jaccard_components(table(spark, sf_dir, "documents"), ngram_join.JoinSettings(words=4, percent=85))
    return out.select("doc_id", "n_shingles", "component_id")


@query("op7_suffix_array_dedup")
def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of 50-byte strings that also start in a smaller document."""
    return suffix_dedup.dedup_substrings(table(spark, sf_dir, "documents")).drop("kept")


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a classifier learned from the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op2_pii_surrogates")
def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with surrogates in place of personal data."""
    out = pii.anonymise(table(spark, sf_dir, "documents"), PII_KEY)
    return out.select("doc_id", F.col("_pi_entities").alias("n_entities"), "text")


@query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), packing.PackSettings(tokenizer_file(WORD_TOKENIZER)))


OP10_SQL = r"""
WITH split_lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
  FROM documents WHERE text IS NOT NULL),
counted AS (
  SELECT *, len(list_filter(regexp_split_to_array(line, '[ \t-\r]+'), lambda x: x <> '')) AS n FROM split_lines),
s AS (
  SELECT *, row_number() OVER d AS seq, sum(n) OVER d AS upto, sum(n) OVER d - n AS before FROM counted WHERE n > 0
  WINDOW d AS (PARTITION BY doc_id ORDER BY line_no)),
windows AS (
  SELECT a.doc_id, a.seq AS first_seq, max(b.seq) AS last_seq, string_agg(b.line, chr(10) ORDER BY b.seq) AS k
  FROM s a JOIN s b ON a.doc_id = b.doc_id AND b.seq >= a.seq AND b.before < a.before + 50
  GROUP BY a.doc_id, a.seq, a.before HAVING max(b.upto) - a.before >= 50
  UNION
  SELECT a.doc_id, min(b.seq), a.seq, string_agg(b.line, chr(10) ORDER BY b.seq)
  FROM s a JOIN s b ON a.doc_id = b.doc_id AND b.seq <= a.seq AND b.upto > a.upto - 50
  GROUP BY a.doc_id, a.seq, a.upto HAVING a.upto - min(b.before) >= 50),
later AS (
  SELECT * FROM (SELECT *, min((doc_id, first_seq)) OVER (PARTITION BY k) AS origin FROM windows) WHERE (doc_id, first_seq) <> origin),
gone AS (
  SELECT DISTINCT s.doc_id, s.line_no FROM s JOIN later l ON s.doc_id = l.doc_id AND s.seq BETWEEN l.first_seq AND l.last_seq),
kept AS (
  SELECT c.doc_id, count(*) FILTER (WHERE n > 0) AS n_lines, count(*) FILTER (WHERE g.line_no IS NOT NULL) AS n_removed,
         string_agg(c.line, chr(10) ORDER BY c.line_no) FILTER (WHERE g.line_no IS NULL) AS kept_text
  FROM counted c LEFT JOIN gone g ON c.doc_id = g.doc_id AND c.line_no = g.line_no GROUP BY c.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN coalesce(kept_text, '') END AS kept_text
FROM documents d LEFT JOIN kept USING (doc_id)
"""


@query("op10_line_dedup", OP10_SQL)
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its later copies of repeated line runs cut out."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("_ld_lines").alias("n_lines"), F.col("_ld_removed").alias("n_removed"), F.col("text").alias("kept_text"))


@query("op13_bpe")
def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents by exact merges, and the texts that they decode to."""
    return bpe.digests(table(spark, sf_dir, "documents"), bpe.BpeFile.load(tokenizer_file(WORD_TOKENIZER)))


@query("op11_conversation_repair")
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by its row ids, with its faults, cheapest edits and repaired rows."""
    rows = table(spark, sf_dir, "conversations")
    return conversation_repair.report(conversation_repair.damage(rows), rows)


OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT row_number() OVER () AS q, item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
asked AS (SELECT DISTINCT q, item_id, unnest(w) AS t FROM items),
times AS (SELECT d, t, count(*) AS tf FROM (SELECT d, unnest(w) AS t FROM docs) WHERE t IN (SELECT t FROM asked) GROUP BY d, t),
size AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS N, sum(len(w))::BIGINT AS L FROM docs),
weight AS (SELECT t, floor(1000 * ln((2 * N + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM times, size GROUP BY t, N),
scored AS (
  SELECT q, item_id, d, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * len(w) * N) // L)))))::BIGINT AS score
  FROM asked JOIN times USING (t) JOIN weight USING (t) JOIN docs USING (d), size GROUP BY q, item_id, d, doc_id)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id ASC NULLS LAST)::INTEGER AS rank FROM scored WHERE score > 0)
WHERE rank <= 50
"""


@query("op12_lexical_search", OP12_SQL)
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty best documents of every benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
