"""The operators as queries over the driver's tables, and the DuckDB statements they must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from acreage.llm import pieces
from acreage.llm.alignment import alignment_digest
from acreage.llm.decontam import EDGES, NAME, NUMBER, NUMERIC, UNIT, UNITS, leaks
from acreage.llm.disclosure import disclosure_digest
from acreage.llm.exact_dedup import exact_dedup
from acreage.llm.langid import identify
from acreage.llm.line_dedup import line_dedup
from acreage.llm.lm import score_texts
from acreage.llm.minhash_join import near_duplicates
from acreage.llm.run_index import remove_repeats
from acreage.llm.sharding import shard
from acreage.llm.spelling import spelling_variants
from acreage.llm.warc_zip import round_trip

#: Vocabularies of the queries on tokens; files on the driver.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_warc(spark, folder):
    return round_trip(table(spark, folder, "pages")).drop("url")


ORACLES["op1_warc"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), k AS (SELECT payload_digest, max(page_id) AS keeper FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN keeper END AS refers_to
FROM p LEFT JOIN k USING (payload_digest)
"""


@query
def op2_language_id(spark, folder):
    return identify(table(spark, folder, "documents")).drop("text_key")


@query
def op3_sentencepiece(spark, folder):
    return pieces.round_trip(table(spark, folder, "documents"), PIECE_MODEL)


@query
def op4_lm_scoring(spark, folder):
    return score_texts(table(spark, folder, "documents"))


@query
def op5_minhash_join(spark, folder):
    found = near_duplicates(table(spark, folder, "documents"), width=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op6_decontamination(spark, folder):
    return leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("text_key")


def _decontamination_sql() -> str:
    """Template windows of 8 words; a text of fewer words is one window."""
    edges = "'" + EDGES.replace("'", "''") + "'"
    units = ", ".join(f"'{u}'" for u in UNITS)
    before = "OVER (PARTITION BY kind, id ORDER BY i)"
    follows = " || chr(1) || ".join(["t", *[f"lead(t, {k}) OVER (PARTITION BY kind, id ORDER BY p)" for k in range(1, 8)]])
    unit = f"pbare >= '0' AND pbare < ':' AND regexp_matches(pbare, '{NUMERIC}') AND lower(bare) IN ({units})"
    return rf"""
WITH src AS (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
split AS (SELECT kind, id, string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') AS l FROM src),
raw AS (SELECT kind, id, unnest(l) AS raw, generate_subscripts(l, 1) AS i FROM split),
w AS (SELECT kind, id, i, trim(raw, {edges}) AS bare, lag(raw) {before} AS praw, lag(trim(raw, {edges})) {before} AS pbare FROM raw),
t AS (SELECT kind, id, i, lower(bare) AS v, CASE
    WHEN bare >= 'a' AND bare < '{{' THEN CASE WHEN {unit} THEN '{UNIT}' ELSE lower(bare) END
    WHEN bare = '' THEN ''
    WHEN bare >= '0' AND bare < ':' THEN CASE WHEN regexp_matches(bare, '{NUMERIC}') THEN '{NUMBER}' ELSE lower(bare) END
    WHEN {unit} THEN '{UNIT}'
    WHEN bare[1] <> lower(bare[1]) AND praw <> '' AND praw[-1] NOT IN ('.', '!', '?', ':') AND bare[2:] = lower(bare)[2:] THEN '{NAME}'
    ELSE lower(bare) END AS t FROM w),
u AS (SELECT kind, id, t, v, row_number() OVER (PARTITION BY kind, id ORDER BY i) - 1 AS p, count(*) OVER (PARTITION BY kind, id) AS n
    FROM t WHERE t <> ''),
win AS (SELECT kind, id, p, n, 8 AS length, {follows} AS content FROM u
    UNION ALL SELECT kind, id, 0, n, n, string_agg(t, chr(1) ORDER BY p) FROM u WHERE n < 8 GROUP BY kind, id, n),
hit AS (SELECT DISTINCT d.id AS doc_id, b.id AS item_id, b.n AS item_words, b.p AS q, d.p - b.p AS shift, length
    FROM win d JOIN win b USING (length, content) WHERE d.kind = 'd' AND b.kind = 'b'),
slot AS (SELECT doc_id, item_id, shift, q, x.t, x.v AS bv, y.v AS dv FROM hit
    JOIN u x ON x.kind = 'b' AND x.id = item_id AND x.p BETWEEN q AND q + length - 1
    JOIN u y ON y.kind = 'd' AND y.id = doc_id AND y.p = x.p + shift
    WHERE x.t IN ('{NUMBER}', '{NAME}', '{UNIT}')),
each AS (SELECT doc_id, item_id, shift, t, bv, count(DISTINCT dv) AS k FROM slot GROUP BY ALL),
broken AS (SELECT doc_id, item_id, shift, max(k) > 1 AS broken FROM each GROUP BY ALL),
owned AS (SELECT doc_id, item_id, shift, q, bool_and(dv = bv) AS own FROM slot GROUP BY ALL),
sound AS (SELECT hit.*, coalesce(own, true) AS own FROM hit LEFT JOIN broken USING (doc_id, item_id, shift)
    LEFT JOIN owned USING (doc_id, item_id, shift, q)
    WHERE coalesce(own, true) OR (NOT coalesce(broken, false) AND length = 8)),
words AS (SELECT doc_id, item_id, item_words, count(DISTINCT q) AS n_windows, count(DISTINCT q + j) AS covered_words, bool_and(own) AS literal
    FROM sound, range(8) AS r(j) WHERE j < length GROUP BY ALL),
place AS (SELECT DISTINCT doc_id, item_id, q + j AS i FROM sound, range(8) AS r(j) WHERE j < length),
island AS (SELECT doc_id, item_id, i - row_number() OVER (PARTITION BY doc_id, item_id ORDER BY i) AS g FROM place),
runs AS (SELECT doc_id, item_id, max(k) AS longest_run FROM (
    SELECT doc_id, item_id, g, count(*) AS k FROM island GROUP BY ALL) GROUP BY ALL)
SELECT doc_id, item_id, n_windows, covered_words, item_words, longest_run, covered_words / item_words AS coverage, literal
FROM words JOIN runs USING (doc_id, item_id) WHERE covered_words / item_words >= 0.5 OR longest_run >= 13
"""


ORACLES["op6_decontamination"] = _decontamination_sql()


@query
def op7_exact_dedup(spark, folder):
    return exact_dedup(table(spark, folder, "documents"))


ORACLES["op7_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""


@query
def op8_run_index(spark, folder):
    return remove_repeats(table(spark, folder, "documents"))


@query
def op9_line_dedup(spark, folder):
    left = F.coalesce("dedup.text", F.lit("")).cast("binary")
    return line_dedup(table(spark, folder, "documents").select("doc_id", "text"), window=2, min_words=0).select(
        "doc_id", "dedup.n_lines", "dedup.n_removed", "dedup.n_in_runs", F.sha2(left, 256).alias("kept_sha256"))


ORACLES["op9_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
), u AS (
  SELECT doc_id, place, trim(line, ' ' || chr(9) || chr(13)) AS t,
    row_number() OVER (PARTITION BY doc_id ORDER BY place) AS i
  FROM l WHERE trim(line, ' ' || chr(9) || chr(13)) <> ''
), w AS (
  SELECT doc_id, i, 2 AS length, t || chr(10) || lead(t) OVER (PARTITION BY doc_id ORDER BY i) AS content FROM u
  UNION ALL
  SELECT doc_id, i, 1, t FROM u
), r AS (
  SELECT doc_id, i, length, row_number() OVER (PARTITION BY length, content ORDER BY doc_id, i) AS k FROM w WHERE content IS NOT NULL
), gone AS (
  SELECT doc_id, i + j AS i, max(length) AS length FROM r, (VALUES (0), (1)) AS o(j) WHERE k > 1 AND j < length GROUP BY doc_id, i + j
), dead AS (SELECT doc_id, place, length FROM gone JOIN u USING (doc_id, i))
SELECT l.doc_id, count(*) AS n_lines, count(dead.place) AS n_removed, count(*) FILTER (WHERE dead.length = 2) AS n_in_runs,
  sha256(coalesce(string_agg(CASE WHEN dead.place IS NULL THEN line END, chr(10) ORDER BY l.place), '')) AS kept_sha256
FROM l LEFT JOIN dead ON l.doc_id = dead.doc_id AND l.place = dead.place GROUP BY l.doc_id
"""


@query
def op10_sharding(spark, folder):
    return shard(table(spark, folder, "documents"))


@query
def op11_pii(spark, folder):
    return disclosure_digest(table(spark, folder, "documents"))


@query
def op12_spelling(spark, folder):
    return spelling_variants(table(spark, folder, "documents"))


ORACLES["op12_spelling"] = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents
), lower_runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM runs GROUP BY ALL
), bytes AS (
  SELECT run, n, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
    lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195, unicode(x)::BIGINT - 64] END)) AS b FROM lower_runs
), hashed AS (
  SELECT run, n, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) AS h FROM bytes, crc
), words AS (
  SELECT CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3
), cut AS (
  SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM words, LATERAL (SELECT unnest(range(1, length(word) + 1)) AS i)
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, other) AS other, max(m) AS m FROM near GROUP BY word
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * w.n THEN other END AS form, CASE WHEN m >= 2 * w.n THEN m END AS form_n
  FROM words w LEFT JOIN best USING (word)
), path AS (
  SELECT word, word AS here FROM formed
  UNION ALL
  SELECT path.word, form FROM path JOIN formed ON formed.word = path.here WHERE form IS NOT NULL
), ends AS (SELECT path.word, here AS root FROM path JOIN formed ON formed.word = path.here WHERE form IS NULL)
SELECT word, n, n_near, form, form_n, root FROM formed JOIN ends USING (word)
"""


@query
def op13_alignment(spark, folder):
    return alignment_digest(table(spark, folder, "documents"), BYTE_BPE, PIECE_MODEL)
